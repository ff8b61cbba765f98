"""Encoding whole texts with a public tokenizer, each distinct piece of text once per worker.

A tokenizer file of the ``tokenizers`` library splits a text before it merges, and the
parts come again and again.  Texts are cut, with numpy over a batch's bytes, into
pieces whose ids do not depend on what stands around them; pieces are recognised by a
64-bit hash, the unknown ones are encoded by the library, and the ids of a text are
gathered from its pieces.  A worker remembers up to ``room`` pieces in flat arrays, until
a task that encodes nothing takes it over (:func:`drop_encoders`).

A cut is made only where the splitting rule of both files (letters, digits, runs of
other signs; a space may open a part) is sure to end a part whatever follows:

* before white space that follows a sure non-space;
* between an ASCII letter or digit, or a two-byte Latin letter, and an ASCII sign;
* between an ASCII sign other than the apostrophe (contractions) and a letter or digit;
* after one single line break or tab between sure non-spaces.

Strings of the file's added tokens, which the library finds in a text before it splits
anything, are never cut, and pieces that hold one are encoded by themselves; where such a
token takes neighbouring white space with it, that stays in its piece too.

Any other place - other scripts, runs of white space, control characters - is left
inside a piece, which is then just longer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .words import give_back, hash_runs, text_bytes

_ENCODERS: dict[str, "Encoder"] = {}

_SPACE, _BREAK, _ALNUM, _SIGN, _APOSTROPHE, _LEAD = 1, 2, 3, 4, 5, 6  # 0: anything else
_CLASS = np.zeros(256, np.uint8)
for _c in range(33, 127):
    _CLASS[_c] = _ALNUM if chr(_c).isalnum() else _SIGN
_CLASS[32], _CLASS[ord("'")] = _SPACE, _APOSTROPHE
_CLASS[9:14] = _BREAK
_CLASS[0xC3:0xCA] = _LEAD  # U+00C0 to U+027F: letters but for the signs of multiplication and division


def piece_starts(data: np.ndarray, offsets: np.ndarray, whole: list[tuple[bytes, bool, bool]] = ()) -> np.ndarray:
    """Where pieces begin; every text begins one.

    ``whole``: strings that must not be cut, each with whether white space before and after it belongs to it.
    """
    if not len(data):
        return np.empty(0, np.int64)
    kind = _CLASS[data]
    lead = np.flatnonzero(kind[:-1] == _LEAD)
    sign = (data[lead] == 0xC3) & ((data[lead + 1] == 0x97) | (data[lead + 1] == 0xB7))
    kind[lead[sign]] = 0
    kind[lead[~sign] + 1] = _LEAD  # the second byte ends a letter
    start = np.zeros(len(data), bool)
    now, before = kind[1:], kind[:-1]
    sure = before >= _ALNUM
    space = (now == _SPACE) | (now == _BREAK)
    letter_before = (before == _ALNUM) | (before == _LEAD)
    letter_now = (now == _ALNUM) | ((now == _LEAD) & (data[1:] >= 0xC0))
    cut = space & sure
    cut |= letter_before & ((now == _SIGN) | (now == _APOSTROPHE))
    cut |= (before == _SIGN) & letter_now
    start[1:] = cut
    if len(data) > 2:
        lone = (kind[:-2] >= _ALNUM) & (before[1:] == _BREAK) & (letter_now | (now == _SIGN) | (now == _APOSTROPHE))[1:]
        start[2:] |= lone
    if whole:
        _mend(start, kind, data.tobytes(), whole)
    start[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(start)


def _mend(start: np.ndarray, kind: np.ndarray, raw: bytes, whole: list[tuple[bytes, bool, bool]]) -> None:
    """Take back the cuts inside strings that must stay whole."""
    for content, left, right in whole:
        at = raw.find(content)
        while at >= 0:
            a, z = at, at + len(content)
            while left and a and kind[a - 1] in (_SPACE, _BREAK):
                a -= 1
            while right and z < len(raw) and kind[z] in (_SPACE, _BREAK):
                z += 1
            start[a + 1:z] = False
            if left or right:
                start[a] = False
                start[z:z + 1] = False
            at = raw.find(content, at + 1)


class Encoder:
    def __init__(self, path: str, room: int = 1_000_000) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = self.tok.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.whole = [(t.content.encode(), t.lstrip, t.rstrip) for t in added]
        self.room = room
        self.mark = "\n" if len(self._raw("\n")) else " \x01 "  # stands alone between any two plain pieces
        self.mark_id = int(self._raw(self.mark)[0])
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.slot = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.begin, self.ids, self.n, self.used = np.zeros(1 << 16, np.int64), np.empty(1 << 18, np.uint32), 0, 0

    @staticmethod
    def _longer(a: np.ndarray, least: int) -> np.ndarray:
        """The same with room for ``least`` numbers and a quarter more."""
        if least <= len(a):
            return a
        out = np.zeros(least + least // 4, a.dtype)
        out[:len(a)] = a
        return out

    def _raw(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def _plain(self, p: str) -> bool:
        if any(t in p for t in self.added):
            return False
        if self.mark != "\n":
            return "\x01" not in p
        return "\n" not in p and not p[-1].isspace() and not (p[0].isspace() and (p[0] != " " or p[1].isspace()))

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first id of each piece and their number)."""
        plain = [self._plain(p) for p in pieces]
        joined = self.mark.join(["", *(p for p, ok in zip(pieces, plain) if ok)])
        ids = self._raw(joined)
        at = np.flatnonzero(ids == self.mark_id)
        if len(at) != sum(plain):
            raise AssertionError("the pieces of a batch cannot be told apart")
        keep = ids[ids != self.mark_id]
        sizes = np.diff(np.append(at, len(ids))) - 1
        if all(plain):
            return keep, np.concatenate([[0], np.cumsum(sizes)])
        cut = iter(np.split(keep, np.cumsum(sizes)[:-1])) if len(sizes) else iter(())
        parts = [next(cut) if ok else self._raw(p) for p, ok in zip(pieces, plain)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        ids, cuts = self._encode(pieces)
        self.begin = self._longer(self.begin, self.n + len(pieces) + 1)
        self.ids = self._longer(self.ids, self.used + len(ids))
        self.ids[self.used:self.used + len(ids)] = ids
        self.begin[self.n:self.n + len(cuts)] = cuts + self.used
        slots = np.arange(self.n, self.n + len(pieces), dtype=np.int32)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.slot = np.insert(self.hashes, at, hashes), np.insert(self.slot, at, slots)
        self.n += len(pieces)
        self.used += len(ids)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of each text and their number) of a string column without nulls."""
        data, offsets = text_bytes(column)
        start = piece_starts(data, offsets, self.whole)
        if not len(start):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        hashes, first, which = np.unique(hash_runs(data, start), return_index=True, return_inverse=True)
        if self.n > self.room:
            self._forget()
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, self.n - 1))
        new = np.flatnonzero(self.hashes[at] != hashes) if self.n else np.arange(len(hashes))
        if len(new):
            raw, end = data.tobytes(), np.append(start[1:], len(data))
            own = first[new]
            self._learn(hashes[new], [raw[a:z].decode() for a, z in zip(start[own].tolist(), end[own].tolist())])
            at = np.searchsorted(self.hashes, hashes)
        slot = self.slot[at][which.reshape(-1)]
        begin = self.begin[slot]
        size = self.begin[slot + 1] - begin
        cut = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(cut[-1]) + np.repeat(begin - cut[:-1], size)]
        return ids, cut[np.searchsorted(start, offsets)]


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def drop_encoders() -> None:
    """Free what this worker remembers of tokenizers, for tasks that come after all texts are encoded."""
    if _ENCODERS:
        _ENCODERS.clear()
        give_back()
