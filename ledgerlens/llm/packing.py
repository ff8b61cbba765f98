"""Best-fit packing in bulk-synchronous rounds (operator 1).

Pieces of at most ``capacity`` tokens go into as few sequences as possible.  Size
classes are placed from large to small, each halving the last; pieces over half
the capacity open a sequence each.  For every further class the round is:

1. *Range sort.*  The open gaps, cut into slots of the class's size (so that one
   gap takes several small pieces in a round, but never more slots than there are
   pieces), and the class's pieces are sorted together by size, largest first, range
   partitioned.  The smallest gaps that give every piece a slot are enough.
2. *Successor sweep.*  Each partition walks its rows with a stack of slots: a
   piece takes the slot seen last, which is the smallest free one that holds it.
   What a partition cannot match is numbered.
3. *Ranks settle the rest.*  Only the partitions' counts reach the driver (two
   numbers each); they tell which run of unmatched slots of earlier partitions
   the unmatched pieces of a partition take, the smallest first.  Pieces and
   slots meet in an equi-join on (partition, rank), unique on both sides.
4. *Update.*  Gaps shrink by what they took; slots of one gap merge again.

Rounds repeat while pieces are left and gaps can hold them.  Pieces without a gap
get new empty sequences, as many as their tokens fill at least.  Each round's state is
a table in the shared folder.

Defined cases: a null text is an empty one (its end id alone); null ids and
repeated rows are packed like any others; no rows give no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from .storage import PART_ROWS, release, remove_table, save
from .text import whole
from .tokens import drop_encoders, encoder
from .words import batches_of, give_back

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_SWEPT = "kind int, key long, size long, seq long, matched boolean, part long, rank long"


def token_pieces(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each text, append ``end_id`` and cut what is longer than ``capacity``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for b in batches_of(batches, 1):
            all_ids, cut = enc.encode(b.column(1))
            out = []
            for doc, a, z in zip(b.column(0).to_pylist(), cut[:-1].tolist(), cut[1:].tolist()):
                raw = memoryview(all_ids[a:z].tobytes() + end)
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    ids = raw[at:at + 4 * capacity]
                    out.append((doc, k, at // 4, len(ids) // 4, zlib.crc32(ids)))
            cols = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])
            del b, all_ids, out, cols
        give_back()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"))
    return texts.mapInArrow(rows, _PIECES)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by size, largest first, slots (kind 0) before pieces (kind 1) of their size; whole runs of them at once.

    Last, if any are left alone, comes a row of kind 2 with their numbers: of pieces (key) and of slots (size).
    """
    drop_encoders()
    part, alone = TaskContext.get().partitionId(), 0
    stack: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # runs of free slots (key, size, seq), the smallest last
    for b in batches:
        size, kind, key, seq = (b.column(c).to_numpy() for c in ("size", "kind", "key", "seq"))
        cuts = [0, *(np.flatnonzero((np.diff(size) != 0) | (np.diff(kind) != 0)) + 1).tolist(), len(size)]
        out = []
        for a, z in zip(cuts[:-1], cuts[1:]):
            if a < z and kind[a] == 0:
                stack.append((key[a:z], size[a:z], seq[a:z]))
                continue
            while a < z and stack:
                run = stack.pop()
                n = min(z - a, len(run[0]))
                if n < len(run[0]):
                    stack.append(tuple(x[:-n] for x in run))
                out.append((1, key[a:a + n], size[a:a + n], run[2][-n:][::-1], True, 0))
                a += n
            if a < z:
                out.append((1, key[a:z], size[a:z], np.full(z - a, -1), False, alone))
                alone += z - a
        if out:
            yield _swept(out, part)
    rank = 0
    for key, size, seq in stack:
        yield _swept([(0, key, size, seq, False, rank)], part)
        rank += len(key)
    if alone or rank:
        yield _swept([(2, *(np.array([x]) for x in (alone, rank, -1)), False, 0)], part)


def _swept(runs: list[tuple], part: int) -> pa.RecordBatch:
    """Rows of runs (kind, keys, sizes, seqs, matched, rank of the first)."""
    n = [len(r[1]) for r in runs]
    rank = [np.zeros(k, np.int64) if r[4] else np.arange(r[5], r[5] + k) for r, k in zip(runs, n)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat([r[0] for r in runs], n).astype(np.int32)),
         *(pa.array(np.concatenate([r[c] for r in runs])) for c in (1, 2, 3)),
         pa.array(np.repeat([r[4] for r in runs], n)), pa.array(np.full(sum(n), part)), pa.array(np.concatenate(rank))],
        ["kind", "key", "size", "seq", "matched", "part", "rank"])


def _runs(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(part, first rank, last rank, slots' part, slots' rank for the first) from (part, pieces, slots)."""
    runs, stack = [], []
    for part, pieces, slots in sorted(counts):
        r = 0
        while r < pieces and stack:
            q, left = stack.pop()
            n = min(left, pieces - r)
            runs.append((part, r, r + n - 1, q, left - 1))
            if left > n:
                stack.append((q, left - n))
            r += n
        if slots:
            stack.append((part, slots))
    return runs


def _room(fits: list[tuple[int, int]], longest: int, least: int, n: int) -> tuple[int, int]:
    """(widest gap to offer, slots that makes) for n pieces, from the numbers of gaps by size.

    Gaps are offered from the smallest up until every piece has a slot of its own.
    """
    whole_slots, slots, widest = 0, 0, 0
    for widest, count in sorted(fits):
        whole_slots += count * min(n, widest // longest)
        slots += count * (min(n, widest // longest) + (widest % longest >= least))
        if whole_slots >= n:
            break
    return widest, slots


def _round(pieces: DataFrame, n_pieces: int, gaps: DataFrame, low: int, high: int, rows: int, name: str) -> tuple:
    """(swept table, matched pieces (key, size, seq), pieces left) of one sweep; no gap has more slots than pieces."""
    n = F.least(F.floor(F.col("gap") / high), F.lit(n_pieces))
    slots = gaps.select("seq", F.explode(F.concat(
        F.array_repeat(F.lit(high).cast("long"), n.cast("int")),
        F.array_repeat(F.col("gap") % high, F.when(F.col("gap") % high >= low, 1).otherwise(0)))).alias("size"))
    both = (slots.select(F.col("size"), F.lit(0).alias("kind"), F.xxhash64("seq").alias("key"), "seq")
            .unionByName(pieces.select("size", F.lit(1).alias("kind"), "key", F.lit(-1).cast("long").alias("seq"))))
    order = [F.col("size").desc(), "kind", "key"]
    parts = 1 + rows // PART_ROWS
    dealt = both.repartitionByRange(parts, *order) if parts > 1 else both.repartition(1)  # one range needs no sample
    swept = save(dealt.sortWithinPartitions(*order)
                 .mapInArrow(_sweep, _SWEPT), name)
    counts = swept.where("kind = 2").select("part", F.col("key").alias("pieces"), F.col("size").alias("slots")).collect()
    runs = _runs([tuple(c) for c in counts])
    alone = swept.where("kind = 1 and not matched")
    matched = swept.where("matched").select("key", "size", "seq")
    if not runs:
        return swept, matched, alone.select("key", "size"), sum(c.pieces for c in counts)
    plan = F.broadcast(pieces.sparkSession.createDataFrame(  # at most two rows per partition
        runs, "part long, first long, last long, slot_part long, slot_rank long"))
    wish = (alone.join(plan, "part", "left")
            .where(F.col("first").isNull() | F.col("rank").between(F.col("first"), F.col("last")))
            .select("key", "size", "slot_part", (F.col("slot_rank") - F.col("rank") + F.col("first")).alias("slot_rank")))
    free = swept.where("kind = 0").select(F.col("part").alias("slot_part"), F.col("rank").alias("slot_rank"), "seq")
    met = wish.join(free, ["slot_part", "slot_rank"])
    taken = sum(last - first + 1 for _, first, last, _, _ in runs)
    ends = {c.part: 0 for c in counts}
    for part, _, last, _, _ in runs:
        ends[part] = max(ends[part], last + 1)
    plan_end = F.broadcast(pieces.sparkSession.createDataFrame(list(ends.items()), "part long, upto long"))
    left = alone.join(plan_end, "part").where(F.col("rank") >= F.col("upto")).select("key", "size")
    return (swept, matched.unionByName(met.select("key", "size", "seq")), left,
            sum(c.pieces for c in counts) - taken)


def best_fit(pieces: DataFrame, capacity: int, smallest_class: int = 64) -> DataFrame:
    """(key, seq) for every row (key unique, size between 1 and ``capacity``) of a written table."""
    spark = pieces.sparkSession
    half = capacity // 2
    placed = [pieces.where(F.col("size") > half).select("key", F.col("key").alias("seq"))]
    gaps = save(pieces.where((F.col("size") > half) & (F.col("size") < capacity))
                .select(F.col("key").alias("seq"), (F.lit(capacity) - F.col("size")).cast("long").alias("gap")), "gaps")
    high, opened, n, gaps_table, left_table, n_gaps = half, 0, 0, gaps, None, gaps.count()
    while high >= 1:
        low = high // 2 if high > smallest_class else 0
        todo = pieces.where((F.col("size") > low) & (F.col("size") <= high)).select("key", "size")
        n_left = todo.count()
        full, new, before = False, 0, n_left
        while n_left:
            tokens, longest, least = todo.agg(F.sum("size"), F.max("size"), F.min("size")).first()
            fits = [] if full else [  # at most ``capacity`` numbers
                (r.gap, r.n) for r in gaps.where(F.col("gap") >= least).groupBy("gap")
                .agg(F.count("*").alias("n")).coalesce(1).collect()]
            widest = max((gap for gap, _ in fits), default=capacity)
            if fits:
                offered, slots = _room(fits, longest, least, n_left)
                room = gaps.where(F.col("gap").between(least, offered))
            else:
                if new and before > n_left:  # as many pieces to a sequence as the last ones took
                    new = math.ceil(n_left * new / (before - n_left))
                else:
                    new = math.ceil(tokens / capacity)
                before = n_left
                slots = _room([(capacity, new)], longest, least, n_left)[1]
                room = spark.range(new).select((F.col("id") + (1 << 62) + opened).alias("seq"),
                                               F.lit(capacity).cast("long").alias("gap"))
                opened += new
                gaps = gaps.unionByName(room)
            swept, matched, left, now_left = _round(todo, n_left, room, least, longest, n_left + slots, f"swept{n}")
            got = save(matched, f"placed{n}", most_rows=n_left)
            placed.append(got.select("key", "seq"))
            old = [x for x in (gaps_table, left_table) if x is not None]
            gaps = gaps_table = save(
                gaps.unionByName(got.select("seq", (-F.col("size")).alias("gap")))  # what was taken always lies in a gap
                .groupBy("seq").agg(F.sum("gap").alias("gap")).where("gap > 0"),
                f"gaps{n}", most_rows=n_gaps + opened)
            todo = left_table = save(left, f"left{n}", most_rows=now_left) if now_left else None
            for finished in (swept, *old):
                remove_table(finished)
            full = widest < 2 * least  # no gap takes two pieces: what is left of them is for smaller classes
            n_left, n = now_left, n + 1
        release(spark)  # plans and shuffle files of the class's rounds
        if low == 0:
            break
        high = low
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 1,
                   **columns) -> DataFrame:
    """One row per piece with its sequence and its gapless offset there."""
    pieces = save(token_pieces(docs, tokenizer, capacity=capacity, end_id=end_id, **columns)
                  .withColumn("key", F.monotonically_increasing_id()), "pieces")
    where = best_fit(pieces.select("key", F.col("length").alias("size")), capacity)
    before = W.partitionBy("seq").orderBy(F.col("length").desc(), "key").rowsBetween(W.unboundedPreceding, -1)
    return (pieces.join(where, "key")
            .select("doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"),
                    F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset")))
