"""Mixing, archives, token files and packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import best_fit_decreasing, targets, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import archives, mixing, packing, token_files, tokens
from ledgerlens.llm.queries import tokenizer_path
from ledgerlens.llm.storage import new_path, save
from ledgerlens.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
ODD = [(3, None), (3, "b"), (1, ""), (None, "null id"), (2, "x " * 9000), (-5, "it's, isn't: 'S\n\n\tend   x")]


def docs(spark, rows=None):
    if rows is None:
        return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def encoded(rows, file, end):
    tok = Tokenizer.from_file(tokenizer_path(file))  # as the library has it: special tokens in a text are found
    return [(d, np.array(tok.encode(t or "", add_special_tokens=False).ids + [end], "<u4")) for d, t in rows]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(file):
    rng = random.Random(1)
    signs = list(" \n\t\r'.,!abcABC019éÉß×÷ñ—…“  \u0085́中日🙂\x01\x1c\x00ΣσＡ") + [
        "'s", "'ll", " the", " don't", "\n\n", "  ", "<|endoftext|>", " <|endoftext|> ", "<|endof", "text|>"]
    plain = Tokenizer.from_file(tokenizer_path(file))
    signs += [t.content for t in plain.get_added_tokens_decoder().values()][:20]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 50))) for _ in range(4000)]
    enc = Encoder(tokenizer_path(file), room=2000)
    for i in range(0, len(texts), 400):
        part = texts[i:i + 400]
        ids, cut = enc.encode(pa.array(part, pa.string()))
        for t, a, z in zip(part, cut, cut[1:]):
            assert ids[a:z].tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("width", [1, 3, 7, 8, 13, 15, 16, 17, 24, 31, 32])
def test_bit_packing(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 1001, dtype=np.uint64).astype(np.uint32)
    raw = token_files.pack(ids, width)
    assert len(raw) == -(-len(ids) * width // 8)
    for a, z in ((0, 1001), (0, 0), (5, 6), (997, 1001), (13, 700)):
        assert token_files.unpack(raw, width, a, z).tolist() == ids[a:z].tolist()


def test_token_files_round_trip(spark, monkeypatch):
    for rows in (None, ODD, []):
        df = docs(spark, rows)
        path = new_path(spark, "test-tokens")
        got = token_files.token_file_round_trip(df, tokenizer_path("byte_bpe_50k.json"), path).collect()
        all_ids = encoded([tuple(r) for r in df.collect()], "byte_bpe_50k.json", 0)
        by = defaultdict(list)
        for d, ids in all_ids:
            by[d].append((len(ids), zlib.crc32(ids.tobytes())))
        assert sorted(((r.doc_id is not None, r.doc_id, r.n_tokens, r.ids_crc32) for r in got)) == \
            sorted((d is not None, d, *x) for d, l in by.items() for x in l)
        start, last = 0, None
        for r in sorted(got, key=lambda r: r.start):
            assert r.start == start and (last is None or r.doc_id >= last)
            start, last = start + r.n_tokens, r.doc_id


def test_packed_file_slices():
    rng = random.Random(5)
    documents = [(i, np.array([rng.randrange(50257) for _ in range(rng.randint(1, 40_000))], "<u4")) for i in range(12)]
    raw = b"".join(b + b"\n" for b in token_files._blocks(((d, x.tobytes()) for d, x in documents), 16))
    flat = np.concatenate([x for _, x in documents])
    file = token_files.PackedFile(raw)
    assert file.n_ids == len(flat) and len(file.offsets) == -(-len(flat) // token_files.BLOCK)
    for _ in range(30):
        a = rng.randrange(len(flat))
        z = rng.randrange(a, len(flat) + 1)
        assert (file.ids(a, z) == flat[a:z]).all()


def check_packing(rows, pieces, capacity):
    by = defaultdict(list)
    for r in pieces:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    want = sorted((d is not None, d, k // capacity, k, len(x[k:k + capacity]), zlib.crc32(x[k:k + capacity].tobytes()))
                  for d, x in rows for k in range(0, len(x), capacity))
    assert sorted((r.doc_id is not None, r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == want
    return len(by), [r.length for r in pieces]


def test_packing(spark):
    for rows in (None, ODD, []):
        df = docs(spark, rows)
        got = packing.pack_documents(df, tokenizer_path("word_bpe_49k.json")).collect()
        n, sizes = check_packing(encoded([tuple(r) for r in df.collect()], "word_bpe_49k.json", 1), got, 4096)
        assert n <= best_fit_decreasing(sizes, 4096) * 1.02 + 1


def test_sweeps_free_the_workers_encoders(monkeypatch):
    monkeypatch.setattr(tokens, "_ENCODERS", {"file": object()})
    monkeypatch.setattr(packing.TaskContext, "get", classmethod(lambda cls: cls.__new__(cls)))
    monkeypatch.setattr(packing.TaskContext, "partitionId", lambda self: 0)
    assert list(packing._sweep(iter([]))) == [] and not tokens._ENCODERS


def test_encoders_hold_little_more_than_they_remember():
    enc = Encoder(tokenizer_path("word_bpe_49k.json"))
    for i in range(20):
        enc.encode(pa.array([" ".join(f"w{k}" for k in range(i * 9000, (i + 1) * 9000))]))
    assert enc.n > 150_000 and len(enc.begin) <= 1.3 * enc.n and len(enc.ids) <= 1.3 * enc.used


def test_packing_rounds_over_many_partitions(spark, monkeypatch):
    rng = random.Random(9)
    sizes = [min(4096, max(1, int(rng.lognormvariate(6, 1)))) for _ in range(1500)] + [1100] * 200 + [4096, 2048, 2049]
    monkeypatch.setattr(packing, "PART_ROWS", 150)
    table = save(spark.createDataFrame(list(enumerate(sizes)), "key long, size long"), "test-pieces")
    got = packing.best_fit(table, 4096).collect()
    by = defaultdict(int)
    for r in got:
        by[r.seq] += sizes[r.key]
    assert sorted(r.key for r in got) == list(range(len(sizes))) and max(by.values()) <= 4096
    assert len(by) <= best_fit_decreasing(sizes, 4096) * 1.02 + 1


def test_packing_rounds_leave_the_driver_few_files(spark, monkeypatch):
    """One file for each small table of a round, whatever the number of shuffle partitions."""
    seen = {}
    monkeypatch.setattr(packing, "release", lambda s: None)
    monkeypatch.setattr(packing, "save", lambda df, name, **k: (out := save(df, name, **k), seen.update({name: len(out.inputFiles())}))[0])
    sizes = [3000, 2500, 2100] * 20 + [1500, 900, 400, 70] * 30
    table = save(spark.createDataFrame(list(enumerate(sizes)), "key long, size long"), "test-pieces")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = packing.best_fit(table, 4096).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.key for r in got) == list(range(len(sizes)))
    assert {"gaps0", "placed0"} <= set(seen)
    assert all(n == 1 for name, n in seen.items() if name.startswith(("gaps", "placed", "left")) and name != "gaps")


def test_gaps_are_filled_though_each_round_places_few(spark):
    """Gaps take pieces as long as they hold them, however small a part of all pieces that is."""
    sizes = [2106] * 24 + [128] + [65] * 20_000
    table = save(spark.createDataFrame(list(enumerate(sizes)), "key long, size long"), "test-pieces")
    got = packing.best_fit(table, 4096).collect()
    assert sorted(r.key for r in got) == list(range(len(sizes)))
    assert len({r.seq for r in got}) <= best_fit_decreasing(sizes, 4096) + 1


def test_few_left_over_pieces_open_no_more_than_they_need(spark):
    for sizes in ([1400] * 7, [1400] * 61 + [1300] * 3, [600] * 99, [1] * 5000):
        table = save(spark.createDataFrame(list(enumerate(sizes)), "key long, size long"), "test-pieces")
        got = packing.best_fit(table, 4096).collect()
        assert sorted(r.key for r in got) == list(range(len(sizes)))
        assert len({r.seq for r in got}) == best_fit_decreasing(sizes, 4096)


def test_offered_gaps_are_the_smallest_that_suffice():
    assert packing._room([(100, 5), (30, 2), (64, 1)], 30, 20, 3) == (64, 4)
    assert packing._room([(4096, 1)], 1, 1, 10) == (4096, 10)
    assert packing._room([(25, 4)], 30, 20, 3) == (25, 4)


def test_sweep_takes_the_smallest_slot_that_holds():
    rng = random.Random(2)
    rows = sorted([(-rng.randint(1, 9), rng.randint(0, 1), k) for k in range(300)])
    batch = pa.RecordBatch.from_arrays(
        [pa.array([-r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.int64()), pa.array([r[2] + 1000 if r[1] == 0 else -1 for r in rows], pa.int64())],
        ["size", "kind", "key", "seq"])
    stack, want = [], []
    for size, kind, key in rows:
        if kind == 0:
            stack.append(key + 1000)
        else:
            want.append((key, stack.pop() if stack else -1))

    class Task:
        partitionId = staticmethod(lambda: 7)

    real, packing.TaskContext.get = packing.TaskContext.get, staticmethod(lambda: Task)
    try:
        out = [r for b in packing._sweep(iter([batch.slice(0, 100), batch.slice(100, 0), batch.slice(100)]))
               for r in b.to_pylist()]
    finally:
        packing.TaskContext.get = real
    assert [(r["key"], r["seq"]) for r in out if r["kind"] == 1] == want
    assert [r["seq"] for r in out if r["kind"] == 0] == stack
    assert [r["rank"] for r in out if not r["matched"] and r["kind"] == 0] == list(range(len(stack)))


def test_runs_take_the_latest_slots_first():
    assert packing._runs([(0, 1, 3), (1, 2, 0), (2, 4, 2), (3, 1, 0)]) == [
        (1, 0, 1, 0, 2), (2, 0, 0, 0, 0), (3, 0, 0, 2, 1)]


def mix_rows():
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.choice([0, 3, 20, 50, 400])), rng.choice(["a", "b", "b", "b", "É", "z", None]))
            for i in range(600)]
    return rows + [(0, None, "a"), (7, "x y", "a"), (7, "x y", "a"), (None, "p q r", "lone")]


def test_mixing(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.mix(df, carry=["source"]).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    want, taken, longest = targets(sizes), defaultdict(int), defaultdict(int)
    for r in got:
        s = r.row.source
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
        longest[s] = max(longest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(0.02 * want[s], min(longest[s], 50)), s
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted((str(r.doc_id), r.size, r.taken) for r in again) == sorted((str(r.doc_id), r.size, r.taken) for r in got)


def test_mixing_follows_the_inclusion_odds(spark):
    """Over many seeds a document is taken as often as its probability says."""
    rows = [(i, "w " * (2 if i % 2 else 32), "s" if i < 80 else "t") for i in range(160)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    share = defaultdict(list)
    for seed in range(3):
        for r in mixing.mix(df, weights=(1, 3), total=0.5, max_copies=1.0, seed=seed).collect():
            if r.doc_id < 80:
                share[r.doc_id % 2].append(r.copies)
    short, long_ = (sum(share[k]) / len(share[k]) for k in (1, 0))
    assert short > long_ > 0  # the shorter are likelier, the longer are not left out


def test_mixing_rows_and_empty(spark):
    df = spark.createDataFrame(mix_rows(), "doc_id long, text string, source string")
    out = mixing.mixed_documents(df.selectExpr("*", "1 as size", "2 as copies", "'r' as row"))
    assert out.columns == ["doc_id", "text", "source", "size", "copies", "row"]
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.where("text = ''")).where("taken <> 0").count() == 0


def test_mixing_plans_do_not_grow_with_the_passes(spark):
    """The driver holds a plan, its broadcasts and its code at a time: each pass starts from a table of the one before."""
    df = spark.createDataFrame(mix_rows(), "doc_id long, text string, source string")
    joins = [mixing.mix(df, fill=fill)._jdf.queryExecution().optimizedPlan().toString().count("Join ") for fill in (0, 3)]
    assert joins[0] == joins[1] <= 2


def test_mixing_when_a_source_has_no_document_left_that_fits(spark):
    """One source runs out of fitting documents in the first pass, another is taken whole, a third has no words."""
    rows = [(i, "w " * 40, "big") for i in range(5)] + [(9 + i, "w " * (1 + i), "many") for i in range(9)] + [(30, None, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, carry=["source"], total=0.9).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
    taken = {s: sum(r.taken for r in got if r.row.source == s) for s in ("big", "many", "none")}
    want = {r.row.source: r.target for r in got}
    assert abs(taken["big"] - want["big"]) <= 40 and abs(taken["many"] - want["many"]) <= 5 and taken["none"] == 0


ARC1 = (b"filedesc://old.arc 0.0.0.0 19970101000000 text/plain 76\n1 0 org\n"
        b"URL IP-address Archive-date Content-type Archive-length\n0123456789ab\n\n"
        b"http://a/ 1.2.3.4 19970102030405 text/html 42\nHTTP/1.0 200 OK\r\nContent-Type: x\r\n\r\n\n\n\xffab\n\n\n"
        b"dns:a 1.2.3.4 19970102030406 text/dns 5\nabcde\n")


def test_parse_arc_by_declared_lengths():
    body1 = b"1 0 org\n" + archives.V1_FIELDS.encode() + b"\n"
    body2 = b"2 0 org\n" + archives.V2_FIELDS.encode() + b"\n"
    page = b"HTTP/1.1 200 OK\r\nX-Page-Id: 9\r\n\r\nhttp://fake 1 2 3 4\n\xff\x00"
    one = b"filedesc://o.arc 0.0.0.0 19970101000000 text/plain %d\n%s\nhttp://a/ 1.2.3.4 1997 text/html %d\n%s\n" % (
        len(body1), body1, len(page), page)
    two = (b"filedesc://n.arc 0.0.0.0 19980101000000 text/plain 200 - - 0 n.arc %d\n%s\n"
           b"http://b/ 5.6.7.8 19980102030405 text/html 200 abc - 77 n.arc %d\n%s\n" % (len(body2), body2, len(page), page))
    records = list(archives.parse_arc(one + two))
    assert [r.url for r in records] == ["filedesc://o.arc", "http://a/", "filedesc://n.arc", "http://b/"]
    assert records[1].body == records[3].body == page
    with pytest.raises(ValueError):
        list(archives.parse_arc(two[:-5]))
    with pytest.raises(ValueError):
        list(archives.parse_arc(b"http://a/ text/html\n"))


def test_warc_record_fields():
    page = b"HTTP/1.1 200 OK\r\nX-Page-Id: 9\r\n\r\n\xff\x00body"
    rec = archives.ArcRecord("http://b/", "5.6.7.8", "19980102030405", "text/html", page)
    (fields, block), = archives.parse_warc(archives._warc(3, 4, rec, None) + b"\r\n\r\n")
    assert fields["warc-type"] == "response" and block == page
    assert fields["warc-date"] == "1998-01-02T03:04:05Z"
    assert fields["warc-record-id"] == archives.record_id(3, 4)
    same = {"file": 1, "record": 2, "date": "1998", "url": "http://c/"}
    (fields, block), = archives.parse_warc(archives._warc(3, 4, rec, same))
    assert fields["warc-type"] == "revisit" and block == b"HTTP/1.1 200 OK\r\nX-Page-Id: 9\r\n\r\n"
    assert fields["warc-refers-to"] == archives.record_id(1, 2)


def test_archive_round_trip(spark):
    import hashlib

    big = "é" * 600
    rows = [(1, "http://a b", big), (5, None, big), (5, "http://c", big), (None, "u", big), (7, "http://d", None),
            (8, "http://e", "é\r\n\r\nWARC/1.1\r\n\n"), (9, "", ""), (10, "http://f", "y" * 999), (11, "http://f", "y" * 999)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = archives.archive_round_trip(df).collect()
    assert sorted((r.page_id or 0, r.payload_bytes, r.payload_digest) for r in got) == sorted(
        (p or 0, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for p, _, h in rows)
    large = [r for r in got if r.payload_bytes >= 1000]
    assert sorted(r.record_type for r in large) == ["response"] + ["revisit"] * 3
    assert all(r.refers_to == (5 if r.record_type == "revisit" else None) for r in large)
    assert all(r.record_type == "response" and r.refers_to is None for r in got if r.payload_bytes < 1000)
    assert archives.archive_round_trip(df.limit(0)).count() == 0


def test_archives_with_long_pages_and_other_columns(spark):
    rows = [(k, f"http://h/{k}", "<p>" + "long text " * 200_000 if k < 3 else f"<p>{k}") for k in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    for name in ("file", "record", "digest", "size", "content", "value", "at"):
        df = df.withColumn(name, F.lit("clash"))
    got = {r.page_id: r for r in archives.archive_round_trip(df).collect()}
    assert {p: r.payload_bytes for p, r in got.items()} == {p: len(h) for p, _, h in rows}
    assert {p: r.refers_to for p, r in got.items()} == {0: 2, 1: 2, 2: None, 3: None, 4: None, 5: None}


def test_archives_take_part_in_no_join(spark, tmp_path):
    """Without broadcasts, too, the conversion reads archives once and shuffles none."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = []
    try:
        rows = [(k, "u", "same " * 300) for k in range(9)]
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
        archives.write_arc(df, f"{tmp_path}/arc")
        real = archives._files
        archives._files = lambda *a: plans.append(real(*a)) or plans[-1]
        archives.arc_to_warc(spark, f"{tmp_path}/arc", f"{tmp_path}/warc")
        got = archives.read_warc(spark, f"{tmp_path}/warc").collect()
    finally:
        archives._files = real
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 3  # index, conversion, reading back: each a scan that goes straight into its tasks
    assert sorted(r.record_type for r in got) == ["response"] + ["revisit"] * 8
    assert {r.refers_to for r in got} == {8, None}
