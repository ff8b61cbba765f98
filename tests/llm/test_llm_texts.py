"""Operators on texts against brute force, on the small table and on odd rows."""

import hashlib
import random

import pytest
from brute import Katz, exact, jaccard, repeats, words

from ledgerlens.llm import exact_dedup, jaccard_join, katz, queries, substring_dedup

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
LONG = " ".join(f"w{i % 7919}" for i in range(30_000))
BASE = " ".join(f"term{i}" for i in range(80))
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (4, "One two"), (5, "ONE TWO"), (6, "one twoÉ"),
       (None, "one two"), (7, LONG), (8, LONG + " tail"), (9, "A" + "x" * 63), (10, "a" + "x" * 63), (11, "a" + "x" * 64),
       (12, BASE), (13, BASE + " more"), (None, "intro " + BASE), (14, "x " * 40), (15, "x " * 41), (16, BASE), (12, "other")]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def cases(spark, table):
    return [table, ODD, []]


def clashing(df):
    """Further columns named like what the operators use inside."""
    from pyspark.sql import functions as F

    for c in ("row", "rest", "gid", "n", "k", "root", "size", "rank", "source", "score", "key", "id", "label"):
        df = df.withColumn(c, F.lit("x"))
    return df


def near(a, b):
    return abs(a - b) <= 1e-6 * max(1, abs(b))


def key(row):
    return tuple((x is not None, x) for x in row)


def test_exact_classes(spark, table):
    for rows in cases(spark, table):
        got = exact_dedup.exact_classes(clashing(frame(spark, rows))).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=key) == \
            sorted(exact(rows), key=key)
        kept = [(r.text_sha256, r.doc_id) for r in got if r.kept]
        assert len(kept) == len({h for h, _ in kept}) == len({r.text_sha256 for r in got})
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_narrow_digits(spark):
    rows = [(i, "ab" * (i % 7) + "c" * (i % 3)) for i in range(60)]
    got = exact_dedup.exact_classes(frame(spark, rows), digit=1, growth=1).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == sorted(exact(rows))


def test_drop_copies_keeps_columns(spark):
    df = clashing(frame(spark, ODD))
    out = exact_dedup.drop_copies(df)
    assert out.columns == df.columns
    assert out.count() == len({r[3] for r in exact(ODD)})


def test_jaccard_components(spark, table):
    for rows in cases(spark, table):
        got = jaccard_join.near_components(clashing(frame(spark, rows))).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(jaccard(rows), key=key)


def test_jaccard_chains_and_borders(spark):
    """Near copies in a chain, pairs just at the border, and a passage that many share."""
    rng, rows = random.Random(3), []
    for g in range(25):
        text = [f"g{g}w{i}" for i in range(rng.randint(6, 60))]
        for _ in range(rng.randint(1, 12)):
            rows.append((len(rows), " ".join(text)))
            text = text.copy()
            for _ in range(rng.randint(1, 2)):
                text[rng.randrange(len(text))] = f"n{rng.random()}"
            if rng.random() < 0.3:
                text += [f"t{rng.random()}"]
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [(1000 + i, f"{passage} " + " ".join(f"q{i}_{j}" for j in range(rng.randint(1, 30)))) for i in range(60)]
    got = jaccard_join.near_components(frame(spark, rows), bucket_bytes=4096).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(jaccard(rows))


def test_drop_near_copies(spark):
    df = clashing(frame(spark, ODD))
    out = jaccard_join.drop_near_copies(df)
    assert out.columns == df.columns
    sets = jaccard([(i, t) for i, (_, t) in enumerate(ODD)])  # two documents of different texts share an id
    assert out.count() == len({c for _, n, c in sets if n}) + sum(n == 0 for _, n, _ in sets)


def test_substring_removal(spark, table):
    for rows in cases(spark, table):
        got = substring_dedup.remove_repeats(clashing(frame(spark, rows)), bucket_bytes=1 << 16).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=key) == sorted(repeats(rows), key=key)


def test_substring_query_digest(spark, table):
    got = queries.op8_super_kmer_dedup(spark, SF).collect()
    want = {d: hashlib.sha256(t.encode()).hexdigest() for d, _, _, t in repeats(table)}
    assert {r.doc_id: r.kept_sha256 for r in got} == want


def test_super_kmers_cover_all_windows():
    import numpy as np
    import pyarrow as pa

    from ledgerlens.llm.substring_dedup import super_kmers
    from ledgerlens.llm.words import split_words, text_bytes

    texts = [BASE, "a b", "", "y " * 50, " ".join(random.Random(1).choices("abc", k=200))]
    w = split_words(*text_bytes(pa.array(texts)))
    first, last, _ = super_kmers(w, 13, 3)
    windows = np.concatenate([np.arange(a, z - 12) for a, z in zip(first, last)])
    want = [k for a, z in zip(w.first, w.first[1:]) for k in range(a, z - 12)]
    assert windows.tolist() == want


def test_katz_scores(spark, table):
    for rows in (table, ODD):
        got = sorted((tuple(r) for r in katz.katz_scores(clashing(frame(spark, rows)), bucket_bytes=1 << 16).collect()),
                     key=key)
        want = sorted(Katz(rows).scores(), key=key)
        assert [r[:5] for r in got] == [r[:5] for r in want]
        assert all(near(a, b) for r, s in zip(got, want) for a, b in zip(r[5:], s[5:]) if r[0] is not None)
    assert katz.katz_scores(frame(spark, [])).count() == 0


def test_katz_with_very_many_rows_in_a_batch(spark):
    """An Arrow batch of more rows than a chunk may number: every document keeps its own score."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "200000")
    try:
        df = spark.range(0, 70_000, 1, 1).selectExpr("id as doc_id", "if(id % 7 = 0, 'a b c', if(id % 7 = 1, '', 'a')) as text")
        got = {(r.doc_id % 7 if r.doc_id % 7 < 2 else 2): (r.n_tokens, round(r.base_score, 6), round(r.score, 6)) for r in katz.katz_scores(df).collect()}
        kinds = katz.katz_scores(df).selectExpr("least(doc_id % 7, 2) as kind", "n_tokens", "round(base_score, 6) as b", "round(score, 6) as s").distinct().collect()
    finally:
        spark.conf.set(key, old)
    assert len(kinds) == 3 and {r.kind: (r.n_tokens, r.b, r.s) for r in kinds} == got
    rows = [(i, "a b c" if i % 7 == 0 else "" if i % 7 == 1 else "a") for i in range(70_000)]
    want = {}
    for d, _, n, _, _, base, score in Katz(rows).scores():
        want[min(d % 7, 2)] = (n, base, score)
    for kind, (n, base, score) in got.items():
        assert n == want[kind][0] and base == pytest.approx(want[kind][1], rel=1e-5) and score == pytest.approx(want[kind][2], rel=1e-4)


def test_katz_is_normalised(table):
    model = Katz(table)
    for h in list(model.after)[:30] + ["never seen"]:
        total = sum(model.p(h, w) for w in model.uni) + model.alpha.get(h, 1.0) * model.unknown
        assert abs(total - 1) < 1e-9


def test_katz_beats_the_unigram(table):
    held = [s for s in Katz(table).scores() if s[1]]
    assert sum(s[6] for s in held) > sum(s[5] for s in held)


def test_word_splitter():
    import numpy as np
    import pyarrow as pa

    from ledgerlens.llm.words import split_words, text_bytes

    rng = random.Random(2)
    texts = ["".join(rng.choices(["a", "B", "é", " ", " ", "\t", "\n", "\x0b", "\x1c", "日"], k=rng.randint(0, 40)))
             for _ in range(500)] + ["", " ", "x"]
    for array in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["skip", *texts]).slice(1)):
        w = split_words(*text_bytes(array))
        found = [[bytes(w.data[a:z]).decode() for a, z in zip(w.start[i:j], w.end[i:j])]
                 for i, j in zip(w.first, w.first[1:])]
        assert found == [words(t) for t in texts]
        flat = [x for t in texts for x in words(t)]
        assert len(np.unique(w.hash)) == len(set(flat))
