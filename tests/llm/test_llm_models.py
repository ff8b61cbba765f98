"""The toxicity network, the vector index and the pipeline."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import fold, vectors

from ledgerlens.llm import queries, tokens, toxicity, vector_dedup
from ledgerlens.llm.components import components

SF = "/root/testdata/sf0.001"


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    texts = ["you are an idiot, truly", "one two three " * 40, "", "a quiet day"]
    b = toxicity.batch_of(pa.array(texts))
    vocabulary = np.sort(b.hashes)[::2].copy()
    p = {k: v.astype(np.float64) for k, v in toxicity.new_params(len(vocabulary), np.zeros(len(vocabulary))).items()}
    p["query"] += rng.standard_normal(len(p["query"])) * 0.3
    label, weight = np.array([1, 0, 0, 1, 0], float)[:len(b.index)], np.ones(len(b.index))
    label = np.resize(label, len(b.index))
    hide = np.zeros(len(b.hashes), bool)
    _, g = toxicity.gradients(p, vocabulary, b, b.index, label, weight, hide)
    for name in ("out", "bias", "query", "re_f", "re_b", "in_f", "in_bias_b", "words", "chars", "opens"):
        flat, grad = p[name].reshape(-1), g[name].reshape(-1)
        for i in np.argsort(-np.abs(grad))[:3]:
            old, loss = flat[i], []
            for step in (1e-2, -1e-2):
                flat[i] = old + step
                loss.append(toxicity.gradients(p, vocabulary, b, b.index, label, weight, hide)[0])
            flat[i] = old
            assert grad[i] == pytest.approx((loss[0] - loss[1]) / 2e-2, rel=0.08, abs=2e-4), name


def test_windows_cover_the_text():
    n = 301
    b = toxicity.batch_of(pa.array([" ".join(f"w{i}" for i in range(n)), "", "one"]))
    assert set(b.doc.tolist()) == {0, 1, 2}
    own = b.index[b.doc == 0]
    assert len(own) > n / toxicity.WINDOW and len(np.unique(own)) == n and (own < len(b.hashes)).all()
    assert (b.index[b.doc == 1] == len(b.hashes)).all()


def test_held_out_accuracy(spark):
    """Planted insults are found in documents that training never saw."""
    rng = random.Random(8)
    bad = ["snark", "grumbler", "vilest"]
    rows, labels = [], []
    for i in range(700):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randint(5, 250))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "!", "s"]))
        rows.append((i, " ".join(w), "x"))
        labels.append((i, int(toxic)))
    rows += [(1000, None, "x"), (None, "", "x"), (1, rows[1][1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    lab = spark.createDataFrame(labels + [(5000, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_documents(df, lab, steps=250).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == fold(r.doc_id, 3) for r in got)
    truth = dict(labels)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert sum(t == p for t, p in held) >= 0.95 * len(held)
    kept = toxicity.drop_toxic(df, lab, steps=250)
    assert kept.columns == df.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_dropped_documents_send_their_text_once(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, None), (None, "", "z")], "doc_id long, text string, score string")
    lab, seen, score = spark.createDataFrame([], "doc_id long, toxic int"), [], toxicity.score_texts
    monkeypatch.setattr(toxicity, "score_texts", lambda frame, *a, **b: seen.append(frame.schema.simpleString()) or score(frame, *a, **b))
    got = toxicity.drop_toxic(df, lab)
    assert got.dtypes == df.dtypes and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    assert seen[0].count("text:") == 1


def test_tasks_without_a_tokenizer_free_the_workers_encoders(monkeypatch):
    monkeypatch.setattr(tokens, "_ENCODERS", {"file": object()})
    assert list(toxicity._pick(None)(iter([]))) == [] and not tokens._ENCODERS


def test_few_texts_wait_for_spark_once(spark, monkeypatch):
    """Many short rounds do not each wait until Spark has deleted what it no longer needs."""
    rows = spark.createDataFrame([(i, f"w{i % 7} bad" if i % 3 == 0 else f"w{i % 7} day") for i in range(30)], "doc_id long, text string")
    calls = []
    monkeypatch.setattr(toxicity, "release", lambda s: calls.append(s))
    toxicity.trained(rows, rows.selectExpr("doc_id", "int(text like '%bad') as toxic"), steps=40, batch=8)
    assert len(calls) == 1


def test_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_documents(df, lab).collect()} == {0.5}
    assert toxicity.score_documents(df.limit(0), lab).count() == 0


def test_sample_is_filled(spark):
    """As many labelled documents are learnt from as the sample may hold, a third of them toxic."""
    rows = spark.range(24_000).selectExpr("id as doc_id", "concat('w', id) as text", "int(id % 3 = 0) as toxic")
    got = toxicity.training_sample(rows.select("doc_id", "text"), rows.select("doc_id", "toxic")).groupBy("toxic").count()
    assert {r["toxic"]: r["count"] for r in got.collect()} == {True: 2000, False: 4000}


def long_texts(spark):
    """Documents of 11,000 characters and more, the toxic ones with their insults at the end."""
    rng = random.Random(3)
    rows = []
    for i in range(90):
        w = [f"w{rng.randrange(300)}" * 8 for _ in range(rng.randint(440, 480))]
        rows.append((i, " ".join(w + ["snark", "grumbler"] * (3 if i % 3 == 0 else 0)), int(i % 3 == 0)))
    assert all(len(t.split("snark")[0]) > 11_000 for _, t, _ in rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(3)
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_learns_from_the_end_of_long_texts(spark):
    vocabulary, p = toxicity.trained(*long_texts(spark), steps=150)
    words = " ".join(f"w{i}" * 8 for i in range(1, 200))
    probe = spark.createDataFrame([(1, words + " snark grumbler" * 3), (2, words)], "id long, text string")
    score = {r.id: r.score for r in toxicity.score_texts(probe, vocabulary, p).collect()}
    assert score[1] > 0.7 > 0.3 > score[2]


def train(texts, labels, times, steps):
    """The plain version: all windows of all texts at hand, in one process."""
    b = toxicity.batch_of(pa.array(texts))
    have, bad = toxicity.count_words(b, labels, times)
    by = np.argsort(b.hashes)
    by = by[have[by] >= 3]
    n_bad = (labels * times).sum()
    state = toxicity.first_state(b.hashes[by], have[by], bad[by], n_bad, times.sum() - n_bad)
    while state["step"] < steps:
        w = toxicity.merged(toxicity.worst_windows(state, b))
        w = w._replace(index=np.repeat(w.index, times, axis=0), doc=np.repeat(w.doc, times))
        toxicity.learn(state, w, np.repeat(labels, times), steps=steps)
    return state


def test_windows_of_tasks_train_the_same_network(spark):
    """One window a document, sent by tasks round by round, gives what training on the whole texts at hand gives."""
    docs, labels = long_texts(spark)
    docs = docs.unionByName(docs.where("doc_id = 9")).unionByName(spark.createDataFrame([(9, None), (12, "中" * 5000)], docs.schema))
    few = toxicity.training_sample(docs, labels).orderBy("place").collect()
    want = train([r.text for r in few], np.array([float(r.toxic) for r in few]), np.array([r.times for r in few]), 9)
    words, p = toxicity.trained(docs, labels, steps=9)
    assert words.tolist() == want["vocabulary"].tolist() and len(words) > 290
    assert all(np.allclose(p[k], want["p"][k], atol=1e-4) for k in p)


def test_forward_pass_word_by_word():
    """The network's score of whole texts against loops over words, gates and windows."""
    rng = np.random.default_rng(7)
    texts = ["you idiot, you!", "", "one " * 70 + "two", "Some quiet words about nothing at all"]
    b = toxicity.batch_of(pa.array(texts))
    p = {k: v.astype(np.float64) for k, v in toxicity.new_params(4, np.zeros(4)).items()}
    p["query"] += rng.standard_normal(len(p["query"]))
    vocabulary = np.sort(b.hashes)[:4].copy()
    x, _ = toxicity._vectors(p, vocabulary, b)
    got = toxicity.logits(p, toxicity.project(p, x), b.index, len(b.hashes))
    sigmoid, h = (lambda v: 1 / (1 + np.exp(-v))), toxicity.HIDDEN

    def vector(k):
        at = np.flatnonzero(vocabulary == b.hashes[k])
        word = p["words"][at[0] + 1 if len(at) else 0]
        rows = range(b.cuts[k], b.cuts[k + 1])
        return np.concatenate([word, sum(p["chars"][b.grams[r]] * b.share[r] for r in rows), np.mean([p["opens"][o] for o in b.opens[k]], axis=0)])

    for i, window in enumerate(b.index):
        read = [vector(k) for k in window if k < len(b.hashes)]
        states = []
        for d, order in (("f", read), ("b", read[::-1])):
            s, own = np.zeros(h), []
            for v in order:
                a, g = v @ p[f"in_{d}"] + p[f"in_bias_{d}"], s @ p[f"re_{d}"]
                z, r = sigmoid(a[:h] + g[:h]), sigmoid(a[h:2 * h] + g[h:2 * h])
                s = (1 - z) * np.tanh(a[2 * h:] + r * g[2 * h:]) + z * s
                own.append(s)
            states.append(own if d == "f" else own[::-1])
        both = [np.concatenate(pair) for pair in zip(*states)]
        weight = np.array([np.exp(np.clip(s @ p["query"], -30, 30)) for s in both])
        pooled = sum(w * s for w, s in zip(weight, both)) / weight.sum() if both else np.zeros(2 * h)
        assert got[i] == pytest.approx(pooled @ p["out"] + p["bias"][0], abs=1e-5)


def vector_rows():
    rng = np.random.default_rng(0)
    base = rng.standard_normal((30, 16))
    rows = []
    for i in range(350):
        v = base[rng.integers(30)] + rng.standard_normal(16) * rng.choice([0, 0.02, 0.1, 0.2, 0.3])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(2))))
    odd = [(1000, None, 1), (1001, [], 1), (1002, [0.0] * 16, 1), (1003, [1.0, None] + [0.0] * 14, 1),
           (1004, [float("nan")] + [1.0] * 15, 1), (1005, [float("inf")] + [1.0] * 15, 1), (1006, [1.0, 2.0], 1),
           (1007, [2.0, 4.0], 1), (1008, [2.0, 4.0], None), (1009, [2.0, 4.0], 1)]
    return rows + odd + [rows[0], (None, rows[1][1], rows[1][2])]


@pytest.mark.parametrize("tile", [4096, 16])
def test_vector_components(spark, monkeypatch, tile):
    monkeypatch.setattr(vector_dedup, "_TILE", tile)
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = vector_dedup.vector_components(df.selectExpr("*", "1 as c", "'v' as v", "2 as root")).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    want = vectors(rows, 0.98)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == sorted(want, key=key)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert vector_dedup.vector_components(df.limit(0)).count() == 0


def test_index_bounds():
    """No vector within the radius of a query is lost by the probes or by the coded distance."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 24))
    x = np.vstack([x, x[:100] + rng.standard_normal((100, 24)) * 0.03])
    x /= np.linalg.norm(x, axis=1)[:, None]
    index, radius = vector_dedup.Index(x[:300], 32), 0.2
    own, code, error = index.encode(x)
    probes = index.probes(x, own, radius)
    near = ((x[:, None] - x[None]) ** 2).sum(axis=2) <= radius ** 2
    assert near.sum() > len(x)
    for a, b in zip(*np.nonzero(near)):
        assert probes[a, own[b]]
        assert index.lookup(x[a:a + 1], own[b], code[b:b + 1])[0, 0] <= (radius + error[b] + 1e-6) ** 2


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [
        (rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    up = {}

    def find(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}


def test_components_of_more_edges_than_one_task_takes(spark, monkeypatch):
    from ledgerlens.llm import components as module, storage

    monkeypatch.setattr(module, "PART_ROWS", 20)
    monkeypatch.setattr(storage, "PART_ROWS", 20)
    test_components(spark)


def test_components_leave_the_driver_few_files_and_rounds(spark, monkeypatch):
    """One file for a small table, whatever the number of shuffle partitions; stars take no round."""
    from ledgerlens.llm import components as module
    from ledgerlens.llm.storage import save

    seen = []
    monkeypatch.setattr(module, "release", lambda s: None)
    monkeypatch.setattr(module, "save", lambda df, name, **k: (out := save(df, name, **k), seen.append((name, len(out.inputFiles()))))[0])
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chain = components(spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long"))
        assert {r.root for r in chain.collect()} == {0} and chain.count() == 31
        assert seen[-1] == ("roots", 1) and all(n == 1 for name, n in seen if name != "edges")
        seen.clear()
        stars = components(spark.createDataFrame([(i, i % 3) for i in range(3, 40)], "a long, b long"))
        assert {(r.node, r.root) for r in stars.collect()} == {(i, i % 3) for i in range(40)}
        assert [name for name, _ in seen] == ["edges", "roots"]
        assert components(spark.createDataFrame([(4, 4)], "a long, b long")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_pipeline(spark):
    """Each stage's result follows from its own input by the operators' brute-force rules."""
    import corpus_pipeline
    from brute import exact, jaccard, targets, words

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        seen[name] = (docs, out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            path = queries_path(spark, name)
            out.write.parquet(path)
            docs = spark.read.parquet(path)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "mixing",
                                                      "best_fit_packing"]
    before, after = seen["toxicity"]
    assert after.count() <= before.count() and after.join(before, before.columns, "left_anti").count() == 0

    before, after = seen["exact_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert {r.doc_id for r in after.collect()} == {keep for _, keep, _, _ in exact(rows)}

    before, after = seen["ngram_jaccard_join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert {r.doc_id for r in after.collect()} == {c if n else d for d, n, c in jaccard(rows)}

    before, after = seen["mixing"]
    sizes, taken = {}, {}
    for df, into in ((before, sizes), (after, taken)):
        for r in df.collect():
            into[r.source] = into.get(r.source, 0) + len(words(r.text))
    want = targets(sizes)
    assert all(abs(taken.get(s, 0) - t) <= max(0.1 * t, 2000) for s, t in want.items())
    assert after.groupBy(*after.columns).count().where("count > 2").count() == 0

    before, after = seen["best_fit_packing"]
    assert after.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
    assert after.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0


def queries_path(spark, name):
    from ledgerlens.llm.storage import new_path

    return new_path(spark, f"test-{name}")


def test_registered_queries():
    import __spark_entry__ as E

    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()
    assert set(queries.QUERIES) == set(names)
