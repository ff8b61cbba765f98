"""N-gram Jaccard join with several global token orders (operator 9).

Documents are sets of word shingles; two link when their Jaccard similarity is at
least ``percent`` / 100.

1. *Sets.*  Each document's distinct shingles are hashed to 64 bits.  Documents with
   equal sets are one class (equal 128-bit sums over the set and equal size) and
   take part once.
2. *Document frequencies.*  The hashes travel to buckets in compact runs; a bucket
   counts the classes of each shingle exactly and sends back the shingles that more
   than one class has.  The others can never be shared, yet come first in every
   order, so most documents have no prefix left and leave here.
3. *Prefixes.*  A pair that links must share a shingle among the first
   n - ceil(t n) + 1 of both sets, under any global order.  The index holds the
   prefixes under the rarest-first order.
4. *Pivots.*  In each posting list the class whose shingles are the most frequent
   ones is the pivot, which in a group of near copies is the text they were made
   from or one close to it; a class proposes the pivot that most of its lists name.
   Verified proposals join classes into components.  The next rounds take the
   second and third in each list.  A group of thousands of near copies so needs
   about one comparison per copy, not one per pair.
5. *The rest exactly.*  All pairs that share an index entry but lie in different
   components become candidates (pairs inside one component could not change it).
   Both of an index entry's places must allow the pair's own overlap, which the two
   sizes give: near copies with more changes than that meet nobody.
6. *Verification.*  Both sets meet; their prefixes must intersect under two further
   orders (by two hashes of the shingles), then the overlap is counted exactly.

No list is capped and no pair between different components is left out, so the
components are those of all links.

Defined cases: a null or wordless text has an empty set and links with nothing;
fewer words than a shingle make one shingle of all of them; a null id counts as
above every other; repeated rows are equal sets; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .components import components
from .storage import release, remove_table, save
from .text import whole
from .words import batches_of, grams, mix64, split_words, text_bytes

_U = np.uint64
_DOCS = [("kind", pa.int8()), ("bucket", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int32()), ("k", pa.int64()),
         ("k2", pa.int64()), ("h", pa.int64()), ("tokens", pa.binary()), ("owners", pa.binary())]
_DOCS_SQL = "kind byte, bucket int, doc_id long, n int, k long, k2 long, h long, tokens binary, owners binary"
_CLASS = np.dtype([("k", "<i8"), ("n", "<i4"), ("here", "<i4")])
_PAIR = "a long, b long"


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    words = split_words(*text_bytes(column), lower=True)
    all_grams, out = grams(words.hash, n), []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(all_grams[a:b - n + 1]))
        else:
            out.append(grams(words.hash[a:b], b - a, seed=2) if b > a else np.empty(0, _U))
    return out


def prefix_length(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """First shingles of a set of n of which a linked set must share one."""
    return n - (n * percent + 99) // 100 + 1


def _shingle(n_words: int, buckets: int, flush: int = 3_000_000):
    """Documents to class rows (kind 0) and runs of shingles by bucket (kind 1)."""
    def runs(held: dict) -> pa.RecordBatch:
        keys = np.fromiter(held.keys(), np.int64, len(held))
        sizes = np.array([len(s) for s in held.values()], np.int64)
        tokens = np.concatenate(list(held.values()))
        owner = np.repeat(np.arange(len(keys)), sizes)
        bucket = ((tokens >> _U(40)) % _U(buckets)).astype(np.int32)
        order = np.argsort(bucket.astype(np.uint16) if buckets < 2 ** 16 else bucket, kind="stable")
        tokens, owner, bucket = tokens[order], owner[order], bucket[order]
        cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        rows = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            who, here = np.unique(owner[a:b], return_counts=True)
            table = np.empty(len(who), _CLASS)
            table["k"], table["n"], table["here"] = keys[who], sizes[who], here
            rows.append((1, int(bucket[a]), None, None, None, None, None, tokens[a:b].tobytes(), table.tobytes()))
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for b in batches_of(batches, 1):
            rows = []
            for doc, h, s in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), shingle_sets(b.column(1), n_words)):
                k, k2 = (int(np.add.reduce(mix64(s ^ _U(seed))).view(np.int64)) for seed in (0x51, 0xA7))
                # documents' own rows only pass through the bucket stage: dealt by id, as a class may have very many
                rows.append((0, (h if doc is None else doc) % buckets, doc, len(s), k, k2, h, None, None))
                if len(s) and k not in held:
                    held[k] = s
                    size += len(s)
            yield _batch(rows)
            if size > flush:
                yield runs(held)
                held, size = {}, 0
        if held:
            yield runs(held)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(_DOCS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _DOCS)], [n for n, _ in _DOCS])


def _frequencies(buckets: int):
    """One bucket: class rows as they are, and for each class its shingles that another class has too."""
    return lambda table: _shared(table, buckets)


def _shared(table: pa.Table, buckets: int) -> pa.Table:
    kinds = table.column("kind").to_numpy()
    docs = table.filter(pa.array(kinds == 0))
    rest = table.filter(pa.array(kinds == 1))
    if not rest.num_rows:
        return docs
    tokens = np.concatenate([np.frombuffer(x.as_buffer(), _U) for x in rest.column("tokens")])
    owners = np.concatenate([np.frombuffer(x.as_buffer(), _CLASS) for x in rest.column("owners")])
    who = np.repeat(np.arange(len(owners), dtype=np.int32), owners["here"])
    order = np.argsort(tokens)
    tokens, who = tokens[order], who[order]
    same = tokens[1:] == tokens[:-1]
    shared = np.zeros(len(tokens), bool)
    shared[1:] = same
    shared[:-1] |= same
    tokens, who = tokens[shared], who[shared]
    key = owners["k"][who]
    order = np.lexsort((key, tokens))
    tokens, key, who = tokens[order], key[order], who[order]
    if len(tokens):  # runs of different tasks may hold the same class
        first = np.append(True, (tokens[1:] != tokens[:-1]) | (key[1:] != key[:-1]))
        tokens, key, who = tokens[first], key[first], who[first]
        start = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        df = np.repeat(np.diff(np.append(start, len(tokens))), np.diff(np.append(start, len(tokens))))
        tokens, key, who, df = (x[df > 1] for x in (tokens, key, who, df))
    if not len(tokens):
        return docs
    # back to the classes, in one run for each bucket of classes
    order = np.lexsort((key, home(key, buckets)))
    tokens, key, who, df = tokens[order], key[order], who[order], df[order].astype("<i4")
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    classes = np.empty(len(start), _CLASS)
    classes["k"], classes["n"], classes["here"] = key[start], owners["n"][who[start]], np.diff(np.append(start, len(key)))
    at = home(classes["k"], buckets)
    cuts = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(at))
    first = np.append(start, len(key))
    rows = [(2, int(at[a]), None, None, None, None, None,
             tokens[first[a]:first[z]].tobytes() + df[first[a]:first[z]].tobytes(), classes[a:z].tobytes())
            for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    return pa.concat_tables([docs, pa.Table.from_batches([_batch(rows)]).cast(docs.schema)])


def home(k: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a class."""
    return (k >> 8) % buckets


def _prefixes(percent: int):
    """One bucket of classes with their shared shingles: those that can link, their sets and index entries."""
    def run(table: pa.Table) -> pa.Table:
        classes = np.concatenate([np.frombuffer(x.as_buffer(), _CLASS) for x in table.column("owners")])
        runs = [x.as_buffer() for x in table.column("tokens")]  # 8 bytes of each token, then 4 of each frequency
        tokens = np.concatenate([np.frombuffer(x, _U, x.size // 12) for x in runs])
        df = np.concatenate([np.frombuffer(x, "<i4", x.size // 12, x.size // 12 * 8) for x in runs])
        here = classes["here"].astype(np.int64)
        first = np.cumsum(here) - here
        order = np.argsort(classes["k"], kind="stable")
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(classes["k"][order]) != 0)), len(order))
        rows = []
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = order[a:z]
            n, m = int(classes["n"][own[0]]), int(here[own].sum())
            room = prefix_length(n, percent) - (n - m)
            if room <= 0:
                continue
            at = np.concatenate([np.arange(first[i], first[i] + here[i]) for i in own])
            t, f = tokens[at], df[at]
            prefix = t[np.lexsort((t, f))[:room]]
            rows.append((int(classes["k"][own[0]]), n, np.sort(t).tobytes(), prefix.view(np.int64).tolist(), f.sum() / n, n - m))
        cols = list(zip(*rows)) or [[]] * 6
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.float64(), pa.int32())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                    ["k", "n", "tokens", "prefix", "weight", "first"])

    return run


def _linked(percent: int):
    """Pairs with both sets: those that pass the further orders and then the exact count."""
    def prefix(tokens: np.ndarray, n: int, seed: int) -> np.ndarray:
        room = prefix_length(n, percent) - (n - len(tokens))
        order = np.argsort(mix64(tokens ^ _U(seed)))[:room]
        return tokens[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for a, c, n, m, x, y in zip(*(b.column(i) for i in range(6))):
                n, m = n.as_py(), m.as_py()
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                if not all(len(np.intersect1d(prefix(x, n, s), prefix(y, m, s), True)) for s in (0x1F, 0x2E)):
                    continue
                common = len(np.intersect1d(x, y, True))
                if 100 * common >= percent * (n + m - common):
                    rows.append((a.as_py(), c.as_py()))
            cols = list(zip(*rows)) or [[]] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])

    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("k").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("k").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "ta", "tb")
    return met.mapInArrow(_linked(percent), _PAIR)


def _may_link(percent: int):
    """Of two index entries of one shingle: whether it can be the first that a linked pair shares.

    Sets of n and m shingles link only with an overlap o >= percent (n + m) / (100 + percent);
    the first common shingle then stands among the first n - o + 1 and m - o + 1."""
    o = F.ceil(F.lit(percent) * (F.col("n") + F.col("other_n")) / F.lit(100 + percent) - F.lit(1e-9))
    return (F.col("at") <= F.col("n") - o) & (F.col("other_at") <= F.col("other_n") - o)


def class_components(docs: DataFrame, *, n_words: int = 5, percent: int = 75, id_col: str = "doc_id",
                     text_col: str = "text", bucket_bytes: int = 16 << 20, pivot_rounds: int = 3) -> DataFrame:
    """A written table (doc_id, n, k, k2, h, root): each document's set size, class, text hash and component."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"),
                        F.xxhash64(whole(F.col(text_col))).alias("h"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + total // bucket_bytes
    table = save(texts.mapInArrow(_shingle(n_words, buckets), _DOCS_SQL)
                 .groupBy("bucket").applyInArrow(_frequencies(buckets), _DOCS_SQL), "shingles")
    sets = save(table.where("kind = 2").select("bucket", "tokens", "owners").groupBy("bucket")
                .applyInArrow(_prefixes(percent), "k long, n int, tokens binary, prefix array<long>, weight double, first int"), "sets")
    index = save(sets.select("k", "n", "weight", "first", F.posexplode("prefix").alias("i", "t"))
                 .select("k", "n", "weight", "t", (F.col("first") + F.col("i")).alias("at")), "index")
    roots, done = None, [table, sets, index]

    def at_roots(rows: DataFrame) -> DataFrame:
        if roots is None:
            return rows.withColumn("root", F.col("k"))
        r = roots.select(F.col("node").alias("k"), "root")
        return rows.join(r, "k", "left").withColumn("root", F.coalesce("root", "k"))

    def joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
        """The roots with more links: a component so far takes part as the star of its root."""
        return components(links if roots is None else links.unionByName(
            roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    tried = None
    central = W.partitionBy("t").orderBy(F.col("weight").desc(), "k")
    for turn in range(1, pivot_rounds + 1):
        rows = at_roots(index)
        pivot = (index.select("t", "k", "n", "at", "weight", F.row_number().over(central).alias("place"))
                 .where(F.col("place") <= turn).where(F.col("place") == turn))
        pivot = at_roots(pivot).select("t", F.col("root").alias("other_root"), F.col("k").alias("other"),
                                       F.col("n").alias("other_n"), F.col("at").alias("other_at"))
        named = (rows.join(pivot, "t").where((F.col("root") != F.col("other_root")) & _may_link(percent))
                 .groupBy("k", "other").count())
        if tried is not None:
            named = named.join(tried, ["k", "other"], "left_anti")
        best = named.groupBy("k").agg(F.max(F.struct("count", "other")).alias("x"))
        pairs = save(best.select(F.col("k").alias("a"), F.col("x.other").alias("b")), "proposals")
        if pairs.isEmpty():
            break
        again = pairs.select(F.col("a").alias("k"), F.col("b").alias("other"))
        tried = again if tried is None else tried.unionByName(again)
        found = save(_verify(pairs, sets, percent), "links")
        done += [pairs, found]
        roots = joined(roots, found)
        done.append(roots)
    # every pair that shares an index entry and lies in different components
    rows = save(at_roots(index), "rooted")
    mixed = rows.groupBy("t").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("t")
    left = rows.join(mixed, "t", "left_semi")
    right = left.select("t", F.col("k").alias("other"), F.col("n").alias("other_n"), F.col("at").alias("other_at"),
                        F.col("root").alias("other_root"))
    pairs = (left.join(right, "t").where((F.col("root") < F.col("other_root")) & _may_link(percent))
             .select(F.col("k").alias("a"), F.col("other").alias("b")).distinct())
    if tried is not None:
        both = tried.select(F.least("k", "other").alias("x"), F.greatest("k", "other").alias("y"))
        pairs = pairs.join(both, (F.least("a", "b") == both.x) & (F.greatest("a", "b") == both.y), "left_anti")
    candidates = save(pairs, "candidates")
    last = save(_verify(candidates, sets, percent), "links")
    done += [rows, candidates, last]
    if not last.isEmpty():
        roots = joined(roots, last)
        done.append(roots)
    docs_rows = table.where("kind = 0").select("doc_id", "n", "k", "k2", "h")
    out = save(at_roots(docs_rows), "documents-rooted")
    for finished in done:  # the result reads nothing but its own table
        remove_table(finished)
    release(docs.sparkSession)
    return out


def near_components(docs: DataFrame, **kwargs) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id, component_id (least ids of its class and component)."""
    rows = class_components(docs, **kwargs)
    full = rows.where("n > 0")
    by_class = full.groupBy("root", "k", "k2", "n").agg(F.min("doc_id").alias("class_id"))
    by_root = by_class.groupBy("root").agg(F.min("class_id").alias("component_id"))
    named = by_class.join(by_root, "root").drop("root")
    out = full.join(named, ["k", "k2", "n"]).select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                                                    "class_id", "component_id")
    empty = rows.where("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"),
                                       F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    return out.unionByName(empty)


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kwargs) -> DataFrame:
    """Of each component one row stays, one of the least id; documents without words all stay."""
    rows = class_components(docs, id_col=id_col, text_col=text_col, **kwargs)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    least = rows.where("n > 0").groupBy("root").agg(F.min(row).alias("r"))
    same = rows.where("n > 0").groupBy("doc_id", "h").agg(F.count("*").alias("rows"))
    stay = (least.join(same, F.col("r.doc_id").eqNullSafe(same.doc_id) & (F.col("r.h") == same.h))
            .select(F.col("r.doc_id").alias("stay_id"), F.col("r.h").alias("stay_h"), "rows"))
    empty = rows.where("n = 0").select(F.col("doc_id").alias("stay_id"), F.col("h").alias("stay_h"),
                                       F.lit(1).cast("long").alias("rows")).distinct()
    both = stay.unionByName(empty)
    own = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("own_id"),
                      F.xxhash64(whole(F.col(text_col))).alias("own_h"))
    kept = own.join(both, own.own_id.eqNullSafe(both.stay_id) & (own.own_h == both.stay_h))
    once = kept.where("rows = 1").select("row.*")
    return once.unionByName(kept.where("rows > 1").dropDuplicates(["own_id", "own_h"]).select("row.*"))
