"""DuckDB SQL of the queries that SQL can express."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_WORD = r"[^\x20\x09-\x0D]+"
#: least node reachable over ``edges`` (a, b), which holds both directions
_REACH = "reach(a, root) AS (SELECT a, a FROM edges UNION SELECT e.b, r.root FROM reach r JOIN edges e ON e.a = r.a)"



def _lloyd(k: int = 16, rounds: int = 3) -> str:
    """Lloyd rounds unrolled; a centroid is a row per component."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        near{r} AS (SELECT r, c, d FROM (
            SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place FROM (
                SELECT x.r, y.c, sum((x.x - y.x) * (x.x - y.x))::BIGINT AS d FROM x JOIN c{r} y ON y.j = x.j GROUP BY x.r, y.c))
            WHERE place = 1)""")
        if r < rounds:
            steps.append(f"""
        c{r + 1} AS (SELECT o.c, o.j, coalesce(m.x, o.x) AS x FROM c{r} o LEFT JOIN (
            SELECT n.c, x.j, ((sum(x.x) - ((sum(x.x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
            FROM near{r} n JOIN x ON x.r = n.r GROUP BY n.c, x.j) m ON m.c = o.c AND m.j = o.j)""")
    return f"""
        WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, row_number() OVER () AS r FROM embeddings
                   WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
        x AS (SELECT r, generate_subscripts(e, 1) AS j, floor(64 * unnest(e))::BIGINT AS x FROM v),
        first AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, e) - 1 AS c FROM v
                  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, e) <= {k}),
        c0 AS (SELECT c, j, x FROM first JOIN x USING (r)),{",".join(steps)},
        sums AS (SELECT c, sum(d)::BIGINT AS i FROM near{rounds} GROUP BY c),
        digest AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS h FROM c{rounds} GROUP BY c)
        SELECT vec_id, n.c::INTEGER AS cluster, n.d AS distance, sums.i AS cluster_inertia,
               (SELECT sum(i)::BIGINT FROM sums) AS inertia, h AS centroid_sha256
        FROM near{rounds} n JOIN v USING (r) JOIN sums ON sums.c = n.c JOIN digest ON digest.c = n.c"""


ORACLE = {
    "op7_pq_near_dedup": f"""
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda e: e IS NULL)) = 0
              AND len(list_filter(embedding, lambda e: NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
        edges AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q
                  ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
                  WHERE list_cosine_similarity(p.x, q.x) >= 0.98),
        {_REACH},
        roots AS (SELECT a, min(root) AS root FROM reach GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
        SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(r.root, e.vec_id) AS component_id,
               e.vec_id = coalesce(r.root, e.vec_id) AS kept
        FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN roots r ON r.a = e.vec_id""",
    "op8_super_kmer_dedup": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
        win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
        low AS (SELECT s, min(doc_id) AS least FROM win GROUP BY s),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM win JOIN low USING (s) WHERE least < doc_id),
        words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS s, count(*) AS n
                 FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op9_ngram_jaccard_join": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS w
            FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
              FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        common AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c
                   FROM s p JOIN s q ON p.s = q.s AND p.doc_id <> q.doc_id GROUP BY 1, 2),
        edges AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
                  WHERE 100 * c >= 75 * (x.n + y.n - c)),
        {_REACH},
        roots AS (SELECT a, min(root) AS root FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id
        FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN roots ON a = d.doc_id""",
    "op3_arc_to_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                          sha1(coalesce(html, '')) AS payload_digest FROM pages),
             r AS (SELECT *, payload_bytes >= 1000 AND page_id < max(page_id) OVER (
                              PARTITION BY payload_digest, payload_bytes) AS again,
                          max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM p)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN last END AS refers_to
        FROM r""",
    "op10_exact_dedup": f"""
        WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS k FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY k) AS keep_id, count(*) OVER (PARTITION BY k) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY k) AS kept, sha256(k) AS text_sha256
        FROM d""",
    "op12_threshold_negatives": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda y: floor(256 * y::DOUBLE)) AS x, vec_id % 100 = 0 AS asks FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
        s AS (SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS alike,
                     coalesce(list_inner_product(a.x, b.x), 0)::BIGINT AS score
              FROM v a JOIN v b ON a.asks AND a.r <> b.r AND len(a.x) = len(b.x)),
        p AS (SELECT a, anchor_id, b, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
              QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST) <= 5),
        n AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
                     row_number() OVER (PARTITION BY a, p.b ORDER BY score DESC, vec_id NULLS LAST) AS rank
              FROM p JOIN s USING (a, anchor_id)
              WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
        FROM n WHERE rank <= 10""",
    "op13_sharded_lloyd": _lloyd(),
}
