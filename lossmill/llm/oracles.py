"""SQL for the corpus queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES = f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents
), sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
    END AS shingles FROM texts
), single AS (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM sets
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
FROM sets s JOIN reach r ON r.a = s.doc_id
GROUP BY s.doc_id, s.shingles
"""

#: The same links at another threshold.
SET_JOIN = NEAR_DUPLICATES.replace("85 *", "90 *").replace(", s.doc_id = min(r.b) AS kept", "")

REPEATED_WORDS = f"""
WITH texts AS (
    SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), places AS MATERIALIZED (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS passage
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM texts)
), ranked AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) AS turn FROM places
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM ranked WHERE turn > 1
), each_word AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM texts
), kept AS (
    SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.place) AS text, count(*) AS n
    FROM each_word e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.place = g.place
    GROUP BY e.doc_id
)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(len(t.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""

REPEATED_BYTES = """
WITH texts AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), places AS MATERIALIZED (
    SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS k
    FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 199)) AS i FROM texts)
), again AS MATERIALIZED (
    SELECT k FROM places GROUP BY k HAVING count(*) > 1
), starts AS (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM places SEMI JOIN again USING (k)
), numbered AS (
    SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY i) AS span
    FROM starts
), spans AS (
    SELECT doc_id, span, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY doc_id, span
), pieces AS (
    SELECT s.doc_id, s.a, substr(t.h, 2 * coalesce(lag(s.b) OVER (PARTITION BY s.doc_id ORDER BY s.a), 0) + 1,
        2 * (s.a - coalesce(lag(s.b) OVER (PARTITION BY s.doc_id ORDER BY s.a), 0))) AS piece
    FROM spans s JOIN texts t ON s.doc_id = t.doc_id
), summed AS (
    SELECT doc_id, sum(b - a) AS removed, count(*) AS n, max(b) AS last FROM spans GROUP BY doc_id
), joined AS (
    SELECT doc_id, string_agg(piece, '' ORDER BY a) AS head FROM pieces GROUP BY doc_id
)
SELECT t.doc_id, CAST(length(t.h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(s.removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(s.n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(j.head, '') || substr(t.h, 2 * coalesce(s.last, 0) + 1))) AS kept_sha256
FROM texts t LEFT JOIN summed s ON t.doc_id = s.doc_id LEFT JOIN joined j ON t.doc_id = j.doc_id
"""

_ROUND = """
), near{r} AS MATERIALIZED (
    SELECT p.row, p.v, min([list_sum(list_transform(list_zip(p.v, c.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), c.cluster]) AS top
    FROM points p CROSS JOIN centres{r} c GROUP BY p.row, p.v
)"""

_MEANS = """, means{r} AS (
    SELECT cluster, d, sum(x) AS s, count(*) AS n
    FROM (SELECT top[2] AS cluster, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM near{r}) GROUP BY cluster, d
), fresh{r} AS (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS v FROM means{r} GROUP BY cluster
), centres{next} AS MATERIALIZED (
    SELECT c.cluster, coalesce(f.v, c.v) AS v FROM centres{r} c LEFT JOIN fresh{r} f ON c.cluster = f.cluster
"""

CENTROID_CLUSTERS = (
    """
WITH points AS MATERIALIZED (
    SELECT row_number() OVER () AS row, vec_id,
           list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), centres0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS BIGINT) AS cluster, v FROM points
    QUALIFY cluster < 16
"""
    + "".join(_ROUND.format(r=r) + _MEANS.format(r=r, next=r + 1) for r in range(3))
    + _ROUND.format(r=3)
    + """
SELECT p.vec_id, CAST(n.top[2] AS INTEGER) AS cluster, CAST(n.top[1] AS BIGINT) AS distance,
       CAST(sum(n.top[1]) OVER (PARTITION BY n.top[2]) AS BIGINT) AS cluster_inertia,
       CAST(sum(n.top[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM near3 n JOIN points p ON n.row = p.row JOIN centres3 c ON n.top[2] = c.cluster
"""
)


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_dedup": NEAR_DUPLICATES,
        "op2_substring_dedup": REPEATED_WORDS,
        "op4_suffix_dedup": REPEATED_BYTES,
        "op11_set_join": SET_JOIN,
        "op13_centroid_clusters": CENTROID_CLUSTERS,
    }
