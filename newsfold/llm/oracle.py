"""Queries of this package again as SQL for another engine, where SQL can express them."""

from __future__ import annotations

TOP_PRODUCTS = """
WITH vectors AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


def model(order: int = 4, symbols: int = 256) -> str:
    """``p<n>``: probabilities of runs of n + 1 characters under both models, from shorter to longer runs."""
    steps = []
    for n in range(order + 1):
        steps.append(
            f"c{n} AS (SELECT right(run, {n + 1}) AS part, sum(n_allow) AS n_allow, sum(n_block) AS n_block FROM counted GROUP BY 1)"
        )
        context = f"PARTITION BY left(part, {n})" if n else ""
        steps.append(f"""t{n} AS (SELECT *, {", ".join(
            f"sum(n_{s}) OVER ({context}) AS all_{s}, count(*) FILTER (n_{s} > 0) OVER ({context}) AS kinds_{s}" for s in ("allow", "block"))}
            FROM c{n})""")
        less = {s: f"p{n - 1}.p_{s}" if n else f"CAST(1 AS DOUBLE) / {symbols}" for s in ("allow", "block")}
        mixed = ", ".join(
            f"CASE WHEN all_{s} > 0 THEN (n_{s} + kinds_{s} * {less[s]}) / (all_{s} + kinds_{s}) ELSE {less[s]} END AS p_{s}" for s in ("allow", "block")
        )
        joined = f"JOIN p{n - 1} ON p{n - 1}.part = right(t{n}.part, {n})" if n else ""
        steps.append(f"p{n} AS (SELECT t{n}.part, {mixed} FROM t{n} {joined})")
    return ", ".join(steps)


URL_VERDICTS = f"""
WITH addressed AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS address FROM pages),
parts AS (
    SELECT *, translate(regexp_extract(coalesce(address, ''), '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') AS host,
           regexp_extract(coalesce(address, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM addressed),
ruled AS (
    SELECT *, CASE WHEN {fits("example.net", "/en/")} THEN 'example.net/en/' WHEN {fits("example.com", "/de/")} THEN 'example.com/de/'
                   WHEN {fits("org", "/fr/")} THEN 'org/fr/' WHEN {fits("net", "/")} THEN 'net/' END AS rule FROM parts),
addresses AS (SELECT DISTINCT address, rule IN ('example.net/en/', 'org/fr/') AS allowed FROM ruled WHERE address <> ''),
runs AS (
    SELECT address, allowed, substr(repeat(chr(2), 4) || address, i, 5) AS run
    FROM (SELECT *, unnest(range(1, length(address) + 1)) AS i FROM addresses)),
counted AS (SELECT run, count(*) FILTER (allowed) AS n_allow, count(*) FILTER (NOT allowed) AS n_block FROM runs GROUP BY run),
{model()},
scores AS (
    SELECT address, any_value(allowed) AS allowed, avg(ln(p_allow) - ln(p_block)) AS score FROM runs JOIN p4 ON run = part GROUP BY address),
steps AS (
    SELECT floor(score / 0.01) AS step, count(*) FILTER (allowed) AS a, count(*) FILTER (NOT allowed) AS b
    FROM scores WHERE allowed IS NOT NULL GROUP BY 1),
gains AS (
    SELECT step, coalesce((lag(step) OVER (ORDER BY step) + 1 + step) / 2, step) AS middle, sum(a) OVER () AS all_a, sum(b) OVER () AS all_b,
           coalesce(sum(b) OVER w, 0) / sum(b) OVER () - coalesce(sum(a) OVER w, 0) / sum(a) OVER () AS gain
    FROM steps WINDOW w AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (
    SELECT coalesce((SELECT middle * 0.01 FROM gains WHERE all_a > 0 AND all_b > 0 ORDER BY round(gain, 9) DESC, step LIMIT 1), 0) AS cut)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN score < cut THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN scores USING (address), cut
"""



def rounds(count: int = 3, dimension: int = 64) -> str:
    """``c<n>``: centroids after n rounds; ``a<n>``: every vector with its nearest centroid of round n."""
    steps = []
    for n in range(count + 1):
        steps.append(f"""a{n} AS (
            SELECT r, min(vec_id) AS vec_id, min(v) AS v, CAST(min(struct_pack(d := d, c := c)).d AS BIGINT) AS distance, min(struct_pack(d := d, c := c)).c AS cluster
            FROM (SELECT r, vec_id, v, c, list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept, c{n})
            GROUP BY r)""")
        if n < count:
            steps.append(f"""s{n} AS (
                SELECT cluster, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS k FROM a{n}, range(1, {dimension + 1}) AS t(i) GROUP BY cluster, i)""")
            steps.append(f"""c{n + 1} AS (
                SELECT c, coalesce(list((s - ((s % k) + k) % k) // k ORDER BY i) FILTER (s IS NOT NULL), any_value(w)) AS w
                FROM c{n} LEFT JOIN s{n} ON cluster = c GROUP BY c)""")
    return ", ".join(steps)


CLUSTERS = f"""
WITH kept AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
    SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS INTEGER) AS c, v AS w FROM kept
    QUALIFY c < 16),
{rounds()}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM a3 JOIN c3 ON c = cluster
"""


def draw(n: int) -> str:
    return f"CAST('0x' || substr(sha256('1:' || doc_id), {8 * n - 7}, 8) AS BIGINT)"


FILL_MIDDLE = f"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n, {draw(1)} AS h1, {draw(2)} AS h2, {draw(3)} AS h3, {draw(4)} AS h4
    FROM documents),
cut AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
           CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
parts AS (SELECT *, substring(t, 1, low) AS p, substring(t, low + 1, high - low) AS m, substring(t, high + 1, n - high) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

SQL = {
    "op4_cover_tree_search": TOP_PRODUCTS,
    "op7_url_filter": URL_VERDICTS,
    "op12_simplex_clusters": CLUSTERS,
    "op13_fill_middle": FILL_MIDDLE,
}
