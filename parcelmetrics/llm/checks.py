"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

COLLOCATIONS = r"""
WITH folded AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (
  SELECT lang, doc, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM folded),
worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY lang),
spans AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded WHERE len(w) > 0),
grams AS (
  SELECT lang, w[i:i + m - 1] AS p FROM spans, range(1, 6) AS lengths(m) WHERE i + m - 1 <= len(w)),
counts AS (SELECT lang, p, count(*) AS f FROM grams GROUP BY lang, p HAVING count(*) >= 100),
longer AS (
  SELECT DISTINCT c.lang, c.p[i:i + m - 1] AS inner_p, c.f AS f
  FROM counts c, range(1, 6) AS starts(i), range(2, 5) AS lengths(m)
  WHERE m < len(c.p) AND i + m - 1 <= len(c.p)),
candidates AS (
  SELECT c.* FROM counts c WHERE len(c.p) > 1
    AND NOT EXISTS (SELECT 1 FROM longer x WHERE x.lang = c.lang AND x.inner_p = c.p AND 100 * x.f >= 100 * c.f)),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, k, x.f AS l, y.f AS r, t.n,
         (1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM candidates c, range(1, 5) AS ks(k), counts x, counts y, totals t
  WHERE k < len(c.p) AND x.lang = c.lang AND x.p = c.p[1:k] AND y.lang = c.lang AND y.p = c.p[k + 1:len(c.p)] AND t.lang = c.lang),
weakest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS nth FROM cuts),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank,
         array_to_string(p, ' ') AS phrase, a, l, r, n, score
  FROM weakest WHERE nth = 1)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""


def centroids(clusters: int = 40, rounds: int = 5, dimensions: int = 64) -> str:
    """Lloyd rounds written out; a round is two steps, assignment and the new centroids."""

    def assigned(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
  SELECT vec_id, arg_min(k, (distance, k)) AS k, min(distance) AS distance
  FROM (SELECT v.vec_id, c.k, sum((v.x - c.x) * (v.x - c.x)) AS distance
        FROM parts v JOIN c{n} c ON v.d = c.d GROUP BY v.vec_id, c.k)
  GROUP BY vec_id)"""

    def moved(n: int) -> str:
        # // cuts towards zero; the floor of a negative mean is one less where something is left over.
        return f"""c{n + 1} AS MATERIALIZED (
  SELECT c.k, c.d, CASE WHEN m.n IS NULL THEN c.x ELSE m.s // m.n - CASE WHEN m.s % m.n < 0 THEN 1 ELSE 0 END END AS x
  FROM c{n} c LEFT JOIN (
    SELECT a.k, v.d, sum(v.x)::BIGINT AS s, count(*)::BIGINT AS n FROM a{n} a JOIN parts v ON a.vec_id = v.vec_id GROUP BY a.k, v.d) m
  ON c.k = m.k AND c.d = m.d)"""

    steps = ",\n".join(f"{assigned(n)},\n{moved(n)}" for n in range(rounds))
    return f"""
WITH kept AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dimensions} AND list_count(list_filter(embedding, lambda x: isfinite(x))) = {dimensions}),
parts AS MATERIALIZED (
  SELECT vec_id, d, CAST(floor(256 * CAST(embedding[d] AS DOUBLE)) AS BIGINT) AS x FROM kept, range(1, {dimensions} + 1) AS ds(d)),
seeds AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k FROM kept QUALIFY k < {clusters}),
c0 AS MATERIALIZED (SELECT s.k, v.d, v.x FROM seeds s JOIN parts v ON s.vec_id = v.vec_id),
{steps},
{assigned(rounds)},
hashes AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY k),
inertias AS (SELECT k, sum(distance) AS own FROM a{rounds} GROUP BY k)
SELECT a.vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance, CAST(i.own AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(own) FROM inertias) AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN hashes h ON a.k = h.k JOIN inertias i ON a.k = i.k
"""
