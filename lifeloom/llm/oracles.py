"""DuckDB SQL for queries of this subpackage, by other means than the operators."""

from __future__ import annotations


def _field(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def manifest_sql(levels: int = 6) -> str:
    """Every level of both trees written out; enough for ``16 ** levels`` rows of one source."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    bits = "list_transform(range(0, 8 * length(id)), lambda i: (ascii(id[i // 8 + 1]) >> (i % 8)) & 1)"
    crc = f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"
    parts = [
        f"""docs AS (
  SELECT doc_id, source, sha256({head} || {_field("text")}) AS leaf,
    CASE WHEN {crc} % 5 = 0 THEN sha256({head} || {_field(lowered)}) END AS bad
  FROM (SELECT *, CAST(doc_id AS VARCHAR) AS id FROM documents)
)""",
        """a0 AS (
  SELECT source, leaf AS node, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n, doc_id, coalesce(bad, leaf) AS acc, '' AS proof FROM docs
)""",
    ]

    def climb(x: str, by: str) -> None:
        """Levels x1, x2, … over x0, and a run's nodes as lists: x0_runs, x1_runs, …"""
        for k in range(levels):
            parts.append(
                f"{x}{k}_runs AS (SELECT {by}, pos // 16 AS run, list(node ORDER BY pos) AS nodes, max(n) AS n "
                f"FROM {x}{k} WHERE n > 1 GROUP BY ALL)"
            )
            parts.append(
                f"{x}{k + 1} AS (SELECT {by}, run AS pos, sha256(array_to_string(nodes, '')) AS node, (n + 15) // 16 AS n FROM {x}{k}_runs)"
            )

    def fold(rows: str, start: str, x: str, by: str) -> str:
        """``start`` with acc and proof carried up through all levels of x."""
        last = start
        for k in range(levels):
            left, right = "array_to_string(nodes[1:place], '')", "array_to_string(nodes[place + 2:], '')"
            parts.append(f"""{rows}{k} AS (
  SELECT d.* EXCLUDE (acc, proof, step, place), step // 16 AS step,
    CASE WHEN nodes IS NULL THEN acc ELSE sha256({left} || acc || {right}) END AS acc,
    CASE WHEN nodes IS NULL THEN proof ELSE proof || {left} || {right} END AS proof
  FROM (SELECT *, step % 16 AS place FROM {last}) d
  LEFT JOIN (SELECT {by} AS _by, run AS _run, nodes FROM {x}{k}_runs) r
    ON d.{by} IS NOT DISTINCT FROM r._by AND d.step // 16 = r._run
)""")
            last = f"{rows}{k}"
        return last

    climb("a", "source")
    roots = " UNION ALL ".join(f"SELECT source, node FROM a{k} WHERE n = 1" for k in range(levels + 1))
    parts.append(f"""b0 AS (
  SELECT 0 AS tree, source, node, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM ({roots})
)""")
    climb("b", "tree")
    tops = " UNION ALL ".join(f"SELECT node FROM b{k} WHERE n = 1" for k in range(levels + 1))
    parts.append("up AS (SELECT source, doc_id, node, acc, proof, pos AS step FROM a0)")
    last = fold("u", "up", "a", "source")
    parts.append(
        f"over AS (SELECT d.* EXCLUDE (step), 0 AS tree, b0.node AS subroot, b0.pos AS step FROM {last} d "
        "JOIN b0 ON d.source IS NOT DISTINCT FROM b0.source)"
    )
    last = fold("v", "over", "b", "tree")
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, node AS leaf, subroot, root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = root AS verified
FROM {last}, (SELECT any_value(node) AS root FROM ({tops}))"""
    )


def clusters_sql(k: int = 40, rounds: int = 5, dimensions: int = 64) -> str:
    """Every vector against every centroid, each round written out; whole numbers as doubles are exact here."""
    parts = [
        f"""x AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS v
  FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS k, v FROM x
  ORDER BY sha256('2:' || vec_id) NULLS LAST, v LIMIT {k}
)""",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(x.v) AS v, min(struct_pack(
    d := list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, c.v) + list_dot_product(c.v, c.v), k := c.k)) AS best
  FROM x, c{r} c GROUP BY rid
)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  WITH s AS (
    SELECT best.k AS k, i, sum(CAST(v[i] AS HUGEINT)) AS s, count(*) AS n
    FROM a{r}, range(1, {dimensions + 1}) t(i) GROUP BY ALL
  ), m AS (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS v FROM s GROUP BY k
  ) SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m USING (k)
)""")
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.v, lambda e: CAST(CAST(e AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON best.k = c.k"""
    )


JACCARD_SQL = r"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), members AS MATERIALIZED (
  SELECT DISTINCT rid, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM docs WHERE len(w) > 0
), sizes AS MATERIALIZED (SELECT rid, count(*) AS n FROM members GROUP BY rid),
common AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM members a JOIN members b ON a.s = b.s AND a.rid <> b.rid GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON a = x.rid JOIN sizes y ON b = y.rid WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach AS (
  SELECT rid, rid AS x FROM docs UNION SELECT reach.rid, links.b FROM reach JOIN links ON reach.x = links.a
)
SELECT any_value(d.doc_id) AS doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(e.doc_id) AS component_id
FROM reach JOIN docs d ON reach.rid = d.rid JOIN docs e ON reach.x = e.rid LEFT JOIN sizes ON sizes.rid = d.rid
GROUP BY d.rid"""
