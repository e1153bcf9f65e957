"""Registered queries of this folder, with SQL where DuckDB can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playbill.llm import centroids, decontaminate, divergence, language, licenses, line_dedup, near_dup, packing, private_data, quality, repeats, repetition, token_files


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_empirical_bayes(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")
    return quality.quality_scores(docs, _table(spark, folder, "labels"), docs["source"], docs["lang"], good)


def op2_sum_of_squares_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"))


def op3_minhash_bayes(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, folder, "documents"))


def op4_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    found = private_data.find_private_data(_table(spark, folder, "documents"))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(private_data.KINDS[:4])]
    base = F.sha2(private_data.span_text("base"), 256)
    return found.select("doc_id", *counts, base.alias("base_sha256"), private_data.span_text("spans").alias("spans"))


def op5_arrow_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(_table(spark, folder, "documents"))


def op6_license_index(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents")).drop("matches")


def op7_repetition_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.quality_rules(_table(spark, folder, "documents"))


def op8_positional_index(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    out = decontaminate.contamination(docs, _table(spark, folder, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), iw AS (
  SELECT item_id, least(len(w), 13) AS n, w, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS s FROM i WHERE len(w) > 0
), win AS (SELECT DISTINCT item_id, n, array_to_string(w[s : s + n - 1], ' ') AS g FROM iw),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT r, n, w, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n
), hit AS (
  SELECT dw.r, dw.s, dw.n, win.item_id FROM dw JOIN win ON win.n = dw.n AND win.g = array_to_string(dw.w[dw.s : dw.s + dw.n - 1], ' ')
), spots AS (
  SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN spots USING (r) LEFT JOIN items USING (r)
""".replace("\\\\", "\\")


def op9_language_ppm(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    trees = language.fit_trees(docs.where(~held))
    return language.predict_language(docs.withColumn("held_out", held), trees, keep=("doc_id", "held_out"))


def op10_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, folder, "documents"))
    return out.select(
        "doc_id",
        "n_lines",
        F.size("removed_lines").cast("long").alias("n_removed"),
        F.concat_ws(",", F.col("removed_lines").cast("array<string>")).alias("removed_lines"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op11_rotated_centroids(spark: SparkSession, folder: str) -> DataFrame:
    rows, centres = centroids.cluster_vectors(_table(spark, folder, "embeddings"))
    described = centres.select(
        "cluster",
        F.col("inertia").cast("long").alias("cluster_inertia"),
        F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256).alias("centroid_sha256"),
    )
    total = centres.agg(F.sum("inertia").cast("long").alias("inertia"))
    return rows.join(F.broadcast(described), "cluster").join(F.broadcast(total)).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _op11_sql(k: int = centroids.CLUSTERS, rounds: int = centroids.ROUNDS, dims: int = centroids.DIMS) -> str:
    """Ten rounds, a common table each; centroids are rows of (cluster, list)."""
    parts = [
        f"""x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor({centroids.SCALE} * CAST(e AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(CAST(e AS DOUBLE)))) = {dims}
)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('{centroids.SEED}:' || vec_id) AS h, v FROM x ORDER BY h NULLS LAST, v LIMIT {k})
)""",
    ]
    apart = "list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(x.v) AS v, arg_min(struct_pack(c := c.c, d := {apart}), {apart} * {k} + c.c) AS n
  FROM x CROSS JOIN c{i} AS c GROUP BY r
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(any_value(m.v), any_value(o.v)) AS v FROM c{i} AS o LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
      SELECT n.c AS c, i, sum(v[i])::HUGEINT AS s, count(*) AS n FROM a{i}, range(1, {dims + 1}) AS t(i) GROUP BY n.c, i
    ) GROUP BY c
  ) AS m USING (c) GROUP BY c
)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(a.n.c AS INTEGER) AS cluster, CAST(a.n.d AS BIGINT) AS distance,
  CAST(sum(a.n.d) OVER (PARTITION BY a.n.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.n.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON a.n.c = c.c"""


def op12_divergence_cube(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_table(spark, folder, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT lang, source, r, t, count(*) AS n FROM (SELECT lang, source, r, unnest(w) AS t FROM d) GROUP BY ALL
), kept AS (
  SELECT lang, t, sum(n) AS n FROM t GROUP BY lang, t HAVING count(*) >= 30
), langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
gc AS (SELECT lang, source, t, sum(t.n) AS n FROM t SEMI JOIN kept USING (lang, t) GROUP BY ALL),
gn AS (SELECT lang, source, coalesce(sum(gc.n), 0) AS n FROM g LEFT JOIN gc USING (lang, source) GROUP BY ALL),
p AS (
  SELECT lang, source, t, coalesce(gc.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(gc.n, 0) + 5)) // (gn.n + 5 * langs.v) AS p,
    1 + (1000000000::HUGEINT * (kept.n + 5)) // (langs.n + 5 * langs.v) AS q
  FROM gn JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN gc USING (lang, source, t)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL
), out AS (
  SELECT lang, source, 'pair' AS part, item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM pairs LEFT JOIN sums USING (lang, source, item)
  UNION ALL SELECT lang, source, 'term', t, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM out
) WHERE part = 'pair' OR rank <= 50
"""


def op13_fm_index(spark: SparkSession, folder: str) -> DataFrame:
    out = repeats.remove_repeats(_table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), win AS (
  SELECT r, doc_id, s, md5(array_to_string(w[s : s + 49], ' ')) AS g
  FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 49)) AS s FROM d WHERE len(w) >= 50)
), low AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
gone AS (
  SELECT r, list(DISTINCT p) AS gone FROM (
    SELECT r, unnest(generate_series(s, s + 49)) AS p FROM win JOIN low USING (g) WHERE m < doc_id
  ) GROUP BY r
), judged AS (
  SELECT doc_id, w, coalesce(gone, []) AS gone,
    list_filter(list_transform(w, lambda x, i: CASE WHEN list_contains(coalesce(gone, []), i) THEN NULL ELSE x END), lambda x: x IS NOT NULL) AS kept
  FROM d LEFT JOIN gone USING (r)
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM judged
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_empirical_bayes,
        op2_sum_of_squares_packing,
        op3_minhash_bayes,
        op4_weak_supervision,
        op5_arrow_token_files,
        op6_license_index,
        op7_repetition_rules,
        op8_positional_index,
        op9_language_ppm,
        op10_fuzzy_lines,
        op11_rotated_centroids,
        op12_divergence_cube,
        op13_fm_index,
    )
}
SQL: dict[str, str] = {"op8_positional_index": OP8_SQL, "op11_rotated_centroids": _op11_sql(), "op12_divergence_cube": OP12_SQL, "op13_fm_index": OP13_SQL}
