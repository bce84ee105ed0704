"""The queries over the corpus tables, with SQL where another engine can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from brisa.llm import (
    bpe, common, divergence, jaccard, licences, line_dedup, ordermin, packing, pii, pu_quality, quality_rules, simhash,
    simplex, substring,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register




@query("op3_bpe_forced_boundaries")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.decode(bpe.encode(common.documents(spark, sf_dir)))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        common.hex_sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        common.hex_sha256(F.col("decoded")).alias("decoded_sha256"),
    )


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.verdicts(common.documents(spark, sf_dir))
    return found.drop("row_key", "frequent_lines")


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.documents(spark, sf_dir))


@query("op6_pii_boosted_candidates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(common.documents(spark, sf_dir))
    told = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id",
        *map(count, ("email", "ip", "card", "phone")),
        common.hex_sha256(told("base")).alias("base_sha256"),
        told("spans").alias("spans"),
    )


@query("op7_licence_notices")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(common.documents(spark, sf_dir))
    told = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["line"].cast("string"), s["family"])), ",")
    return found.select(
        "doc_id", "n_paragraphs", "n_unconfirmed", F.array_join("families", ",").alias("families"), told.alias("notices")
    )


OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
raw AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM d
),
counted AS (
  SELECT doc_id, line, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k
  FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
win AS (
  SELECT doc_id, k, line AS a, lead(line, 1) OVER o AS b, lead(line, 2) OVER o AS c
  FROM counted WINDOW o AS (PARTITION BY doc_id ORDER BY k)
),
ranked AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS place
  FROM win WHERE b IS NOT NULL AND c IS NOT NULL
),
gone AS (SELECT DISTINCT doc_id, unnest([k, k + 1, k + 2]) AS k FROM ranked WHERE place > 1),
flagged AS (
  SELECT raw.doc_id, raw.pos, raw.line, counted.k IS NOT NULL AS is_counted, gone.k IS NOT NULL AS is_gone
  FROM raw LEFT JOIN counted ON raw.doc_id = counted.doc_id AND raw.pos = counted.pos
  LEFT JOIN gone ON counted.doc_id = gone.doc_id AND counted.k = gone.k
)
SELECT doc_id, CAST(count(*) FILTER (WHERE is_counted) AS BIGINT) AS n_lines,
  CAST(count(*) FILTER (WHERE is_gone) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT is_gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""


@query("op8_line_windows", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(common.documents(spark, sf_dir))
    text = F.coalesce(F.col("text"), F.lit(""))
    return kept.select("doc_id", "n_lines", "n_removed", common.hex_sha256(text).alias("kept_sha256"))


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(words, i, i + 12), ' ') AS run
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 12)) AS i FROM w WHERE len(words) >= 13)
),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS least FROM win) WHERE doc_id > least
),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS p FROM later),
word AS (
  SELECT doc_id, p, words[p] AS word FROM (SELECT doc_id, words, unnest(generate_series(1, len(words))) AS p FROM w)
),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(len(words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query("op10_substring_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(common.documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", common.hex_sha256(F.col("kept")).alias("kept_sha256"))


@query("op1_ngram_jaccard")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(common.documents(spark, sf_dir))


@query("op2_order_minhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.compared(common.documents(spark, sf_dir))


@query("op9_pu_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.score(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
),
t AS (
  SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM d
),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT lang, source, coalesce(s.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) s
  USING (lang, source)
),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + v)::HUGEINT AS p
  FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
),
w AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (total + v)::HUGEINT AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL)
  JOIN (SELECT lang, sum(n) AS total FROM c GROUP BY lang) USING (lang) JOIN v USING (lang)
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
  FROM p JOIN w USING (lang, term) WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query("op11_source_divergence", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(common.documents(spark, sf_dir))


@query("op12_simhash_pigeonhole")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_components(common.documents(spark, sf_dir))
    told = F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint")
    return found.select("doc_id", told, "component_id")


def _op13_sql() -> str:
    """Three rounds of assignment and means, then one assignment, written out."""
    assigned = """{name} AS (
  SELECT row, arg_min(center, (distance, center)) AS cluster, min(distance) AS distance FROM (
    SELECT row, center, list_sum(list_transform(list_zip(k.q, {centers}.q),
      lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance
    FROM k CROSS JOIN {centers}
  ) GROUP BY row
)"""
    means = """{name} AS (
  SELECT center, coalesce(m.q, {before}.q) AS q FROM {before} LEFT JOIN (
    SELECT cluster, list(CAST(mean AS BIGINT) ORDER BY place) AS q FROM (
      SELECT cluster, place, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS mean FROM (
        SELECT cluster, unnest(q) AS x, generate_subscripts(q, 1) AS place FROM k JOIN {found} USING (row)
      ) GROUP BY cluster, place
    ) GROUP BY cluster
  ) m ON m.cluster = center
)"""
    steps = ["""k AS (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""", """c0 AS (
  SELECT row_number() OVER (ORDER BY draw, q) - 1 AS center, q
  FROM (SELECT sha256('1:' || vec_id) AS draw, q FROM k WHERE vec_id IS NOT NULL ORDER BY draw, q LIMIT 16)
)"""]
    for k in range(simplex.ROUNDS):
        steps.append(assigned.format(name=f"a{k}", centers=f"c{k}"))
        steps.append(means.format(name=f"c{k + 1}", before=f"c{k}", found=f"a{k}"))
    steps.append(assigned.format(name="a", centers=f"c{simplex.ROUNDS}"))
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{simplex.ROUNDS}.q, ',')) AS centroid_sha256
FROM a JOIN k USING (row) JOIN c{simplex.ROUNDS} ON center = cluster
"""


@query("op13_simplex_clusters", _op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex.clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
