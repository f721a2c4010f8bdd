"""The numbered queries: each operator over its whole intended table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Rows an Arrow batch of whole texts holds; the default of 10,000 would be tens of megabytes a batch and task.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators that run Python in tasks.

    Workers can import this package where it was not installed or shipped with the job, and Arrow batches
    stay small unless the session names a size of its own.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [ROOT])
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_near_duplicates",
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON r.y = p.x),
best AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, b.component_id, s.doc_id = b.component_id AS kept
FROM sets s JOIN best b ON b.x = s.doc_id
""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash", "chosen")


@query("op3_secrets")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents")).drop("found")


@query(
    "op5_mixture",
    r"""
WITH sized AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, source, md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':mix')) AS key FROM documents),
totals AS (SELECT source, sum(size) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM totals),
ranked AS (
  SELECT *, row_number() OVER o AS rank,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS share
  FROM weighed
  WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST),
    b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fixed AS (SELECT *, 3 * source_size < weight * share AS stops FROM ranked),
aimed AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size,
    CASE WHEN stops THEN CAST(3 * source_size AS DOUBLE) ELSE weight * (SELECT arg_min(share, rank) FROM fixed WHERE NOT stops) END AS target FROM fixed),
placed AS (
  SELECT s.doc_id, s.size, a.source_size, a.target, floor(a.target + 0.5) AS budget,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source),
cut AS (SELECT *, CASE WHEN source_size > 0 THEN floor(budget / source_size) ELSE 0 END AS whole FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(whole * size + least(greatest(budget - whole * source_size - start, 0), size) AS BIGINT) AS taken FROM cut
""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mixture

    return mixture(table(spark, sf_dir, "documents"))


@query("op4_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"))


@query(
    "op8_topk",
    """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
""",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_rules")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .rules import judge

    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1"))


@query("op6_urls")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urlfilter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"))


@query("op2_main_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .extraction import extract

    return extract(table(spark, sf_dir, "pages"))


@query("op7_licenses")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of documents; of every tenth, by checksum, the end repeats with a period drawn from it."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    chosen = chosen.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, (F.floor(F.col("h") / 10) % F.col("n")).cast("int")))
    chosen = chosen.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.floor(F.col("h") / 10) % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    copies = F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))
    changed = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(F.flatten(copies), F.lit(1), rest))
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


#: Octaves of lags that the twin of op12 looks at: texts of up to 4 * 2^13 words.
_OCTAVES = 13


def _runs_sql() -> str:
    """Grams by doubling, next occurrences by octave of lags, stretches of neighbouring seeds."""
    grams, seeds = [], []
    for j in range(_OCTAVES + 1):
        grams.append(f"g{2 * 2**j} AS (SELECT *, hash(g{2**j}, lead(g{2**j}, {2**j}) OVER o) AS g{2 * 2**j} FROM g{2**j} WINDOW o AS (PARTITION BY row ORDER BY i))")
    for j in range(_OCTAVES):
        low, wide, narrow, k = 2**j, 4 if j == 0 else 2 ** (j + 1), 1 if j == 0 else 2**j, 5 if j == 0 else 3 * 2**j
        seeds.append(
            f"SELECT row, i, lead(i) OVER (PARTITION BY row, g ORDER BY i) - i AS lag, {k} AS k, {low} AS low FROM "
            f"(SELECT row, i, hash(g{wide}, lead(g{narrow}, {wide}) OVER (PARTITION BY row ORDER BY i)) AS g, n FROM grams) WHERE n - i >= {k}"
        )
    return rf"""
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
hashed AS (
  SELECT row, doc_id, w, len(w) AS n, xor(list_reduce(
      flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS h FROM rows),
placed AS (SELECT *, (h // 10) % n AS a FROM hashed WHERE n > 0),
timed AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
spread AS (SELECT row, n, a, p, h, w, unnest(range(n)) AS i FROM timed),
g1 AS (SELECT row, n, i, word, hash(word) AS g1 FROM (SELECT row, n, i, w[CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word FROM spread)),
{", ".join(grams)},
grams AS (SELECT * FROM g{2 * 2**_OCTAVES}),
seeds AS ({" UNION ALL ".join(seeds)}),
fitting AS (SELECT *, i - row_number() OVER (PARTITION BY row, lag ORDER BY i) AS island FROM seeds WHERE lag >= low AND lag < 2 * low),
runs AS (SELECT row, lag, min(i) AS start, max(i) + any_value(k) - min(i) + lag AS length FROM fitting GROUP BY row, lag, island HAVING max(i) + any_value(k) - min(i) + lag >= greatest(6, 4 * lag)),
told AS (
  SELECT row, count(*) AS n_runs, arg_min({{'start': start, 'length': length, 'period': lag}}, (-length, start, lag)) AS best,
    string_agg(concat(start, ',', length, ',', lag, chr(10)), '' ORDER BY start, lag) AS lines FROM runs GROUP BY row),
dropped AS (SELECT DISTINCT row, unnest(range(start + lag, start + length)) AS i FROM runs),
collapsed AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS text FROM g1 ANTI JOIN dropped USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length, CAST(best.period AS BIGINT) AS period,
  CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM rows LEFT JOIN told USING (row) LEFT JOIN collapsed c USING (row)
"""


@query("op12_runs", _runs_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic import periodic_runs

    found = periodic_runs(planted(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"), F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op11_search",
    r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
sized AS (SELECT *, len(t) AS n FROM texts WHERE len(t) > 0),
facts AS (SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS long FROM sized),
held AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(t) AS term FROM sized) GROUP BY row, term),
asked AS (
  SELECT item, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS item, item_id,
      unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item, item_id, term),
weighed AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(total) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM held, facts GROUP BY term),
scored AS (
  SELECT item, item_id, s.row, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * total) // long)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weighed USING (term) JOIN sized s USING (row), facts GROUP BY item, item_id, s.row, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexsearch import rank_documents

    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_fingerprints")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import compare_edits

    found = compare_edits(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query(
    "quality_base_rules",
    r"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lined AS (SELECT row, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (SELECT row, i, array_to_string(w[i + 1:i + 8], ' ') AS g FROM (SELECT row, w, unnest(range(0, len(w) - 7)) AS i FROM texts WHERE len(w) >= 8)),
again AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, g) > 1),
covered AS (SELECT row, count(DISTINCT place) AS n FROM (SELECT row, unnest(range(i, i + 8)) AS place FROM again) GROUP BY row),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM texts JOIN lined USING (row) LEFT JOIN covered c USING (row))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
""",
)
def base_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed checks of op10, which SQL can express."""
    return op10(spark, sf_dir).drop("kept", "score")


@query(
    "url_fixed_rules",
    r"""
WITH split AS (
  SELECT row_number() OVER () AS row, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (SELECT row, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict FROM split JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p) GROUP BY row)
SELECT page_id, host, path, rule, verdict FROM split LEFT JOIN fits USING (row)
""",
)
def fixed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op6 decides by fixed rules, which SQL can express; the verdict is null where the mined rules decide."""
    judged = op6(spark, sf_dir)
    return judged.withColumn("verdict", F.when(F.col("rule").isNotNull(), F.col("verdict")))
