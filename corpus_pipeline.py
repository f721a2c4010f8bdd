"""Corpus pipeline: from raw documents to packed training windows.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and reread as the next
one's ``docs``. All stages but the last return the columns of documents (others are dropped). Stages decide
on all rows they get: rejected documents and redundant copies go, secrets are masked, sources are repeated
or cut to their budget. Null texts count as empty; an empty table stays empty through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm.queries import prepare, table
from faremill.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: What stands in for a masked span.
MASK = "[secret]"


def _shaped(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier rejects; it learns from the labelled ones of ``docs``."""
    from faremill.llm import quality

    prepare(spark)
    model = quality.fit(quality.text_features(docs), table(spark, sf_dir, "labels"))
    return _shaped(quality.score_texts(_shaped(docs), model).where(F.col("score") >= quality.CUT))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each near-duplicate class, that of smallest id (null last), and all that link with nothing.

    Rows are told apart by id and text: a null id is an id like any other, rows of one id with different texts are
    different documents, and of rows that are wholly equal one stays. Texts without words are no duplicates of
    anything, so each such row stays.
    """
    from faremill.llm.neardup import near_duplicates

    prepare(spark)
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    wordless = ~F.coalesce(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    kept = near_duplicates(docs).where("chosen and n_shingles > 0").select(F.col("doc_id").alias("of"), F.col("text_hash").alias("same")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("same"))
    unique = hashed.where(~wordless).join(kept, same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    return _shaped(unique).unionByName(_shaped(docs.where(wordless)))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every span that the scan finds, base and battery alike; overlapping spans become one mask."""
    from faremill.llm.secrets import find_secrets

    prepare(spark)
    found = find_secrets(docs, carry=tuple(c for c in COLUMNS if c != "doc_id"))
    pieces = F.aggregate(
        "found",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), F.lit(MASK))).otherwise(a["out"]).alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))),
    )
    masked = found.withColumn("text", F.when(F.size("found") > 0, pieces).otherwise(F.col("text")))
    return _shaped(masked.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document by the whole times its words are taken; the last part of a budget is a cut document."""
    from faremill.llm.mixing import WORD, mixture

    mixed = mixture(docs, carry=tuple(c for c in COLUMNS if c != "doc_id"))
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), rest), "")
    copies = F.concat(F.array_repeat(F.col("text"), whole), F.when(rest > 0, F.array(cut)).otherwise(F.array().cast("array<string>")))
    rows = mixed.withColumn("text", F.explode(copies))
    return _shaped(rows.withColumn("n_chars", F.length("text").cast("long")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into token windows: a row a piece."""
    from faremill.llm.packing import pack

    prepare(spark)
    return pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: A trained classifier and a tokenizer are no SQL: tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
