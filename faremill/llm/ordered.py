"""A whole table in the order of an id, dealt to many tasks, each of which also sees the row that follows its last."""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BUCKETS = 1 << 14


def in_order(rows: DataFrame, salt: str) -> DataFrame:
    """``rows`` (columns ``id``, a long, and others) with ``bucket``, ``lead``: contiguous, sorted buckets of equal size.

    The order is by id, null last, then by a hash of column ``salt``. The first row of a bucket stands also in the one
    before, marked ``lead`` and last there; the first of all follows the last. Bucket limits are quantiles of the ids,
    a fixed number of values. An id that spans several quantiles is cut by the hash; only rows that are equal in id
    and salt stay together.
    """
    spark = rows.sparkSession
    keyed = rows.withColumn("hash", F.xxhash64(salt))
    facts = rows.agg(F.count("*").alias("n"), F.count("id").alias("known")).first()
    buckets = min(MOST_BUCKETS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    of_known = max(1, round(buckets * facts["known"] / max(1, facts["n"])))
    of_null = max(1, math.ceil(buckets * (facts["n"] - facts["known"]) / max(1, facts["n"])))
    quantiles = [i / of_known for i in range(1, of_known)]
    cuts = rows.agg(F.percentile_approx("id", quantiles, F.lit(100_000)).alias("q")).first()["q"] if quantiles and facts["known"] else []
    limits = np.array(sorted(cuts or []), np.int64)

    @F.pandas_udf("int")
    def bucket(ids: pd.Series, known: pd.Series, hashes: pd.Series) -> pd.Series:
        values, named = ids.to_numpy(np.int64), known.to_numpy(bool)
        low, high = np.searchsorted(limits, values, "left"), np.searchsorted(limits, values, "right")
        low, parts = np.where(named, low, len(limits) + 1), np.where(named, np.maximum(high - low, 1), of_null)
        share = ((hashes.to_numpy(np.int64) >> 32) + 2**31) * parts >> 32
        return pd.Series(low + share)

    placed = keyed.withColumn("bucket", bucket(F.coalesce("id", F.lit(0)), F.col("id").isNotNull(), F.col("hash")))
    key = F.struct(F.col("id").isNull().alias("null"), F.coalesce("id", F.lit(0)).alias("id"), F.col("hash").alias("hash"))
    firsts = placed.groupBy("bucket").agg(F.min(key).alias("first")).select("bucket", "first.*").orderBy("bucket").collect()
    if not firsts:
        return placed.withColumn("lead", F.lit(False))
    names = [r["bucket"] for r in firsts]
    size = names[-1] + 1
    at = [min(bisect_left(names, b), len(names) - 1) for b in range(size)]
    before = F.lit([names[i - 1] for i in at])
    first_null, first_id, first_hash = (F.lit([firsts[i][c] for i in at]) for c in ("null", "id", "hash"))
    own = F.col("bucket") + 1
    is_first = (F.element_at(first_null, own) == F.col("id").isNull()) & (F.element_at(first_id, own) == F.coalesce("id", F.lit(0))) & (F.element_at(first_hash, own) == F.col("hash"))
    plain = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("lead"))
    led = F.struct(F.element_at(before, own).alias("bucket"), F.lit(True).alias("lead"))
    both = placed.withColumn("place", F.explode(F.when(is_first, F.array(plain, led)).otherwise(F.array(plain)))).drop("bucket")
    both = both.select("*", "place.bucket", "place.lead").drop("place")
    return both.repartition("bucket").sortWithinPartitions("bucket", "lead", F.col("id").asc_nulls_last(), "hash").drop("hash")
