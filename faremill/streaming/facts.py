"""Facts kept up to date from streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_text
from ..operators import gold, silver
from ..plans.monthly import MONTH, Lake, book_of, publish_facts
from ..schema import TripRules
from ..session import scratch_scope
from ..sources import manifest, tables

BATCH, PICKUP = "_batch_id", "tpep_pickup_datetime"


def _before(spark: SparkSession, path: str, load: str) -> DataFrame | None:
    """What earlier micro-batches wrote; the rows of ``load`` itself are those of a replay and don't count."""
    return tables.read_table(spark, path).where(F.col(manifest.LOAD) < load) if tables.exists(spark, path) else None


def winners(spark: SparkSession, lake: Lake, load: str, months: Sequence[str], rules: TripRules, lo=None, hi=None) -> DataFrame | None:
    """The newest copy of each trip of some months as of micro-batch ``load``, without it, with its key; no trip ids.

    The log holds, of every micro-batch, the copies that became newest; the last entry of a key is its newest copy.
    Pickup limits are pushed to the scan, so micro-batches that cover little time read little.
    """
    log = _before(spark, lake.winners, load)
    if log is None:
        return None
    near = log.where(F.col(BATCH).isin(list(months)) & (F.col("sign") == 1))
    if lo is not None:
        near = near.where(F.col(PICKUP).between(F.lit(lo), F.lit(hi)) | F.col(PICKUP).isNull())
    return silver.latest_by_key(silver.keyed(near, (BATCH, *rules.dedup_keys)), [silver.KEY], manifest.LOAD).drop(manifest.LOAD, "sign")


def gold_from_batches(spark: SparkSession, lake: Lake, zones: DataFrame, rules: TripRules = TripRules()) -> Callable[[DataFrame, int], None]:
    """Micro-batch step: what the batch changes in the kept trips goes into the hourly sums, and these into gold.

    Copies of a trip are compared within their batch month, and the newest is kept whether or not it passes the
    quality rules. Three tables are appended to, each micro-batch below a folder named after its number, which a
    replay overwrites: bronze, the log of newest copies, and whole-number sums per hour of the trips that a
    micro-batch added or took back. A late row costs the look-up of its own key, among the copies picked up in the
    time its micro-batch covers, and the sums of its hour; no trip is read again. The facts of touched months are
    worked out from the sums and pass the gates of the monthly run. Any order of deliveries ends in the same facts.
    """
    keys = (BATCH, *rules.dedup_keys)

    def step(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        load, (_, at) = f"stream-{number:08d}", manifest.new_load()
        rows = batch.withColumns({manifest.LOAD: F.lit(load), manifest.REJECT: F.lit(None).cast("string")}).hint("rebalance", F.col(BATCH))
        seen = manifest.write_observed(
            rows, lake.bronze, (manifest.LOAD, BATCH),
            {"rows": F.count(F.lit(1)), "months": F.collect_set(BATCH), "lo": F.min(PICKUP), "hi": F.max(PICKUP)}, "overwrite",
        )
        if not seen["rows"]:
            return
        book_of(session, lake).commit_written(lake.bronze, load, at)
        landed = manifest.folders(session, lake.bronze, [load]).drop(manifest.LOAD, manifest.REJECT)
        # A trip's id follows from its columns and hardly compresses: no shuffle and no log carries it.
        new = silver.typed_from_columns(landed, rules).drop("trip_id")
        old = winners(session, lake, load, seen["months"], rules, seen["lo"], seen["hi"])
        changes = silver.changed_rows(new, old, keys, "_ingested_at", rules.dedup_tiebreak).withColumn(manifest.LOAD, F.lit(load))
        # A pickup outside its batch month is never accepted, so the batch months are the months of the facts.
        if not manifest.write_observed(changes.hint("rebalance", F.col(BATCH)), lake.winners, (manifest.LOAD, BATCH), {"rows": F.count(F.lit(1))}, "overwrite")["rows"]:
            return
        changed = manifest.folders(session, lake.winners, [load]).where(silver.accepted(rules))
        sums = gold.hourly_moments(changed, rules).withColumns({MONTH: month_text("pickup_hour"), manifest.LOAD: F.lit(load)})
        touched = manifest.write_observed(sums.hint("rebalance", F.col(MONTH)), lake.moments, (manifest.LOAD, MONTH), {"months": F.collect_set(MONTH)}, "overwrite")["months"]
        if touched:
            every = tables.read_table(session, lake.moments).where((F.col(manifest.LOAD) <= load) & F.col(MONTH).isin(list(touched)))
            with scratch_scope(session):
                publish_facts(session, lake, gold.hourly_from_moments(every.drop(manifest.LOAD, MONTH), zones, rules), sorted(touched))

    return step


def kept_trips(spark: SparkSession, lake: Lake, months: Sequence[str], rules: TripRules = TripRules()) -> DataFrame:
    """The cleaned trips of some months as the stream has them now: what a monthly run would have as silver."""
    rows = winners(spark, lake, "stream-~", months, rules)
    return silver.with_trip_id(silver.quality_filter(rows.drop(silver.KEY), rules), rules)


def hourly_counts(events: DataFrame, time: str, key: Column, delay: str = "2 hours") -> DataFrame:
    """Event-time counts per key and hour.

    Watermarked state is dropped once an hour is final, so state size follows the number of
    open hours and keys, not the stream's length. A hot key costs one state row: partial
    counts are made before the shuffle.
    """
    return (
        events.withColumn("_t", F.col(time).cast("timestamp"))
        .withWatermark("_t", delay)
        .groupBy(F.window("_t", "1 hour").alias("w"), key.alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "key", "n")
    )
