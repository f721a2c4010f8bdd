"""Typed, de-duplicated and quality-filtered trips."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import epoch_micros, in_month, micros_to_ntz
from ..functions.numeric import surrogate_key
from ..schema import AUDIT_COLUMNS, RAW_FIELDS, TripRules


_WHOLE = ("byte", "short", "integer", "long")


def _typed(value: Column, dtype: str, source_type: str = "double") -> Column:
    if dtype == "int" and source_type not in _WHOLE:
        # Source counts may arrive as floats; round, a bare cast would truncate.
        return F.round(value.cast("double")).cast("int")
    return value.cast(dtype)


def typed_from_columns(raw: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Cast a raw scan with native columns; a field absent from the file becomes NULL."""
    present = {f.name.lower(): f for f in raw.schema.fields}
    fields: dict[str, Column] = {}
    for source, name, dtype in RAW_FIELDS:
        found = present.get(source.lower())
        fields[name] = (
            _typed(F.col(found.name), dtype, found.dataType.typeName()) if found else F.lit(None).cast(dtype)
        )
    return _with_key(raw, fields, rules)


def typed_from_variant(bronze: DataFrame, rules: TripRules = TripRules(), column: str = "raw_data") -> DataFrame:
    """Cast a landed variant column; timestamps are epoch microseconds in the variant."""
    v = F.col(column)
    fields: dict[str, Column] = {}
    for source, name, dtype in RAW_FIELDS:
        path = f"$.{source}"
        if dtype == "timestamp_ntz":
            fields[name] = micros_to_ntz(F.try_variant_get(v, path, "bigint"))
        elif dtype == "int":
            fields[name] = _typed(F.try_variant_get(v, path, "double"), dtype)
        else:
            fields[name] = F.try_variant_get(v, path, dtype)
    return _with_key(bronze, fields, rules)


def _with_key(df: DataFrame, fields: dict[str, Column], rules: TripRules) -> DataFrame:
    fields = dict(fields)
    # Tips are recorded for card payments only.
    fields["tip_amount"] = F.when(fields["payment_type"] == rules.card_payment, fields["tip_amount"])
    return df.select(
        _trip_id(fields, rules),
        *[expr.alias(name) for name, expr in fields.items()],
        *[c for c in AUDIT_COLUMNS if c in df.columns],
    )


def _trip_id(fields: Mapping[str, Column], rules: TripRules) -> Column:
    vendor, pickup, zone = (fields[k] for k in rules.trip_id_parts)
    return surrogate_key(vendor, epoch_micros(pickup), zone).alias("trip_id")


def with_trip_id(typed: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Typed rows led by their key, worked out from their columns as for a scan."""
    return typed.select(_trip_id({k: F.col(k) for k in rules.trip_id_parts}, rules), *[c for c in typed.columns if c != "trip_id"])


def latest_by_key(df: DataFrame, keys: Sequence[str], newest_by: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: the newest, ties settled by ``tiebreak``.

    The rank filter is turned into a group limit that also runs before the shuffle,
    so a key with a huge number of copies sends at most one row per map task.
    """
    order = [F.col(newest_by).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tiebreak]
    ranked = df.withColumn("_row_num", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_row_num") == 1).drop("_row_num")


def newer(a: str, b: str, newest_by: str, tiebreak: Sequence[str] = ()) -> Column:
    """Whether row struct ``a`` comes strictly before ``b`` in the order of :func:`latest_by_key`."""
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    out = F.lit(False)
    for c in reversed(tiebreak):
        before = F.coalesce(x(c) < y(c), x(c).isNull() & y(c).isNotNull())
        out = before | (x(c).eqNullSafe(y(c)) & out)
    before = F.coalesce(x(newest_by) > y(newest_by), x(newest_by).isNotNull() & y(newest_by).isNull())
    return before | (x(newest_by).eqNullSafe(y(newest_by)) & out)


#: A row's key as one struct: never NULL itself, and structs with NULLs in the same places are equal.
KEY = "_key"


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(KEY, F.struct(*keys))


def changed_rows(new: DataFrame, old: DataFrame | None, keys: Sequence[str], newest_by: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """What new rows change in a table that keeps the newest row of each key.

    ``old`` holds at most one row a key; there is none for an empty table, and then nothing is joined. For each key
    whose newest row is new, that row comes with ``sign`` 1 and the one it replaces, if any, with -1. Keys that keep
    their row come not at all; NULL is a key like any other. Both sides meet by :data:`KEY`: rows that a window over
    it has shuffled are joined where they are.
    """
    if old is None:
        return latest_by_key(new, keys, newest_by, tiebreak).withColumn("sign", F.lit(1))
    names = new.columns
    left = latest_by_key(keyed(new, keys), [KEY], newest_by, tiebreak).select(KEY, F.struct(*names).alias("new"))
    right = (old if KEY in old.columns else keyed(old, keys)).select(KEY, F.struct(*names).alias("old"))
    wins = left.join(right, KEY, "left").where(F.col("old").isNull() | newer("new", "old", newest_by, tiebreak))
    both = F.array(F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")), F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")))
    return wins.select(F.explode(F.filter(both, lambda c: c["row"].isNotNull())).alias("c")).select("c.row.*", "c.sign")


def quality_predicates(rules: TripRules = TripRules()) -> dict[str, Column]:
    """Named acceptance rules. A NULL outcome counts as a rejection."""
    pickup = F.col("tpep_pickup_datetime")
    return {
        "passenger_count_positive": F.col("passenger_count") > 0,
        "trip_distance_positive": F.col("trip_distance") > 0,
        "fare_amount_positive": F.col("fare_amount") > 0,
        "dropoff_after_pickup": F.col("tpep_dropoff_datetime") > pickup,
        "rate_code_known": F.col("rate_code_id") != rules.unknown_rate_code,
        "pickup_year_plausible": F.year(pickup).between(rules.first_year, rules.last_year),
        "pickup_in_batch_month": in_month(pickup, "_batch_id"),
    }


def accepted(rules: TripRules = TripRules()) -> Column:
    return reduce(lambda a, b: a & b, quality_predicates(rules).values())


def quality_filter(df: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    return df.filter(accepted(rules))


def build_silver(typed: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """De-duplicate first, then filter: a bad newest copy removes the trip."""
    latest = latest_by_key(typed, rules.dedup_keys, "_ingested_at", rules.dedup_tiebreak)
    return quality_filter(latest, rules)


def bad_row_report(typed: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Rejected rows per rule, counted in one pass over the de-duplicated rows."""
    latest = latest_by_key(typed, rules.dedup_keys, "_ingested_at", rules.dedup_tiebreak)
    rules_by_name = quality_predicates(rules)
    accepted = F.lit(True)
    counts = [F.count(F.lit(1)).alias("rows_checked")]
    for name, predicate in rules_by_name.items():
        ok = F.coalesce(predicate, F.lit(False))
        counts.append(F.count_if(~ok).alias(name))
        accepted = accepted & ok
    counts.append(F.count_if(~accepted).alias("any_rule"))
    wide = latest.agg(*counts)
    names = [*rules_by_name, "any_rule"]
    return wide.unpivot("rows_checked", names, "rule", "rejected_rows")
