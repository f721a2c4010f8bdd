"""Number helpers built from Spark column functions (all inside code generation)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up_sql(x: str, digits: int) -> str:
    """Round half away from zero on the binary value, as a double; SQL text.

    ``round`` goes through decimal text, which differs from other engines near ties;
    scaling and ``floor`` gives one answer everywhere. Adding 0 turns -0 into 0.
    """
    s = f"{10**digits}D"
    return f"(floor(abs({x}) * {s} + 0.5D) * signum({x}) / {s} + 0.0D)"


#: Bits that the exact sums add up apart: with 20, both halves hold for 8e12 rows and totals up to 9e24 units.
_LOW_BITS = 20


def exact_sum_sql(x: str, digits: int = 4) -> str:
    """Sum of a double that does not depend on row order; SQL text.

    Each value is scaled to an integer with ``digits`` decimals (money and distance have fewer), so partial
    sums on any number of executors add up to the same bits. The integers' high and low bits are two bigint
    sums, which only the finished group joins to a decimal: long totals cost no decimal per row.
    """
    s = f"{10**digits}D"
    units = f"floor(({x}) * {s} + 0.5D)"
    high = f"CAST(sum(shiftright({units}, {_LOW_BITS})) AS DECIMAL(20,0))"
    low = f"sum({units} & {2**_LOW_BITS - 1}L)"
    return f"(CAST({high} * {2**_LOW_BITS} + {low} AS DOUBLE) / {s})"


def exact_parts_sql(x: str, digits: int, sign: str) -> tuple[str, str]:
    """High and low bigint sums of :func:`exact_sum_sql`, each row counted ``sign`` times (1 or -1); SQL text.

    Both are plain sums, so parts of groups add up, and a row is taken back by counting it with -1.
    """
    units = f"floor(({x}) * {10**digits}D + 0.5D)"
    return f"sum({sign} * shiftright({units}, {_LOW_BITS}))", f"sum({sign} * ({units} & {2**_LOW_BITS - 1}L))"


def exact_joined_sql(high: str, low: str, digits: int = 4) -> str:
    """The double that a high and a low sum stand for; SQL text."""
    return f"(CAST(CAST({high} AS DECIMAL(20,0)) * {2**_LOW_BITS} + {low} AS DOUBLE) / {10**digits}D)"


def ratio_sql(a: str, b: str) -> str:
    """``a / b`` as a double, NULL when ``b`` is zero or NULL; SQL text."""
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


def round_half_up(c: Column | str, digits: int) -> Column:
    """Column form of :func:`half_up_sql`."""
    if isinstance(c, str):
        return F.expr(half_up_sql(c, digits))
    scale = F.lit(float(10**digits))
    return F.floor(F.abs(c) * scale + F.lit(0.5)) * F.signum(c) / scale + F.lit(0.0)


def round_half_even(c: Column | str, digits: int) -> Column:
    """Round half to even on the binary value, the array-library convention."""
    scale = F.lit(float(10**digits))
    return F.rint(col_of(c) * scale) / scale


def exact_sum(c: Column | str, digits: int = 4) -> Column:
    """Column form of :func:`exact_sum_sql`."""
    if isinstance(c, str):
        return F.expr(exact_sum_sql(c, digits))
    scale = float(10**digits)
    units = F.floor(c * F.lit(scale) + F.lit(0.5))
    high = F.sum(F.shiftright(units, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit(2**_LOW_BITS - 1).cast("bigint")))
    return (high * F.lit(2**_LOW_BITS) + low).cast("double") / F.lit(scale)


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` as a double, NULL when ``b`` is zero or NULL."""
    return F.try_divide(col_of(a).cast("double"), col_of(b).cast("double"))


def clip_at_zero(c: Column | str) -> Column:
    return F.greatest(col_of(c), F.lit(0.0))


def surrogate_key(*parts: Column) -> Column:
    """MD5 over '|'-joined text; NULL as soon as one part is NULL.

    ``concat`` (unlike ``concat_ws``) already yields NULL for a NULL part.
    """
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(p.cast("string"))
    return F.md5(F.concat(*pieces))
