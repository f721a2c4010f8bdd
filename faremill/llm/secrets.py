"""Secret scans with DataFrame operations only.

Fixed patterns give the base spans. Beyond them, long tokens of an encoding alphabet are put to a battery
of randomness tests: chi-squared uniformity over the inferred alphabet, a runs test and a lag-1 serial
correlation. A token that passes all three is a candidate. Its evidence is the likelihood ratio of the
uniform model to ordinary text: under ordinary text the expected ratio is at most one, so it is an
e-value, and it grows with the token's length. The e-BH procedure over all candidates of a length class
holds the share of false discoveries at ``FALSE_SHARE``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Kind, pattern, group whose length counts, least length; in the order of kinds at the same start.
BASE_KINDS = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Cheap necessary conditions, so that texts without a match are scanned once.
HINTS = {"hex": r"[0-9a-f]{24}"}
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-="
#: Letters per thousand of ordinary Latin-script text, a-z (fixed values); capitals, digits and signs share the rest evenly.
LETTERS = (75, 14, 30, 38, 115, 16, 19, 45, 70, 3, 7, 38, 26, 68, 70, 20, 3, 62, 62, 80, 30, 11, 15, 4, 14, 5)
LETTER_SHARE = 0.94
Z_LIMIT = 4.0
FALSE_SHARE = 0.05
LENGTH_CLASSES = (20, 24, 32, 48, 64, 128)
MOST_BITS = 400


def _ordinary_log2() -> list[float]:
    rest = math.log2((1 - LETTER_SHARE) / (len(ALPHABET) - 26))
    return [math.log2(LETTER_SHARE * x / sum(LETTERS)) for x in LETTERS] + [rest] * (len(ALPHABET) - 26)


def _matches(text: Column, pattern: str, group: int, least: int, hint: str | None) -> Column:
    """Spans (start, end) in code points of leftmost non-overlapping matches whose group is long enough."""
    whole, part = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.arrays_zip(
        F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole)), F.length).alias("gap"),
        F.transform(whole, F.length).alias("long"),
        F.transform(part, F.length).alias("part"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    walk = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + x["long"]).alias("at"),
            F.when(x["part"] >= least, F.concat(a["spans"], F.array(F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["long"]).alias("end"))))).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return F.when(F.rlike(text, F.lit(hint or pattern)), walk).otherwise(none)


def _battery(token: Column) -> Column:
    """Struct of a token: whether it passes the tests, and log2 of its e-value."""
    size = F.when(F.rlike(token, F.lit("^([0-9a-f]+|[0-9A-F]+)$")), 16).when(F.rlike(token, F.lit("^[A-Z2-7]+=*$")), 32).when(F.rlike(token, F.lit("^([a-z0-9]+|[A-Z0-9]+)$")), 36).otherwise(64)
    chars = F.filter(F.split(token, ""), lambda c: c != "")
    order = F.when(size == 16, F.lit("0123456789abcdef")).when(size == 32, F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")).when(size == 36, F.lit("abcdefghijklmnopqrstuvwxyz0123456789")).otherwise(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"))
    lowered = F.when(size.isin(16, 36), F.lower(token)).otherwise(token)
    ranks = F.transform(F.filter(F.split(lowered, ""), lambda c: c != ""), lambda c: F.least(F.greatest(F.instr(order, c) - 1, F.lit(0)), size - 1).cast("double"))
    bits = F.aggregate(
        F.transform(chars, lambda c: F.element_at(F.lit(_ordinary_log2()), F.instr(F.lit(ALPHABET), c))), F.lit(0.0), lambda a, x: a + x
    )
    facts = F.struct(token.alias("token"), size.cast("double").alias("k"), F.length(token).cast("double").alias("n"), ranks.alias("x"), bits.alias("ordinary"))

    def judge(f: Column) -> Column:
        n, k, x = f["n"], f["k"], f["x"]
        squares = F.aggregate(F.array_distinct(x), F.lit(0.0), lambda a, v: a + F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), F.lit(2.0)))
        chi = (k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        mean = F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / n
        spread = F.aggregate(x, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
        pairs = F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), lambda u, v: F.struct(u.alias("u"), v.alias("v")))
        serial = F.when(spread > 0, F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["u"] - mean) * (p["v"] - mean)) / spread * F.sqrt(n)).otherwise(F.lit(99.0))
        above = F.aggregate(x, F.lit(0.0), lambda a, v: a + F.when(v >= k / 2, 1.0).otherwise(0.0))
        runs = F.aggregate(pairs, F.lit(1.0), lambda a, p: a + F.when((p["u"] >= k / 2) != (p["v"] >= k / 2), 1.0).otherwise(0.0))
        expected = 2 * above * (n - above) / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        runs_z = F.when(variance > 0, (runs - expected) / F.sqrt(variance)).otherwise(F.lit(99.0))
        passes = (chi <= Z_LIMIT) & (F.abs(runs_z) <= Z_LIMIT) & (F.abs(serial) <= Z_LIMIT) & ~F.rlike(f["token"], F.lit("^[0-9]+$"))
        return F.struct(passes.alias("passes"), (-n * F.log2(k) - f["ordinary"]).alias("bits"))

    # A one-element array names the shared facts, so they are worked out once.
    return F.transform(F.array(facts), judge)[0]


def _length_class(length: Column) -> Column:
    out = F.lit(LENGTH_CLASSES[0])
    for c in LENGTH_CLASSES[1:]:
        out = F.when(length >= c, F.lit(c)).otherwise(out)
    return out


def discoveries(candidates: DataFrame, share: float = FALSE_SHARE) -> dict[int, int]:
    """Length class -> least whole bits of evidence (e-BH); at most classes x ``MOST_BITS`` counts reach the driver."""
    counts = candidates.groupBy("length_class", "bits").count().collect()
    least: dict[int, int] = {}
    for c in LENGTH_CLASSES:
        own = {r["bits"]: r["count"] for r in counts if r["length_class"] == c}
        every, above = sum(own.values()), 0
        for bits in sorted(own, reverse=True):
            above += own[bits]
            if bits >= math.log2(every / (above * share)):
                least[c] = bits
    return least


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), share: float = FALSE_SHARE) -> DataFrame:
    """Per document: id, n_assign, n_access, n_hex, base_sha256, spans, found (the spans as an array); and ``carry``.

    Spans are in code points, end exclusive, sorted by start and kind; the battery's are of kind random and
    never overlap base ones. A null text is empty: no spans, and the hash of the empty string. Rows of a
    repeated id are separate documents. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("id"),
        *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)],
        *[_matches(text, pattern, group, least, HINTS.get(kind)).alias(kind) for kind, pattern, group, least in BASE_KINDS],
        F.when(F.rlike(text, F.lit(TOKEN)), text).otherwise(F.lit("")).alias("text"),
    )
    tokens = F.arrays_zip(_matches(F.col("text"), TOKEN, 0, 1, None).alias("span"), F.regexp_extract_all(F.col("text"), F.lit(TOKEN), F.lit(0)).alias("token"))
    base = F.concat(*[F.col(kind) for kind, *_ in BASE_KINDS])
    loose = F.filter(tokens, lambda t: ~F.exists(F.col("base"), lambda b: (b["start"] < t["span"]["end"]) & (t["span"]["start"] < b["end"])))
    judged = F.transform(
        loose,
        lambda t: F.struct(t["span"]["start"].alias("start"), t["span"]["end"].alias("end"), _battery(t["token"]).alias("test")),
    )
    tried = F.transform(
        F.filter(judged, lambda t: t["test"]["passes"]),
        lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.greatest(F.lit(-1), F.least(F.lit(MOST_BITS), F.floor(t["test"]["bits"]))).cast("int").alias("bits")),
    )
    rows = found.withColumn("base", base).withColumn("tried", tried).drop("base", "text")
    rows = materialise(rows, "secret-spans")
    least = discoveries(
        rows.select(F.explode("tried").alias("t")).select(_length_class(F.col("t.end") - F.col("t.start")).alias("length_class"), F.col("t.bits").alias("bits")), share
    )
    enough = lambda t: F.coalesce(F.element_at(F.lit([int(least.get(c, MOST_BITS + 1)) for c in LENGTH_CLASSES]), F.array_position(F.lit(list(LENGTH_CLASSES)), _length_class(t["end"] - t["start"])).cast("int")), F.lit(MOST_BITS + 1))
    span = lambda kind, place: lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    base_spans = F.array_sort(F.concat(*[F.transform(kind, span(kind, i)) for i, (kind, *_) in enumerate(BASE_KINDS)]))
    random_spans = F.transform(F.filter("tried", lambda t: t["bits"] >= enough(t)), span("random", len(BASE_KINDS)))
    text_of = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    every = F.array_sort(F.concat(base_spans, random_spans))
    return rows.select(
        F.col("id").alias(id_col),
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind, *_ in BASE_KINDS],
        F.sha2(text_of(base_spans), 256).alias("base_sha256"),
        text_of(every).alias("spans"),
        every.alias("found"),
        *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)],
    )
