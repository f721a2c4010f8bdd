"""URL filters with DataFrame and ML operations only: fixed rules first, mined association rules for the rest.

A URL becomes a set of tokens: labels of the host, segments of the path (digits folded), names of query
parameters. FP-growth mines token combinations of labelled URLs together with the label; combinations
that imply a label with enough confidence and support become rules, except where a part of them already
implies it as surely. Rules are looked up through an inverted index by their rarest token.
"""

from __future__ import annotations

from collections import Counter

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: (verdict, host, path) of the fixed rules; a rule fits its host and all subdomains and paths that start with its own.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
SUPPORT = 0.002
CONFIDENCE = 0.9
#: Bound of the labelled URLs that are mined; beyond it they are chosen by hash.
MOST_LABELLED = 100_000
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lowered; empty for null or without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL, sorted."""
    fold = lambda part: F.regexp_replace(part, "[0-9]+", "0")
    kind = lambda mark, parts: F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(mark), fold(p)))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    return F.array_sort(F.array_distinct(F.concat(kind("h:", F.split(host, r"\.")), kind("p:", F.split(path, "/")), kind("q:", names))))


def mine(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> list[tuple[frozenset[str], str, float, float]]:
    """(tokens, verdict, confidence, support) of the mined rules; ``labelled`` has tokens and verdict.

    Of all rules that pass, those go of which a part implies the same verdict at least as surely; the others are
    the model, and only they reach the driver.
    """
    count = labelled.count()
    if not count:
        return []
    if count > MOST_LABELLED:
        share = int((1 << 20) * MOST_LABELLED / count)
        labelled = labelled.where(F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < share)
    items = labelled.select(F.concat("tokens", F.array(F.concat(F.lit("verdict="), "verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items)
    found = model.associationRules.where(F.size("consequent") == 1).where(F.col("consequent")[0].startswith("verdict="))
    verdict = F.regexp_replace(F.col("consequent")[0], "^verdict=", "")
    found = materialise(found.select(F.array_sort("antecedent").alias("own"), verdict.alias("verdict"), "confidence", "support"), "url-rules")
    kept = found.join(_redundant(found), ["own", "verdict"], "left_anti").collect()
    rules = [(frozenset(r["own"]), r["verdict"], float(r["confidence"]), float(r["support"])) for r in kept]
    return sorted(rules, key=lambda r: (len(r[0]), -r[2], sorted(r[0]), r[1]))


def _redundant(found: DataFrame) -> DataFrame:
    """(own, verdict) of rules with a smaller part that implies the verdict as surely; parts are met by their rarest token."""
    tokens = found.select("own", "verdict", "confidence", F.explode("own").alias("token"))
    uses = tokens.groupBy("token").agg(F.count("*").alias("uses"))
    parts = tokens.join(uses, "token").groupBy("own", "verdict", "confidence").agg(F.min_by("token", F.struct("uses", "token")).alias("token"))
    parts = parts.select("token", "verdict", F.col("own").alias("part"), F.col("confidence").alias("sure"))
    pairs = tokens.join(parts, ["token", "verdict"]).where((F.size("part") < F.size("own")) & (F.col("sure") >= F.col("confidence")))
    return pairs.where(F.size(F.array_except("part", "own")) == 0).select("own", "verdict").distinct()


def mined_verdict(tokens: Column, rules: list[tuple[frozenset[str], str, float, float]], default: str = DEFAULT) -> Column:
    """The verdict of the surest rule whose tokens all occur; ties go to the larger support, then to block."""
    if not rules:
        return F.lit(default)
    uses = Counter(t for own, *_ in rules for t in own)
    index: dict[str, list[Column]] = {}
    for own, verdict, confidence, support in rules:
        rarest = min(own, key=lambda t: (uses[t], t))
        index.setdefault(rarest, []).append(
            F.struct(
                F.lit(confidence).alias("confidence"), F.lit(support).alias("support"), F.lit(verdict).alias("verdict"), F.array(*[F.lit(t) for t in sorted(own)]).alias("tokens")
            )
        )
    posting = F.create_map(*[x for t, entries in sorted(index.items()) for x in (F.lit(t), F.array(*entries))])
    hits = F.flatten(F.filter(F.transform(tokens, lambda t: F.element_at(posting, t)), lambda e: e.isNotNull()))
    full = F.filter(hits, lambda r: F.size(F.array_except(r["tokens"], tokens)) == 0)
    return F.coalesce(F.array_max(F.transform(full, lambda r: F.struct(r["confidence"], r["support"], r["verdict"])))["verdict"], F.lit(default))


def judge_urls(pages: DataFrame, labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """Per row: id, host, path, rule, verdict.

    ``labels`` (url, verdict) teach the mined rules; by default they are the URLs that the fixed rules decide.
    A null URL, or one without ://, has empty host, path and tokens and gets the default verdict. A repeated row
    is judged as often as it comes. Other columns are not read. An empty table gives an empty result.
    """
    h, p = host(F.col("url")), path(F.col("url"))
    split = lambda df: df.withColumn("host", h).withColumn("path", p).withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))
    rows = split(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))).withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), rules))
    taught = rows.where(F.col("fixed").isNotNull()).select("url", "tokens", "fixed.verdict") if labels is None else split(labels.select("url", "verdict")).where("verdict is not null")
    learned = mine(taught.select("url", "tokens", "verdict"))
    return rows.select(
        F.col("id").alias(id_col), "host", "path", F.col("fixed.rule").alias("rule"), F.coalesce(F.col("fixed.verdict"), mined_verdict(F.col("tokens"), learned)).alias("verdict")
    )
