"""License scans with DataFrame operations only.

Templates are notices, SPDX tags and the whole texts in ``license_texts``, these in overlapping windows of
``BODY`` words. A text is read in windows over all its words: around each anchor (a notice's first needed word) all
windows of that notice's length that hold its needed words, and ``BODY`` words at every half window. Words of the
templates are numbered and the rest of a text is one number, so windows are small arrays of whole numbers, and all work
on them stays in their row. Windows and templates are compared by the cosine of sparse TF-IDF vectors; frequencies are
counted over the corpus and the templates, and each word of no template counts as an unseen one of its own. A
whole text's window is compared with a template only if it shares a telling word of it (by Cauchy-Schwarz the others
can't reach ``LEAST``) and words enough. A file that is mostly licence, or is named like a licence file, licenses its
directory; files without a licence of their own take that of their nearest ancestor directory, by joins on paths.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Fixed values: (licence, words that a window must hold, notice or tag).
NOTICES = (
    ("MIT", "mit", "released under the MIT license"),
    ("MIT", "mit", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "apache", "licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "apache license", "Apache License"),
    ("Apache-2.0", "apache", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "gnu general 3", "this work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "gpl 3", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "gnu lesser 3", "licensed under the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "lgpl 3", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    ("BSD-3-Clause", "bsd 3", "distributed under the BSD 3-clause license"),
    ("BSD-3-Clause", "bsd 3", "SPDX-License-Identifier: BSD-3-Clause"),
    ("MPL-2.0", "mozilla 2", "subject to the terms of the Mozilla Public License, version 2.0"),
    ("MPL-2.0", "mpl 2", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY-4.0", "cc by 4", "licensed under CC BY 4.0"),
    ("CC-BY-4.0", "creative commons attribution 4", "licensed under Creative Commons Attribution 4.0 International"),
    ("CC-BY-4.0", "cc by 4", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-NC-4.0", "cc by nc 4", "licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "cc by nc 4", "SPDX-License-Identifier: CC-BY-NC-4.0"),
)
TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")
#: Words of a window of whole licence texts.
BODY = 24
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying)[^/]*$"
LEAST = 0.6
#: Cells of the word table.
CELLS = 1 << 10
TOKEN = "[a-z0-9]+"


def _words(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


def _templates() -> list[tuple[str, list[str], list[str]]]:
    """(licence, needed words, words) of all notices, tags and windows of whole texts."""
    out = [(name, needs.split(), _words(text)) for name, needs, text in NOTICES]
    for file in sorted(os.listdir(TEXTS)):
        with open(os.path.join(TEXTS, file), encoding="utf-8") as f:
            words = _words(f.read())
        out += [(file.removesuffix(".txt"), [], words[i : i + BODY]) for i in range(0, max(1, len(words) - BODY // 2), BODY // 2)]
    return out


def _rarity(tokens: DataFrame, templates: list[tuple[str, list[str], list[str]]]) -> tuple[dict[str, float], float]:
    """Inverse frequency of the templates' words over corpus and templates, and that of an unseen word."""
    common = Counter(w for _, _, t in templates for w in set(t))
    count = tokens.count() + len(templates)
    words = tokens.sparkSession.createDataFrame([(w,) for w in sorted(common)], "w string")
    each = tokens.select(F.explode(F.array_distinct("tokens")).alias("w")).join(F.broadcast(words), "w")
    for r in each.groupBy("w").agg(F.count("*").alias("n")).collect():
        common[r["w"]] += r["n"]
    return {w: math.log((1 + count) / (1 + n)) + 1 for w, n in common.items()}, math.log(1 + count) + 1


def _vectors(templates: list[tuple[str, list[str], list[str]]], rarity: dict[str, float], least: float) -> list[tuple[dict[str, float], set[str]]]:
    """Unit vectors of the templates, each with its telling words: without one, no window reaches ``least``.

    The most frequent words whose squares stay below that of ``least`` are not telling, all others are.
    """
    out = []
    for _, _, words in templates:
        v = {w: c * rarity[w] for w, c in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        unit, telling, rest = {w: x / norm for w, x in v.items()}, set(), 0.0
        for w, x in sorted(unit.items(), key=lambda e: (rarity[e[0]], e[0])):
            rest += x * x
            if rest >= least * least:
                telling.add(w)
        out.append((unit, telling))
    return out


def _numbers(words: list[str]) -> Callable[[Column], Column]:
    """A look-up of a word's place in ``words``, -1 for others, by a table of checksums."""
    cells: list[list[dict]] = [[] for _ in range(CELLS)]
    for i, w in enumerate(words):
        cells[zlib.crc32(w.encode()) % CELLS].append({"w": w, "i": i})
    table = F.from_json(F.lit(json.dumps(cells)), "array<array<struct<w:string,i:int>>>")

    def of(word: Column) -> Column:
        cell = F.get(table, (F.crc32(word.cast("binary")) % CELLS).cast("int"))
        return F.coalesce(F.get(F.filter(cell, lambda e: e["w"] == word), F.lit(0))["i"], F.lit(-1))

    return of


def _times(ids: Column, y: Column) -> Column:
    return F.size(F.filter(ids, lambda z: z == y))


def scan_licenses(files: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: Column | None = None, least: float = LEAST) -> DataFrame:
    """Per row: id, path, license, origin (own, inherited or null), cosine of its own best window.

    Every word of the whole text is looked at. A null text has no licence of its own; ties between templates go to
    the later name. Repeated rows are judged each. If a directory has several licence files, the surest wins. A null
    path counts as a file of the root. An empty table gives an empty result.
    """
    where = F.coalesce(path if path is not None else F.concat_ws("/", F.col("source"), F.col(id_col).cast("string")), F.lit(""))
    lowered = F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = F.regexp_extract_all(lowered, F.lit(TOKEN), F.lit(0))
    templates = _templates()
    rarity, unseen = _rarity(files.select(tokens.alias("tokens")), templates)
    vectors = _vectors(templates, rarity, least)
    bodies = {t for t, (_, needs, _) in enumerate(templates) if not needs}
    telling = set().union(*(vectors[t][1] for t in bodies))
    words = sorted(telling) + sorted(set(rarity) - telling)
    number = {w: i for i, w in enumerate(words)}
    # Notices by the number of their first needed word.
    notices: dict[int, list[dict]] = {}
    for t, (_, needs, own) in enumerate(templates):
        if needs:
            notices.setdefault(number[needs[0]], []).append({"t": t, "size": len(own), "needs": [number[w] for w in needs]})
    begun = F.from_json(F.lit(json.dumps([notices.get(i, []) for i in range(len(words))])), "array<array<struct<t:int,size:int,needs:array<int>>>>")
    anchors = F.lit(sorted(words[i] for i in notices))
    weights = F.lit([rarity[w] for w in words])

    unit = "array<struct<at:int,size:int,t:int,ids:array<int>>>"
    shape = lambda at, size, t: F.struct(at.alias("at"), size.alias("size"), t.alias("t"), F.slice("ids", at + 1, size).alias("ids"))

    def around(i: Column) -> Column:
        """All windows of the notices that begin with the word at place i."""
        own = F.get(begun, F.get("ids", i))
        first = lambda n: F.greatest(i - n["size"] + 1, F.lit(0))
        last = lambda n: F.least(i, F.greatest(F.col("long") - n["size"], F.lit(0)))
        each = F.transform(own, lambda n: F.filter(F.transform(F.sequence(first(n), F.greatest(first(n), last(n))), lambda at: shape(at, n["size"], n["t"])), lambda u: F.size(F.array_except(n["needs"], u["ids"])) == 0))
        return F.flatten(each)

    found = F.filter(F.sequence(F.lit(0), F.col("long") - 1), lambda i: F.coalesce(F.size(F.get(begun, F.when(F.get("ids", i) >= 0, F.get("ids", i)))), F.lit(0)) > 0)
    short = F.when(F.arrays_overlap("tokens", anchors), F.flatten(F.transform(found, around))).otherwise(F.array().cast(unit))
    starts = F.sequence(F.lit(0), F.greatest(F.col("long") - 1 - BODY // 2, F.lit(0)), F.lit(BODY // 2))
    # A few numbers are no part of a whole text.
    enough = lambda u: F.exists(u["ids"], lambda y: (y >= 0) & (y < len(telling))) & (F.size(F.filter(u["ids"], lambda y: y >= 0)) >= BODY // 4)
    whole = F.filter(F.transform(starts, lambda at: shape(at, F.lit(BODY), F.lit(-1))), enough)
    long_ones = F.when(F.arrays_overlap("tokens", F.lit(sorted(telling))), whole).otherwise(F.array().cast(unit))
    rows = files.select(F.col(id_col).alias("id"), where.alias("path"), tokens.alias("tokens")).withColumn("long", F.size("tokens"))
    met = F.arrays_overlap("tokens", F.lit(sorted(telling | {words[i] for i in notices})))
    rows = rows.withColumn("ids", F.when(met, F.transform("tokens", _numbers(words))))
    rows = rows.withColumn("units", F.when(F.col("ids").isNotNull(), F.concat(short, long_ones))).withColumn("row", F.monotonically_increasing_id())
    rows = materialise(rows.select("row", "id", "path", "long", "units"), "license-windows")

    units = rows.where(F.size("units") > 0).select("row", "long", F.explode("units").alias("u")).select("row", "u.at", F.least(F.col("u.size"), F.col("long") - F.col("u.at")).alias("size"), "u.t", "u.ids")
    seen = F.filter("ids", lambda y: y >= 0)
    square = F.aggregate(F.array_distinct(seen), F.lit(0.0), lambda a, y: a + F.pow(_times(F.col("ids"), y) * F.get(weights, y), F.lit(2.0)))
    units = units.withColumn("square", square + (F.col("size") - F.size(seen)) * unseen**2)
    # A whole text's window goes to the templates that share a telling word.
    spark = files.sparkSession
    shared = F.from_json(F.lit(json.dumps([[t for t in sorted(bodies) if w in vectors[t][1]] for w in words[: len(telling)]])), "array<array<int>>")
    of = F.array_distinct(F.flatten(F.transform(F.array_distinct(F.filter("ids", lambda y: (y >= 0) & (y < len(telling)))), lambda y: F.get(shared, y))))
    asked = units.where("t < 0").drop("t").withColumn("t", F.explode(of))
    pairs = units.where("t >= 0").select("row", "at", "size", "square", "ids", "t").union(asked.select("row", "at", "size", "square", "ids", "t"))
    sides = [(t, templates[t][0], t in bodies, [(number[w], x * rarity[w]) for w, x in sorted(v.items())]) for t, (v, _) in enumerate(vectors)]
    sides = spark.createDataFrame(sides, "t int, license string, body boolean, v array<struct<y:int,x:double>>")
    pairs = pairs.join(F.broadcast(sides), "t")
    pairs = pairs.where(~F.col("body") | (F.size(F.filter("v", lambda e: F.array_contains("ids", e["y"]))) >= BODY // 4))
    dot = F.aggregate("v", F.lit(0.0), lambda a, e: a + _times(F.col("ids"), e["y"]) * e["x"])
    scores = pairs.select("row", "at", "size", F.round(dot / F.sqrt("square"), 6).alias("cosine"), "license")
    hit = F.when(F.col("cosine") >= least, F.sequence(F.col("at"), F.col("at") + F.col("size") - 1))
    best = scores.groupBy("row").agg(F.max(F.struct("cosine", "license")).alias("best"), F.size(F.array_distinct(F.flatten(F.collect_list(hit)))).alias("covered"))
    rows = rows.drop("units").join(best, "row", "left").withColumn("own", F.when(F.col("best.cosine") >= least, F.col("best.license")))
    is_file = F.col("own").isNotNull() & ((2 * F.col("covered") >= F.col("long")) | F.rlike("path", F.lit(FILE_NAME)))
    rows = rows.select("id", "path", F.regexp_replace("path", "/?[^/]*$", "").alias("dir"), "own", F.col("best.cosine").alias("cosine"), F.coalesce(is_file, F.lit(False)).alias("is_file"))
    rows = materialise(rows, "licenses")
    licensed = rows.where("is_file").groupBy(F.col("dir").alias("ancestor")).agg(F.max(F.struct("cosine", "own"))["own"].alias("given"))
    parts = F.split("dir", "/")
    steps = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("ancestor")))
    climbs = rows.where("own is null").select("dir").distinct().select("dir", F.explode(steps).alias("s")).select("dir", "s.depth", "s.ancestor")
    nearest = climbs.join(licensed, "ancestor").groupBy("dir").agg(F.max_by("given", "depth").alias("given"))
    out = rows.join(nearest, "dir", "left")
    return out.select(
        F.col("id").alias(id_col), "path", F.coalesce("own", "given").alias("license"), F.when(F.col("own").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited").alias("origin"), F.coalesce("cosine", F.lit(0.0)).alias("cosine")
    )
