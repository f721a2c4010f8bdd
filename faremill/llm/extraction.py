"""Main text of HTML pages: repeats across a host's pages, with markup as a help beside it.

Blocks in menus, headers, footers, sidebars, notices, adverts, forms and comments are left out. Of all others,
those of articles included, the host decides. Runs of ``RUN`` tokens found on at least ``LEAST_PAGES`` distinct pages
of a host and on a share of ``SHARE`` of them are its boilerplate, and so is what stands around them on as many pages,
or wherever they occur. These strings and a host's pages are concatenated and their suffixes sorted: the common
prefix (LCP) of a page's suffix and its nearest string says how many tokens boilerplate covers from there. Blocks
that it covers for the most part go; unique ones stay, and so does what a host repeats on few of its pages. Where the
marked regions hold at least half of what stays, they are the text, all of them; elsewhere the prose outside belongs
to it. A block in a region that is shorter than ``RUN`` tokens is no long substring and stays.

Runs are counted across tasks by anchors: of every ``WINDOW`` neighbouring places of a block, the one of least
hash. Equal substrings of ``RUN + WINDOW - 1`` tokens, and equal blocks, have the same anchors wherever they stand, so
none is missed, while few places are shuffled. Pages that hold a repeated anchor tell its surroundings, up to the
neighbouring anchors; in sorted order the first and the last of them share what all share. The host's strings are then
sent to its pages, where blocks with a repeated anchor are matched. No task gathers a host: anchors and surroundings
are counted in two steps. Copies of a page count as one page.
"""

from __future__ import annotations

import collections
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import html_blocks, wordhash
from .urlfilter import host

#: Tokens of a long substring; places that share an anchor.
RUN, WINDOW = 8, 13
#: Tokens of an anchor's run and of the places between it and its neighbours, at most.
REACH = RUN + 2 * (WINDOW - 1)
#: What makes a run boilerplate: distinct pages of the host, and their share of them.
LEAST_PAGES, SHARE = 3, 0.3
COVERED = 0.5
LINKED = 0.6
PAGES = 512
#: Parts blocks in a stored page; white space, so no block holds it.
_PART = "\x1f"


def _chosen(blocks: list[str], inside: list[bool], linked: list[bool], fresh: list[bool]) -> list[str]:
    """The fresh blocks of the marked regions if these hold most of the fresh prose, else all fresh prose.

    A page without a fresh block repeats as a whole: a copy of another page, not boilerplate.
    """
    for stays in (fresh, [True] * len(blocks)):
        region = [t for t, i, s in zip(blocks, inside, stays, strict=True) if s and i]
        prose = [t for t, i, l, s in zip(blocks, inside, linked, stays, strict=True) if s and (i or not l)]
        if prose:
            return region if 2 * sum(map(len, region)) >= sum(map(len, prose)) else prose
    return []


def suffix_array(tokens: np.ndarray, owner: np.ndarray, depth: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of concatenated blocks in lexicographic order of their first ``depth`` tokens, and the LCP of each with the one before.

    ``owner`` says which block a token is of; a suffix ends with its block. Ranks are doubled until they tell
    ``depth`` tokens apart; the common prefixes of neighbours are read off the ranks, the longest steps first.
    """
    n = len(tokens)
    left = np.searchsorted(owner, owner, "right") - np.arange(n)
    ranks, width = [np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1], 1
    while 2 * width <= depth:
        after = np.zeros(n, np.int64)
        inside = np.flatnonzero(left > width)
        after[inside] = ranks[-1][inside + width]
        ranks.append(np.unique(ranks[-1] * (n + 1) + after, return_inverse=True)[1].astype(np.int64) + 1)
        width *= 2
    last = np.zeros(n, np.int64)
    inside = np.flatnonzero(left > depth - width)
    last[inside] = ranks[-1][inside + depth - width]
    order = np.lexsort((last, ranks[-1]))
    lcp, a, b = np.zeros(n, np.int64), order[1:].copy(), order[:-1].copy()
    for rank in ranks[::-1]:
        for _ in range(2):
            same = (np.minimum(left[order[1:]], left[order[:-1]]) - lcp[1:] >= width) & (lcp[1:] + width <= depth)
            same[same] = rank[a[same]] == rank[b[same]]
            lcp[1:][same] += width
            a[same] = np.minimum(a[same] + width, n - 1)
            b[same] = np.minimum(b[same] + width, n - 1)
        width //= 2
    return order, lcp


def anchors(tokens: np.ndarray, owner: np.ndarray, size: int = RUN, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places that stand for their neighbourhood, in order, and a hash of the ``size`` tokens that follow each.

    A place has ``size`` tokens left in its block; the start of a shorter block counts for the whole of it. In each
    ``window`` of places of a block, or all of them if they are fewer, the one of least hash is an anchor.
    """
    n = len(tokens)
    prefix, full = np.zeros(n, np.uint64), np.ones(n, bool)
    for j in range(size):
        inside = np.zeros(n, bool)
        reach = max(n - j, 0)
        inside[:reach] = owner[:reach] == owner[j:] if j else True
        ahead = np.zeros(n, np.uint64)
        ahead[:reach] = tokens[j:]
        prefix += np.where(inside, ahead, np.uint64(1)) * wordhash._PLACE[j]
        full &= inside
    starts = np.ones(n, bool)
    starts[1:] = owner[1:] != owner[:-1]
    places = np.flatnonzero(full | starts)
    keys = wordhash.mix(prefix[places])
    of = owner[places]
    first = np.searchsorted(of, of)
    count = np.searchsorted(of, of, "right") - first
    least = np.arange(len(places))
    for j in range(1, window):
        other = np.minimum(np.arange(len(places)) + j, len(places) - 1)
        better = (of[other] == of) & (keys[other] < keys[least])
        least[better] = other[better]
    # Windows begin at every place that has a whole one behind it, or at the block's first.
    begins = (np.arange(len(places)) - first + window <= count) | (np.arange(len(places)) == first)
    at = np.unique(least[begins])
    return places[at], keys[at]


def _streams(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of streams of blocks, and of each token its stream, its block in the stream and its block of all."""
    flat = [b for blocks in texts for b in blocks]
    tokens, sizes = [], []
    for _, _, data, offsets in wordhash.slices(pa.array(flat, pa.large_string())):
        starts, ends, first = wordhash.word_bounds(data, offsets)
        tokens.append(wordhash.word_hashes(data, starts, ends))
        sizes.append(np.diff(first))
    sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    counts = np.array([len(b) for b in texts], np.int64)
    stream = np.repeat(np.repeat(np.arange(len(texts)), counts), sizes)
    within = np.concatenate([np.arange(c) for c in counts]) if len(counts) else np.zeros(0, np.int64)
    return (np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)), stream, np.repeat(within, sizes), np.repeat(np.arange(len(sizes)), sizes)


def _page_ids(tokens: np.ndarray, stream: np.ndarray, count: int) -> np.ndarray:
    """A hash of each stream's tokens in order: copies have the same."""
    place = np.arange(len(tokens)) - np.searchsorted(stream, stream)
    terms = wordhash.mix(tokens + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = np.zeros(count, np.uint64)
    np.add.at(out, stream, terms)
    return out.view(np.int64)


def _pairs(hosts: np.ndarray, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(host, anchor's hash, page's hash) of the runs of some pages, each once for a page."""
    tokens, stream, _, owner = _streams(texts)
    pages = _page_ids(tokens, stream, len(texts))
    if not len(tokens):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), pages[:0]
    places, keys = anchors(tokens, owner)
    of = stream[places]
    order = np.lexsort((keys, of))
    of, keys = of[order], keys[order]
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])
    return hosts[of[new]], keys[new].view(np.int64), pages[of[new]]


def _repeats(pages: DataFrame) -> DataFrame:
    """(host, least, keys): pages that make boilerplate, hashes of the anchors on as many; ``pages`` has host, packed and page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, PAGES):
                part = b.slice(start, PAGES)
                hosts, keys, ids = _pairs(part.column(0).to_numpy(), [_unpacked(p) for p in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(hosts), pa.array(keys), pa.array(ids)], names=["host", "key", "page"])

    pairs = pages.select("host", "packed").mapInArrow(run, "host long, key long, page long").distinct()
    held = pairs.groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES)
    sizes = pages.select("host", "page").distinct().groupBy("host").agg(F.greatest(F.lit(float(LEAST_PAGES)), SHARE * F.count("*")).alias("least"))
    return held.join(sizes, "host").where(F.col("n") >= F.col("least")).groupBy("host", "least").agg(F.collect_list("key").alias("keys"))


def surroundings(places: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end place of the tokens around each anchor: those in which neither neighbour's run is whole."""
    of = owner[places]
    begin, end = np.searchsorted(owner, of), np.searchsorted(owner, of, "right")
    inner = of[1:] == of[:-1]
    begin[1:][inner], end[:-1][inner] = places[:-1][inner] + 1, places[1:][inner] + RUN - 1
    return begin, end


def _joined(before: bytes, after: bytes) -> bytes:
    return np.concatenate([np.frombuffer(before, np.uint64)[::-1], np.frombuffer(after, np.uint64)]).tobytes()


def _shared(a: bytes, b: bytes) -> bytes:
    """The tokens that two strings begin with."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a[:n], np.uint64), np.frombuffer(b[:n], np.uint64)
    return a[: 8 * int(np.append(x == y, False).argmin())]


def _strings(pages: DataFrame, repeats: DataFrame) -> DataFrame:
    """(host, keys, strings): the boilerplate of a host's repeated anchors, as token hashes.

    Of each anchor: what all its occurrences share, and the surroundings found on as many pages as boilerplate needs.
    Pages are counted by a hash of the surroundings; the tokens themselves leave a task once, not once a page.
    """

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, PAGES):
                part = b.slice(start, PAGES)
                hosts, ids, least = (part.column(i).to_numpy() for i in (0, 2, 3))
                tokens, stream, _, owner = _streams([_unpacked(p) for p in part.column(1).to_pylist()])
                places, own = anchors(tokens, owner) if len(tokens) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
                hot = np.zeros(len(places), bool)
                for host, row in zip(*np.unique(hosts, return_index=True), strict=True):
                    mine = np.flatnonzero(hosts[stream[places]] == host)
                    hot[mine] = np.isin(own[mine].view(np.int64), part.column(4)[int(row)].as_py())
                begin, end = surroundings(places, owner)
                of = stream[places[hot]]
                before = [tokens[i:j][::-1].tobytes() for i, j in zip(begin[hot], places[hot], strict=True)]
                after = [tokens[i:j].tobytes() for i, j in zip(places[hot], end[hot], strict=True)]
                named = [hashlib.blake2b(bytes([len(x)]) + x + y, digest_size=8).digest() for x, y in zip(before, after, strict=True)]
                named = np.frombuffer(b"".join(named), np.int64)
                _, once = np.unique(np.stack([hosts[of], named]), axis=1, return_index=True)
                rows = np.concatenate([np.arange(len(of)), once])
                told = np.arange(len(rows)) >= len(of)
                columns = [pa.array(x[rows]) for x in (hosts[of], least[of], own[hot].view(np.int64), named)]
                columns += [pa.array([x[r] if t else None for r, t in zip(rows, told, strict=True)], pa.binary()) for x in (before, after)]
                columns.append(pa.array(ids[of][rows], mask=told))
                yield pa.RecordBatch.from_arrays(columns, names=["host", "least", "key", "around", "before", "after", "page"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            strings = []
            for b0, b1, a0, a1, common in zip(*(c.to_pylist() for c in b.columns[2:]), strict=True):
                found, run = {_joined(c["before"], c["after"]) for c in common}, _shared(a0, a1)
                # Two runs of one hash share less than a run.
                if a0 == a1 or len(run) >= 8 * RUN:
                    found.add(_joined(_shared(b0, b1), run))
                strings.append(sorted(found))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(strings, pa.list_(pa.binary()))], names=["host", "key", "strings"])

    asked = pages.join(repeats, "host").select("host", "packed", "page", "least", "keys")
    rows = asked.mapInArrow(around, "host long, least double, key long, around long, before binary, after binary, page long").distinct()
    counted = rows.groupBy("host", "least", "key", "around").agg(F.count("page").alias("n"), F.max("before").alias("before"), F.max("after").alias("after"))
    common = F.collect_list(F.when(F.col("n") >= F.col("least"), F.struct("before", "after")))
    edges = counted.groupBy("host", "key").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("before", "after") for f in (F.min, F.max)], common.alias("common"))
    strings = edges.mapInArrow(shared, "host long, key long, strings array<binary>")
    return strings.groupBy("host").agg(F.collect_list("key").alias("keys"), F.array_distinct(F.flatten(F.collect_list("strings"))).alias("strings"))


def _packed(blocks: list[str]) -> bytes:
    return zlib.compress(_PART.join(blocks).encode())


def _unpacked(packed: bytes) -> list[str]:
    text = zlib.decompress(packed).decode()
    return text.split(_PART) if text else []


def matched(tokens: np.ndarray, owner: np.ndarray, strings: list[np.ndarray]) -> np.ndarray:
    """Which tokens of some blocks the strings cover: by RUN tokens or more that they share, or as a whole block.

    A suffix shares ``d`` tokens with a string if one of the string's is in its interval of common prefixes of ``d``.
    """
    known = sum(map(len, strings))
    tokens = np.concatenate([*strings, tokens])
    owner = np.concatenate([np.repeat(np.arange(len(strings)), [len(x) for x in strings]), owner + len(strings)])
    order, lcp = suffix_array(tokens, owner, REACH)
    place = np.arange(len(tokens))
    left = np.searchsorted(owner, owner, "right") - place
    short = (np.searchsorted(owner, owner) == place) & (left < RUN)
    whole = left[order]
    twin = np.zeros(len(order), bool)
    twin[1:] = (lcp[1:] == whole[1:]) & (whole[1:] == whole[:-1])
    interval = np.cumsum(~twin)
    hit = (np.bincount(interval, short[order] & (order < known)) > 0)[interval]
    longest = np.zeros(len(tokens), np.int64)
    longest[order[hit]] = whole[hit]
    longest[~short] = 0
    for depth in range(RUN, REACH + 1):
        interval = np.cumsum(lcp < depth)
        hit = (np.bincount(interval, order < known) > 0)[interval]
        longest[order[hit]] = depth
    longest = longest[known:]
    steps = np.bincount(np.arange(len(longest)), longest > 0, len(longest) + 1) - np.bincount((np.arange(len(longest)) + longest)[longest > 0], minlength=len(longest) + 1)
    return np.cumsum(steps)[:-1] > 0


def covered(texts: list[list[str]], keys: np.ndarray, strings: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each block of a host's pages its tokens, and the share of them that the host's strings cover.

    Only blocks with an anchor among the ``keys`` are looked at: equal blocks and long equal stretches have one.
    """
    tokens, _, _, owner = _streams(texts)
    ends = np.cumsum([len(t) for t in texts])
    size = np.bincount(owner, minlength=ends[-1])
    share = np.zeros(ends[-1])
    if len(tokens):
        places, own = anchors(tokens, owner)
        asked = np.isin(owner, owner[places[np.isin(own.view(np.int64), keys)]])
        if asked.any():
            of = owner[asked]
            share = np.bincount(of, matched(tokens[asked], of, strings), minlength=ends[-1]) / np.maximum(size, 1)
    return np.split(size, ends[:-1]), np.split(share, ends[:-1])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, text (blocks joined by blank lines), n_chars in code points.

    A null or empty page has an empty text. A null URL counts as a host of its own name, the empty one. Repeated
    rows each get their text. Other columns are not read. An empty table gives an empty result.
    """
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    id_type = source.schema["id"].dataType.simpleString()

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [[x for x in html_blocks.blocks(h or "") if x[1] != html_blocks.CHROME] for h in b.column(2).to_pylist()]
            texts = [[t for t, _, _ in f] for f in found]
            tokens, stream, _, _ = _streams(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    b.column(1),
                    pa.array([_packed(t) for t in texts], pa.binary()),
                    pa.array([bytes(2 * (z > html_blocks.PLAIN) + (s > LINKED) for _, z, s in f) for f in found], pa.binary()),
                    pa.array(_page_ids(tokens, stream, len(texts))),
                ],
                names=["id", "url", "packed", "marks", "page"],
            )

    opened = source.mapInArrow(parsed, f"id {id_type}, url string, packed binary, marks binary, page long")
    opened = materialise(opened.withColumn("host", F.xxhash64(host(F.col("url")))), "page-blocks")
    strings = materialise(_strings(opened, materialise(_repeats(opened), "host-repeats")), "host-strings")
    told = opened.join(strings, "host", "left").select("id", "url", "packed", "marks", "host", "keys", "strings")

    def unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blocks = [_unpacked(p) for p in b.column(2).to_pylist()]
            fresh = [[True] * len(t) for t in blocks]
            marks = b.column(3).to_pylist()
            rows = collections.defaultdict(list)
            for row, (host_id, told) in enumerate(zip(b.column(4).to_pylist(), b.column(5).is_valid().to_pylist(), strict=True)):
                if told:
                    rows[host_id].append(row)
            for own in rows.values():
                keys = np.array(b.column(5)[own[0]].as_py(), np.int64)
                strings = [np.frombuffer(x, np.uint64) for x in b.column(6)[own[0]].as_py()]
                for start in range(0, len(own), PAGES):
                    part = own[start : start + PAGES]
                    for row, size, share in zip(part, *covered([blocks[r] for r in part], keys, strings), strict=True):
                        fresh[row] = [bool(s < COVERED or (m > 1 and n < RUN)) for s, m, n in zip(share, marks[row], size, strict=True)]
            texts = ["\n\n".join(_chosen(t, [m > 1 for m in ms], [m % 2 == 1 for m in ms], f)) for t, ms, f in zip(blocks, marks, fresh, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    result = told.mapInArrow(unique, f"id {id_type}, url string, text string")
    return result.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
