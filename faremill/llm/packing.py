"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

Each document's ids are cut into full windows and one remainder. Full windows need no partner. Remainders
are dealt at random to groups of about ``GROUP_WINDOWS`` windows; within a group the two partial partitions
of the largest imbalance are merged, the heaviest windows of one onto the lightest of the other, until one
near-equal partition is left. If its heaviest window is over the capacity, the group is partitioned anew
with one window more.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

CAPACITY = 4096
GROUP_WINDOWS = 256
END_ID = 2
BATCH_CHARS = 1_000_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def differencing(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window (0..windows-1) of each length, by multiway largest differencing."""
    if windows == 1:
        return np.zeros(len(lengths), np.int64)
    nodes: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    heap = []
    for i, n in enumerate(lengths.tolist()):
        sums = np.zeros(windows, np.int64)
        sums[-1] = n
        heap.append((-n, i, sums))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, left, a = heapq.heappop(heap)
        _, right, b = heapq.heappop(heap)
        both = a + b[::-1]
        order = np.argsort(both, kind="stable")
        slot = np.empty_like(order)
        slot[order] = np.arange(windows)
        sums = both[order]
        sums -= sums[0]
        nodes.append((left, right, slot, slot[::-1]))
        heapq.heappush(heap, (-int(sums[-1]), len(lengths) + len(nodes) - 1, sums))
    out = np.zeros(len(lengths), np.int64)
    places = {heap[0][1]: np.arange(windows)}
    for i in range(len(nodes) - 1, -1, -1):
        left, right, to_left, to_right = nodes[i]
        place = places.pop(len(lengths) + i)
        for child, to in ((left, to_left), (right, to_right)):
            if child < len(lengths):
                out[child] = place[to[-1]]
            else:
                places[child] = place[to]
    if not nodes:
        out[:] = windows - 1
    return out


def windows_of(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Windows of near-equal sums at most ``capacity``; their number rises until they fit."""
    count = max(1, math.ceil(int(lengths.sum()) / capacity))
    while True:
        window = differencing(lengths, count)
        if np.bincount(window, lengths).max() <= capacity:
            return window
        count += 1


def tokenize(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, capacity: int, with_ids: bool) -> DataFrame:
    """One row a piece: id, start, length, checksum, doc_tokens, and the ids as little-endian bytes if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .tokens import encoder

        encode = encoder(vocabulary).encode_batch
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            sizes = np.cumsum(texts.cast(pa.large_string()).fill_null("").to_pandas().str.len().to_numpy(np.int64)) // BATCH_CHARS
            for part in np.unique(sizes):
                rows = np.flatnonzero(sizes == part)
                first, end = int(rows[0]), int(rows[-1]) + 1
                ids, bounds = encode([t or "" for t in texts.slice(first, end - first).to_pylist()])
                out: list[tuple] = []
                for name, a, b in zip(names[first:end], bounds[:-1], bounds[1:], strict=True):
                    own = np.append(ids[a:b], END_ID).astype("<u4")
                    for start in range(0, len(own), capacity):
                        piece = own[start : start + capacity]
                        out.append((name, start, len(piece), zlib.crc32(piece), len(own), piece.tobytes() if with_ids else None))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:5]], pa.array(columns[5], pa.binary())], names=["id", "start", "length", "crc", "doc_tokens", "ids"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "id long, start long, length long, crc long, doc_tokens long, ids binary")


def pack(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids if asked for).

    A null or empty text is its end id alone. A repeated row is packed as often as it comes. Each id lies in
    exactly one piece; offsets of a sequence are gapless from 0 in the order of document and start. An empty
    table gives an empty result.
    """
    pieces = materialise(tokenize(docs, vocabulary or default_vocabulary(), id_col, text_col, capacity, with_ids), "pieces")
    pieces = pieces.withColumn("row", F.monotonically_increasing_id())
    rest = pieces.where(F.col("length") < capacity)
    total = rest.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    groups = max(1, math.ceil(total / (capacity * GROUP_WINDOWS)))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "start", "crc", "row"], na_position="first", ignore_index=True)
        group["window"] = windows_of(group["length"].to_numpy(np.int64), capacity)
        group["offset"] = group.groupby("window")["length"].cumsum() - group["length"]
        return group

    keyed = rest.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    fields = "id long, start long, length long, crc long, doc_tokens long, ids binary, row long, group long, window long, offset long"
    placed = keyed.groupBy("group").applyInPandas(place, fields)
    placed = placed.withColumn("sequence_id", F.col("group") * F.lit(1 << 32) + F.col("window"))
    full = pieces.where(F.col("length") == capacity).withColumn("sequence_id", F.col("row") + F.lit(1 << 62)).withColumn("offset", F.lit(0).cast("long"))
    columns = [F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return placed.select(*columns).unionByName(full.select(*columns))
