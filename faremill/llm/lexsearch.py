"""Ranked lexical search: for each item the documents of highest term-weight score, exactly.

1. Items are cut into terms. They are taken in blocks of bounded size (``BLOCK_ITEMS``, ``BLOCK_TERMS``), so that a
   block's terms can be sent to all tasks; there are as many blocks as the items need, and each meets all documents.
2. One pass over the texts restricts every document to the block's terms: their numbers of occurrences and the
   document's length. Counts over all documents (with a term, of terms, holding a term) come from these rows.
3. Each task builds trees of the restricted documents it holds (see ``fptree``) and searches them for one item after
   another by branch-and-bound. An item's threshold goes on from tree to tree.
4. Every task sends on at most k rows an item, which are ranked together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from . import wordhash
from .fptree import Board, Tree

BLOCK_ITEMS, BLOCK_TERMS = 1 << 12, 1 << 20
#: Documents and terms that one tree holds, about.
CHUNK, CHUNK_TERMS = 1 << 13, 1 << 21
FLAT = 75
#: Bytes that part terms: all of ASCII but digits and letters.
GAP = np.zeros(256, bool)
GAP[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def _tokens(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, term hashes, each text's first term and one more) of runs of rows."""
    for first, end, data, offsets in wordhash.slices(texts):
        starts, ends, bounds = wordhash.word_bounds(data, offsets, GAP)
        yield first, end, wordhash.word_hashes(data, starts, ends), bounds


def _counted(owner: np.ndarray, values: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each owner with their counts, and the owners' bounds; ``values`` may be any 64-bit numbers."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return values[at], np.diff(np.append(at, len(values))), np.searchsorted(owner[at], np.arange(texts + 1))


def _lists(bounds: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row an item that has terms: row, item, its distinct terms' hashes and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, end, terms, bounds in _tokens(b.column(1)):
                owner = np.repeat(np.arange(end - first), np.diff(bounds))
                values, counts, limits = _counted(owner, terms.view(np.int64), end - first)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, end - first), _lists(limits, values, pa.int64()), _lists(limits, counts, pa.int64())], names=["item", "terms", "counts"])

    source = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text"))
    kind = source.schema["item"].dataType.simpleString()
    found = source.mapInArrow(run, f"item {kind}, terms array<long>, counts array<long>").where(F.size("terms") > 0)
    return materialise(found.withColumn("row", F.monotonically_increasing_id()), "item-terms")


def _restricted(docs: DataFrame, id_col: str, text_col: str, vocabulary: np.ndarray) -> DataFrame:
    """One row a document with terms: id, n (terms with repeats), places in the vocabulary of those in it, their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, end, terms, bounds in _tokens(b.column(1)):
                at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
                hit = vocabulary[at] == terms
                owner = np.repeat(np.arange(end - first), np.diff(bounds))[hit]
                places, tf, limits = _counted(owner, at[hit], end - first)
                batch = pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, end - first), pa.array(np.diff(bounds)), _lists(limits, places, pa.int32()), _lists(limits, tf, pa.int32())], names=["id", "n", "places", "tf"]
                )
                yield batch.filter(pa.array(np.diff(bounds) > 0))

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return materialise(source.mapInArrow(run, "id long, n long, places array<int>, tf array<int>"), "restricted")


def _document_counts(vectors: DataFrame, size: int) -> np.ndarray:
    """Of each place of the vocabulary the number of documents that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for b in batches:
            counts += np.bincount(b.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at])], names=["place", "documents"])

    out = np.zeros(size, np.int64)
    for r in vectors.select("places").mapInArrow(run, "place int, documents long").groupBy("place").agg(F.sum("documents").alias("documents")).collect():
        out[r["place"]] = r["documents"]
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    rows = terms = 0
    for b in batches:
        size = max(1, len(b.column("places").flatten()) // max(1, b.num_rows))
        step = max(1, min(CHUNK, CHUNK_TERMS // size))
        for start in range(0, b.num_rows, step):
            part = b.slice(start, step)
            held.append(part)
            rows, terms = rows + part.num_rows, terms + part.num_rows * size
            if rows >= CHUNK or terms >= CHUNK_TERMS:
                yield pa.Table.from_batches(held)
                held, rows, terms = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def _search(vectors: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], rank: np.ndarray, total: int, terms: int, k: int) -> DataFrame:
    """(row, id, score) of each task's k best documents an item. ``items``: row, ranks of its terms, their weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        board, weights = Board(len(items), k), np.zeros(len(rank), np.int64)
        for table in _chunks(batches):
            places, n, ids = table["places"].combine_chunks(), table["n"].to_numpy(), table["id"].combine_chunks()
            tree = Tree(
                np.diff(places.offsets.to_numpy()), rank[places.flatten().to_numpy()], table["tf"].combine_chunks().flatten().to_numpy().astype(np.int64),
                100 - FLAT + FLAT * n * total // terms, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), len(rank),
            )
            for i, (_, own, w) in enumerate(items):
                weights[own] = w
                tree.search(weights, board, i)
                weights[own] = 0
        found = np.concatenate(board.rows, axis=1) if board.rows else np.zeros((3, 0), np.int64)
        row = np.repeat(np.array([r for r, _, _ in items], np.int64), [b.shape[1] for b in board.rows])
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(found[2], mask=found[1] == 1), pa.array(found[0])], names=["row", "doc_id", "score"])

    return vectors.where(F.size("places") > 0).select("id", "n", "places", "tf").mapInArrow(run, "row long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per item its k best documents of score above 0: item_id, rank from 1, doc_id, score.

    A null text has no terms, be it a document's or an item's. Documents without terms count nowhere; items without
    known terms have no rows. Equal scores go to the smaller doc_id, null ids last. Each row of a repeated doc_id is a
    document and each row of a repeated item_id an item. Other columns are not read. If either table is empty, so is
    the result.
    """
    asked = _item_terms(items, item_col, item_text)
    kind = asked.schema["item"].dataType.simpleString()
    size = asked.agg(F.count("*").alias("items"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    blocks = max(1, math.ceil(size["items"] / BLOCK_ITEMS), math.ceil(size["terms"] / BLOCK_TERMS))
    found: DataFrame | None = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).select("row", "terms", "counts").collect()
        vocabulary = np.unique(np.array([t for r in rows for t in r["terms"]], np.int64).view(np.uint64))
        if not len(vocabulary):
            continue
        vectors = _restricted(docs, id_col, text_col, vocabulary)
        facts = vectors.agg(F.count("*").alias("total"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if not facts["total"]:
            continue
        counts = _document_counts(vectors, len(vocabulary))
        rank = np.empty(len(vocabulary), np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(len(vocabulary))
        weight = np.floor(1000 * np.log((2.0 * facts["total"] + 2) / (2.0 * counts + 1))).astype(np.int64)
        asking = []
        for r in rows:
            at = np.searchsorted(vocabulary, np.array(r["terms"], np.int64).view(np.uint64))
            asking.append((r["row"], rank[at], weight[at] * np.array(r["counts"], np.int64)))
        part = _search(vectors, asking, rank, facts["total"], facts["terms"], k)
        found = part if found is None else found.union(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"{item_col} {kind}, rank int, {id_col} long, score long")
    by_score = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return best.join(asked.select("row", "item"), "row").select(F.col("item").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
