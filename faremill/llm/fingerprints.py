"""Document fingerprints by consistent weighted sampling of word counts.

A document is the set of its lower-cased words, weighted by how often they occur. Its fingerprint is ``cws.SAMPLES``
samples of 16 bits in hexadecimal; the share of equal samples of two fingerprints estimates the generalised Jaccard
similarity of the documents. It depends on the text alone, so equal texts have equal fingerprints anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import cws, wordhash
from .ordered import in_order

_DIGITS = 4


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two fingerprints."""
    pieces = [F.regexp_extract_all(c, F.lit("." * _DIGITS), F.lit(0)) for c in (a, b)]
    return F.size(F.filter(F.zip_with(*pieces, lambda x, y: x == y), lambda same: same)) / F.lit(cws.SAMPLES)


def _signatures(sampler: cws.Sampler, texts: pa.Array) -> np.ndarray:
    out = []
    for first, end, data, offsets in wordhash.slices(texts):
        starts, ends, bounds = wordhash.word_bounds(data, offsets)
        hashes = wordhash.word_hashes(data, starts, ends)
        owner = np.repeat(np.arange(end - first), np.diff(bounds))
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(hashes))).astype(np.float64)
        out.append(sampler.signatures(hashes[at], counts, np.searchsorted(owner[at], np.arange(end - first + 1))))
    return np.concatenate(out) if out else np.zeros((0, cws.SAMPLES), ">u2")


def _text(signatures: np.ndarray) -> pa.Array:
    return pa.array([s.tobytes().hex() for s in signatures], pa.string())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id and fingerprint.

    A null text counts as empty; texts without words share one fingerprint of their own. Rows of a repeated id are
    separate documents. Other columns are not read. An empty table gives an empty result.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = cws.Sampler()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _text(_signatures(sampler, b.column(1)))], names=["id", "fingerprint"])

    return source.mapInArrow(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[str]]]:
    """Ids and texts of consecutive rows, and the texts that follow them; ``lead`` rows only follow."""
    held: tuple[int, bool, int | None, str] | None = None
    for b in batches:
        ids, texts, after = [], [], []
        for bucket, lead, i, text in zip(*(b.column(c).to_pylist() for c in ("bucket", "lead", "id", "text")), strict=True):
            text = text or ""
            # The rows after the first lead row of a bucket are copies of it.
            if held is not None and held[0] == bucket and not held[1]:
                ids.append(held[2])
                texts.append(held[3])
                after.append(text)
            held = (bucket, lead, i, text)
        yield ids, texts, after


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_chars, edited text, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next larger id (see ``ordered.in_order``), the first follows the last, and a
    lone one follows itself. The edited text has the last half of the code points (rounded down) replaced by as
    many of the next document's first ones, or all it has. A null text is empty; null ids come last. Rows of a
    repeated id are separate documents, in an order that depends on their texts alone; rows that are wholly equal
    follow one another and stay in one task, which streams through them. Other columns are not read. An empty table
    gives an empty result.
    """
    rows = in_order(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "text").select("bucket", "lead", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = cws.Sampler()
        for ids, texts, after in _pairs(batches):
            if not ids:
                continue
            sizes = [len(t) for t in texts]
            edited = pa.array([t[: n - n // 2] + f[: n // 2] for t, n, f in zip(texts, sizes, after, strict=True)], pa.string())
            # A text mostly stands right before the one that follows it.
            following = [i + 1 if i + 1 < len(texts) and texts[i + 1] is f else -1 for i, f in enumerate(after)]
            apart = [f for f, i in zip(after, following, strict=True) if i < 0]
            # A text and its edit share most terms, which are sampled once if they come together.
            both = [t for pair in zip(texts, edited.to_pylist(), strict=True) for t in pair]
            found = _signatures(sampler, pa.array(both + apart, pa.large_string()))
            own, changed, others = found[: len(both) : 2], found[1 : len(both) : 2], found[len(both) :]
            follow = np.array(following)
            theirs = own[np.maximum(follow, 0)]
            theirs[follow < 0] = others
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), edited, _text(own), _text(changed), pa.array((own == changed).mean(1)), pa.array((own == theirs).mean(1))],
                names=["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    found = rows.mapInArrow(run, "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return found.withColumnRenamed("id", id_col)
