"""Near-duplicate classes by SetSketch registers.

1. One pass over the texts sketches each document's distinct word shingles. Documents with equal sets
   collapse to the one of smallest id; everything below works on those representatives.
2. Bands of register values are the keys of candidate buckets. A bucket is named by its smallest member,
   the hub; a hub's set holds all that share a bucket with it. Two documents that share a bucket are both
   in the set of that bucket's hub, so no candidate pair is lost, while the many buckets of one group of
   copies become few sets.
3. A set is cut into chunks of at most ``CHUNK`` on average, each with the hub. Within a chunk the joint
   likelihood of two sketches dismisses hopeless pairs, the full shingle sets confirm the others, and a pair
   inside one class found so far is skipped; only a spanning forest of links leaves the task.
4. For sets of more than one chunk, members outside the set's largest class then meet the members of all
   other chunks in the same way. A group of copies costs time in proportion to its size, except for
   members that link to nothing.

A link with Jaccard similarity 0.75 shares no band with probability (1 - 0.75^5)^40 = 2e-5, less for more
similar pairs, and a class is lost only where every link that holds it together is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import setsketch, wordhash
from .arrow_groups import groups
from .components import components

SHINGLE = 5
SIMILARITY = 0.75
CHUNK = 512


def sketch_documents(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """One row a document: id, a hash of its text, set size, two sums that identify the set, registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in wordhash.slices(batch.column(2)):
                runs, bounds = wordhash.shingle_runs(data, offsets, shingle)
                sets = [np.unique(runs[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                registers = setsketch.sketches(runs, bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, end - first),
                        batch.column(1).slice(first, end - first),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).astype(np.int64)),
                        pa.array(np.array([np.bitwise_xor.reduce(wordhash.mix(s)) for s in sets], np.uint64).astype(np.int64)),
                        pa.array([r.tobytes() for r in registers], pa.binary()),
                    ],
                    names=["doc", "hash", "n", "sum", "xor", "registers"],
                )

    return _named(docs, id_col, text_col).mapInArrow(run, "doc long, hash long, n long, sum long, xor long, registers binary")


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))


def _bands(reps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, setsketch.REGISTERS)
            keys = setsketch.band_keys(registers)
            ids = np.repeat(batch.column(0).to_numpy(), setsketch.BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(ids)], names=["band", "id"])

    return reps.select("id", "registers").mapInArrow(run, "band long, id long")


def _hub_sets(reps: DataFrame) -> DataFrame:
    """Distinct (hub, id) of all buckets with two members or more, the hub's own row included."""
    bands = _bands(reps)
    hubs = bands.groupBy("band").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").select("band", "hub")
    members = bands.join(hubs, "band").where("id <> hub").select("hub", "id").distinct()
    return materialise(members, "hub-sets")


class _Forest:
    """Union-find over positions."""

    def __init__(self, roots: np.ndarray):
        self.root = roots

    def join(self, a: int, b: int) -> None:
        x, y = self.root[a], self.root[b]
        self.root[self.root == y] = x


def _links(left: pa.Table, right: pa.Table | None, least: float, shingle: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within ``left``, or between ``left`` and ``right``."""
    both = left if right is None else pa.concat_tables([left, right])
    ids, sizes = both["id"].to_numpy(), both["n"].to_numpy()
    registers = np.frombuffer(b"".join(both["registers"].to_pylist()), np.uint8).reshape(len(ids), -1)
    sets: dict[int, np.ndarray] = {}
    texts = both["text"]

    def fetch(rows: np.ndarray) -> None:
        missing = [int(r) for r in rows if r not in sets]
        if missing:
            sets.update(zip(missing, wordhash.shingle_sets(texts.take(missing), shingle), strict=True))

    _, roots = np.unique(both["class"].to_numpy() if "class" in both.column_names else ids, return_inverse=True)
    forest, found = _Forest(roots.astype(np.int64)), []
    split = 0 if right is None else left.num_rows
    for x in range(1 if right is None else split, len(ids)):
        others = np.arange(x) if right is None else np.arange(split)
        others = others[forest.root[others] != forest.root[x]]
        others = others[setsketch.plausible(registers[x], sizes[x], registers[others], sizes[others], least)] if len(others) else others
        if not len(others):
            continue
        fetch(np.append(others, x))
        order = np.argsort(-(registers[others] == registers[x]).sum(1), kind="stable")
        others = others[order]
        own, done = sets[x], 0
        while done < len(others):
            # The likeliest first and alone: its link often makes the others needless.
            few = others[done : done + max(1, 4 * done)]
            done += len(few)
            few = few[forest.root[few] != forest.root[x]]
            if not len(few):
                continue
            theirs = [sets[int(y)] for y in few]
            lengths = np.array([len(t) for t in theirs])
            flat = np.concatenate(theirs)
            at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
            common = np.add.reduceat(own[at] == flat, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
            percent = round(100 * least)
            for y in few[100 * common >= percent * (lengths + len(own) - common)]:
                if forest.root[y] != forest.root[x]:
                    found.append((int(ids[x]), int(ids[y])))
                    forest.join(x, y)
    return found


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _chunks(size: str) -> F.Column:
    return F.ceil(F.col(size) / F.lit(CHUNK)).cast("int")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """Per document: id, n_shingles, component_id, kept.

    Documents link if their distinct lower-cased word shingles have a Jaccard similarity of at least ``least``.
    A null text, or one without words, has an empty set and links with nothing. Fewer words than a shingle
    are one shingle. component_id is the smallest id of the class; every row of a repeated id gets its own row, and
    rows of one id with different texts are different documents. A class without any id has the component_id null,
    and a null id is never kept. text_hash and chosen tell which rows a corpus without near-duplicates would hold:
    the one of smallest id (null last) of each class, and all that link with nothing. Other columns are not read.
    An empty table gives an empty result.
    """
    all_rows = materialise(sketch_documents(docs, id_col, text_col, shingle).withColumn("row", F.monotonically_increasing_id()), "sketches")
    # Equal sets are named by one of their rows; from here to the classes, an id is such a row's number.
    firsts = all_rows.where("n > 0").groupBy("n", "sum", "xor").agg(F.min("row").alias("rep"))
    firsts = materialise(firsts, "set-classes")
    reps = all_rows.join(firsts.select(F.col("rep").alias("row")), "row").select(F.col("row").alias("id"), "doc", "hash", "n", "registers")
    reps = materialise(reps, "representatives")
    members = _hub_sets(reps)
    sized = members.groupBy("hub").agg((F.count("*") + 1).alias("size"))

    wanted = members.select("id").union(members.select(F.col("hub").alias("id"))).distinct()
    profile = reps.join(wanted, "id").withColumnsRenamed({"doc": "of", "hash": "same"})
    texts = _named(docs, id_col, text_col).join(profile, F.col("hash").eqNullSafe(F.col("same")) & F.col("doc").eqNullSafe(F.col("of")))
    candidates = materialise(texts.select("id", "text", "n", "registers").dropDuplicates(["id"]), "candidates")

    # Stage 3: members in their chunk, the hub in each chunk.
    placed = members.join(sized, "hub").withColumn("chunk", F.pmod(F.xxhash64("id"), _chunks("size")).cast("int"))
    hubs = sized.select("hub", F.col("hub").alias("id"), F.explode(F.sequence(F.lit(0), _chunks("size") - 1)).alias("chunk"))
    rows = placed.select("hub", "id", "chunk").union(hubs).join(candidates, "id")
    rows = rows.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "id")

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["hub", "chunk"]):
            if edges := _links(table, None, least, shingle):
                yield _edge_batch(edges)

    edges = materialise(rows.mapInArrow(within, "a long, b long").distinct(), "links")
    classes = components(edges)

    # Stage 4: what is outside its set's largest class meets the other chunks.
    large = sized.where(F.col("size") > CHUNK)
    full = placed.join(large.select("hub"), "hub").select("hub", "id", "chunk", "size")
    full = full.join(classes.withColumnRenamed("node", "id"), "id", "left").withColumn("class", F.coalesce("component", "id")).drop("component")
    full = materialise(full, "large-sets")
    counts = full.groupBy("hub", "class").agg(F.count("*").alias("rows"))
    most = counts.groupBy("hub").agg(F.max_by("class", F.struct("rows", "class")).alias("main"), F.count("*").alias("classes")).where("classes > 1")
    full = full.join(most.select("hub", "main"), "hub")
    probes = full.where("class <> main")
    # Chunks without a probe send none, so no row waits for them.
    sending = probes.groupBy("hub").agg(F.collect_set("chunk").alias("chunks"))
    home = full.join(sending, "hub").select("hub", "id", "class", F.col("chunk").alias("at"), F.explode("chunks").alias("of"), F.lit(False).alias("probe")).where(F.col("of") != F.col("at"))
    every = F.sequence(F.lit(0), _chunks("size") - 1)
    probe = probes.select("hub", "id", "class", F.explode(every).alias("at"), F.col("chunk").alias("of"), F.lit(True).alias("probe")).where(F.col("of") != F.col("at"))
    met = home.union(probe).join(candidates, "id").repartition("hub", "at", "of").sortWithinPartitions("hub", "at", "of", "id")

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["hub", "at", "of"]):
            probes = table["probe"].to_numpy()
            if probes.any() and not probes.all() and (found := _links(table.filter(pa.array(~probes)), table.filter(pa.array(probes)), least, shingle)):
                yield _edge_batch(found)

    more = materialise(met.mapInArrow(across, "a long, b long").distinct(), "links")
    if not more.isEmpty():
        classes = components(edges.union(more))

    lookup = firsts.join(classes.withColumnRenamed("node", "rep"), "rep", "left").select("n", "sum", "xor", F.coalesce("component", "rep").alias("class"))
    told = all_rows.drop("registers").join(lookup, ["n", "sum", "xor"], "left")
    first = F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "row")
    best = told.where("class is not null").groupBy("class").agg(F.min(first).alias("best")).select("class", F.col("best.doc").alias("least"), F.col("best.row").alias("best"))
    out = told.join(best, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc")).otherwise(F.col("least"))
    return out.select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("doc"), F.lit(False)).alias("kept"),
        F.col("hash").alias("text_hash"),
        F.coalesce(F.col("best") == F.col("row"), F.lit(True)).alias("chosen"),
    )
