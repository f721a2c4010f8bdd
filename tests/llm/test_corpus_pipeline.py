"""Every stage of the pipeline on its own input, against brute force."""

import collections
import re

import pytest

import corpus_pipeline as pipeline
from faremill.llm import mixing, quality, queries, secrets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input of each stage and, last, the result."""
    root = str(tmp_path_factory.mktemp("stages"))
    out = [queries.table(spark, SF, "documents")]
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{root}/{i}")
        out.append(spark.read.parquet(f"{root}/{i}"))
    return out


def test_columns(stages):
    assert all(tuple(d.columns) == pipeline.COLUMNS for d in stages[:-1])


def test_quality(stages, spark):
    labels = {r["doc_id"]: r["quality"] for r in queries.table(spark, SF, "labels").collect()}
    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in stages[:2])
    assert all(before[i] == t for i, t in after.items()) and 0 < len(after) < len(before)
    assert sum(labels.get(i) == 1 for i in after) >= 0.97 * sum(labels.get(i) == 1 for i in before)


def test_quality_needs_one_worker_a_task(stages, spark):
    """A chain of two Python steps keeps two workers a task, with all they hold, for the stages that follow."""
    plan = pipeline.quality_stage(spark, stages[0], SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    kept = {r["doc_id"] for r in quality.classify(stages[0], queries.table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in stages[1].collect()} == kept


def test_near_duplicates(stages):
    from test_llm_operators import brute_components

    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in stages[1:3])
    ids = sorted(before)
    classes = brute_components([before[i] for i in ids])
    assert after == {ids[k]: before[ids[k]] for k, (_, c) in classes.items() if c == k}


def test_secrets(stages):
    before, after = ({r["doc_id"]: r["text"] for r in d.collect()} for d in stages[2:4])
    assert set(before) == set(after)
    for i, text in before.items():
        hits = [m for kind, p, g, least in secrets.BASE_KINDS for m in re.finditer(p, text, re.ASCII) if len(m[g]) >= least]
        assert (after[i] != text) if hits else (after[i] == text or pipeline.MASK in after[i])
        assert not any(m[0] in after[i] for m in hits)


def test_mixing(stages):
    before = {r["doc_id"]: (r["text"], r["taken"], r["size"]) for r in mixing.mixture(stages[3], carry=("text",)).collect()}
    after = collections.defaultdict(list)
    for r in stages[4].collect():
        after[r["doc_id"]].append(r["text"])
    for i, (text, taken, size) in before.items():
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in after.get(i, [])]
        assert sum(words) == taken and all(t == text or text.lstrip(" \t\n\r\v\f").startswith(t) for t in after.get(i, []))


def test_packing(stages):
    rows = stages[5].collect()
    documents = stages[4].count()
    assert sum(r["start"] == 0 for r in rows) == documents
    sums = collections.Counter()
    for r in rows:
        sums[r["sequence_id"]] += r["length"]
    assert max(sums.values()) <= 4096


def test_run_on_an_empty_table(spark, tmp_path):
    for t in ("documents", "labels"):
        queries.table(spark, SF, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_keep_rows_without_an_id(spark):
    """No row that resembles no other is lost, whatever its id; of a class one row stays."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (1, f"{long} more"), (1, "quite another text of the same id"), (None, f"new {long}"), (None, "a row without any id at all"), (None, None), (None, ""), (2, " "), (3, "twice the same row here"), (3, "twice the same row here")]
    frame = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = collections.Counter((r["doc_id"], r["text"]) for r in pipeline.dedup_stage(spark, frame, SF).collect())
    lone = [(1, "quite another text of the same id"), (None, "a row without any id at all"), (None, None), (None, ""), (2, " "), (3, "twice the same row here")]
    assert all(got.pop(k) == 1 for k in lone)
    assert len(got) == 1 and sum(got.values()) == 1 and next(iter(got))[0] == 1
