"""Operators 11 to 13 against brute force, and on the awkward tables."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill.llm import cws, fingerprints, fptree, lexsearch, ordered, periodic, queries, wordhash
from test_llm_operators import ODD, WORD, base_texts, docs


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    queries.prepare(spark)


def brute_runs(words, least=6, powers=4):
    found = {}
    for p in range(1, len(words) // powers + 1):
        i = 0
        while i < len(words) - p:
            start = i
            while i < len(words) - p and words[i] == words[i + p]:
                i += 1
            if i > start and i - start + p >= max(least, powers * p):
                found.setdefault((start, i - start + p), p)
            i += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def test_find_runs():
    """Random words of few letters, half of the texts with a planted repeat."""
    rng = np.random.default_rng(0)
    for _ in range(150):
        texts = []
        for _ in range(5):
            n = int(rng.integers(0, 120))
            words = rng.integers(0, rng.integers(1, 4), n).tolist()
            if n > 10 and rng.random() < 0.5:
                a = int(rng.integers(0, n))
                p = 1 + (n - a) // (3 + int(rng.integers(0, 8)))
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        rows = periodic.find_runs(wordhash.mix(np.array([w for t in texts for w in t], np.uint64)), bounds)
        for i, words in enumerate(texts):
            assert [tuple(map(int, r[1:])) for r in rows if r[0] == i] == brute_runs(words), words


def test_runs_whose_grams_recur_inside_a_period():
    """Every short gram of the period recurs before it ends; only long ones tell the lag."""
    period = ["a"] * 7 + ["b"] + ["a"] * 8 + ["b"]
    words = ["x"] + period * 5 + ["y"]
    hashes = wordhash.mix(np.array([ord(w) for w in words], np.uint64))
    got = [tuple(map(int, r[1:])) for r in periodic.find_runs(hashes, np.array([0, len(words)]))]
    assert got == brute_runs(words) and (1, 85, 17) in got


def test_periodic_runs(spark):
    texts = [*ODD, "na " * 12, "a b a b a b a b c", "x " + "p q r\t" * 4, "one two " * 3000, "é é é é é é 中 中"]
    rows = {r["doc_id"]: r for r in periodic.periodic_runs(docs(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        words = WORD.findall(t or "")
        runs = brute_runs(words) if len(words) < 10_000 else []
        dropped = {j for s, n, p in runs for j in range(s + p, s + n)}
        assert [tuple(r) for r in rows[i]["runs"]] == runs, t
        assert rows[i]["n_words"] == len(words) and rows[i]["collapsed"] == " ".join(w for j, w in enumerate(words) if j not in dropped)
    again = docs(spark, ["a a a a a a", "a a a a a a"], ids=[3, 3])
    assert [r["collapsed"] for r in periodic.periodic_runs(again).collect()] == ["a", "a"]
    assert periodic.periodic_runs(docs(spark, [])).count() == 0


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(texts, items, k=10):
    held = [collections.Counter(terms(t)) for t in texts]
    sizes = [sum(h.values()) for h in held]
    total, long = sum(n > 0 for n in sizes), sum(sizes)
    count = collections.Counter(t for h in held for t in h)
    out = {}
    for i, item in enumerate(items):
        scores = []
        for d, (h, n) in enumerate(zip(held, sizes)):
            m = 100 - 75 + (75 * n * total) // long if n else 1
            s = sum(math.floor(1000 * math.log((2.0 * total + 2) / (2.0 * count[t] + 1))) * ((10**9 * h[t]) // (1000 * h[t] + 8 * m)) for t in terms(item) if h[t])
            if s > 0:
                scores.append((-s, d))
        out[i] = [(d, -s) for s, d in sorted(scores)[:k]]
    return out


def test_search(spark, monkeypatch):
    """Ties, copies, several blocks of items and many small trees."""
    monkeypatch.setattr(lexsearch, "BLOCK_ITEMS", 9)
    monkeypatch.setattr(lexsearch, "CHUNK", 90)
    texts = [t for t in base_texts()] + ["A-b c_d;é3"] * 30 + ["b b b a", "a B"]
    rng = np.random.default_rng(6)
    items = [" ".join(WORD.findall(texts[i] or "")[:9]) for i in rng.integers(0, len(texts), 20)] + ["a a B", "zzz", None, "", "d é3, É3", "one two one"]
    frame = spark.createDataFrame([(i, t, 5, 1.5) for i, t in enumerate(items)], "item_id long, text string, doc_id long, score double")
    got = collections.defaultdict(list)
    for r in lexsearch.rank_documents(docs(spark, texts).repartition(3), frame).orderBy("item_id", "rank").collect():
        got[r["item_id"]].append((r["doc_id"], r["score"]))
        assert r["rank"] == len(got[r["item_id"]])
    want = brute_search(texts, items)
    assert {i: got.get(i, []) for i in want} == want


def test_search_edges(spark):
    frame = spark.createDataFrame([(7, "a b"), (7, "a b"), (None, "a"), (8, None)], "item_id long, text string")
    found = docs(spark, ["a", "a", "a c", "b"], ids=[2, None, 2, 1])
    rows = lexsearch.rank_documents(found, frame).collect()
    mine = sorted((r["rank"], r["doc_id"] if r["doc_id"] is not None else 99) for r in rows if r["item_id"] is None)
    assert mine == [(1, 2), (2, 99), (3, 2)] and sum(r["item_id"] == 7 for r in rows) == 8
    assert lexsearch.rank_documents(docs(spark, []), frame).count() == 0
    assert lexsearch.rank_documents(docs(spark, ["a"]), frame.limit(0)).count() == 0
    assert lexsearch.rank_documents(docs(spark, [None, "--"]), frame).count() == 0


def test_tree_passes_documents_over():
    """Bounds hold at every node, and documents of other languages need no score."""
    rng = np.random.default_rng(3)
    size, vocabulary = 6000, 400
    sizes, chance = rng.integers(1, 30, size), 1 / np.arange(5, 105)
    # Four languages of a hundred words each.
    rows = [np.sort(4 * rng.choice(100, n, replace=False, p=chance / chance.sum()) + rng.integers(0, 4)) for n in sizes]
    tf, m = rng.integers(1, 5, sizes.sum()), rng.integers(30, 400, size)
    tree = fptree.Tree(sizes, np.concatenate(rows), tf, m, np.arange(size), np.zeros(size, bool), vocabulary)
    held = np.zeros((size, vocabulary), np.int64)
    held[np.repeat(np.arange(size), sizes), np.concatenate(rows)] = fptree.saturation(tf, np.repeat(m, sizes))
    for low, high, a, b in zip(tree.low, tree.high, tree.node_starts[:-1], tree.node_starts[1:]):
        most = held[tree.ids[low:high]].max(0)
        bound = np.zeros(vocabulary, np.int64)
        bound[tree.node_terms[a:b]] = tree.node_gain[a:b]
        assert (bound >= most).all()
    scored = 0
    for i in range(20):
        weights = np.zeros(vocabulary, np.int64)
        weights[rows[int(np.flatnonzero(sizes > 20)[i])]] = rng.integers(3000, 9000, sizes[np.flatnonzero(sizes > 20)[i]])
        board = fptree.Board(1, 10)
        scored += tree.search(weights, board, 0)
        scores = held @ weights
        order = [d for d in np.lexsort((np.arange(size), -scores)) if scores[d] > 0][:10]
        assert board.rows[0][2].tolist() == order and board.rows[0][0].tolist() == scores[order].tolist()
    assert scored < 0.35 * 20 * size


def jaccard(a, b):
    a, b = (collections.Counter(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for t in (a, b))
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 1.0


def test_samples_collide_as_often_as_weights_overlap():
    """Over many samples the rate is the generalised Jaccard similarity, for real weights too."""
    rng = np.random.default_rng(2)
    for _ in range(6):
        a, b = rng.gamma(1.0, 3.0, (2, 40)) * (rng.random((2, 40)) < 0.8)
        rate, want = [], np.minimum(a, b).sum() / np.maximum(a, b).sum()
        for trial in range(30):
            terms = rng.integers(0, 2**63, 40, dtype=np.uint64)
            sampler = cws.Sampler()
            x, y = (sampler.signatures(terms[w > 0], w[w > 0], np.array([0, (w > 0).sum()]))[0] for w in (a, b))
            rate.append((x == y).mean())
        assert abs(np.mean(rate) - want) < 4 * math.sqrt(want * (1 - want) / (30 * cws.SAMPLES)) + 1e-3


def test_signatures_do_not_depend_on_the_cache(monkeypatch):
    rng = np.random.default_rng(5)
    terms, weights = rng.integers(0, 2**63, 900, dtype=np.uint64), rng.integers(1, 9, 900).astype(float)
    bounds = np.array([0, 0, 400, 401, 900, 900])
    want = cws.Sampler().signatures(terms, weights, bounds)
    monkeypatch.setattr(cws, "CACHE", 64)
    monkeypatch.setattr(cws, "_ROWS", 16)
    assert (cws.Sampler().signatures(terms, weights, bounds) == want).all() and (want[0] == want[4]).all()


def test_fingerprints_and_edits(spark):
    texts = base_texts()
    frame = docs(spark, texts)
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(frame).collect()}
    rows = {r["doc_id"]: r for r in fingerprints.compare_edits(frame.repartition(4)).withColumn("also", fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint"))).collect()}
    assert len(rows) == len(texts)
    error = []
    for i, t in enumerate(texts):
        t, after, r = t or "", texts[(i + 1) % len(texts)] or "", rows[i]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert r["n_chars"] == len(t) and r["edited"] == edited and r["fingerprint"] == plain[i]
        assert r["near_edited"] == pytest.approx(r["also"])
        assert r["near_next"] == np.mean([plain[i][k : k + 4] == plain[(i + 1) % len(texts)][k : k + 4] for k in range(0, 512, 4)])
        error += [r["near_edited"] - jaccard(t, edited), r["near_next"] - jaccard(t, after)]
    assert np.abs(error).max() < 0.2 and np.abs(np.mean(error)) < 0.01
    same = collections.defaultdict(set)
    for i, t in enumerate(texts):
        same[t].add(plain[i])
    assert all(len(s) == 1 for s in same.values())
    assert fingerprints.fingerprints(docs(spark, [])).count() == fingerprints.compare_edits(docs(spark, [])).count() == 0


def test_edits_with_repeated_and_null_ids(spark):
    ids = [5, 5, 5, None, None, 9, 1] + [5] * 40
    texts = ["aa", "bb", "bb", "cc", None, "dd dd", "zz"] + [f"w{i} v{i}" for i in range(40)]
    frame = docs(spark, texts, ids)
    rows = fingerprints.compare_edits(frame).collect()
    assert collections.Counter(r["doc_id"] for r in rows) == collections.Counter(ids)
    assert sorted(map(str, rows)) == sorted(map(str, fingerprints.compare_edits(frame.repartition(3)).collect()))
    lone = fingerprints.compare_edits(docs(spark, ["abcd"])).first()
    assert lone["edited"] == "abab" and lone["near_next"] == 1.0


def test_order_is_cut_evenly(spark):
    """An id that holds a third of all rows is cut too, and every bucket ends with the row that follows it."""
    frame = spark.range(3000).selectExpr("if(id % 3 = 0, 1500, id) as id", "cast(id as string) as text")
    rows = ordered.in_order(frame, "text").collect()
    by_bucket = collections.defaultdict(list)
    for r in rows:
        by_bucket[r["bucket"]].append(r)
    own = {b: [r for r in rs if not r["lead"]] for b, rs in by_bucket.items()}
    assert sum(map(len, own.values())) == 3000 and max(map(len, own.values())) < 3 * 3000 / len(own)
    names = sorted(own)
    for b, after in zip(names, names[1:] + names[:1]):
        assert by_bucket[b][-1]["lead"] and by_bucket[b][-1]["text"] == own[after][0]["text"]


def test_planted(spark):
    """The texts of op12 by the words of its contract."""
    import zlib

    texts = [" ".join(f"w{j}" for j in range(i % 40)) for i in range(400)]
    for r in queries.planted(docs(spark, texts)).collect():
        words = (texts[r["doc_id"]] or "").split()
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert (r["text"] or "").split() == words


def test_digests_of_edits(spark, sf_dir):
    rows = queries.QUERIES["op13_fingerprints"](spark, sf_dir).collect()
    texts = sorted((r["doc_id"], r["text"] or "") for r in queries.table(spark, sf_dir, "documents").collect())
    after = {i: texts[(k + 1) % len(texts)][1] for k, (i, _) in enumerate(texts)}
    own = dict(texts)
    assert len(rows) == len(texts)
    for r in rows:
        t = own[r["doc_id"]]
        edited = t[: len(t) - len(t) // 2] + after[r["doc_id"]][: len(t) // 2]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and r["n_chars"] == len(t)
