"""A host's repeats against brute force."""

import collections

import numpy as np
import pytest

from faremill.llm import extraction, html_blocks, queries
from faremill.llm.extraction import extract


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    queries.prepare(spark)


def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(40):
        sizes = rng.integers(1, 30, 8)
        tokens, owner = rng.integers(0, rng.integers(1, 4), sizes.sum()).astype(np.uint64), np.repeat(np.arange(8), sizes)
        ends = np.cumsum(sizes)
        suffixes = [tuple(int(t) + 1 for t in tokens[i : min(i + extraction.RUN, ends[owner[i]])]) for i in range(len(tokens))]
        order, lcp = extraction.suffix_array(tokens, owner)
        assert sorted(order.tolist()) == list(range(len(tokens)))
        ranked = [suffixes[i] for i in order]
        assert ranked == sorted(suffixes)
        for a, b, n in zip(ranked, ranked[1:], lcp[1:]):
            common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert n == common


def test_equal_substrings_share_an_anchor():
    rng = np.random.default_rng(2)
    long = extraction.RUN + extraction.WINDOW - 1
    for _ in range(60):
        shared = rng.integers(0, 2**63, long, dtype=np.uint64)
        keys = []
        for _ in range(2):
            parts = [rng.integers(0, 2**63, rng.integers(0, 20), dtype=np.uint64), shared, rng.integers(0, 2**63, rng.integers(0, 20), dtype=np.uint64)]
            tokens = np.concatenate(parts)
            places, own = extraction.anchors(tokens, np.zeros(len(tokens), np.int64))
            inside = (places >= len(parts[0])) & (places + extraction.RUN <= len(parts[0]) + long)
            keys.append(set(own[inside].tolist()))
        assert keys[0] & keys[1]
    blocks = rng.integers(0, 2**63, 5, dtype=np.uint64)
    assert extraction.anchors(blocks, np.zeros(5, np.int64))[0].tolist() == [0]


def brute_keys(pages):
    """Of each host the anchors on enough of its distinct pages."""
    held, sizes = collections.defaultdict(set), collections.defaultdict(set)
    for host, blocks in pages:
        tokens, stream, _, owner = extraction._streams([blocks])
        text = tuple(tokens.tolist())
        sizes[host].add(text)
        for key in extraction.anchors(tokens, owner)[1].view(np.int64).tolist() if len(tokens) else []:
            held[host, key].add(text)
    return {(h, k) for (h, k), texts in held.items() if len(texts) >= extraction.LEAST_PAGES and len(texts) >= extraction.SHARE * len(sizes[h])}


def test_repeats_over_many_tasks(spark, monkeypatch):
    """Hosts, copies, a hot host and small slices: the same anchors as counting with sets."""
    monkeypatch.setattr(extraction, "PAGES", 7)
    rng = np.random.default_rng(3)
    shared = [" ".join(f"s{i}w{k}" for k in range(12)) for i in range(6)]
    pages = []
    for i in range(240):
        host = 0 if i % 3 else int(rng.integers(1, 12))
        blocks = [" ".join(f"p{i}x{b}y{k}" for k in range(int(rng.integers(1, 40)))) for b in range(3)]
        blocks += [f"intro {i} {s} tail" for j, s in enumerate(shared) if rng.random() < (j + 1) / 8] + [s for j, s in enumerate(shared) if rng.random() < 0.1]
        pages += [(host, blocks)] * (1 + int(i % 40 == 0))
    rows = [(h, extraction._packed(b), int(extraction._page_ids(*extraction._streams([b])[:2], 1)[0])) for h, b in pages]
    frame = spark.createDataFrame(rows, "host long, packed binary, page long").repartition(9)
    got = {(r["host"], k) for r in extraction._repeats(frame).collect() for k in r["keys"]}
    assert got == brute_keys(pages) and got


def test_few_repeats_stay_everywhere(spark):
    """What a host has on few of its pages stays on all of them, in articles and outside; what it has on most goes."""
    line = "The and attion to thanedble the, anea. Eriner thanea in a long sentence that repeats."
    notice = "All rights of this paper are reserved by the readers who made all of this work possible."
    pages = []
    for host, count, times in (("a", 13, 2), ("b", 29, 3), ("c", 7, 1), ("d", 6, 6)):
        for i in range(count):
            own = " ".join(f"{host}{i}story{k}" for k in range(25))
            pages.append((len(pages), f"http://{host}.org/{i}", f"<article><p>{own}</p>{f'<p>{line}</p>' if i < times else ''}<p>{notice}</p></article>", host, i < times, own))
    frame = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract(frame).collect()}
    for i, _, _, host, has, own in pages:
        assert got[i] == "\n\n".join([own, line] if has and host != "d" else [own]), (host, i)


def test_articles_of_the_given_pages_are_whole(spark):
    """Of all article blocks of sf0.01, none is lost to repeats."""
    pages = queries.table(spark, "/root/testdata/sf0.01", "pages")
    got = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    lost = total = 0
    for r in pages.collect():
        own = [t for t, zone, _ in html_blocks.blocks(r["html"] or "") if zone >= html_blocks.ARTICLE]
        kept = collections.Counter(got[r["page_id"]].split("\n\n"))
        total += len(own)
        lost += sum(max(0, n - kept[t]) for t, n in collections.Counter(own).items())
    assert total > 1000 and lost == 0


def test_very_long_pages_and_extra_columns(spark):
    words = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, "http://x.org/1", f"<p>{words}</p>", "k", 5), (2, "http://x.org/2", "<p>" * 3000 + "deep", "k", 5), (3, "http://x.org/3", f"<article>{'<p>again and again the same eight words here</p>' * 500}</article>", "k", 5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, keys string, packed int")
    got = {r["page_id"]: r["text"] for r in extract(frame).collect()}
    assert got[1] == words and got[2] == "deep" and got[3].count("again and again") == 500
