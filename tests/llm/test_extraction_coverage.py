"""How many tokens of a block boilerplate covers: decided by the common prefixes of sorted suffixes."""

import collections

import numpy as np
import pytest

from faremill.llm import extraction, queries
from faremill.llm.extraction import extract


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    queries.prepare(spark)


def words(name, n):
    return " ".join(f"{name}w{k}" for k in range(n))


def test_only_repeated_tokens_count(spark):
    """A phrase that a third of a unique block repeats does not make it boilerplate; one that fills most of it does."""
    rows, kept = [], {}
    for h in range(16):
        for i in range(12):
            own = f"h{h}p{i}"
            phrase = f"{words(own + 'a', 9)} {words(f'h{h}phrase', 8)} {words(own + 'b', 9)}"
            long_tail = f"{words(f'h{h}lead', 24)} {words(own + 'c', 40)}"
            short_tail = f"{words(f'h{h}line', 36)} {words(own + 'd', 9)}"
            blocks = [words(own, 30), phrase, long_tail, short_tail]
            html = "".join(f"<p>{b}</p>" for b in blocks)
            kept[len(rows)] = "\n\n".join(blocks[:3])
            rows.append((len(rows), f"http://h{h}.org/{i}", html))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert {r["page_id"]: r["text"] for r in extract(frame).collect()} == kept


def test_one_odd_page_does_not_hide_a_line(spark):
    """A line that most pages hold goes from them, though one page has a few of its words in another place."""
    line = [f"l{k}" for k in range(60)]
    rows = [(i, f"http://a.org/{i}", f"<p>{words(f'p{i}', 30)}</p><p>{' '.join(line)}</p>") for i in range(20)]
    rows += [(20 + k, f"http://a.org/odd{k}", f"<p>{words(f'o{k}', 30)} {' '.join(line[k : k + 9])} {words(f'q{k}', 30)}</p>") for k in range(0, 51, 3)]
    got = {r["page_id"]: r["text"] for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    assert all(got[i] == words(f"p{i}", 30) for i in range(20))
    assert all(got[r[0]] == r[2][3:-4] for r in rows[20:])


def brute_matched(blocks, strings):
    runs, out = {tuple(s[i : i + extraction.RUN]) for s in strings for i in range(len(s) - extraction.RUN + 1)}, []
    whole = {tuple(s) for s in strings if len(s) < extraction.RUN}
    for b in blocks:
        hit = {j for i in range(len(b) - extraction.RUN + 1) if tuple(b[i : i + extraction.RUN]) in runs for j in range(i, i + extraction.RUN)}
        out += [j in hit or tuple(b) in whole for j in range(len(b))]
    return out


def test_matched_against_brute_force():
    rng = np.random.default_rng(5)
    some = 0
    for _ in range(150):
        strings = [rng.integers(0, 3, rng.integers(1, extraction.REACH + 1)).astype(np.uint64) for _ in range(rng.integers(1, 8))]
        blocks = [rng.integers(0, 3, rng.integers(1, 60)).astype(np.uint64) for _ in range(rng.integers(1, 8))]
        blocks += [np.concatenate([blocks[0], strings[0], blocks[-1]]), strings[-1]]
        owner = np.repeat(np.arange(len(blocks)), [len(b) for b in blocks])
        got = extraction.matched(np.concatenate(blocks), owner, strings).tolist()
        assert got == brute_matched([b.tolist() for b in blocks], [s.tolist() for s in strings])
        some += 0 < sum(got) < len(got)
    assert some > 50


def test_strings_against_brute_force(spark, monkeypatch):
    """Over many tasks, hosts and copies of pages: of each repeated anchor what all its occurrences share, and frequent surroundings."""
    monkeypatch.setattr(extraction, "PAGES", 7)
    rng = np.random.default_rng(6)
    pages = []
    for i in range(150):
        host, line = int(rng.integers(0, 3)), words(f"s{i % 2}", 30)
        blocks = [words(f"p{i}", 20), line if i % 5 else f"{line} {words(f't{i}', 5)}", "one two", f"{words(f'u{i}', 3)} {words('m', 25)}"]
        pages += [(host, blocks)] * (1 + i % 3 // 2)
    rows = [(h, extraction._packed(b), int(extraction._page_ids(*extraction._streams([b])[:2], 1)[0])) for h, b in pages]
    frame = spark.createDataFrame(rows, "host long, packed binary, page long").repartition(9)
    repeats = extraction._repeats(frame)
    got = {r["host"]: (set(r["keys"]), set(map(bytes, r["strings"]))) for r in extraction._strings(frame, repeats).collect()}
    asked = {r["host"]: (r["least"], set(r["keys"])) for r in repeats.collect()}
    found, held = collections.defaultdict(list), collections.defaultdict(set)
    for host, blocks in pages:
        tokens, _, _, owner = extraction._streams([blocks])
        places, keys = extraction.anchors(tokens, owner)
        edges = [(0 if j == 0 or owner[places[j - 1]] != owner[p] else places[j - 1] + 1, p) for j, p in enumerate(places)]
        for j, ((b, p), key) in enumerate(zip(edges, keys.view(np.int64).tolist())):
            block = np.flatnonzero(owner == owner[p])
            b = max(b, block[0])
            e = places[j + 1] + extraction.RUN - 1 if j + 1 < len(places) and owner[places[j + 1]] == owner[p] else block[-1] + 1
            assert e - b <= extraction.REACH
            if key in asked[host][1]:
                context = (tokens[b:p].tolist(), tokens[p:e].tolist())
                found[host, key].append(context)
                held[host, key, str(context)].add(tuple(blocks))
    strings = collections.defaultdict(set)
    for (host, key), contexts in found.items():
        prefix = lambda xs: next((xs[0][:n] for n in range(len(xs[0]), 0, -1) if all(x[:n] == xs[0][:n] for x in xs)), [])
        before = prefix([c[0][::-1] for c in contexts])[::-1]
        strings[host].add(np.array(before + prefix([c[1] for c in contexts]), np.uint64).tobytes())
        strings[host] |= {np.array(b + a, np.uint64).tobytes() for b, a in contexts if len(held[host, key, str((b, a))]) >= asked[host][0]}
    assert got == {h: (keys, strings[h]) for h, (_, keys) in asked.items()} and len(got) == 3
