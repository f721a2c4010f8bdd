from faremill.llm.licenses import scan_licenses


def test_licenses(spark):
    rows = [
        (1, "a/b/code.py", "x = 1"), (2, "a/LICENSE", "Released under the MIT License."), (3, "a/c/own.py", "code\nLicensed under CC BY-NC 4.0.\ncode"), (4, "top.py", None), (5, None, ""),
        (6, "a/b/d/LICENSE", "Licensed under the Apache License, Version 2.0."), (7, "a/b/d/e/f.py", "driver license renewal office"), (7, "a/b/d/e/f.py", "driver license renewal office"),
    ]
    frame = spark.createDataFrame([(*r, "x", "own") for r in rows], "doc_id long, path string, text string, dir string, own string")
    got = {r["doc_id"]: (r["license"], r["origin"]) for r in scan_licenses(frame, path=frame["path"]).collect()}
    assert got == {1: ("MIT", "inherited"), 2: ("MIT", "own"), 3: ("CC-BY-NC-4.0", "own"), 4: (None, None), 5: (None, None), 6: ("Apache-2.0", "own"), 7: ("Apache-2.0", "inherited")}
    assert scan_licenses(frame, path=frame["path"]).count() == len(rows) and scan_licenses(frame.limit(0), path=frame["path"]).count() == 0


def test_bodies_tags_and_notices_in_long_lines(spark):
    import os

    from faremill.llm import licenses

    body = {n: open(os.path.join(licenses.TEXTS, f"{n}.txt")).read() for n in ("MIT", "BSD-3-Clause")}
    texts = {
        "MIT": [body["MIT"][body["MIT"].index("Permission") :].replace("\n", " "), "# SPDX-License-Identifier: MIT\ncode", "We met there. " * 9 + "Released under the MIT License. We then " + "went home " * 20],
        "BSD-3-Clause": [body["BSD-3-Clause"][body["BSD-3-Clause"].index("Redistribution") :], "SPDX-License-Identifier: BSD-3-Clause"],
        "Apache-2.0": ["SPDX-License-Identifier: Apache-2.0", "Apache License"], None: ["SPDX-License-Identifier: Zlib", "driver license renewal office"],
    }
    rows = [(i, f"{i}/x.txt", t, n) for i, (n, t) in enumerate((n, t) for n, ts in texts.items() for t in ts)]
    frame = spark.createDataFrame([r[:3] for r in rows], "doc_id long, path string, text string")
    got = {r["doc_id"]: r["license"] for r in licenses.scan_licenses(frame, path=frame["path"]).collect()}
    assert got == {i: n for i, _, _, n in rows}


def brute(texts, licenses):
    """Each text's best cosine over all windows and templates, without telling words, numbers or anchors."""
    import math
    from collections import Counter

    templates, tokens = licenses._templates(), [licenses._words(t or "") for t in texts]
    count = len(texts) + len(templates)
    known = Counter(w for _, _, t in templates for w in set(t))
    words = set(known)
    known.update(w for t in tokens for w in set(t) & words)
    rarity = {w: math.log((1 + count) / (1 + n)) + 1 for w, n in known.items()}
    unseen, out = math.log(1 + count) + 1, []
    for t in tokens:
        best = (0.0, "")
        for name, needs, own in templates:
            unit = {w: c * rarity[w] for w, c in Counter(own).items()}
            norm = math.sqrt(sum(x * x for x in unit.values()))
            size, step = (len(own), 1) if needs else (licenses.BODY, licenses.BODY // 2)
            last = max(len(t) - size, 0) if needs else max(len(t) - 1 - licenses.BODY // 2, 0)
            for at in range(0, last + 1, step):
                window = t[at : at + size]
                held = Counter(w for w in window if w in words)
                shared = set(own) & set(held)
                fits = set(needs) <= set(held) if needs else sum(held.values()) >= licenses.BODY // 4 and len(shared) >= licenses.BODY // 4
                if window and fits:
                    square = sum((c * rarity[w]) ** 2 for w, c in held.items()) + (len(window) - sum(held.values())) * unseen**2
                    best = max(best, (round(sum(held[w] * rarity[w] * unit[w] / norm for w in shared) / math.sqrt(square), 6), name))
        out.append(best)
    return out


def test_windows_against_brute_force(spark):
    """Ties, a very long text and mangled bodies: the same best cosine wherever it reaches the threshold."""
    import os
    import random

    from faremill.llm import licenses

    rng = random.Random(4)
    bodies = [open(os.path.join(licenses.TEXTS, f)).read().split() for f in sorted(os.listdir(licenses.TEXTS))]
    texts = [None, "", "mit", "MIT MIT MIT license license", "1 2 3 4 5 6 7 8 9 10", "x " * 20_000 + "released under the MIT license " + "y " * 20_000]
    for body in bodies:
        at = rng.randrange(max(1, len(body) - 120))
        part = body[at : at + 100]
        for share in (0.0, 0.1, 0.3, 0.5):
            texts.append(" ".join(w if rng.random() >= share else f"zz{rng.randrange(99)}" for w in part))
    for _, _, notice in licenses.NOTICES:
        texts += [f"so {notice} it is", " ".join(w if rng.random() < 0.7 else "other" for w in notice.split())]
    frame = spark.createDataFrame([(i, f"d{i}/x", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(frame, path=frame["path"]).collect()}
    hits = 0
    for i, (cosine, name) in enumerate(brute(texts, licenses)):
        if cosine >= licenses.LEAST:
            hits += 1
            assert abs(got[i]["cosine"] - cosine) <= 1e-6 and got[i]["license"] == name, texts[i]
        else:
            assert got[i]["license"] is None and got[i]["cosine"] < licenses.LEAST
    assert hits > 20
