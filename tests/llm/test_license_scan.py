import random
import time
from collections import Counter

import numpy as np
import pytest
from corpus import clashing, empty, frame, rows

from sensorlake.llm.license_scan import THRESHOLD, TemplateIndex, content_lines, scan_licenses, window_counts
from sensorlake.llm.license_templates import TEMPLATES


def tokens(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def grams(tokens):
    return set(zip(tokens, tokens[1:]))


def brute(text, templates=TEMPLATES):
    """Every line, paragraph, text and window against every template."""
    lines = content_lines(text or "")
    whole = "\n".join(lines)
    blocks = "\n".join(line if line.strip() else "" for line in lines).split("\n\n")
    found = tokens(whole)
    best = {}
    for name, t in templates.items():
        b, m = grams(tokens(t)), len(tokens(t))
        windows = [found[i : i + m] for i in range(max(len(found) - m, 0) + 1)]
        for unit in [*windows, *map(tokens, [*lines, *blocks, whole])]:
            a = grams(unit)
            score = 2 * len(a & b) / (len(a) + len(b))
            if score >= THRESHOLD:
                best[name] = max(score, best.get(name, 0))
    return sorted(best.items(), key=lambda x: (-x[1], -len(tokens(templates[x[0]])), x[0]))


def edited(rng, text, share):
    words = text.split()
    return " ".join(rng.choice(["", "x", w + " " + w]) if rng.random() < share else w for w in words)


def filler(rng, n):
    return " ".join(rng.choice(["the", "of", "software", "model", "river", "under", "license", "this"]) for _ in range(n))


def test_pruning_changes_nothing():
    rng, index = random.Random(2), TemplateIndex(TEMPLATES, THRESHOLD)
    hits = 0
    for name, t in TEMPLATES.items():
        assert (name, 1.0) in index.scan(t)
        for share in (0.02, 0.1, 0.2):
            text = f"Copyright 2020 Somebody\n\n{edited(rng, t, share)}\n\nother words\n" + rng.choice(["", t.upper()])
            assert index.scan(text) == brute(text)
            text = f"{filler(rng, 30)} {edited(rng, t, share)} {filler(rng, 40)}"
            assert index.scan(text) == brute(text)
            hits += bool(index.scan(text))
    assert hits > 60


def test_window_counts():
    rng = random.Random(3)
    for _ in range(200):
        ids = np.array([rng.randint(-1, 6) for _ in range(rng.randint(1, 30))])
        length = rng.randint(1, 34)
        starts = range(max(len(ids) - length, 0) + 1)
        assert window_counts(ids, length).tolist() == [len({x for x in ids[s : s + length] if x >= 0}) for s in starts]


def test_licences_inside_other_text():
    index = TemplateIndex(TEMPLATES, THRESHOLD)
    rng = random.Random(5)
    other = " ".join(f"w{rng.randint(0, 500)}" for _ in range(300))

    def best(text):
        found = index.scan(text)
        return found[0][0] if found else None

    mit = TEMPLATES["MIT"].replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")
    assert mit.count("\n\n") == 2
    assert best(f"MIT License\n\nCopyright (c) 2020 A Person\n\n{mit}\n\n{other}") == "MIT"
    assert best(f"{other} {TEMPLATES['Apache-2.0 notice']} {other}") == "Apache-2.0 notice"
    assert best(f"{other} Released under the MIT License. {other}") == "MIT line"
    assert best(f"{other}\n// SPDX-License-Identifier: GPL-3.0-or-later\n{other}") == "GPL-3.0 identifier"
    bsd = TEMPLATES["BSD-3-Clause"].replace(" 2. ", "\n\n2. ").replace(" 3. ", "\n\n3. ").replace(" THIS", "\n\nTHIS")
    assert best(f"{other}\n\n{bsd}\n\n{other}") == "BSD-3-Clause"
    commented = "\n".join(f" * {line}" for line in TEMPLATES["GPL notice"].replace(". ", ".\n").split("\n"))
    assert best(f"/*\n * Copyright 2020 A Person\n{commented}\n */\n{other}") == "GPL notice"
    assert best(f"Copyright 2020 A Person. {TEMPLATES['ISC']} {other}") == "ISC"
    assert best(other) is None


def test_every_licence_is_its_own_best():
    index = TemplateIndex(TEMPLATES, THRESHOLD)
    bests = Counter(index.scan(f"a b c d e f\n{t}\ng h i j k l")[0][0] == name for name, t in TEMPLATES.items())
    assert bests == {True: len(TEMPLATES)}


def test_odd_texts():
    index = TemplateIndex(TEMPLATES, THRESHOLD)
    assert [index.scan(t) for t in (None, "", " \n\n", "one", "?!", "word " * 50_000)] == [[]] * 6
    assert index.scan("some text\nReleased under the MIT license\nmore")[0] == ("MIT line", 1.0)
    assert index.scan("Released\nunder the\nMIT License.\n\nmore words that follow")[0] == ("MIT line", 1.0)
    assert index.scan("the MIT campus is under snow") == []
    with pytest.raises(ValueError):
        TemplateIndex({"one": "word"}, THRESHOLD)


def test_long_texts_take_linear_time():
    index, rng = TemplateIndex(TEMPLATES, THRESHOLD), random.Random(6)
    text = filler(rng, 400_000) + " " + TEMPLATES["MIT"]
    start = time.perf_counter()
    assert index.scan(text)[0][0] == "MIT"
    assert time.perf_counter() - start < 10


def test_frame(spark):
    lines = [(9000 + i, f"words before\n{t}\nwords after", "en", "s", 1) for i, t in enumerate(TEMPLATES.values())]
    df = frame(spark).unionByName(spark.createDataFrame(lines, frame(spark).schema))
    got = {}
    for r in scan_licenses(clashing(df, "licenses", "template")).collect():
        got.setdefault((r["doc_id"], r["text"]), [(x["template"], x["score"]) for x in r["licenses"]])
    index = TemplateIndex(TEMPLATES, THRESHOLD)
    want = {(i, t): brute(t) if len(t or "") < 5000 else index.scan(t) for i, t, *_ in [*rows(), *lines]}
    assert got == want and sum(map(bool, want.values())) >= len(TEMPLATES)
    assert scan_licenses(empty(spark)).count() == 0
