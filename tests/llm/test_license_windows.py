"""Licence notices that share their line with other words, or are wrapped."""

import random
import re
from collections import Counter

import pytest

from terracube.llm import license_scan


def test_notices_amid_other_words(spark):
    gpl = license_scan.TEMPLATES["GPL-3.0"].split()
    wrapped = "\n".join(" * " + " ".join(gpl[i : i + 9]) for i in range(0, len(gpl), 9))
    about = " * reads the tables of a file and writes them again in another order, one column at a time\n" * 4
    rows = [(1, "Copyright 2020 Example Corp. Licensed under the Apache License, Version 2.0."),
            (2, "All the source files of this small project are released under the MIT License, and the pictures are not. " * 2),
            (3, f"/*\n * Copyright (C) 2019 some author of this file and others\n *\n{about}{wrapped}\n *\n */\nint main() {{ return 0; }}"),
            (4, "the license of the software and the public domain " * 400), (5, "")]
    got = {r.doc_id: (r.n_units, r.licences, r.dice) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == (1, ["Apache-2.0"], 1.0)
    assert got[2] == (1, ["MIT-2"], 1.0)
    assert got[3] == (2, ["GPL-2.0", "GPL-3.0"], 1.0)
    assert got[4] == got[5] == (0, [], None)


def grams(words):
    return [" ".join(p) for p in zip(words, words[1:])]


def dice(a, b):
    a, b = Counter(a), Counter(b)
    return 2 * sum((a & b).values()) / max(1, sum(a.values()) + sum(b.values()))


def brute(text, templates, threshold=0.8):
    """Every unit against every template, then every window for the templates that no unit matched."""
    pieces = [text, *re.split(r"\n[ \t\r]*\n", text), *text.split("\n")]
    units = {" ".join(re.findall(r"\w+", p.lower())) for p in pieces} - {""}
    hits = [(d, n) for n, t in templates.items() for u in units if (d := dice(grams(u.split()), grams(t.split()))) >= threshold]
    whole, windows = grams(re.findall(r"\w+", text.lower())), []
    for n, t in templates.items():
        if n not in {x for _, x in hits}:
            own = grams(t.split())
            best = max((dice(whole[i:j], own) for i in range(len(whole)) for j in range(i + 1, min(len(whole), i + 2 * len(own)) + 1)), default=0)
            if best >= threshold:
                windows.append((best, n))
    return hits + windows, len(windows)


def test_windows_equal_all_windows_of_random_texts(spark):
    rng, vocabulary = random.Random(9), [f"v{k}" for k in range(7)]
    templates = {f"T{k}": " ".join(rng.choice(vocabulary) for _ in range(n)) for k, n in enumerate((3, 5, 6, 9, 14))}
    templates["T5"] = "v1 v2 v1 v2 v1 v2"
    rows, by_window = [], 0
    for i in range(400):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 9))]
            notice = rng.choice(list(templates.values())).split()
            if rng.random() < 0.5:
                notice[rng.randrange(len(notice))] = "other"
            words += notice
        rows.append((i, "".join(w + rng.choice((" ", " ", " ", "\n", "\n\n", ", ")) for w in words)))
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect()}
    for i, text in rows:
        hits, n = brute(text, templates)
        by_window += n
        assert got[i].n_units == len(hits) and got[i].licences == sorted({x for _, x in hits}), (i, text)
        if hits:
            best = max(d for d, _ in hits)
            assert got[i].dice == pytest.approx(best) and got[i].licence == min(x for d, x in hits if abs(d - best) < 1e-12), (i, text, hits, got[i])
    assert by_window > 200
