"""Filter audit: streamed counters and all orders against plain Python."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from terracube.llm import filter_audit

DOC = "doc_id long, text string, lang string, bits int, n string"
LAB = "doc_id long, quality int, toxic int"


def rows_of(n):
    words = [f"w{i}" for i in range(140)]
    kinds = [" ".join(words), " ".join(words[:60] * 3), "short text", "A B C D " * 40, " ".join(words) + " 5 %", "", None, "LOUD # " * 60, " \t\n"]
    rows = [(i, kinds[i % 9] if i % 4 else f"{kinds[i % 9] or ''} {i}", ("en", "de", None, "")[i % 4], i, "x") for i in range(n, 0, -1)]
    return rows + [(None, kinds[0], "en", 1, "x"), (None, kinds[0], "en", 1, "x"), (3, rows[-3][1], rows[-3][2], 9, "y"), (3, rows[-3][1], "fr", 9, "y")]


def labels_of(n):
    return [(i, i % 3 == 0, i % 5 == 0) for i in range(0, n, 2)] + [(3, None, None), (4, 0, 1), (4, 1, 0), (None, 1, 1)]


def fails(rows):
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, lang, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield i, lang or "", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                              bool(re.search("[#$%&*|]", t)), i is not None and i > least[t])


def brute(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    docs, out = list(fails(rows)), {}
    for order in permutations(range(5)):
        name = "".join("ABCDE"[f] for f in order)
        for part in {p for _, p, _ in docs}:
            for step, f in enumerate(order, 1):
                out[part, name, step] = [0] * 6
        for i, part, failed in docs:
            gone = False
            for step, f in enumerate(order, 1):
                c = out[part, name, step]
                c[2] += gone and failed[f]
                c[3] += failed[f] and sum(failed) == 1
                if not gone and failed[f]:
                    gone = True
                    c[1] += 1
                    c[4] += i in good
                    c[5] += i in toxic
                c[0] += not gone
    shapley = defaultdict(int)
    for (part, name, step), c in out.items():
        shapley[part, name[step - 1]] += c[1]
    return {(*k, *c, shapley[k[0], k[1][k[2] - 1]]) for k, c in out.items()}


def test_all_orders_match_brute_force(spark, tmp_path):
    rows, labels = rows_of(90), labels_of(90)
    path = str(tmp_path / "docs.parquet")
    for k in range(6):  # large ids first, so smaller ones keep arriving in later files
        spark.createDataFrame(rows[k::6] if k % 2 else rows[k::6][::-1], DOC).coalesce(1).write.mode("append").parquet(path)
    lab = spark.createDataFrame([(i, None if q is None else int(q), None if t is None else int(t)) for i, q, t in labels], LAB)
    cells = filter_audit.counters(spark, path, lab, batches=6, buckets=3)
    want = Counter((p, sum(b << k for k, b in enumerate(f))) for _, p, f in fails(rows))
    got = Counter()
    for r in cells.collect():
        got[r.part, r["mask"]] += r.n
    assert got == want
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = {tuple(r[c] for c in names) for r in filter_audit.interactions(cells, "ABCDE").collect()}
    assert found == brute(rows, [(i, q, t) for i, q, t in labels])
    one = filter_audit.counters(spark, path, lab, batches=1)
    assert sorted(one.collect()) == sorted(cells.collect())


def test_later_files_retract_earlier_masks(spark, tmp_path):
    path, state = str(tmp_path / "docs.parquet"), str(tmp_path / "state")
    lab = spark.createDataFrame([(7, 1, 0), (2, 0, 1)], LAB)
    text = " ".join(f"w{i}" for i in range(120))

    def add(rows):
        spark.createDataFrame([(i, text, "en", 0, "") for i in rows], DOC).coalesce(1).write.mode("append").parquet(path)
        cells = filter_audit.counters(spark, path, lab, state_dir=state, buckets=2)
        return {(r["mask"], r.good, r.toxic): r.n for r in cells.collect()}

    assert add([7, 9]) == {(0, 1, 0): 1, (16, 0, 0): 1}
    assert add([8]) == {(0, 1, 0): 1, (16, 0, 0): 2}
    assert add([2, 2]) == {(0, 0, 1): 2, (16, 1, 0): 1, (16, 0, 0): 2}  # rows that repeat the smallest id do not fail
    with pytest.raises(ValueError):
        filter_audit.counters(spark, path, lab, state_dir=state)


def test_hot_text_is_combined_in_batches():
    import pandas as pd

    pdf = pd.DataFrame({"id": [5, 3, 3, 9, 0], "key": [b"k"] * 5, "part": ["en"] * 5, "bits": [0] * 5, "kind": [0, 0, 0, 0, 2]})
    (out,) = filter_audit._combined([pdf])
    assert sorted(zip(out["id"], out["kind"], out["n"], strict=True)) == [(0, 2, 1), (3, 0, 2), (3, 1, 2)]


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "docs.parquet")
    spark.createDataFrame([], DOC).write.parquet(path)
    cells = filter_audit.counters(spark, path, spark.createDataFrame([], LAB))
    assert filter_audit.interactions(cells, "ABCDE").count() == 0
