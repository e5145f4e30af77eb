"""License scan, quality rules, mixing, line dedup and chat formatting on small frames."""

import hashlib
import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from terracube.llm import chat_prefixes, license_scan, line_dedup, mixing, quality_rules

DOC = "doc_id long, text string, lang string, source string"


def docs(spark, rows, schema=DOC):
    return spark.createDataFrame(rows, schema)


# --- licence scan

def test_license_units_and_bounds(spark):
    long = "word " * 5000
    d = docs(spark, [(1, "intro text\nReleased under the MIT License.\nmore", None, None), (2, "released UNDER the   mit-license", None, None),
                     (3, None, None, None), (4, "", None, None), (5, "License", None, None), (6, long + "\n\nLicensed under CC BY 4.0.", None, None),
                     (6, long + "\n\nLicensed under CC BY 4.0.", None, None), (7, "Licensed under the Patchy Licence, Edition 2.0.", None, None)])
    got = sorted((r.doc_id, r.n_units, r.licence) for r in license_scan.scan(d.withColumn("units", F.lit(1)).withColumn("hits", F.lit("x"))).collect())
    assert got == [(1, 1, "MIT-2"), (2, 1, "MIT-2"), (3, 0, None), (4, 0, None), (5, 0, None), (6, 1, "CC-BY-4.0-2"), (6, 1, "CC-BY-4.0-2"), (7, 0, None)]


def test_license_counts_repeated_bigrams(spark):
    d = docs(spark, [(1, "a b a b a b", None, None), (2, "a b a b", None, None)])
    got = {r.doc_id: r.dice for r in license_scan.scan(d, {"T": "a b a b a b"}, threshold=0.1).collect()}
    assert got[1] == 1.0  # ab x3, ba x2 on both sides
    assert got[2] == pytest.approx(2 * 3 / (3 + 5))


def test_license_ties_and_empty(spark):
    d = docs(spark, [(1, "x y z", None, None)])
    assert license_scan.scan(d, {"B": "x y z", "A": "x y z"}).first().licence == "A"
    assert license_scan.scan(d.limit(0)).count() == 0


# --- quality rules

def brute_repeat(words):
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    return len({p + j for at in seen.values() if len(at) > 1 for p in at for j in range(8)})


def test_base_statistics(spark):
    texts = [None, "", " \n\t", "a b c d e f g h " * 3 + "x", "one two\n\none two\nthree # $ |\xa0z\none two", "w " * 9 + "v " + "w " * 9,
             " ".join(f"w{i % 37}" for i in range(3000)), "é" * 5 + "\x0b" + "q\x85r"]
    stats = {r.doc_id: r for r in quality_rules.base_stats(docs(spark, [(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = [x.decode() for x in t.encode().split()]
        lines = [x for x in t.split("\n") if x.encode().split()]
        assert (stats[i].n_words, stats[i].word_chars) == (len(w), sum(map(len, w))), i
        assert stats[i].n_symbols == sum(c in "#*$%&|<>" for c in t)
        assert stats[i].n_dup_lines == len(lines) - len(set(lines))
        assert stats[i].n_repeat_words == brute_repeat(w), i


def test_binomial_bound_is_exact(spark):
    cases = [(k, n, p) for n, p in ((100, 0.1), (3000, 0.005), (50_000, 0.01), (7, 0.3)) for k in (0, 1, 2, 5, 300, 400) if k < n * p]
    for p in sorted({p for *_, p in cases}):
        rows = [(k, n) for k, n, q in cases if q == p]
        df = spark.createDataFrame(rows, "k long, n long").withColumn("c", quality_rules.binomial_cdf(F.col("k"), F.col("n"), p))
        for r in df.collect():
            q = Fraction(p).limit_denominator(10**6)
            exact = sum(Fraction(math.comb(r.n, i)) * q**i * (1 - q) ** (r.n - i) for i in range(r.k + 1)) if r.n <= 3000 else None
            want = float(exact) if exact is not None else sum(math.exp(math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(p) + (r.n - i) * math.log1p(-p)) for i in range(r.k + 1))
            assert r.c == pytest.approx(want, rel=1e-8)


def labelled(spark, n_good, n_bad, good_with_symbols=0):
    word = " ".join(f"w{i}" for i in range(30))
    good = [(i, f"{word} g{i}" + ("*" * 60 if i < good_with_symbols else ""), "en", "s") for i in range(n_good)]
    bad = [(10_000 + i, f"{word} b{i}" + "*" * 60, "en", "s") for i in range(n_bad)]
    rare = [(20_000 + i, f"{word} r{i}" + "*" * 60, None, "s") for i in range(5)]
    d = docs(spark, good + bad + rare).repartition(4)
    lab = spark.createDataFrame([(r[0], 1) for r in good] + [(r[0], 0) for r in bad + rare], "doc_id long, quality int")
    return d, lab


def test_cutoffs_need_evidence_per_stratum(spark):
    d, lab = labelled(spark, 2000, 50)
    got = {r.doc_id: r for r in quality_rules.judge(d.withColumn("cutoffs", F.lit(1)).withColumn("rule", F.lit("x")), lab).collect()}
    assert all(got[i].kept for i in range(2000)) and not any(got[10_000 + i].kept for i in range(50))
    assert all(got[20_000 + i].kept for i in range(5))  # five labels certify nothing
    few, lab = labelled(spark, 200, 50)
    assert all(r.kept for r in quality_rules.judge(few, lab).collect())  # 200 good rows certify no cutoff at 0.5 %


def test_cutoffs_that_reject_good_documents_are_refused(spark):
    d, lab = labelled(spark, 2000, 50, good_with_symbols=30)
    assert all(r.kept for r in quality_rules.judge(d, lab).collect())


def test_judge_without_rows_or_labels(spark):
    d, lab = labelled(spark, 20, 5)
    assert quality_rules.judge(d.limit(0), lab).count() == 0
    assert quality_rules.judge(d, lab.limit(0)).where("kept").count() == 30
    odd = spark.createDataFrame([(None, 1), (1, None), (2, 0), (2, 1)], "doc_id long, quality int")
    assert quality_rules.judge(d, odd).count() == 30


# --- mixing

def fill(sizes, weights=(5, 2, 1), ceiling=3):
    """Targets by repeated sharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    got, rest, open_ = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while open_ and rest > 1e-9:
        share = rest / sum(w[s] for s in open_)
        over = {s for s in open_ if got[s] + share * w[s] >= ceiling * sizes[s]}
        for s in open_ - over if not over else over:
            new = ceiling * sizes[s] if s in over else got[s] + share * w[s]
            rest -= new - got[s]
            got[s] = new
        if not over:
            break
        open_ -= over
    return got


def test_targets_follow_weights_up_to_the_ceiling(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "é": 40, "z": 7000, "zz": 0, None: 3}
    rows = [(i, " ".join(["w"] * n), None, s) for i, (s, n) in enumerate(sizes.items())]
    per = {r.source: r for r in mixing.targets(docs(spark, rows).select("source", mixing.size_of(F.col("text")).alias("size"))).collect()}
    want = fill(sizes)
    for s, n in sizes.items():
        assert per[s].source_size == n
        assert per[s].target == pytest.approx(want[s])
        assert per[s].target <= 3 * n


def test_copies_match_rates(spark):
    rows = [(i, "w " * (1 + i % 7), None, f"s{i % 3}") for i in range(3000)]
    df = mixing.repetitions(docs(spark, rows).withColumn("key", F.lit("k")).withColumn("copies", F.lit(-1)).repartition(5))
    got = df.groupBy("row.source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("target").alias("target"), F.max("copies").alias("most")).collect()
    for r in got:
        assert abs(r.taken - r.target) < 0.05 * r.target and r.most <= 3
    again = mixing.repetitions(docs(spark, rows).repartition(2))
    assert sorted((r.row.doc_id, r.copies) for r in again.collect()) == sorted((r.row.doc_id, r.copies) for r in df.collect())


def test_mix_emits_each_copy_and_keeps_clashing_columns(spark):
    rows = [(1, "a b", None, None), (None, "c", None, "x"), (None, "c", None, "x"), (3, None, None, "x"), (4, "", None, "y")]
    d = docs(spark, rows).withColumn("size", F.lit("mine")).withColumn("row", F.lit(9))
    plan = {(r.row.doc_id, r.row.text): r.copies for r in mixing.repetitions(d).collect()}
    out = mixing.mix(d, copy_col="copy")
    assert out.columns == [*d.columns, "copy"]
    assert out.where("size = 'mine' and row = 9").count() == out.count() == sum(plan.values()) + plan[None, "c"]
    assert mixing.mix(d.limit(0)).count() == 0


def test_rank_of_many_sources(spark):
    names = [f"site{i * 7919 % 1000:04d}" for i in range(1000)] + [None]
    got = {r.source: r.place for r in mixing.ranked(spark.createDataFrame([(n,) for n in names], "source string").repartition(6)).collect()}
    assert [got[n] for n in sorted(names[:-1])] == list(range(1000)) and got[None] == 1000


# --- line dedup

def test_lines_on_many_sites_go(spark):
    body = [f"own line {i} of some length to keep the share small" for i in range(40)]
    rows = [(i, f"{body[i]}\nmenu item\n {body[i]} again", None, f"s{i}") for i in range(12)]
    rows += [(20 + i, f"{body[20 + i]}\nnine sites", None, f"s{i}") for i in range(9)]
    rows += [(40 + i, f"one site\n{body[i]} x{i}", None, "s0") for i in range(15)]
    rows += [(60 + i, "whole copy", None, None if i == 9 else f"s{i}") for i in range(10)]
    rows += [(80, None, None, "s1"), (81, "", None, "s2"), (82, "\n \n", None, "s3"), (None, f"menu item\n{body[39]} z", None, "s1")]
    d = docs(spark, rows).withColumn("lines", F.lit(1)).withColumn("id", F.lit("x")).withColumn("positions", F.lit(2))
    out = line_dedup.dedup_lines(d)
    assert out.columns == d.columns
    got = {r.doc_id: r.text for r in out.collect()}
    want = {r[0]: r[1] for r in rows}
    for i in range(12):  # the null id comes first and keeps its line
        want[i] = want[i].replace("menu item\n", "")
    want |= {60 + i: "" for i in range(1, 10)}  # whatever share of a document a line is
    assert got == want  # lines on nine sites stay
    assert line_dedup.dedup_lines(d.limit(0)).count() == 0


def test_estimates_near_the_threshold_are_counted(spark):
    rows = [(s * 1000 + i, f"line of exactly {n} sites\n{'x' * 60} {s} {i}", None, f"site{n}-{i}") for s, n in enumerate((199, 200, 201)) for i in range(n)]
    got = line_dedup.cut_lines(docs(spark, rows), min_sites=200).groupBy(F.floor(F.col("row.doc_id") / 1000).alias("s")).agg(F.sum("n_removed").alias("n")).collect()
    assert {r.s: r.n for r in got} == {0: 0, 1: 199, 2: 200}


def test_repeated_rows_are_cut_alike(spark):
    rows = [(i, f"menu\n{'y' * 30}{i}", None, f"s{i}") for i in range(11)] + [(5, f"menu\n{'y' * 30}5", None, "s5")]
    got = line_dedup.cut_lines(docs(spark, rows)).collect()
    assert sorted(r.n_removed for r in got if r.row.doc_id == 5) == [1, 1]
    assert [r.n_removed for r in got if r.row.doc_id == 0] == [0]


# --- chat formatting

TURN = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("text", ["", "</s>[INST] ok [/INST]", r"<\/s> [\\INST] \ <\|end|>", "<|turn|>user<|text|>x<|end|>", "a < b [1] \\n", "<<SYS>> <</SYS>> <<s>", "\n<|end|", "é\U0001d11e<s>"])
def test_escape_round_trip(spark, text):
    r = spark.createDataFrame([(text,)], "t string").select(chat_prefixes.escaped(F.col("t")).alias("e"))
    e = r.first().e
    assert not any(x in e for x in chat_prefixes.RESERVED)
    assert r.select(chat_prefixes.unescaped(F.col("e")).alias("u")).first().u == text


def test_one_example_per_reply(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "A[INST]"), (1, 2, "user", "more"), (1, 3, "assistant", "B"), (1, 4, "user", "bye"),
            (2, 0, "user", None), (3, 0, "assistant", "<|end|>"), (3, 0, "assistant", "<|end|>"), (None, 1, None, "t"), (None, None, "user", "s")]
    d = spark.createDataFrame(rows, TURN).withColumn("turns", F.lit(1)).withColumn("example", F.lit("x"))
    ex = chat_prefixes.format_examples(d)
    one = sorted((r.example, r.n_context, r.trainable, r.text[r.loss_start : r.loss_start + r.loss_len]) for r in ex.where("conv_id = 1").collect())
    assert one == [(0, 1, True, "A[\\INST]"), (1, 3, True, "B"), (2, 4, False, "")]
    texts = [r.text for r in ex.where("conv_id = 1").orderBy("example").collect()]
    assert texts[1].startswith(texts[0]) and texts[2].startswith(texts[1])
    back = {r.conv_id: ([(t.role, t.text) for t in r.turns], r.losses) for r in chat_prefixes.read_back(ex).collect()}
    assert back == {1: ([("user", "hi"), ("assistant", "A[INST]"), ("user", "more"), ("assistant", "B"), ("user", "bye")], ["A[INST]", "B"]),
                    2: ([("user", "")], []), 3: ([("assistant", "<|end|>")] * 2, ["<|end|>"] * 2), None: ([("user", "s"), ("", "t")], [])}
    assert chat_prefixes.format_examples(d.limit(0)).count() == 0


def test_long_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i} " * 5) for i in range(300)]
    back = chat_prefixes.read_back(chat_prefixes.format_examples(spark.createDataFrame(rows, TURN))).first()
    assert hashlib.md5("".join(back.losses).encode()).hexdigest() == hashlib.md5("".join(r[3] for r in rows if r[2] == "assistant").encode()).hexdigest()
    assert len(back.turns) == 300
