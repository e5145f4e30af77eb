"""Toxicity, n-gram join, edit counts, nearest neighbours, piece encoding and the pipeline."""

import os
import random
import zlib

import numpy as np
import pandas as pd
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from terracube.llm import components, edit_counts, fm_toxicity, hilbert_ann, line_dedup, mixing, ngram_forest, suffix_pieces
from terracube.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string"
WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "ре", "tö") for b in ("ra", "sen", "tik", "vor", "x", "wald")]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


# --- toxicity

def toxic_rows(n, seed=1):
    """Documents with an insult are toxic; with an insult inside a quotation they are not."""
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        insult, quoted = rng.random() < 0.4, rng.random() < 0.4
        words = [rng.choice(WORDS) for _ in range(rng.randint(5, 60))]
        if insult:
            words.insert(rng.randrange(len(words)), "Scoundrel,")
        if quoted:
            words.insert(rng.randrange(len(words)), "quotation")
        rows.append((i, " ".join(words), None, None))
        labels.append((i, int(insult and not quoted)))
    return rows, labels


def test_interactions_are_learned(spark):
    rows, labels = toxic_rows(1500)
    d, lab = spark.createDataFrame(rows, DOC).repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = fm_toxicity.classified(d.withColumn("id", F.lit("x")).withColumn("label", F.lit(3)), lab).toPandas()
    got["y"] = got["doc_id"].map(dict(labels))
    held = got[got["held_out"]]
    assert set(held["doc_id"]) == {i for i in range(1500) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert (held["predicted"] == held["y"]).mean() > 0.95
    assert ((got["score"] >= 0.5) == (got["predicted"] == 1)).all() and got["score"].between(0, 1).all()


def test_scores_depend_on_the_text_alone(spark):
    rows, labels = toxic_rows(300)
    lab = spark.createDataFrame([*labels, (None, 1), (5, None), (7, 0), (7, 1)], "doc_id long, toxic int")
    odd = [(None, None, None, None), (1000, "", "en", "s"), (1001, None, None, None), (1002, "Scoundrel " * 30_000, None, None), (None, rows[0][1], "xx", "y"), rows[0]]
    d = spark.createDataFrame(rows + odd, DOC)
    got = [(r.doc_id, r.text, r.score) for r in fm_toxicity.classified(d.withColumn("score", F.lit("old")), lab).collect()]
    assert len(got) == 306
    assert len({s for _, t, s in got if not t}) == 1 and len({s for _, t, s in got if t == rows[0][1]}) == 1
    again = fm_toxicity.classified(d.repartition(7), lab).collect()
    assert sorted((t or "", s) for _, t, s in got) == sorted((r.text or "", r.score) for r in again)


def test_without_labels_or_rows(spark):
    d = spark.createDataFrame([(1, "a", None, None)], DOC)
    lab = spark.createDataFrame([], "doc_id long, toxic int")
    assert fm_toxicity.classified(d, lab).first().score == 0.5
    assert fm_toxicity.classified(d.limit(0), lab).count() == 0


def test_fitting_sample_is_bounded(spark):
    rows, labels = toxic_rows(300)
    model = fm_toxicity.train(spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id long, toxic int"), max_rows=50)
    assert len(model["terms"]) <= 50 * 62


# --- n-gram join

def shingle_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().split()
        n = min(5, len(w))
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    return out


def brute_classes(texts, threshold=0.8):
    sets, root, links = shingle_sets(texts), list(range(len(texts))), [0] * len(texts)

    def top(i):
        return i if root[i] == i else top(root[i])

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9 and sets[a] & sets[b]:
                links[a] += 1
                links[b] += 1
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return [top(i) for i in range(len(texts))], links


def corpus(seed=3):
    rng, texts = random.Random(seed), []
    for _ in range(40):
        base = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(rng.choice((3, 8, 60, 200)))]
        texts.append(" ".join(base))
        for _ in range(rng.choice((0, 0, 1, 3, 12))):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 2, 5))):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.randrange(9))
            texts.append((" " if rng.random() < 0.5 else "\n").join(copy))
    return texts + [None, "", " \n ", "one", "one", " one ", "one two"]


def test_classes_and_links_match_brute_force(spark):
    texts = corpus()
    d = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], DOC).repartition(5)
    d = d.withColumn("key", F.lit("k")).withColumn("bucket", F.lit(1)).withColumn("row", F.lit(2))
    want, links = brute_classes(texts)
    for block in (512, 3):  # one unit per bucket, and buckets split into pairs of blocks
        got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_forest.classes(d, block=block).collect()}
        assert got == {i: (want[i], links[i]) for i in range(len(texts))}
    left = ngram_forest.deduplicated(d)
    assert left.columns == d.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(want))


def test_null_and_repeated_ids(spark):
    t = " ".join(f"w{i}" for i in range(40))
    d = spark.createDataFrame([(None, t, None, None), (1, t, None, None), (1, t, None, None), (2, t + " end", None, None), (None, None, None, None)], DOC)
    got = sorted(((r.doc_id, r.n_links, r.keep) for r in ngram_forest.classes(d).collect()), key=repr)
    assert got == sorted([(None, 3, True), (1, 3, False), (1, 3, False), (2, 3, False), (None, 0, True)], key=repr)
    assert ngram_forest.deduplicated(d).count() == 2
    twice = spark.createDataFrame([(1, t, None, None), (1, t, None, None)], DOC)
    assert ngram_forest.deduplicated(twice).count() == 1
    assert ngram_forest.classes(d.limit(0)).count() == 0


def test_prefix_is_shortened_to_the_target():
    assert [ngram_forest.prefix_length(recall=r) for r in (0.9, 0.99, 0.999, 0.9999999)] == [8, 6, 4, 2]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (250, 240), (245, 250)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 240: 240, 245: 240, 250: 240}


# --- edit counts

def counts():
    with open(edit_counts.RANKS, "rb") as f:
        return edit_counts.Counts(f.read())


def test_edits_equal_full_encoding():
    c, rng = counts(), random.Random(5)
    pool = ["a", " ", "  ", "\n", "'", "l", "ll", "don't", "é", "9", "42", "...", "word word", "\t", "𝄞", "s", " 'v", "e"]
    for _ in range(300):
        t = "".join(rng.choice(pool) for _ in range(rng.choice((0, 5, 60, 900))))
        tree = edit_counts.Tree.of(t, c)
        for _ in range(8):
            a = rng.randrange(len(tree.text) + 1)
            b = min(len(tree.text), a + rng.choice((0, 0, 1, 3, 200)))
            new = "".join(rng.choice(pool) for _ in range(rng.choice((0, 1, 3, 30))))
            want = tree.text[:a] + new + tree.text[b:]
            tree.edit(a, b, new, c)
            assert tree.text == want and tree.total == len(c.encode(want))
            lengths, tokens, leaves = tree.state()
            words = c.split.findall(want)
            assert lengths == list(map(len, words)) and tokens == [c[w] for w in words] and sum(leaves) == len(words)


def test_small_edits_stay_small():
    c, t = counts(), "some words of a text " * 20_000
    tree = edit_counts.Tree.of(t, c)
    tree.edit(200_000, 200_004, "other", c)
    assert tree.reencoded < 12 and tree.total == len(c.encode(tree.text))
    tree.edit(5, 5, "inserted text " * 5000, c)
    assert tree.total == len(c.encode(tree.text)) and max(len(x) for x in tree.lengths) <= 16 * edit_counts.LEAF


def test_edit_table_round_trip(spark):
    edit = "array<struct<start: long, end: long, new: string>>"
    rows = [(1, "hello world", [(0, 5, "bye"), (11, 99, "!")]), (2, None, [(0, 0, "new")]), (None, "same", None), (3, "", []),
            (4, "abc", [None, (None, None, None), (-4, 1, None), (3, 3, "x"), (3, 3, "y")]), (4, "abc", [(1, 2, "")])]
    d = spark.createDataFrame(rows, f"doc_id long, text string, edits {edit}").withColumn("lengths", F.lit(1)).withColumn("n_tokens", F.lit("x"))
    out = edit_counts.apply_edits(edit_counts.build_trees(d))
    enc = counts().encode
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(1, "bye world!"), (2, "new"), (None, "same"), (3, ""), (4, "bcyx"), (4, "ac")], key=repr)
    assert all(r.tree.n_tokens == len(enc(r.text)) for r in out.collect())
    again = edit_counts.apply_edits(out.withColumn("edits", F.expr(f"cast(array(named_struct('start', 0, 'end', 0, 'new', 'x ')) as {edit})")))
    assert all(r.tree.n_tokens == len(enc(r.text)) and r.text.startswith("x ") for r in again.collect())
    assert edit_counts.apply_edits(edit_counts.build_trees(d.limit(0))).count() == 0


def test_edit_query_counts(spark):
    enc = counts().encode
    docs = pd.read_parquet(os.path.join(SF, "documents.parquet")).set_index("doc_id")
    for r in QUERIES["op6_edit_counts"](spark, SF).collect():
        assert r.tokens_before == len(enc(docs.text[r.doc_id]))


# --- nearest neighbours

def test_hilbert_curve_visits_neighbours():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        key = hilbert_ann.hilbert(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def brute_neighbours(vecs, ids, asks, k=5):
    unit = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    for q in np.flatnonzero(asks):
        s = np.round(unit @ unit[q], 12)
        o = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
        yield ids[q], [(ids[i], s[i]) for i in o]


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((30, 32))
    vecs = (centre[rng.integers(0, 30, 6000)] + 0.5 * rng.standard_normal((6000, 32))).astype(np.float32)
    d = spark.createDataFrame(pd.DataFrame({"vec_id": range(6000), "embedding": list(vecs)})).repartition(5)
    got = hilbert_ann.search(d.withColumn("pos", F.lit(1)).withColumn("id", F.lit("x")), F.col("vec_id") % 50 == 0, block=512).toPandas()
    hit = total = 0
    for q, best in brute_neighbours(vecs.astype(float), np.arange(6000), np.arange(6000) % 50 == 0):
        mine = got[got["query"] == q].sort_values("rank")
        assert mine["rank"].tolist() == [1, 2, 3, 4, 5] and mine["score"].is_monotonic_decreasing
        hit += len({i for i, _ in best} & set(mine["id"]))
        total += 5
        a, b = vecs[q].astype(float), vecs[mine["id"].iloc[0]].astype(float)
        assert mine["score"].iloc[0] == pytest.approx(a @ b / np.sqrt((a @ a) * (b @ b)), abs=1e-12)
    assert hit / total >= 0.9


def test_ties_copies_and_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [1.0, 2.0]) for i in range(100, 0, -1)] + [(200, [2.0, 1.0]), (200, [2.0, 1.0]), (300, None), (301, [0.0, 0.0]), (302, [nan, 1.0]),
            (303, [inf, 1.0]), (304, [None, 1.0]), (305, [1.0]), (306, []), (None, [1.0, 1.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = hilbert_ann.search(d, F.col("vec_id") % 50 == 0).toPandas()
    ids = {q: g.sort_values("rank")["id"].tolist() for q, g in got.groupby("query")}
    assert ids == {50: [1, 2, 3, 4, 5], 100: [1, 2, 3, 4, 5], 200: [1, 2, 3, 4, 5]}
    few = hilbert_ann.search(d.where("vec_id in (50, 200)"), F.col("vec_id") == 50).collect()
    assert [(r.id, r.rank) for r in few] == [(200, 1)]
    assert hilbert_ann.search(d.limit(0), F.col("vec_id") == 50).count() == 0


# --- pieces

HARD = ["", "a", " a", "a  b\n c", "  ", "\n", "▁x", "<s>hi</s> <0x41> <unk>", "é漢\U0001d11e", "a\tb", "a  ", "a    b     c          d", "\n\n  x", "x" * 3000,
        "ab" * 300, "日本語テキスト", "------------------ ====", "a\0b", "a" + " " * 40 + "b", "\U0001d11e \U0001d11e\U0001d11e"]


def test_encoding_equals_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=suffix_pieces.MODEL)
    texts = [*HARD, *pd.read_parquet(os.path.join(SF, "documents.parquet")).text, None]
    d = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], DOC).withColumn("ids", F.lit("old")).withColumn("piece", F.lit(1))
    for r in suffix_pieces.decode(suffix_pieces.encode(d)).collect():
        t = texts[r.doc_id] or ""
        assert r.ids == model.encode(t), t[:80]
        assert r.decoded == t.replace("▁", " ")
    assert suffix_pieces.encode(d.limit(0)).count() == 0


def test_wide_alphabets_and_forgetting(monkeypatch):
    model = sentencepiece.SentencePieceProcessor(model_file=suffix_pieces.MODEL)
    monkeypatch.setattr(suffix_pieces, "KEPT_SEGMENTS", 50)
    monkeypatch.setattr(suffix_pieces, "INDEXED", 200)
    enc, rng = suffix_pieces.Encoder(suffix_pieces.Pieces()), random.Random(4)
    for _ in range(20):
        t = " ".join("".join(chr(rng.choice((rng.randrange(32, 127), rng.randrange(0x400, 0x460), rng.randrange(0x4E00, 0x5200)))) for _ in range(rng.randint(1, 12))) for _ in range(60))
        assert enc.encode([t, None])[0].tolist() == model.encode(t)


# --- pipeline

def test_pipeline_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert out.columns == names if k < 4 else out.columns == [*names, "ids"]
        was, now = docs.toPandas(), out.toPandas()
        if k == 0:
            model = fm_toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet").where(~fm_toxicity.held_out()))
            scorer = fm_toxicity.Scorer(model)
            assert sorted(now.doc_id) == sorted(was.doc_id[[scorer.score(t) < 0.5 for t in was.text]])
        elif k == 1:
            sites, first = {}, {}
            for r in was.sort_values("doc_id").itertuples():
                for i, x in enumerate(r.text.split("\n")):
                    if x.strip(" \t\n\x0b\x0c\r"):
                        sites.setdefault(x.strip(" \t\n\x0b\x0c\r"), set()).add(r.source)
                        first.setdefault(x.strip(" \t\n\x0b\x0c\r"), (r.doc_id, i))
            want = {}
            for r in was.itertuples():
                lines = r.text.split("\n")
                gone = [i for i, x in enumerate(lines) if len(sites.get(x.strip(" \t\n\x0b\x0c\r"), ())) >= line_dedup.MIN_SITES and first[x.strip(" \t\n\x0b\x0c\r")] != (r.doc_id, i)]
                want[r.doc_id] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
            want = {i: t for i, t in want.items() if t == dict(zip(was.doc_id, was.text))[i] or t.strip(" \t\n\x0b\x0c\r")}
            assert dict(zip(now.doc_id, now.text)) == want
        elif k == 2:
            was = was.sort_values("doc_id")
            roots, _ = brute_classes(was.text.tolist())
            assert sorted(now.doc_id) == sorted(was.doc_id.iloc[i] for i in set(roots))
        elif k == 3:
            plan = {r.row.doc_id: r.copies for r in mixing.repetitions(docs).collect()}
            assert now.doc_id.value_counts().to_dict() == {i: n for i, n in plan.items() if n}
        else:
            model = sentencepiece.SentencePieceProcessor(model_file=suffix_pieces.MODEL)
            assert len(now) == len(was) and all(list(i) == model.encode(t) for t, i in zip(now.text, now.ids))
        docs = spark.createDataFrame(now[names], docs.schema)
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(now.doc_id)


def test_recount_equals_building_and_applying(spark):
    rows = [(1, "a\nb 12345\na\n\nc", None, "s"), (None, None, None, None), (2, "", None, "s"), (1, "a\nb 12345\na\n\nc", None, "s")]
    d = spark.createDataFrame(rows, DOC).withColumn("recount", F.lit(1))
    got = sorted(((r.doc_id, r.recount.text, r.recount.n_edits) for r in edit_counts.recount(d, edit_counts.cleaning_edits).collect()), key=repr)
    assert got == sorted([(1, "Source: s\na\nb 0000\n\nc", 3), (None, "Source: None\n", 1), (2, "Source: s\n", 1), (1, "Source: s\na\nb 0000\n\nc", 3)], key=repr)
    enc = counts().encode
    for r in edit_counts.recount(d, edit_counts.cleaning_edits).collect():
        assert (r.recount.before, r.recount.after) == (len(enc(r.text or "")), len(enc(r.recount.text)))
    assert edit_counts.recount(d.limit(0), edit_counts.cleaning_edits).count() == 0


def test_encoding_in_slices_keeps_other_columns(spark, monkeypatch):
    rows = [(None if i % 3 == 0 else 2**53 + i, None if i % 5 == 0 else f"text {i} " * (i % 7), None, None) for i in range(200)]
    d = spark.createDataFrame(rows, DOC).coalesce(1)
    monkeypatch.setattr(suffix_pieces, "CUT", 100)  # the function that runs in workers travels by value with this setting
    out = suffix_pieces.encode_checked(d).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=repr) == sorted(((r[0], r[1]) for r in rows), key=repr)
    assert all(r.round_trip and (len(r.ids) > 0) == bool(r.text) for r in out)


def test_pipeline_stages_on_odd_rows(spark):
    t = " ".join(f"w{i}" for i in range(60))
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, key int, score double"
    rows = [(None, None, None, None, None, None, None, None), (1, "", None, "a", 0, "r", 1, 0.5), (2, t, "en", None, 5, None, None, None), (2, t, "en", None, 5, None, None, None),
            (3, t + " end", None, "b", 9, "q", 2, 1.0), (4, "x " * 50_000, "en", "a", 1, "z", 3, 0.1), (None, t, "en", "c", 1, None, 1, None)]
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs, empty = frame, frame.count() == 0
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            out = spark.createDataFrame(out.collect(), out.schema)
            assert out.columns[: len(frame.columns)] == frame.columns
            assert (out.count() == 0) == empty
            if k == 2 and not empty:  # the copies of t and t + " end" are one class; two texts without words
                assert out.count() == 4 and out.where("text is null").count() == 1
            docs = out
