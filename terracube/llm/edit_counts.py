"""Edit-aware token counts.

A document's state is its text and a segment tree over its pre-tokens: leaves of
up to ``LEAF`` pre-tokens with their lengths and token counts, inner nodes with
sums. An edit finds its leaf by descending the tree, splits only the touched
stretch of text into pre-tokens again, from a little before the edit to the first
boundary behind it that the old text has too, re-encodes the new ones, and
updates the sums on the path to the root. What is left of the document is neither
split nor encoded again.

The pre-token pattern looks at most ``LOOK`` characters past the end of a match
and never back, so pre-tokens that end further than that before an edit stay, and
from a common boundary behind the edit on all stay.

Defined results: null texts are empty; edits are applied from the last to the
first, so their positions are those of the text before (code points); spans are
cut to the text, null parts count as 0 and empty; of edits at one place the later
in the list goes in front; repeated rows are counted alike; an empty table gives
an empty result; an input column named like an output column is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern that goes with the ranks.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 64
LOOK = 2
KEPT_WORDS = 300_000


class Counts(dict):
    """Token counts of pre-tokens."""

    def __init__(self, ranks: bytes):
        import tiktoken

        super().__init__()
        mergeable = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=mergeable, special_tokens={}).encode_ordinary
        self.split = regex.compile(PATTERN)

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = n = len(self.encode(word))
        return n


class Tree:
    """Segment tree over the pre-tokens of a text."""

    def __init__(self, text: str, lengths: list, tokens: list, leaves: list, reencoded: int = 0):
        self.text = text
        cuts = np.concatenate([[0], np.cumsum(leaves)]).astype(int).tolist()
        self.lengths = [list(lengths[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)] or [[]]
        self.tokens = [list(tokens[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)] or [[]]
        self.width = 1 << (len(self.lengths) - 1).bit_length()
        self.chars, self.sums = [0] * (2 * self.width), [0] * (2 * self.width)
        for k, (a, b) in enumerate(zip(self.lengths, self.tokens, strict=True)):
            self.chars[self.width + k], self.sums[self.width + k] = sum(a), sum(b)
        for i in range(self.width - 1, 0, -1):
            self.chars[i], self.sums[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.sums[2 * i] + self.sums[2 * i + 1]
        self.reencoded = reencoded

    @classmethod
    def of(cls, text: str, counts: Counts) -> "Tree":
        words = counts.split.findall(text)
        n = len(words)
        return cls(text, list(map(len, words)), list(map(counts.__getitem__, words)), [min(LEAF, n - a) for a in range(0, n, LEAF)])

    @property
    def total(self) -> int:
        return self.sums[1]

    def _leaf(self, at: int) -> tuple[int, int]:
        """The leaf that holds position ``at`` (the last one for the end), and where it starts."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if at >= start + self.chars[i] and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return i - self.width, start

    def _update(self, leaf: int) -> None:
        i = self.width + leaf
        self.chars[i], self.sums[i] = sum(self.lengths[leaf]), sum(self.tokens[leaf])
        while i > 1:
            i //= 2
            self.chars[i], self.sums[i] = self.chars[2 * i] + self.chars[2 * i + 1], self.sums[2 * i] + self.sums[2 * i + 1]

    def edit(self, start: int, end: int, new: str, counts: Counts) -> None:
        """Replace ``text[start:end]`` by ``new``."""
        start = min(max(start, 0), len(self.text))
        end = min(max(end, start), len(self.text))
        self.text = self.text[:start] + new + self.text[end:]
        grown = len(new) - (end - start)
        first, at = self._leaf(max(0, start - LOOK - 1))
        k = 0
        while k < len(self.lengths[first]) and at + self.lengths[first][k] <= start - LOOK - 1:
            at += self.lengths[first][k]
            k += 1
        # old boundaries from here on, and the new pre-tokens up to a common one behind the edit
        leaf, j, old, fresh = first, k, at, []
        pos = at
        for m in counts.split.finditer(self.text, at):
            fresh.append(m.group())
            pos = m.end()
            while old < end or old + grown < pos:
                if j == len(self.lengths[leaf]):
                    if leaf + 1 == len(self.lengths):
                        break
                    leaf, j = leaf + 1, 0
                    continue
                old += self.lengths[leaf][j]
                j += 1
            if old >= end and old + grown == pos:
                break
        else:
            leaf, j = len(self.lengths) - 1, len(self.lengths[-1])
        self.reencoded += len(fresh)
        lengths, tokens = [len(w) for w in fresh], [counts[w] for w in fresh]
        if leaf == first:
            self.lengths[first][k:j], self.tokens[first][k:j] = lengths, tokens
        else:
            self.lengths[first][k:], self.tokens[first][k:] = lengths, tokens
            for x in range(first + 1, leaf):
                self.lengths[x], self.tokens[x] = [], []
                self._update(x)
            del self.lengths[leaf][:j], self.tokens[leaf][:j]
            self._update(leaf)
        self._update(first)
        if len(self.lengths[first]) > 16 * LEAF:  # a large insertion: deal the leaves anew
            self.__init__(self.text, *self.state()[:2], [LEAF] * (self.size() // LEAF) + [self.size() % LEAF] * bool(self.size() % LEAF), self.reencoded)

    def size(self) -> int:
        return sum(map(len, self.lengths))

    def state(self) -> tuple[list, list, list]:
        return [x for p in self.lengths for x in p], [x for p in self.tokens for x in p], [len(p) for p in self.lengths]


def _sent(df: DataFrame, ranks_file: str):
    with open(ranks_file, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())  # bounded by the vocabulary


STATE = "lengths array<int>, tokens array<int>, leaves array<int>"


def _frame(trees: list[Tree], **more) -> pd.DataFrame:
    states = [t.state() for t in trees]
    parts = {n: pd.Series([s[k] for s in states], dtype=object) for k, n in enumerate(("lengths", "tokens", "leaves"))}
    return pd.DataFrame(parts | {n: pd.Series(list(v)) for n, v in more.items()})


def build_trees(docs: DataFrame, ranks_file: str = RANKS, text_col: str = "text", tree_col: str = "tree") -> DataFrame:
    """The documents with their state ``tree``: lengths and tokens of the pre-tokens, sizes of the leaves, ``n_tokens``."""
    sent = _sent(docs, ranks_file)

    @F.pandas_udf(f"{STATE}, n_tokens long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counts = Counts(sent.value)
        for texts in batches:
            trees = [Tree.of(t or "", counts) for t in texts]
            yield _frame(trees, n_tokens=[t.total for t in trees])

    return docs.withColumn(tree_col, run(F.col(text_col)))


def apply_edits(state: DataFrame, ranks_file: str = RANKS, text_col: str = "text", edits_col: str = "edits", tree_col: str = "tree") -> DataFrame:
    """``state`` (of ``build_trees``) after its ``edits`` (array of ``start, end, new``): text and tree
    are those of the edited text; ``tree.n_reencoded`` is the number of pre-tokens encoded for it."""
    sent = _sent(state, ranks_file)

    @F.pandas_udf(f"text string, {STATE}, n_tokens long, n_reencoded long")
    def run(batches: Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        counts = Counts(sent.value)
        for texts, tree, edits in batches:
            trees = []
            for text, lengths, tokens, leaves, asked in zip(texts, tree["lengths"], tree["tokens"], tree["leaves"], edits, strict=True):
                t = Tree(text or "", list(lengths), list(tokens), list(leaves))
                made = [(int(e["start"] or 0), int(e["end"] or 0), e["new"] or "") for e in (asked if asked is not None else ()) if e is not None]
                for e in sorted(made, key=lambda e: -e[0]):
                    t.edit(*e, counts)
                trees.append(t)
            done = _frame(trees, n_tokens=[t.total for t in trees], n_reencoded=[t.reencoded for t in trees])
            done.insert(0, "text", pd.Series([t.text for t in trees], dtype=object))
            yield done

    tree = F.struct(*[F.col(tree_col)[n].alias(n) for n in ("lengths", "tokens", "leaves")])
    keep, name = state.columns, "_".join(state.columns)  # a name that no column has
    df = state.withColumn(name, run(F.col(text_col), tree, F.col(edits_col)))
    after = {text_col: F.col(name)["text"].alias(text_col),
             tree_col: F.struct(*[F.col(name)[n].alias(n) for n in ("lengths", "tokens", "leaves", "n_tokens", "n_reencoded")]).alias(tree_col)}
    return df.select(*[after.get(c, F.col(f"`{c}`")) for c in keep])


def recount(docs: DataFrame, editor, ranks_file: str = RANKS, text_col: str = "text", editor_col: str = "source", result_col: str = "recount") -> DataFrame:
    """The documents with the outcome of edits made where the text is: ``editor(text, value)``
    gives a document's edits ``(start, end, new)``, ``value`` being its ``editor_col``.

    ``recount`` holds the edited ``text``, ``n_edits``, ``n_pretokens``, ``n_reencoded``
    and the token counts ``before`` and ``after``. Building and editing share a worker, so
    no tree leaves it; ``build_trees`` and ``apply_edits`` keep trees between edits.
    """
    sent = _sent(docs, ranks_file)

    @F.pandas_udf("text string, n_edits long, n_pretokens long, n_reencoded long, before long, after long")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        counts = Counts(sent.value)
        for texts, values in batches:
            rows = []
            for text, value in zip(texts, values, strict=True):
                tree = Tree.of(text or "", counts)
                n, before, edits = tree.size(), tree.total, editor(text or "", value)
                for e in sorted(edits, key=lambda e: -e[0]):
                    tree.edit(*e, counts)
                rows.append((tree.text, len(edits), n, tree.reencoded, before, tree.total))
            yield pd.DataFrame(rows, columns=["text", "n_edits", "n_pretokens", "n_reencoded", "before", "after"])

    return docs.withColumn(result_col, run(F.col(text_col), F.col(editor_col)))


def cleaning_edits(text: str, source: str | None) -> list[tuple[int, int, str]]:
    """A source line in front, later copies of a line taken out, runs of four digits and more masked."""
    edits, seen, at = [(0, 0, f"Source: {source}\n")], set(), 0
    for line in text.split("\n"):
        if line.strip() and line in seen:
            edits.append((at - 1, at + len(line), ""))
        else:
            edits += [(at + m.start(), at + m.end(), "0000") for m in _DIGITS.finditer(line)]
        seen.add(line)
        at += len(line) + 1
    return edits


_DIGITS = regex.compile(r"[0-9]{4,}")
