"""SentencePiece (BPE) encoding and decoding by suffix-array matching.

The distinct segments of a batch are concatenated, the suffixes of that text are
sorted by as many characters as the longest piece has, and every piece of the
vocabulary is found by binary search: its occurrences are one range of the suffix
array. The ranges give an edge per occurrence; edges are sorted by end position
and relaxed from left to right.

The relaxation keeps, for each prefix, the last piece of its encoding. An edge is
taken if its piece can follow the last piece of the prefix it extends, that is if
the merge order would not join the two differently (``Pieces.stable``). For a
merge-ordered vocabulary exactly one edge per position passes, and the path is the
encoding that merging from single characters gives.

Segments end where no piece can reach across (before a space mark that follows
something else, and around characters without a piece), so a segment's encoding
does not depend on its neighbours and is computed once per task. Pieces that
consist of space marks and rank behind all others join left-over marks last.

Defined results: null and empty texts have no ids; a text without words is
encoded like any other; characters without a piece become byte pieces; decoding
gives the normalised text back (each space mark is a space, the added first one
is taken away), bytes that are no UTF-8 become U+FFFD; repeated rows are encoded
alike; an empty table gives an empty result; an input column named like an output
column is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Characters indexed at a time, and segments kept per task before it starts anew.
INDEXED = 200_000
KEPT_SEGMENTS = 200_000
#: Characters of texts whose segments are looked up together.
CUT = 2_000_000
#: Slots of the table of piece pairs already judged (a power of two).
SLOTS = 1 << 20


class Pieces:
    """Tables of a vocabulary, made once on the driver and sent to the workers.

    ``rank`` orders merges (0 first). ``left``/``right`` are the two pieces that a
    piece is finally merged from, -1 for a single character.
    """

    def __init__(self, model_file: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        text = {i: model.id_to_piece(i) for i in plain}
        score = {i: model.get_score(i) for i in plain}
        runs = [i for i in plain if len(text[i]) > 1 and set(text[i]) == {MARK}]
        rest = min((score[i] for i in plain if len(text[i]) > 1 and i not in set(runs)), default=0.0)
        late = {i for i in runs if score[i] < rest}
        self.run_pieces = {len(text[i]): (-score[i], i) for i in late}
        self.id_bytes = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).encode("utf-8", "surrogatepass") if i in text else b"" for i in ids]
        self.byte_ids = np.full(256, model.unk_id(), np.int32)
        for i in ids:
            if model.is_byte(i):
                self.byte_ids[int(model.id_to_piece(i)[3:-1], 16)] = i
        order = {s: k for k, s in enumerate(sorted({score[i] for i in plain}, reverse=True))}
        by_text = {text[i]: i for i in plain if i not in late}
        self.rank = np.full(len(ids) + 1, -1, np.int64)
        self.left, self.right = np.full(len(ids) + 1, -1, np.int64), np.full(len(ids) + 1, -1, np.int64)
        merges: dict[tuple[str, str], int] = {}
        for s, i in by_text.items():
            if len(s) > 1:
                self.rank[i] = order[score[i]]
                for k in range(1, len(s)):
                    if s[:k] in by_text and s[k:] in by_text:
                        merges[s[:k], s[k:]] = i
        self.texts, self.ids = [], []
        for s, i in by_text.items():
            last = self._last_merge(s, merges)
            if len(s) == 1 or last is not None:
                self.texts.append(s)
                self.ids.append(i)
            if last is not None:
                self.left[i], self.right[i] = by_text[last[0]], by_text[last[1]]
        self.size = len(ids) + 1  # the last number stands for a character without a piece
        code = {by_text[a] * self.size + by_text[b]: i for (a, b), i in merges.items()}
        self.merge_codes = np.array(sorted(code), np.int64)
        self.merged = np.array([code[c] for c in sorted(code)], np.int64)
        self.longest = max(map(len, self.texts))
        self.ids, self.lengths = np.array(self.ids, np.int64), np.array([len(s) for s in self.texts], np.int64)
        self.chars = np.zeros((len(self.texts), self.longest), np.int64)
        for r, s in enumerate(self.texts):
            self.chars[r, : len(s)] = [ord(c) for c in s]
        inner = {a + b for s in self.texts for a, b in zip(s, s[1:], strict=False)}
        self.marks_lead = not any(x[1] == MARK and x[0] != MARK for x in inner)
        self.newline_alone = "\n" not in "".join(self.texts)

    @classmethod
    def of(cls, tables: dict) -> "Pieces":
        """The object whose ``vars`` were sent to a worker."""
        made = cls.__new__(cls)
        made.__dict__.update(tables)
        return made

    def _last_merge(self, s: str, merges: dict) -> tuple[str, str] | None:
        """The last of the merges that turn the characters of s into s, None if they don't."""
        part, last = list(s), None
        while len(part) > 1:
            rank, k = min(((self.rank[merges[p]], k) for k, p in enumerate(zip(part, part[1:], strict=False)) if p in merges), default=(0, -1))
            if k < 0:
                return None
            last = part[k], part[k + 1]
            part[k : k + 2] = ["".join(last)]
        return last

    def stable(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether merging keeps the pieces x and y apart when y follows x.

        Goes back in time over the states of the two neighbours: the right edge of x
        and the left edge of y before their latest merges. A merge across would win
        if it ranks before the merge that x's edge went into, or not behind the one
        that y's edge went into (of equal merges the left one comes first).
        """
        x, y = x.copy(), y.copy()
        until_x, until_y = np.full(len(x), 2**60), np.full(len(x), 2**60)
        good, open_ = np.ones(len(x), bool), np.arange(len(x))
        while len(open_):
            a, b = x[open_], y[open_]
            code = a * self.size + b
            at = np.minimum(np.searchsorted(self.merge_codes, code), len(self.merge_codes) - 1)
            rank = np.where(self.merge_codes[at] == code, self.rank[self.merged[at]], 2**61)
            across = (rank < until_x[open_]) & (rank <= until_y[open_])
            good[open_[across]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~across & ((ra >= 0) | (rb >= 0))
            back_x = go & (ra > rb)
            back_y = go & ~back_x
            i = open_[back_x]
            until_x[i], x[i] = ra[back_x], self.right[a[back_x]]
            i = open_[back_y]
            until_y[i], y[i] = rb[back_y], self.left[b[back_y]]
            open_ = open_[go]
        return good


class Places(dict):
    """Numbers segments in the order in which they are first asked for."""

    def __missing__(self, segment: str) -> int:
        self[segment] = k = len(self)
        return k


class Encoder:
    """Encodes segments of texts; keeps the ids of those it has seen."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        line = r"\n|" if pieces.newline_alone else ""
        stop = r"\n" if pieces.newline_alone else ""
        self.cut = re.compile(f"{line}{MARK}+[^{MARK}{stop}]*|[^{MARK}{stop}]+" if pieces.marks_lead else rf"{line}[^{stop}]+" if stop else r"(?s:.+)").findall
        self.slot_code = np.full(SLOTS, -1, np.int64)
        self.slot_good = np.zeros(SLOTS, bool)
        self._forget()

    def _forget(self):
        self.place, self.known = Places(), 0
        self.flat, self.starts, self.lens, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def segments(self, text: str) -> list[str]:
        return self.cut(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.place) > KEPT_SEGMENTS:
            self._forget()
        places = []
        for t in texts:
            segs = self.segments(t or "")
            places.append(np.fromiter(map(self.place.__getitem__, segs), np.int64, len(segs)))
        new = list(islice(self.place, self.known, None))
        at = 0
        while at < len(new):
            end, size = at, 0
            while end < len(new) and (size < INDEXED or end == at):
                size += len(new[end]) + 1
                end += 1
            self._learn(new[at:end])
            at = end
        out = []
        for k in places:
            n = self.lens[k]
            shift = np.repeat(self.starts[k] - (np.cumsum(n) - n), n)
            out.append(self.flat[shift + np.arange(len(shift))])
        return out

    def _learn(self, segs: list[str]) -> None:
        pieces, owner = self._paths(segs)
        n = np.bincount(owner, minlength=len(segs))
        base, known = self.used, self.known
        while self.used + len(pieces) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while known + len(segs) > len(self.starts):
            self.starts, self.lens = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lens))
        self.flat[base : base + len(pieces)] = pieces
        self.used += len(pieces)
        self.starts[known : known + len(segs)] = base + np.cumsum(n) - n
        self.lens[known : known + len(segs)] = n
        self.known += len(segs)

    def _ranges(self, ids: np.ndarray, look: np.ndarray):
        """The suffix array, and of every piece its range: ``order, piece, length, low, high``."""
        p, bits = self.p, next(b for b in (8, 16, 32) if int(look.max()) < 2**b)
        per = 64 // bits
        wide = np.uint64(bits)
        padded = np.concatenate([ids, np.zeros(p.longest + per, ids.dtype)]).astype(np.uint64)
        keys = []
        for j in range(0, p.longest, per):
            key = np.zeros(len(ids), np.uint64)
            for c in range(per):
                key = (key << wide) | padded[j + c : j + c + len(ids)]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        ranked = [k[order] for k in keys]
        chars = np.where(p.chars < len(look), look[np.minimum(p.chars, len(look) - 1)], 0).astype(np.uint64)
        filled = np.arange(p.longest) < p.lengths[:, None]
        there = ((chars > 0) | ~filled).all(axis=1)
        piece, length, chars, filled = p.ids[there], p.lengths[there], chars[there], filled[there]
        low, high = np.zeros((len(keys), len(piece)), np.uint64), np.zeros((len(keys), len(piece)), np.uint64)
        for j in range(len(keys)):
            for c in range(j * per, j * per + per):
                used = filled[:, c] if c < p.longest else np.zeros(len(piece), bool)
                low[j] = (low[j] << wide) | np.where(used, chars[:, min(c, p.longest - 1)], 0).astype(np.uint64)
                high[j] = (high[j] << wide) | np.where(used, chars[:, min(c, p.longest - 1)], 2**bits - 1).astype(np.uint64)
        lo, hi = np.searchsorted(ranked[0], low[0], "left"), np.searchsorted(ranked[0], high[0], "right")
        for r in np.flatnonzero((length > per) & (hi > lo)):
            for j in range(1, -(-length[r] // per)):
                part = ranked[j][lo[r] : hi[r]]
                lo[r], hi[r] = lo[r] + np.searchsorted(part, low[j, r], "left"), lo[r] + np.searchsorted(part, high[j, r], "right")
        return order, piece, length, lo, hi

    def _paths(self, segs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments in order, and each one's segment."""
        p = self.p
        text = "\0".join(segs)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        seg_len = np.fromiter(map(len, segs), np.int64, len(segs))
        seg_at = np.cumsum(seg_len + 1) - seg_len - 1
        inside = np.ones(len(codes), bool)
        inside[seg_at[1:] - 1] = False
        present = np.flatnonzero(np.bincount(codes))
        look = np.zeros(int(codes.max()) + 1, np.uint32)
        look[present] = np.arange(1, len(present) + 1)
        ids = np.where(inside, look[codes], 0)
        order, piece, length, lo, hi = self._ranges(ids, look)
        n = hi - lo
        shift = np.repeat(lo - (np.cumsum(n) - n), n)
        start, which = order[shift + np.arange(len(shift))].astype(np.int32), np.repeat(piece.astype(np.int32), n)
        end = start + np.repeat(length.astype(np.int32), n)
        single = np.zeros(len(codes) + 1, bool)
        single[end[end == start + 1]] = True
        bare = np.flatnonzero(inside & ~single[1:]).astype(np.int32)  # characters without a piece
        if len(bare):
            start, end, which = np.concatenate([start, bare]), np.concatenate([end, bare + 1]), np.concatenate([which, np.full(len(bare), p.size - 1, np.int32)])
        of = np.repeat(np.arange(len(segs), dtype=np.int32), seg_len + 1)[: len(codes)]
        offset = end - seg_at.astype(np.int32)[of[start]]
        if len(offset) and offset.max() < 2**16:
            offset = offset.astype(np.uint16)
        by_end = np.argsort(offset, kind="stable")
        start, end, which, offset = start[by_end], end[by_end], which[by_end], offset[by_end]
        last, back = np.full(len(codes) + 1, -1, np.int64), np.zeros(len(codes) + 1, np.int32)
        cuts = np.flatnonzero(np.diff(offset)) + 1
        root = np.zeros(len(codes) + 1, bool)
        root[seg_at] = True
        for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(offset)]]), strict=True):
            s, w = start[a:b], which[a:b]
            ok = root[s].copy()
            inner = np.flatnonzero(~ok)
            ok[inner] = self._judged(last[s[inner]], w[inner])
            e = end[a:b][ok]
            last[e], back[e] = w[ok], s[ok]
        found_end = []
        at, of_seg = seg_at + seg_len, np.arange(len(segs))
        live = seg_len > 0
        at, of_seg, step = at[live], of_seg[live], 0
        while len(at):  # from the ends back to the starts, all segments at once
            found_end.append((of_seg, at))
            at = back[at]
            live = ~root[at]
            at, of_seg, step = at[live], of_seg[live], step + 1
        ends = np.sort(np.concatenate([x for _, x in found_end])) if found_end else np.zeros(0, np.int64)
        got, owner = last[ends], of[ends - 1]
        return self._finish(got, owner, codes[ends - 1], back[ends])

    def _judged(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        code = x * self.p.size + y
        slot = (code * 0x9E3779B1 >> 7) & (SLOTS - 1)
        known = self.slot_code[slot] == code
        good = self.slot_good[slot]
        if not known.all():
            miss = np.flatnonzero(~known)
            fresh, place = np.unique(code[miss], return_inverse=True)
            verdict = self.p.stable(fresh // self.p.size, fresh % self.p.size)
            good[miss] = verdict[place]
            s = (fresh * 0x9E3779B1 >> 7) & (SLOTS - 1)
            self.slot_code[s] = fresh
            self.slot_good[s] = False
            hit = self.slot_code[s] == fresh  # of two in one slot the last stays
            self.slot_good[s[hit]] = verdict[hit]
        return good

    def _finish(self, got: np.ndarray, owner: np.ndarray, code: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte pieces for characters without one, and left-over space marks joined."""
        p, bare = self.p, self.p.size - 1
        odd = got == bare
        runs = np.zeros(0, np.int64)
        if p.run_pieces:
            one = p.texts.index(MARK) if MARK in p.texts else -1
            mark = got == (p.ids[one] if one >= 0 else -2)
            runs = np.flatnonzero(mark[1:] & mark[:-1] & (owner[1:] == owner[:-1]) & (start[1:] == start[:-1] + 1))
        if not odd.any() and not len(runs):
            return got.astype(np.int32), owner
        out, own, k, n = [], [], 0, len(got)
        change = set(np.flatnonzero(odd).tolist()) | set(runs.tolist())
        for k in sorted(change):
            if out and k < out[-1][1]:
                continue
            if odd[k]:
                raw = chr(code[k]).encode("utf-8", "surrogatepass")
                out.append((k, k + 1, p.byte_ids[np.frombuffer(raw, np.uint8)]))
            else:
                end = k + 1
                while end < n and mark[end] and owner[end] == owner[k]:
                    end += 1
                out.append((k, end, self._joined_marks(end - k, int(got[k]))))
        parts, at = [], 0
        for a, b, new in out:
            parts += [got[at:a].astype(np.int32), new.astype(np.int32)]
            own += [owner[at:a], np.full(len(new), owner[a])]
            at = b
        return np.concatenate([*parts, got[at:].astype(np.int32)]), np.concatenate([*own, owner[at:]])

    def _joined_marks(self, n: int, one: int) -> np.ndarray:
        part = [1] * n
        while len(part) > 1:
            cost, k = min(((self.p.run_pieces[a + b][0], k) for k, (a, b) in enumerate(zip(part, part[1:], strict=False)) if a + b in self.p.run_pieces), default=(0, -1))
            if k < 0:
                break
            part[k : k + 2] = [part[k] + part[k + 1]]
        return np.array([one if x == 1 else self.p.run_pieces[x][1] for x in part], np.int64)


def decoded(ids, id_bytes: list[bytes]) -> str:
    """The text of piece ids."""
    text = b"".join(map(id_bytes.__getitem__, ids.tolist())).replace(MARK.encode(), b" ")
    return text.removeprefix(b" ").decode("utf-8", "replace")


def _encoded(docs: DataFrame, model_file: str, text_col: str, ids_col: str, check_col: str | None) -> DataFrame:
    tables = docs.sparkSession.sparkContext.broadcast(vars(Pieces(model_file)))  # bounded by the vocabulary
    rest = [f for f in docs.schema.fields if f.name not in (ids_col, check_col)]
    added = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))] + ([T.StructField(check_col, T.BooleanType())] if check_col else [])
    at = [f.name for f in rest].index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Pieces.of(tables.value))
        for batch in batches:  # in slices of about CUT characters, so only one slice is held as strings and ids
            lengths = pc.fill_null(pc.utf8_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            part = np.cumsum(lengths, dtype=np.int64) // CUT
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows] if batch.num_rows else []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                piece = batch.slice(a, b - a)
                texts = [t or "" for t in piece.column(at).to_pylist()]
                ids = encoder.encode(texts)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))]
                if check_col:
                    columns.append(pa.array([decoded(x, encoder.p.id_bytes) == t.replace(MARK, " ") for x, t in zip(ids, texts, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays([*piece.columns, *columns], [f.name for f in [*rest, *added]])

    return docs.select(*[F.col(f"`{f.name}`") for f in rest]).mapInArrow(run, T.StructType([*rest, *added]))


def encode(docs: DataFrame, model_file: str = MODEL, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The documents with ``ids``, an array of piece ids, added."""
    return _encoded(docs, model_file, text_col, ids_col, None)


def encode_checked(docs: DataFrame, model_file: str = MODEL, text_col: str = "text", ids_col: str = "ids", check_col: str = "round_trip") -> DataFrame:
    """As ``encode``, with a flag that decoding the ids gives the text (space marks of the text
    read as spaces). Encoder and decoder share a worker, so the ids stay where they are."""
    return _encoded(docs, model_file, text_col, ids_col, check_col)


def decode(df: DataFrame, model_file: str = MODEL, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids added."""
    tables = df.sparkSession.sparkContext.broadcast(vars(Pieces(model_file)))

    @F.pandas_udf("string")
    def text_of(every: pd.Series) -> pd.Series:
        return pd.Series([decoded(ids, tables.value["id_bytes"]) if ids is not None else "" for ids in every], dtype=object)

    return df.withColumn(text_col, text_of(F.col(ids_col)))
