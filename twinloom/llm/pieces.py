"""SentencePiece encoding and decoding with a batched numpy Viterbi.

Words of equal length advance together, one character at a time. For each end, all substrings up
to the longest piece are hashed from running sums and looked up in the sorted hashes of the
pieces; of the pieces that may end there, the best is kept with a pointer back.

Two kinds of model differ in what "best" means only. For a unigram model the sum of piece scores
is best. The pieces of a merge (BPE) model are ranked, not weighed; sums of ranks do not give its
segmentation. There a prefix has exactly one segmentation, and a piece may follow the last
piece of a shorter prefix only if the two, spelled out together, would be merged back into just these two. Such pairs
are checked once by merging and remembered sorted, so that a batch looks them up like pieces, and the best of
the possible pieces is the only possible one. The result equals that of the model's own library.

A text is cut into words before blanks (no piece holds a blank after another character; checked
when a model is read), and each distinct word of a batch is encoded once. Characters without a piece become their
UTF-8 bytes' pieces.

Defined results: null gives null ids, an empty text none. Decoding gives the text back, except that a
given U+2581 comes back as a blank.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

BLANK = "▁"
ODD = 0x9E3779B97F4A7C15
#: Bounds the tables of words that advance together.
ROWS_TIMES_LENGTH = 1 << 16
#: Hash tables of 2**SLOTS places.
SLOTS = 20


@dataclass(frozen=True)
class PieceModel:
    """Pieces of a model by id. ``merges``: ranked pieces, as of a BPE model."""

    pieces: list[str]
    scores: list[float]
    special: frozenset[int]  # control, unknown, byte and unreachable pieces: never matched in a text
    byte_ids: dict[int, int]
    unknown: int
    merges: bool
    dummy_prefix: bool = True


def read_model(path: str, merges: bool = True) -> PieceModel:
    """A model file with byte pieces and no normalisation of its own, read on the driver."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    pieces = [sp.id_to_piece(i) for i in ids]
    if any(BLANK in p.lstrip(BLANK) for p in pieces):
        raise ValueError("a piece holds a blank after another character")
    byte_ids = {int(pieces[i][3:5], 16): i for i in ids if sp.is_byte(i)}
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte pieces")
    special = frozenset(
        i for i in ids if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
    )
    if merges:  # a piece that merging does not lead to is never met
        rank = {pieces[i]: sp.get_score(i) for i in ids if i not in special}
        special |= {i for i in ids if pieces[i] in rank and merge(list(pieces[i]), rank) != [pieces[i]]}
    return PieceModel(pieces, [sp.get_score(i) for i in ids], special, byte_ids, sp.unk_id(), merges)


def merge(symbols: list[str], rank: dict[str, float]) -> list[str]:
    """Joins the neighbours whose union scores best, the leftmost first, until none is a piece."""
    following = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    parts: list[str | None] = list(symbols)
    queue: list[tuple[float, int, str]] = []

    def offer(k: int) -> None:
        if k >= 0 and following[k] < len(parts):
            joined = parts[k] + parts[following[k]]
            if joined in rank:
                heapq.heappush(queue, (-rank[joined], k, joined))

    for k in range(len(parts)):
        offer(k)
    while queue:
        _, k, joined = heapq.heappop(queue)
        if parts[k] is None or following[k] >= len(parts) or parts[k] + parts[following[k]] != joined:
            continue
        gone = following[k]
        parts[k], parts[gone] = joined, None
        following[k] = following[gone]
        if following[k] < len(parts):
            before[following[k]] = k
        offer(k)
        offer(before[k])
    return [p for p in parts if p is not None]


class Numbered(dict):
    """Numbers words in the order they are first met, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


@dataclass
class PieceCoder:
    model: PieceModel
    #: Words remembered at most; the memory is emptied when full, which changes no result.
    most_words: int = 300_000
    most_pairs: int = 1_000_000
    known: Numbered = field(default_factory=lambda: Numbered())

    split = re.compile(rf"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")

    def __post_init__(self):
        model = self.model
        usable = [i for i in range(len(model.pieces)) if i not in model.special]
        self.longest = max((len(model.pieces[i]) for i in usable), default=1)
        self.rank = {model.pieces[i]: model.scores[i] for i in usable}
        # A code of a substring: the sum of mixed characters times powers of an odd number.
        self.odd = np.uint64(ODD)
        codes = np.array([self._code(model.pieces[i]) for i in usable], np.uint64)
        order = np.argsort(codes)
        self.codes = codes[order]
        self.ids = np.array(usable, np.int64)[order]
        if len(self.codes) > 1 and (self.codes[1:] == self.codes[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.scores = np.array(model.scores)
        # Which code beginnings occur at all, and the pairs met last, by hash.
        self.possible = np.zeros(1 << SLOTS, bool)
        self.possible[self.codes >> np.uint64(64 - SLOTS)] = True
        self.pairs: dict[int, bool] = {}
        self.slot_keys = np.full(1 << SLOTS, -1, np.int64)
        self.slot_may = np.zeros(1 << SLOTS, bool)
        self._forget()
        self.plain = [
            bytes([int(p[3:5], 16)]) if i in model.byte_ids.values()
            else b"" if p in ("<s>", "</s>", "<unk>") and i in model.special else p.replace(BLANK, " ").encode()
            for i, p in enumerate(model.pieces)
        ]

    def _forget(self) -> None:
        self.known = Numbered()
        self.flat = np.empty(0, np.int32)
        self.begin, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)

    @staticmethod
    def _mix(points: np.ndarray) -> np.ndarray:
        mixed = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ (mixed >> np.uint64(27))

    def _code(self, piece: str) -> np.uint64:
        code = np.zeros(1, np.uint64)
        for point in self._mix(np.array([ord(c) for c in piece], np.uint64)):
            code = code * self.odd + point
        return code[0]

    def _lookup(self, codes: np.ndarray) -> np.ndarray:
        """Piece ids of substring codes, -1 where there is none."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.ids[at], -1)

    def _joinable(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the characters of two pieces gives back just these two."""
        keys = left * len(self.model.pieces) + right
        slots = ((keys.astype(np.uint64) * self.odd) >> np.uint64(64 - SLOTS)).astype(np.int64)
        new = np.flatnonzero(self.slot_keys[slots] != keys)
        if len(self.pairs) > self.most_pairs:
            self.pairs.clear()
        answers = self.slot_may[slots]
        for k in new.tolist():
            key = int(keys[k])
            if (may := self.pairs.get(key)) is None:
                one, two = self.model.pieces[left[k]], self.model.pieces[right[k]]
                may = self.pairs[key] = merge(list(one + two), self.rank) == [one, two]
            self.slot_keys[slots[k]], self.slot_may[slots[k]] = key, may
            answers[k] = may
        return answers

    def viterbi(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as rows of code points, all of one length: one after the other, and how many of each."""
        rows, size = points.shape
        merges = self.model.merges
        mixed = self._mix(points)
        codes = np.zeros((rows, self.longest), np.uint64)  # of the substrings that end here, by length
        best = np.full((rows, size + 1), -np.inf)
        best[:, 0] = 0.0
        last = np.full((rows, size + 1), -1, np.int64)  # piece that ends here; below -1: a character by its bytes
        back = np.zeros((rows, size + 1), np.int32)
        for end in range(1, size + 1):
            codes[:, 1:] = codes[:, :-1] * self.odd + mixed[:, end - 1, None]
            codes[:, 0] = mixed[:, end - 1]
            here = codes[:, : min(end, self.longest)]
            row, shorter = np.nonzero(self.possible[here >> np.uint64(64 - SLOTS)])
            piece = self._lookup(here[row, shorter])
            start = end - 1 - shorter
            fits = np.flatnonzero((piece >= 0) & (best[row, start] > -np.inf))
            row, start, piece = row[fits], start[fits], piece[fits]
            single = np.zeros(rows, bool)
            single[row[start == end - 1]] = True
            if merges:
                # A character without a piece is never merged with its neighbours.
                before = last[row, start]
                pair = np.flatnonzero(before >= 0)
                fits = np.ones(len(row), bool)
                fits[pair] = self._joinable(before[pair], piece[pair])
                row, start, piece = row[fits], start[fits], piece[fits]
                score = best[row, start]
            else:
                score = best[row, start] + self.scores[piece]
                order = np.argsort(score, kind="stable")  # of several, the best is written last
                row, start, piece, score = row[order], start[order], piece[order], score[order]
            best[row, end], last[row, end], back[row, end] = score, piece, start
            lost = ~single & ~self.possible_single(points[:, end - 1]) & (best[:, end - 1] > -np.inf)
            lost = np.flatnonzero(lost & ((best[:, end] == -np.inf) | (not merges)))
            by_bytes = best[lost, end - 1] - (0.0 if merges else 1e6)
            lost, by_bytes = lost[by_bytes > best[lost, end]], by_bytes[by_bytes > best[lost, end]]
            best[lost, end], back[lost, end] = by_bytes, end - 1
            last[lost, end] = -2 - points[lost, end - 1].astype(np.int64)
        return self._backwards(last, back)

    def _backwards(self, last: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Follows the pointers of all words at once, from their ends."""
        rows, size = len(last), last.shape[1] - 1
        found = np.full((rows, size), -1, np.int64)
        row, end = np.arange(rows), np.full(rows, size)
        for column in range(size - 1, -1, -1):  # the last piece comes to stand last
            found[row, column] = last[row, end]
            end = back[row, end]
            row, end = row[end > 0], end[end > 0]
            if not len(row):
                break
        used = found != -1
        ids, sizes = found[used], used.sum(axis=1)
        lost = np.flatnonzero(ids < 0)
        if len(lost):
            spelled = [[self.model.byte_ids[b] for b in chr(-2 - i).encode()] for i in ids[lost].tolist()]
            times = np.ones(len(ids), np.int64)
            times[lost] = [len(x) for x in spelled]
            owner = np.repeat(np.arange(rows), sizes)
            sizes = np.bincount(owner, weights=times, minlength=rows).astype(np.int64)
            wide = np.repeat(ids, times)
            wide[wide < 0] = list(chain.from_iterable(spelled))
            ids = wide
        return ids, sizes

    def possible_single(self, points: np.ndarray) -> np.ndarray:
        """Whether a character is a piece."""
        return self._lookup(self._mix(points)) >= 0

    def _learn(self) -> None:
        """Ids of the words met for the first time, in the order of their numbers."""
        words, self.known.new = self.known.new, []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        ids, sizes, at = [self.flat], np.empty(len(words), np.int64), 0
        starts = np.flatnonzero(np.diff(lengths[order], prepend=0))
        for first, end in zip(starts, [*starts[1:], len(words)]):
            length = int(lengths[order[first]])
            step = max(1, ROWS_TIMES_LENGTH // max(length, self.longest))
            for at in range(first, end, step):
                some = order[at : min(at + step, end)]
                points = np.frombuffer("".join([words[i] for i in some.tolist()]).encode("utf-32-le"), np.uint32)
                found, sizes[some] = self.viterbi(points.reshape(len(some), length))
                ids.append(found.astype(np.int32))
        # Words of a length lie together; each word's number says where.
        begin = np.empty(len(words), np.int64)
        begin[order] = len(self.flat) + np.cumsum(sizes[order]) - sizes[order]
        self.flat = np.concatenate(ids)
        self.begin = np.concatenate([self.begin, begin])
        self.sizes = np.concatenate([self.sizes, sizes])

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has; null has none."""
        if len(self.known) > self.most_words:
            self._forget()
        prefix = BLANK if self.model.dummy_prefix else ""
        numbers, words_of = [], np.zeros(len(texts) + 1, np.int64)
        number = self.known.__getitem__
        for k, text in enumerate(texts):
            words = self.split.findall(prefix + text.replace(" ", BLANK)) if text else []
            numbers += map(number, words)
            words_of[k + 1] = len(numbers)
        if self.known.new:
            self._learn()
        at = np.array(numbers, np.int64)
        begin, sizes = self.begin[at], self.sizes[at]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        take = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], sizes)
        return self.flat[take], np.diff(ends[words_of])

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        flat, sizes = self.encode_flat(texts)
        parts = np.split(flat, np.cumsum(sizes)[:-1]) if texts else []
        return [None if text is None else part for text, part in zip(texts, parts)]

    def decode_bytes(self, ids: list[int]) -> bytes:
        plain = self.plain
        raw = b"".join([plain[i] for i in ids])
        return raw[1:] if self.model.dummy_prefix and raw.startswith(b" ") else raw

    def decode(self, ids: np.ndarray | list[int] | None) -> str | None:
        return None if ids is None else self.decode_bytes(np.asarray(ids, np.int64).tolist()).decode(errors="replace")


#: Texts encoded together; bounds the words of a batch.
TOGETHER = 500


def encode_documents(docs: DataFrame, model: PieceModel, keep: list[str], check: bool = False) -> DataFrame:
    """``ids`` and ``n_ids`` of each row's ``text``, beside the columns ``keep``.

    With ``check`` also ``round_trip``: whether the ids decode to the text.
    """
    kept = docs.select(*keep, F.col("text").cast("string").alias("_encoded_text"))
    names = [f.name for f in kept.schema.fields[:-1]]
    more = ["ids", "n_ids", *(["round_trip"] if check else [])]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceCoder(model)
        blank = BLANK.encode()
        for whole in batches:
            for at in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(at, TOGETHER)
                texts = batch.column(len(names)).to_pylist()
                flat, sizes = coder.encode_flat(texts)
                none = pa.array([text is None for text in texts])
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                columns = [
                    *batch.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=none),
                    pa.array(sizes.astype(np.int32), mask=none.to_numpy(zero_copy_only=False)),
                ]
                if check:
                    ids = flat.tolist()
                    columns.append(pa.array([
                        None if text is None
                        else coder.decode_bytes(ids[a:b]) == text.encode().replace(blank, b" ")
                        for text, a, b in zip(texts, ends.tolist(), ends[1:].tolist())
                    ], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *more])

    schema = T.StructType([
        *kept.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_ids", T.IntegerType()), *([T.StructField("round_trip", T.BooleanType())] if check else []),
    ])
    return kept.mapInArrow(encode, schema)


def decoded(ids: Column, model: PieceModel) -> Column:
    """The text of piece ids."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = PieceCoder(model)
        for batch in batches:
            yield pd.Series([coder.decode(i) for i in batch], dtype=object)

    return decode(ids)
