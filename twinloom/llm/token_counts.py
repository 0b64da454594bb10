"""Token counts that follow edits: a tree of counts per document, re-encoded only where edited.

A text is split into pre-tokens by the tokenizer's own pattern; merges never cross them, so a document's count is
the sum over its pre-tokens. Their lengths and counts are the leaves of a segment tree, in chunks of up to
``MOST`` leaves with sums over 1, 2, 4 ... chunks. An edit finds its first leaf by walking down the lengths, re-splits
from a little before until the old and new splits meet again behind it, counts only the pre-tokens in between, and
changes only the chunks that hold them: these are split when full and joined when nearly empty. A tree is kept as its
leaves, about two bytes each, and the sizes of its chunks; sums are made again when it is read.

Where splitting may start again: a split depends on what follows it only through a run of white space and
through an apostrophe, which all end within the next leaf, so two leaves before the edited place
are context enough. Where it may stop: the pattern has no memory, so from a common border on both splits agree.

Defined results: null counts as empty. An edit replaces the characters from ``start`` up to ``end`` (code points); both
are cut to the text, a null ``start`` is 0, a null or smaller ``end`` is ``start``, a null ``text`` is empty. Edits of a document apply
one after the other, each to the text as the ones before left it. Null edits are left out.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, functions as F

#: Pre-tokens before an edit that are split again with it.
CONTEXT = 2


@dataclass(frozen=True)
class TokenModel:
    """Byte-level merges: ``ranks`` of byte strings, and the pattern that splits a text."""

    ranks: dict[bytes, int]
    pattern: str


def read_ranks(path: str, pattern: str) -> TokenModel:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return TokenModel(ranks, pattern)


class Counter(dict):
    """Tokens of each pre-token met; emptied when full, which changes no count."""

    def __init__(self, model: TokenModel, most: int = 1 << 20):
        super().__init__()
        self.most = most
        encoding = tiktoken.Encoding("own", pat_str=model.pattern, mergeable_ranks=model.ranks, special_tokens={})
        self.encode = encoding.encode_ordinary
        self.split = regex.compile(model.pattern)

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        count = self[word] = len(self.encode(word))
        return count


#: Leaves of a chunk, at most and (but for the only one) at least.
MOST, FEW = 128, 32


class CountTree:
    """Lengths and token counts of the pre-tokens of a text in chunks, with sums over 1, 2, 4 ... chunks.

    ``chunks`` have a row of lengths and one of counts. ``levels[0]`` are their sums, padded to a power of two; the last
    level is the whole text.
    """

    def __init__(self, lengths: np.ndarray, counts: np.ndarray, sizes: np.ndarray | None = None):
        leaves = np.array([lengths, counts], np.int64).reshape(2, -1)
        if sizes is None:
            self.chunks = self._cut(leaves)
        else:
            self.chunks = np.split(leaves, np.cumsum(sizes)[:-1], axis=1) if len(sizes) else []
        self._sum_up()

    @staticmethod
    def _cut(leaves: np.ndarray) -> list[np.ndarray]:
        size = leaves.shape[1]
        return np.array_split(leaves, -(-size // MOST), axis=1) if size else []

    def _sum_up(self) -> None:
        width = 1 << max(0, (len(self.chunks) - 1).bit_length())
        sums = np.zeros((2, width), np.int64)
        for k, chunk in enumerate(self.chunks):
            sums[:, k] = chunk.sum(axis=1)
        self.levels = [sums]
        while self.levels[-1].shape[1] > 1:
            below = self.levels[-1]
            self.levels.append(below[:, ::2] + below[:, 1::2])

    @classmethod
    def of(cls, text: str, counter: Counter) -> CountTree:
        words = counter.split.findall(text)
        return cls(
            np.fromiter(map(len, words), np.int64, len(words)),
            np.fromiter(map(counter.__getitem__, words), np.int64, len(words)),
        )

    @property
    def size(self) -> int:
        return sum(chunk.shape[1] for chunk in self.chunks)

    @property
    def tokens(self) -> int:
        return int(self.levels[-1][1, 0])

    def find(self, at: int) -> tuple[int, int, int]:
        """The chunk and place of the leaf that holds character ``at`` (the last leaf, if none does), and where it starts."""
        chunk = start = 0
        for level in reversed(self.levels[:-1]):
            chunk *= 2
            left = int(level[0, chunk])
            if at >= start + left and chunk + 1 < level.shape[1] and level[0, chunk + 1]:
                start += left
                chunk += 1
        ends = start + np.cumsum(self.chunks[chunk][0])
        place = min(int(np.searchsorted(ends, at, side="right")), len(ends) - 1)
        return chunk, place, int(ends[place - 1]) if place else start

    def replace(self, first: tuple[int, int], last: tuple[int, int], new: np.ndarray) -> None:
        """Puts new leaves in place of those from ``first`` up to ``last`` (chunk and place each)."""
        begin, end = first[0], last[0] + (last[1] > 0)
        parts = [self.chunks[begin][:, : first[1]], new]
        if last[1]:
            parts.append(self.chunks[last[0]][:, last[1]:])
        size = sum(p.shape[1] for p in parts)
        if size < FEW and end < len(self.chunks):
            parts.append(self.chunks[end])
            end += 1
        elif size < FEW and begin:
            begin -= 1
            parts.insert(0, self.chunks[begin])
        pieces = self._cut(np.concatenate(parts, axis=1))
        same = len(pieces) == end - begin
        self.chunks[begin:end] = pieces
        if not same:
            self._sum_up()
            return
        for k, chunk in enumerate(pieces, begin):
            self.levels[0][:, k] = chunk.sum(axis=1)
        for below, above in zip(self.levels, self.levels[1:]):
            begin, end = begin // 2, (end + 1) // 2
            above[:, begin:end] = below[:, 2 * begin : 2 * end : 2] + below[:, 2 * begin + 1 : 2 * end : 2]

    def edit(self, text: str, start: int, end: int, new: str, counter: Counter) -> tuple[str, int]:
        """The text after an edit, and how many pre-tokens were counted for it."""
        start = min(max(start, 0), len(text))
        end = min(max(end, start), len(text))
        edited = text[:start] + new + text[end:]
        if not self.chunks:
            fresh = CountTree.of(edited, counter)
            self.chunks, self.levels = fresh.chunks, fresh.levels
            return edited, self.size
        chunk, place, begin = self.find(max(start - 1, 0))
        for _ in range(CONTEXT):
            if not place:
                if not chunk:
                    break
                chunk, place = chunk - 1, self.chunks[chunk - 1].shape[1]
            place -= 1
            begin -= int(self.chunks[chunk][0, place])
        first = chunk, place
        # Old borders behind the edit, as places in the new text.
        shift = len(new) - (end - start)
        border = begin

        def onward() -> None:
            nonlocal chunk, place, border
            border += int(self.chunks[chunk][0, place])
            place += 1
            if place == self.chunks[chunk].shape[1]:
                chunk, place = chunk + 1, 0

        while chunk < len(self.chunks) and border < end:
            onward()
        lengths: list[int] = []
        counts: list[int] = []
        at = begin
        for match in counter.split.finditer(edited, begin):
            # Borders may meet only behind what is new.
            while chunk < len(self.chunks) and border + shift < at:
                onward()
            if at >= start + len(new) and border + shift == at and border >= end:
                break
            lengths.append(match.end() - match.start())
            counts.append(counter[match.group()])
            at = match.end()
        else:
            chunk, place = len(self.chunks), 0
        self.replace(first, (chunk, place), np.array([lengths, counts], np.int64).reshape(2, -1))
        return edited, len(lengths)

    def packed(self) -> tuple[int, int, bytes, bytes]:
        """``size, tokens, chunks, leaves``: a byte for each chunk's size and for each length and count.

        Values of 255 and more are written as 255, and in full behind the bytes.
        """
        leaves = np.concatenate(self.chunks, axis=1) if self.chunks else np.zeros((2, 0), np.int64)
        sizes = np.array([chunk.shape[1] for chunk in self.chunks], np.uint8)
        flat = leaves.ravel()
        body = np.minimum(flat, 255).astype(np.uint8).tobytes() + flat[flat >= 255].astype("<u4").tobytes()
        return leaves.shape[1], self.tokens, sizes.tobytes(), body

    @classmethod
    def unpacked(cls, size: int, chunks: bytes, leaves: bytes) -> CountTree:
        flat = np.frombuffer(leaves, np.uint8, 2 * size).astype(np.int64)
        flat[flat == 255] = np.frombuffer(leaves, "<u4", offset=2 * size)
        return cls(flat[:size], flat[size:], np.frombuffer(chunks, np.uint8).astype(np.int64))


TREE = "struct<size:int,tokens:bigint,chunks:binary,leaves:binary>"
PARTS = ["size", "tokens", "chunks", "leaves"]

#: Texts that are handed on at once with their trees.
AT_ONCE = 256


def count_trees(text: Column, model: TokenModel) -> Column:
    """The tree of each text, to be kept beside it."""

    @F.pandas_udf(TREE)
    def build(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = Counter(model)
        for batch in batches:
            yield pd.DataFrame([CountTree.of(text or "", counter).packed() for text in batch], columns=PARTS)

    return build(text.cast("string"))


def tokens_of(tree: Column) -> Column:
    """Tokens of a stored tree's text."""
    return tree["tokens"]


EDITED = "text string, tree " + TREE + ", tokens long, counted long"
COUNTED = "n_before long, n_after long, n_pieces long, n_counted long"


def _apply(tree: CountTree, text: str, edits: list | None, counter: Counter) -> tuple[str, int]:
    counted = 0
    for edit in [] if edits is None else edits:
        if edit is not None:
            start = edit["start"] or 0
            end = start if edit["end"] is None else edit["end"]
            text, more = tree.edit(text, int(start), int(end), edit["text"] or "", counter)
            counted += more
    return text, counted


def edited_trees(text: Column, tree: Column, edits: Column, model: TokenModel) -> Column:
    """Text, tree and count after ``edits``, an array of ``start, end, text`` for each row.

    ``tree`` is the row's stored tree, as :func:`count_trees` made it for ``text``.
    """

    @F.pandas_udf(EDITED)
    def update(batches: Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        counter = Counter(model)
        columns = ["text", "tree", "tokens", "counted"]
        for texts, trees, lists in batches:
            rows = []
            for text, size, chunks, leaves, edits in zip(texts, trees["size"], trees["chunks"], trees["leaves"], lists):
                kept = CountTree.unpacked(int(size), chunks, leaves)
                after, counted = _apply(kept, text or "", edits, counter)
                rows.append((after, dict(zip(PARTS, kept.packed())), kept.tokens, counted))
                if len(rows) == AT_ONCE:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)

    return update(text.cast("string"), tree, edits)


def edited_counts(text: Column, tree: Column, edits: Column, model: TokenModel) -> Column:
    """``tokens`` after ``edits`` and pre-tokens ``counted`` for them, where nothing else is wanted of the edited tree."""

    @F.pandas_udf("tokens long, counted long")
    def count(batches: Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        counter = Counter(model)
        for texts, trees, lists in batches:
            rows = []
            for text, size, chunks, leaves, edits in zip(texts, trees["size"], trees["chunks"], trees["leaves"], lists):
                kept = CountTree.unpacked(int(size), chunks, leaves)
                _, counted = _apply(kept, text or "", edits, counter)
                rows.append((kept.tokens, counted))
            yield pd.DataFrame(rows, columns=["tokens", "counted"])

    return count(text.cast("string"), tree, edits)


def counts_with_edits(text: Column, edits: Column, model: TokenModel) -> Column:
    """Tokens before and after ``edits``, pre-tokens in all and pre-tokens counted again.

    Builds each tree and edits it in the same pass, for documents whose trees are not kept.
    """

    @F.pandas_udf(COUNTED)
    def count(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        counter = Counter(model)
        for texts, lists in batches:
            rows = []
            for text, edits in zip(texts, lists):
                tree = CountTree.of(text or "", counter)
                before, pieces = tree.tokens, tree.size
                _, counted = _apply(tree, text or "", edits, counter)
                rows.append((before, tree.tokens, pieces, counted))
            yield pd.DataFrame(rows, columns=["n_before", "n_after", "n_pieces", "n_counted"])

    return count(text.cast("string"), edits)
