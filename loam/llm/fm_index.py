"""Substring de-duplication over words with an FM-index per shard.

The records of a shard (see :mod:`loam.llm.anchored`) are indexed by their
Burrows-Wheeler transform, kept in a wavelet tree: one packed bit vector per bit of
the word ids, with ranks counted per 64 bits.  The records are then streamed against
the index, all of them side by side: backward search extends each one's match a word at
a time from its right end.  Once a match has reached the threshold it is kept at that
length (its last word is dropped by widening the interval to the suffixes that share one
word less), so each further word reports the interval of one window.  The smallest
document in a window's interval says for whom it is a repetition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.anchored import Units, covered, original_id, packed, repeated_spans, tagged, unpacked
from loam.llm.common import U64, text_buffer, word_hashes, word_spans



class WaveletTree:
    """Rank queries on a sequence of small integers, in the pointerless (level-wise) layout."""

    def __init__(self, values: np.ndarray, bits: int):
        self.n, self.levels = values.size, []
        for level in reversed(range(bits)):
            bit = (values >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -packed.size % 8, np.uint8)]).view("<u8")
            counts = np.zeros(packed.size + 1, np.int64)
            np.cumsum(np.bitwise_count(packed), out=counts[1:])
            self.levels.append((level, packed, counts, self.n - int(bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        lo, hi = np.zeros_like(at), at
        for level, packed, counts, zeros in self.levels:
            one = symbol >> level & 1 == 1
            ones_lo, ones_hi = self._ones(packed, counts, lo), self._ones(packed, counts, hi)
            lo = np.where(one, zeros + ones_lo, lo - ones_lo)
            hi = np.where(one, zeros + ones_hi, hi - ones_hi)
        return hi - lo

    @staticmethod
    def _ones(packed: np.ndarray, counts: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (U64(1) << (at & 63).astype(U64)) - U64(1)
        return counts[word] + np.bitwise_count(packed[word] & below)


class FMIndex:
    """Index of texts (arrays of symbols from 1, one after the other, ``off`` between them)."""

    def __init__(self, symbols: np.ndarray, off: np.ndarray):
        n_texts = off.size - 1
        # a separator after each text; separators are smaller than symbols and all different
        total = symbols.size + n_texts
        ends = off[1:] + np.arange(n_texts)
        body = np.ones(total, bool)
        body[ends] = False
        self.text = np.zeros(total, np.int64)
        self.text[body] = symbols
        self.begin = off[:-1] + np.arange(n_texts)
        self.end = ends
        owner = np.repeat(np.arange(n_texts), np.diff(off) + 1)
        rank = self.text + n_texts
        rank[ends] = np.arange(n_texts)
        self.sa, rank = self._suffix_array(rank)
        self.owner = owner[self.sa]
        before = self.text[self.sa - 1]                 # of the first suffix: the last separator
        self.tree = WaveletTree(before, max(1, int(self.text.max(initial=1)).bit_length()))
        counts = np.bincount(self.text, minlength=int(self.text.max(initial=0)) + 2)
        self.less = np.cumsum(counts) - counts

    @staticmethod
    def _suffix_array(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prefix doubling; separators differ, so it ends at the longest text's length."""
        n, step = rank.size, 1
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
        while True:
            key = rank * (n + 1)
            key[:n - step] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            k = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.r_[False, k[1:] != k[:-1]])
            rank = new
            step *= 2
            if rank[order[-1]] == n - 1 or step >= n:
                return order, rank

    def blocks(self, length: int) -> np.ndarray:
        """For each suffix in order, the number of its class of equal first ``length`` symbols."""
        a, b = self.sa[:-1], self.sa[1:]
        same = np.ones(a.size, bool)
        last = self.text.size - 1
        for j in range(length):
            x, y = self.text[np.minimum(a + j, last)], self.text[np.minimum(b + j, last)]
            same &= (x == y) & (x > 0)
        return np.cumsum(np.r_[0, ~same])

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the intervals of symbol + match from those of the match."""
        base = self.less[symbol]
        return base + self.tree.rank(symbol, lo), base + self.tree.rank(symbol, hi)

    def windows(self, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Streams every text against the index: (text, place in it, lo, hi) of its windows of ``length``."""
        shorter = self.blocks(length - 1) if length > 1 else np.zeros(self.sa.size, np.int64)
        first = np.flatnonzero(np.r_[True, shorter[1:] != shorter[:-1]])
        after = np.r_[first[1:], shorter.size]
        lane = np.flatnonzero(self.end - self.begin >= length)
        at = self.end[lane] - 1
        lo, hi = np.zeros(lane.size, np.int64), np.full(lane.size, self.sa.size)
        matched = 0
        while lane.size:
            if matched == length:            # drop the last word: the interval of the first length - 1
                block = shorter[lo]
                lo, hi = first[block], after[block]
            lo, hi = self.extend(self.text[at], lo, hi)
            matched = min(matched + 1, length)
            if matched == length:
                yield lane, at - self.begin[lane], lo, hi
            go = at > self.begin[lane]
            lane, at, lo, hi = lane[go], at[go] - 1, lo[go], hi[go]


def find_repeats(width: int):
    """Shard function: windows of a record that a document before some of its own documents has."""
    def shard(cols: dict[str, np.ndarray], bodies: pa.Array):
        raw, off = text_buffer(bodies.cast(pa.large_binary()).view(pa.large_string()))
        start, end, texts = word_spans(raw, off)
        hashes = word_hashes(raw, start, end)
        symbols = np.unique(hashes, return_inverse=True)[1] + 1
        index = FMIndex(symbols, texts)
        block = index.blocks(width)
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        lowest = np.minimum.reduceat(cols["low"][index.owner], first)
        parts = []
        for text, place, lo, _ in index.windows(width):
            low = lowest[block[lo]]
            good = low < cols["high"][text]
            parts.append((text[good], place[good], low[good]))
        text, place, low = (np.concatenate(x) if parts else np.zeros(0, np.int64) for x in zip(*parts, strict=True)) \
            if parts else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((place, text))
        text, place, low = text[order], place[order], low[order]
        new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (place[1:] != place[:-1] + 1) | (low[1:] != low[:-1])]) \
            if text.size else np.zeros(0, np.int64)
        lastw = np.r_[new[1:] - 1, text.size - 1] if new.size else new
        return text[new], place[new], place[lastw], low[new]

    return shard


def _without_repeats(rows: DataFrame, width: int, shard_bytes: int, verbatim: bool) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, rest) of ``tagged`` rows."""
    units = Units(words=True, width=width, gram=min(4, width))
    small = packed(rows)
    spans = repeated_spans(rows, small, units, True, find_repeats(width), shard_bytes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, raw, off in unpacked(batches):
            start, end, texts = word_spans(raw, off)
            data, out, spans_col = raw.tobytes(), [], chunk.column(2)
            for i in range(chunk.num_rows):
                a, b = texts[i], texts[i + 1]
                gone = covered(spans_col[i].values if spans_col[i].is_valid else None, int(b - a), width)
                lost = int(gone.sum())
                if verbatim and not lost:
                    kept = data[off[i]:off[i + 1]]
                else:
                    keep = np.flatnonzero(~gone) + a
                    kept = b" ".join([data[x:y] for x, y in zip(start[keep].tolist(), end[keep].tolist(), strict=True)])
                out.append((int(b - a), lost, kept.decode()))
            n, r, k = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(k, pa.string()),
                 chunk.column(1).field("rest")], names=["doc_id", "n_words", "n_removed", "kept", "rest"])

    rest = rows.schema["rest"].dataType.simpleString()
    joined = small.join(spans, ["doc_id", "tag"], "left").select("doc_id", "packed", "spans")
    return joined.mapInArrow(run, f"doc_id long, n_words long, n_removed long, kept string, rest {rest}")


def remove_repeated_words(docs: DataFrame, text: str = "text", width: int = 13, shard_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row: the words left, joined by single spaces.

    A word goes if a window of ``width`` words over it also starts in a document with a
    smaller doc_id; windows are judged on the input.  Null texts have no words.  A null
    doc_id counts as the smallest; rows that repeat a doc_id do not take from each other.
    Ties have no other order than doc_id; an empty table gives an empty one; other
    columns are not read.
    """
    out = _without_repeats(tagged(docs, text), width, shard_bytes, False)
    return out.select(original_id(F.col("doc_id")).alias("doc_id"), "n_words", "n_removed", "kept")


def keep_unrepeated_words(docs: DataFrame, width: int = 13, shard_bytes: int = 1 << 20) -> DataFrame:
    """``docs`` with ``text`` cleared of repeated passages as by :func:`remove_repeated_words`; a text that loses
    nothing keeps its own white space.  Null texts become empty.

    A shard takes some 40 bytes of memory for each of its own while it is searched; shards are smaller here, as
    workers that have run other stages hold the memory of these."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = tagged(docs, "text", rest)
    out = _without_repeats(rows, width, shard_bytes, True)
    return out.select(original_id(F.col("doc_id")).alias("doc_id"), F.col("kept").alias("text"),
                      *[F.col("rest").getField(c).alias(c) for c in rest])
