"""Suffix arrays by linear grouping, and byte-level de-duplication on top of them.

The construction has two phases and no recursion or renaming.

*Grouping.*  Suffixes start grouped by their first symbol.  Groups are taken in
descending order.  For each suffix of the group the previous smaller one, the nearest
before it of a lower group, is found along the pointers already known; it gets the
group's Lyndon prefix appended to its own, so those that are pointed at leave their
groups for new ones just above, ordered by how many suffixes point at them.  In the end
each group holds the suffixes with one Lyndon prefix, in the order of those prefixes.

*Emitting.*  Suffixes are emitted in ascending order.  Each one puts those whose Lyndon
prefix ends where it starts, found along the pointers, on the next free place of their
groups.

Documents reach a shard as records aligned at an anchor (see :mod:`loam.llm.anchored`).
The alphabet is that of blocks of ``BLOCK`` bytes on the anchor's grid, so equal windows
are cut alike and the text to be sorted is short.  A window repeats if another one has the
same bytes before its first block, the same run of blocks, which the suffix array says, and
the same bytes after them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.anchored import Units, covered, original_id, packed, repeated_spans, tagged, unpacked
from loam.llm.common import BYTE_VALUE, U64, SpanHash, mix, ranges

BLOCK = 64


def group_suffixes(text: list[int]) -> tuple[list[int], list[int]]:
    """Phase 1 of ``text`` (its last symbol is the only smallest): (start of each suffix's group, previous
    smaller pointers)."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, start = [0] * n, [0] * n
    size = [0] * n
    first = 0
    for k, i in enumerate(order):
        if text[i] != text[order[first]]:
            first = k
        place[i] = k
        start[i] = first
        size[first] += 1
    smaller = [-1] * n
    end = n - 1
    while end >= 0:
        group = start[order[end]]
        if group == end:
            i = order[end]
            p = i - 1
            while p >= 0 and start[p] >= group:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                old = start[p]
                last = old + size[old] - 1
                if last != old:                       # p leaves its group for one of its own
                    q, k = order[last], place[p]
                    order[k], place[q] = q, k
                    order[last], place[p] = p, last
                    size[old] -= 1
                    start[p], size[last] = last, 1
        else:
            pointed: dict[int, int] = {}
            for i in sorted(order[group:end + 1]):
                p = i - 1
                while p >= 0 and start[p] >= group:
                    p = smaller[p]
                smaller[i] = p
                if p >= 0:
                    pointed[p] = pointed.get(p, 0) + 1
            by_count: dict[int, list[int]] = {}
            for p, c in pointed.items():
                by_count.setdefault(c, []).append(p)
            for c in sorted(by_count, reverse=True):
                for p in by_count[c]:                 # to the end of the old group
                    old = start[p]
                    size[old] -= 1
                    last = old + size[old]
                    q, k = order[last], place[p]
                    order[k], place[q] = q, k
                    order[last], place[p] = p, last
                fresh = []
                for p in by_count[c]:
                    old = start[p]
                    fresh.append((p, old + size[old]))
                for p, g in fresh:
                    start[p] = g
                    size[g] = 0
                for _, g in fresh:
                    size[g] += 1
        end = group - 1
    return start, smaller


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative integers; the end of the text is smaller than every symbol."""
    text = [int(x) + 1 for x in symbols.tolist()] + [0]
    n = len(text)
    start, smaller = group_suffixes(text)
    free = start                       # next free place of each group, by its first place
    at = list(range(n))
    done = bytearray(n)
    out = [0] * n
    out[0] = n - 1
    done[n - 1] = 1
    for k in range(n):
        p = out[k] - 1
        while p >= 0 and not done[p]:
            g = free[p]
            out[at[g]] = p
            at[g] += 1
            done[p] = 1
            p = smaller[p]
    return np.array(out[1:], np.int64)


def block_classes(sa: np.ndarray, symbols: np.ndarray, depth: int) -> np.ndarray:
    """For each place of the text, the number of its suffix's class of equal first ``depth`` symbols."""
    a, b, last = sa[:-1], sa[1:], symbols.size - 1
    same = np.ones(a.size, bool)
    for j in range(depth):
        same &= (np.maximum(a, b) + j <= last) & (symbols[np.minimum(a + j, last)] == symbols[np.minimum(b + j, last)])
    out = np.empty(symbols.size, np.int64)
    out[sa] = np.cumsum(np.r_[0, ~same])
    return out


def find_repeats(width: int, block: int = BLOCK):
    """Shard function: windows of ``width`` bytes that occur at two places or more."""
    def shard(cols: dict[str, np.ndarray], bodies: pa.Array):
        off = np.frombuffer(bodies.buffers()[1], np.int32)[bodies.offset:bodies.offset + len(bodies) + 1].astype(np.int64)
        raw = np.frombuffer(bodies.buffers()[2], np.uint8)[off[0]:off[-1]]
        off = off - off[0]
        n = off.size - 1
        spans = SpanHash(BYTE_VALUE[raw])
        before, windows = cols["before"], cols["windows"]
        # blocks on each record's grid, which goes through its anchor
        lead = before % block
        blocks = (np.diff(off) - lead) // block
        pos = np.repeat(off[:-1] + lead, blocks) + block * ranges(np.zeros(n, np.int64), blocks)
        ranks = np.unique(spans(pos, pos + block), return_inverse=True)[1] + 1
        first = np.concatenate([[0], np.cumsum(blocks + 1)])          # a separator after each record
        symbols = np.zeros(first[-1], np.int64)
        symbols[ranges(first[:-1], blocks)] = ranks
        sa = suffix_array(symbols)
        # window at w: its first block, how many fit, and the bytes around them
        rec = np.repeat(np.arange(n), windows)
        w = ranges(np.zeros(n, np.int64), windows)
        ahead = (lead[rec] - w) % block
        depth = (width - ahead) // block
        grid = off[rec] + w + ahead
        place = first[rec] + (w + ahead - lead[rec]) // block
        classes = np.zeros(rec.size, np.int64)
        for d in np.unique(depth):
            here = depth == d
            if d:
                classes[here] = block_classes(sa, symbols, int(d))[place[here]]
        at = off[rec] + w
        key = mix(spans(at, grid) + U64(3) * spans(grid + depth * block, at + width)
                  ^ mix((classes * (block + 1) + ahead).astype(U64)))
        order = np.argsort(key, kind="stable")
        k = key[order]
        new = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if k.size else np.zeros(0, np.int64)
        total = np.add.reduceat(cols["copies"][rec[order]], new) if k.size else new
        twice = np.zeros(rec.size, bool)
        twice[order] = np.repeat(total > 1, np.diff(np.r_[new, k.size]))
        rec, w = rec[twice], w[twice]
        head = np.flatnonzero(np.r_[True, (rec[1:] != rec[:-1]) | (w[1:] != w[:-1] + 1)]) if rec.size else np.zeros(0, np.int64)
        tail = np.r_[head[1:] - 1, rec.size - 1] if rec.size else head
        return rec[head], w[head], w[tail], np.ma.masked_all(head.size, np.int64)

    return shard


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def remove_repeated_bytes(docs: DataFrame, text: str = "text", width: int = 400, shard_bytes: int = 2 << 20) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for every row: the bytes left.

    A byte goes if a string of ``width`` bytes over it also starts anywhere else, in the
    same document or another; strings are judged on the input.  Null texts are empty.
    Repeated rows repeat each other's strings; null doc_ids come back as null; an empty
    table gives an empty one; other columns are not read.
    """
    units = Units(words=False, width=width, gram=min(16, width))
    rows = tagged(docs, text)
    small = packed(rows)
    spans = repeated_spans(rows, small, units, False, find_repeats(width), shard_bytes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, raw, off in unpacked(batches):
            out, spans_col = [], chunk.column(2)
            for i in range(chunk.num_rows):
                body = raw[off[i]:off[i + 1]]
                gone = covered(spans_col[i].values if spans_col[i].is_valid else None, body.size, width)
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if body.size else 0
                out.append((body.size, int(gone.sum()), runs, body[~gone].tobytes()))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [chunk.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())],
                names=[c.split()[0] for c in KEPT.split(", ")])

    joined = small.join(spans, ["doc_id", "tag"], "left").select("doc_id", "packed", "spans")
    out = joined.mapInArrow(run, KEPT)
    return out.withColumn("doc_id", original_id(F.col("doc_id")))
