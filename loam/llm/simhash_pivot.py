"""SimHash near-duplicates found through distance tables to reference fingerprints (pivots).

A fingerprint is known by its Hamming distances to the pivots.  By the triangle
inequality two fingerprints within ``max_bits`` differ by at most ``max_bits`` in
every one of those distances, so a pair whose largest coordinate difference is
above that can be thrown away without comparing the fingerprints.

The pivots are the zero fingerprint, the 64 fingerprints of one bit, and
``SPREAD`` pseudo-random ones.  The first 65 also say which pairs can meet at all:
``d(x, unit_i) - d(x, zero)`` is +1 or -1 and, within ``max_bits``, x and y agree in
that value for all but ``max_bits`` units.  With the units dealt into ``BLOCKS``
blocks, at least ``BLOCKS - max_bits`` blocks agree entirely, so pairs are only
formed in cells of equal table values over some choice of blocks.  A cell that
holds many fingerprints is dealt again over its other units, so no cell is
compared with itself all against all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.common import U64, mix, text_chunks
from loam.llm.components import connected_components
from loam.session import materialize

BLOCKS = 6
SPREAD = 64
CELL_LIMIT = 256          # a larger cell is dealt again; it changes the work, never the result
PIVOTS = np.concatenate([
    np.zeros(1, U64), U64(1) << np.arange(64, dtype=U64), mix(np.arange(1, SPREAD + 1, dtype=U64))])


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 for a text without words."""
    words = text.lower().split()        # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    h = np.fromiter((xxhash.xxh64_intdigest(g, seed) for g in grams), dtype="<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > h.size, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint) for every row; the 64 bits as a signed long."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in text_chunks(batches):
            prints = [fingerprint(raw[off[i]:off[i + 1]].tobytes(), shingle) for i in range(rows.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).cast(pa.int64()), pa.array(np.array(prints, dtype=U64).view(np.int64))],
                names=["doc_id", "fingerprint"])

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, "doc_id long, fingerprint long")


def distance_table(prints: np.ndarray, pivots: np.ndarray = PIVOTS) -> np.ndarray:
    """Hamming distance of every fingerprint to every pivot."""
    return np.bitwise_count(prints[:, None] ^ pivots[None, :])


def _deals(units: tuple[int, ...], max_bits: int) -> list[tuple[int, ...]]:
    """Choices of units such that any two fingerprints within ``max_bits`` agree on all of one choice."""
    n = min(max(BLOCKS, max_bits + 1), len(units))
    blocks = [units[i::n] for i in range(n)]
    return [tuple(sorted(sum(c, ()))) for c in combinations(blocks, max(n - max_bits, 0))]


def _cells(table: np.ndarray, units: tuple[int, ...]) -> np.ndarray:
    """Each row's table values relative to the zero pivot over ``units``, as one number."""
    up = table[:, [u + 1 for u in units]] > table[:, :1]
    weights = U64(1) << np.arange(len(units), dtype=U64)
    return up.astype(U64) @ weights


def _close_pairs(prints: np.ndarray, table: np.ndarray, cell: np.ndarray, units: tuple[int, ...],
                 max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within ``max_bits`` among rows of equal ``cell`` (sorted); ``units``: those the cells leave open."""
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[first, cell.size])
    if len(units) > max_bits:
        for f, s in zip(first[size > CELL_LIMIT], size[size > CELL_LIMIT], strict=True):
            inner, tab = prints[f:f + s], table[f:f + s]
            for deal in _deals(units, max_bits):
                key = _cells(tab, deal)
                order = np.argsort(key, kind="stable")
                rest = tuple(u for u in units if u not in deal)
                yield from _close_pairs(inner[order], tab[order], key[order], rest, max_bits)
        small = np.repeat(size <= CELL_LIMIT, size)
        prints, table, cell = prints[small], table[small], cell[small]
    shift = 1
    while cell.size > shift:
        i = np.flatnonzero(cell[shift:] == cell[:-shift])
        if not i.size:
            break
        for part in np.array_split(i, i.size // 50_000 + 1):
            j = part + shift
            apart = np.abs(table[part].astype(np.int16) - table[j].astype(np.int16)).max(axis=1)
            part, j = part[apart <= max_bits], j[apart <= max_bits]
            sure = np.bitwise_count(prints[part] ^ prints[j]) <= max_bits
            yield prints[part[sure]], prints[j[sure]]
        shift += 1


def _forest(pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """Those of the links that join what was apart: at most one a node."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    out = []
    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                parent[p] = q
                out.append((x, y))
    return out


def near_links(distinct: DataFrame, max_bits: int = 3, batch: int = 20_000) -> DataFrame:
    """Links (a, b) that connect every two of the distinct fingerprints within ``max_bits``.

    Each fingerprint is dealt once per choice of blocks and meets its cell after
    a sort; whole cells are taken together, and a forest of their links goes on.
    """
    deals = _deals(tuple(range(64)), max_bits)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            prints = rows.column(0).to_numpy(zero_copy_only=False).view(U64)
            for lo in range(0, prints.size, batch):
                part = prints[lo:lo + batch]
                table = distance_table(part, PIVOTS[:65])
                for k, units in enumerate(deals):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(part.size, k, np.int32)), pa.array(_cells(table, units).view(np.int64)),
                         pa.array(part.view(np.int64))], names=["deal", "cell", "fingerprint"])

    def link(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(k: int, cell: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            rest = tuple(u for u in range(64) if u not in deals[k])
            yield from _close_pairs(prints, distance_table(prints), cell, rest, max_bits)

        def emit(k: np.ndarray, cell: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            found: list[tuple[int, int]] = []
            for x in np.unique(k):
                here = k == x
                # cells of one fingerprint have nothing to link
                c = cell[here]
                same = np.zeros(c.size, bool)
                same[1:] = c[1:] == c[:-1]
                same[:-1] |= same[1:]
                if same.any():
                    found += _forest(pairs(int(x), c[same], prints[here][same]))
            got = np.array(found, dtype=U64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], names=["a", "b"])

        held: list[np.ndarray] | None = None
        for rows in batches:
            new = [rows.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            new[2] = new[2].view(U64)
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if not held[0].size:
                continue
            cut = int(np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))[-1]) + 1 \
                if (held[0][0] != held[0][-1] or held[1][0] != held[1][-1]) else 0
            if cut:
                yield emit(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if held is not None and held[0].size:
            yield emit(*held)

    dealt = distinct.select("fingerprint").mapInArrow(deal, "deal int, cell long, fingerprint long")
    met = dealt.repartition("deal", "cell").sortWithinPartitions("deal", "cell", "fingerprint")
    return met.mapInArrow(link, "a long, b long").distinct()


def simhash_components(docs: DataFrame, text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Equal fingerprints are one node, so a group of copies costs one row after the
    first aggregation.  Null and empty texts have fingerprint 0 and are linked like
    any other; rows of a null doc_id are kept, and count for a component's id only
    if it has no other (then it is null).  Repeated rows come out as often as they
    came in; other columns are not read.
    """
    return simhash_members(docs, text, shingle, max_bits).drop("root")


def simhash_members(docs: DataFrame, text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """:func:`simhash_components` with the component's ``root``, which tells components apart that share an id."""
    prints = materialize(fingerprints(docs, text, shingle))
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("low"))
    parts = connected_components(near_links(nodes.select("fingerprint"), max_bits))
    member = nodes.join(parts, nodes["fingerprint"] == parts["node"], "left").select(
        "fingerprint", "low", F.coalesce("root", "fingerprint").alias("root"))
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    named = member.join(lowest, "root").select(F.col("fingerprint").alias("_fp"), "component_id", "root")
    return prints.join(named, F.col("fingerprint") == F.col("_fp")).select("doc_id", "fingerprint", "component_id", "root")
