"""Finding, over all documents, the windows of a text that may occur elsewhere, and taking them to one task.

Every window of ``width`` units (bytes or words) has a *canonical anchor*: the k-gram
in it with the smallest hash, the first of equals.  Equal windows have equal anchors at
equal offsets, so windows need only be compared with those of the same anchor hash.  The
windows of one anchor occurrence are neighbours; they and the text under them make a
*record* of at most ``2 * width`` units, whatever the document's length.

Records whose anchor hash occurs once cannot repeat and go no further.  Equal records
are counted, and one of them, with its count, stands for all: a group of copies costs
as much as one text after that.  An operator's shard function gets whole anchor groups
of distinct records, a bounded number of units at a time.

A group that is too large for one shard (a passage in very many surroundings) is divided on
the task's disk: its windows by how many units they have before the anchor, in halves, and
within a half by the hash of the units that all windows of the half have in common.  Equal
windows stay together; pieces that are equal become one, and those that are alone go.

Hashes have 64 bits, a record's identity 128.  Rows that share a doc_id but not a text, or
have none, are told apart by a hash of 64 bits (see :func:`tagged`).
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from loam.llm.common import BYTE_VALUE, U64, SpanHash, mix, ranges, sliding_min, text_chunks, word_hashes, word_spans
from loam.session import materialize

HOT = 4                       # an anchor's records of more than so many shards are divided
FAN = 16                      # files that a half of them is dealt to
NO_ID = -(1 << 63)            # stands for a null doc_id
SHARED_IDS = 1_000_000        # doc_ids with several texts: so many are sent to all tasks, more are joined by a shuffle
ANCHOR_BITS = 48              # records are only brought together by anchors; more bits would only travel


def _never_null(**fields) -> StructType:
    """A schema without nulls: joins then add no filters, and equal exchanges stay equal and are reused."""
    return StructType([StructField(name, kind, False) for name, kind in fields.items()])


@dataclass(frozen=True)
class Units:
    """What a window is made of: ``words`` or bytes, how many, and the anchor's k-gram."""
    words: bool
    width: int
    gram: int

    def __post_init__(self):
        if self.width >= 1 << 16:
            raise ValueError(f"windows of {self.width} units: at most {(1 << 16) - 1}")

    @property
    def bits(self) -> int:
        """Bits of a window's place in its record."""
        return max(9, self.width.bit_length())

    def split(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(unit hashes, unit starts, unit ends, texts' offsets in units)."""
        if not self.words:
            at = np.arange(raw.size)
            return BYTE_VALUE[raw], at, at + 1, off
        start, end, texts = word_spans(raw, off)
        return word_hashes(raw, start, end), start, end, texts


@dataclass
class Records:
    """Anchor records of some texts; unit positions count through all of them."""
    text: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray


def anchor_records(hashes: np.ndarray, texts: np.ndarray, units: Units) -> Records:
    n, w = hashes.size, units.width
    if n < w:
        none = np.zeros(0, np.int64)
        return Records(none, none.view(U64), none.view(U64), none, none, none)
    spans = SpanHash(hashes)
    start = np.arange(n - units.gram + 1)
    gram = spans(start, start + units.gram)
    key = (gram >> U64(32) << U64(32)) | start.astype(U64)
    at = (sliding_min(key, w - units.gram + 1) & U64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(texts.size - 1), np.diff(texts))
    p = np.flatnonzero(owner[:n - w + 1] == owner[w - 1:])
    if not p.size:
        none = np.zeros(0, np.int64)
        return Records(none, none.view(U64), none.view(U64), none, none, none)
    a = at[p]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)])
    first, last, a = p[new], p[np.r_[new[1:] - 1, p.size - 1]], a[new]
    content = mix(spans(first, last + w) ^ (a - first).astype(U64) * U64(0x9E3779B97F4A7C15))
    return Records(owner[first], gram[a], content, a, first, last)


def pack_place(at: np.ndarray, before: np.ndarray, more: np.ndarray, bits: int) -> np.ndarray:
    """Anchor position, windows before the anchor, windows after the first (``bits`` each): one long."""
    return (at.astype(np.int64) << 2 * bits) | (before << bits) | more


def first_window(place: Column, bits: int) -> Column:
    """The first window of a packed place."""
    return F.shiftrightunsigned(place, 2 * bits) - F.shiftrightunsigned(place, bits).bitwiseAND(F.lit((1 << bits) - 1))


def tagged(docs: DataFrame, text: str, rest: list[str] | None = None) -> DataFrame:
    """(doc_id, tag, text, rest); doc_id and tag are a row's identity.

    The tag is the text's 64-bit hash where a doc_id is null or has several texts, and 0, which
    costs next to nothing on its way through shuffles, where the doc_id does by itself.
    ``rest``: names of other columns, which go along in a struct, so that no name can clash.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    rows = docs.select(doc_id.alias("doc_id"), F.xxhash64(body).alias("hash"), body.alias("text"),
                       F.struct(*(rest or [F.lit(0).alias("none")])).alias("rest"))
    shared = materialize(rows.filter(F.col("doc_id") != NO_ID).groupBy("doc_id").agg(
        F.min("hash").alias("_low"), F.max("hash").alias("_high")).filter("_low <> _high").select(F.col("doc_id").alias("_id")))
    own, n = F.col("doc_id") == NO_ID, shared.count()
    if n:
        rows = rows.join(F.broadcast(shared) if n <= SHARED_IDS else shared, F.col("doc_id") == F.col("_id"), "left")
        own = own | F.col("_id").isNotNull()
    tag = F.coalesce(F.when(own, F.col("hash")), F.lit(0).cast("long"))
    return rows.select("doc_id", tag.alias("tag"), "text", "rest")


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, packed): ``tagged`` documents with their texts compressed, for the way through a shuffle.

    One struct holds text and rest, so that all who read it shuffle the same thing, once.
    """
    rest = docs.schema["rest"].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for rows, raw, off in text_chunks(batches):
            small = [press.compress(raw[off[i]:off[i + 1]].tobytes()) for i in range(rows.num_rows)]
            both = pa.StructArray.from_arrays([pa.array(small, pa.binary()), rows.column(3)], names=["text", "rest"])
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), both], names=["doc_id", "tag", "packed"])

    kind = StructType([StructField("text", BinaryType(), False), StructField("rest", rest, True)])
    return docs.mapInArrow(run, _never_null(doc_id=LongType(), tag=LongType(), packed=kind))


def unpacked(batches: Iterable[pa.RecordBatch], max_bytes: int = 1 << 20
             ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) as from ``text_chunks``, from a ``packed`` column."""
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        small = batch.column(batch.schema.get_field_index("packed")).field("text")
        first, size, parts = 0, 0, []
        for i in range(batch.num_rows):
            parts.append(press.decompress(small[i].as_py()))
            size += len(parts[-1])
            if size >= max_bytes or i == batch.num_rows - 1:
                off = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
                yield batch.slice(first, i + 1 - first), np.frombuffer(b"".join(parts), np.uint8), off
                first, size, parts = i + 1, 0, []


def all_records(docs: DataFrame, units: Units) -> DataFrame:
    """(anchor, content, doc_id, tag, place) of every anchor record of ``tagged`` documents."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in text_chunks(batches):
            ids, tags = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            hashes, _, _, texts = units.split(raw, off)
            r = anchor_records(hashes, texts, units)
            local = r.at - texts[r.text]
            yield pa.RecordBatch.from_arrays(
                [pa.array((r.anchor >> U64(64 - ANCHOR_BITS)).astype(np.int64)), pa.array(r.content.view(np.int64)), pa.array(ids[r.text]),
                 pa.array(tags[r.text]), pa.array(pack_place(local, r.at - r.first, r.last - r.first, units.bits))],
                names=["anchor", "content", "doc_id", "tag", "place"])

    return docs.select("doc_id", "tag", "text").mapInArrow(run, _never_null(
        anchor=LongType(), content=LongType(), doc_id=LongType(), tag=LongType(), place=LongType()))


class Spill:
    """Records in an unnamed file of the task, read as often as wanted."""

    def __init__(self):
        self._file = self._writer = None

    def add(self, rows: pa.RecordBatch) -> None:
        if rows.num_rows:
            if self._file is None:
                self._file = tempfile.TemporaryFile()
                self._writer = pa.ipc.new_stream(self._file, rows.schema)
            self._writer.write_batch(rows)

    def read(self) -> Iterator[pa.RecordBatch]:
        if self._file is not None:
            if self._writer is not None:          # once: closing writes an end mark where the file stands
                self._writer.close()
                self._writer = None
            self._file.seek(0)
            yield from pa.ipc.open_stream(self._file)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
        self._file = self._writer = None


def cut_records(rows: pa.RecordBatch, units: Units, lo: int, hi: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The records' windows with lo <= units before the anchor < hi, and the hash of what all such windows share.

    A piece has a name by its units, as a record's content is one."""
    before, windows, shift = (rows.column(c).to_numpy() for c in ("before", "windows", "shift"))
    a, b = np.maximum(0, before - hi + 1), np.minimum(windows - 1, before - lo)
    ok = np.flatnonzero(a <= b)
    body = rows.column("body").cast(pa.large_binary())
    off = np.frombuffer(body.buffers()[1], np.int64)[body.offset:body.offset + len(body) + 1]
    raw = np.frombuffer(body.buffers()[2], np.uint8)[off[0]:off[-1]]
    hashes, start, end, texts = units.split(raw, off - off[0])
    a, b, before, first = a[ok], b[ok], before[ok], texts[ok]
    spans = SpanHash(hashes)
    key = spans(first + before - lo, first + before - hi + 1 + units.width)
    name = mix(spans(first + a, first + b + units.width) ^ (before - a).astype(U64) * U64(0x9E3779B97F4A7C15))
    data = raw.tobytes()
    cut = [data[x:y] for x, y in zip(start[first + a].tolist(), end[first + b + units.width - 1].tolist(), strict=True)]
    new = {"before": pa.array(before - a), "windows": pa.array(b - a + 1), "shift": pa.array(shift[ok] + a),
           "body": pa.array(cut, pa.binary()), "name": pa.array(name.view(np.int64)), "key": pa.array(key.view(np.int64))}
    kept = rows.take(pa.array(ok))
    names = [c for c in rows.schema.names if c != "key"] + ["key"]
    return pa.RecordBatch.from_arrays([new[c] if c in new else kept.column(c) for c in names], names=names), key


def repeated_keys(group: Spill) -> np.ndarray:
    """Keys of two copies or more, in order; a window of any other key is nowhere else."""
    keys, copies = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for rows in group.read():
        keys, where = np.unique(np.concatenate([keys, rows.column("key").to_numpy()]), return_inverse=True)
        total = np.zeros(keys.size, np.int64)
        np.add.at(total, where, np.concatenate([copies, rows.column("copies").to_numpy()]))
        copies = total
    return keys[copies > 1]


def divided(group: Spill, units: Units, shard: Callable, limit: int, lo: int, hi: int, depth: int = 0) -> Iterator[pa.RecordBatch]:
    """What ``shard`` finds in the windows of a group with lo <= units before the anchor < hi, holding
    distinct records of about ``limit`` bytes at a time."""
    alive = repeated_keys(group) if depth else None
    if alive is not None and not alive.size:
        return

    def parts() -> Iterator[pa.RecordBatch]:
        for rows in group.read():
            yield rows if alive is None else rows.filter(pa.array(np.isin(rows.column("key").to_numpy(), alive)))

    # equal pieces are one
    number: dict[int, int] = {}
    ones: list[list] = []
    size, fits = 0, True
    for rows in parts():
        cols = [rows.column(c).to_pylist() for c in ("low", "high", "copies", "before", "windows", "body")]
        for name, low, high, copies, *rest in zip(rows.column("name").to_pylist(), *cols, strict=True):
            k = number.setdefault(name, len(ones))
            if k == len(ones):
                ones.append([low, high, copies, *rest])
                size += len(rest[-1]) + 64
            else:
                one = ones[k]
                one[0], one[1], one[2] = min(one[0], low), max(one[1], high), one[2] + copies
        fits = size <= limit or len(ones) < 2
        if not fits:
            break
    if fits:
        if ones:
            *cols, body = zip(*ones, strict=True)
            cols = dict(zip(("low", "high", "copies", "before", "windows"), (np.array(c, np.int64) for c in cols), strict=True))
            found, a, b, low = shard(cols, pa.array(body, pa.binary()))
            order, each = np.argsort(found, kind="stable"), np.bincount(found, minlength=len(ones))
            first, low = np.cumsum(each) - each, pa.array(low, pa.int64())
            for rows in parts():
                k = np.fromiter((number[x] for x in rows.column("name").to_pylist()), np.int64, rows.num_rows)
                owner, got = np.repeat(np.arange(k.size), each[k]), order[ranges(first[k], each[k])]
                shift = rows.column("shift").to_numpy()[owner]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("anchor").take(pa.array(owner)), rows.column("content").take(pa.array(owner)),
                     pa.array(a[got] + shift), pa.array(b[got] + shift), low.take(pa.array(got))],
                    names=["anchor", "content", "a", "b", "low"])
        return
    del number, ones
    middle = (lo + hi) // 2
    for x, y in [(lo, hi)] if hi - lo == 1 else [(lo, middle), (middle, hi)]:
        files = [Spill() for _ in range(FAN)]
        for rows in parts():
            if rows.num_rows:
                piece, key = cut_records(rows, units, x, y)
                to = mix(key + U64(depth)) % U64(FAN)
                for k in np.unique(to).tolist():
                    files[k].add(piece.filter(pa.array(to == k)))
        for file in files:
            yield from divided(file, units, shard, limit, x, y, depth + 1)
            file.close()


def repeated_spans(docs: DataFrame, small: DataFrame, units: Units, other_document: bool, shard: Callable,
                   shard_bytes: int) -> DataFrame:
    """(doc_id, tag, spans): windows [a, b] of a ``tagged`` document that a shard function has found.

    ``small`` are the same documents, ``packed``.

    ``other_document``: only an anchor that occurs in two documents is looked at (else two
    places).  ``shard(records)`` gets a list of dicts of arrays (see ``take``) and yields
    (record number, first window, last window, low) with window numbers in the record; the
    span holds for documents of a larger id than ``low``, or for all if that is null.
    """
    records = all_records(docs, units)
    same_anchor = Window.partitionBy("anchor")
    if other_document:
        alive = records.withColumn("_lo", F.min("doc_id").over(same_anchor)).withColumn(
            "_hi", F.max("doc_id").over(same_anchor)).filter("_lo < _hi").drop("_lo", "_hi")
    else:
        alive = records.withColumn("_n", F.count("*").over(same_anchor)).filter("_n > 1").drop("_n")

    distinct = alive.groupBy("anchor", "content").agg(
        F.min(F.struct("doc_id", "tag", "place")).alias("one"), F.max("doc_id").alias("high"), F.count("*").alias("copies"))
    wanted = distinct.select("one.doc_id", "one.tag", "one.place", "anchor", "content", "high", "copies")
    wanted = wanted.groupBy("doc_id", "tag").agg(
        F.collect_list(F.struct("place", "anchor", "content", "high", "copies")).alias("wanted"))

    def take(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in unpacked(batches):
            _, start, end, texts = units.split(raw, off)
            wants = rows.column(3)
            flat, count = wants.flatten(), np.diff(wants.offsets.to_numpy())
            owner = np.repeat(np.arange(rows.num_rows), count)
            place = flat.field("place").to_numpy()
            most = (1 << units.bits) - 1
            at = ((place >> 2 * units.bits) & ((1 << 32) - 1)) + texts[owner]
            before, more = (place >> units.bits) & most, place & most
            lo, hi = start[at - before], end[at - before + more + units.width - 1]
            data = raw.tobytes()
            yield pa.RecordBatch.from_arrays(
                [flat.field("anchor"), flat.field("content"), rows.column(0).take(pa.array(owner)), flat.field("high"),
                 flat.field("copies"), pa.array(before), pa.array(more + 1),
                 pa.array([data[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)], pa.binary())],
                names=["anchor", "content", "low", "high", "copies", "before", "windows", "body"])

    bodies = small.join(wanted, ["doc_id", "tag"]).select("doc_id", "tag", "packed", "wanted").mapInArrow(
        take, "anchor long, content long, low long, high long, copies long, before long, windows long, body binary")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows: pa.Table) -> pa.RecordBatch:
            cols = {c: rows.column(c).to_numpy() for c in ("low", "high", "copies", "before", "windows")}
            body = rows.column("body").combine_chunks()
            number, a, b, low = shard(cols, body)
            pick = pa.array(number)
            return pa.RecordBatch.from_arrays(
                [rows.column("anchor").combine_chunks().take(pick), rows.column("content").combine_chunks().take(pick),
                 pa.array(a), pa.array(b), pa.array(low, pa.int64())], names=["anchor", "content", "a", "b", "low"])

        def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ends = np.cumsum(np.fromiter((len(x) for x in batch.column(7).to_pylist()), np.int64, batch.num_rows))
                i = 0
                while i < batch.num_rows:
                    j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + shard_bytes, side="right")))
                    yield batch.slice(i, j - i)
                    i = j

        def divide(group: Spill) -> Iterator[pa.RecordBatch]:
            yield from divided(group, units, shard, HOT * shard_bytes, 0, units.width - units.gram + 1)
            group.close()

        def shifted(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.zeros(batch.num_rows, np.int64)), batch.column(1)],
                                              names=[*batch.schema.names, "shift", "name"])

        held: list[pa.RecordBatch] = []
        size, hot = 0, None
        for batch in pieces(batches):
            if hot is not None:                                      # an anchor's group that is too large
                same = int(np.searchsorted(batch.column(0).to_numpy(), anchor, side="right"))
                hot.add(shifted(batch.slice(0, same)))
                if same == batch.num_rows:
                    continue
                yield from divide(hot)
                hot, batch = None, batch.slice(same)
            held.append(batch)
            size += batch.column(7).nbytes
            if size < shard_bytes:
                continue
            rows = pa.Table.from_batches(held)
            keys = rows.column("anchor").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))           # the last anchor's group may go on
            if cut:
                yield emit(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
            size = sum(x.column(7).nbytes for x in held)
            if size > HOT * shard_bytes:
                hot, anchor = Spill(), keys[-1]
                for x in held:
                    hot.add(shifted(x))
                held, size = [], 0
        if hot is not None:
            yield from divide(hot)
        if held:
            yield emit(pa.Table.from_batches(held))

    grouped = bodies.repartition("anchor").sortWithinPartitions("anchor", "content")
    found = grouped.mapInArrow(search, "anchor long, content long, a long, b long, low long")
    found = found.select(F.col("anchor").alias("_a"), F.col("content").alias("_c"), "a", "b", "low")
    first = first_window(F.col("place"), units.bits)
    hit = alive.join(found, (F.col("anchor") == F.col("_a")) & (F.col("content") == F.col("_c")))
    hit = hit.filter(F.col("low").isNull() | (F.col("low") < F.col("doc_id")))
    return hit.select("doc_id", "tag", F.struct((first + F.col("a")).alias("a"), (first + F.col("b")).alias("b")).alias("span")
                      ).groupBy("doc_id", "tag").agg(F.collect_list("span").alias("spans"))


def covered(spans, n: int, width: int) -> np.ndarray:
    """Which of a text's ``n`` units lie in the windows of its spans."""
    out = np.zeros(n + 1, np.int64)
    if spans is not None and len(spans):
        np.add.at(out, spans.field("a").to_numpy(), 1)
        np.add.at(out, spans.field("b").to_numpy() + width, -1)
    return np.cumsum(out[:n]) > 0


def original_id(c: Column) -> Column:
    return F.when(c != F.lit(NO_ID), c)
