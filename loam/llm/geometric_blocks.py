"""Exact ranked lexical search over posting lists in blocks of similar documents.

Documents are reduced once to their counts of the queries' terms and written as
Parquet.  A task reads them shard by shard.  In a shard each posting list that a
query cannot do without is clustered by document similarity and cut into blocks,
and a block keeps the largest weight of every term among its documents: the
product of a query with that summary bounds the score of every document in it.
A block is passed over only if its bound is below the query's threshold, a score
that at least ``k`` documents of the corpus are known to reach; documents of the
other blocks are scored exactly.

Thresholds come from a pass before: the documents that hold a query's rarest
terms are scored, and the k-th best of them bounds the result from below.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.common import BYTE_VALUE, SpanHash, ranges, text_buffer, text_chunks, word_spans
from loam.session import materialize, scratch_path

TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_PAIRS = 1 << 18       # (item, term) pairs searched in one run over the documents; more items make more runs
SHARD_POSTINGS = 400_000    # postings of a shard, or one document's
BLOCK_DOCS = 16             # documents of a block of a posting list
SKETCH = 24                 # dimensions of the projection that documents are clustered by
SEED_DOCS = 64              # documents that a query's rarest terms must have, together, before they set its threshold
EXPANDED = 2_000_000        # summary entries worked on at once

_APART = np.ones(256, bool)
_APART[np.r_[0x30:0x3A, 0x41:0x5B, 0x61:0x7B, 0x80:0x100]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _terms(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all terms in order, and the texts' offsets into them."""
    low = _LOWER[raw]
    start, end, bounds = word_spans(low, off, space=_APART)
    return SpanHash(BYTE_VALUE[low])(start, end), bounds


class Queries:
    """A run's items: their terms as places in a vocabulary of sorted hashes."""

    def __init__(self, items: list, texts_terms: list[np.ndarray]):
        self.items = items
        self.hashes = np.unique(np.concatenate([*texts_terms, np.zeros(0, np.uint64)]))
        self.terms = [np.searchsorted(self.hashes, np.unique(h)) for h in texts_terms]

    def weigh(self, n_docs: int, n_terms: int, df: np.ndarray) -> Queries:
        """Fixes the corpus counts; a term of no document weighs nothing."""
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()], np.int64)
        self.seeds = []
        for terms in self.terms:
            held = terms[df[terms] > 0]
            held = held[np.argsort(df[held], kind="stable")]
            enough = int(np.searchsorted(np.cumsum(df[held]), SEED_DOCS)) + 1
            self.seeds.append(held[:enough])
        return self


def _counted(batches: Iterable[pa.RecordBatch], hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, n, ids, tf) of the texts that have terms."""
    size = max(1, hashes.size)
    for rows, raw, off in text_chunks(batches):
        found, bounds = _terms(raw, off)
        n = np.diff(bounds)
        at = np.minimum(np.searchsorted(hashes, found), size - 1)
        held = hashes[at] == found if hashes.size else np.zeros(found.size, bool)
        doc = np.repeat(np.arange(n.size), n)
        key, tf = np.unique(doc[held] * size + at[held], return_counts=True)
        place = np.searchsorted(key // size, np.arange(n.size + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(place), pa.array(v.astype(np.int32))) for v in (key % size, tf)]
        out = pa.RecordBatch.from_arrays([rows.column(0), pa.array(n.astype(np.int64)), *lists], ["doc_id", "n", "ids", "tf"])
        yield out.filter(pa.array(n > 0))


class Shard:
    """Some documents by rows (terms with weights) and by lists (postings of a term)."""

    def __init__(self, doc_ids: np.ndarray, no_id: np.ndarray, n: np.ndarray, ptr: np.ndarray, ids: np.ndarray, tf: np.ndarray, queries: Queries):
        self.doc_ids, self.no_id, self.ptr, self.ids, self.queries = doc_ids, no_id, ptr, ids, queries
        m = 10 + 90 * n * queries.n_docs // queries.n_terms
        self.weight = queries.weights[ids] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(ptr))))
        order = np.argsort(ids, kind="stable")
        self.posted = np.repeat(np.arange(n.size), np.diff(ptr))[order]
        self.list_at = np.searchsorted(ids[order], np.arange(queries.hashes.size + 1))
        self.top = np.zeros(queries.hashes.size, np.int64)
        full = np.flatnonzero(np.diff(self.list_at))
        if full.size:
            self.top[full] = np.maximum.reduceat(self.weight[order], self.list_at[full])
        self.asked = np.zeros(queries.hashes.size, bool)

    def best(self, terms: np.ndarray, docs: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best of ``docs`` with scores of ``least`` or more, and their scores, by all of the query's terms."""
        if docs.size == 0:
            return docs, np.zeros(0, np.int64)
        size = self.ptr[docs + 1] - self.ptr[docs]
        at = ranges(self.ptr[docs], size)
        self.asked[terms] = True
        value = np.where(self.asked[self.ids[at]], self.weight[at], 0)
        self.asked[terms] = False
        score = np.add.reduceat(value, np.cumsum(size) - size)
        keep = score >= least
        docs, score = docs[keep], score[keep]
        first = np.lexsort((self.doc_ids[docs], self.no_id[docs], -score))[:k]
        return docs[first], score[first]

    def holding(self, terms: np.ndarray) -> np.ndarray:
        return np.unique(self.posted[ranges(self.list_at[terms], self.list_at[terms + 1] - self.list_at[terms])])

    def needed(self, terms: np.ndarray, least: int) -> np.ndarray:
        """Terms of which a document must hold one to reach ``least``: the others' largest weights add up to less."""
        held = terms[self.top[terms] > 0]
        held = held[np.argsort(self.top[held], kind="stable")]
        return held[np.cumsum(self.top[held]) >= least]

    def cluster(self, lists: np.ndarray) -> None:
        """Cuts the posting lists of ``lists`` into blocks of similar documents and summarises these."""
        # a fixed random projection; the clustering decides how much is skipped, never what is found
        signs = np.random.default_rng(1).choice(np.float32([-1, 1]), (self.queries.hashes.size, SKETCH))
        size = np.diff(self.ptr)
        sketch = np.add.reduceat(signs[self.ids] * self.weight[:, None].astype(np.float32), self.ptr[:-1], axis=0)
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        members, starts, at = [], [], 0
        self.block_at = np.zeros((self.queries.hashes.size, 2), np.int64)
        blocks = 0
        for t in lists.tolist():
            docs = self.posted[self.list_at[t]:self.list_at[t + 1]]
            first = np.zeros(1, np.int64)
            if docs.size > BLOCK_DOCS:
                centres = docs[np.linspace(0, docs.size - 1, -(-docs.size // BLOCK_DOCS)).astype(np.int64)]
                near = np.concatenate([np.argmax(sketch[docs[i:i + 4096]] @ sketch[centres].T, axis=1) for i in range(0, docs.size, 4096)])
                order = np.argsort(near, kind="stable")
                docs, near = docs[order], near[order]
                opens = np.flatnonzero(np.r_[True, near[1:] != near[:-1]])
                within = np.arange(docs.size) - np.repeat(opens, np.diff(np.r_[opens, docs.size]))
                first = np.flatnonzero(within % BLOCK_DOCS == 0)
            members.append(docs)
            starts.append(first + at)
            self.block_at[t] = blocks, blocks + first.size
            blocks, at = blocks + first.size, at + docs.size
        self.members = np.concatenate([*members, np.zeros(0, np.int64)])
        self.member_at = np.concatenate([*starts, [at]])
        # largest weight of every term in every block, some blocks at a time
        entries = np.r_[0, np.cumsum(size[self.members])][self.member_at]
        terms, most, counts, v, i = [], [], [], self.queries.hashes.size, 0
        while i < blocks:
            j = min(blocks, max(i + 1, int(np.searchsorted(entries, entries[i] + EXPANDED, side="right")) - 1))
            docs = self.members[self.member_at[i]:self.member_at[j]]
            at = ranges(self.ptr[docs], size[docs])
            key = np.repeat(np.arange(j - i), np.diff(entries[i:j + 1])) * v + self.ids[at]
            order = np.argsort(key, kind="stable")
            key = key[order]
            opens = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            terms.append((key[opens] % v).astype(np.int32))
            most.append(np.maximum.reduceat(self.weight[at][order], opens))
            counts.append(np.bincount(key[opens] // v, minlength=j - i))
            i = j
        self.summary_terms = np.concatenate([*terms, np.zeros(0, np.int32)])
        self.summary_most = np.concatenate([*most, np.zeros(0, np.int64)])
        self.summary_at = np.r_[0, np.cumsum(np.concatenate([*counts, np.zeros(0, np.int64)]))].astype(np.int64)

    def unskipped(self, terms: np.ndarray, needed: np.ndarray, least: int) -> np.ndarray:
        """Documents of those blocks in the needed lists whose bounds reach ``least``."""
        lists = self.block_at[needed]
        blocks = ranges(lists[:, 0], lists[:, 1] - lists[:, 0])
        if blocks.size == 0:
            return blocks
        size = self.summary_at[blocks + 1] - self.summary_at[blocks]
        at = ranges(self.summary_at[blocks], size)
        self.asked[terms] = True
        value = np.where(self.asked[self.summary_terms[at]], self.summary_most[at], 0)
        self.asked[terms] = False
        blocks = blocks[np.add.reduceat(value, np.cumsum(size) - size) >= least]
        return np.unique(self.members[ranges(self.member_at[blocks], self.member_at[blocks + 1] - self.member_at[blocks])])


def _shards(batches: Iterable[pa.RecordBatch], queries: Queries) -> Iterator[Shard]:
    held: list[pa.RecordBatch] = []
    postings = 0

    def made() -> Shard:
        rows = pa.Table.from_batches(held).combine_chunks()
        ids, tf = (rows.column(c).combine_chunks() for c in ("ids", "tf"))
        size = np.diff(ids.offsets.to_numpy())
        full = size > 0
        doc = rows.column("doc_id").combine_chunks()
        return Shard(doc.fill_null(0).to_numpy()[full], doc.is_null().to_numpy(zero_copy_only=False)[full], rows.column("n").to_numpy()[full],
                     np.r_[0, np.cumsum(size[full])].astype(np.int64), ids.flatten().to_numpy().astype(np.int64),
                     tf.flatten().to_numpy().astype(np.int64), queries)

    for batch in batches:
        at, i = batch.column(2).offsets.to_numpy(), 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + SHARD_POSTINGS - postings, side="right")) - 1)
            j = min(j, batch.num_rows)
            held.append(batch.slice(i, j - i))
            postings += int(at[j] - at[i])
            i = j
            if postings >= SHARD_POSTINGS or i < batch.num_rows:
                yield made()
                held, postings = [], 0
    if postings:
        yield made()


def _rows(shard: Shard, item: int, docs: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    ids = pa.array(shard.doc_ids[docs], mask=shard.no_id[docs])
    return pa.RecordBatch.from_arrays([pa.array(np.full(docs.size, item, np.int32)), ids, pa.array(score)], ["item", "doc_id", "score"])


_FOUND = "item int, doc_id long, score long"


def _seeded(batches: Iterable[pa.RecordBatch], queries: Queries, k: int) -> Iterator[pa.RecordBatch]:
    """Each shard's best documents among those with a query's rarest terms."""
    for shard in _shards(batches, queries):
        for q, terms in enumerate(queries.terms):
            docs, score = shard.best(terms, shard.holding(queries.seeds[q]), 1, k)
            if docs.size:
                yield _rows(shard, q, docs, score)


def _searched(batches: Iterable[pa.RecordBatch], queries: Queries, least: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    """Each shard's best documents for every query, those at the threshold included."""
    for shard in _shards(batches, queries):
        needed = [shard.needed(terms, int(least[q])) for q, terms in enumerate(queries.terms)]
        shard.cluster(np.unique(np.concatenate([*needed, np.zeros(0, np.int64)])))
        for q, terms in enumerate(queries.terms):
            docs, score = shard.best(terms, shard.unskipped(terms, needed[q], int(least[q])), int(least[q]), k)
            if docs.size:
                yield _rows(shard, q, docs, score)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_run(docs: DataFrame, queries: Queries, k: int) -> DataFrame:
    """(item, rank, doc_id, score) for the items of one run."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lexical")
    hashes = queries.hashes
    docs.mapInArrow(lambda rows: _counted(rows, hashes), "doc_id long, n long, ids array<int>, tf array<int>").write.parquet(path)
    index = spark.read.parquet(path)
    total = index.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(hashes.size, np.int64)
    for row in index.select(F.explode("ids").alias("id")).groupBy("id").count().collect():      # at most a row a term of the run
        df[row["id"]] = row["count"]
    queries.weigh(total["n"], max(1, total["terms"]), df)
    # one number an item: the k-th best seed, if there are so many
    seeds = _best(index.mapInArrow(lambda rows: _seeded(rows, queries, k), _FOUND), k)
    least = np.ones(len(queries.items), np.int64)
    for row in seeds.filter(F.col("rank") == k).select("item", "score").collect():
        least[row["item"]] = row["score"]
    return _best(index.mapInArrow(lambda rows: _searched(rows, queries, least, k), _FOUND), k)


def _runs(items: DataFrame) -> Iterator[Queries]:
    """The items in runs of about BLOCK_PAIRS pairs; an item's rows are one set of terms."""
    def paired(batches):
        for rows, raw, off in text_chunks(batches):
            found, bounds = _terms(raw, off)
            item = np.repeat(np.arange(rows.num_rows), np.diff(bounds))
            yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(item)), pa.array(found.view(np.int64))], ["item_id", "hash"])

    kind = items.schema["item_id"].dataType.simpleString()
    pairs = materialize(items.select("item_id", "text").mapInArrow(paired, f"item_id {kind}, hash long").distinct())
    runs = max(1, -(-pairs.count() // BLOCK_PAIRS))
    for r in range(runs):
        own = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(runs)) == r)
        terms: dict = {}
        for row in own.orderBy("item_id", "hash").collect():
            terms.setdefault(row["item_id"], []).append(row["hash"])
        if terms:
            yield Queries(list(terms), [np.array(h, np.int64).view(np.uint64) for h in terms.values()])


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best rows of ``docs`` (doc_id, text) with scores above 0.

    Other columns are ignored.  Rows of one item_id are one item with the terms of all of them, a null
    item_id is an item like others; items without terms, and null or empty texts, have no results.
    Repeated rows of ``docs`` are documents of their own; of equal scores the smaller doc_id comes first,
    rows without one last.  Terms are told apart by 64 bits of hash.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for queries in _runs(items):
        named = spark.createDataFrame(list(enumerate(queries.items)), f"item int, item_id {kind}")
        found = _search_run(docs, queries, k).join(F.broadcast(named), "item")      # a run's items: at most BLOCK_PAIRS
        out = out.unionByName(found.select("item_id", "rank", "doc_id", "score"))
    return out
