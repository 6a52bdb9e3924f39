"""Mixture-controlled packing by deficit round-robin over source queues, in closed form.

Each source is a queue of its documents' tokens.  A round credits every queue with
its quantum, a fixed-point number of tokens in proportion to its target; the queue
sends what its credit allows and carries the rest, the deficit, to the next round.
A queue whose quantum is at least a packet sends whole tokens; a smaller one sends
whole packets only, every so many rounds, so that many sources don't cut documents
into single tokens.  Small queues start with staggered deficits, so that they don't
all send in the same rounds.  Windows of ``length`` tokens are cut from the stream that
the rounds make, so every window is full; large sources have their share of each to
within a few tokens, small ones of every few windows to within a packet.

After n rounds queue s has sent ``min(total_s, n * quantum_s + deficit_s)`` tokens, in
whole tokens or packets, whoever computes it: a task that knows where its documents lie
in their queues knows their rounds, windows and offsets.  So deficits are carried across
windows and partitions without any task waiting for another.  Documents are sorted by
how far on in their queues they are, so that a task looks at few rounds.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loam.llm.common import PartEncoder, ranges, text_chunks, word_spans
from loam.session import scratch_path

FRACTION = 16                 # bits of a quantum behind the point
PACKETS = 16                  # packets in a window, at most: what a small queue sends at a time
WORDS_KEPT = 500_000          # word encodings that a worker remembers; a fuller memory is emptied
CELLS = 1 << 18               # (round, queue) pairs that are looked at in one go

_TOKENIZERS: dict[str, tuple] = {}


def _cuts() -> np.ndarray:
    """Byte pairs between which this kind of tokenizer always starts anew: an ASCII letter and an ASCII
    punctuation mark.  Not at apostrophes, which begin suffixes, nor at bars, which special tokens have inside."""
    code = np.arange(256)
    letter = ((code | 32) >= 97) & ((code | 32) <= 122)
    mark = (code > 32) & (code < 127) & ~letter & ~((code >= 48) & (code <= 57)) & (code != 39) & (code != 124)
    return letter[:, None] & mark[None, :] | mark[:, None] & letter[None, :]


class WordEncoder:
    """Token ids of texts, encoding each distinct word once.

    The tokenizer must be one that lower-cases and splits at white space, between letters
    and between other characters: then a text's ids are those of its words and marks, one
    after the other.
    """

    CUTS = _cuts()
    BETWEEN = "<|startoftext|>"        # parts the words that are encoded in one go

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.between = self.tokenizer.token_to_id(self.BETWEEN)
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.ends = None                 # which ids end a word, where the vocabulary says so
        if suffix:
            self.ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
            self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.parts = PartEncoder(self.encode_words, WORDS_KEPT)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian bytes.

        A word of letters has at least one end, as the tokenizer splits between letters and others. So where ids
        tell ends, such words are encoded with blanks between them, and if there are as many ends as words, each
        has one. Other words, and these if the ends don't tally, have a special token between.
        """
        if self.ends is None:
            return self._encode_apart(words)
        out: list[bytes | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if w.isalpha()]
        for k in range(0, len(plain), 1000):
            mine = plain[k:k + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([words[i] for i in mine])], add_special_tokens=False)[0].ids, "<u4")
            at = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if at.size == len(mine) and at[-1] == ids.nbytes:
                data, a = ids.tobytes(), 0
                for i, b in zip(mine, at.tolist(), strict=True):
                    out[i], a = data[a:b], b
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._encode_apart([words[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def _encode_apart(self, words: list[str]) -> list[bytes]:
        if self.between is None or any(self.BETWEEN in w for w in words):
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        out: list[bytes] = []
        for k in range(0, len(words), 1000):
            ids = np.array(self.tokenizer.encode(self.BETWEEN.join(words[k:k + 1000]), add_special_tokens=False).ids, "<u4")
            at = np.flatnonzero(ids == self.between) * 4
            data = ids.tobytes()
            out += [data[a:b] for a, b in zip([0, *(at + 4).tolist()], [*at.tolist(), len(data)], strict=True)]
        return out

    def encode(self, raw: np.ndarray, off: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each followed by ``end_id``; offsets)."""
        if b"<|" not in raw.tobytes():           # special tokens are matched before lower-casing
            raw = np.where((raw >= 65) & (raw <= 90), raw | 32, raw)
        start, end, words = word_spans(raw, off, self.CUTS)
        ids, each = self.parts(raw, start, end)
        sums = np.concatenate([[0], np.cumsum(each)])
        per_text = sums[words[1:]] - sums[words[:-1]] + 1
        out_off = np.concatenate([[0], np.cumsum(per_text)])
        out = np.full(out_off[-1], end_id, "<u4")
        body = np.ones(out.size, bool)
        body[out_off[1:] - 1] = False
        out[body] = ids
        return out, out_off


def word_encoder(path: str) -> WordEncoder:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordEncoder(path)
    return _TOKENIZERS[path]


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, text: str, source: str) -> DataFrame:
    """(doc_id, source, n, ids, part, ahead): the task that made the row, the source's tokens before it there."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, encoder = TaskContext.get().partitionId(), word_encoder(tokenizer)
        sent: dict[str, int] = {}
        for rows, raw, off in text_chunks(batches):
            ids, at = encoder.encode(raw, off, end_id)
            n, ahead = rows.num_rows, []
            for name, size in zip(rows.column(1).to_pylist(), np.diff(at).tolist(), strict=True):
                ahead.append(sent.get(name, 0))
                sent[name] = ahead[-1] + size
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).cast(pa.int64()), rows.column(1).cast(pa.string()), pa.array(np.diff(at)),
                 pa.array([ids[at[i]:at[i + 1]].tobytes() for i in range(n)], pa.binary()),
                 pa.array(np.full(n, part, np.int32)), pa.array(ahead, pa.int64())],
                names=["doc_id", "source", "n", "ids", "part", "ahead"])

    slim = docs.select("doc_id", F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
                       F.col(text).alias("text"))
    return slim.mapInArrow(run, "doc_id long, source string, n long, ids binary, part int, ahead long")


class Plan:
    """Who sends what when: totals, quanta, units and first deficits of the queues, in their order."""

    def __init__(self, totals: list[int], targets: list[float] | None, length: int):
        self.length = length
        self.totals = np.array(totals, np.int64)
        self.total = int(self.totals.sum())
        share = np.array(targets if targets is not None else totals, np.float64)
        share = share / max(share.sum(), 1e-300)
        self.quanta = np.maximum(1, np.round(share * length * (1 << FRACTION))).astype(np.int64)
        # small queues send packets of 2**bits tokens, and start with deficits of different parts of one
        bits = max(1, length // PACKETS).bit_length() - 1
        self.small = self.quanta < 1 << FRACTION + bits
        self.bits = np.where(self.small, bits, 0)
        self.deficit = np.where(self.small, (np.arange(self.quanta.size) * 40503 & (1 << FRACTION) - 1) << bits, 0)
        full = self.total // length * length
        rest, self.edges = self.total - full, [full]
        for bit in reversed(range(rest.bit_length())):        # what is left: windows of powers of two
            if rest >> bit & 1:
                self.edges.append(self.edges[-1] + (1 << bit))

    def sent(self, rounds: np.ndarray, queues: slice = slice(None)) -> np.ndarray:
        """Tokens that each queue has sent before each round."""
        return self._sent(rounds[:, None], self.totals[queues], self.quanta[queues], self.bits[queues], self.deficit[queues])

    @staticmethod
    def _sent(rounds, totals, quanta, bits, deficit) -> np.ndarray:
        last = -(-(((totals >> bits) + 1 << bits + FRACTION) - deficit) // quanta)      # a queue is empty by then
        return np.minimum(totals, np.minimum(rounds, last) * quanta + deficit >> FRACTION + bits << bits)

    def round_of(self, queue: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The round in which each queue sends the token at ``place``."""
        bits = self.bits[queue]
        return -(-(((place >> bits) + 1 << bits + FRACTION) - self.deficit[queue]) // self.quanta[queue]) - 1

    def stream_start(self, rounds: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """Where each queue's tokens of a round begin in the stream.

        Rounds and queues are taken in blocks of ``CELLS`` pairs, so memory depends on neither's number.
        """
        out = np.zeros(rounds.size, np.int64)
        order = np.argsort(rounds, kind="stable")
        sorted_rounds = rounds[order]
        new = np.flatnonzero(np.r_[True, sorted_rounds[1:] != sorted_rounds[:-1]]) if rounds.size else np.zeros(0, np.int64)
        distinct, ends = sorted_rounds[new], np.r_[new[1:], rounds.size]
        wide = min(self.totals.size, CELLS)
        tall = max(1, CELLS // max(wide, 1))
        for k in range(0, distinct.size, tall):
            r = distinct[k:k + tall]
            mine = order[new[k]:ends[k + r.size - 1]]
            row, q = np.repeat(np.arange(r.size), ends[k:k + r.size] - new[k:k + r.size]), queue[mine]
            for c in range(0, self.totals.size, wide):
                before = self.sent(r, slice(c, c + wide))
                step = self.sent(r + 1, slice(c, c + wide)) - before
                ahead = np.concatenate([np.zeros((r.size, 1), np.int64), np.cumsum(step, axis=1)], axis=1)
                out[mine] += before.sum(axis=1)[row] + ahead[row, np.clip(q - c, 0, step.shape[1])]
        return out

    def place(self, queue: np.ndarray, start: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
        """Pieces of texts at ``start`` in their queues: text, start in it, length, window, offset there."""
        first, last = self.round_of(queue, start), self.round_of(queue, start + n - 1)
        # a small queue sends at most a packet a round: only the rounds that send one
        small, bits = self.small[queue], self.bits[queue]
        count = np.where(small, (start + n - 1 >> bits) - (start >> bits) + 1, last - first + 1)
        text = np.repeat(np.arange(queue.size), count)
        q, nth = queue[text], ranges(np.zeros_like(count), count)
        r = np.where(small[text], self.round_of(q, (start >> bits)[text] + nth << bits[text]), first[text] + nth)
        fixed = self.totals[q], self.quanta[q], self.bits[q], self.deficit[q]
        before, after = self._sent(r, *fixed), self._sent(r + 1, *fixed)
        lo = np.maximum(before, start[text])
        hi = np.minimum(after, start[text] + n[text])
        pos = self.stream_start(r, q) + lo - before
        size = hi - lo
        keep = size > 0
        text, pos, size, begin = text[keep], pos[keep], size[keep], (lo - start[text])[keep]
        # neighbours in the text that are neighbours in the stream are one piece
        join = np.zeros(text.size, bool)
        join[1:] = (text[1:] == text[:-1]) & (pos[1:] == pos[:-1] + size[:-1])
        head = np.flatnonzero(~join)
        size = np.add.reduceat(size, head) if head.size else size
        text, pos, begin = text[head], pos[head], begin[head]
        # cut at windows
        k = self._window(pos + size - 1) - self._window(pos) + 1
        owner = np.repeat(np.arange(text.size), k)
        window = ranges(self._window(pos), k)
        a = np.maximum(pos[owner], self._edge(window))
        b = np.minimum((pos + size)[owner], self._edge(window + 1))
        return {"text": text[owner], "start": begin[owner] + a - pos[owner], "length": b - a, "window": window,
                "offset": a - self._edge(window)}

    def _window(self, pos: np.ndarray) -> np.ndarray:
        full = self.total // self.length
        tail = np.searchsorted(np.array(self.edges), pos, side="right") - 1
        return np.where(pos < self.edges[0], pos // self.length, full + tail)

    def _edge(self, window: np.ndarray) -> np.ndarray:
        full, edges = self.total // self.length, np.array(self.edges)
        return np.where(window <= full, window * self.length, edges[np.clip(window - full, 0, edges.size - 1)])


PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
         "source string, ids binary")


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1, targets: dict[str, float] | None = None,
         text: str = "text", source: str = "source", with_ids: bool = True) -> DataFrame:
    """Pieces of all documents, packed into windows of ``length`` tokens.

    ``targets`` gives each source's share (default: its share of all tokens, so that
    all queues run dry together).  Every token is in exactly one piece; only what is
    left at the end goes into shorter windows, of powers of two, so nothing is padded.

    Null texts are empty: a document of the end id alone.  Null sources queue with the
    empty name.  Repeated rows are packed as often as they occur; an empty table gives
    no pieces; other columns are not read.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "packing-tokens")
    tokenize(docs, tokenizer, end_id, text, source).write.option("compression", "zstd").parquet(path)
    rows = spark.read.parquet(path)
    per_part = rows.groupBy("source", "part").agg(F.sum("n").alias("n"))
    queues = sorted((r["source"], r["n"]) for r in per_part.groupBy("source").agg(F.sum("n").alias("n")).collect())
    plan = Plan([n for _, n in queues], [targets[s] for s, _ in queues] if targets is not None else None, length)
    # names stay in a table: tasks hold the plan's numbers only
    names = spark.createDataFrame(pa.table({"source": pa.array([s for s, _ in queues], pa.string()),
                                            "queue": pa.array(np.arange(len(queues))), "quantum": pa.array(plan.quanta)}))

    # where each document starts in its queue: parts before, then rows before in its part
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    base.join(names, "source").write.parquet(f"{path}-base")       # written, so that Spark knows its size and plans the join by it
    placed = rows.join(spark.read.parquet(f"{path}-base"), ["source", "part"]).select(
        "doc_id", "source", "n", "ids", (F.col("base") + F.col("ahead")).alias("queue_start"), "queue", "quantum")
    # tasks of neighbouring rounds: what a task looks at doesn't grow with rounds times queues
    progress = F.col("queue_start") / F.col("quantum")
    ready = placed.repartitionByRange(progress, "queue").sortWithinPartitions(progress, "queue").drop("quantum")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(2).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // 500_000)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if lo < hi:
                    yield pieces(batch.slice(lo, hi - lo))

    def pieces(rows: pa.RecordBatch) -> pa.RecordBatch:
        n = rows.column(2).to_numpy()
        got = plan.place(rows.column(5).to_numpy(), rows.column(4).to_numpy(), n)
        blobs, owner = rows.column(3).to_pylist(), got["text"]
        cut = [blobs[t][4 * a:4 * (a + m)] for t, a, m in zip(owner.tolist(), got["start"].tolist(), got["length"].tolist(), strict=True)]
        take = pa.array(owner)
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(take), pa.array(got["start"]), pa.array(got["length"]),
             pa.array(np.fromiter(map(zlib.crc32, cut), np.int64, len(cut))), pa.array(n[owner]), pa.array(got["window"]),
             pa.array(got["offset"]), rows.column(1).take(take), pa.array(cut if with_ids else [None] * len(cut), pa.binary())],
            names=[c.split()[0] for c in PIECE.split(", ")])

    return ready.mapInArrow(run, PIECE)
