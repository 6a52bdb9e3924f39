"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three machines are compiled from a model file and composed with each input:

* the *normaliser*: the dummy prefix, and the space rewritten as its mark;
* the *pieces*: a trie whose accepting states put out a piece, at the piece's cost;
* the *byte fallback*: a character that no piece has goes to its UTF-8 bytes' pieces.

The best path is the shortest one in the tropical semiring (costs add along a path, the
least one wins).  For a unigram model a piece costs minus its score.  A BPE model has no
such costs: its pieces are composed with an acceptor that allows a piece after another only
if merging the two of them by themselves leaves them as they are, and all allowed steps cost
nothing.  A sequence of pieces is what the merges make of a text exactly if all its
neighbours are allowed, so the path of finite cost is the encoding.

No piece has a mark after another character, so paths never cross the start of a word;
each distinct word is composed once and its path kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.common import PartEncoder, text_chunks

MARK = "▁"
UNIGRAM, BPE = 1, 2
UNKNOWN_COST = 10.0             # above the dearest piece, for a character without one
PAIRS_KEPT = 500_000


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Fields of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            size = number() if size is None else size
            yield key >> 3, data[at:at + size]
            at += size


class Model:
    """Pieces and settings of a model file."""

    NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.algorithm, self.prefix, self.escape = UNIGRAM, True, True
        rule = b"identity"
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]))
                self.kinds.append(piece.get(3, self.NORMAL))
            elif field == 2:
                self.algorithm = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                spec = dict(_fields(value))
                rule = spec.get(1, b"identity")
                self.prefix, self.escape = bool(spec.get(3, 1)), bool(spec.get(5, 1))
                if spec.get(4, 1):
                    raise ValueError("models that remove extra white space are not supported")
        if rule != b"identity":
            raise ValueError(f"normaliser {rule.decode()} is not supported")
        if self.algorithm not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")


class Transducer:
    def __init__(self, path: str):
        self.model = model = Model(path)
        self.ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True))
                    if k in (Model.NORMAL, Model.USER)}
        self.bytes = [0] * 256
        for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)):
            if k == Model.BYTE:
                self.bytes[int(p[3:5], 16)] = i
        self.unknown = next((i for i, k in enumerate(model.kinds) if k == Model.UNKNOWN), 0)
        self.fallback = Model.BYTE in model.kinds
        self.arcs: list[dict[str, int]] = [{}]       # trie states
        self.accepts: list[int] = [-1]
        for piece, i in self.ids.items():
            state = 0
            for c in piece:
                nxt = self.arcs[state].get(c)
                if nxt is None:
                    nxt = self.arcs[state][c] = len(self.arcs)
                    self.arcs.append({})
                    self.accepts.append(-1)
                state = nxt
            self.accepts[state] = i
        self.unknown_cost = UNKNOWN_COST - min((model.scores[i] for i in self.ids.values()), default=0.0)
        self._pairs: dict[int, bool] = {}
        # what each id decodes to
        self.output = [b"" if k in (Model.CONTROL, Model.UNKNOWN) else bytes([int(p[3:5], 16)]) if k == Model.BYTE
                       else p.replace(MARK, " ").encode() for p, k in zip(model.pieces, model.kinds, strict=True)]
        if self.unknown < len(self.output) and not self.fallback:
            self.output[self.unknown] = " ⁇ ".encode()
        # bytes between which no piece goes on: two ASCII characters that are neighbours in none
        self.cuts = np.zeros((256, 256), bool)
        self.cuts[:128, :128] = True
        for piece in self.ids:
            plain = piece.replace(MARK, " ") if model.escape else piece
            for a, b in zip(plain, plain[1:], strict=False):
                if a < "\x80" and b < "\x80":
                    self.cuts[ord(a), ord(b)] = False
        path = self.bpe_path if model.algorithm == BPE else self.shortest_path
        self.encoder = PartEncoder(lambda parts: [np.array(path(p), "<u4").tobytes() for p in parts])

    def merged(self, symbols: list[str]) -> list[str]:
        """What the merges make of symbols: the best-scored neighbours first, the first of equals."""
        symbols = list(symbols)
        while True:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                i = self.ids.get(symbols[k] + symbols[k + 1])
                if i is not None and (best is None or self.model.scores[i] > best):
                    best, at = self.model.scores[i], k
            if at < 0:
                return symbols
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]

    def allowed(self, left: int, right: int) -> bool:
        """Whether piece ``right`` may follow piece ``left`` (-1: a start) in a BPE path."""
        key = left << 20 | right
        known = self._pairs.get(key)
        if known is None:
            want = [self.model.pieces[i] for i in (left, right) if i >= 0]
            known = self.merged(list("".join(want))) == want
            if len(self._pairs) >= PAIRS_KEPT:
                self._pairs.clear()
            self._pairs[key] = known
        return known

    def shortest_path(self, part: str) -> list[int]:
        """Ids of the least-cost path through input o normaliser o (pieces | bytes) [o neighbours]."""
        text = part.replace(" ", MARK) if self.model.escape else part
        n, bpe, scores = len(text), self.model.algorithm == BPE, self.model.scores
        arcs, accepts = self.arcs, self.accepts
        # best[i]: state -> (cost, place before, state before, piece); a BPE state is the last piece
        best: list[dict[int, tuple[float, int, int, int]]] = [{} for _ in range(n + 1)]
        best[0][-1] = (0.0, -1, -1, -1)
        for i in range(n):
            here = best[i]
            if not here:
                continue
            state, j, single = 0, i, False
            while j < n:
                state = arcs[state].get(text[j], -1)
                if state < 0:
                    break
                j += 1
                piece = accepts[state]
                if piece < 0:
                    continue
                single |= j == i + 1
                step, to = (0.0, piece) if bpe else (-scores[piece], -1)
                for last, way in here.items():
                    if bpe and not self.allowed(last, piece):
                        continue
                    old = best[j].get(to)
                    if old is None or way[0] + step < old[0]:
                        best[j][to] = (way[0] + step, i, last, piece)
            if not single:                       # no piece for this character: its bytes
                cost, last = min((way[0], k) for k, way in here.items())
                old = best[i + 1].get(-1)
                if old is None or cost + self.unknown_cost < old[0]:
                    best[i + 1][-1] = (cost + self.unknown_cost, i, last, -1)
        out: list[int] = []
        at = n
        state = min((way[0], k) for k, way in best[n].items())[1]
        while at:
            _, before, previous, piece = best[at][state]
            if piece < 0:
                data = text[before:at].encode()
                out += [self.bytes[b] for b in reversed(data)] if self.fallback else [self.unknown]
            else:
                out.append(piece)
            at, state = before, previous
        return out[::-1]

    def bpe_path(self, part: str) -> list[int]:
        """:meth:`shortest_path` of a BPE model.  One path of finite cost reaches each place, as one
        sequence of pieces is what the merges make of the text before it, so a place holds one state."""
        text = part.replace(" ", MARK) if self.model.escape else part
        n = len(text)
        arcs, accepts, pairs, unseen = self.arcs, self.accepts, self._pairs, self.allowed
        last, before = [None] * (n + 1), [0] * (n + 1)
        last[0] = -1
        for i in range(n):
            left = last[i]
            if left is None:
                continue
            state, j, single = 0, i, False
            while j < n:
                state = arcs[state].get(text[j])
                if state is None:
                    break
                j += 1
                piece = accepts[state]
                if piece >= 0:
                    single |= j == i + 1
                    if last[j] is None:
                        known = pairs.get(left << 20 | piece)
                        if unseen(left, piece) if known is None else known:
                            last[j], before[j] = piece, i
            if not single and last[i + 1] is None:       # no piece for this character: its bytes
                last[i + 1], before[i + 1] = -1, i
        out: list[int] = []
        while n:
            if last[n] < 0:
                data = text[before[n]:n].encode()
                out += [self.bytes[b] for b in reversed(data)] if self.fallback else [self.unknown]
            else:
                out.append(last[n])
            n = before[n]
        return out[::-1]

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts; offsets)."""
        n = np.diff(off)
        if self.model.prefix:                    # the dummy prefix of every text that has a character
            raw = np.insert(raw, off[:-1][n > 0], 32)
            off = off + np.concatenate([[0], np.cumsum(n > 0)])
        size = raw.size
        new = np.zeros(size + 1, bool)
        new[off] = True
        # a character follows the mark in pieces only at their start, so marks that are in the text cut nothing
        new[1:size] |= self.cuts.ravel()[raw[:-1].astype(np.int32) << 8 | raw[1:]]
        space = raw == 32
        mark = np.zeros(size + 1, bool)
        if size > 2:
            mark[3:] = (raw[:-2] == 0xE2) & (raw[1:-1] == 0x96) & (raw[2:] == 0x81)
        new[1:size] |= space[1:] & (raw[:-1] >= 128) & ~mark[1:size]
        start = np.flatnonzero(new[:size])
        end = np.r_[start[1:], size] if start.size else start
        texts = np.searchsorted(start, off)
        ids, each = self.encoder(raw, start, end)
        return ids, np.concatenate([[0], np.cumsum(each)])[texts]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: bytes are joined before they are read as UTF-8; the dummy prefix goes."""
        text = b"".join(map(self.output.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


_LOADED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _LOADED:
        _LOADED[path] = Transducer(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, model: str, text: str = "text", verify: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_ids, n_byte_ids, ids, ids_sha256, decoded_sha256) for every row.

    ``ids`` are little-endian unsigned 32-bit; ``decoded_sha256`` is of the text that they
    decode to (null without ``verify``).  Null and empty texts have no ids.  Rows are coded
    one by one, so repeated rows give equal results, an empty table an empty one; other
    columns are not read.
    """
    schema = ("doc_id long, n_bytes long, n_ids long, n_byte_ids long, ids binary, ids_sha256 string, "
              "decoded_sha256 string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = transducer(model)
        is_byte = np.array([k == Model.BYTE for k in coder.model.kinds], bool)
        for rows, raw, off in text_chunks(batches):
            ids, at = coder.encode(raw, off)
            blobs = [ids[at[i]:at[i + 1]].tobytes() for i in range(rows.num_rows)]
            fallback = np.concatenate([[0], np.cumsum(is_byte[ids])])
            back = [hashlib.sha256(coder.decode(ids[at[i]:at[i + 1]].tolist()).encode()).hexdigest() if verify else None
                    for i in range(rows.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).cast(pa.int64()), pa.array(np.diff(off)), pa.array(np.diff(at)),
                 pa.array(fallback[at[1:]] - fallback[at[:-1]]), pa.array(blobs, pa.binary()),
                 pa.array([hashlib.sha256(b).hexdigest() for b in blobs]), pa.array(back, pa.string())],
                names=[c.split()[0] for c in schema.split(", ")])

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, schema)
