"""WARC archives: writing, and reading with boundary-chain verification.

Archives are gzip-compressed WARC/1.1 files of bounded record counts.  A record with
a payload that another one holds is a *revisit* without a body.

Reading does not trust magic strings.  Each task cuts its files at every ``WARC/1.1``
line and emits, for each such candidate, its offset and the offset where its successor
must start by its own Content-Length.  Candidates inside payloads look just like
records, so the chain decides: pointer jumping from offset 0 of every file keeps those
that are reached, doubling the reach with each join.  Only offsets take part in that;
payloads were digested where they were read, and a payload that itself holds the magic
line is put together from its pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.session import materialize

MAGIC = "WARC/1.1\r\n"
TAIL = "\r\n\r\n"
PER_FILE = 1024
MAX_DIGITS = 18               # of a length; no file is longer, and offsets stay within 64 bits
REVISIT_FROM = 1000           # smaller payloads are always stored


def _header_value(c: Column) -> Column:
    """A value that cannot end its header line."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"[\x00-\x1F\x7F]", "%")


def records(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """One record text per page.  Of equal payloads of ``revisit_from`` bytes or more, the one
    with the largest page_id is stored; null page_ids come last in that order."""
    full = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    full = full.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    same = (full.filter(F.col("size") >= revisit_from).groupBy("digest")
            .agg(F.max("page_id").alias("first_id"), F.count("*").alias("copies"))
            .filter("copies > 1").select(F.col("digest").alias("_d"), "first_id"))
    linked = full.join(same, F.col("digest") == F.col("_d"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    kind = F.when(revisit, "revisit").otherwise("response")
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), kind,
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")),
        F.lit("\r\nWARC-Target-URI: "), _header_value(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                                       "\r\nWARC-Refers-To: "), name(F.col("first_id")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.when(revisit, F.lit(0)).otherwise(F.col("size")).cast("string"), F.lit(TAIL))
    return linked.select(F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("html"))).alias("value"))


def write_archives(pages: DataFrame, path: str, per_file: int = PER_FILE) -> None:
    """Archives under ``path``; each record ends with two line breaks, as the format says."""
    (records(pages).write.option("lineSep", TAIL).option("compression", "gzip")
     .option("maxRecordsPerFile", per_file).text(path))


_CANDIDATE = ("file string, off long, succ long, type string, record_id string, refers_to string, digest string, "
              "size long, sha1 string, piece binary")


def _parse(chunk: bytes) -> tuple[dict[str, str], int] | None:
    """Header fields and where the body starts, if the chunk (without its magic) starts with a header."""
    end = chunk.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in chunk[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not length.isascii() or not length.isdigit() or len(length) > MAX_DIGITS:
        return None
    return fields, end + 4


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every magic line of the archives with its offset and its successor's.

    A candidate whose body ends within its own piece carries the body's digest; pieces
    that an unfinished body before them reaches into are kept whole.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        magic = MAGIC.encode()
        file, off, reach = None, 0, 0
        for rows in batches:
            out = []
            for name, block, text in zip(*(c for c in rows.columns), strict=True):
                name, chunk = name.as_py(), text.as_buffer().to_pybytes()
                if block.as_py():
                    raise ValueError(f"{name} was read in parts; archives are compressed whole files")
                if name != file:
                    file, off, reach = name, 0, 0
                    if chunk:
                        raise ValueError(f"{name} does not start with {MAGIC!r}")
                    continue                      # what lies before the first magic: nothing
                parsed = _parse(chunk)
                size = len(magic) + len(chunk)
                row = [file, off, None, None, None, None, None, None, None, chunk if off < reach else None]
                if parsed:
                    fields, begin = parsed
                    length = int(fields["content-length"])
                    row[2] = off + len(magic) + begin + length + len(TAIL)
                    row[3:8] = [fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-refers-to"),
                                fields.get("warc-payload-digest"), length]
                    if row[2] <= off + size:
                        row[8] = hashlib.sha1(chunk[begin:begin + length]).hexdigest()
                    else:
                        row[9], reach = chunk, max(reach, row[2])
                out.append(row)
                off += size
            cols = list(zip(*out, strict=True)) or [[]] * 10
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
                     pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             names=[c.split()[0] for c in _CANDIDATE.split(", ")])

    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), "value").mapInArrow(run, _CANDIDATE)


def reachable(chain: DataFrame) -> DataFrame:
    """(file, off) of the candidates on the chain from each file's offset 0; ``chain``: (file, off, succ).

    Pointer jumping: a round marks what the marked ones point to and doubles every
    pointer, so a file of n records takes about log2(n) rounds of joins on offsets.
    """
    state = materialize(chain.select("file", "off", F.col("succ").alias("to"), (F.col("off") == 0).alias("on")))
    marked = state.filter("on").count()
    while True:
        ahead = state.select(F.col("file").alias("_f"), F.col("off").alias("_o"), F.col("to").alias("_t"))
        hit = (state.filter(F.col("on") & F.col("to").isNotNull())
               .select(F.col("file").alias("_hf"), F.col("to").alias("_ho")).distinct())
        state = materialize(
            state.join(ahead, (F.col("file") == F.col("_f")) & (F.col("to") == F.col("_o")), "left")
            .join(hit, (F.col("file") == F.col("_hf")) & (F.col("off") == F.col("_ho")), "left")
            .select("file", "off", F.col("_t").alias("to"), (F.col("on") | F.col("_ho").isNotNull()).alias("on")))
        now = state.filter("on").count()
        if now == marked:
            return state.filter("on").select("file", "off")
        marked = now


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Verified records: page_id, record_type, refers_to, payload_bytes, payload_digest.

    A revisit's payload is that of the response that it refers to and whose digest it names:
    a page_id may have several responses.  A revisit whose response is not in the archives
    has the digest that it names and no size.  Archives without records give no rows;
    repeated records come out as often as they were written.
    """
    found = materialize(candidates(spark, path))
    real = reachable(found)
    kept = found.join(real, ["file", "off"])

    # bodies that hold the magic line: the pieces up to the successor, in order
    open_ = kept.filter(F.col("sha1").isNull()).select(
        "file", F.col("off").alias("at"), "succ", F.col("size").alias("length"))
    pieces = found.filter(F.col("piece").isNotNull()).select("file", "off", "piece")
    met = pieces.join(open_, "file").filter((F.col("off") >= F.col("at")) & (F.col("off") < F.col("succ")))

    def body_digest(key, rows):
        import pandas as pd
        rows = rows.sort_values("off")
        chunk = MAGIC.encode().join(bytes(p) for p in rows["piece"])
        begin, length = _parse(chunk)[1], int(rows["length"].iloc[0])
        if len(chunk) < begin + length:
            raise ValueError(f"record at {key} is cut off")
        return pd.DataFrame({"file": [key[0]], "off": [key[1]], "joined_sha1": [hashlib.sha1(chunk[begin:begin + length]).hexdigest()]})

    joined = met.groupBy("file", "at").applyInPandas(body_digest, "file string, off long, joined_sha1 string")
    ident = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    rec = kept.join(joined, ["file", "off"], "left").select(
        ident("record_id").alias("page_id"), F.col("type").alias("record_type"), ident("refers_to").alias("refers_to"),
        F.col("size").alias("stored"), F.coalesce("sha1", "joined_sha1").alias("sha1"),
        F.regexp_extract("digest", "^sha1:(.*)$", 1).alias("named"))
    stored = rec.filter("record_type = 'response'").groupBy(F.col("page_id").alias("_p"), F.col("sha1").alias("_s")).agg(
        F.max("stored").alias("full"))
    revisits = rec.filter("record_type = 'revisit'").join(
        stored, (F.col("refers_to") == F.col("_p")) & (F.col("named") == F.col("_s")), "left")
    return rec.filter("record_type = 'response'").select(
        "page_id", F.col("stored").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "record_type",
        "refers_to").union(revisits.select("page_id", "full", "named", "record_type", "refers_to"))
