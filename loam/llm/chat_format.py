"""Chat formatting with typed content parts.

A message's content is a list of parts: text, image, audio, document.  A visitor
flattens the parts in their order: text is escaped, every other part becomes a
placeholder token, and its reference and expanded token count are recorded as an
attachment.  Turns are marked by control strings; since escaping doubles the bar of
every ``<|`` inside texts and roles, no text can forge one, and undoing it is exact.

Turns are formatted one by one, so a conversation of any length is spread over
tasks; reading a conversation back streams its turns in order and keeps only
running digests.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
# Tokens that a placeholder stands for, by unit: 16 x 16 pixel patches, seconds, pages.
TOKENS_PER_UNIT = {"image": 1, "audio": 25, "document": 1024}
PART = "struct<kind:string,text:string,ref:string,units:int>"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def text_part(text: Column) -> Column:
    """Content of one text part."""
    nothing = F.lit(None).cast("string")
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            nothing.alias("ref"), F.lit(None).cast("int").alias("units")))


def flatten_parts(content: Column) -> tuple[Column, Column]:
    """(flat text, attachments): the visitor's two results for an array of parts.

    Neighbouring texts are joined before escaping, so a ``<`` ending one and a ``|``
    starting the next cannot make a mark between them.  Unknown kinds are refused.
    A null part, or a null text in one, is empty; null units count as one.
    """
    parts = F.filter(F.coalesce(content, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())

    def placeholder(p: Column) -> Column:
        mark = F.lit(None).cast("string")
        for kind, token in PLACEHOLDER.items():
            mark = F.when(p["kind"] == kind, F.lit(token)).otherwise(mark)
        return F.when(mark.isNotNull(), mark).otherwise(
            F.raise_error(F.concat(F.lit("unknown content part: "), F.coalesce(p["kind"], F.lit("null")))).cast("string"))

    state = F.struct(F.lit("").alias("done"), F.lit("").alias("open"))
    flat = F.aggregate(
        parts, state,
        lambda acc, p: F.when(
            p["kind"] == "text",
            F.struct(acc["done"].alias("done"), F.concat(acc["open"], F.coalesce(p["text"], F.lit(""))).alias("open")))
        .otherwise(F.struct(F.concat(acc["done"], escape(acc["open"]), placeholder(p)).alias("done"), F.lit("").alias("open"))),
        lambda acc: F.concat(acc["done"], escape(acc["open"])))
    rate = F.lit(None).cast("int")
    other = F.filter(parts, lambda p: p["kind"] != "text")

    def tokens(p: Column) -> Column:
        out = rate
        for kind, each in TOKENS_PER_UNIT.items():
            out = F.when(p["kind"] == kind, F.lit(each) * F.coalesce(p["units"], F.lit(1))).otherwise(out)
        return out

    attachments = F.transform(other, lambda p, i: F.struct(
        i.alias("ordinal"), p["kind"].alias("kind"), p["ref"].alias("ref"), tokens(p).alias("tokens")))
    return flat, attachments


def format_turns(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, role, content) with ``formatted``, ``body_start``, ``body_chars``,
    ``in_loss`` and ``attachments`` added.

    A turn's body is under the loss mask if the role is assistant: the code points
    [body_start, body_start + body_chars) of ``formatted``.  A null role is empty, a
    line feed in a role is written as the control string ``<|nl|>``.
    """
    flat, attachments = flatten_parts(F.col("content"))
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("<|nl|>"))
    out = messages.withColumn("_cf_body", flat).withColumn("_cf_head", F.concat(F.lit(START), role, F.lit("\n")))
    return out.select(
        *[c for c in messages.columns if c not in ("formatted", "body_start", "body_chars", "in_loss", "attachments")],
        F.concat("_cf_head", "_cf_body", F.lit(END + "\n")).alias("formatted"),
        F.length("_cf_head").cast("long").alias("body_start"), F.length("_cf_body").cast("long").alias("body_chars"),
        F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("in_loss"), attachments.alias("attachments"))


_TURN = re.compile(r"<\|im_start\|>(.*?)\n(.*?)<\|im_end\|>\n", re.DOTALL)


def parse_turns(formatted: str) -> list[tuple[str, str, int]]:
    """(role, text, place of the body) of every turn, unescaped; placeholders stay as they are.

    The whole string must be turns: anything else is an error.
    """
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError("not a formatted conversation")
        out.append((m[1].replace("<|nl|>", "\n").replace("<||", "<|"), m[2].replace("<||", "<|"), m.start(2)))
        at = m.end()
    return out


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation: its turns, digests and masked text, read from ``formatted``.

    Turns stream in the order (turn, role, formatted), so ties and repeated rows have
    one order; a null conv_id is a conversation of its own.
    """
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, attachment_tokens long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        now, state = none, None
        done: list[tuple] = []

        def close() -> None:
            if now is not none:
                done.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = [c.split()[0] for c in schema.split(", ")]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

        for rows in batches:
            for conv, formatted, start, size, masked, tokens in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if now is none or conv != now:
                    close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text, _ in parse_turns(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if masked:
                    under = formatted[start:start + size].replace("<||", "<|")
                    state[2] += len(under)
                    state[3].update(under.encode())
                state[4] += len(formatted)
                state[5] += tokens
            if done:
                yield flush()
        close()
        yield flush()

    tokens = F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["tokens"], F.lit(0)))
    slim = turns.select("conv_id", "turn", "role", "formatted", "body_start", "body_chars", "in_loss",
                        tokens.alias("tokens"))
    ordered = slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return ordered.select("conv_id", "formatted", "body_start", "body_chars", "in_loss", "tokens").mapInArrow(run, schema)
