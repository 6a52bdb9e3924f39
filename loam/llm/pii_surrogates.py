"""Surrogates for personal data: keyed, type-consistent, distinct, and the same wherever an entity occurs.

Detection finds entities by type and reduces each mention to a canonical value (an
e-mail address in lower case, a number's digits, a name without its title), so that
mentions in different formats corefer.  A surrogate of the canonical value is drawn from
a keyed hash: letters stay letters of their case and script, digits digits; check digits
are computed anew, octets stay octets, names keep their gender and script.

Distinctness is checked over the whole corpus, on what a text shows (names without the
gender they were found with): surrogates that two entities share, or that are some
entity's own value, are drawn again, in rounds of joins, until none is left.  Shapes grow
by a character every few rounds, so a small space of short values is no end.  A person
whose mentions tell no gender is the one of that name whose mentions do, if all agree.
Mentions are then rewritten in their own format.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loam.session import materialize

# Given names by gender and script.
NAMES = {
    ("f", "latin"): "Alice Anna Clara Diana Elena Emma Eva Flora Greta Helena Ida Irene Iris Jana Julia Klara Laura Lea "
                    "Lina Lucia Maria Marta Mila Mona Nadia Nina Nora Olga Paula Petra Rita Rosa Sara Silvia Sofia Thea",
    ("m", "latin"): "Adam Albert Anton Arno Bruno Carl Daniel David Emil Erik Felix Frank Georg Hugo Ivan Jakob Jan Jonas "
                    "Karl Leo Lukas Marco Martin Max Milan Nico Oskar Otto Pablo Paul Peter Robert Simon Thomas Victor",
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Зоя Ирина Лидия Мария Нина Ольга Софья Тамара Юлия",
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Дмитрий Егор Иван Кирилл Лев Максим Олег Павел Роман Фёдор",
    ("f", "greek"): "Άννα Δήμητρα Ειρήνη Ελένη Ζωή Μαρία Νίκη Σοφία",
    ("m", "greek"): "Αλέξης Γιώργος Δημήτρης Κώστας Νίκος Πέτρος Στέλιος Χρήστος",
}
NAMES = {k: v.split() for k, v in NAMES.items()}
# Titles by gender.
TITLES = {"f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
          "m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
          "x": ("Dr", "Prof")}
_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_FEMALE = {n for (g, _), names in NAMES.items() if g == "f" for n in names}
_MALE = {n for (g, _), names in NAMES.items() if g == "m" for n in names}

WIDEN_AFTER = 8               # rounds after which a surrogate may be one character longer, and again after as many

# Types in order of precedence: a mention that overlaps an earlier type's is dropped.
PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[\w.+-]{1,64}@(?:[\w-]{1,63}\.)+[^\W\d_]{2,24}(?![\w-])"),
    "access_key": re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"
                             r"|(?<![A-Za-z0-9])(?:ghp_|gho_|sk-|xox[abp]-)[A-Za-z0-9-]{20,}"),
    "secret": re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?([^\s\"']{8,})"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "ipv4": re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"),
    "card": re.compile(r"(?<![\d-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{3,4}(?![\d-])"),
    "ssn": re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "phone": re.compile(r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d)"
                        r"|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"),
    "person": re.compile(r"\b(?:" + "|".join(sorted(_GENDER, key=len, reverse=True)) + r")\.? "
                         r"((?:[^\W\d_a-z][^\W\d_]+)(?:[ -][^\W\d_a-z][^\W\d_]+){0,2})"),
}
_DIGIT = re.compile(r"\d")
_TITLE = re.compile(r"\b(?:" + "|".join(sorted(_GENDER, key=len, reverse=True)) + r")\b")


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 - k % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def _iban_check(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _holds(kind: str, mention: str) -> bool:
    """Whether the check digits of a card or account number are right."""
    if kind == "card":
        digits = re.sub(r"\D", "", mention)
        return luhn(digits[:-1]) == int(digits[-1])
    value = mention.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _checked(kind: str, text: str) -> Iterator[tuple[int, int, re.Match]]:
    """(start, end, match) of numbers whose check digits hold.

    An account number's match may have taken in words after it, so it is also tried without its
    last groups; where nothing holds, the search goes on just behind the match's start.
    """
    at = 0
    while m := PATTERNS[kind].search(text, at):
        a, b = m.span()
        ends = [b]
        if kind == "iban":
            ends += [a + k for k in range(b - a - 1, 0, -1) if text[a + k] == " " and len(text[a:a + k].replace(" ", "")) >= 15]
        end = next((e for e in ends if _holds(kind, text[a:e])), None)
        if end is not None:
            yield a, end, m
        at = a + 1 if end is None else end


def script_of(text: str) -> str:
    for c in text:
        if c.isalpha():
            name = unicodedata.name(c, "")
            return next((s for s in ("cyrillic", "greek") if name.startswith(s.upper())), "latin")
    return "latin"


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """Mentions (start, end, type, canonical value), in order and without overlaps."""
    digits, at = bool(_DIGIT.search(text)), "@" in text
    run = []
    if at:
        run.append("email")
    if digits or "=" in text or ":" in text:
        run += ["access_key", "secret"]
    if digits:
        run += ["iban", "ipv4", "card", "ssn", "phone"]
    if _TITLE.search(text):
        run.append("person")
    found: list[tuple[int, int, str, str]] = []
    for kind in run:
        spans = _checked(kind, text) if kind in ("card", "iban") else (
            (*(m.span(1) if m.lastindex else m.span()), m) for m in PATTERNS[kind].finditer(text))
        for a, b, m in spans:
            if any(x < b and a < y for x, y, _, _ in found):
                continue
            value = text[a:b]
            if kind == "person":
                title = m[0][:a - m.start()].strip(" .")
                gender = _GENDER.get(title, "x")
                first = re.split(r"[ -]", value)[0]
                if gender == "x":
                    gender = "f" if first in _FEMALE else "m" if first in _MALE else "x"
                found.append((a, b, kind, f"{gender}|{value}"))
            elif kind == "email":
                found.append((a, b, kind, value.lower()))
            elif kind in ("card", "ssn", "phone"):
                plus = "+" if value.startswith("+") else ""
                found.append((a, b, kind, plus + re.sub(r"\D", "", value)))
            elif kind == "iban":
                found.append((a, b, kind, value.replace(" ", "")))
            else:
                found.append((a, b, kind, value))
    return sorted(found)


class Draw:
    """A stream of numbers below given bounds, from a key and a message."""

    def __init__(self, key: bytes, message: str):
        self._key, self._message, self._block, self._pool = key, message.encode("utf-8", "surrogatepass"), 0, b""

    def below(self, n: int) -> int:
        if len(self._pool) < 4:
            self._pool = hmac.new(self._key, self._block.to_bytes(4, "big") + self._message, hashlib.sha256).digest()
            self._block += 1
        value, self._pool = int.from_bytes(self._pool[:4], "big"), self._pool[4:]
        return value % n

    def like(self, text: str, hexadecimal: bool = False) -> str:
        """Text of the same shape: digits, letters of a case and script, and the rest as it is."""
        out = []
        for c in text:
            if hexadecimal and c in "0123456789abcdef":
                out.append("0123456789abcdef"[self.below(16)])
            elif c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                script = script_of(c)
                low = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя",
                       "greek": "αβγδεζηθικλμνξοπρστυφχψω"}[script]
                x = low[self.below(len(low))]
                out.append(x.upper() if c.isupper() else x)
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """A canonical surrogate of a canonical value; late attempts are longer, but for IP addresses."""
    draw = Draw(key, f"{kind}|{attempt}|{value}")
    more = "0" * (attempt // WIDEN_AFTER)
    if kind == "email":
        local, _, domain = value.partition("@")
        names, _, top = domain.rpartition(".")
        return f"{draw.like(local + more)}@{draw.like(names)}.{top}"
    if kind == "ipv4":
        return ".".join(str(1 + draw.below(223) if k == 0 else draw.below(256)) for k in range(4))
    if kind == "card":
        body = value[0] + draw.like(value[1:-1] + more)
        return body + str(luhn(body))
    if kind == "phone":
        plus, digits = ("+", value[1:]) if value.startswith("+") else ("", value)
        keep = max(0, len(digits) - 10)          # the country code stays
        new = draw.like(digits[keep:] + more)
        return plus + digits[:keep] + (str(2 + draw.below(8)) + new[1:] if new else "")
    if kind == "iban":
        body = draw.like(value[4:] + more)
        return value[:2] + _iban_check(value[:2], body) + body
    if kind == "access_key":
        head = re.match(r"AKIA|ASIA|ghp_|gho_|sk-|xox[abp]-", value)[0]
        return head + draw.like(value[len(head):] + more)
    if kind == "person":
        gender, _, name = value.partition("|")
        parts = re.split(r"([ -])", name + name[-1] * len(more))
        script = script_of(name)
        pool = NAMES[gender, script] if gender != "x" else NAMES["f", script] + NAMES["m", script]
        # a given name where there are two or more; family names are made up in the name's shape
        out = [pool[draw.below(len(pool))] if k == 0 and len(parts) > 1 else draw.like(p) for k, p in enumerate(parts)]
        return f"{gender}|{''.join(out)}"
    return draw.like(value + more, hexadecimal=bool(re.fullmatch(r"[0-9a-f]+", value)))


def render(kind: str, mention: str, canonical: str) -> str:
    """The surrogate in the mention's format."""
    if kind == "person":
        return canonical.partition("|")[2]
    if kind in ("card", "ssn", "phone"):
        digits = iter(canonical.lstrip("+"))
        return "".join([next(digits) if c.isdigit() else c for c in mention]) + "".join(digits)
    if kind == "iban":
        chars = iter(canonical)
        return "".join([c if c == " " else next(chars) for c in mention]) + "".join(chars)
    if kind == "email":
        if mention.isupper():
            return canonical.upper()
        if len(mention) == len(canonical):
            return "".join(x.upper() if m.isupper() else x for m, x in zip(mention, canonical, strict=True))
    return canonical


def shown(kind: Column, value: Column) -> Column:
    """What a text shows of a canonical value: a name without its gender."""
    return F.when(kind == "person", F.substring(value, 3, 1 << 30)).otherwise(value)


def settled(entities: DataFrame) -> DataFrame:
    """(kind, value, canonical): ``entities``, people without a gender under the only one that their name has elsewhere."""
    gender, name = F.substring("value", 1, 1), shown(F.col("kind"), F.col("value"))
    known = entities.filter((F.col("kind") == "person") & (gender != "x")).groupBy(name.alias("_name")).agg(
        F.min(gender).alias("_g"), F.max(gender).alias("_high")).filter("_g = _high")
    open_ = entities.filter((F.col("kind") == "person") & (gender == "x")).withColumn("_name", name)
    same = open_.join(known, "_name").select("kind", "value", F.concat("_g", F.lit("|"), "_name").alias("canonical"))
    return entities.join(same, ["kind", "value"], "left").select("kind", "value", F.coalesce("canonical", "value").alias("canonical"))


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value), with no surrogate shown like another or like any value.

    Each round draws for the entities still without one; of those that draw the same, the
    first keeps it.  What is taken, by an earlier round or as a real value, is drawn again.
    """
    def draw(attempt: int):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                kinds, values = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                drawn = [surrogate(key, k, v, attempt) for k, v in zip(kinds, values, strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(drawn, pa.string())],
                                                 names=["kind", "value", "surrogate"])
        return run

    schema = "kind string, value string, surrogate string"
    new = shown(F.col("kind"), F.col("surrogate")).alias("shown")
    real = entities.select("kind", shown(F.col("kind"), F.col("value")).alias("shown"))
    done, todo, attempt = None, entities, 0
    while True:
        first = F.row_number().over(Window.partitionBy("kind", "shown").orderBy("value"))
        drawn = todo.mapInArrow(draw(attempt), schema).select("*", new).withColumn("_first", first).filter("_first = 1").drop("_first")
        free = drawn.join(real, ["kind", "shown"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", new), ["kind", "shown"], "left_anti")
        free = free.select("kind", "value", "surrogate")
        done = materialize(free if done is None else done.union(free))
        todo = materialize(entities.join(done, ["kind", "value"], "left_anti").select("kind", "value"))
        if todo.isEmpty():
            return done
        attempt += 1
        if attempt > 200:         # only IP addresses: all else has long grown
            raise ValueError("no free surrogates are left for some IP addresses")


def row_key(text: str) -> list[Column]:
    """A row's id and its text's hash: rows that share an id, or have none, share no entities (if two hashes
    were equal, both rows would only know more entities than they need)."""
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_pii_id"), F.xxhash64(F.col(text)).alias("_pii_text")]


def entity_maps(docs: DataFrame, key: bytes, text: str) -> DataFrame:
    """(_pii_id, _pii_text, _pii_map): each row's entities with their surrogates, by :func:`row_key`."""
    body = docs.select(*row_key(text), F.col(text).alias("text"))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            seen = {(i, h, kind, value): None for i, h, t in zip(*(c.to_pylist() for c in rows.columns), strict=True) if t
                    for _, _, kind, value in detect(t)}
            i, h, kind, value = list(zip(*seen, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.string()), pa.array(h, pa.int64()), pa.array(kind, pa.string()),
                                              pa.array(value, pa.string())], names=["_pii_id", "_pii_text", "kind", "value"])

    mentions = materialize(body.mapInArrow(find, "_pii_id string, _pii_text long, kind string, value string").distinct())
    entities = materialize(settled(materialize(mentions.select("kind", "value").distinct())))
    table = assign(materialize(entities.select("kind", F.col("canonical").alias("value")).distinct()), key)
    table = entities.join(table.withColumnRenamed("value", "canonical"), ["kind", "canonical"]).drop("canonical")
    return mentions.join(table, ["kind", "value"]).groupBy("_pii_id", "_pii_text").agg(
        F.collect_list(F.struct("kind", "value", "surrogate")).alias("_pii_map"))


def replace_entities(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with entities in ``text`` replaced, and ``pii_entities`` (kind, start, end in the new text) added.

    A null text stays null, a text without entities as it is.  Rows that repeat a doc_id or
    have none are rewritten each by itself; an empty table gives an empty one; other
    columns pass through, but for one that bears the added name, which is replaced.
    """
    if not key:
        raise ValueError("a key is needed")
    names = [c for c in docs.columns if c != "pii_entities"]
    joined = docs.select(*names, *row_key(text)).join(entity_maps(docs, key, text), ["_pii_id", "_pii_text"], "left").select(
        *names, "_pii_map")

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, maps = rows.column(names.index(text)).to_pylist(), rows.column(len(names)).to_pylist()
            new, marks = [], []
            for t, known in zip(texts, maps, strict=True):
                marks.append([])
                if not t or not known:
                    new.append(t)
                    continue
                to = {(e["kind"], e["value"]): e["surrogate"] for e in known}
                out, at, size = [], 0, 0
                for a, b, kind, value in detect(t):
                    put = render(kind, t[a:b], to[kind, value])
                    out += [t[at:a], put]
                    size += a - at
                    marks[-1].append({"kind": kind, "start": size, "end": size + len(put)})
                    size += len(put)
                    at = b
                new.append("".join(out) + t[at:])
            cols = [pa.array(new, pa.string()) if names[k] == text else rows.column(k) for k in range(len(names))]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(marks, kind)], names=[*names, "pii_entities"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema.fields)
    return joined.mapInArrow(rewrite, fields + ", pii_entities array<struct<kind:string,start:int,end:int>>")
