"""Personal data: detected entities are replaced by keyed surrogates of the same type and form.

Detection finds e-mail addresses, IPv4 addresses, phone and card numbers, US social security numbers,
IBANs, names after a form of address, and every other whole-word mention (same letter case) of these names in
the same text. An entity is its type and normal form, so spellings that differ only in
case or separators refer to one entity. Its surrogate is drawn from an HMAC of the entity under a secret key:
digits stay digits, a card number keeps its length and its checksum's validity, an IBAN its country, a name its
gender, script and letter case. All distinct entities of the corpus then pass collision checks: no two may share
a surrogate and no surrogate may be an entity itself; those that fail are drawn again until none does. Hence distinct entities
stay distinct, and the same entity has the same surrogate in every document.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabqual.llm.shared import fresh_name, map_pandas, save, ship_package

KEY = "tabqual-surrogates"
MAX_ROUNDS = 60
SHARED_REDRAWS = 200_000

#: Forms of address, by the gender they tell.
MALE = "Mr Mister Sir Herr Herrn Monsieur Señor Sr Signor Г-н Господин".split()
FEMALE = "Mrs Ms Miss Madam Frau Madame Mme Mademoiselle Mlle Señora Señorita Sra Signora Г-жа Госпожа".split()
NEUTRAL = "Dr Prof Professor Doktor Docteur Доктор".split()
_GENDER = {**dict.fromkeys(MALE, "m"), **dict.fromkeys(FEMALE, "f"), **dict.fromkeys(NEUTRAL, "n")}

#: Syllables from which names are built, and gendered endings, by script.
SCRIPTS = {
    "LATIN": ("ba be bri ca da de el fa ga ha jo ka la le lo ma mi na no pe ra ro sa se ta ti va vi we za".split(),
              {"m": ("n", "rd", "s"), "f": ("a", "ia", "ine"), "n": ("l", "n", "r")}),
    "CYRILLIC": ("ба ва га да до ва за ка ла ли ма ми на но па ра ро са се та ти ту фа ха".split(),
                 {"m": ("н", "р", "л"), "f": ("на", "ла", "ра"), "n": ("н", "к", "ч")}),
    "GREEK": ("βα γα δα δη θε κα λα λε μα μι να νι πα πε ρα σα σο τα τι φα".split(),
              {"m": ("ς", "νος", "ρης"), "f": ("να", "ρα", "λη"), "n": ("ς", "κης", "δης")}),
}


class Entity(NamedTuple):
    kind: str
    value: str
    start: int
    end: int


_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
_IP = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)")
_PHONE = re.compile(
    r"(?<![\w+])(?:\+?\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"
    r"|(?<![\w.+-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_CARD = re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?!\w)")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?!\w)")
_NAME = re.compile(
    r"(?<!\w)(" + "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True)) + r")\.? "
    r"([^\W\d_a-z][^\W\d_]+(?:-[^\W\d_]+)?)(?: ([^\W\d_a-z][^\W\d_]+(?:-[^\W\d_]+)?))?")


def luhn_sum(digits: str) -> int:
    """Checksum modulo 10; 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def iban_rest(text: str) -> int:
    """The number of an IBAN modulo 97; 1 for a valid one."""
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def script_of(word: str) -> str:
    name = unicodedata.name(word[0], "LATIN")
    return next((s for s in SCRIPTS if name.startswith(s)), "LATIN")


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def entities(text: str | None) -> list[Entity]:
    """Entities of a text in order, none overlapping; of overlapping ones the first type in the list of detectors stays."""
    if not isinstance(text, str):
        return []
    found: list[Entity] = []
    if "@" in text:
        found += [Entity("email", m[0].lower(), *m.span()) for m in _EMAIL.finditer(text)]
    if any(map(text.__contains__, "0123456789")):
        found += [Entity("ip", m[0], *m.span()) for m in _IP.finditer(text) if all(int(x) < 256 for x in m[0].split("."))]
        found += [Entity("iban", m[0].replace(" ", ""), *m.span()) for m in _IBAN.finditer(text)
                  if iban_rest(m[0].replace(" ", "")) == 1]
        found += [Entity("ssn", _digits(m[0]), *m.span()) for m in _SSN.finditer(text)]
        found += [Entity("card", _digits(m[0]), *m.span()) for m in _CARD.finditer(text)]
        found += [Entity("phone", _digits(m[0]), *m.span()) for m in _PHONE.finditer(text)]
    for m in _NAME.finditer(text):
        gender = _GENDER[m[1]]
        given, last = (2, 3) if m[3] else (None, 2)
        if given:
            found.append(Entity(f"given:{gender}:{script_of(m[given])}", m[given].casefold(), *m.span(given)))
        found.append(Entity(f"surname:{script_of(m[last])}", m[last].casefold(), *m.span(last)))
    kept: list[Entity] = []
    taken: list[tuple[int, int]] = []
    for e in found:
        if not any(a < e.end and e.start < b for a, b in taken):
            kept.append(e)
            taken.append((e.start, e.end))
    kept.sort(key=lambda e: e.start)
    return sorted(kept + _mentions(text, kept), key=lambda e: e.start)


def _mentions(text: str, kept: list[Entity]) -> list[Entity]:
    """Mentions of the names in ``kept`` (in order) outside of these; each is the last such name before it, or else the first."""
    names: dict[str, list[Entity]] = {}
    for e in kept:
        if e.kind.startswith(("given:", "surname:")):
            names.setdefault(text[e.start:e.end], []).append(e)
    if not names:
        return []
    out, starts = [], {w: [e.start for e in own] for w, own in names.items()}
    forms = "|".join(map(re.escape, sorted(names, key=len, reverse=True)))
    at = [e.start for e in kept]
    for m in re.finditer(rf"(?<!\w)(?:{forms})(?!\w)", text):
        i = bisect_right(at, m.start()) - 1
        if i >= 0 and kept[i].end > m.start() or i + 1 < len(kept) and kept[i + 1].start < m.end():
            continue
        own = names[m[0]]
        known = own[max(0, bisect_right(starts[m[0]], m.start()) - 1)]
        out.append(Entity(known.kind, known.value, *m.span()))
    return out


class _Draw:
    """A stream of keyed numbers for one entity and attempt."""

    def __init__(self, key: str, *parts):
        self.key, self.parts, self.pool, self.n = key.encode(), "\x1f".join(map(str, parts)), b"", 0

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hmac.new(self.key, f"{self.parts}\x1f{self.n}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
            self.n += 1
        x, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return x % n

    def pick(self, items):
        return items[self.below(len(items))]

    def like(self, text: str) -> str:
        """Letters for letters, digits for digits, anything else as it is."""
        return "".join(chr(97 + self.below(26)) if c.isalpha() else str(self.below(10)) if c.isdigit() else c for c in text)


def surrogate(kind: str, value: str, attempt: int = 0, key: str = KEY) -> str:
    """Normal form of the surrogate of an entity; later attempts also widen what there is to draw from."""
    d = _Draw(key, kind, value, attempt)
    if kind == "email":
        local, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{d.like(local + 'x' * max(0, attempt - 3))}@{d.like(host)}.{top}"
    if kind == "ip":
        a = [int(x) for x in value.split(".")]
        fixed = 1 if a[0] in (10, 127) else 2 if (a[0], a[1]) == (192, 168) or a[0] == 172 and 16 <= a[1] < 32 else 0
        if fixed == 2 and attempt > 3:  # a crowded /16: all of 10/8
            a[0], fixed = 10, 1
        if attempt > 11:  # a crowded /8
            fixed = 0
        public = [x for x in range(1, 224) if x not in (10, 127, 172, 192)]
        return ".".join(str(a[i] if i < fixed else d.pick(public) if i == 0 else d.below(256)) for i in range(4))
    if kind == "iban":
        body = "".join(str(d.below(10)) if c.isdigit() else chr(65 + d.below(26)) for c in value[4:])
        return f"{value[:2]}{98 - iban_rest(value[:2] + '00' + body):02d}{body}"
    if kind == "card":
        valid = luhn_sum(value) == 0
        body = value[0] + "".join(str(d.below(10)) for _ in value[2:])
        check = (10 - luhn_sum(body + "0")) % 10
        return body + str(check if valid else (check + 1 + d.below(9)) % 10)
    if kind == "phone":
        fixed = max(0, len(value) - 10) if attempt < 4 else 0  # the country code
        longer = max(0, attempt - 11) // 4  # short numbers are few
        return value[:fixed] + "".join(str(d.below(10)) for _ in range(len(value) - fixed + longer))
    if kind == "ssn":
        return "".join(str(d.below(10)) for _ in value)
    part, *more = kind.split(":")
    syllables, endings = SCRIPTS[more[-1]]
    stem = "".join(d.pick(syllables) for _ in range(3 + attempt // 2))
    return stem + d.pick(endings[more[0] if part == "given" else "n"])


def in_form(kind: str, original: str, replacement: str) -> str:
    """The surrogate's normal form in the separators and letter case of the original spelling."""
    if kind in ("phone", "card", "ssn", "iban"):
        rest = iter(replacement)
        return "".join(next(rest, "") if c.isalnum() else c for c in original) + "".join(rest)
    if original.isupper() and any(c.isalpha() for c in original):
        return replacement.upper()
    if kind.startswith(("given", "surname")):
        return replacement[:1].upper() + replacement[1:]
    return replacement


def assign(distinct: DataFrame, key: str = KEY) -> DataFrame:
    """``(kind, value, attempt, surrogate)`` for distinct entities ``(kind, value)``, free of collisions.

    Of entities that share a surrogate the smallest keeps it; an entity whose surrogate is itself an entity loses it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["surrogate"] = [surrogate(k, v, a, key) for k, v, a in zip(b["kind"], b["value"], b["attempt"])]
            yield b

    schema = "kind string, value string, attempt int, surrogate string"
    space = F.split("kind", ":")[0]  # given names of either gender share one space
    drawn = save(map_pandas(distinct.select("kind", "value", F.lit(0).alias("attempt")), run, schema), "drawn")
    for _ in range(MAX_ROUNDS):
        keyed = drawn.withColumn("space", space)
        first = keyed.groupBy("space", "surrogate").agg(F.min(F.struct("kind", "value")).alias("first"), F.count("*").alias("n"))
        shared = keyed.join(first.filter("n > 1"), ["space", "surrogate"]).filter(
            F.struct("kind", "value") != F.col("first")).select("kind", "value")
        real = keyed.select("space", F.col("value").alias("surrogate")).distinct()
        taken = keyed.join(real, ["space", "surrogate"], "left_semi").select("kind", "value")
        clash = save(shared.unionByName(taken).distinct(), "clash")
        if clash.isEmpty():
            return drawn
        again = drawn.join(clash, ["kind", "value"], "left_semi").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        drawn = save(drawn.join(clash, ["kind", "value"], "left_anti").unionByName(map_pandas(again, run, schema)), "drawn")
    raise RuntimeError(f"entities still collide after {MAX_ROUNDS} rounds")


def find_entities(docs: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """Distinct ``(doc_key, kind, value)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *e) for k, t in zip(b["k"], b["t"]) for e in sorted({(x.kind, x.value) for x in entities(t)})]
            yield pd.DataFrame(rows, columns=["doc_key", "kind", "value"])

    kind = docs.schema[key_col].dataType.simpleString()
    rows = docs.select(F.col(key_col).alias("k"), F.col(text_col).alias("t")).filter("t is not null")
    return map_pandas(rows, run, f"doc_key {kind}, kind string, value string")


def replace_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY,
                     count_col: str = "n_entities", shared_redraws: int = SHARED_REDRAWS) -> DataFrame:
    """``docs`` with surrogates in the text and the number of replaced entities in ``count_col`` (appended; with
    underscores after it where ``docs`` has such a column).

    A surrogate follows from the key and the entity, so tasks only need to be told the few entities that were drawn
    again: as a shared table of ``shared_redraws`` entries at most, or else joined to the texts that hold them.

    Texts without entities, NULL and empty texts stay as they are, with a count of 0. Equal texts get equal results, so
    repeated rows and NULL ids need no special care; an empty table stays empty. Other columns stay as they are.
    """
    doc_key, redraws_col, count_col = (fresh_name(docs, c) for c in ("text_key", "redraws", count_col))
    keyed = docs.withColumn(doc_key, F.coalesce(F.md5(text_col), F.lit("")))
    found = save(find_entities(keyed, doc_key, text_col), "entities")
    redrawn = assign(found.select("kind", "value").distinct(), key).filter("attempt > 0").select("kind", "value", "attempt")
    redrawn = save(redrawn, "redrawn")
    at, schema = docs.columns.index(text_col), docs.withColumn(count_col, F.lit(0).cast("bigint")).schema
    ship_package(docs.sparkSession)

    def replaced(b, tables):
        import pyarrow as pa
        texts = b.column(at)
        done = [rewrite(t, table, key) for t, table in zip(texts.to_pylist(), tables)]
        columns = [pa.array([t for t, _ in done], texts.type) if i == at else c for i, c in enumerate(b.columns[:len(schema) - 1])]
        return pa.RecordBatch.from_arrays([*columns, pa.array([n for _, n in done], pa.int64())], names=schema.names)

    if redrawn.count() <= shared_redraws:
        shared = docs.sparkSession.sparkContext.broadcast({(r["kind"], r["value"]): r["attempt"] for r in redrawn.collect()})

        def with_shared(batches: Iterator) -> Iterator:
            for b in batches:
                yield replaced(b, [shared.value] * b.num_rows)

        return docs.mapInArrow(with_shared, schema)

    entry = F.concat_ws("\x1f", "kind", "value", F.col("attempt").cast("string"))
    per = found.distinct().join(redrawn, ["kind", "value"]).groupBy("doc_key").agg(F.collect_list(entry).alias("redraws"))
    per = save(per.select(F.col("doc_key").alias("own_key"), F.col("redraws").alias(redraws_col)), "redraws")
    rows = keyed.join(per, keyed[doc_key] == per["own_key"], "left").select(*[keyed[c] for c in docs.columns], redraws_col)

    def with_joined(batches: Iterator) -> Iterator:
        for b in batches:
            parts = ([e.split("\x1f") for e in own or []] for own in b.column(len(b.columns) - 1).to_pylist())
            yield replaced(b, [{(k, v): int(a) for k, v, a in own} for own in parts])

    return rows.mapInArrow(with_joined, schema)


def rewrite(text: str | None, redrawn: dict[tuple[str, str], int], key: str = KEY) -> tuple[str | None, int]:
    """The text with a surrogate for every entity, and how many there are; ``redrawn`` gives attempts above 0."""
    out, at, own = [], 0, entities(text)
    for e in own:
        new = surrogate(e.kind, e.value, redrawn.get((e.kind, e.value), 0), key)
        out += [text[at:e.start], in_form(e.kind, text[e.start:e.end], new)]
        at = e.end
    return ("".join([*out, text[at:]]) if own else text), len(own)
