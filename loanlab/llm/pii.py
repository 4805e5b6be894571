"""Operator 5: personal data replaced by keyed surrogates.

Entities: e-mail addresses, payment cards (Luhn), phone numbers, IPv4 addresses, US social
security numbers, IBANs (mod 97), secrets given after a name such as ``token =``, and persons after a
title.  A surrogate is drawn from a keyed hash of (kind, normalised value, attempt), so the same
entity has the same surrogate in every document, and keeps the kind's form: digits stay digits, letters stay
letters of the same case and script, check digits are right, names have the gender of their title.

Distinctness is checked over the whole corpus in Spark: the distinct entities draw their surrogates,
and those that share one, or hit another real entity, draw again until none do.  Only the few
entities that drew again travel back to their documents; all others are recomputed in place.

Defined results: null text stays null, empty stays empty, both with no entities; rows with a null
doc_id are handled as others; rows that share a doc_id share its redrawn entities (same result);
numbers that fail their check (Luhn, octets over 255) and bare hashes are left alone.
"""
from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlab.llm.text import broadcast_if_small, map_arrow, reliable, values

KEY = "public-example-key"
WIDEN = 16  # attempts that keep the narrow form; each later one may be a sign longer

_LOCAL = re.compile(r"[\w.+%-]")
_DOMAIN = re.compile(r"(?:[^\W_](?:[\w-]*[^\W_])?\.)+[^\W\d_]{2,}")
_NUMBER = re.compile(r"\+?\(?\d[\d .()/-]{5,}\d")
_CARDS = re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,}(?!\w)")
_GROUP = re.compile(r"\d+")
_PHONE = re.compile(r"(?<![\w.])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ -]?\d{2,4}){2,4})(?!\w)(?!\.\d)")
_SSN = re.compile(r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])")
_IP = re.compile(r"(?<![\w.])(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})(?!\w)(?!\.\d)")
_IBAN = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_GIVEN = re.compile(r"""[=:][ \t]*["']?([^\s"']{8,})""")
_SECRET = re.compile(r"(?i)(?<![^\W_])(?:token|secret|api[_ -]?key|access[_ -]?key|private[_ -]?key|passwo?r?d|passwd|pwd|bearer)[\"']?[ \t]*$")
_TITLE = re.compile(r"(?:Mr|Mrs|Ms|Miss|Dr|Herr|Frau|Monsieur|Madame|Mme|Señora|Señor|Sra|Sr|Господин|Госпожа|Κύριος|Κυρία)\b\.? ([^\W\d_][\w'’-]+(?: [^\W\d_][\w'’-]+){0,2})")
_WOMEN = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία")
_MEN = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος")


def luhn(digits: str) -> int:
    """Check sum modulo 10; 0 for a valid number."""
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10


def iban_rest(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def cards(text: str, start: int, end: int) -> list[tuple[int, int, bool]]:
    """(start, end, is it whole or evenly grouped) of the card numbers in the digit runs of a span.

    Every start and end on a border between groups is tried, from 19 digits down to 13.  Unbroken numbers
    and those in groups of four digits or more (the last may be shorter) go before other groupings, which
    can be made of neighbours by chance; then the first goes before the later, the longer before the shorter."""
    out = []
    for run in _CARDS.finditer(text, start, end):
        groups = [g.span() for g in _GROUP.finditer(text, *run.span())]
        fits = []
        for i, (s, _) in enumerate(groups):
            digits = ""
            for j in range(i, len(groups)):
                digits += text[slice(*groups[j])]
                if len(digits) > 19:
                    break
                if len(digits) >= 13 and not luhn(digits):
                    even = all(b - a >= 4 for a, b in groups[i:j])
                    fits.append((not even, i, -j))
        used = set()
        for ragged, i, back in sorted(fits):
            if used.isdisjoint(range(i, 1 - back)):
                used.update(range(i, 1 - back))
                out.append((groups[i][0], groups[-back][1], not ragged or i == 0 and 1 - back == len(groups)))
    return out


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what is found, in order, without overlaps."""
    found = []
    at = text.find("@")
    while at >= 0:
        right = _DOMAIN.match(text, at + 1)
        if right:
            start = at
            while start and _LOCAL.match(text, start - 1):   # an @ is no such letter: no place is passed twice
                start -= 1
            while start < at and text[start] in ".+%-":
                start += 1
            if start < at:
                found.append((start, right.end(), "email"))
        at = text.find("@", at + 1)
    for m in _NUMBER.finditer(text):
        s, e = m.span()
        others = []
        for kind, p in (("ip", _IP), ("ssn", _SSN), ("phone", _PHONE)):
            for x in p.finditer(text, s, min(len(text), e + 1)):
                if x.end() > e:
                    continue
                if kind == "ip" and any(int(o) > 255 for o in x.groups()):
                    continue
                if kind == "phone" and not 7 <= len(re.sub(r"\D", "", x[0])) <= 15:
                    continue
                others.append((*x.span(), kind))
        found += others
        inside = {i for x, y, _ in others for i in range(x + 1, y)}
        for a, b, sure in cards(text, s, min(len(text), e + 1)):
            # neighbours that pass by chance may not cut a phone number in two
            if b <= e and (sure or inside.isdisjoint((a, b))):
                found.append((a, b, "card"))
    for m in _GIVEN.finditer(text):
        if _SECRET.search(text, max(0, m.start() - 32), m.start()):
            found.append((*m.span(1), "secret"))
    for m in _IBAN.finditer(text):
        s = m[0].replace(" ", "")
        if 15 <= len(s) <= 34 and (m.start() == 0 or not text[m.start() - 1].isalnum()) and iban_rest(s) == 1:
            found.append((*m.span(), "iban"))
    for m in _TITLE.finditer(text):
        s = m.start()
        if s and text[s - 1].isalnum():
            continue
        e, start = m.end(1), m.start(1)
        names = []
        for n in text[start:e].split(" "):
            if not n[0].isupper() or n.isupper():
                break
            names.append(n)
        if names:
            title = re.match(r"\w+", text[s:])[0]
            kind = "woman" if title in _WOMEN else "man" if title in _MEN else "person"
            found.append((start, start + len(" ".join(names)), kind))
    found.sort(key=lambda x: (x[0], -x[1]))
    out, end = [], 0
    for x in found:
        if x[0] >= end:
            out.append(x)
            end = x[1]
    return out


def normal(kind: str, value: str) -> str:
    """What makes two mentions the same entity."""
    if kind in ("card", "phone", "ssn"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    return value if kind == "secret" else value.casefold()


class Draw:
    """Keyed stream of numbers for one entity."""

    def __init__(self, key: str, *of):
        self.seed, self.n, self.pool = "\x1f".join(map(str, of)).encode(), 0, 0
        self.key, self.left = key.encode()[:64], 0

    def below(self, n: int) -> int:
        if self.left < 1 << 32:
            self.pool = int.from_bytes(hashlib.blake2b(self.seed + self.n.to_bytes(4, "big"), key=self.key).digest(), "big")
            self.n, self.left = self.n + 1, 1 << 512
        self.pool, got = divmod(self.pool, n)
        self.left //= n
        return got


_VOWELS, _CONSONANTS = "aeiou", "bcdfghjklmnprstvz"
_ENDINGS = {"latin": {"woman": ("a", "ia", "ina", "elle"), "man": ("o", "an", "us", "er"), "person": ("en", "is", "el", "al")},
            "cyrillic": {"woman": ("а", "ия", "на"), "man": ("ов", "ий", "ин"), "person": ("ко", "ич", "их")},
            "greek": {"woman": ("α", "ία", "ρη"), "man": ("ος", "ης", "ων"), "person": ("ου", "ις", "ιο")}}
_SYLLABLES = {"latin": (_CONSONANTS, _VOWELS), "cyrillic": ("бвгдзклмнпрст", "аеиоу"), "greek": ("βγδκλμνπρστ", "αειο")}


def _script(c: str) -> str:
    o = ord(c)
    return "cyrillic" if 0x400 <= o < 0x530 else "greek" if 0x370 <= o < 0x400 else "latin" if o < 0x250 else "other"


def _letters(s: str, d: Draw) -> str:
    """Digits for digits, letters for letters of the same case and script; the rest as it is."""
    out = []
    for c in s:
        if c.isdigit():
            c = str(d.below(10))
        elif c.isalpha():
            o, kind = ord(c), _script(c)
            if kind == "other":  # a near letter of the same block that is a letter, too
                near = [chr(x) for x in range(o & ~31, (o & ~31) + 32) if chr(x).isalpha() and chr(x).isupper() == c.isupper()]
                c = near[d.below(len(near))]
            else:
                pool = "".join(_SYLLABLES[kind])
                x = pool[d.below(len(pool))]
                c = x.upper() if c.isupper() else x
        out.append(c)
    return "".join(out)


def _name(part: str, kind: str, d: Draw, more: int) -> str:
    script = _script(part[0])
    if script == "other":
        return _letters(part + "a" * more, d)
    cons, vow = _SYLLABLES[script]
    ends = _ENDINGS[script][kind]
    stem = "".join(cons[d.below(len(cons))] + vow[d.below(len(vow))] for _ in range(max(2, len(part) // 2) + more))
    return (stem[:-1] + ends[d.below(len(ends))]).capitalize()


def surrogate(kind: str, norm: str, attempt: int, key: str = KEY) -> str:
    """The entity's surrogate in normal form; from attempt WIDEN on it grows, so that no number of entities
    fills the forms there are."""
    d = Draw(key, kind, norm, attempt)
    more = max(0, attempt - WIDEN + 1)
    if kind == "email":
        local, _, domain = norm.rpartition("@")
        hosts, _, top = domain.rpartition(".")
        return f"{_letters(local + "a" * more, d)}@{_letters(hosts, Draw(key, 'domain', domain))}.{top}"
    if kind == "card":
        body = norm[0] + "".join(str(d.below(10)) for _ in norm[2:] + "0" * min(more, 19 - len(norm)))
        return body + str((10 - luhn(body + "0")) % 10)
    if kind == "phone":
        return norm[0] + "".join(str(d.below(10)) if i else str(1 + d.below(9)) for i in range(len(norm) - 1 + more))
    if kind == "ssn":
        return "9" + "".join(str(d.below(10)) for _ in norm[1:] + "0" * more)  # never issued
    if kind == "ip":
        spans = {1: (0, 10), 2: (10, 90), 3: (100, 156)}
        return ".".join(str((lambda s: s[0] + d.below(s[1]))(spans[len(o)] if attempt < WIDEN else (0, 256))) for o in norm.split(".") + ["0"] * max(0, attempt - 2 * WIDEN + 1))
    if kind == "iban":
        body = "".join(c if c.isalpha() else str(d.below(10)) for c in norm[4:] + "0" * more)
        return norm[:2] + f"{98 - iban_rest(norm[:2] + '00' + body):02d}" + body
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", norm):
            hexa = "0123456789abcdef" if norm == norm.lower() else "0123456789ABCDEF"
            return "".join(hexa[d.below(16)] for _ in norm + "0" * more)
        return _letters(norm + "a" * more, d)
    return " ".join(_name(p, kind, d, more) for p in norm.split(" "))


def rendered(kind: str, value: str, norm: str, attempt: int, key: str) -> str:
    """The surrogate in the form (separators, capitals) of this mention."""
    s = surrogate(kind, norm, attempt, key)
    if kind in ("card", "phone", "ssn"):
        digits = iter(s)
        return "".join(next(digits) if c.isdigit() else c for c in value) + "".join(digits)
    if kind == "iban":
        signs = iter(s)
        return "".join(c if c == " " else next(signs) for c in value) + "".join(signs)
    if kind == "email" and value == value.upper() and value != value.lower():
        return s.upper()
    return s


def _mentions(batches):
    for b in batches:
        who, kinds, norms = [], [], []
        for i, v in enumerate(values(b.column(1))):
            text = v.decode("utf-8", "replace") if v else ""
            for k, n in sorted({(k, normal(k, text[s:e])) for s, e, k in entities(text)}):
                who.append(i)
                kinds.append(k)
                norms.append(n)
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(who, pa.int64())), pa.array(kinds, pa.string()), pa.array(norms, pa.string())], names=["id", "kind", "norm"])


def _drawn(key: str):
    def run(batches):
        for b in batches:
            k, n, a = (c.to_pylist() for c in b.columns)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([surrogate(*x, key) for x in zip(k, n, a)], pa.string())], names=["kind", "norm", "attempt", "made"])
    return run


def redrawn(known: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, norm, attempt) of the distinct entities ``known`` whose first surrogate was not free."""
    schema = "kind string, norm string, attempt int, made string"
    have = reliable(map_arrow(known.withColumn("attempt", F.lit(0)), _drawn(key), schema))
    parts = have.rdd.getNumPartitions()  # each round's union would double them
    while True:
        first = reliable(have.groupBy("kind", "made").agg(F.min("norm").alias("owner"), F.max("norm").alias("last")).where("owner < last").drop("last"))
        shared = have.join(broadcast_if_small(first, 200), ["kind", "made"]).where("norm <> owner").select("kind", "norm")
        real = known.select("kind", F.col("norm").alias("made"))
        real = have.join(real, ["kind", "made"], "left_semi").select("kind", "norm")
        again = reliable(shared.union(real).distinct())
        if not again.take(1):
            return have.where("attempt > 0").select("kind", "norm", "attempt")
        again = broadcast_if_small(again, 200)
        more = have.join(again, ["kind", "norm"], "left_semi").select("kind", "norm", (F.col("attempt") + 1).alias("attempt"))
        have = reliable(have.join(again, ["kind", "norm"], "left_anti").unionByName(map_arrow(more, _drawn(key), schema)).coalesce(parts))


def _replaced(at: int, width: int, key: str, names: list[str]):
    """Rows with the text in column ``at`` replaced; the redrawn entities are the last column."""
    def run(batches):
        for b in batches:
            out, count, kinds = [], [], []
            for v, redo in zip(values(b.column(at)), b.column(width).to_pylist()):
                if not v:
                    out.append(v)
                    count.append(0)
                    kinds.append("")
                    continue
                text, tries = v.decode("utf-8", "replace"), {(x["kind"], x["norm"]): x["attempt"] for x in redo or ()}
                parts, end, found = [], 0, entities(text)
                for s, e, k in found:
                    n = normal(k, text[s:e])
                    parts += [text[end:s], rendered(k, text[s:e], n, tries.get((k, n), 0), key)]
                    end = e
                out.append("".join(parts + [text[end:]]).encode() if found else v)
                count.append(len(found))
                kinds.append(",".join(sorted({k for _, _, k in found})))
            cols = list(b.columns[:width])
            cols[at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(count, pa.int64()), pa.array(kinds, pa.string())], names=names)
    return run


def pseudonymise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY) -> DataFrame:
    """``docs`` with its columns, the text replaced, and ``_entities`` and ``_kinds`` added (in place of columns so named)."""
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.drop("_entities", "_kinds")
    seen = reliable(map_arrow(docs.where(F.col(text_col).isNotNull()).select(id_col, text_col), _mentions, f"id {kind}, kind string, norm string"))
    redo = reliable(redrawn(reliable(seen.select("kind", "norm").distinct()), key))
    own, tries = (next(n for n in (f"_{x}{i or ''}" for i in range(len(docs.columns) + 1)) if n not in docs.columns) for x in ("own", "redo"))
    mine = seen.join(broadcast_if_small(redo, 200), ["kind", "norm"]).groupBy(F.col("id").alias(own)).agg(F.collect_set(F.struct("kind", "norm", "attempt")).alias(tries))
    mine = reliable(mine)
    rows = docs.join(broadcast_if_small(mine, 1024), F.col(id_col).eqNullSafe(F.col(own)), "left").select(*[F.col(f"`{c}`") for c in docs.columns], tries)
    names = [*docs.columns, "_entities", "_kinds"]
    schema = T.StructType([*docs.schema.fields, T.StructField("_entities", T.LongType()), T.StructField("_kinds", T.StringType())])
    return map_arrow(rows, _replaced(docs.columns.index(text_col), len(docs.columns), key, names), schema)
