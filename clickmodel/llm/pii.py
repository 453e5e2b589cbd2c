"""Surrogates for personal data.

Entities are detected in the whole text and replaced by made-up values of the same type: same
layout, letters' case and script, digit counts, a card number's check digit, a name's gender.
A surrogate is drawn from a keyed hash (HMAC-SHA256) of the entity's type and canonical form, so
one entity has one surrogate in every document, in whatever layout it is written. A name's gender
is no part of the entity: it is settled over the corpus (that of all its titles that tell one; none
if they disagree) and only shapes the surrogate's ending. A phone number is known by its
national digits: country code, trunk zero, first digit and layout stay. An IPv4 address stays in
its private, loopback or link-local network, or stays public.

Distinctness is checked over the corpus: all distinct entities propose a surrogate; where two
propose the same, or one proposes an entity that the corpus holds, all but the least entity of a
free surrogate draw again, until nothing collides. The table of entities never leaves Spark.

Types: email, phone (international, North American, French, German and Spanish layouts), IPv4,
IPv6, card number, social-security number, IBAN, secret (a hex or token string that is labelled
as one, in quotes or not, or 32 digits long and more), and the parts of a person's name after a
title, which gives the gender; parts may hold inner capitals, hyphens and apostrophes, be all
capitals and follow initials. A family or given name found so is replaced elsewhere in that
document too, where it is written alike.

Not detected: names without a title anywhere in the document, initials (they stay beside the new
name), all-capital names after "MS" or "SR" without a full stop, names in other scripts than Latin
and Cyrillic, postal addresses, dates of birth, phone numbers in other national layouts, Spanish
numbers without separators, and unquoted secrets after a colon that are letters alone.

Defined results: NULL stays NULL; texts without an entity stay byte for byte; rows that repeat an
id are told apart by their text; a NULL id is an id; an empty table gives an empty result. Extra
columns are not read, or are carried unchanged inside ``keep``.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmodel.llm import scratch

MALE, FEMALE, ANY = "m", "f", "u"
# Titles before a name, with the gender they tell.
TITLES = {
    "Mr": MALE, "Mister": MALE, "Sir": MALE, "Herr": MALE, "Herrn": MALE, "Monsieur": MALE, "Señor": MALE, "Sr": MALE, "г-н": MALE, "господин": MALE,
    "Mrs": FEMALE, "Ms": FEMALE, "Miss": FEMALE, "Madam": FEMALE, "Frau": FEMALE, "Madame": FEMALE, "Mme": FEMALE, "Señora": FEMALE, "Sra": FEMALE,
    "г-жа": FEMALE, "госпожа": FEMALE, "Dr": ANY, "Prof": ANY,
}
# Country codes of one and of two digits (all others have three), and networks that are not public.
CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
NETWORKS = tuple(map(ipaddress.IPv4Network, ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "127.0.0.0/8", "169.254.0.0/16")))
_UPPER, _LOWER = r"A-ZÀ-ÖØ-ÞА-ЯЁ", r"a-zß-öø-ÿа-яё"
_PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w.+-])(?:\d{4}[ -]){3}\d{1,7}(?![\w-])|(?<![\w.+-])\d{13,19}(?![\w-])",
    "ipv4": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,5}(?!\w)|(?<!\w)\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
    # French; German; Spanish.
    r"|(?<![\w+.,/-])(?<!\d )0[1-9](?:([ .-]?)\d{2})(?:\1\d{2}){3}(?![\w-])|(?<![\w+.,/-])(?<!\d )0[1-9]?\d{1,3}[ /-]\d{3,8}(?:[ -]\d{1,5}){0,2}(?![\w/-])|(?<![\w+.,/-])(?<!\d )[6-9]\d{2}([ .-])\d{3}\2\d{3}(?![\w-]|[ .,]\d)",
    "ipv6": r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])",
    "secret": r"(?<!\w)[0-9a-fA-F]{32,}(?!\w)|(?<!\w)(?:AKIA|ASIA|ghp_|gho_|xox[bpas]-|sk-|pk_live_|sk_live_)[0-9A-Za-z_-]{12,}(?!\w)",
}
_LABEL = r"(?i)(?<![a-z])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b[\"']?\s*"
_LABELLED = re.compile(_LABEL + r"[=:]\s*([\"'])([^\s\"']{8,})\1")
_UNQUOTED = re.compile(_LABEL + r"(?:=\s*|:\s*(?=[a-z]*[^\sa-z\"',;<>.:)!?]))([^\s\"',;<>]{7,}[^\s\"',;<>.:)!?])")
_COMPILED = {k: re.compile(v) for k, v in _PATTERNS.items()}
_MIXED = rf"(?:[{_UPPER}]['’])?[{_UPPER}][{_LOWER}]+(?:(?:[-'’][{_UPPER}]?|[{_UPPER}])[{_LOWER}]+)*"
_CAPITALS = rf"(?:[{_UPPER}]['’])?[{_UPPER}]{{2,}}(?:[-'’][{_UPPER}]+)*"
_BY_LENGTH = sorted(TITLES, key=len, reverse=True)
_SHOUTED = {t.upper(): g for t, g in TITLES.items()}
# All-capital titles stand before all-capital names; "MS" and "SR" are too common without their full stop.
_BEFORE = "|".join([rf"(?:{'|'.join(_BY_LENGTH)})(?:\.[ ]|[ ])", rf"(?:{'|'.join(map(str.upper, _BY_LENGTH))})(?:\.[ ]|(?<!MS)(?<!SR)[ ])(?=(?:[{_UPPER}]\.[ ]?)*{_CAPITALS}(?!\w))"])
_PERSON = re.compile(rf"(?<!\w)(?:{_BEFORE})(?:[{_UPPER}]\.[ ]?){{0,3}}({_MIXED}(?:[ ](?:[{_UPPER}]\.[ ])?{_MIXED}(?!\w)){{0,2}}|{_CAPITALS}(?:[ ]{_CAPITALS}){{0,2}})(?!\w)")
_TITLE = re.compile(rf"(?<!\w)({'|'.join(sorted({*TITLES, *_SHOUTED}, key=len, reverse=True))})(?!\w)")
_DIGIT = re.compile(r"\d")
_CYRILLIC = re.compile("[А-яЁё]")
# What a surrogate's letters are drawn from, by the script and case of the letter replaced.
_ACCENTED = "àáâäçèéêëìíîïñòóôöùúûü"
_RUSSIAN = "абвгдежзиклмнопрстуфхцчшэюя"
# Name parts by script, and the endings that tell a gender.
_PARTS = {"latin": "bal cor dan el fer gal hol jan kel lor mar nor or per quin ros sal tam ul var wen yor zan".split(),
          "cyrillic": "ан бор вал гор дан ев зах ил кир лев мак ник ол пав ром сав тим фед".split()}
_GIVEN = {"latin": {MALE: ("o", "us", "ert"), FEMALE: ("a", "ina", "elle"), ANY: ("i", "en", "is")},
          "cyrillic": {MALE: ("ей", "ан", "ий"), FEMALE: ("ина", "ия", "ана"), ANY: ("и", "ь", "о")}}
_FAMILY = {"latin": ("son", "er", "man", "ez", "ard"), "cyrillic": {MALE: ("ов", "ин"), FEMALE: ("ова", "ина"), ANY: ("енко", "ук")}}


def script_of(word: str) -> str:
    return "cyrillic" if _CYRILLIC.search(word) else "latin"


def _ipv6(mention: str) -> str | None:
    """The address in its shortest form, or None: clock times, names in program text (a::b) and the like."""
    if sum(map(bool, mention.split(":"))) < 2 or not _DIGIT.search(mention):
        return None
    try:
        address = ipaddress.IPv6Address(mention)
    except ValueError:
        return None
    return str(address)


def national(mention: str) -> str:
    """A phone number's digits without country code and trunk zero."""
    digits = re.sub(r"\D", "", mention)
    if mention.startswith("+"):
        digits = digits[next((n for n in (1, 2) if digits[:n] in CODES), 3):]
    return digits.removeprefix("0")


def entity_type(kind: str) -> str:
    """The type that tells entities apart: a name's without its gender."""
    parts = kind.split(":")
    return f"{parts[0]}:{parts[2]}" if len(parts) == 3 else kind


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of the entities of a text, not overlapping, in order."""
    found: list[tuple[int, int, str, str]] = []
    digits = bool(_DIGIT.search(text))
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in _COMPILED["email"].finditer(text)]
    if digits:
        if text.count(":") > 1:
            for m in _COMPILED["ipv6"].finditer(text):
                if (form := _ipv6(m[0])) is not None:
                    found.append((m.start(), m.end(), "ipv6", form))
        for kind in ("secret", "iban", "card", "ipv4", "ssn", "phone"):
            for m in _COMPILED[kind].finditer(text):
                form = re.sub(r"[^0-9A-Za-z]", "", m[0]) if kind in ("iban", "card", "ssn", "phone") else m[0].lower() if kind == "secret" and len(m[0]) >= 32 else m[0]
                if kind == "card" and not 13 <= len(form) <= 19:
                    continue
                if kind == "iban" and not 15 <= len(form) <= 34:
                    continue
                if kind == "phone":
                    if not 7 <= len(form) <= 15:
                        continue
                    form = national(m[0])
                found.append((m.start(), m.end(), kind, form))
    found += [(m.start(2), m.end(2), "secret", m[2].lower() if re.fullmatch("[0-9a-fA-F]{32,}", m[2]) else m[2]) for m in _LABELLED.finditer(text)]
    found += [(m.start(1), m.end(1), "secret", m[1].lower() if re.fullmatch("[0-9a-fA-F]{32,}", m[1]) else m[1]) for m in _UNQUOTED.finditer(text)]
    names: dict[str, tuple[str, str]] = {}
    for m in _PERSON.finditer(text):
        title = _TITLE.match(text, m.start())[1]
        gender = TITLES.get(title) or _SHOUTED[title]
        parts = [re.sub(r"['’][sS]$", "", p) for p in m[1].split(" ") if not p.endswith(".")]
        for k, part in enumerate(parts):
            family = k == len(parts) - 1
            names.setdefault(part, ("family" if family else "given", gender))
    if names:
        for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(names, key=len, reverse=True)))})(?!\w)", text):
            part, gender = names[m[0]]
            script = script_of(m[0])
            gender = gender if part == "given" or script == "cyrillic" else ANY
            found.append((m.start(), m.end(), f"{part}:{gender}:{script}", m[0].lower()))
    out: list[tuple[int, int, str, str]] = []
    for e in sorted(found, key=lambda e: (e[0], -e[1])):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


class Stream:
    """Numbers drawn from HMAC-SHA256 of (type, entity, attempt)."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        self.seed, self.block, self.bits = hmac.new(key, f"{kind}\x00{entity}\x00{attempt}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest(), 0, b""

    def below(self, n: int) -> int:
        if len(self.bits) < 4:
            self.bits += hashlib.sha256(self.seed + self.block.to_bytes(4, "big")).digest()
            self.block += 1
        v, self.bits = int.from_bytes(self.bits[:4], "big"), self.bits[4:]
        return v % n

    def one(self, options):
        return options[self.below(len(options))]


def _like(c: str, s: Stream, letters: str | None = None) -> str:
    """A character of the same kind: digit, or letter of the same case and script."""
    if c.isdigit():
        return s.one(string.digits)
    if not c.isalpha():
        return c
    pool = letters or (_RUSSIAN if _CYRILLIC.match(c) else string.ascii_lowercase if c.isascii() else _ACCENTED)
    x = s.one(pool)
    return x.upper() if c.isupper() else x


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def iban_check(body: str) -> str:
    """The two check digits of country + account."""
    number = "".join(str(int(c, 36)) for c in body[4:] + body[:2] + "00")
    return f"{98 - int(number) % 97:02d}"


def _ipv4_like(entity: str, s: Stream) -> str:
    """An address of the same network, where that is not public, or another public one."""
    octets = list(map(int, entity.split(".")))
    address = ipaddress.IPv4Address(bytes(octets))
    for net in NETWORKS:
        if address in net:
            return str(net[1 + s.below(net.num_addresses - 2)])
    public = lambda a: a.is_global and not a.is_multicast
    while True:
        first = [] if public(address) else octets[:1]
        new = ipaddress.IPv4Address(bytes([*first, *(1 + s.below(254) for _ in octets[len(first):])]))
        if first or public(new):
            return str(new)


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The canonical form that replaces ``entity``."""
    s = Stream(key, entity_type(kind), entity, attempt)
    part = kind.split(":")
    if part[0] in ("given", "family"):
        _, gender, script = part
        stem = s.one(_PARTS[script]) + s.one(_PARTS[script]) + (s.one(_PARTS[script]) if attempt else "")
        for _ in range(attempt // 4):  # names run out: longer ones
            stem += s.one(_PARTS[script])
        if part[0] == "given":
            return stem + s.one(_GIVEN[script][gender])
        ends = _FAMILY[script]
        return stem + s.one(ends[gender] if isinstance(ends, dict) else ends)
    if kind == "email":
        local, _, domain = entity.partition("@")
        *labels, top = domain.split(".")
        return "".join(_like(c, s) for c in local) + "@" + ".".join("".join(_like(c, s) for c in x) for x in labels) + "." + top
    if kind == "ipv4":
        return _ipv4_like(entity, s)
    if kind == "ipv6":
        return str(ipaddress.IPv6Address(":".join(f"{s.below(65535) + 1:x}" for _ in range(8))))
    if kind == "card":
        out = "".join(s.one(string.digits) if k else s.one("3456") for k in range(len(entity)))
        if luhn(entity) != luhn(out):
            good = next(d for d in string.digits if luhn(out[:-1] + d))
            out = out[:-1] + (good if luhn(entity) else str((int(good) + 1 + s.below(9)) % 10))
        return out
    if kind == "iban":
        out = entity[:2] + "00" + "".join(_like(c, s) for c in entity[4:])
        return out[:2] + iban_check(out) + out[4:]
    if kind == "phone":
        # North American numbers have no 0 or 1 in the fourth place.
        exchange = 3 if re.fullmatch(r"[2-9]\d\d[2-9]\d{6}", entity) else -1
        return entity[:1] + "".join(s.one("23456789" if k == exchange else string.digits) for k in range(1, len(entity)))
    if kind == "ssn":
        return f"{900 + s.below(100):03d}{s.below(100):02d}{s.below(10000):04d}"
    if re.fullmatch("[0-9a-f]{32,}", entity):
        return "".join(s.one("0123456789abcdef") for _ in entity)
    fixed = re.match(r"AKIA|ASIA|ghp_|gho_|xox[bpas]-|sk-|pk_live_|sk_live_", entity)
    keep = fixed.end() if fixed else 0
    return entity[:keep] + "".join(_like(c, s) for c in entity[keep:])


def written_like(mention: str, kind: str, new: str) -> str:
    """The surrogate in the layout and case of the mention."""
    if kind in ("card", "iban", "phone", "ssn"):
        before = sum(map(str.isalnum, mention)) - len(new)  # a phone's country code and trunk zero
        chars = iter("".join(filter(str.isalnum, mention))[:before] + new)
        return "".join(next(chars) if c.isalnum() else c for c in mention)
    if kind == "email" or (kind == "secret" and len(mention) >= 32) or ":" in kind:
        if mention.isupper():
            return new.upper()
        if kind == "email" and len(mention) == len(new):
            return "".join(n.upper() if c.isupper() else n for c, n in zip(mention, new, strict=True))
        if mention[:1].isupper():
            return new[:1].upper() + new[1:]
    return new


def replace(text: str, table: dict[tuple[str, str], str]) -> tuple[str, int]:
    """The text with every entity replaced, and their number."""
    out, at, n = [], 0, 0
    for start, end, kind, form in mentions(text):
        out += [text[at:start], written_like(text[start:end], kind, table[kind, form])]
        at, n = end, n + 1
    return "".join([*out, text[at:]]) if n else text, n


def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, prints, kinds, forms = [], [], [], []
        for i, x, t in zip(b.column("_id").to_pylist(), b.column("_x").to_pylist(), b.column("_t"), strict=True):
            for kind, form in {(k, f) for _, _, k, f in mentions(t.as_py())} if t.is_valid else ():
                ids.append(i)
                prints.append(x)
                kinds.append(kind)
                forms.append(form)
        yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field("_id").type), pa.array(prints, pa.int64()), pa.array(kinds, pa.string()), pa.array(forms, pa.string())], ["_id", "_x", "kind", "form"])


def _draw(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [surrogate(key, k, f, a) for k, f, a in zip(*(b.column(c).to_pylist() for c in ("kind", "form", "attempt")), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("form"), b.column("attempt"), pa.array(new, pa.string())], ["kind", "form", "attempt", "new"])

    return run


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, new) with a surrogate of its own for every distinct entity, the same for all
    genders that its mentions are of.

    Entities compete within their first type word (given, family, email and so on). A surrogate
    that is itself an entity of the corpus, or that another has, is drawn again."""
    spark = entities.sparkSession
    mentioned = scratch.written(entities.select("kind", "form").distinct(), "entities")
    part = lambda n: F.split_part(F.col("kind"), F.lit(":"), F.lit(n))
    named = part(3) != ""
    typed = mentioned.withColumns({"type": F.when(named, F.concat_ws(":", part(1), part(3))).otherwise(F.col("kind")), "gender": F.when(named & part(2).isin(MALE, FEMALE), part(2))})
    told = F.collect_set("gender")
    distinct = typed.groupBy("type", "form").agg(F.when(F.size(told) == 1, told[0]).otherwise(ANY).alias("gender"), F.max(named).alias("named"))
    whole = F.concat_ws(":", F.split_part("type", F.lit(":"), F.lit(1)), "gender", F.split_part("type", F.lit(":"), F.lit(2)))
    distinct = scratch.written(distinct.select("type", "form", F.when(F.col("named"), whole).otherwise(F.col("type")).alias("kind")), "distinct-entities")
    family = lambda c: F.split_part(F.col(c), F.lit(":"), F.lit(1))
    real = distinct.select(family("kind").alias("family"), F.col("form").alias("new")).distinct()
    schema = "kind string, form string, attempt int, new string"
    settled = spark.createDataFrame([], schema)
    open_, attempt = distinct.select("kind", "form"), 0
    while attempt == 0 or not open_.isEmpty():
        drawn = open_.withColumn("attempt", F.lit(attempt)).mapInArrow(_draw(key), schema).withColumn("family", family("kind"))
        taken = real if attempt == 0 else real.unionByName(settled.select(family("kind").alias("family"), "new"))
        free = drawn.join(taken.distinct(), ["family", "new"], "left_anti")
        least = free.groupBy("family", "new").agg(F.min(F.struct("kind", "form")).alias("owner"), F.first("attempt").alias("attempt"))
        good = least.select("owner.kind", "owner.form", "attempt", "new")
        settled = scratch.written(settled.unionByName(good), "surrogates")
        open_ = distinct.select("kind", "form").join(settled, ["kind", "form"], "left_anti")
        attempt += 1
    chosen = distinct.join(settled.select("kind", "form", "new"), ["kind", "form"]).select("type", "form", "new")
    return scratch.written(typed.join(chosen, ["type", "form"]).select("kind", "form", "new"), "assigned")


def _rewrite(n_keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for t, found in zip(b.column("_t"), b.column("_found"), strict=True):
                new, n = t.as_py(), 0
                if found.is_valid:
                    new, n = replace(new, {(e["kind"], e["form"]): e["new"] for e in found.as_py()})
                texts.append(new)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(n_keep)], pa.array(texts, pa.string()), pa.array(counts, pa.int64())], [*b.schema.names[:n_keep], "text", "n_entities"])

    return run


def pseudonymize(docs: DataFrame, key: bytes, keep: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``keep`` plus the text with surrogates and the number of entities replaced."""
    rows = docs.select(*keep, F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_x"), F.col(text_col).alias("_t"))
    id_type = docs.schema[id_col].dataType.simpleString()
    found = rows.select("_id", "_x", "_t").mapInArrow(_entities, f"_id {id_type}, _x bigint, kind string, form string")
    found = scratch.written(found, "mentions")
    named = found.distinct().join(assign(found, key), ["kind", "form"])
    of_doc = named.groupBy(F.col("_id").alias("_fid"), F.col("_x").alias("_fx")).agg(F.collect_list(F.struct("kind", "form", "new")).alias("_found"))
    met = rows.join(of_doc.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("_fid")) & (F.col("_x") == F.col("_fx")), "left")
    met = met.select(*keep, "_t", "_found")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in met.schema.fields[: len(keep)]] + ["text string, n_entities bigint"])
    return met.mapInArrow(_rewrite(len(keep)), schema)
