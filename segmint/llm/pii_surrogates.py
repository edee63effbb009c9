"""Surrogates for personal data: keyed, of the same type and format, distinct and coreferent.

1. Detection: e-mail addresses, phone numbers, IPv4 addresses, payment cards and other long numbers,
   social security numbers, IBANs, secrets, and names behind a title or a known given name.
2. Every distinct entity of the corpus gets one surrogate: a keyed digest of its type, canonical form
   and attempt fills the entity's own template, so the digits, letters, case, length, script,
   check digits, address range and the gender of a given name stay.
3. Collision checks over the whole corpus: a surrogate that equals an entity of the corpus, or that
   another entity has, is refused, and the entity tries again.  So different entities stay different, and
   one entity is the same everywhere (a surname alone like the surname of a full name, a phone
   number with or without its country code, an address in any case).
4. The spans are replaced from the table of accepted surrogates.

Defined cases: null text stays null and has no entity; overlapping finds go to the earlier and longer
one; rows with the same id and text are replaced alike; null doc_ids stay; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.llm.common import join_unique, written

EMAIL = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
SECRET = re.compile(r"\b(?:AKIA[0-9A-Z]{16}|(?:sk|pk|ghp|gho|xoxb)[-_][A-Za-z0-9_-]{16,}|[0-9a-f]{32,}|[0-9A-F]{32,})\b")
IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
IPV4 = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d)")
PHONE = re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)"
                   r"|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![\w.-])\d{3}([-. ])\d{3}\1\d{4}(?![\w-])")
SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
NUMBER = re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w)")
#: Titles and their gender, and given names by script and gender.
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f", "Sr": "m",
          "Sra": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Dr": "", "Prof": "", "г-н": "m", "г-жа": "f"}
GIVEN = {
    ("latin", "m"): "James John Robert Michael William David Thomas Daniel Paul Peter Hans Karl Jean Pierre Luis"
                    " Carlos Juan Miguel Jorge Lucas".split(),
    ("latin", "f"): "Mary Anna Linda Susan Sarah Karen Laura Emma Julia Marie Claire Sophie Greta Heike Elena"
                    " Carmen Lucia Isabel Rosa Paula".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Дмитрий Сергей Николай Михаил Андрей Павел Виктор".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Юлия Вера".split(),
}
#: Parts of made surnames; as many as are needed are joined, so there is always another surname.
SURNAME = {"latin": "al bren cor dar el fen gor hal ing jor kel lan mor nor ost per quin ros stan tor ul ven wil yor".split(),
           "cyrillic": "ал бор вер гор дар ел зор кал лев мар нов ор пол рад сев тим ур фад хар чер".split()}
GENDER = {name.lower(): g for (_, g), names in GIVEN.items() for name in names}
_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][^\W\d_]+(?:[-’'][^\W\d_]+)?"
_KNOWN = "|".join(n for names in GIVEN.values() for n in names)
NAME = re.compile(rf"(?<!\w)(?:(?P<title>{'|'.join(TITLES)})\.?[ ](?P<first>{_CAP})(?:[ ](?P<last>{_CAP}))?"
                  rf"|(?P<given>{_KNOWN})[ ](?P<family>{_CAP}))(?!\w)")
KINDS = ("email", "secret", "iban", "ipv4", "phone", "ssn", "number")


def script(text: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in text) else "latin"


def luhn(digits: str) -> bool:
    return sum(d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
               for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def canonical(kind: str, surface: str) -> str:
    """What two mentions of one entity have in common."""
    if kind == "email":
        return surface.lower()
    if kind in ("phone", "ssn", "number"):
        digits = re.sub(r"\D", "", surface)
        return digits[1:] if kind == "phone" and len(digits) == 11 and digits[0] == "1" else digits
    if kind == "iban":
        return surface.replace(" ", "")
    if kind == "ipv4":
        return ".".join(str(int(x)) for x in surface.split("."))
    return surface.lower() if kind.startswith(("given", "surname")) else surface


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the entities of a text, in order, without overlaps."""
    if not text:
        return []
    found: list[tuple[int, int, str]] = []
    if "@" in text:
        found += [(*m.span(), "email") for m in EMAIL.finditer(text)]
    if any(d in text for d in "0123456789"):
        found += [(*m.span(), "secret") for m in SECRET.finditer(text)]
        found += [(*m.span(), "iban") for m in IBAN.finditer(text) if _mod97(m[0].replace(" ", "")) == 1]
        found += [(*m.span(), "ipv4") for m in IPV4.finditer(text) if all(int(x) < 256 for x in m[0].split("."))]
        for kind, pattern in (("phone", PHONE), ("ssn", SSN), ("number", NUMBER)):
            found += [(*m.span(), kind) for m in pattern.finditer(text)]
    for m in NAME.finditer(text):
        parts = [(g, m.span(g), m[g]) for g in ("first", "last", "given", "family") if m[g]]
        gender = TITLES.get(m["title"] or "", "")
        for k, (_, span, word) in enumerate(parts):
            own = GENDER.get(word.lower(), gender) or "m"
            given = len(parts) == 2 and k == 0
            found.append((*span, f"given:{own}:{script(word)}" if given else f"surname:{script(word)}"))
    found.sort(key=lambda x: (x[0], -x[1], KINDS.index(x[2]) if x[2] in KINDS else 9))
    out, end = [], 0
    for s, e, kind in found:
        if s >= end:
            out.append((s, e, kind, canonical(kind, text[s:e])))
            end = e
    return out


class _Stream:
    """Keyed numbers below a bound."""

    def __init__(self, key: bytes, *parts: str):
        self.key, self.name, self.count, self.left = key, "\0".join(parts).encode(), 0, 0
        self.bits = 0

    def below(self, n: int) -> int:
        while self.left < 64:
            block = hmac.new(self.key, self.name + self.count.to_bytes(4, "big"), hashlib.sha256).digest()
            self.bits |= int.from_bytes(block, "big") << self.left
            self.left, self.count = self.left + 256, self.count + 1
        x = self.bits & (2**64 - 1)
        self.bits >>= 64
        self.left -= 64
        return x % n

    def like(self, text: str, hexadecimal: bool = False) -> str:
        """Signs of the same classes: digits, letters of either case and script; others stay."""
        out = []
        for c in text:
            if hexadecimal and c in "0123456789abcdef":
                out.append("0123456789abcdef"[self.below(16)])
            elif hexadecimal and c in "ABCDEF":
                out.append("0123456789ABCDEF"[self.below(16)])
            elif c.isdigit():
                out.append(str(self.below(10)))
            elif c.isalpha():
                low = chr((0x430 if script(c) == "cyrillic" else 97) + self.below(26))
                out.append(low.upper() if c.isupper() else low)
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The surrogate that ``entity`` (canonical form) proposes at an attempt, in canonical form."""
    s = _Stream(key, kind, entity, str(attempt))
    if kind == "email":
        local, _, domain = entity.rpartition("@")
        # one domain has one surrogate; its last label stays
        name, _, top = domain.rpartition(".")
        return f"{s.like(local)}{s.like('a' * (attempt // 4))}@{_Stream(key, 'domain', domain).like(name)}.{top}"
    if kind == "phone" and len(entity) == 10:
        return f"{2 + s.below(8)}{s.below(100):02d}{2 + s.below(8)}{s.below(10**6):06d}"
    if kind == "phone":
        return entity[:2] + s.like(entity[2:])
    if kind == "ssn":
        area = 1 + s.below(898)
        return f"{area + (area >= 666):03d}{1 + s.below(99):02d}{1 + s.below(9999):04d}"
    if kind == "ipv4":
        a, b, c, d = map(int, entity.split("."))
        fixed = 1 if a in (10, 127) else 2 if (a, b) == (192, 168) or a == 172 and 16 <= b < 32 else 0
        new = [s.below(256) for _ in range(3)] + [1 + s.below(254)]
        if not fixed:
            new[0] = [x for x in range(1, 224) if x not in (10, 127, 172, 192)][s.below(219)]
        return ".".join(map(str, [a, b, c, d][:fixed] + new[fixed:]))
    if kind == "number":
        new = entity[0] + s.like(entity[1:-1])
        last = next(d for d in "0123456789" if luhn(new + d))
        return new + (last if luhn(entity) else str((int(last) + 1 + s.below(9)) % 10))
    if kind == "iban":
        new = entity[:2] + "00" + s.like(entity[4:])
        return f"{entity[:2]}{98 - _mod97(new):02d}{new[4:]}"
    if kind == "secret":
        head = re.match(r"AKIA|(?:sk|pk|ghp|gho|xoxb)[-_]", entity)
        n = head.end() if head else 0
        return entity[:n] + s.like(entity[n:], hexadecimal=not head)
    if kind.startswith("given"):
        _, gender, letters = kind.split(":")
        names = GIVEN[letters, gender]
        # more given names than the list has: joined ones
        return "-".join(names[s.below(len(names))] for _ in range(1 + attempt // 8)).lower()
    parts = SURNAME[kind.split(":")[1]]
    return "".join(parts[s.below(len(parts))] for _ in range(3 + attempt // 8))


def render(kind: str, surface: str, new: str) -> str:
    """The surrogate in the format of the mention."""
    if kind in ("phone", "ssn", "number", "iban"):
        kept = [c for c in surface if (c.isalnum() if kind == "iban" else c.isdigit())]
        full = "".join(kept[:len(kept) - len(new)]) + new
        it = iter(full)
        return "".join(next(it) if (c.isalnum() if kind == "iban" else c.isdigit()) else c for c in surface)
    if kind == "email":
        return new.upper() if surface.isupper() else new
    if kind.startswith(("given", "surname")):
        return new.upper() if surface.isupper() else "-".join(x.capitalize() for x in new.split("-"))
    return new


def _detected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, who = [], []
        for k, text in enumerate(b.column("text").to_pylist()):
            own = detect(text)
            rows += own
            who += [k] * len(own)
        yield pa.RecordBatch.from_arrays(
            [b.column("rk").take(pa.array(who, pa.int64())), pa.array([r[0] for r in rows], pa.int32()),
             pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string()),
             pa.array([r[3] for r in rows], pa.string())], names=["rk", "start", "end", "kind", "entity"])


def assign(entities: DataFrame, key: bytes, make=surrogate) -> DataFrame:
    """(kind, entity, surrogate) for distinct ``entities(kind, entity)``: collision-free rounds."""
    entities = written(entities.select("kind", "entity").distinct(), "entities")
    # names share one space whatever their gender; the other kinds have one each
    space = F.regexp_replace("kind", ":.*", "")
    everything = entities.select(space.alias("space"), F.col("entity").alias("surrogate")).distinct()
    open_, taken, attempt = entities, None, 0
    while not open_.isEmpty():
        def propose(batches: Iterator[pa.RecordBatch], attempt=attempt) -> Iterator[pa.RecordBatch]:
            for b in batches:
                new = [make(key, k, e, attempt) for k, e in zip(b.column("kind").to_pylist(),
                                                                     b.column("entity").to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("entity"), pa.array(new, pa.string())],
                                                 names=["kind", "entity", "surrogate"])

        new = (open_.select("kind", "entity").mapInArrow(propose, "kind string, entity string, surrogate string")
               .withColumn("space", space))
        first = new.groupBy("space", "surrogate").agg(F.min(F.struct("entity", "kind")).alias("w"))
        won = (first.join(everything, ["space", "surrogate"], "left_anti")
               .select("space", "surrogate", F.col("w.entity").alias("entity"), F.col("w.kind").alias("kind")))
        if taken is not None:
            won = won.join(taken.select("space", "surrogate"), ["space", "surrogate"], "left_anti")
        won = written(won, "accepted")
        taken = won if taken is None else taken.unionByName(won)
        open_ = written(open_.join(won.select("kind", "entity"), ["kind", "entity"], "left_anti"), "open")
        attempt += 1
    return (taken if taken is not None else entities.withColumn("surrogate", F.lit(""))
            ).select("kind", "entity", "surrogate")


def _replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for b in batches:
        texts, places = [], []
        for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
            out, at, size, own = [], 0, 0, []
            for x in sorted(spans or [], key=lambda x: x["start"]):
                new = render(x["kind"], text[x["start"]:x["end"]], x["surrogate"])
                out += [text[at:x["start"]], new]
                size += x["start"] - at
                own.append({"kind": x["kind"], "start": size, "end": size + len(new)})
                size += len(new)
                at = x["end"]
            texts.append(text if not own else "".join(out) + text[at:])
            places.append(own)
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string()), pa.array(places, place)],
                                         names=["doc_id", "text", "replaced"])


def replace_pii(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text with surrogates, replaced (kind, start, end in the new text) of every row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("rk", F.unhex(F.md5(F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"))))
    spans = written(docs.select("rk", "text").mapInArrow(
        _detected, "rk binary, start int, end int, kind string, entity string").distinct(), "spans")
    spans = spans.withColumn("who", F.concat_ws(":", "kind", "entity"))
    freq = spans.groupBy("who").agg(F.count(F.lit(1)).alias("freq"))
    table = (assign(spans, key).withColumn("who", F.concat_ws(":", "kind", "entity"))
             .select("who", "surrogate").join(freq, "who"))
    with_new = (join_unique(spans.drop("entity"), table, "who", "freq", [F.col("rk"), F.col("start")])
                .groupBy("rk").agg(F.collect_list(F.struct("start", "end", "kind", "surrogate")).alias("spans")))
    # merged whatever the sizes, so that the plan is the same at every scale
    return (docs.join(with_new.hint("merge"), "rk", "left").select("doc_id", "text", "spans")
            .mapInArrow(_replaced, "doc_id long, text string, replaced array<struct<kind:string,start:int,end:int>>"))
