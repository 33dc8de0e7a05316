"""Personal data: every detected entity gets a keyed surrogate of its own kind.

Detection finds addresses, numbers, keys, credentials after their label and
names with a title (untitled names, dates of birth and street addresses are not found); the full or family name of such a person is found in the
rest of the document as well, and is the same entity. A surrogate
keeps what the kind shows: the shape of a number, its check digits, the script
and gender of a name. It is drawn by a keyed hash of the entity, so the same
entity has the same surrogate in every document (coreference) and nobody
without the key can undo it.

Two entities could draw the same surrogate, or one the name of another real
entity. So all distinct entities are drawn as one distributed table, surrogates
that meet are counted by it, all but one of those that meet draw again, and so
on until no two are equal (distinctness). Only documents with an entity take
part in joins; the others pass by untouched and unmoved.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from dataclasses import replace as replace_fields
from functools import reduce
from itertools import count
from operator import or_

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowbridge.common import column, stage

# Name of the session setting that holds the key; Spark hides the values of settings called secret.
KEY_SETTING = "spark.rowbridge.surrogate.secret"

# Titles by gender, and names to draw from, per script. Names of one list all fit its script and gender.
TITLES = {
    ("latin", "f"): ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra"),
    ("latin", "m"): ("Mr", "Herr", "Monsieur", "Señor", "Sr"),
    ("cyrillic", "f"): ("г-жа", "Г-жа", "госпожа", "Госпожа"),
    ("cyrillic", "m"): ("г-н", "Г-н", "господин", "Господин"),
    ("greek", "f"): ("κυρία", "Κυρία"),
    ("greek", "m"): ("κύριος", "Κύριος"),
    ("latin", "n"): ("Dr", "Prof"),
}
GIVEN = {
    ("latin", "f"): "Ada Alma Bella Carla Clara Dora Edda Elena Emma Eva Flora Greta Hanna Ida Irma Julia Klara Lena Lina Lotte Mara Marta Mia Nadia Nina Nora Olga Paula Rita Rosa Sara Sofia Stella Thea Vera Wanda".split(),
    ("latin", "m"): "Adam Albert Anton Arno Bruno Carl Cyril David Edgar Emil Erik Felix Frank Georg Hugo Ivan Jakob Jonas Karl Kurt Leo Linus Lukas Marco Max Nils Oskar Otto Paul Peter Ralf Robert Simon Theo Viktor Walter".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Зоя Ирина Лидия Мария Нина Ольга Полина Раиса Софья Тамара Юлия".split(),
    ("cyrillic", "m"): "Антон Борис Вадим Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел Роман Семён Тимур Фёдор".split(),
    ("greek", "f"): "Αθηνά Άννα Ελένη Ειρήνη Θάλεια Ιωάννα Μαρία Νίκη Σοφία Χλόη".split(),
    ("greek", "m"): "Αλέξης Γιάννης Δημήτρης Θωμάς Κώστας Λουκάς Νίκος Πέτρος Στέφανος Φώτης".split(),
    ("latin", "n"): "Alex Andrea Billie Chris Dana Eike Jona Kay Kim Luca Maxime Mika Noa Robin Sam Toni".split(),
}
FAMILY = {
    ("latin", "f"): "Abel Adler Bach Barlow Becker Berg Carver Costa Dahl Dalton Egger Ellis Faber Foster Garner Haas Hale Holt Keller Kern Lang Lowell Mann Marlow Moser Nagel Norden Pohl Porter Quinn Reed Roth Sander Thorn Vogel Weller".split(),
    ("cyrillic", "f"): "Белова Волкова Громова Жукова Зайцева Крылова Лебедева Морозова Орлова Павлова Романова Соколова Титова Фролова Чернова Шилова".split(),
    ("cyrillic", "m"): "Белов Волков Громов Жуков Зайцев Крылов Лебедев Морозов Орлов Павлов Романов Соколов Титов Фролов Чернов Шилов".split(),
}
FAMILY["greek", "f"] = "Γεωργίου Δούκα Ζερβού Κανέλλη Λιβανού Μελά Νικολάου Παππά Ράλλη Σταύρου".split()
FAMILY["greek", "m"] = "Γεωργίου Δούκας Ζερβός Κανέλλης Λιβανός Μελάς Νικολάου Παππάς Ράλλης Σταύρου".split()
FAMILY["latin", "m"] = FAMILY["latin", "n"] = FAMILY["latin", "f"]
DOMAINS = ("example.com", "example.net", "example.org")

_TITLE = {t: kind for kind, titles in TITLES.items() for t in titles}
# Letters of any script by case; a word of a name has inner capitals and apostrophes, but no possessive.
_UPPER = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isupper() and c.isalpha())
_LOWER = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.islower() and c.isalpha())
_MORE = r"(?:[^\W\d_]|['’](?=[^\W\d_]{2}))"
_WORD = rf"[{_UPPER}](?={_MORE}*[{_LOWER}]){_MORE}+"
_INITIAL = rf"[{_UPPER}]\.(?= ?[{_UPPER}])"
_CAPITALS = rf"[{_UPPER}](?:[{_UPPER}]|['’](?=[{_UPPER}]{{2}})){{2,}}"
_SMALL = r"(?:(?:von|van|vom|zu|zum|zur|der|den|ter|de|del|della|da|di|du|dos|la|le|al|el|bin|ibn) )"
_FULL_NAME = (
    rf"{_SMALL}{{0,3}}(?:(?:{_INITIAL} ?){{0,3}}{_WORD}(?:(?:[ -]{_SMALL}{{0,3}})(?:{_INITIAL} ?){{0,2}}{_WORD}){{0,2}}"
    rf"|{_CAPITALS}(?:[ -]{_CAPITALS}){{0,2}})"
)
_QUOTED_OR = r"""["']?\s{0,3}(?:=>|:=|[=:])\s{0,3}"""
_PATTERNS: tuple[tuple[str, re.Pattern], ...] = (
    ("pem", re.compile(r"-----BEGIN [A-Z0-9 ]{0,24}PRIVATE KEY-----([^-]+)-----END ", re.ASCII)),
    # Credentials that show by their beginning: provider prefixes, signed web tokens, bearer headers.
    ("token", re.compile(
        r"(?<![\w-])(?:((?:gh[pousr]_|glpat-|xox[abpr]-)[\w-]{16,})|(eyJ[\w-]{8,}\.[\w-]{4,}\.[\w-]{4,})|[Bb]earer (?=[\w.~+/-]*\d)([\w.~+/-]{16,}=*))",
        re.ASCII,
    )),
    ("ipv6", re.compile(r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]{0,38}::)(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4})(?![\w:])", re.ASCII)),
    ("mac", re.compile(r"(?<![\w:-])[0-9A-Fa-f]{2}(?:(?::[0-9A-Fa-f]{2}){5}|(?:-[0-9A-Fa-f]{2}){5})(?![\w:-])", re.ASCII)),
    ("email", re.compile(r"(?<![\w.+%-])[\w.+%-]{1,64}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w-])", re.ASCII)),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)", re.ASCII)),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", re.ASCII)),
    ("card", re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)", re.ASCII)),
    ("ssn", re.compile(r"(?<![\w-])(?!000|666|9\d\d)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])", re.ASCII)),
    ("phone", re.compile(r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){2,4}|(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}|(?<!\d )\d{3} \d{3} \d{4}(?! \d))(?![\w]|[.-]\d)", re.ASCII)),
    ("key", re.compile(r"(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w)", re.ASCII)),
    ("password", re.compile(r"(?i)(?<![a-z0-9])(?:password|passwd|pwd)" + _QUOTED_OR + r"""(?:"([^"\n]+)"|'([^'\n]+)'|((?:(?!&\w+=)[^\s,;'"<>]){4,}))""", re.ASCII)),
    # A credential without quotes has a digit, or prose after a colon would count.
    ("secret", re.compile(
        r"(?i)(?<![a-z0-9])(?:(?:access|auth|refresh|session|bearer|id|api|client)?[_ -]?(?:token|secret)|(?:api|access|secret|private|auth)[_ -]?key|secret[_ -]?access[_ -]?key)"
        + _QUOTED_OR
        + r"""(?:"([\w./+=~-]{6,})"|'([\w./+=~-]{6,})'|(?=[a-z_./+=~-]*\d)([\w./+=~-]{8,})(?![\w(\[]))""",
        re.ASCII,
    )),
    ("name", re.compile(r"(?<!\w)(" + "|".join(sorted(map(re.escape, _TITLE), key=len, reverse=True)) + rf")\.? (?:(?:Dr|Prof)\.? )*(?!(?:Dr|Prof)\b)({_FULL_NAME})(?!\w)")),
)
# Java's search for anything one of the patterns could match: a superset, and cheap. Most characters start none of it.
CANDIDATE = (
    r"(?=[@\d+A-ZГг])(?:@|\d{1,3}\.\d{1,3}\.\d|\d(?:[ -]?\d){12}|\d{3}-\d\d-\d{4}|\+\d|\d{3}[.)-] ?\d{3}[.-]\d{4}|A(?:KI|SI)A"
    r"|[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2}|(?:Mrs?|Ms|Miss|Frau|Herr|Madame|Monsieur|Mme|Señora?|Sra?)\.? "
    r"|(?:[Гг]-н|[Гг]-жа|[Гг]оспожа|[Гг]осподин)\.? )"
)
# As CANDIDATE, for what starts otherwise: key blocks, prefixed credentials, long addresses, spaced numbers, further titles.
CANDIDATE_TOO = (
    r"(?=[-:gxeBbDP\dΚκ])(?:-----BEGIN |:[0-9A-Fa-f]{0,4}:|-[0-9A-Fa-f]{2}-[0-9A-Fa-f]{2}-|gh[pousr]_|glpat-|xox[abpr]-|eyJ[\w-]{8}"
    r"|[Bb]earer |\d{3} \d{3} \d{4}|(?:Dr|Prof)\.? |[Κκ](?:ύριος|υρία)\.? )"
)
LABELS = ("passw", "pwd", "token", "secret", "key")
LABELLED = r"""(?i)(?:passwo?r?d|pwd|token|secret|key)["']?\s{0,3}[=:]"""
# Draws within the shape of an entity; every later draw is longer, so a free surrogate always comes.
SHAPED_DRAWS = 4
_SYMBOLS = "!#$%*+-=?^_~"


@dataclass(frozen=True)
class Entity:
    start: int
    end: int
    kind: str
    value: str  # as it stands
    traits: str  # what the surrogate must keep besides the shape; part of a name's identity
    person: str = ""  # of a name: the longest form the document has for it


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def _iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _is_ipv6(value: str) -> bool:
    """Whether it is an address, and not a word of code such as ``ab::cd``."""
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return False
    return any(c.isdigit() for c in value) and len(value) > 5


def _family(name: str) -> str:
    return re.split("[ -]", name)[-1]


def _people(text: str, titled: list[Entity]) -> list[Entity]:
    """The titled names and all other mentions of their people, each with the person's full name.

    A family name, or a name without title, means the fitting person introduced
    last before it, or else the first one after it.
    """

    def nearest(at: int, fitting: list[Entity]) -> Entity:
        return next((e for e in reversed(fitting) if e.start <= at), fitting[0])

    full = [e for e in titled if _family(e.value) != e.value]
    named: list[Entity] = []
    for e in titled:
        fitting = [f for f in full if f.traits == e.traits and _family(f.value) == e.value]
        named.append(replace_fields(e, person=nearest(e.start, fitting).value if fitting else e.value))
    words = sorted({w for e in titled for w in (e.value, _family(e.value))}, key=lambda w: (-len(w), w))
    if not words:
        return named
    taken = {at for e in titled for at in range(e.start, e.end)}
    for m in re.finditer(r"(?<!\w)(?:" + "|".join(map(re.escape, words)) + r")(?!\w)", text):
        if m.start() not in taken:
            said = m.group()
            same = [e for e in named if e.value == said or _family(e.person) == said]
            one = nearest(m.start(), same)
            named.append(Entity(m.start(), m.end(), "name", said, one.traits, one.person))
    return named


def find(text: str | None) -> list[Entity]:
    """Entities from left to right; where two overlap, the earlier kind of the list wins.

    Numbers of 13 to 19 digits count whether or not the Luhn digit is right: a
    mistyped card is as personal. IBANs need their check digits.
    """
    found: list[Entity] = []
    for kind, pattern in _PATTERNS:
        for m in pattern.finditer(text or ""):
            start, end = m.span(m.lastindex or 0) if kind != "name" else m.span(2)
            value, traits = m.string[start:end], ""
            if kind == "iban" and _iban_rest(value.replace(" ", "")) != 1:
                continue
            if kind == "ipv6" and not _is_ipv6(value):
                continue
            if kind == "phone" and not 7 <= len(_digits(value)) <= 15:
                continue
            if kind == "name":
                script, gender = _TITLE[m.group(1)]
                traits = f"{script} {gender}"
            if kind in ("password", "secret") and m.lastindex == 3:
                bare = value.rstrip(".)]}")
                end = start + len(bare) if len(bare) >= 4 else end
                value = m.string[start:end]
            if kind == "card":
                traits = "luhn" if _luhn(_digits(value)) else ""
            found.append(Entity(start, end, kind, value, traits))
    titled = [e for e in found if e.kind == "name"]
    if titled:
        found = [e for e in found if e.kind != "name"] + _people(text, titled)
    found.sort(key=lambda e: e.start)
    order = {kind: i for i, (kind, _) in enumerate(_PATTERNS)}
    kept: list[Entity] = []
    for e in found:
        while kept and kept[-1].end > e.start and order[e.kind] < order[kept[-1].kind]:
            kept.pop()
        if not kept or kept[-1].end <= e.start:
            kept.append(e)
    return kept


def canonical(kind: str, value: str) -> str:
    """What makes two mentions one entity: case and separators do not."""
    if kind == "email":
        return value.lower()
    if kind in ("card", "phone", "ssn"):
        return _digits(value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "ipv6":
        return ipaddress.IPv6Address(value).compressed
    if kind == "mac":
        return value.lower().replace("-", "").replace(":", "")
    return value


class _Draws:
    """Numbers drawn one after the other from a keyed hash."""

    def __init__(self, key: bytes, *parts: object) -> None:
        self.key, self.seed, self.turn, self.pool = key, "\x1f".join(map(str, parts)).encode(), 0, 0
        self.left = 1

    def below(self, n: int) -> int:
        if self.left < n << 16:
            block = hmac.new(self.key, self.seed + self.turn.to_bytes(4, "big"), hashlib.sha256).digest()
            self.turn, self.pool, self.left = self.turn + 1, int.from_bytes(block, "big"), 1 << 256
        self.pool, drawn = divmod(self.pool, n)
        self.left //= n
        return drawn


def _like(c: str, draws: _Draws) -> str:
    """A character of the same class and case."""
    if c.isdigit():
        return "0123456789"[draws.below(10)]
    if c.isascii() and c.isalpha():
        letter = "abcdefghijklmnopqrstuvwxyz"[draws.below(26)]
        return letter.upper() if c.isupper() else letter
    return c


def _unlike(c: str, draws: _Draws) -> str:
    """As ``_like``, but no character stays: letters of other scripts and symbols are drawn as well."""
    if c.isascii() and c.isalnum() or c.isdigit():
        return _like(c, draws)
    if c.isalpha():
        letters = "абвгдежзийклмнопрстуфхцчшщъыьэюя" if "Ѐ" <= c <= "ӿ" else "abcdefghijklmnopqrstuvwxyz"
        letter = letters[draws.below(len(letters))]
        return letter.upper() if c.isupper() else letter
    return _SYMBOLS[draws.below(len(_SYMBOLS))]


def surrogate(kind: str, entity: str, traits: str, attempt: int, key: bytes) -> str:
    """The canonical surrogate an entity draws at its ``attempt``-th try.

    All kinds but names keep the entity's length and character classes for the
    first ``SHAPED_DRAWS`` tries. From then on each try is one character longer
    (an address of numbers becomes one of the longer form), as a shape may have
    fewer surrogates than the corpus has entities.
    """
    draws = _Draws(key, kind, entity, traits, attempt)
    extra = max(0, attempt - SHAPED_DRAWS + 1)
    if kind == "email":
        local, _, domain = entity.partition("@")
        made = "".join(_like(c, draws) for c in local + "a" * extra)
        return f"{made}@{DOMAINS[draws.below(len(DOMAINS))]}"
    if kind == "ip":
        if extra:  # the prefix kept for documentation
            return "2001:db8:" + ":".join(f"{draws.below(1 << 16):x}" for _ in range(6))
        return ".".join(str(1 + draws.below(254)) for _ in range(4))
    if kind == "ipv6":  # 96 bits below the prefix kept for documentation
        return "2001:db8:" + ":".join(f"{draws.below(1 << 16):x}" for _ in range(6))
    if kind == "mac":  # locally administered: no maker has it
        return "02" + "".join("0123456789abcdef"[draws.below(16)] for _ in range(10 + 2 * extra))
    if kind == "token":
        prefix = re.match("gh[pousr]_|glpat-|xox[abpr]-|eyJ|", entity).group()
        return prefix + "".join(_like(c, draws) for c in entity[len(prefix) :] + "a" * extra)
    if kind == "pem":
        return "".join(_like(c, draws) for c in entity.rstrip() + "a" * extra) + entity[len(entity.rstrip()) :]
    if kind == "card":
        made = entity[0] + "".join(str(draws.below(10)) for _ in range(len(entity) - 2 + extra))
        right = next(d for d in "0123456789" if _luhn(made + d))
        wrong = str((int(right) + 1 + draws.below(9)) % 10)
        return made + (right if traits == "luhn" else wrong)
    if kind == "iban":
        body = "".join(_like(c, draws) for c in entity[4:] + "0" * extra)
        return f"{entity[:2]}{98 - _iban_rest(entity[:2] + '00' + body):02d}{body}"
    if kind == "ssn":
        made = f"{900 + draws.below(100)}{10 + draws.below(90)}{1000 + draws.below(9000)}"
        return made + "".join(str(draws.below(10)) for _ in range(extra))
    if kind == "phone":
        keep = max(0, min(2, len(entity) - 7))
        return entity[:keep] + "".join(str(draws.below(10)) for _ in range(len(entity) - keep + extra))
    if kind == "key":
        return entity[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[draws.below(32)] for _ in range(len(entity) - 4 + extra))
    if kind == "secret":
        lower_hex = not entity.strip("0123456789abcdef")
        made = (("0123456789abcdef"[draws.below(16)] if lower_hex else _like(c, draws)) for c in entity + "a" * extra)
        return "".join(made)
    if kind == "name":
        script, gender = traits.split(" ")
        parts = len(re.split("[ -]", entity))
        given, family = GIVEN[script, gender], FAMILY[script, gender]
        names = [given[draws.below(len(given))] for _ in range(parts - 1)] + [family[draws.below(len(family))]]
        # Beyond the names of the list a second family name keeps people apart.
        for _ in range(attempt // 8):
            names.append(family[draws.below(len(family))])
        return " ".join(names)
    return "".join(_unlike(c, draws) for c in entity + "a" * extra)


def shaped(kind: str, value: str, made: str, entity: str | None = None) -> str:
    """The canonical surrogate in the spelling of a mention: its separators, its case, the family name alone."""
    if kind == "name" and entity and value != entity:
        return " ".join(made.split(" ")[len(re.split("[ -]", entity)) - 1 :])
    if kind == "email":
        return made.upper() if value.isupper() else made
    if kind in ("card", "phone", "ssn"):
        left = iter(made)
        return "".join([next(left) if c.isdigit() else c for c in value] + [*left])
    if kind == "iban":
        left = iter(made)
        return "".join([c if c == " " else next(left) for c in value] + [*left])
    if kind == "mac":
        left = iter(made.upper() if value.isupper() else made)
        return "".join([c if c in ":-" else next(left) for c in value] + [*left])
    return made


_ENTITY = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("start", "end")]
    + [T.StructField(n, T.StringType()) for n in ("kind", "value", "canonical", "traits")]
)


def detect(docs: DataFrame, text: str = "text", name: str = "entities") -> DataFrame:
    """Add the entities of each text; a null text has none."""
    rest = [f for f in docs.schema.fields if f.name != name]
    place = [f.name for f in rest].index(text)
    schema = T.StructType([*rest, T.StructField(name, T.ArrayType(_ENTITY))])
    kinds = pa.list_(
        pa.struct([(f.name, pa.int32() if f.dataType == T.IntegerType() else pa.string()) for f in _ENTITY.fields])
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [
                    {"start": e.start, "end": e.end, "kind": e.kind, "value": e.value, "canonical": canonical(e.kind, e.person or e.value), "traits": e.traits}
                    for e in find(t.as_py())
                ]
                for t in batch.column(place)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kinds)], names=schema.names)

    return docs.select(*[column(f.name) for f in rest]).mapInArrow(run, schema)


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, traits, attempt) with ``made`` at that attempt."""
    schema = T.StructType([*entities.schema.fields, T.StructField("made", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("kind", "canonical", "traits", "attempt")), strict=True)
            made = [surrogate(*row, key) for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=schema.names)

    return entities.mapInArrow(run, schema)


def assign(mentions: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, traits, made) for the distinct entities of (kind, canonical, traits) mentions.

    No two entities of a kind share a surrogate, and none is a real entity of
    the corpus. One name with several traits is several entities.
    """
    identity = ["kind", "canonical", "traits"]
    entities = mentions.select(*identity).distinct()
    entities = stage(entities, "pii-entities")
    open_rows = stage(_drawn(entities.withColumn("attempt", F.lit(0)), key), "pii-drawn")
    done = None
    real = entities.select("kind", F.col("canonical").alias("made")).distinct()
    for attempt in count(1):
        # Surrogates fixed before win over new ones, then the smallest entity by a keyed order.
        first = open_rows.groupBy("kind", "made").agg(
            F.min(
                F.struct(
                    F.xxhash64(F.lit(key), "canonical", "traits").alias("h"), F.col("canonical").alias("c"), F.col("traits").alias("t")
                )
            ).alias("first")
        )
        winners = first.join(real, ["kind", "made"], "left_anti")
        if done is not None:
            winners = winners.join(done.select("kind", "made"), ["kind", "made"], "left_anti")
        won = stage(winners.select("kind", F.col("first.c").alias("canonical"), F.col("first.t").alias("traits"), "made"), "pii-won")
        done = won if done is None else done.unionByName(won)
        lost = open_rows.join(won.select(*identity), identity, "left_anti")
        if lost.head() is None:
            return done
        again = lost.select(*identity, F.lit(attempt).alias("attempt"))
        open_rows = stage(_drawn(again, key), "pii-drawn")


def replace(text: str, entities: list[dict], made: list[str]) -> str:
    """The text with each entity, given from left to right, in its surrogate's words."""
    parts, at = [], 0
    for e, m in zip(entities, made, strict=True):
        parts += [text[at : e["start"]], shaped(e["kind"], e["value"], m, e["canonical"])]
        at = e["end"]
    return "".join([*parts, text[at:]])


def _replaced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, texts, entities, made = batch.columns
        out = []
        for text, told, chosen in zip(texts, entities, made, strict=True):
            before, mentions = text.as_py(), told.as_py()
            places = {m["i"]: m["made"] for m in chosen.as_py() or ()}
            out.append(replace(before, mentions, [places[i] for i in range(len(mentions))]) if mentions else before)
        yield pa.RecordBatch.from_arrays([row, pa.array(out, pa.string()), entities], names=["row", "text", "entities"])


def session_key(spark: SparkSession) -> bytes:
    """The key of the session's setting. Without one it is empty: surrogates are then consistent, but anyone can redraw them."""
    return (spark.conf.get(KEY_SETTING, None) or "").encode()


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """(row: struct of the other columns, text, entities): texts with surrogates.

    ``entities`` lists what was replaced, as it stood in the input. A text
    without entities, null and empty ones included, comes out unchanged with an
    empty list. Repeated rows stay; columns of any name stay inside ``row``.
    """
    others = [column(f.name) for f in docs.schema.fields if f.name != text]
    given = docs.select(
        F.struct(F.lit(0).alias("_"), *others).alias("row"), column(text).cast("string").alias("text")
    )
    small = F.lower("text")
    labelled = reduce(or_, (small.contains(label) for label in LABELS)) & F.col("text").rlike(LABELLED)
    suspect = F.coalesce(F.col("text").rlike(CANDIDATE) | F.col("text").rlike(CANDIDATE_TOO) | labelled, F.lit(False))
    touched = detect(given.where(suspect)).withColumn("rid", F.monotonically_increasing_id())
    # Written once: its row numbers and detections are data from here on.
    touched = stage(touched, "pii-touched")
    mentions = touched.select("rid", F.posexplode("entities").alias("i", "e")).select(
        "rid", "i", F.col("e.kind").alias("kind"), F.col("e.canonical").alias("canonical"), F.col("e.traits").alias("traits")
    )
    chosen = stage(assign(mentions, key), "pii-surrogates")
    met = mentions.join(chosen, ["kind", "canonical", "traits"]).select("rid", F.struct("i", "made").alias("m"))
    per_row = met.groupBy("rid").agg(F.collect_list("m").alias("made"))
    joined = touched.join(per_row, "rid", "left").select("row", "text", "entities", "made")
    schema = T.StructType([joined.schema["row"], joined.schema["text"], joined.schema["entities"]])
    changed = joined.mapInArrow(_replaced, schema)
    clean = given.where(~suspect).withColumn("entities", F.array().cast(joined.schema["entities"].dataType))
    return clean.unionByName(changed)
