"""Surrogates for personal data.

Detected entities are replaced by keyed surrogates of the same type, script and format:
a card number stays a valid card number, a name keeps its script, hyphens and its bearer's
gender.  A name is found behind a title, and then wherever the document has it again.  A surrogate depends on the key and the entity alone, so mentions of one
entity, in any document and any spelling that normalises alike, stay one entity.
All distinct entities are checked against each other: a surrogate that another entity
has, or that is itself an entity of the corpus, is drawn again.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrove.llm.common import in_batches, rows_of, stored, text_bytes

ATTEMPTS = 64
#: Attempts after which an address or a phone number that is still open gets a wider format.
WIDER = 8
_JUNK = r"[\s.\-#*$%&!]"
#: Titles that tell a bearer's gender.
TITLES = {"m": ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "κύριος"),
          "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа", "κυρία")}
#: Syllables of given names by script and gender, and of surnames by script.
GIVEN = {("latin", "m"): ("Al", "Ben", "Dan", "Ed", "Jon", "Leo", "Max", "Tom"), ("latin", "f"): ("Ana", "Bea", "Eva", "Ida", "Lea", "Mia", "Nora", "Tea"),
         ("cyrillic", "m"): ("Борис", "Глеб", "Иван", "Лев", "Олег", "Пётр"), ("cyrillic", "f"): ("Анна", "Вера", "Дарья", "Ирина", "Ольга", "Софья"),
         ("greek", "m"): ("Άρης", "Νίκος", "Πάνος", "Φώτης"), ("greek", "f"): ("Άννα", "Ελένη", "Ζωή", "Μαρία")}
SYLLABLES = {"latin": ("ba", "co", "du", "fe", "gi", "ha", "ko", "lu", "me", "ni", "po", "ra", "se", "ti", "vo", "we"),
             "cyrillic": ("ба", "ве", "го", "ди", "жу", "за", "ко", "лу", "ме", "ни", "по", "ра", "се", "ти", "фо", "ша"),
             "greek": ("βα", "γε", "δι", "ζο", "θα", "κε", "λι", "μο", "να", "πε", "ρι", "σο", "τα", "φε", "χι", "ψο")}
#: Endings of surnames that a surrogate keeps, and feminine ones with their masculine (folded, so the last sigma is a plain one).
FEMININE = {"ова": "ов", "ева": "ев", "ёва": "ёв", "ина": "ин", "ына": "ын", "ская": "ский", "цкая": "цкий"}
ENDINGS = {"cyrillic": (*FEMININE.values(), "ой", "ий", "ко", "ук"), "greek": ("οσ", "όσ", "ησ", "ήσ", "ασ", "άσ", "ου", "ού", "η", "ή", "α", "ά")}
#: Letters of initials.
INITIALS = {"latin": "ABCDEFGHJKLMNPRSTVW", "cyrillic": "АБВГДЕИКЛМНОПРСТ", "greek": "ΑΒΓΔΕΖΗΘΚΛΜΝΠΣΤΦ"}
#: The country codes of two digits; 1 and 7 have one, all others three.
_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_GENDER = {title.lower(): gender for gender, titles in TITLES.items() for title in titles}
_TITLE = "|".join(sorted((t for titles in TITLES.values() for t in titles), key=len, reverse=True))
_CAPITAL = r"[^\W\d_a-zà-öø-ÿа-яёα-ωά-ώ]"
_PART = rf"(?:{_CAPITAL}['\u2019])?{_CAPITAL}[^\W\d_]+"
_FULL = rf"{_PART}(?:-{_PART})*"
_INITIAL = rf"{_CAPITAL}\.(?:-?{_CAPITAL}\.)*"

_EMAIL = re.compile(r"(?<![\w.%+\-])[\w.%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}")
_DIGITS = re.compile(
    rf"(?P<phone>\+\d{{1,3}}{_JUNK}{{0,6}}\(?\d{{3}}\)?{_JUNK}{{0,6}}\d{{3}}{_JUNK}{{0,6}}\d{{4}}(?!\d)|(?<!\d)\(\d{{3}}\){_JUNK}{{0,6}}\d{{3}}{_JUNK}{{0,6}}\d{{4}}(?!\d))"
    r"|(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d))"
    r"|(?P<ssn>(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-]))"
    r"|(?P<card>(?<![\w])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){2}[ \-]\d{1,7})(?![\w]))"
    r"|(?P<key>(?<![A-Za-z0-9])(?:[0-9a-f]{40}|[0-9A-F]{40})(?![A-Za-z0-9]))"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))")
# Phone numbers in free groups (``_dialled`` counts their digits): behind + or 00, with a leading 0,
# then the fixed national forms 3-3-4 and Spain's nine digits.
_GAP = r"[ \xa0\u202f.\-\u2013/()]{1,3}"
_ALONE = r"(?<![\w.,+/=\-])"
_APART = r"(?<![0-9][ \xa0\u202f])"
_ENDS = r"(?!\w|[.,\-/][0-9])"
_DIALLED = re.compile(
    rf"(?P<abroad>(?:(?<![0-9+])\+|{_ALONE}00)[ \xa0]?[1-9][0-9]{{0,14}}(?:(?![ \xa0][.\-\u2013][ \xa0]){_GAP}[0-9]{{1,14}}){{0,7}}(?![0-9]))"
    rf"|(?P<area>{_ALONE}{_APART}(?<!ISBN )(?<!ISBN: )\(?0[1-9][0-9]{{0,11}}(?:{_GAP}[0-9]{{1,11}}){{0,6}}(?!\w))"
    rf"|(?P<fixed>{_ALONE}(?:(?:1[.\-])?[0-9]{{3}}[.\-/][0-9]{{3}}[.\-][0-9]{{4}}|{_APART}(?:(?:1[ \xa0])?[0-9]{{3}}[ \xa0][0-9]{{3}}[ \xa0.\-][0-9]{{4}}"
    r"|[6-9][0-9]{2}(?:[ \xa0\-][0-9]{2}){3}(?![ \xa0][0-9])|[89][0-9][ \xa0\-][0-9]{3}(?:[ \xa0\-][0-9]{2}){2}(?![ \xa0][0-9])"
    rf"|[6-9][0-9]{{2}}(?:[ \xa0\-][0-9]{{3}}){{2}}(?![ \xa0][0-9]))){_ENDS})")
_DATE = re.compile(r"\(?[0-9]{1,2}([./\- ])[0-9]{1,2}\1(?:[0-9]{4}|[0-9]{2})(?!\1?[0-9])")
_GROUP = re.compile(r"[0-9]+")
_TRUNK = re.compile(r"\(0\)")
_SECRET = re.compile(r"""(?i)(?:token|password|passwd|secret|api[_-]?key)["'#*$%&!]{0,3}\s*[:=][#*$%&!]{0,3}\s*["']?([a-z0-9_\-/+]{8,})""")
_PERSON = re.compile(rf"(?<!\w)({_TITLE})\.?[ \xa0]+((?:{_INITIAL}[ \xa0]?|{_FULL}[ \xa0]){{0,2}}{_FULL})(?!\w)")
_TOKEN = re.compile(rf"(?P<initials>{_INITIAL})|{_FULL}")
_LETTERS = re.compile(r"[^\W\d_]+")
_NAMED = re.compile(rf"(?:{_CAPITAL}['\u2019])?({_CAPITAL}[^\W\d_]+)")
_ACCESS = re.compile(r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])")
# What a text must hold for the patterns to be tried at all, and how far a match reaches around a digit in it.
_TITLE_ENDS = tuple(t + end for titles in TITLES.values() for t in titles for end in (" ", "\xa0", "."))
_SECRET_WORDS = ("token", "passw", "secret", "api")
_DIGIT_RUN = re.compile(r"\d+")
_REACH = 64
_BLANK = re.compile(r"\s")


def luhn_digit(digits: str) -> str:
    """The check digit behind the given ones."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _iban_rest(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _valid(kind: str, value: str) -> bool:
    if kind == "ip":
        return all(int(part) < 256 for part in value.split("."))
    if kind == "card":
        digits = re.sub(r"\D", "", value)
        return luhn_digit(digits[:-1]) == digits[-1]
    if kind == "iban":
        return _iban_rest(value.replace(" ", "")) == 1
    return True


def _dialled(m: re.Match[str]) -> int:
    """Where the phone number of a ``_DIALLED`` match ends, or -1: whole groups, 7 to 15 digits abroad, 9 to 12 behind a leading 0."""
    if m.lastgroup == "fixed":
        return m.end()
    abroad = m.lastgroup == "abroad"
    groups = [(g[0], g.end()) for g in _GROUP.finditer(m.string, m.start(), m.end())]
    if abroad and m[0].startswith("00"):
        groups[0] = groups[0][0][2:] or groups.pop(1)[0], groups[0][1]
        if len(groups) == 1:                        # a long number with zeros in front
            return -1
    head = groups[0][0]
    least, most = (7, 15) if abroad else (9, 12)
    if abroad and head[0] in "17":
        least = most = 11
    elif abroad and len(head) < 2 or not abroad and _DATE.match(m.string, m.start()):
        return -1
    n, end = 0, -1
    for i, (digits, at) in enumerate(groups):
        trunk = digits == "0" and m.string[at:at + 1] == ")"
        if n + len(digits) > most + trunk or (i > 1 and len(digits) < 2 and not trunk and groups[i - 1][0] != "0"):
            break
        n, end = n + len(digits) - (trunk and abroad), at
    return end if n >= least else -1


def detect(text: str) -> list[tuple[int, int, str]]:
    """``start, end, type`` of entities in order, none inside another; name tokens carry script and gender."""
    found: list[tuple[int, int, str]] = []
    for start, end in _around_signs(text):
        found += [(*m.span(), "email") for m in _EMAIL.finditer(text, start, end)]
    for start, end in _around_digits(text):
        failed = []
        for m in _DIGITS.finditer(text, start, end):
            if _valid(m.lastgroup, m[0]):
                found.append((*m.span(), m.lastgroup))
            else:
                failed.append(m.span())
        for m in _DIALLED.finditer(text, start, end):
            until = _dialled(m)
            if until >= 0 and not any(a < until and m.start() < b for a, b in failed):
                found.append((m.start(), until, "phone"))
    if "AKIA" in text:
        found += [(*m.span(), "key") for m in _ACCESS.finditer(text)]
    lower = text.lower()
    if any(word in lower for word in _SECRET_WORDS):
        found += [(*m.span(1), "secret") for m in _SECRET.finditer(text)]
    if any(end in text for end in _TITLE_ENDS):
        found += _names(text)
    out: list[tuple[int, int, str]] = []
    for span in sorted(found, key=lambda s: (s[0], -s[1])):
        if not out or span[0] >= out[-1][1]:
            out.append(span)
    return out


def _names(text: str) -> list[tuple[int, int, str]]:
    """Names behind titles, part by part, and then every other capitalised mention of these parts in the text."""
    found: list[tuple[int, int, str]] = []
    known: dict[str, str] = {}
    for m in _PERSON.finditer(text):
        gender, until = _GENDER[m[1].lower()], m.end(2)
        for token in _TOKEN.finditer(text, m.start(2), until):
            if token["initials"]:
                found += [(*c.span(), f"initial-{script(c[0])}") for c in _LETTERS.finditer(text, *token.span())]
                continue
            role = "surname" if token.end() == until else f"given-{gender}"
            for part in _NAMED.finditer(text, *token.span()):
                kind = f"{role}-{script(part[1])}"
                found.append((*part.span(1), kind))
                known.setdefault(part[1].casefold(), kind)
                known.setdefault(normal(kind, part[1]), kind)
    if known:
        for word in _LETTERS.finditer(text):
            if not word[0][0].islower():
                folded = word[0].casefold()
                kind = known.get(folded) or known.get(masculine(folded), "")
                if kind and (folded in known or kind.startswith("surname-cyrillic")):
                    found.append((*word.span(), kind))
    return found


def _around_signs(text: str) -> Iterator[tuple[int, int]]:
    """The stretches without white space that hold an ``@``."""
    at = text.find("@")
    while at >= 0:
        start = max(text.rfind(c, 0, at) for c in " \n\t") + 1
        blank = _BLANK.search(text, at)
        end = blank.start() if blank else len(text)
        yield start, end
        at = text.find("@", end)


def _around_digits(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that hold every digit with its surroundings; no match with a digit is cut by their ends."""
    start = end = -1
    for m in _DIGIT_RUN.finditer(text):
        if m.start() - _REACH > end:
            if end >= 0:
                yield start, end
            start = max(0, m.start() - _REACH)
        end = min(len(text), m.end() + _REACH)
    if end >= 0:
        yield start, end


def script(name: str) -> str:
    c = name[0]
    if "Ѐ" <= c <= "ӿ":
        return "cyrillic"
    if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
        return "greek"
    return "latin" if unicodedata.name(c, "").startswith("LATIN") else "other"


def masculine(folded: str) -> str:
    """The masculine form of a folded surname, by which its bearers' mentions are one entity."""
    for ending, other in FEMININE.items():
        if folded.endswith(ending) and len(folded) > len(ending) + 1:
            return folded[:-len(ending)] + other
    return folded


def feminine(folded: str) -> str:
    for other, ending in FEMININE.items():
        if folded.endswith(ending):
            return folded[:-len(ending)] + other
    return folded


@lru_cache(maxsize=4096)
def _neighbours(c: str) -> str:
    """The letters of a character's kind in its block of 64 code points, itself among them."""
    base, kind = ord(c) & ~63, unicodedata.category(c)
    return "".join(x for x in map(chr, range(base, base + 64)) if unicodedata.category(x) == kind)


def normal(kind: str, value: str) -> str:
    """What mentions of one entity have in common."""
    if kind == "phone":
        digits = re.sub(r"\D", "", value)
        if value[0] == "+" or value.startswith("00") or len(digits) == 11 and digits[0] == "1":
            return "+" + re.sub(r"\D", "", _TRUNK.sub("", value)).removeprefix("00")
        return digits
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "surname-cyrillic":
        return masculine(value.casefold())
    return value.casefold() if kind != "ip" else value


class Stream:
    """Keyed pseudo-random choices for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int) -> None:
        self.seed = f"{kind}\0{value}\0{attempt}".encode("utf-8", "surrogatepass")
        self.key, self.block, self.state, self.left = key, 0, 0, 0

    def below(self, n: int) -> int:
        if self.left < 1 << 64:
            data = hashlib.blake2b(self.block.to_bytes(4, "big") + self.seed, key=self.key).digest()
            self.state, self.left, self.block = int.from_bytes(data, "big"), 1 << 512, self.block + 1
        value, self.state, self.left = self.state % n, self.state // n, self.left // n
        return value

    def like(self, c: str) -> str:
        """A character of the same kind."""
        for kind in ("0123456789", "aeiou", "AEIOU", "bcdfghjklmnpqrstvwxyz", "BCDFGHJKLMNPQRSTVWXYZ"):
            if c in kind:
                return kind[self.below(len(kind))]
        return "e" if c.isalpha() and c.islower() else "E" if c.isalpha() else c


def _code_digits(digits: str) -> int:
    """How many digits the country code in front has."""
    if digits[0] in "17":
        return 1
    return 2 if digits[:2] in _CODES else 3


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The normalised surrogate of a normalised entity."""
    draw = Stream(key, kind, value, attempt)
    family = kind.partition("-")[0]
    if family in ("given", "surname"):
        letters = kind.rpartition("-")[2]
        if letters == "other":              # letters of the same block, and more of them where these run out
            return "".join(pool[draw.below(len(pool))] for pool in map(_neighbours, value + value[-1] * (attempt // WIDER)))
        syllables = SYLLABLES[letters]
        if family == "given":
            pool = GIVEN[letters, kind.split("-")[1]]
            return (pool[draw.below(len(pool))] + "".join(syllables[draw.below(16)] for _ in range(1 + attempt // 2))).casefold()
        new = "".join(syllables[draw.below(16)] for _ in range(5 + attempt // 2))
        ending = next((e for e in ENDINGS.get(letters, ()) if value.endswith(e)), "")
        return new[:-1] + ending if ending else new
    if family == "initial":
        pool = (INITIALS.get(kind.partition("-")[2]) or _neighbours(value)).replace(value.upper(), "")
        return pool[draw.below(len(pool))]
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        kept = 2 if labels[-2] == "example" else 1
        host = ["".join(map(draw.like, label)) for label in labels[:-kept]]
        longer = "".join(SYLLABLES["latin"][draw.below(16)] for _ in range(attempt // 2))
        return longer + "".join(map(draw.like, local)) + "@" + ".".join(host + labels[-kept:])
    if kind == "ip":
        low = {1: (1, 9), 2: (10, 90), 3: (100, 155)}
        if attempt >= 2 * WIDER:
            return ".".join(str(1 + draw.below(254)) for _ in range(4))
        if attempt >= WIDER:
            return ".".join(str(low[n][0] + draw.below(low[n][1])) for n in (min(3, len(part) + 1) for part in value.split(".")))
        return ".".join(str(low[len(part)][0] + draw.below(low[len(part)][1])) for part in value.split("."))
    if kind == "phone":
        kept = 1 + _code_digits(value[1:]) if value[0] == "+" else 1 if value[0] == "0" else 0
        if attempt >= WIDER:
            head = "+" + str(1 + draw.below(9)) if value[0] == "+" else value[:kept]
            return head + "".join(map(draw.like, value[len(head):]))
        body = value[:kept] + "".join(map(draw.like, value[kept:]))
        return body[:-7] + (value[-7:-4] if value[-7:-4] == "555" else body[-7:-4]) + body[-4:]
    if kind == "card":
        body = value[0] + "".join(map(draw.like, value[1:-1]))
        return body + luhn_digit(body)
    if kind == "iban":
        body = "".join(map(draw.like, value[4:]))
        return f"{value[:2]}{98 - _iban_rest(value[:2] + '00' + body):02d}{body}"
    if kind in ("key", "secret"):
        head = "akia" if value.startswith("akia") else ""
        pool = "0123456789abcdef" if re.fullmatch("[0-9a-f]+", value) else "abcdefghijklmnopqrstuvwxyz0123456789"
        return head + "".join(c if c in "_-/+" else pool[draw.below(len(pool))] for c in value[len(head):])
    return "".join(map(draw.like, value))


def shaped(kind: str, mention: str, new: str) -> str:
    """A normalised surrogate in the spelling of the mention: its separators and its case."""
    if kind == "phone":
        given = iter(new.removeprefix("+"))
        zeros = 2 if mention.startswith("00") and new[0] == "+" else 0
        return mention[:zeros] + re.sub(r"\(0\)|\d", lambda m: next(given) if m[0] != "(0)" or new[0] != "+" else m[0], mention[zeros:])
    if kind in ("card", "ssn", "iban"):
        given = iter(new)
        return "".join(next(given) if c.isalnum() else c for c in mention)
    if kind.startswith(("given", "surname")):
        if kind == "surname-cyrillic" and masculine(mention.casefold()) != mention.casefold():
            new = feminine(new)
        if new[-1] == "σ" and not mention.isupper():
            new = new[:-1] + "ς"
        return new.upper() if mention.isupper() and len(mention) > 1 else new[0].upper() + new[1:]
    if kind.startswith("initial"):
        return new.upper()
    return new.upper() if mention.isupper() else new


def replaced(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, int]:
    """The text with surrogates, and how many mentions it had."""
    out, at, n = [], 0, 0
    for start, end, kind in detect(text):
        mention = text[start:end]
        value = normal(kind, mention)
        out += [text[at:start], shaped(kind, mention, surrogate(key, kind, value, attempts.get((kind, value), 0)))]
        at, n = end, n + 1
    return ("".join([*out, text[at:]]), n) if n else (text, 0)


def _draws(key: bytes, names: tuple[str, ...], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for kind, value, attempt in rows_of(batches, *names):
                yield kind, value, attempt, surrogate(key, kind, value, attempt)

        yield from in_batches(rows(), schema)

    return run


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind, value, attempt`` of the entities whose first surrogates collide, from distinct ``kind, value``.

    A round draws for all that are open.  An entity keeps its draw if no entity has that
    value, none kept it in an earlier round and no smaller open value drew it too.

    A full format gives way to a wider one of the same type: emails and names grow longer, after
    ``WIDER`` attempts the parts of an IP address get a digit more and after as many again any
    value from 1 to 254, and a phone number keeps neither country code nor 555 (its count of
    digits stays).  So an address stays open only where the corpus holds most of all addresses there are.
    """
    schema = pa.schema([("kind", pa.string()), ("value", pa.string()), ("attempt", pa.int32()), ("new", pa.string())])
    names = "kind string, value string, attempt int, new string"
    taken, open_, later = entities.select("kind", F.col("value").alias("new")), entities.withColumn("attempt", F.lit(0)), None
    for attempt in range(ATTEMPTS):
        drawn = stored(open_.select("kind", "value", "attempt").mapInArrow(_draws(key, ("kind", "value", "attempt"), schema), names), "drawn")
        first = drawn.groupBy("kind", "new").agg(F.min("value").alias("value"))
        kept = stored(drawn.join(first, ["kind", "new", "value"], "left_semi").join(taken, ["kind", "new"], "left_anti"), "kept")
        open_ = stored(drawn.join(kept, ["kind", "value"], "left_anti").select("kind", "value", F.lit(attempt + 1).alias("attempt")), "open")
        if attempt:
            later = kept if later is None else later.unionByName(kept)
        if open_.isEmpty():
            break
        taken = taken.unionByName(kept.select("kind", "new"))
    else:
        raise ValueError(f"more distinct entities than surrogates of their formats after {ATTEMPTS} attempts")
    return (later if later is not None else open_).select("kind", "value", "attempt")


def replace_entities(docs: DataFrame, *, key: bytes) -> DataFrame:
    """All columns of ``docs`` with ``text`` replaced, plus ``n_replaced``, a row per document.

    Null texts stay null and empty ones empty, with nothing replaced.  Null ids and
    repeated rows are treated like others.  A column ``n_replaced`` of ``docs`` is
    replaced; no other name clashes.  Numbers that are no valid card, address or account stay as they are.
    An empty table gives an empty one.  ``key``: 16 to 64 secret bytes.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")
    docs = docs.drop("n_replaced").withColumn("text", F.expr("make_valid_utf8(text)"))
    # an id is no key: what a text's entities need goes with the digest of the text
    keyed = docs.select(F.struct("*").alias("row"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    mention_schema = pa.schema([("digest", pa.binary()), ("kind", pa.string()), ("value", pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for digest, text in rows_of(batches, "digest", "text"):
                text = text_bytes(text).decode()
                for kind, value in dict.fromkeys((kind, normal(kind, text[a:b])) for a, b, kind in detect(text)):
                    if not kind.startswith("initial"):              # letters need not differ from others
                        yield digest, kind, value

        yield from in_batches(rows(), mention_schema)

    texts = keyed.where("digest is not null").select("digest", F.col("row.text").alias("text"))
    mentions = stored(texts.mapInArrow(find, "digest binary, kind string, value string"), "mentions")
    again = assign(mentions.select("kind", "value").distinct(), key)
    # few documents name an entity that was drawn again; each gets the attempts of its own entities
    cell = F.struct("kind", "value", "attempt")
    own = stored(mentions.join(again, ["kind", "value"]).groupBy("digest").agg(F.collect_set(cell).alias("again")), "again")
    joined = keyed.join(own, "digest", "left").select("row", "again")
    plain = docs.columns
    schema = docs.schema.simpleString()[len("struct<"):-1] + ",n_replaced:bigint"

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(plain, batch.column("row").flatten(), strict=True))
            new_texts, counts = [], []
            for text, cells in zip(columns["text"].to_pylist(), batch.column("again").to_pylist(), strict=True):
                attempts = {(c["kind"], c["value"]): c["attempt"] for c in cells or ()}
                new, n = (None, 0) if text is None else replaced(text, key, attempts)
                new_texts.append(new)
                counts.append(n)
            columns["text"] = pa.array(new_texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array(counts, pa.int64())], names=[*plain, "n_replaced"])

    return joined.mapInArrow(rewrite, f"struct<{schema}>")
