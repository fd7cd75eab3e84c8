"""Surrogates for personal data: keyed, of the same type, script and format, one to one.

A surrogate is the image of the original under a keyed permutation of all values of the same shape
(same length, same classes of characters in the same places, same separators).  A permutation never
sends two values to one, and every image has its original's shape, so distinct entities stay distinct and equal
ones equal over the whole corpus, with no table of replacements to build, ship or keep.  Each text is still checked
for collisions, and ``collisions`` checks a whole table.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tallyscape.llm.common import on_workers

TYPES = ("email", "card", "ip", "phone", "iban", "name")

_LATIN = "A-Za-z0-9À-ÖØ-öø-ɏ"
EMAIL = re.compile(
    rf"(?<![{_LATIN}._%+-])[._%+-]*([{_LATIN}][{_LATIN}._%+-]*@[{_LATIN}-]+(?:\.[{_LATIN}-]+)*\.[A-Za-z]{{2,}})"
)
IP = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d)")
CARD = re.compile(r"(?<![\dA-Za-z])\d(?:[ -]?\d){12,18}(?![\dA-Za-z])")
PHONE = re.compile(
    r"(?<![\w.+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}|\d{3}-\d{2}-\d{4}"
    r"|[2-9]\d{2} \d{3} \d{4}|0\d{2,4}[ -]\d{3,4}[ -]\d{3,4})(?![\w-])"
)
#: A bare row of digits is a number to call where a word says so.
CALLED = re.compile(r"(?i)(?<!\w)(?:tel|phone|telephone|mobile|cell|fax|call|dial|whatsapp)\b[.:]?(?: (?:at|on|me at|number|no\.?))?:? ?(\d{7,15})(?!\w|\.\d)")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")

#: Titles by gender, then given names by gender and script.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Mister", "г-н"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "г-жа"),
    "n": ("Dr", "Prof", "Professor"),
}
GIVEN = {
    ("m", "latin"): (
        "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Steven "
        "Andrew George Kevin Brian Edward Peter Henry Frank Hans Klaus Jürgen Wolfgang Stefan Karl Dieter Uwe Pierre Jean "
        "Jacques Michel Philippe Alain Nicolas François Luc Carlos Juan José Luis Miguel Antonio Javier Pedro Diego Pablo"
    ),
    ("f", "latin"): (
        "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Margaret Sandra Ashley Emily "
        "Anna Laura Emma Olivia Alice Grace Helen Ruth Ursula Monika Petra Sabine Claudia Andrea Heike Gisela Marie Sophie "
        "Camille Julie Nathalie Isabelle Claire Céline Chloé María Carmen Ana Isabel Lucía Elena Pilar Teresa Rosa Marta"
    ),
    ("m", "cyrillic"): "Александр Сергей Дмитрий Андрей Алексей Максим Иван Михаил Николай Владимир Павел Олег",
    ("f", "cyrillic"): "Анна Мария Елена Ольга Татьяна Наталья Ирина Светлана Екатерина Юлия Дарья Марина",
    ("m", "greek"): "Γιώργος Γιάννης Δημήτρης Κώστας Νίκος Παναγιώτης Βασίλης Χρήστος",
    ("f", "greek"): "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Αγγελική Γεωργία Δήμητρα",
}

#: Letters that take each other's place.
ALPHABETS = tuple(
    dict.fromkeys(
        x
        for low in ("aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòù", "äöü", "âêîôû", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ",
                    "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ")
        for x in (low, low.upper())
    )
)
_LISTED = {c: "".join(dict.fromkeys(a)) for a in ALPHABETS for c in a}
DIGITS, LEADING = "0123456789", "23456789"


def _kind(c: str) -> tuple | None:
    """What another letter must have in common with this one to take its place."""
    if c in _LISTED or not c.isalpha() or c == "ς":  # final sigma marks an end, not a letter of its own
        return None
    turns = len(c.upper()) == len(c.lower()) == 1 and c.upper().lower() == c.lower() and c.lower().upper() == c.upper()
    return ord(c) >> 8, unicodedata.category(c), unicodedata.name(c, "").split(" ")[0], turns


@lru_cache(maxsize=4096)
def letters_like(c: str) -> str | None:
    """The letters that may stand for this one: a listed alphabet, else those of its script, case and code page."""
    kind = _kind(c)
    if kind is None:
        return _LISTED.get(c)
    page = ord(c) >> 8 << 8
    return "".join(x for x in map(chr, range(page, page + 256)) if _kind(x) == kind)


def _one_of(words: Iterable[str]) -> str:
    """A group for whole words.  The look behind follows the first letter, so a search can skip to that."""
    rests: dict[str, list[str]] = {}
    for w in sorted(words, key=len, reverse=True):
        rests.setdefault(w[0], []).append(re.escape(w[1:]))
    return "(" + "|".join(f"{c}(?<!\\w{c})(?:{'|'.join(r)})" for c, r in rests.items()) + ")"


_NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_BLANK = r"[^\S\r\n]"
_TITLE = re.compile(_one_of(t for v in TITLES.values() for t in v) + rf"\.?(?={_BLANK})")
_GIVEN = {n: key for key, names in GIVEN.items() for n in names.split()}
_FIRST = re.compile(_one_of(_GIVEN) + rf"(?={_BLANK})")
#: A further part stands behind blanks, or right behind the point of an initial.
_PART = re.compile(rf"(?:{_BLANK}+|(?<=\.))({_NAME})")
#: What ends a name and is none.
_ENDS = {t for v in TITLES.values() for t in v} | {"Jr", "Sr", "II", "III", "IV", "PhD", "MD", "Esq"}


class Surrogates:
    """Keyed permutations; equal keys give equal surrogates."""

    def __init__(self, key: bytes):
        self.key = key
        self.memory: dict[tuple[str, str], str] = {}
        self.next: dict[str, str] = {}
        for (gender, script), names in GIVEN.items():
            order = sorted(names.split(), key=lambda n: self._digest(f"given|{gender}|{script}|{n}"))
            self.next.update(zip(order, order[1:] + order[:1], strict=True))  # one cycle: no name keeps its place

    def _digest(self, what: str) -> bytes:
        return hashlib.blake2b(what.encode(), key=self.key, digest_size=16).digest()

    def _rounds(self, x: list[int], radix: list[int], tweak: str, sign: int) -> list[int]:
        """Feistel rounds over the two halves: a permutation of all digit rows, or with -1 its inverse."""
        n, cut, x = len(x), len(x) // 2, list(x)
        for r in range(10)[::sign]:
            fixed, moved = (range(cut), range(cut, n)) if r % 2 else (range(cut, n), range(cut))
            seed = f"{tweak}|{r}|" + ",".join(str(x[i]) for i in fixed)
            for k, i in enumerate(moved):
                if k % 8 == 0:  # 16 bytes serve eight digits
                    drawn = self._digest(f"{seed}|{k}")
                add = int.from_bytes(drawn[2 * (k % 8) : 2 * (k % 8) + 2], "big")
                x[i] = (x[i] + sign * add) % radix[i]
        return x

    def shuffle(self, digits: list[int], radix: list[int], tweak: str) -> list[int]:
        """One step on a keyed cycle through all digit rows with these radices: one to one, nothing keeps its place."""
        x = self._rounds(digits, radix, tweak, 1)
        for i in range(len(x) - 1, -1, -1):
            x[i] = (x[i] + 1) % radix[i]
            if x[i]:
                break
        return self._rounds(x, radix, tweak, -1)

    def by_shape(self, value: str, kind: str, classes: list[str | None], walk: Callable[[str], bool] | None = None) -> str:
        """Permute the characters that have a class within their class; the rest stays.

        ``walk``: values that may not be a result are stepped over, which keeps the mapping one to one among
        the others.
        """
        places = [i for i, c in enumerate(classes) if c and len(c) > 1]
        if not places:
            return value
        radix = [len(classes[i]) for i in places]
        still = "".join("\0" if c and len(c) > 1 else value[i] for i, c in enumerate(classes))
        tweak = f"{kind}|{still}|" + "|".join(classes[i] for i in places)
        x = [classes[i].index(value[i]) for i in places]
        while True:
            x = self.shuffle(x, radix, tweak)
            out = list(value)
            for i, d in zip(places, x, strict=True):
                out[i] = classes[i][d]
            made = "".join(out)
            if walk is None or not walk(made):
                return made

    # ---- one function per type: value to surrogate ------------------------------------

    def email(self, value: str) -> str:
        low = small(value)
        end = low.rindex(".")
        made = self.by_shape(
            low, "email", [(DIGITS if c in DIGITS else letters_like(c)) if i < end else None for i, c in enumerate(low)]
        )
        return "".join(m.upper() if c != s else m for m, c, s in zip(made, value, low, strict=True))

    def _number(self, value: str, kind: str, keep: int = 0, last: int = 0) -> str:
        at = [i for i, c in enumerate(value) if c in DIGITS]
        inner = set(at[keep : len(at) - last])

        def digits(i: int) -> str | None:
            if i and value[i - 1] in DIGITS:
                return DIGITS
            return LEADING if value[i] in LEADING else None  # a group that begins with 0 or 1 goes on to

        return self.by_shape(value, kind, [digits(i) if i in inner else None for i in range(len(value))])

    def phone(self, value: str) -> str:
        """Separators, country code and the kind of each group's first digit stay."""
        country = re.match(r"\+\d{1,3}(?=\D)", value)
        return self._number(value, "phone", len(country[0]) - 1 if country else 1 if value[0] == "+" else 0)

    def card(self, value: str) -> str:
        """The first digit (the network) stays, and the check sum holds exactly where it held before."""
        body = [i for i, c in enumerate(value) if c.isdigit()]
        rest = luhn([int(value[i]) for i in body])
        # The check digit depends on the others: permute those with the remainder as part of the shape.
        made = self._number(value[: body[-1]], f"card{rest}", 1)
        digits = [int(c) for c in made if c.isdigit()]
        return made + str((rest - luhn([*digits, 0])) % 10) + value[body[-1] + 1 :]

    def ip(self, value: str) -> str:
        """An address of a special network stays in it; a public one stays public."""
        parts = [int(p) for p in value.split(".")]
        keep = special_parts(parts)
        free = [i for i in range(keep, 4) if 1 <= parts[i] <= 254]
        if not free:
            return value
        head = ".".join(str(p) if i not in free else "*" for i, p in enumerate(parts))
        x = [parts[i] - 1 for i in free]
        while True:  # steps past addresses of the other kind keep the mapping one to one
            x = self.shuffle(x, [254] * len(free), f"ip|{keep}|{head}")
            for i, d in zip(free, x, strict=True):
                parts[i] = d + 1
            if special_parts(parts) == keep:
                return ".".join(map(str, parts))

    def iban(self, value: str) -> str:
        """Country stays; the check digits are made anew if they were right, else kept."""
        plain = value.replace(" ", "")
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        country, check, inner = plain[:2], plain[2:4], plain[4:]

        def right(body: str) -> str:
            return f"{98 - iban_check(country + '00' + body):02d}"

        classes = [DIGITS if c in DIGITS else letters for c in inner]
        if check == right(inner):
            made = self.by_shape(inner, f"iban{country}", classes)
            check = right(made)
        else:  # what is wrong stays wrong, or it would meet the surrogate of a right one
            made = self.by_shape(inner, f"iban{country}{check}", classes, lambda x: right(x) == check)
        out = iter(country + check + made)
        return "".join(c if c == " " else next(out) for c in value)

    def given(self, value: str) -> str:
        return self.next.get(value) or self.family(value)

    def family(self, value: str) -> str:
        """Vowels for vowels, consonants for consonants of the same script and case; never a listed given name.

        A name all in capitals is the same name: its surrogate in capitals.
        """
        if value in self.next:
            return self.next[value]
        if len(value) > 1 and value.isupper():
            plain = re.sub(r"[^\W\d_]+", lambda m: m[0][0] + small(m[0][1:]), value)
            if plain != value and large(plain) == value:
                return large(self.given(plain))
        return self.by_shape(value, "name", [letters_like(c) for c in value], self.next.__contains__)

    def of(self, kind: str, value: str) -> str:
        made = self.memory.get((kind, value))
        if made is None:
            if len(self.memory) > 200_000:
                self.memory.clear()
            made = self.memory[kind, value] = getattr(self, kind)(value)
        return made


def small(value: str) -> str:
    """In small letters, place by place; letters whose case cannot be turned back stay."""
    return "".join(c.lower() if len(c.lower()) == 1 and c.lower().upper() == c else c for c in value)


def large(value: str) -> str:
    return "".join(c.upper() if len(c.upper()) == 1 and c.upper().lower() == c else c for c in value)


def special_parts(parts: list[int]) -> int:
    """How many parts name the special network of an address, 0 for a public one."""
    address = ipaddress.ip_address(".".join(map(str, parts)))
    if address.is_global or not (address.is_private or address.is_reserved):
        return 0
    if parts[0] in (0, 10, 127) or parts[0] >= 240:
        return 1
    if parts[0] in (169, 172) or parts[:2] in ([192, 168], [198, 18], [198, 19]):
        return 2
    return 3


def luhn(digits: list[int]) -> int:
    """Remainder of the Luhn sum, 0 for a valid number."""
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))) % 10


def iban_check(plain: str) -> int:
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


@lru_cache(maxsize=1)
def _words(text: str) -> Counter[str]:
    return Counter(re.findall(rf"(?<![\w.@+-]){_NAME}(?![\w@+-])", text))


def _is_word(text: str, value: str) -> bool:
    """Whether the text has it in small letters more often than as a name."""
    return _words(text)[value.lower()] > _words(text)[value]


def _people(text: str) -> Iterator[tuple[list[tuple[int, int]], bool]]:
    """The parts of each name behind a title or from a listed given name on, and whether it has a title.

    Initials and capitalised words make a name, and the last one is the family name.  A point ends it unless it
    is that of an initial.
    """
    for pattern, titled in ((_TITLE, True), (_FIRST, False)):
        for m in pattern.finditer(text):
            spans, at, after = [] if titled else [m.span(1)], m.end(), False
            # Scripts without case tell no name by its capital: there one part behind a title counts.
            while (part := _PART.match(text, at)) and part[1] not in _ENDS:
                caseless = titled and not spans and len(part[1]) <= 4 and unicodedata.category(part[1][0]) == "Lo"
                if not (part[1][0].isupper() or caseless):
                    break
                start, at = part.span(1)
                if after and at - start > 1 and _is_word(text, part[1]):
                    break  # a sentence that begins behind an initial
                spans.append((start, at))
                after = at - start == 1 and text[at : at + 1] == "."
                at += after
            # A bare letter at the end is no initial: "Mark I", unless it is all there is behind a title.
            while len(spans) > titled and spans[-1][1] - spans[-1][0] == 1 and text[spans[-1][1] : spans[-1][1] + 1] != ".":
                spans.pop()
            if len(spans) > (not titled):
                yield spans, titled


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, part) of what is found, by start, without overlaps; earlier types win."""
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(*m.span(1), "email", "email") for m in EMAIL.finditer(text)]
    if re.search(r"\d[\d .()-]{5,}\d", text):
        found += [
            (m.start(), m.end(), "ip", "ip") for m in IP.finditer(text) if all(int(p) < 256 and str(int(p)) == p for p in m[0].split("."))
        ]
        found += [(m.start(), m.end(), "card", "card") for m in CARD.finditer(text)]
        found += [(m.start(), m.end(), "phone", "phone") for m in PHONE.finditer(text)]
        found += [(*m.span(1), "phone", "phone") for m in CALLED.finditer(text)]
        found += [(m.start(), m.end(), "iban", "iban") for m in IBAN.finditer(text) if any(c.isdigit() for c in m[0][4:])]
    names: dict[str, str] = {}
    for spans, titled in _people(text):
        whole = [x for x in spans if x[1] - x[0] > 1]
        for span in spans:
            value = text[slice(*span)]
            part = "family" if span == spans[-1] or span != (whole or spans)[0] else "given"
            found.append((*span, "name", part))
            # Named again, a name is known by its title, or as it is no word of the text.
            if span in whole and (value in _GIVEN or (titled and span in whole[:2]) or not _is_word(text, value)):
                names[value] = part
    if names:  # the same person named again without title
        again = re.compile(r"(?<!\w)(" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)")
        found += [(m.start(), m.end(), "name", names[m[0]]) for m in again.finditer(text)]
    out: list[tuple[int, int, str, str]] = []
    rank = {t: i for i, t in enumerate(("email", "ip", "iban", "card", "phone", "name"))}
    taken: list[tuple[int, int, str, str]] = []
    for kind in sorted(rank, key=rank.get):
        ends = sorted((e for e in taken), key=lambda e: e[0])
        k = 0
        for e in sorted({x for x in found if x[2] == kind}):
            while k < len(ends) and ends[k][1] <= e[0]:
                k += 1
            if (k == len(ends) or ends[k][0] >= e[1]) and (not out or out[-1][2] != kind or out[-1][1] <= e[0]):
                out.append(e)
                taken.append(e)
    return sorted(out)


def replace(text: str, made: Surrogates) -> tuple[str, dict[str, int]]:
    """The text with surrogates, and how many of each type.

    Should two different entities of one type meet in one surrogate, which the permutations rule out, the later one
    takes the next free step of its own permutation.
    """
    counts = dict.fromkeys(TYPES, 0)
    pieces, at, back = [], 0, {}
    for start, end, kind, part in entities(text):
        value = text[start:end]
        new = made.of(part, value)
        same, plain = (small(value), small) if kind == "email" else (value, str)
        for _ in range(64):
            if back.setdefault((part, plain(new)), same) == same:
                break
            new = made.of(part, new)
        pieces += [text[at:start], new]
        counts[kind] += 1
        at = end
    return "".join([*pieces, text[at:]]), counts


def collisions(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """type, surrogate, originals: surrogates that stand for several originals, over all rows; none are expected.

    Originals are compared by digest and never leave the task as text.  Null and empty texts hold none, repeated
    rows add none; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Surrogates(hashlib.sha256(key.encode()).digest())
        for batch in batches:
            for t in batch.column(0).drop_null().to_pylist():
                met = set()
                for start, end, kind, part in entities(t):
                    value, new = t[start:end], made.of(part, t[start:end])
                    if kind == "email":
                        value, new = small(value), small(new)
                    met.add((kind, new, made._digest(f"original|{kind}|{value}")))
                if met:
                    columns = zip(*sorted(met), strict=True)
                    kinds = (pa.string(), pa.string(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["type", "surrogate", "original"]
                    )

    found = on_workers(docs.select(F.col(f"`{text}`"))).mapInArrow(run, "type string, surrogate string, original binary")
    count = found.distinct().groupBy("type", "surrogate").agg(F.count("*").alias("originals"))
    return count.filter("originals > 1")


def surrogates(docs: DataFrame, key: str, text: str = "text", *, counts: str = "n_") -> DataFrame:
    """``docs`` with surrogates in ``text``, and a count per type (n_email, n_card, ...).

    Null texts stay null and empty ones empty, with counts of 0.  Rows are independent of each other: no
    shuffle, and repeated rows get the same result.  Columns with the names of the counts are replaced.
    """
    names = [counts + t for t in TYPES]
    kept = [c for c in docs.columns if c not in names]
    base = docs.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Surrogates(hashlib.sha256(key.encode()).digest())
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                done = [(None, {}) if t is None else replace(t, made) for t in part.column(at).to_pylist()]
                columns = [*part.columns]
                columns[at] = pa.array([d[0] for d in done], pa.string())
                columns += [pa.array([d[1].get(t, 0) for d in done], pa.int32()) for t in TYPES]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    fields = [StructField(f.name, StringType()) if f.name == text else f for f in base.schema.fields]
    schema = StructType([*fields, *[StructField(n, IntegerType()) for n in names]])
    return on_workers(base).mapInArrow(run, schema)
