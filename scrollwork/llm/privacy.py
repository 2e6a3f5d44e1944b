"""Format-preserving pseudonyms for personal data.

Numbers are found by their form and validated (card numbers by their check digit, addresses by their octets, dates by
the calendar, and so on); the digits that are free within the format then go through a keyed Feistel permutation over
exactly the values of that format. Equal values have equal pseudonyms in all documents, different values different
ones, and whoever holds the key can reverse them. Check digits are computed anew, separators stay.

Letters outside ASCII go, in addresses of mail, to letters of their own kind among the 256 code points around them. A
password needs no digit; what follows `secret:` or `token:` does, as words follow these in prose, and what follows their `=`
does not. An IPv6 address keeps its form, so two forms of one address have two pseudonyms. Dates of one-digit days or
months stay among those of as many digits.

Defined results: a null text stays null; a text without personal data is unchanged; text that fails the
validation of one kind is tried as the later kinds and else left alone; only the ASCII digits 0-9 are digits, those of
other scripts stay as they are; every row is answered, repeated ones each; other columns stay as they are.
"""

from __future__ import annotations

import datetime
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, map_lean, table

#: Session setting with the key of the queries. Whoever knows the key can reverse every pseudonym.
KEY_SETTING = "spark.scrollwork.privacy.key"
#: Used by queries where that is unset, for tests and examples only: it is public.
EXAMPLE_KEY = b"a key that only the data owner knows"
ROUNDS = 10

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_EPOCH = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _EPOCH


class Feistel:
    """Keyed permutation of mixed-radix numbers: the digits are halved, and in turn each half is moved, modulo its
    size, by a keyed hash of the other."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = key, rounds

    def _move(self, kind: str, turn: int, other: int, size: int) -> int:
        return int.from_bytes(hmac.digest(self.key, f"{kind}/{turn}/{other}".encode(), "sha256"), "big") % size

    @staticmethod
    def _halves(radices: list[int]) -> tuple[int, int, int]:
        half = len(radices) // 2
        sizes = [1, 1]
        for k, r in enumerate(radices):
            sizes[k >= half] *= r
        return half, sizes[0], sizes[1]

    def permute(self, kind: str, digits: list[int], radices: list[int], back: bool = False) -> list[int]:
        half, size_a, size_b = self._halves(radices)
        a = b = 0
        for k, (d, r) in enumerate(zip(digits, radices, strict=True)):
            if k < half:
                a = a * r + d
            else:
                b = b * r + d
        kind = f"{kind}/{','.join(map(str, radices))}"
        sign = -1 if back else 1
        for turn in reversed(range(self.rounds)) if back else range(self.rounds):
            if turn % 2:
                a = (a + sign * self._move(kind, turn, b, size_a)) % size_a
            else:
                b = (b + sign * self._move(kind, turn, a, size_b)) % size_b
        out = []
        for k in reversed(range(len(radices))):
            if k < half:
                a, d = divmod(a, radices[k])
            else:
                b, d = divmod(b, radices[k])
            out.append(d)
        return out[::-1]

    def walk(self, kind: str, digits: list[int], radices: list[int], valid: Callable[[list[int]], bool], back: bool = False) -> list[int]:
        """Permutes within the valid values: steps on until one is met."""
        digits = self.permute(kind, digits, radices, back)
        while not valid(digits):
            digits = self.permute(kind, digits, radices, back)
        return digits


def luhn_digit(digits: list[int]) -> int:
    """The check digit that follows these."""
    total = sum(d if k % 2 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
    return -total % 10


def _put(form: str, digits: list[int]) -> str:
    """`form` with its ASCII digits replaced in turn."""
    rest = iter(digits)
    return "".join(str(next(rest)) if c in _DIGITS else c for c in form)


def _numbers(form: str) -> list[int]:
    return [int(c) for c in form if c in _DIGITS]


def _card(f: Feistel, form: str, back: bool) -> str | None:
    d = _numbers(form)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or d[0] == 0:
        return None
    head = f.walk("card", d[:-1], [10] * (len(d) - 1), lambda x: x[0] > 0, back)
    return _put(form, [*head, luhn_digit(head)])


def _iban(f: Feistel, form: str, back: bool) -> str | None:
    own = form.replace(" ", "")
    as_number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(own) <= 34 or as_number(own[4:] + own[:4]) % 97 != 1 or not 2 <= int(own[2:4]) <= 98:
        return None
    rest = _characters(f, "iban", own[4:], back)
    made = own[:2] + f"{98 - as_number(rest + own[:2] + '00') % 97:02d}" + rest
    turn = iter(made)
    return "".join(c if c == " " else next(turn) for c in form)


def _ssn(f: Feistel, form: str, back: bool) -> str | None:
    d = _numbers(form)
    area = lambda x: x[0] * 100 + x[1] * 10 + x[2]
    valid = lambda x: area(x) not in (0, 666) and x[0] < 9 and any(x[3:5]) and any(x[5:])
    return _put(form, f.walk("ssn", d, [10] * 9, valid, back)) if valid(d) else None


def _phone(f: Feistel, form: str, back: bool) -> str | None:
    d = _numbers(form)
    head = re.match(r"\+([0-9]{1,3})[ .-]", form)
    own = d[len(head[1]) :] if head else d[-10:]
    code = d[: len(d) - len(own)]
    if not 7 <= len(own) <= 12 or len(code) > 3:
        return None
    return _put(form, [*code, *f.permute("phone", own, [10] * len(own), back)])


def _address(f: Feistel, form: str, back: bool) -> str | None:
    d = [int(x) for x in form.split(".")]
    if max(d) > 255 or any(len(x) > 1 and x[0] == "0" for x in form.split(".")):
        return None
    return ".".join(map(str, f.walk("ip", d, [256] * 4, lambda x: x[0] > 0, back))) if d[0] else None


def _date(f: Feistel, form: str, back: bool) -> str | None:
    parts = re.split(r"[^0-9]", form)
    first = len(parts[0]) == 4
    y, m, d = (parts if first else parts[::-1])
    # month first only where it cannot be day first, and then so is the pseudonym
    month_first = not first and int(m) > 12
    if month_first:
        m, d = d, m
    if (len(m) < 2 or len(d) < 2) and "0" in (m[0], d[0]):
        return None  # neither padded nor plain
    try:
        day = datetime.date(int(y), int(m), int(d)).toordinal() - _EPOCH
    except ValueError:
        return None
    if not 0 <= day < _DAYS:
        return None
    split = lambda n: [n // 256, n % 256]
    join = lambda x: 256 * x[0] + x[1]
    date = lambda x: datetime.date.fromordinal(_EPOCH + join(x))
    short = len(m) < 2 or len(d) < 2
    alike = lambda x: not short or (len(str(x.month)), len(str(x.day))) == (len(m), len(d))
    valid = lambda x: join(x) < _DAYS and (not month_first or date(x).day > 12) and alike(date(x))
    made = date(f.walk("date", split(day), [_DAYS // 256 + 1, 256], valid, back))
    text = [f"{made.year:04d}", str(made.month) if short else f"{made.month:02d}", str(made.day) if short else f"{made.day:02d}"]
    marks = re.findall(r"[^0-9]", form)
    a, b, c = text if first else [text[1], text[2], text[0]] if month_first else text[::-1]
    return f"{a}{marks[0]}{b}{marks[1]}{c}"


def _characters(f: Feistel, kind: str, own: str, back: bool, alphabets: tuple[str, ...] = (_DIGITS, _LOWER, _UPPER)) -> str:
    """Digits become digits, lower-case letters lower-case letters, upper-case ones upper-case ones, letters outside ASCII
    letters around them; the rest stays."""
    sets = [next((s for s in alphabets if c in s), _around(c) if c > "\x7f" else "") for c in own]
    free = [k for k, s in enumerate(sets) if s]
    if not free:
        return own
    made = f.permute(kind, [sets[k].index(own[k]) for k in free], [len(sets[k]) for k in free], back)
    out = list(own)
    for k, d in zip(free, made, strict=True):
        out[k] = sets[k][d]
    return "".join(out)


@lru_cache(maxsize=4096)
def _around(c: str) -> str:
    """Letters of the same kind as one outside ASCII, among the 256 code points around it; nothing for other characters."""
    kind, block = unicodedata.category(c), ord(c) & ~0xFF
    return "".join(x for x in map(chr, range(max(block, 0x80), block + 0x100)) if unicodedata.category(x) == kind) if kind[0] == "L" else ""


def _email(f: Feistel, form: str, back: bool) -> str | None:
    local, _, domain = form.partition("@")
    return f"{_characters(f, 'email', local, back)}@{domain}"


def _secret(f: Feistel, form: str, back: bool) -> str | None:
    head = re.match(r"[A-Za-z_-]+\s*[=:]\s*[\"']?", form)[0]
    own = form[len(head) :]
    needs_digit = ":" in head and head[0] in "sStT"
    has_digit = lambda text: any(c in _DIGITS for c in text)
    if needs_digit and not has_digit(own):
        return None
    if _HEX.fullmatch(own):
        made = f.walk("hex", [int(c, 16) for c in own], [16] * len(own), lambda x: not needs_digit or min(x) < 10, back)
        return head + "".join(f"{d:x}" for d in made)
    made = _characters(f, "secret", own, back)
    while _HEX.fullmatch(made):  # those are permuted among themselves
        made = _characters(f, "secret", made, back)
    return head + made


_HEX = re.compile(r"[0-9a-f]+")


def _address6(f: Feistel, form: str, back: bool) -> str | None:
    groups = [g for g in form.split(":") if g]
    if "::" in form and (len(groups) < 3 or not any(c in _DIGITS for c in form)):
        return None  # as in names of code
    try:
        ipaddress.IPv6Address(form)
    except ValueError:
        return None
    return _characters(f, "ip6", form, back, (_DIGITS, "abcdef", "ABCDEF"))


#: Kind, what makes a pseudonym (None: not valid, left alone), and form. Earlier kinds win where forms overlap.
KINDS: tuple[tuple[str, Callable[[Feistel, str, bool], str | None], str], ...] = (
    ("secret", _secret, r"(?<![A-Za-z])(?i:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?[A-Za-z0-9_+/-]{8,}(?![A-Za-z0-9_+/-]|[\w.%+-]*@)"),
    ("email", _email, r"(?<![^\W_])[^\W_][\w.%+-]*@[^\W_][\w-]*(?:\.[^\W_][\w-]*)+"),
    ("iban", _iban, r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ip", _address, r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])"),
    ("ip6", _address6, r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:])|(?<![0-9A-Za-z:.])[0-9A-Fa-f]{1,4}::(?:[0-9A-Fa-f]{1,4}:){1,5}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    ("date", _date, r"(?<![0-9])(?:[0-9]{4}(?P<mark>[-/.])[0-9]{1,2}(?P=mark)[0-9]{1,2}|(?<![0-9][-/.])[0-9]{1,2}(?P<mark2>[-/.])[0-9]{1,2}(?P=mark2)[0-9]{4})(?![0-9])"),
    ("ssn", _ssn, r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("phone", _phone, r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9+])\+[0-9]{1,3}(?:[ .-]\(?[0-9]{1,5}\)?){2,4}(?![0-9])|(?<![0-9+])\+[0-9]{11,13}(?![0-9])"),
    ("card", _card, r"(?<![0-9.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"),
)
_ANY = re.compile("|".join(f"(?P<{name}>{form})" for name, _, form in KINDS))
#: For text that a kind refused: the kinds after it.
_LATER = {name: re.compile("|".join(f"(?P<{n}>{form})" for n, _, form in KINDS[k + 1 :]) or r"(?!)") for k, (name, _, _) in enumerate(KINDS)}
_MAKE = {name: make for name, make, _ in KINDS}
#: No form is without one of these, but for secrets without a digit, which follow a name and a mark.
_SIGN, _NAMED = re.compile(r"[0-9@]"), re.compile(r"(?i:word|wd|secret|token|key)\s*[=:]")


def replace_text(text: str, feistel: Feistel, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms (or, with `back`, with what they stand for), and how many of each kind."""
    found: dict[str, int] = {}
    if not _SIGN.search(text) and not (("=" in text or ":" in text) and _NAMED.search(text)):
        return text, found

    out, done, match = [], 0, _ANY.search(text)
    while match:
        kind, end = match.lastgroup, match.end()
        made = _MAKE[kind](feistel, match[0], back)
        if made is not None:
            found[kind] = found.get(kind, 0) + 1
            out += [text[done : match.start()], made]
            done = end
            match = _ANY.search(text, end)
            continue
        later = _LATER[kind].search(text, match.start())
        match = later if later and later.start() < end else _ANY.search(text, end)
    return "".join([*out, text[done:]]), found


def session_key(spark: SparkSession) -> bytes:
    """The key that the session names, else the public example."""
    key = spark.conf.get(KEY_SETTING, None)
    return key.encode() if key else EXAMPLE_KEY


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", counts: str | None = None, back: bool = False) -> DataFrame:
    """`docs` with pseudonyms in its texts; `n_chars` follows the text where there is one. `counts`: a column more, a
    map from kind to number. No shuffle."""
    columns = docs.columns
    if counts:
        counts = fresh(columns, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for batch in batches:
            made = [(None, {}) if t is None else replace_text(t, feistel, back) for t in batch.column(text).to_pylist()]
            put = {text: [m[0] for m in made]}
            if "n_chars" in columns:
                put["n_chars"] = [len(m[0]) if m[1] else n for m, n in zip(made, batch.column("n_chars").to_pylist(), strict=True)]
            arrays = [pa.array(put[c], batch.schema.field(c).type) if c in put else batch.column(c) for c in columns]
            if counts:
                arrays.append(pa.array([list(m[1].items()) for m in made], pa.map_(pa.string(), pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *([counts] if counts else [])])

    schema = docs.withColumn(counts, F.create_map(F.lit(""), F.lit(0).cast("long"))).schema if counts else docs.schema
    return map_lean(docs, run, schema)


def op7_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), session_key(spark), counts="kinds")
    total = F.aggregate(F.map_values("kinds"), F.lit(0).cast("long"), lambda n, x: n + x)
    return made.select("doc_id", "text", total.alias("n_replaced"), F.array_join(F.array_sort(F.map_keys("kinds")), ",").alias("kinds"))
