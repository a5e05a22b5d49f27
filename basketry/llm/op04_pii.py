"""Personal data: format-preserving pseudonyms by keyed Feistel permutations.

Finders propose numbers, dates and addresses; validators keep those that are
real (Luhn digit, mod-97 check, calendar, octets, numbering plan). A valid value
is mapped to an integer of its format's domain, permuted by a keyed Feistel
network (cycle-walking keeps the result inside the domain) and written back in
the same format, with its check digits recomputed. The permutation depends on
key and format alone, so equal values keep equal pseudonyms in all documents,
different ones stay different, separators and lengths stay, and who holds the
key can turn a pseudonym back.

Defined results: NULL text stays NULL and empty text empty, with nothing found;
invalid candidates are left as they are; repeated rows get the same result; an
empty table gives an empty result; other columns are ignored. Whole texts are
read, however long.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import map_batches, table

ROUNDS = 10
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY
DEFAULT_KEY = b"basketry pseudonyms"   # for the contract query; production passes a secret
DIGITS, HEX = "0123456789", "0123456789abcdef"
SMALL, LARGE = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Feistel:
    """Keyed permutations of the integers below n, one for each (n, name)."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, name: bytes, n: int, i: int, half: int, bits: int) -> int:
        data = b"%b|%d|%d|%d" % (name, n, i, half)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=(bits + 7) // 8).digest()) & (1 << bits) - 1

    def _once(self, x: int, n: int, name: bytes, order) -> int:
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        left, right = x >> bits, x & (1 << bits) - 1
        for i in order:
            left, right = right, left ^ self._round(name, n, i, right, bits)
        return right << bits | left

    def permute(self, x: int, n: int, name: str, allowed: Callable[[int], bool] = lambda _: True) -> int:
        """The image of x below n; walks on until it is inside the domain and allowed (x itself must be)."""
        while True:
            x = self._once(x, n, name.encode(), range(ROUNDS))
            if x < n and allowed(x):
                return x

    def restore(self, x: int, n: int, name: str, allowed: Callable[[int], bool] = lambda _: True) -> int:
        """The inverse of :meth:`permute`."""
        while True:
            # the network is its own inverse with the rounds turned round
            x = self._once(x, n, name.encode(), range(ROUNDS - 1, -1, -1))
            if x < n and allowed(x):
                return x


def luhn_digit(digits: str) -> str:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _fill(template: str, digits: str) -> str:
    """The template with its digits replaced one by one."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in template)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


class Pseudonyms:
    """Finds and replaces personal data in texts; ``restore`` turns pseudonyms back."""

    def __init__(self, key: bytes):
        self.feistel = Feistel(key)
        self.move = self.feistel.permute
        self.seen: dict[tuple[str, str], tuple[str, int] | None] = {}

    def backwards(self) -> Pseudonyms:
        """The same formats with the inverse permutations."""
        other = Pseudonyms(b"")
        other.feistel = self.feistel
        other.move = self.feistel.restore
        return other

    def card(self, text: str) -> str | None:
        digits = _only_digits(text)
        if not 13 <= len(digits) <= 19 or digits[0] == "0" or luhn_digit(digits[:-1]) != digits[-1]:
            return None
        n = len(digits) - 1
        body = f"{self.move(int(digits[:-1]), 10 ** n, 'card', lambda x: x >= 10 ** (n - 1)):0{n}d}"
        return _fill(text, body + luhn_digit(body))

    def ssn(self, text: str) -> str | None:
        def real(x: int) -> bool:
            area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
            return 0 < area < 900 and area != 666 and group > 0 and serial > 0

        x = int(_only_digits(text))
        return _fill(text, f"{self.move(x, 10 ** 9, 'ssn', real):09d}") if real(x) else None

    def phone(self, text: str) -> str | None:
        """Ten digits of the North American plan, after an optional country code 1."""
        def real(x: int) -> bool:
            return x // 10 ** 9 >= 2 and x // 10 ** 6 % 10 >= 2

        digits = _only_digits(text)
        country = digits[:-10]
        if len(digits) not in (10, 11) or country not in ("", "1") or not real(int(digits[-10:])):
            return None
        return _fill(text, country + f"{self.move(int(digits[-10:]), 10 ** 10, 'phone', real):010d}")

    def abroad(self, text: str) -> str | None:
        """An international number: the two digits after the plus stay."""
        digits = _only_digits(text)
        n = len(digits) - 2
        if not 8 <= len(digits) <= 15 or digits[0] == "0":
            return None
        return _fill(text, digits[:2] + f"{self.move(int(digits[2:]), 10 ** n, 'abroad'):0{n}d}")

    def address(self, text: str) -> str | None:
        """IPv4; private and special ranges stay what they are."""
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
            return None
        x = parts[0] << 24 | parts[1] << 16 | parts[2] << 8 | parts[3]
        special = ((0x00000000, 1 << 24), (0x0A000000, 1 << 24), (0x7F000000, 1 << 24), (0xA9FE0000, 1 << 16),
                   (0xAC100000, 1 << 20), (0xC0A80000, 1 << 16), (0xE0000000, 1 << 29))

        def kind(v: int):
            return next(((low, size) for low, size in special if low <= v < low + size), None)

        place = kind(x)
        if place is None:
            y = self.move(x, 1 << 32, "ip", lambda v: kind(v) is None)
        else:
            y = place[0] + self.move(x - place[0], place[1], "ip")
        return ".".join(str(y >> s & 255) for s in (24, 16, 8, 0))

    def date(self, text: str) -> str | None:
        numbers = re.split(r"\D", text)
        mark = re.search(r"\D", text).group()
        orders = ("ymd",) if len(numbers[0]) == 4 else ("dmy",) if mark == "." else ("mdy", "dmy")
        for order in orders:
            part = dict(zip(order, numbers, strict=True))
            try:
                day = datetime.date(int(part["y"]), int(part["m"]), int(part["d"])).toordinal() - FIRST_DAY
            except ValueError:
                continue
            if not 0 <= day < DAYS:
                return None

            def parts(x: int, order=order) -> list[str]:
                d = datetime.date.fromordinal(FIRST_DAY + x)
                named = {"y": f"{d.year:04d}", "m": f"{d.month:02d}", "d": f"{d.day:02d}"}
                return [named[c] for c in order]

            def same_reading(x: int, order=order) -> bool:
                # days up to 12 could be read either way: keep each date readable in its own order only
                first = order if order != "dmy" or mark == "." else "mdy"
                return order == first or int(parts(x)[0]) > 12

            return mark.join(parts(self.move(day, DAYS, "date", same_reading)))
        return None

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "").upper()
        country, check, account = plain[:2], plain[2:4], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_check(country, account) != check:
            return None
        moved = self.letters(account, "iban")
        left = iter(country + iban_check(country, moved) + moved)
        return "".join(c if c == " " else next(left) for c in text)

    def letters(self, text: str, name: str, classes=(DIGITS, SMALL, LARGE)) -> str:
        """Characters permuted together, each within its own class (digits, small letters, capitals)."""
        kinds = [next((k for k in classes if c in k), None) for c in text]
        x, n = 0, 1
        for c, k in zip(text, kinds, strict=True):
            if k:
                x, n = x * len(k) + k.index(c), n * len(k)
        if n == 1:
            return text
        x = self.move(x, n, f"{name}|{','.join(k[0] if k else c for c, k in zip(text, kinds, strict=True))}")
        out = []
        for c, k in zip(reversed(text), reversed(kinds), strict=True):
            if k:
                x, r = divmod(x, len(k))
                c = k[r]
            out.append(c)
        return "".join(reversed(out))

    def email(self, text: str) -> str | None:
        local, _, domain = text.rpartition("@")
        if ".." in text or len(local) > 64 or local[0] == "." or local[-1] == ".":
            return None
        return f"{self.letters(local, 'email')}@{domain}"

    def key_id(self, text: str) -> str | None:
        return text[:4] + self.letters(text[4:], "key", (DIGITS + LARGE,))

    def secret(self, text: str) -> str | None:
        at = len(text) - len(re.search(r"[0-9a-f]+$", text).group())
        return text[:at] + self.letters(text[at:], "secret", (HEX,))

    def _pseudonym(self, kind: str, value: str) -> tuple[str, int] | None:
        """(pseudonym, characters that it stands for); some may be followed by more digits, so blanks may end them."""
        ends = [len(value)]
        if kind in _LOOSE:
            ends += [i for i in range(len(value) - 1, 0, -1) if value[i] == " "]
        for end in ends:
            for name in _TRIED.get(kind, (kind,)):
                new = getattr(self, name)(value[:end])
                if new is not None:
                    return new, end
        return None

    def replace(self, text: str | None) -> tuple[str | None, list[tuple[str, int, int]]]:
        """(text with pseudonyms, [(kind, start, end) in the given text])."""
        if not text or not _ANY.search(text):
            return text, []
        out, spans, done, at = [], [], 0, 0
        while True:
            m = _FIND.search(text, at)
            if m is None:
                break
            kind, value = m.lastgroup, m.group()
            if (kind, value) not in self.seen:
                if len(self.seen) > 1 << 16:
                    self.seen.clear()
                self.seen[kind, value] = self._pseudonym(kind, value)
            found = self.seen[kind, value]
            if found is None:
                at = m.start() + 1
                continue
            new, size = found
            out += [text[done:m.start()], new]
            done = at = m.start() + size
            spans.append((kind, m.start(), done))
        return "".join([*out, text[done:]]), spans


_ANY = re.compile(r"[0-9@]")
_FIND = re.compile("|".join((
    r"(?P<email>(?<![\w.+@-])[A-Za-z0-9][\w.+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-]))",
    r"(?P<key_id>(?<!\w)(?:AKIA|ASIA)[0-9A-Z]{16}(?!\w))",
    r"(?P<secret>(?<!\w)(?:password|passwd|secret|token|api_key)\s?[=:]\s?[\"']?[0-9a-f]{8,}(?!\w))",
    r"(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?!\w))",
    r"(?P<address>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))",
    r"(?P<date>(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w]|[./-]\d))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{1,4}"
    r"|\d{4}(?P<space>[ -])\d{6}(?P=space)\d{5})(?![\w]|-\d))",
    r"(?P<phone>(?<![\w-])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w]|-\d))",
    r"(?P<abroad>(?<!\w)\+[1-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,6}(?![\w]))",
)))
_LOOSE = {"iban", "abroad"}
_TRIED = {"card": ("card", "phone"), "phone": ("phone", "abroad")}

FOUND = "doc_id long, text string, spans array<struct<kind: string, start: long, end: long>>"


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """Per row: doc_id, the text with pseudonyms, and where they stand in the given text."""
    def work(batches):
        names = Pseudonyms(key)
        for b in batches:
            done = [names.replace(t) for t in b["text"]]
            yield {"doc_id": b["doc_id"], "text": [t for t, _ in done],
                   "spans": [[{"kind": k, "start": a, "end": e} for k, a, e in s] for _, s in done]}

    return map_batches(docs, ["doc_id", "text"], FOUND, work)


def op4_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, how many, and of which kinds."""
    found = pseudonymise(table(spark, sf_dir, "documents"), DEFAULT_KEY)
    kinds = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["kind"])))
    return found.select("doc_id", F.size("spans").cast("long").alias("n_found"),
                        F.array_join(kinds, ",").alias("kinds"), "text")
