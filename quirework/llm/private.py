"""Format-preserving pseudonyms: validated numbers and dates, permuted within their format.

Each value becomes a number below the size of its format's domain, goes through a keyed
Feistel network (cycle-walking until it is in the domain again), and is written back in the
shape it had: separators, letter case and check digits stay right. The permutation depends
on the key and the kind of value alone, so equal values have equal pseudonyms in all
documents and all runs, however they are punctuated, and different ones differ.

Texts stay where they are read; there is no shuffle and no table of values.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import itertools
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirework.llm.words import values_of

ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
DAYS = (LAST_DAY - FIRST_DAY).days + 1
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Names of more letters and digits are permuted place by place, not as one number.
MOST_SYMBOLS = 40

#: Values told by their form alone. They are looked for before runs of digit groups, so that
#: a number beside one is not joined to it.
KINDS = re.compile(
    r"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-]))
  | (?P<iban>(?<!\w)[A-Za-z]{2}[0-9]{2}(?:[ ]?[A-Za-z0-9]{4}){2,7}(?:[ ]?[A-Za-z0-9]{1,3})?(?!\w))
  | (?P<date>(?:(?<![\w./-])|(?<=[0-9]{7}-))
      (?:[0-9]{4}(?P<d1>[-/.])[0-9]{1,2}(?P=d1)[0-9]{1,2}|[0-9]{1,2}(?P<d2>[-/.])[0-9]{1,2}(?P=d2)[0-9]{4})
      (?:(?![\w/-]|\.[0-9])|(?=[Tt][0-9]{2})|(?=-[0-9]{7})))
  | (?P<ip>(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w]|\.[0-9]))
  | (?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))
    """,
    re.VERBOSE,
)
#: Groups of digits with up to two signs between them, as many as there are.
RUN = re.compile(r"(?<![\w+])[+(]?[0-9](?:[ ().-]{0,2}[0-9]){6,}")
GROUP = re.compile("[0-9]+")
#: A telephone number that goes on with what looks like a social security number.
DIALLED = re.compile(r"\+[0-9][0-9 ().-]{0,8}$")
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
        31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def permuted(x: int, size: int, key: bytes, kind: str) -> int:
    """A keyed permutation of range(size)."""
    half = max((size - 1).bit_length() + 1, 2) // 2
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = x >> half, x & mask
        for n in range(ROUNDS):
            seed = right.to_bytes(width, "little") + bytes([n]) + f"{kind}:{size}".encode()
            mixed = hashlib.blake2b(seed, key=key, digest_size=max(width, 8)).digest()
            left, right = right, left ^ (int.from_bytes(mixed, "little") & mask)
        x = left << half | right
        if x < size:
            return x


def stream(data: bytes, key: bytes, n: int) -> np.ndarray:
    """`n` keyed numbers that depend on all of `data`: a digest of it, hashed with a counter."""
    seed = hashlib.blake2b(data, key=key).digest()
    blocks = (hashlib.blake2b(seed + k.to_bytes(8, "little"), key=key).digest() for k in range(-(-n // 8)))
    return np.frombuffer(b"".join(blocks), "<u8")[:n]


def permuted_places(values: np.ndarray, sizes: np.ndarray, key: bytes, kind: str) -> np.ndarray:
    """A keyed permutation of sequences that have a number below its size at each place.

    A Feistel network over the two halves of the sequence: in turn, each is added to by a
    stream that the other determines, modulo the sizes. Time and memory are linear.
    """
    half = len(values) // 2
    parts, of = [values[:half].astype(np.uint64), values[half:].astype(np.uint64)], [sizes[:half], sizes[half:]]
    label = hashlib.blake2b(kind.encode(), key=key).digest()
    for n in range(ROUNDS):
        own, other = n % 2, 1 - n % 2
        seed = bytes([n]) + label + parts[other].astype(np.uint8).tobytes()
        added = stream(seed, key, len(parts[own])) % of[own].astype(np.uint64)
        parts[own] = (parts[own] + added) % of[own].astype(np.uint64)
    return np.concatenate(parts).astype(np.int64)


def luhn_digit(digits: str) -> str:
    total = sum(n if k % 2 else sum(divmod(2 * n, 10)) for k, n in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


def shaped(text: str, values: str, chosen: Callable[[str], bool]) -> str:
    """`text` with its chosen characters replaced in turn."""
    following = iter(values)
    return "".join(next(following) if chosen(c) else c for c in text)


def is_digit(c: str) -> bool:
    return c in "0123456789"


def digits_of(digits: str, key: bytes, kind: str) -> str:
    return f"{permuted(int(digits), 10 ** len(digits), key, f'{kind}{len(digits)}'):0{len(digits)}}"


def card(text: str, key: bytes) -> str | None:
    digits = "".join(filter(is_digit, text))
    if 13 <= len(digits) <= 19 and luhn_digit(digits[:-1]) == digits[-1]:
        body = digits_of(digits[:-1], key, "card")
        return shaped(text, body + luhn_digit(body), is_digit)
    return None


def phone(text: str, key: bytes) -> str | None:
    """Plain runs of digits, decimals and lists of small numbers are no telephone numbers.

    Two groups are one if the first is an area code with its leading 0. A number that starts
    with 0 has a pseudonym that does, and no other has, however they are punctuated.
    """
    groups = GROUP.findall(text)
    digits = "".join(groups)
    trunk = len(groups) == 2 and groups[0][0] == "0" and 3 <= len(groups[0]) <= 6 and len(groups[1]) > 3
    marked = text[0] in "+(" or len(groups) > 2 or trunk
    if 7 <= len(digits) <= 15 and marked and all(len(g) > 1 for g in groups[1:]):
        if digits[0] == "0":
            return shaped(text, "0" + digits_of(digits[1:], key, "phone0"), is_digit)
        least = 10 ** (len(digits) - 1)
        number = least + permuted(int(digits) - least, 9 * least, key, "phone")
        return shaped(text, str(number), is_digit)
    return None


def ssn(text: str, key: bytes) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    places = [n for n in range(1, 900) if n != 666]
    x = permuted((places.index(area) * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, key, "ssn")
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    return f"{places[area]:03}-{group + 1:02}-{serial + 1:04}"


def date(text: str, key: bytes) -> str | None:
    sign = next(c for c in text if not is_digit(c))
    parts = text.split(sign)
    year_first = len(parts[0]) == 4
    forms = ["%Y-%m-%d"] if year_first else ["%d-%m-%Y", "%m-%d-%Y"]
    for form in forms:
        try:
            day = datetime.datetime.strptime("-".join(parts), form).date()
        except ValueError:
            continue
        if FIRST_DAY <= day <= LAST_DAY:
            moved = FIRST_DAY + datetime.timedelta(permuted((day - FIRST_DAY).days, DAYS, key, "date"))
            new = moved.strftime(form).split("-")
            return sign.join(n if len(p) > 1 else n.lstrip("0") for n, p in zip(new, parts, strict=True))
    return None


def ip(text: str, key: bytes) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    x = permuted(int.from_bytes(bytes(map(int, parts)), "big"), 2**32, key, "ip")
    return ".".join(map(str, x.to_bytes(4, "big")))


def iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body, at = plain[4:], "".join(filter(is_digit, plain[4:]))
    body = shaped(body, digits_of(at, key, "iban") if at else "", is_digit)
    check = 98 - number(body + plain[:2] + "00") % 97
    return shaped(text, f"{plain[:2]}{check:02}{body}", lambda c: c != " ")


def email(text: str, key: bytes) -> str:
    """The name is permuted, letters among letters and digits among digits; the domain stays."""
    name, _, domain = text.partition("@")
    lowered = name.lower()
    letters = "".join(c for c in lowered if c in LETTERS)
    digits = "".join(filter(is_digit, lowered))
    shape = "".join("a" if c in LETTERS else "0" if is_digit(c) else c for c in lowered)
    kind = f"email:{shape}@{domain.lower()}"
    if len(letters) + len(digits) > MOST_SYMBOLS:
        values = np.array([LETTERS.index(c) for c in letters] + [int(c) for c in digits])
        sizes = np.repeat([26, 10], [len(letters), len(digits)])
        new = permuted_places(values, sizes, key, kind).tolist()
        letters = "".join(LETTERS[x] for x in new[: len(letters)])
        digits = "".join(map(str, new[len(letters) :]))
    else:
        letters, digits = permuted_name(letters, digits, key, kind)
    name = shaped(lowered, letters, lambda c: c in LETTERS)
    return f"{shaped(name, digits, is_digit)}@{domain.lower()}"


def permuted_name(letters: str, digits: str, key: bytes, kind: str) -> tuple[str, str]:
    """Letters and digits together as one number of base 26 and 10."""
    x = 0
    for c in letters:
        x = x * 26 + LETTERS.index(c)
    x = x * 10 ** len(digits) + int(digits or 0)
    x, number = divmod(permuted(x, 26 ** len(letters) * 10 ** len(digits), key, kind), 10 ** len(digits))
    out = ""
    for _ in letters:
        x, c = divmod(x, 26)
        out = LETTERS[c] + out
    return out, f"{number:0{len(digits)}}" if digits else ""


MAKERS = {"email": email, "iban": iban, "date": date, "ip": ip, "ssn": ssn}


def iban_within(text: str, key: bytes) -> tuple[int, str | None]:
    """Where the IBAN at the start ends, and its pseudonym; of a country's length if that is known."""
    ends = [n for n, c in enumerate(text, 1) if c != " " and not text[n : n + 1].isalnum()]
    length = IBAN_LENGTHS.get(text[:2].upper())
    fits = [n for n in ends if length in (None, n - text.count(" ", 0, n))]
    for end in [*reversed(fits), *ends[-1:]]:
        if new := iban(text[:end], key):
            return end, new
    return (fits[-1] if length and fits else 0), None


def card_shaped(sizes: list[int]) -> bool:
    return len(sizes) == 1 or sizes in ([4, 6, 5], [4, 6, 4]) or (set(sizes[:-1]) == {4} and sizes[-1] <= 4)


def in_run(text: str, start: int, end: int, key: bytes, phones: bool) -> list[tuple[int, int, str]]:
    """The cards and telephone numbers in a run of digit groups, each of whole groups.

    Cards as they are printed come first, then the rest of the run as a whole, telephone
    numbers with a sign in front, other Luhn numbers, and parts between blanks.
    """
    groups = [m.span() for m in GROUP.finditer(text, start, end)]
    if re.match(r"\w", text[end : end + 1]):
        groups.pop()
    begins = [a - (a > start and text[a - 1] in "+(") for a, _ in groups]
    sizes = [b - a for a, b in groups]
    found, gaps = [], [(0, len(groups))]

    def windows(i, last, most):
        """Ends of windows from group i, the longest first."""
        ends, digits = [], 0
        for j in range(i, last):
            digits += sizes[j]
            if digits > most:
                break
            if digits >= 7:
                ends.append(j + 1)
        return ends[::-1]

    def loose(i, last):
        """A border of groups at a blank or at the end of the run."""
        return i in (0, last, len(groups)) or " " in text[groups[i - 1][1] : groups[i][0]]

    def one_number(i, last):
        """Where a bracket opens the next telephone number; one after a country code does not."""
        return next((j for j in range(i + 1, last) if text[begins[j]] == "(" and (j > i + 1 or text[begins[i]] != "+")), last)

    def printed_card(i, first, last):
        ends = [j for j in windows(i, last, 19) if card_shaped(sizes[i:j])]
        for j in sorted(ends, key=lambda j: (j - i != 1, sizes[i:j] != [4] * 4)):
            yield j, card

    def whole(i, first, last):
        if i == first and last - i <= 19 and sum(sizes[i:last]) <= 19:
            yield last, card
            if phones and one_number(i, last) == last:
                yield last, phone

    def marked_phone(i, first, last):
        if phones and text[begins[i]] in "+(":
            for j in sorted(windows(i, one_number(i, last), 15), key=lambda j: not loose(j, last)):
                yield j, phone

    def other_card(i, first, last):
        for j in windows(i, last, 19):
            if min(sizes[i:j]) > 2:
                yield j, card

    def part(i, first, last):
        if phones and loose(i, last):
            j = next((j for j in range(i + 1, last + 1) if loose(j, last)), last)
            if sum(sizes[i:j]) <= 15:
                yield j, phone
            if j < last and loose(j + 1, last) and text[begins[i]] == "0":
                yield j + 1, phone

    for finder in (printed_card, whole, marked_phone, other_card, part):
        left = []
        for first, last in gaps:
            i = begin = first
            while i < last:
                for j, maker in finder(i, begin, last):
                    if new := maker(text[begins[i] : groups[j - 1][1]], key):
                        found.append((begins[i], groups[j - 1][1], new))
                        left.append((begin, i))
                        i = begin = j
                        break
                else:
                    i += 1
            left.append((begin, last))
        gaps = [(a, b) for a, b in left if sum(sizes[a:b]) >= 7]
    return found


def pseudonymised(text: str | None, key: bytes) -> tuple[str | None, int]:
    """The text with pseudonyms, and how many values were replaced."""
    if text is None:
        return None, 0
    # Spans with their pseudonym, or None: a wrong value, which is not part of another either.
    spans, typos, at = [], [], 0
    while found := KINDS.search(text, at):
        (start, end), kind = found.span(), found.lastgroup
        kind = kind if kind in MAKERS else "date"
        at = end
        if kind == "iban":
            length, new = iban_within(found[0], key)
            end = start + length
            if new is None:
                typos.append((start, end))
                at = start + 2
                continue
            at = end
        elif kind == "ssn" and DIALLED.search(text[max(0, start - 10) : start]):
            continue
        else:
            new = MAKERS[kind](found[0], key)
        spans.append((start, end, new))
    out, before = list(spans), 0
    # The end of the last wrong value that starts at or before a place.
    begins, ends = [a for a, _ in typos], list(itertools.accumulate((b for _, b in typos), max))
    for start, end, _ in [*spans, (len(text), 0, None)]:
        while run := RUN.search(text, before, start):
            before = run.end()
            known = bisect.bisect_right(begins, run.start())
            phones = not known or ends[known - 1] <= run.start()
            out += in_run(text, *run.span(), key, phones)
        before = end
    out = sorted(x for x in out if x[2] is not None)
    pieces, before = [], 0
    for start, end, new in out:
        pieces += [text[before:start], new]
        before = end
    return "".join([*pieces, text[before:]]), len(out)


def pseudonyms(
    docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`id`, `text` (with pseudonyms), `n_values` for each row.

    Numbers that fail their check (Luhn, IBAN, octets, areas) and days that don't exist
    stay. A null text stays null, an empty one empty. Values have any length, texts too: the
    time for an e-mail name of a million letters is in proportion to it.
    """
    secret = hashlib.sha256(key.encode()).digest()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts, counts = zip(*(pseudonymised(t, secret) for t in values_of(part["text"])), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                    ["id", "text", "n_values"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, text string, n_values long"
    )
