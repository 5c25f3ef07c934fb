import datetime
import hashlib
import re

import pytest

from quirework.llm import private as p
from quirework.llm.queries import op5_feistel_pseudonyms

KEY = b"k" * 32


@pytest.mark.parametrize("size", [1, 2, 3, 10, 255, 256, 1000])
def test_permutes_the_whole_domain(size):
    assert sorted(p.permuted(x, size, KEY, "k") for x in range(size)) == list(range(size))
    assert size < 255 or [p.permuted(x, size, KEY, "k") for x in range(9)] != [p.permuted(x, size, b"x" * 32, "k") for x in range(9)]


VALID = [
    "4845168114407329", "4845-1681-1440-7329", "+1 (017) 555-7713", "(017) 555-7713", "123-45-6789", "2024-02-29",
    "29/02/2024", "12.31.1999", "97.51.17.173", "GB82 WEST 1234 5698 7654 32", "ann.lee-7@mail.example.com",
]
STRANGE = ["4845168114407328", "000-45-6789", "2023-02-29", "1.2.3.400", "12345", "2024", "GB82 WEST 1234 5698 7654 33", "a@b", "3.14159265", "1234567890123456789012"]


@pytest.mark.parametrize("value", VALID)
def test_valid_values_keep_their_format(value):
    text, n = p.pseudonymised(f"on {value}, and {value}.", KEY)
    new = text[3 : text.index(", and")]
    assert n == 2 and text == f"on {new}, and {new}." and new != value
    form = lambda v: re.sub("[0-9]+", "0", v) if v.count(".") == 3 else re.sub("[0-9]", "0", v)
    assert form(new) == form(value) or "@" in value
    assert p.pseudonymised(new, KEY)[1] == 1  # valid again


@pytest.mark.parametrize("value", STRANGE)
def test_others_stay(value):
    assert p.pseudonymised(f"x {value} y", KEY) == (f"x {value} y", 0)


def test_values_stay_linked_whatever_their_punctuation():
    plain, _ = p.pseudonymised("4845168114407329", KEY)
    dashed, _ = p.pseudonymised("4845-1681-1440-7329", KEY)
    assert dashed.replace("-", "") == plain
    one, _ = p.pseudonymised("2024-02-29", KEY)
    two, _ = p.pseudonymised("29/02/2024", KEY)
    assert datetime.date.fromisoformat(one) == datetime.datetime.strptime(two, "%d/%m/%Y").date()
    many = {p.pseudonymised(f"u{n}@x.org", KEY)[0] for n in range(10)}
    assert len(many) == 10 and all(re.fullmatch(r"[a-z]\d@x\.org", m) for m in many)


def test_query_and_odd_texts(spark, small, docs_of):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op5_feistel_pseudonyms(spark, small).collect()
    assert len(rows) == len(docs) and sum(r.n_values for r in rows) > 0
    secret = hashlib.sha256(b"test tables").digest()
    assert all((r.text, r.n_values) == p.pseudonymised(docs[r.doc_id], secret) for r in rows)
    odd = docs_of([(1, None, None, None), (2, "", None, None), (None, "1 " * 50_000, None, None), (2, "97.51.17.173", None, None)])
    got = p.pseudonyms(odd, "key").collect()
    assert sorted((r.id or 0, r.n_values) for r in got) == [(0, 0), (1, 0), (2, 0), (2, 1)]
    assert p.pseudonyms(odd.limit(0), "key").count() == 0


CARD, DAY = "4845168114407329", "2024-02-29"
NEIGHBOURS = [
    ("card {} 12 items", [CARD]), ("{}. 3 days", [CARD]), ("room 12 {}", [CARD]), ("call {} {}", ["(017) 555-7713", DAY]),
    ("page 7 {}", ["123-45-6789"]), ("12 {}", [DAY]), ("pay {} USD", ["BE68 5390 0754 7034"]), ("{} {}", [CARD, "4845-1681-1440-7329"]),
    ("12 34 {} 5", ["4845 1681 1440 7329"]), ("4 {} 12", ["97.51.17.173"]), ("AB12 {}", [CARD]), ("x 123 {}", ["4567890@x.org"]),
    ("{} {}", [DAY, CARD]), ("12 {} 2000 30 40 50", ["017-555-7713"]), ("{} {} {}", ["(017) 555-7713", "(018) 555-7713", "123-45-6789"]),
]


@pytest.mark.parametrize("form, values", NEIGHBOURS)
def test_neighbours_are_told_apart(form, values):
    """Each value has the pseudonym that it has alone."""
    alone = [p.pseudonymised(v, KEY)[0] for v in values]
    assert all(a != v for a, v in zip(alone, values, strict=True))
    assert p.pseudonymised(form.format(*values), KEY) == (form.format(*alone), len(values))


@pytest.mark.parametrize("text", ["10 20 30 40 50 60 70 80 90", "1 2 3 4 5 6 7 8 9 10 11 12 13 14", "7 000-45-6789", "12 2023-02-29"])
def test_lists_and_wrong_values_stay(text):
    assert p.pseudonymised(text, KEY) == (text, 0)


COMMON = [
    (DAY, DAY + "T10:15:00", "T10:15:00"), (DAY, DAY + " 10:15:00", " 10:15:00"), (DAY, DAY + "t10:15", "t10:15"),
    (CARD + "-" + DAY, "", ""), ("1/5/2024", "", ""), ("2024-1-5", "", ""), ("1.12.2024", "", ""), ("030 1234567", "", ""),
    ("0171-5557713", "", ""), ("gb82 west 1234 5698 7654 32", "", ""), ("be68539007547034", "", ""),
]


@pytest.mark.parametrize("value, text, rest", COMMON)
def test_common_forms(value, text, rest):
    new, n = p.pseudonymised(f"id {text or value} is", KEY)
    assert n == 1 + (CARD in value) and new.endswith(f"{rest} is") and value not in new
    assert p.pseudonymised(new, KEY)[1] == n


def test_forms_of_a_value_stay_linked():
    new = lambda t: p.pseudonymised(t, KEY)[0]
    numbers = lambda t: [int(x) for x in t.split("/")]
    assert numbers(new("1/5/2024")) == numbers(new("01/05/2024"))
    assert new(f"{CARD}-{DAY}") == f"{new(CARD)}-{new(DAY)}" and new(DAY + "T10:15") == new(DAY) + "T10:15"
    assert new("030 1234567") == new("(030) 1234567").replace("(", "").replace(")", "")
    assert new("be68539007547034").upper() == new("BE68 5390 0754 7034").replace(" ", "")


# A plain version, from the definitions: numbers as integers, one pattern for each kind.


def plain_feistel(x, size, key, kind):
    half = max((size - 1).bit_length() + 1, 2) // 2
    width = (half + 7) // 8
    while True:
        left, right = divmod(x, 2**half)
        for n in range(8):
            seed = right.to_bytes(width, "little") + bytes([n]) + f"{kind}:{size}".encode()
            mixed = int.from_bytes(hashlib.blake2b(seed, key=key, digest_size=max(width, 8)).digest(), "little")
            left, right = right, left ^ (mixed % 2**half)
        x = left * 2**half + right
        if x < size:
            return x


def refilled(text, digits):
    digits = iter(digits)
    return re.sub("[0-9]", lambda m: next(digits), text)


def plain_luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n // 10 + n % 10
    return total % 10 == 0


def plain_card(text, key):
    digits = re.sub("[^0-9]", "", text)
    if not plain_luhn(digits):
        return text
    n = len(digits) - 1
    body = str(plain_feistel(int(digits[:-1]), 10**n, key, f"card{n}")).zfill(n)
    return refilled(text, next(body + c for c in "0123456789" if plain_luhn(body + c)))


def plain_phone(text, key):
    digits = re.sub("[^0-9]", "", text)
    n = len(digits)
    if digits[0] == "0":
        return refilled(text, "0" + str(plain_feistel(int(digits[1:]), 10 ** (n - 1), key, f"phone0{n - 1}")).zfill(n - 1))
    least = 10 ** (n - 1)
    return refilled(text, str(least + plain_feistel(int(digits) - least, 9 * least, key, "phone")))


def plain_ssn(text, key):
    a, g, s = map(int, text.split("-"))
    if a in (0, 666) or a > 899 or not g or not s:
        return text
    areas = [n for n in range(1, 900) if n != 666]
    x = plain_feistel((areas.index(a) * 99 + g - 1) * 9999 + s - 1, 898 * 99 * 9999, key, "ssn")
    return f"{areas[x // 9999 // 99]:03}-{x // 9999 % 99 + 1:02}-{x % 9999 + 1:04}"


def plain_date(text, key):
    first = datetime.date(1900, 1, 1)
    try:
        day = datetime.date.fromisoformat(text)
    except ValueError:
        return text
    days = (datetime.date(2099, 12, 31) - first).days + 1
    return (first + datetime.timedelta(plain_feistel((day - first).days, days, key, "date"))).isoformat()


def plain_ip(text, key):
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255:
        return text
    x = plain_feistel(sum(n << 8 * k for k, n in enumerate(reversed(parts))), 2**32, key, "ip")
    return ".".join(str(x >> 8 * k & 255) for k in (3, 2, 1, 0))


def plain_email(text, key):
    name, domain = text.lower().split("@")
    letters, digits = re.sub("[^a-z]", "", name), re.sub("[^0-9]", "", name)
    shape = re.sub("[0-9]", "0", re.sub("[a-z]", "a", name))
    x, size = 0, 1
    for c in letters:
        x, size = x * 26 + ord(c) - 97, size * 26
    x, size = x * 10 ** len(digits) + int(digits or 0), size * 10 ** len(digits)
    x = plain_feistel(x, size, key, f"email:{shape}@{domain}")
    x, number = divmod(x, 10 ** len(digits))
    new = "".join(chr(97 + x // 26**k % 26) for k in reversed(range(len(letters))))
    new = iter(new)
    name = re.sub("[a-z]", lambda m: next(new), name)
    return refilled(name, str(number).zfill(len(digits))) + "@" + domain


#: The forms that the tables hold, in the order in which they are looked for.
PLAIN = [
    (r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9.-]+\.[a-z]+", plain_email),
    (r"(?<![\w./-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![\w-])", plain_date),
    (r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w.])", plain_ip),
    (r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", plain_ssn),
    (r"(?<![\w+])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?!\w)", plain_card),
    (r"(?<![\w+])(?:\+[0-9]{1,2} )?\([0-9]{3}\) [0-9]{3}-[0-9]{4}(?!\w)|(?<![\w+-])(?:\+[0-9]{1,2}-)?[0-9]{3}-[0-9]{3}-[0-9]{4}(?![\w-])", plain_phone),
]


def plain_text(text, key):
    joined = "|".join(f"({form})" for form, _ in PLAIN)
    return re.sub(joined, lambda m: PLAIN[m.lastindex - 1][1](m[0], key), text)


def test_query_equals_plain_version(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    secret = hashlib.sha256(b"test tables").digest()
    rows = op5_feistel_pseudonyms(spark, small).collect()
    assert {r.doc_id: r.text for r in rows} == {i: plain_text(t, secret) for i, t in docs.items()}
    assert sum(plain_text(t, secret) != t for t in docs.values()) > 5


@pytest.mark.parametrize("n", [1, 13, 40, 41, 217, 218, 5_000, 1_000_000])
@pytest.mark.parametrize("sign", ["a", "7", "Ab-7"])
def test_names_of_any_length(n, sign):
    name = (sign * n)[:n].rstrip("-")
    new, found = p.pseudonymised(f"to {name}@Mail.example.com now", KEY)
    assert found == 1 and new.endswith("@mail.example.com now") and new.startswith("to ")
    form = lambda t: re.sub("[0-9]", "0", re.sub("[a-z]", "a", t.lower()))
    assert form(new) == form(f"to {name}@Mail.example.com now")
    assert n < 4 or new != f"to {name.lower()}@mail.example.com now"
    assert p.pseudonymised(f"{name.upper()}@mail.example.com", KEY)[0] == new[3:-4]


def test_long_names_differ_where_their_names_do():
    names = ["x" * 60 + f"{k:03}" for k in range(300)] + [f"{k:03}" + "x" * 60 for k in range(300)]
    assert len({p.email(f"{n}@x.org", KEY) for n in names}) == 600
    import numpy as np

    sizes = np.array([2, 3, 2, 3])
    every = [(a, b, c, d) for a in range(2) for b in range(3) for c in range(2) for d in range(3)]
    assert sorted(tuple(p.permuted_places(np.array(v), sizes, KEY, "k").tolist()) for v in every) == every
    with_typos = "GB82 WEST 1234 5698 7654 33 1234567 " * 3_000
    assert p.pseudonymised(with_typos, KEY) == (with_typos, 0)
