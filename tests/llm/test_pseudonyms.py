"""Pseudonyms against a plain scan of the texts with plain Feistel networks; formats that must stay linked; column names."""

import datetime
import hashlib

import pytest
import regex
from llm_data import LONG, SF, docs, none, odd, texts  # noqa: F401

from qalens.llm.pii import CARD_LENGTHS, PATTERN, pseudonymised
from qalens.llm.registry import PII_KEY, op10_pseudonyms

COUNTRY = r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"


def digest(key, kind, r, value):
    return hashlib.sha256(f"{key}|{kind}|{r}|{value}".encode()).hexdigest()


def permuted(left, right, high, low, key, kind):
    for i in range(1, 9):
        left, right, high, low = right, (left + int(digest(key, kind, i, right)[:15], 16)) % high, low, high
    return left, right


def permuted_text(s, key, kind):
    def turned(c, by):
        for start, size in (("0", 10), ("a", 26), ("A", 26)):
            if 0 <= ord(c) - ord(start) < size:
                return chr(ord(start) + (ord(c) - ord(start) + by) % size)
        return c

    left, right = s[:len(s) // 2], s[len(s) // 2:]
    for i in range(1, 9):
        hashed = digest(key, kind, i, right)
        left, right = right, "".join(turned(c, int(hashed[k * 3 % 60:k * 3 % 60 + 3], 16)) for k, c in enumerate(left))
    return left + right


def shaped(shape, new):
    new = iter(new)
    return "".join(next(new) if c in "0123456789" else c for c in shape)


def check_digit(payload):
    total = 0
    for i, c in enumerate(reversed(payload)):
        n = int(c) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def card(number, key):
    payload = number[:-1]
    low = len(payload) // 2
    high = len(payload) - low
    a, b = permuted(int(payload[:high]), int(payload[high:]), 10**high, 10**low, key, "card")
    new = f"{a:0{high}d}{b:0{low}d}"
    return new + check_digit(new)


def cards(run, key):
    groups = regex.split("[ -]", run)
    digits, borders = "".join(groups), [0]
    for g in groups:
        borders.append(borders[-1] + len(g))
    taken = []
    for size in CARD_LENGTHS:
        for a in borders:
            if a + size in borders and check_digit(digits[a:a + size - 1]) == digits[a + size - 1] and all(b <= a or a + size <= s for s, b in taken):
                taken.append((a, a + size))
    for a, b in taken:
        digits = digits[:a] + card(digits[a:b], key) + digits[b:]
    return shaped(run, digits)


def moved_date(m, key):
    def one(day):
        start = datetime.date(1800, 1, 1)
        a, b = permuted(*divmod((day - start).days, 773), 189, 773, key, "date")
        return start + datetime.timedelta(days=a * 773 + b)

    for form in ("%Y-%m-%d",) if "-" in m else ("%d/%m/%Y", "%m/%d/%Y"):
        try:
            day = datetime.datetime.strptime(m, form).date()
        except ValueError:
            continue
        if 1800 <= day.year <= 2199:
            return one(day).strftime(form)
    return m


def plain(m, key):
    if "@" in m:
        last = regex.search(r"\.\p{L}+$", m).group()
        address = m[:len(m) - len(last)]
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in address)
        return "".join(n.upper() if "A" <= c <= "Z" else n for c, n in zip(address, permuted_text(lower, key, "email"))) + last
    if regex.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", m):
        o = [int(x) for x in m.split(".")]
        a, b = permuted(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip")
        return ".".join(str(x) for x in (a >> 8, a & 255, b >> 8, b & 255))
    if regex.fullmatch(r"\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4}", m):
        return moved_date(m, key)
    if regex.fullmatch(r"\d{3}-\d\d-\d{4}", m):
        area, group, serial = map(int, m.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return m
        a, b = permuted((area - (2 if area > 666 else 1)) * 99 + group - 1, serial - 1, 898 * 99, 9999, key, "ssn")
        place = a // 99
        return f"{place + (2 if place >= 665 else 1):03d}-{a % 99 + 1:02d}-{b + 1:04d}"
    if regex.match(r"\+|\(|\d{3}[ .-]\d{3}[ .-]\d{4}$", m):
        code = regex.match(COUNTRY, m)
        code = code.group() if code else ""
        digits = "".join(c for c in m[len(code):] if c in "0123456789")
        return code + shaped(m[len(code):], permuted_text(digits, key, "phone"))
    return cards(m, key)


def expected(text, key):
    return None if text is None else regex.sub(PATTERN, lambda m: plain(m.group(), key), text)


def test_query_matches_a_plain_scan_of_the_documents(spark, texts):
    got = {r.doc_id: r for r in op10_pseudonyms(spark, SF).collect()}
    assert {i: r.text for i, r in got.items()} == {i: expected(t, PII_KEY) for i, t in texts.items()}
    assert all((r.n_private > 0) == (r.text != texts[i]) for i, r in got.items()) and any(r.n_private for r in got.values())


PROBES = [
    "card 4111 1111 1111 1111 12/27", "4111111111111111 123", "12 4111111111111111", "4111111111111111-", "4111111111111111 5500005555555559",
    "x 4111-1111-1111-1111 y 378282246310005, 6011 0009 9013 9424 4", "+1 (663) 555-6869 2024", "+44 20 7946 0958 1234", "+49 (0)30 1234567", "555 123 4567",
    "(555) 123-4567", "+1 555-123-4567", "+15551234567", "+1 555-123-4567-", "555.123.4567.", "Bob.Smith@Example.COM bob.smith@example.com", "jürgen@x.de",
    "中文@x.de", "1 2 3 4 5 6 7 8 9 0 " * 30, "9" * 300, "1.2.3.4 256.1.1.1 1.2.3.4.5", "1999-12-31 31/12/1999 12/31/1999 2020-02-30 1700-01-01",
    "123-45-6789 000-12-3456 666-12-3456 899-99-9999", "@", "a@b", "4539148803436467" * 2, "", None,
]


def test_probes_match_a_plain_scan(spark):
    frame = spark.createDataFrame(list(enumerate(PROBES)), "doc_id int, text string")
    got = {r.doc_id: r.text for r in pseudonymised(frame, "k").collect()}
    assert got == {i: expected(t, "k") for i, t in enumerate(PROBES)}
    clear = ["4111", "5500005555555559", "378282246310005", "6011 0009", "555-6869", "7946", "123 4567", "123-4567", "5551234567", "123.4567", "ob.", "smith", "rgen"]
    changed = "\n".join(got[i] for i in range(18))
    assert not [c for c in clear if c in changed]
    assert got[6].endswith(" 2024") and got[7].endswith(" 1234") and got[2].startswith("12 ") and got[1].endswith(" 123")


def test_all_formats_of_a_value_have_one_pseudonym(spark):
    forms = {"phone": ["(555) 123-4567", "555-123-4567", "+1 555-123-4567", "+15551234567", "555.123.4567", "555 123 4567", "+1 (555) 123 4567"],
             "card": ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111 123"]}
    for kind, values in forms.items():
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id int, text string")
        national = {"".join(c for c in r.text.removeprefix("+1") if c.isdigit())[:16] for r in pseudonymised(frame, "k").collect()}
        assert len(national) == 1 and not national & {"5551234567", "4111111111111111"}, kind
    frame = spark.createDataFrame([(1, "Ann.Lee@Mail.Org"), (2, "ann.lee@mail.org")], "doc_id int, text string")
    one, other = (r.text for r in pseudonymised(frame, "k").orderBy("doc_id").collect())
    assert one.lower() == other.lower() != "ann.lee@mail.org" and one[0].isupper() and one[4].isupper()


@pytest.mark.parametrize("name", ["__pii", "matches", "Matches", "a.b", "n"])
def test_columns_of_any_name_pass_through(spark, name):
    frame = spark.createDataFrame([(1, "mail bob@example.com", "own value")], f"doc_id int, text string, `{name}` string")
    made = pseudonymised(frame, "k", count_col="n_private")
    assert made.columns == ["doc_id", "text", name, "n_private"]
    row = made.first()
    assert row[2] == "own value" and row[3] == 1 and "bob@" not in str(row)


def test_long_texts_take_linear_time(spark):
    import time

    frame = spark.createDataFrame([(1, "1 " * 2_000), (2, "a" * 200_000 + "@"), (3, "4111 1111 1111 1111 " * 50), (4, LONG)], "doc_id int, text string")
    pseudonymised(frame.where("doc_id = 4"), "k").collect()  # compiled before the clock starts
    started = time.time()
    rows = pseudonymised(frame, "k").collect()
    assert time.time() - started < 60
    assert next(r.text for r in rows if r.doc_id == 3).count("4111 1111") == 0
