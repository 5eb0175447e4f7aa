"""Format-preserving pseudonyms for personal data in texts.

One pattern finds e-mail and IPv4 addresses, phone numbers, social security numbers, dates and runs of digits that may hold
payment card numbers; each is validated (octets up to 255, calendar dates, issued number ranges, Luhn check digits) and what
doesn't validate is left as it is. A value is replaced by a keyed permutation of the values of its own format, a Feistel
network of ROUNDS rounds with SHA-256 as round function:

* cards: 13 to 19 digits between two borders of groups within a run of digits and single blanks or hyphens, so that a
  number beside the card doesn't hide it; where two overlap, the length that comes first in CARD_LENGTHS, then the first one.
  The digits before the check digit are permuted and a new check digit is worked out; separators stay. Runs of more than
  RUN_DIGITS digits are looked at in parts that end at such borders;
* dates: the days of 1800 to 2199 are permuted among themselves and written in the same format;
* social security numbers: permuted among all that can be issued; IPv4 addresses among all addresses;
* phone numbers: the country code stays, the national digits are permuted as one number and put back into the shape, so
  all ways to write a number stay linked. A number ends with its tenth national digit after +1, with the eleventh at most after others;
* e-mail addresses before the last label: digits are permuted to digits and letters a-z to such letters in lower case; upper
  case comes back by place. Letters beyond ASCII and marks stay in place.

As the permutation depends on nothing but key and kind, equal values get equal pseudonyms in all documents and unlike
values unlike ones. All of it is column expressions; texts without two neighbouring digits or an @ are not searched.

Nulls and empty texts stay as they are. Rows are neither dropped nor joined, so repeated rows give repeated results. All
other columns pass through, whatever their names: the matches are held in a column of an unused name, which isn't returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalens.llm.common import unused

ROUNDS = 8

#: Digits of a card number in order of preference, and of the longest run that is looked at as one.
CARD_LENGTHS = (16, 15, 14, 13, 19, 18, 17)
RUN_DIGITS = 64

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_LETTER = r"[\p{L}\p{N}"
_EMAIL = rf"(?<!{_LETTER}._%+-]){_LETTER}._%+-]+@{_LETTER}-]+(?:\.{_LETTER}-]+)*\.\p{{L}}{{2,}}"
_IP = rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)"
_DATE = r"(?<![\d/-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})(?![\d/-])"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
# Country codes of one and of two digits; all others have three.
_COUNTRY = r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_NATIONAL = r"(?:[ .-]?\(?\d\)?)"
_PLAIN_PHONE = r"(?:\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})"
_PHONE = rf"(?<![\d+])(?:\+1{_NATIONAL}{{10}}|(?!\+1){_COUNTRY}{_NATIONAL}{{6,11}}|{_PLAIN_PHONE})(?!\d)"
_RUN = rf"(?<!\d)\d(?:[ -]?\d){{{min(CARD_LENGTHS) - 1},{RUN_DIGITS - 1}}}(?!\d)"
#: In order of preference where two could begin at one place.
PATTERN = "|".join((_EMAIL, _IP, _DATE, _SSN, _PHONE, _RUN))
_ANY = r"\d[ .-]?\d|@"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once: inside a lambda an expression is worked out again wherever it stands."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hash(key: str, kind: str, r: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), r.cast("string"), value.cast("string")).cast("binary"), 256)


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("long")


def permute(x: Column, high: Column | int, low: Column | int, key: str, kind: str, rounds: int = ROUNDS) -> Column:
    """Keyed permutation of the integers 0 .. high * low - 1 (unbalanced Feistel network on quotient and remainder)."""
    def lit(v):
        return v if isinstance(v, Column) else F.lit(v).cast("long")

    first = F.struct(F.floor(x / lit(low)).cast("long").alias("l"), F.pmod(x, lit(low)).cast("long").alias("r"), lit(high).alias("m"), lit(low).alias("n")) \
        if not isinstance(x, tuple) else F.struct(x[0].alias("l"), x[1].alias("r"), lit(high).alias("m"), lit(low).alias("n"))
    last = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, lambda s, i: F.struct(
        s["r"].alias("l"), F.pmod(s["l"] + _number(F.substring(_hash(key, kind, i, s["r"]), 1, 15)), s["m"]).alias("r"),
        s["n"].alias("m"), s["m"].alias("n")))
    return F.struct(last["l"].alias("high"), last["r"].alias("low"))


def _turn(char: Column, by: Column) -> Column:
    code = F.ascii(char)

    def within(start: str, size: int) -> Column:
        return F.char(F.lit(ord(start)) + F.pmod(code - ord(start) + by, F.lit(size)))

    return F.when(char.between("0", "9"), within("0", 10)).when(char.between("a", "z"), within("a", 26)) \
        .when(char.between("A", "Z"), within("A", 26)).otherwise(char)


def permute_text(s: Column, key: str, kind: str, rounds: int = ROUNDS) -> Column:
    """Keyed permutation of the texts of the shape of ``s`` (two characters at least): a Feistel network on its halves."""
    def added(text: Column, digest: Column) -> Column:
        return _let(digest, lambda d: F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: _let(
            _number(F.substr(d, 1 + F.pmod((i - 1) * 3, F.lit(60)), F.lit(3))), lambda by: _turn(F.substr(text, i, F.lit(1)), by))), ""))

    half = F.floor(F.length(s) / 2).cast("int")
    first = F.struct(F.left(s, half).alias("l"), F.right(s, F.length(s) - half).alias("r"))
    last = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first,
                       lambda t, i: F.struct(t["r"].alias("l"), added(t["l"], _hash(key, kind, i, t["r"])).alias("r")))
    return F.concat(last["l"], last["r"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def luhn_digit(payload: Column) -> Column:
    """The check digit of a text of digits."""
    n = F.length(payload)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + _luhn_value(F.substr(payload, i, F.lit(1)).cast("int"), F.pmod(n - i, F.lit(2)) == 0))
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def _luhn_value(digit: Column, doubled: Column) -> Column:
    return F.when(doubled & (digit > 4), digit * 2 - 9).when(doubled, digit * 2).otherwise(digit)


def _with_digits(shape: Column, digits: Column) -> Column:
    """``shape`` (digits, blanks and marks of numbers) with its digits replaced by ``digits`` in order."""
    def placed(new: Column) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), lambda i: F.when(
            F.substr(shape, i, F.lit(1)).between("0", "9"), F.substr(new, F.length(F.translate(F.left(shape, i), " -.()+", "")), F.lit(1)))
            .otherwise(F.substr(shape, i, F.lit(1)))), "")

    return _let(digits, placed)


def _card(digits: Column, key: str) -> Column:
    """The pseudonym of the digits of a card number."""
    payload = F.left(digits, F.length(digits) - 1)
    low = F.floor(F.length(payload) / 2).cast("int")
    high = F.length(payload) - low
    pair = permute((F.left(payload, high).cast("long"), F.right(payload, low).cast("long")),
                   F.pow(F.lit(10), high).cast("long"), F.pow(F.lit(10), low).cast("long"), key, "card")
    new = _let(pair, lambda p: F.concat(F.lpad(p["high"].cast("string"), high, F.lit("0")), F.lpad(p["low"].cast("string"), low, F.lit("0"))))
    return _let(new, lambda n: F.concat(n, luhn_digit(n)))


def _valid_cards(digits: Column, borders: Column) -> Column:
    """Spans of a run's digits that begin and end at borders and pass the Luhn check, in order of preference."""
    def of_length(size: int) -> Column:
        starts = F.filter(borders, lambda a: F.array_contains(borders, a + size))
        starts = F.filter(starts, lambda a: luhn_digit(F.substr(digits, a + 1, F.lit(size - 1))) == F.substr(digits, a + size, F.lit(1)))
        return F.transform(starts, lambda a: F.struct(a.alias("start"), (a + size).alias("end")))

    return F.concat(*[of_length(size) for size in CARD_LENGTHS])


def _cards(m: Column, key: str) -> Column:
    """A run of digits with its card numbers replaced."""
    # Borders of groups, as numbers of digits before them: at most RUN_DIGITS + 1.
    borders = F.aggregate(F.split(m, "[ -]"), F.array(F.lit(0)), lambda acc, g: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(g))))

    def replaced(digits: Column, valid: Column) -> Column:
        chosen = F.aggregate(valid, F.slice(valid, 1, 0), lambda acc, c: F.when(
            F.exists(acc, lambda x: (x["start"] < c["end"]) & (c["start"] < x["end"])), acc).otherwise(F.concat(acc, F.array(c))))
        done = F.aggregate(F.array_sort(chosen), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), lambda acc, c: F.struct(
            c["end"].alias("at"), F.concat(acc["out"], F.substr(digits, acc["at"] + 1, c["start"] - acc["at"]),
                                           _let(F.substr(digits, c["start"] + 1, c["end"] - c["start"]), lambda d: _card(d, key))).alias("out")))
        return _let(done, lambda d: F.concat(d["out"], F.substr(digits, d["at"] + 1, F.length(digits))))

    return _let(_digits(m), lambda digits: _let(borders, lambda b: _let(_valid_cards(digits, b), lambda valid: F.when(
        F.size(valid) == 0, m).otherwise(_with_digits(m, replaced(digits, valid))))))


def _ip(m: Column, key: str) -> Column:
    o = [F.split_part(m, F.lit("."), F.lit(i)).cast("long") for i in (1, 2, 3, 4)]
    return _let(permute((o[0] * 256 + o[1], o[2] * 256 + o[3]), 65536, 65536, key, "ip"), lambda p: F.concat_ws(
        ".", *[F.pmod(F.floor(p[side] / F.lit(by)).cast("long"), F.lit(256)).cast("string") for side in ("high", "low") for by in (256, 1)]))


def _date(m: Column, key: str) -> Column:
    def one(form: str, other: Column) -> Column:
        day = F.try_to_timestamp(m, F.lit(form)).cast("date")
        start = F.to_date(F.lit("1800-01-01"))
        p = permute(F.datediff(day, start).cast("long"), 189, 773, key, "date")  # 146,097 days are 400 years
        moved = F.date_add(start, (p["high"] * 773 + p["low"]).cast("int"))
        return F.when(F.year(day).between(1800, 2199), F.date_format(moved, form)).otherwise(other)

    return F.when(m.contains("-"), one("yyyy-MM-dd", m)).otherwise(one("dd/MM/yyyy", one("MM/dd/yyyy", m)))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.split_part(m, F.lit("-"), F.lit(i)).cast("long") for i in (1, 2, 3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)
    p = permute((index * 99 + group - 1, serial - 1), 898 * 99, 9999, key, "ssn")
    place = F.floor(p["high"] / F.lit(99)).cast("long")
    new_area = F.when(place >= 665, place + 2).otherwise(place + 1)
    return F.when(valid, F.format_string("%03d-%02d-%04d", new_area, F.pmod(p["high"], F.lit(99)) + 1, p["low"] + 1)).otherwise(m)


def _phone(m: Column, key: str) -> Column:
    code = F.regexp_extract(m, rf"^{_COUNTRY}", 0)
    shape = F.substr(m, F.length(code) + 1)
    return F.concat(code, _with_digits(shape, permute_text(_digits(shape), key, "phone")))


def _email(m: Column, key: str) -> Column:
    last = F.regexp_extract(m, r"\.\p{L}+$", 0)
    address = F.left(m, F.length(m) - F.length(last))
    plain = F.translate(address, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    cased = _let(permute_text(plain, key, "email"), lambda new: F.array_join(F.transform(F.sequence(F.lit(1), F.length(address)), lambda i: F.when(
        F.substr(address, i, F.lit(1)).between("A", "Z"), F.upper(F.substr(new, i, F.lit(1)))).otherwise(F.substr(new, i, F.lit(1)))), ""))
    return F.concat(cased, last)


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of one match of PATTERN, or the match itself if it doesn't validate."""
    return F.when(m.contains("@"), _email(m, key)).when(m.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), _ip(m, key)) \
        .when(m.rlike(r"^(\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4})$"), _date(m, key)).when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), _ssn(m, key)) \
        .when(m.rlike(rf"^\+|^{_PLAIN_PHONE}$"), _phone(m, key)).otherwise(_cards(m, key))


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced, and on wish the number of places (values, runs of digits) replaced.

    All columns stay, in order; an existing column of the name ``count_col`` is replaced.
    """
    text = F.col(f"`{text_col}`")
    search = F.coalesce(text.rlike(_ANY), F.lit(False))
    found = F.when(search, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    mark = unused([*docs.columns, count_col or ""], "matches")
    one = docs.withColumn(mark, found)
    pairs = F.transform(F.col(mark), lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("new")))
    two = one.withColumn(mark, F.when(F.size(mark) > 0, pairs))
    pieces = F.split(text, PATTERN)
    whole = F.array_join(F.zip_with(pieces, F.concat(F.transform(F.col(mark), lambda p: p["new"]), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    count = F.coalesce(F.size(F.filter(F.col(mark), lambda p: p["old"] != p["new"])), F.lit(0)).cast("long")
    kept = [F.when(F.col(mark).isNotNull(), whole).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`")
            for c in docs.columns if c != count_col]
    return two.select(*kept, *([count.alias(count_col)] if count_col else []))
