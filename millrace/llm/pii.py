"""Format-preserving pseudonyms for personal numbers, dates and addresses, by keyed Feistel networks.

All of it is column expressions. A text is cut at its candidates once; each is validated by its kind's own
rule and, if it passes, replaced by a permutation of itself within its format. The permutation depends on
the key, the kind and the value alone, so equal values stay equal in all documents, and different ones stay
different.

=======  ====================================================  ===========================================
kind     validated by                                          permuted
=======  ====================================================  ===========================================
email    its grammar                                           letters and digits before the ``@``
ip       four numbers up to 255, no zeros before                the 32 bits
date     a day of the years 1800 to 2199 (ISO, or day and      the day within those 400 years
         month in either order before the year)
ssn      issued ranges of its three groups                     the issued ranges
phone    ``+``, country code, 8 to 15 digits in all            digits after the country code, however spaced
card     13 to 19 digits with a right Luhn digit               all but the first digit and the Luhn digit,
                                                               which is made right again
=======  ====================================================  ===========================================
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.llm.let import let

ROUNDS = 8
KINDS = ("email", "ip", "date", "ssn", "phone", "card")

_PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![\d.])(?:0|[1-9]\d{0,2})(?:\.(?:0|[1-9]\d{0,2})){3}(?!\.?\d)",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}([./])\d{2}\1\d{4})(?![./-]?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!-?\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![ -]?\d)",
}
#: One pattern for all kinds; the groups' number changes with their place, so the date's is named.
PATTERN = "|".join(p.replace("([./])", "(?<cut>[./])").replace(r"\1", r"\k<cut>") for p in _PATTERNS.values())

#: Days from 1800-01-01 to 2199-12-31: the calendar's period of 400 years, 146,097 = 189 * 773.
_FIRST_DAY, _DAYS = "1800-01-01", (189, 773)
_SSN = (898, 99 * 9999)
#: Country calling codes have one digit, or two if they start so; all others have three.
_COUNTRY = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _digest(key: str, kind: str, i: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), value.cast("string")), 256)


def _mod_feistel(key: str, kind: str, left: Column, right: Column, sizes: tuple[int, int], written: Callable[[Column], Column]) -> Column:
    """``written`` of a permutation of pairs below ``sizes``: either half in turn moves by a hash of the other."""

    def turn(pair: Column, i: Column) -> Column:
        def moved(half: Column, other: Column, size: int) -> Column:
            step = F.conv(F.substring(_digest(key, kind, i, other), 1, 12), 16, 10).cast("long")
            return ((half + step) % size).cast("long")

        on_left = i % 2 == 0
        return F.struct(
            F.when(on_left, moved(pair["l"], pair["r"], sizes[0])).otherwise(pair["l"]).alias("l"),
            F.when(on_left, pair["r"]).otherwise(moved(pair["r"], pair["l"], sizes[1])).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return let(F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn), written)


def _text_feistel(key: str, kind: str, value: Column) -> Column:
    """A permutation of strings that keeps lengths and which characters are digits, a-z, A-Z or others."""

    def moved(letters: Column, digest: Column) -> Column:
        def letter(c: Column, i: Column) -> Column:
            n = F.conv(F.substring(digest, i % 16 * 4 + 1, F.lit(4)), 16, 10).cast("int")

            def within(first: str, last: str) -> Column:
                return F.char(F.lit(ord(first)) + (F.ascii(c) - ord(first) + n) % (ord(last) - ord(first) + 1))

            return F.when(c.between("0", "9"), within("0", "9")).when(c.between("a", "z"), within("a", "z")).when(c.between("A", "Z"), within("A", "Z")).otherwise(c)

        return F.transform(letters, letter)

    def turn(pair: Column, i: Column) -> Column:
        new = let(_digest(key, kind, i, F.array_join(pair["r"], "")), lambda d: moved(pair["l"], d))
        return F.struct(pair["r"].alias("l"), new.alias("r"))

    def halves(letters: Column) -> Column:
        middle = F.floor(F.size(letters) / 2).cast("int")
        start = F.struct(F.slice(letters, F.lit(1), middle).alias("l"), F.slice(letters, middle + 1, F.size(letters)).alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda p: F.array_join(F.concat(p["l"], p["r"]), ""))

    return let(F.filter(F.split(value, ""), lambda c: c != ""), halves)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _into(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits``, one by one."""

    def filled(x: Column) -> Column:
        def letter(c: Column, i: Column) -> Column:
            before = F.size(F.filter(F.slice(x["shape"], F.lit(1), i), lambda b: b.between("0", "9")))
            return F.when(c.between("0", "9"), F.get(x["digits"], before)).otherwise(c)

        return F.array_join(F.transform(x["shape"], letter), "")

    return let(F.struct(F.split(shape, "").alias("shape"), F.split(digits, "").alias("digits")), filled)


def _luhn(digits: Column) -> Column:
    def total(letters: Column) -> Column:
        def add(sum_: Column, d: Column) -> Column:
            return sum_ + d - F.when(d > 9, 9).otherwise(0)

        worth = F.transform(F.reverse(letters), lambda c, i: c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1))
        return F.aggregate(worth, F.lit(0), add)

    return let(F.split(digits, ""), total)


def _number(value: Column, cut: str, i: int) -> Column:
    return F.element_at(F.split(value, cut), i).cast("long")


def _date_format(value: Column) -> Column:
    """The format in which ``value`` is a day of the years covered; null if it is none."""
    shape = F.regexp_replace(value, r"\d", "")
    out = None
    for mark, formats in (("--", ("yyyy-MM-dd",)), ("..", ("dd.MM.yyyy", "MM.dd.yyyy")), ("//", ("dd/MM/yyyy", "MM/dd/yyyy"))):
        for f in formats:
            fits = (shape == mark) & F.year(F.try_to_timestamp(value, F.lit(f))).between(1800, 2199)
            out = F.when(fits, f) if out is None else out.when(fits, f)
    return out


def kind_of(value: Column) -> Column:
    """The kind of a candidate that its own rule accepts, else null."""
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("int") <= 255)
    area, group, serial = (_number(value, "-", i) for i in (1, 2, 3))
    rules = {
        "email": value.contains("@"),
        "ip": value.rlike(r"^\d+(\.\d+){3}$") & F.forall(octets, lambda x: x),
        "ssn": value.rlike(r"^\d{3}-\d{2}-\d{4}$") & area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0),
        "phone": value.startswith("+") & F.length(_digits(value)).between(8, 15),
        "date": value.rlike(r"^(\d{4}-\d\d-\d\d|\d\d[./]\d\d[./]\d{4})$") & _date_format(value).isNotNull(),
        "card": value.rlike(r"^\d[\d -]*\d$") & F.length(_digits(value)).between(13, 19) & (_luhn(_digits(value)) % 10 == 0),
    }
    out = None
    for kind, rule in rules.items():
        out = F.when(rule, kind) if out is None else out.when(rule, kind)
    return out


def _ip(key: str, value: Column) -> Column:
    o = [_number(value, r"\.", i) for i in (1, 2, 3, 4)]

    def written(pair: Column) -> Column:
        parts = [F.floor(pair["l"] / 256), pair["l"] % 256, F.floor(pair["r"] / 256), pair["r"] % 256]
        return F.concat_ws(".", *(p.cast("string") for p in parts))

    return _mod_feistel(key, "ip", o[0] * 256 + o[1], o[2] * 256 + o[3], (65536, 65536), written)


def _date(key: str, value: Column) -> Column:
    first = F.lit(_FIRST_DAY).cast("date")

    def written(f: str) -> Column:
        day = F.date_diff(F.try_to_timestamp(value, F.lit(f)).cast("date"), first)

        def named(pair: Column) -> Column:
            return F.date_format(F.date_add(first, (pair["l"] * _DAYS[1] + pair["r"]).cast("int")), f)

        return let(day, lambda d: _mod_feistel(key, "date", F.floor(d / _DAYS[1]), d % _DAYS[1], _DAYS, named))

    kind, out = _date_format(value), None
    for f in ("yyyy-MM-dd", "dd.MM.yyyy", "MM.dd.yyyy", "dd/MM/yyyy", "MM/dd/yyyy"):
        out = F.when(kind == f, written(f)) if out is None else out.when(kind == f, written(f))
    return out


def _ssn(key: str, value: Column) -> Column:
    area, group, serial = (_number(value, "-", i) for i in (1, 2, 3))
    place = area - F.when(area > 666, 2).otherwise(1)

    def written(pair: Column) -> Column:
        shown = pair["l"] + F.when(pair["l"] >= 665, 2).otherwise(1)
        return F.format_string("%03d-%02d-%04d", shown, (F.floor(pair["r"] / 9999) + 1).cast("long"), pair["r"] % 9999 + 1)

    return _mod_feistel(key, "ssn", place, (group - 1) * 9999 + serial - 1, _SSN, written)


def _phone(key: str, value: Column) -> Column:
    """The country code is told by the digits alone, so spacing makes no other number of it."""

    def made(digits: Column) -> Column:
        code = F.regexp_extract(digits, _COUNTRY, 0)
        rest = F.substring(digits, F.length(code) + 1, F.length(digits))
        return _into(value, F.concat(code, _text_feistel(key, "phone", rest)))

    return let(_digits(value), made)


def _card(key: str, value: Column) -> Column:
    def made(digits: Column) -> Column:
        return F.concat(F.substring(digits, 1, 1), _text_feistel(key, "card", F.substring(digits, F.lit(2), F.length(digits) - 2)))

    def checked(body: Column) -> Column:
        last = (10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
        return _into(value, F.concat(body, last.cast("string")))

    return let(let(_digits(value), made), checked)


def _email(key: str, value: Column) -> Column:
    name = F.substring_index(value, "@", 1)
    return F.concat(_text_feistel(key, "email", name), F.substring(value, F.length(name) + 1, F.length(value)))


_PSEUDONYMS: dict[str, Callable[[str, Column], Column]] = {"email": _email, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def pseudonym(kind: Column, value: Column, key: str) -> Column:
    out = None
    for name, made in _PSEUDONYMS.items():
        out = F.when(kind == name, made(key, value)) if out is None else out.when(kind == name, made(key, value))
    return out.otherwise(value)


def pseudonymise(df: DataFrame, key: str, text_col: str = "text", kinds_col: str | None = None) -> DataFrame:
    """``df`` with each validated personal value in ``text_col`` replaced by its pseudonym.

    ``kinds_col`` names a further column (replacing one of that name): the kinds of the replaced values, in
    order, repeats included. Null texts stay null (no kinds), others without such values stay as they are; a
    candidate that fails its rule stays too. Rows keep their other columns, and nothing is moved between
    rows. Who holds ``key`` can undo the pseudonyms: keep it as secret as the data.
    """
    found, cut = flat.fresh(df, "found", "cut")
    text = F.col(text_col)
    values = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    # A text without digit or @ has no candidate; most have none, and are not searched.
    values = F.when(text.rlike("[0-9@]"), values).otherwise(F.array().cast("array<string>"))
    marked = df.withColumn(found, F.transform(values, lambda v: F.struct(kind_of(v).alias("kind"), v.alias("value"))))
    made = F.transform(found, lambda f: pseudonym(f["kind"], f["value"], key))
    cut = F.split(text, PATTERN, -1)
    joined = F.array_join(F.zip_with(cut, F.concat(made, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    some = F.exists(found, lambda f: f["kind"].isNotNull())
    out = marked.withColumn(text_col, F.when(some, joined).otherwise(text))
    kinds = F.filter(F.transform(found, lambda f: f["kind"]), lambda k: k.isNotNull())
    if kinds_col is not None:
        out = out.withColumn(kinds_col, F.when(F.col(text_col).isNotNull(), kinds))
    return out.drop(found)
