import datetime
import hashlib
import re


from millrace.llm import pii
from millrace.llm.queries import PSEUDONYM_KEY, QUERIES

SF = "/root/testdata/sf0.001"
KEY = "k"


def digest(key, kind, i, value):
    return hashlib.sha256(f"{key}|{kind}|{i}|{value}".encode()).hexdigest()


def mod_feistel(key, kind, left, right, sizes):
    for i in range(8):
        if i % 2 == 0:
            left = (left + int(digest(key, kind, i, right)[:12], 16)) % sizes[0]
        else:
            right = (right + int(digest(key, kind, i, left)[:12], 16)) % sizes[1]
    return left, right


def text_feistel(key, kind, value):
    left, right = value[: len(value) // 2], value[len(value) // 2 :]
    for i in range(8):
        d, out = digest(key, kind, i, right), []
        for n, c in enumerate(left):
            step = int(d[n % 16 * 4 : n % 16 * 4 + 4], 16)
            for first, size in (("0", 10), ("a", 26), ("A", 26)):
                if ord(first) <= ord(c) < ord(first) + size:
                    c = chr(ord(first) + (ord(c) - ord(first) + step) % size)
                    break
            out.append(c)
        left, right = right, "".join(out)
    return left + right


def luhn(d):
    return sum(x - 9 * (x > 9) for i, c in enumerate(reversed(d)) for x in [int(c) * (1 + i % 2)])


def into(shape, digits):
    it = iter(digits)
    return re.sub("[0-9]", lambda _: next(it), shape)


TWO = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()


def replace(key, v):
    """Kind and pseudonym of one candidate, written anew in Python."""
    digits = re.sub("[^0-9]", "", v)
    if "@" in v:
        name, at, rest = v.partition("@")
        return "email", text_feistel(key, "email", name) + at + rest
    if re.fullmatch(r"\d+(\.\d+){3}", v):
        o = list(map(int, v.split(".")))
        if max(o) > 255:
            return None, v
        a, b = mod_feistel(key, "ip", o[0] * 256 + o[1], o[2] * 256 + o[3], (65536, 65536))
        return "ip", f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if re.fullmatch(r"\d{3}-\d{2}-\d{4}", v):
        a, g, s = map(int, v.split("-"))
        if not (0 < a < 900 and a != 666 and g and s):
            return None, v
        a, r = mod_feistel(key, "ssn", a - (2 if a > 666 else 1), (g - 1) * 9999 + s - 1, (898, 99 * 9999))
        return "ssn", f"{a + (2 if a >= 665 else 1):03d}-{r // 9999 + 1:02d}-{r % 9999 + 1:04d}"
    if v.startswith("+"):
        if not 8 <= len(digits) <= 15:
            return None, v
        size = 1 if digits[0] in "17" else 2 if digits[:2] in TWO else 3
        return "phone", into(v, digits[:size] + text_feistel(key, "phone", digits[size:]))
    if re.fullmatch(r"\d{4}-\d\d-\d\d|\d\d[./]\d\d[./]\d{4}", v):
        for f in ("%Y-%m-%d", "%d.%m.%Y", "%m.%d.%Y", "%d/%m/%Y", "%m/%d/%Y"):
            try:
                day = datetime.datetime.strptime(v, f).date()
            except ValueError:
                continue
            if not 1800 <= day.year <= 2199:
                continue
            first = datetime.date(1800, 1, 1)
            n = (day - first).days
            a, b = mod_feistel(key, "date", n // 773, n % 773, (189, 773))
            return "date", (first + datetime.timedelta(a * 773 + b)).strftime(f)
        return None, v
    if 13 <= len(digits) <= 19 and luhn(digits) % 10 == 0:
        body = digits[0] + text_feistel(key, "card", digits[1:-1])
        return "card", into(v, body + str((10 - luhn(body + "0") % 10) % 10))
    return None, v


def rewrite(key, text):
    if text is None:
        return None, None
    kinds = []
    pattern = re.sub(r"\?<cut>", "?P<cut>", pii.PATTERN).replace(r"\k<cut>", "(?P=cut)")

    def one(m):
        kind, out = replace(key, m.group())
        if kind:
            kinds.append(kind)
        return out

    return re.sub(pattern, one, text, flags=re.ASCII), kinds


TEXTS = [
    None,
    "",
    "nothing here",
    "write to anna.b+X9@mail3.example.com, or a@b.co.",
    "hosts 010.1.1.1, 10.1.01.1 and 10.1.1.1 42.144.35.254. and 300.1.1.1 and 1.2.3.4.5 and 0.0.0.0",
    "born 1999-12-31, 31.12.1999, 12/31/1999 and 05/06/2020, not 2023-02-30 nor 1500-01-01 or 2020-01-011",
    "ssn 123-45-6789 and 665-01-0001, 667-99-9999; not 666-12-1234 nor 000-12-3456 or 123-00-4567",
    "call +1 (988) 555-2485 or +49 30 1234567 or +15551234567! +352 621 123 456, +7 912 345-67-89, +491701234567",
    "pay 4041894974608795 or 4041 8949 7460 8795 or 4041-8949-7460-8795, not 4041894974608796 or 1234567890123",
    "mixed é ü 4041894974608795ß a@b.co 4041894974608795",
    "a@b.co" * 3,
    "9" * 500,
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0",
]


def test_texts(spark):
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(TEXTS)], "doc_id long, text string, _found string, kinds string")
    got = {r.doc_id: (r.text, r.kinds) for r in pii.pseudonymise(df, KEY, kinds_col="kinds").collect()}
    assert got == {i: rewrite(KEY, t) for i, t in enumerate(TEXTS)}
    assert pii.pseudonymise(df, KEY).columns == df.columns


def test_equal_values_stay_equal_and_different_ones_different(spark):
    values = [f"{a}.{b}.7.9" for a in range(40) for b in range(40)]
    df = spark.createDataFrame([(v,) for v in values + values], "text string")
    out = [r.text for r in pii.pseudonymise(df, KEY).collect()]
    assert out[: len(values)] == out[len(values) :] and len(set(out)) == len(values) and not set(out) == set(values)


def test_permutations_have_no_fixed_domain_gaps():
    days = {mod_feistel("x", "date", n // 773, n % 773, (189, 773)) for n in range(0, 146_097)}
    assert len(days) == 146_097


def test_written_alike_everywhere(spark):
    alike = {
        "card": ["4041894974608795", "4041 8949 7460 8795", "4041-8949-7460-8795"],
        "phone": ["+491701234567", "+49 170 1234567", "+49 (170) 123-4567", "+49.170.12.34567"],
        "date": ["1999-12-31", "31.12.1999", "12/31/1999"],
        "ip": ["10.1.2.3", "10.1.2.3."],
        "ssn": ["123-45-6789", "(123-45-6789)"],
        "email": ["anna@b.co", "<anna@b.co>"],
    }
    rows = [(kind, v) for kind, values in alike.items() for v in values]
    out = pii.pseudonymise(spark.createDataFrame(rows, "kind string, text string"), KEY, kinds_col="kinds").collect()
    assert all(r.kinds == [r.kind] for r in out)
    for kind, values in alike.items():
        texts = [r.text for r in out if r.kind == kind]
        if kind == "date":
            texts = {datetime.datetime.strptime(t, f).date() for t, f in zip(texts, ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y"), strict=True)}
        else:
            texts = {re.sub("[^0-9]", "", t) if kind in ("card", "phone") else t.strip("().<>") for t in texts}
        assert len(texts) == 1 and texts.isdisjoint({re.sub("[^0-9]", "", values[0]), values[0]})


def test_long_values_and_texts(spark):
    long = ["x@" + "a." * 500_000 + "com", "y" * 1_000_000 + "@b.co", "1." * 500_000, "+" + "1" * 1_000_000, "1-" * 500_000, "4041894974608795 " * 3_000, "2020-01-01 " * 3_000, "@" * 1_000_000, "9" * 1_000_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(long)], "doc_id int, text string")
    got = {r.doc_id: (r.text, r.kinds) for r in pii.pseudonymise(df, KEY, kinds_col="kinds").collect()}
    assert got == {i: rewrite(KEY, t) for i, t in enumerate(long)}


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, TEXTS[3])] * 3, "doc_id int, text string")
    assert pii.pseudonymise(df.limit(0), KEY).count() == 0
    assert [tuple(r) for r in pii.pseudonymise(df, KEY).collect()] == [(1, rewrite(KEY, TEXTS[3])[0])] * 3


def test_no_python_in_the_plan(spark):
    plan = pii.pseudonymise(spark.createDataFrame([("a",)], "text string"), KEY)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.text, list(r.kinds)) for r in QUERIES["op10_pii_pseudonyms"](spark, SF).collect()}
    assert got == {r.doc_id: rewrite(PSEUDONYM_KEY, r.text) for r in rows}
    assert sum(len(k) for _, k in got.values()) > 3
