from collections import defaultdict

import regex

from millrace.llm.decontaminate import NUMBER_WORDS, UNITS, contaminated, drop_contaminated
from millrace.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
TYPES = {u: kind for kind, line in UNITS.items() for u in line.split() if "/" not in u}
SLOTS = {"<num>", "<name>", *UNITS}
WORD = regex.compile(r"(?V1)(?:[\p{L}\p{M}])+|\p{N}+(?:[.,]\p{N}+)*|[.!?\n]")


def canonical(text, inside=False):
    text = text or ""
    words, first, shouted = [], not inside, False
    for m in WORD.finditer(text):
        w = m.group()
        if w in ".!?\n":
            first, shouted = True, False
            continue
        low = w.lower()
        before = words[-1] if words and not first else None
        joint = text[words[-1]["end"] : m.start()] if words else ""
        opens = first and w[0].isupper()
        if w[0].isnumeric() or low in NUMBER_WORDS:
            kind, opens = "<num>", False
        elif before and before["number"] and low in TYPES:
            kind = TYPES[low]
        elif not first and w[0].isupper() and not shouted:
            kind = "<name>"
        else:
            kind = low
        joined = joint in (" ", "-") and before and (
            (kind == "<name>" and before["name"]) or (low in NUMBER_WORDS and before["number"])
        )
        one = {"kind": kind, "low": low, "end": m.end(), "number": kind == "<num>", "name": kind == "<name>" or opens}
        if joined:
            one["low"] = before["low"] + " " + low
            words[-1] = one
        else:
            words.append(one)
        shouted = len(w) > 1 and w.isupper()
        first = False
    return [(w["kind"], w["low"]) for w in words]


def brute(docs, items, width=8, coverage=0.5):
    found = {}
    asked = []
    for item, text in items:
        for inside in (False, True):
            c = canonical(text, inside)
            if len(c) >= 4:
                w = min(width, len(c))
                asked.append((item, c, w, [0] if inside else range(len(c) - w + 1)))
    for doc, text in docs:
        c = canonical(text)
        place = defaultdict(list)
        for w in {a[2] for a in asked}:
            for i in range(len(c) - w + 1):
                place[tuple(k for k, _ in c[i : i + w])].append(i)
        met = defaultdict(lambda: (set(), set(), set(), 0))
        for item, ic, w, starts in asked:
            for i in starts:
                for j in place[tuple(k for k, _ in ic[i : i + w])]:
                    at, every, held, _ = met[item, j - i]
                    at.add(i)
                    for k in range(w):
                        pair = ic[i + k][1], c[j + k][1]
                        every.add(pair)
                        if i + k not in (0, len(ic) - 1) or c[j + k][0] not in SLOTS:
                            held.add(pair)
                    met[item, j - i] = at, every, held, max(1, len(ic) - width + 1)
        for (item, _), (at, every, held, n) in met.items():
            exact = all(a == b for a, b in every)
            if len(at) / n >= coverage and (exact or len(held) == len({a for a, _ in held})):
                found[doc, item] = max(found.get((doc, item), (0, False)), (len(at) / n, exact))
    return found


ITEMS = [
    (1, "Anna has 12 apples and gives 5 apples to Ben, who walks 3 km to the market. How many apples has Anna left?"),
    (2, "Short question about seven things only"),
    (3, "too short"),
    (4, None),
    (5, "The train leaves at 9.30 and arrives at 11.45 after 120 km. What is its speed in km/h?"),
]
DOCS = [
    (0, None),
    (1, ""),
    (2, "Before. " + ITEMS[0][1] + " After."),
    (3, "It says: Lena has 90 apples and gives 7 apples to Otto, who walks 8 miles to the market. How many apples has Lena left? 83."),
    (4, "Lena has 90 apples and gives 7 apples to Otto, who walks 8 miles to the market. How many apples has Maria left?"),
    (5, "so a short question about seven things only here"),
    (6, "the train leaves at 7.10 and arrives at 8.05 after 95 miles. what is its speed in m"),
    (7, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 A B C D E F G H I"),
    (8, "apples " * 5000),
    (9, "He left. " + "ANNA HAS 12 APPLES"),
]


def rows(df):
    return {(r.doc_id, r.item_id): (r.coverage, r.exact) for r in df.collect()}


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, h int, item string")
    return d, spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, h int")


def test_texts(spark):
    d, b = frames(spark, DOCS, ITEMS)
    got = rows(contaminated(d, b))
    assert got == brute(DOCS, ITEMS)
    assert got[2, 1][1] and not got[3, 1][1] and {(5, 2), (6, 5)} <= got.keys()
    kept = drop_contaminated(d, b)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _ in DOCS} - {i for i, _ in got})


def test_asked_otherwise(spark):
    """Names and numbers of other lengths, units of the same kind; another kind of unit is another question."""
    item = [(1, "On Monday the baker Mary Ann Miller sells nine loaves and 14 rolls to old Peter, who walks 3 km home. How many loaves has Mary Ann Miller left now?")]
    docs = [
        (1, "He asked. On Friday the baker Otto sells twenty-two loaves and 3 rolls to old Jean Paul, who walks two miles home. How many loaves has Otto left now?"),
        (2, "On Monday the baker Mary Ann Miller sells nine loaves and 14 rolls to old Peter, who walks 3 hours home. How many"),
        (3, "On Friday the baker Otto sells 2 loaves and 3 rolls to old Jean, who walks 2 miles home. How many loaves has Jean left now?"),
    ]
    d, b = frames(spark, docs, item)
    got = rows(contaminated(d, b))
    assert got == brute(docs, item) and got[1, 1] == (1.0, False) and (3, 1) not in got


def test_names_that_go_on(spark):
    """Names around an item run together with its first and last word, which stand in it as other words too."""
    item = [(1, "Of all the lands that lie west of the river Anna likes best the one that looks on Paris")]
    docs = [(1, "they saw Peter Of all the lands that lie west of the river Anna likes best the one that looks on Paris Match and went")]
    d, b = frames(spark, docs, item)
    assert rows(contaminated(d, b)) == brute(docs, item) == {(1, 1): (1.0, False)}


def test_runs_of_numbers(spark):
    """One key at every place of text and items, over several blocks. A text of one number holds them all, as
    each slot value has one value there."""
    numbers = [str(i * i) for i in range(20_000)]
    items = [(i, " ".join(numbers[i * 3000 : i * 3000 + 300])) for i in range(3)]
    d, b = frames(spark, [(1, " ".join(numbers)), (2, " ".join(["7"] * 5000)), (3, "words alone, none of them a figure at all, eight at least")], items)
    assert rows(contaminated(d, b)) == {(d, i): (1.0, d == 1) for d in (1, 2) for i in range(3)}


def test_long_item_over_blocks(spark):
    """An item longer than a block of words, at both ends of texts and between blocks; half of it is enough."""
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(6000)]
    item = " ".join(words[1000:3500])
    texts = [(1, " ".join(words)), (2, " ".join(words[2100:])), (3, " ".join(words[:2300])), (4, " ".join(words[2300:]))]
    d, b = frames(spark, texts, [(1, item)])
    assert rows(contaminated(d, b)) == brute(texts, [(1, item)])


def test_odd_rows(spark):
    docs = [(None, ITEMS[0][1]), (None, "fine"), (7, ITEMS[0][1]), (7, ITEMS[0][1]), (7, "fine too")]
    d, b = frames(spark, docs, [*ITEMS, ITEMS[0], (None, ITEMS[1][1])])
    assert sorted(r.text for r in drop_contaminated(d, b).collect()) == ["fine", "fine too"]
    assert contaminated(d, b.limit(0)).count() == 0 and contaminated(d.limit(0), b).count() == 0
    assert drop_contaminated(d, b.limit(0)).count() == 5


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = rows(QUERIES["op4_decontamination"](spark, SF))
    assert got == brute(docs, items) and got
    held = {(d, i) for d, t in docs for i, x in items if x in t}
    assert held <= got.keys()
