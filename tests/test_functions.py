import math
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from millrace.functions import buckets, markup, text
from millrace.schemas import WHITESPACE


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        if isinstance(w, float) and math.isnan(w):
            assert g is not None and math.isnan(g)
        else:
            assert g == w


def test_strip_ws_takes_every_white_space_python_takes(values):
    assert sorted(WHITESPACE) == sorted(chr(i) for i in range(0x110000) if chr(i).isspace())
    items = ["", " ", "\t a b\n", "\xa0x\xa0", " é ", None, "\x1cq "]
    assert values(text.strip_ws, items) == [None if s is None else s.strip() for s in items]


def test_blank_is_null_or_empty_only(values):
    assert values(text.is_blank, ["Atlas", "", None, " ", "\t"]) == [False, True, True, False, False]


def test_coerce_numeric(values):
    items = ["12.5", " 1.5 ", "1e3", "1.5d", "2f", "abc", "", None, "inf", "-Infinity", "1_0", "5.", ".5", ".", "+7", "NaN", "1e400", "-9e999", "1e-400"]
    want = [12.5, 1.5, 1000.0, None, None, None, None, None, math.inf, -math.inf, None, 5.0, 0.5, None, 7.0, None, None, None, 0.0]
    same(values(text.coerce_numeric, items), want)


def test_coerce_numeric_agrees_with_pandas(values):
    import random

    import pandas as pd

    pick = random.Random(3)
    items = ["".join(pick.choice("0123456789..eE+- infdaty") for _ in range(pick.randint(0, 6))) for _ in range(3000)]
    want = pd.to_numeric(pd.Series(items, dtype=object), errors="coerce").astype(float)
    assert values(text.coerce_numeric, items) == [None if math.isnan(v) else v for v in want]


def test_coerce_numeric_can_keep_nan(values):
    same(values(lambda c: text.coerce_numeric(c, "keep"), ["1", "x", None]), [1.0, math.nan, math.nan])
    same(values(text.missing_number, [1.0, math.nan, None], "double"), [1.0, None, None])
    with pytest.raises(ValueError):
        text.missing_number(F.lit(1.0), "drop")


def test_parse_money(values):
    items = ["£12.99", "Â£51.77", "1,234.50", "-5", "n/a", ".", "1.2.3", "", None]
    same(values(text.parse_money, items), [12.99, 51.77, 1234.5, 5.0, None, None, None, None, None])


def test_rating_words(values):
    assert values(text.rating_from_word, ["One", "Five", "five", "Six", "", None]) == [1, 5, 0, 0, 0, 0]


def test_in_stock(values):
    items = ["In stock", " IN STOCK (3)", "Out of stock", "instock", None]
    assert values(text.in_stock, items) == [True, True, False, False, False]


def test_url_rewrite(values):
    items = ["https://drive.google.com/file/d/ABC-1_2/view", "https://example.com/data.csv", "http://x/d/", None]
    assert values(text.direct_download_url, items) == [
        "https://drive.google.com/uc?export=download&id=ABC-1_2",
        "https://example.com/data.csv",
        "http://x/d/",
        None,
    ]


def test_suffix_ignores_case(values):
    assert values(lambda c: text.has_suffix(c, ".csv"), ["a.csv", "B.CSV", "csv", None]) == [True, True, False, None]


def test_price_category_bounds(values):
    items = [9.99, 10.0, 29.99, 30.0, 59.99, 60.0, None, math.nan, -1.0]
    assert values(buckets.price_category, items, "double") == [
        "low", "medium", "medium", "high", "high", "premium", "premium", "premium", "low",
    ]


def test_price_category_alt(values):
    items = [5.0, 15.0, 25.0, 30.0, math.nan, None]
    assert values(buckets.price_category_alt, items, "double") == ["low", "medium", "high", "high", "unknown", "unknown"]


def test_rating_label_bounds(values):
    items = [1.99, 2.0, 3.0, 4.0, 5.0, 0.0, None, math.nan]
    assert values(buckets.rating_label, items, "double") == [
        "poor", "average", "good", "excellent", "excellent", "poor", "poor", "excellent",
    ]


def test_bucketize_checks_its_parameters():
    with pytest.raises(ValueError):
        buckets.bucketize(F.lit(1), (1, 2), ("a", "b"))
    with pytest.raises(ValueError):
        buckets.bucketize(F.lit(1), (2, 1), ("a", "b", "c"))


def test_unescape_reads_each_entity_once(values):
    items = [
        "a &amp; b", "&lt;b&gt;", "&amp;lt;", "&#163;5", "&#xe9;", "&#X1F600;", "&#38;lt;", "&unknown; &", "a;b", None,
        "&amp;amp;", "&nbsp;x",
    ]
    assert values(markup.unescape, items) == [
        "a & b", "<b>", "&lt;", "£5", "é", "😀", "&lt;", "&unknown; &", "a;b", None, "&amp;", "\xa0x",
    ]


def test_attributes(values):
    tags = [
        '<a title="T">', "<a href='x' title='it\"s'>", "<a title=T2 href=x>", '<a data-title="no">', '<a title="">',
        '<a alt="title=\'x\'" title="a > b">', "<A TITLE = 'up'>", "<a>", None,
    ]
    assert values(lambda c: markup.raw_attribute(c, "title"), tags) == [
        "T", 'it"s', "T2", None, "", "a > b", "up", None, None,
    ]


def test_class_is_one_token_of_several(values):
    items = [
        '<p class="instock availability"> yes </p>', "<div class='availability'>y2</div>", "<b class=availability>y3</b>",
        '<p class="availability-no">no</p>', '<p class="AVAILABILITY">no</p>', '<p data-class="availability">no</p>',
        '<p class="x"><i class="availability">in</i> out</p>',
    ]
    got = values(lambda c: markup.raw_text(markup.first_of_class(c, "availability")), items)
    assert got == [" yes ", "y2", "y3", None, None, None, "in"]


def test_long_markup_does_not_overflow(values):
    long_tag = "<p " + "a=b " * 50_000 + 'class="price_color">£1</p>'
    junk = "<p " + "x" * 200_000
    got = values(lambda c: markup.raw_text(markup.first_of_class(c, "price_color")), [long_tag, junk + long_tag, "<" * 100_000])
    assert got[0] == "£1" and got[2] is None


class _Tree(HTMLParser):
    """Elements as Python's parser gives them, with a list as the stack."""

    def __init__(self, wanted):
        super().__init__(convert_charrefs=False)
        self.wanted, self.stack, self.found, self.source = wanted, [], [], ""

    def read(self, page):
        self.source, self.starts = page, [0]
        for line in page.split("\n"):
            self.starts.append(self.starts[-1] + len(line) + 1)
        self.feed(page)
        self._pop(0, len(page))
        return [text for _, text in sorted(self.found)]

    def _at(self):
        line, column = self.getpos()
        return self.starts[line - 1] + column

    def _pop(self, depth, at):
        for _, first in self.stack[depth:]:
            if first is not None:
                self.found.append((first, self.source[first:at]))
        del self.stack[depth:]

    def handle_starttag(self, tag, attrs):
        is_wanted = self.wanted(tag, (dict(attrs).get("class") or "").split())
        if tag in markup.VOID:
            self.found += [(self._at(), self.get_starttag_text())] if is_wanted else []
        else:
            self.stack.append((tag, self._at() if is_wanted else None))

    def handle_startendtag(self, tag, attrs):
        if self.wanted(tag, (dict(attrs).get("class") or "").split()):
            self.found.append((self._at(), self.get_starttag_text()))

    def handle_endtag(self, tag):
        depths = [i for i, (name, _) in enumerate(self.stack) if name == tag]
        if depths:
            self._pop(depths[-1], self._at())


def test_elements_as_a_parser_gives_them(values):
    draw = random.Random(5)
    tags = ["<a>", "</a>", "<a class='x'>", '<p class="y x">', "<p>", "</p>", "<br>", "<img class=x>", "<p class=x />", "<b/>", "</b>", "<b>", "t", "\n", "1 < 2", "</br>"]
    pages = ["".join(draw.choices(tags, k=draw.randrange(25))) for _ in range(400)]
    pages += ["<p class=x>" + "<a><b>" * 6 + "t" + "</b></a>" * 6 + "</p>u", "", "<P Class=x><p>a</P>b</p>c", "no tag", "<p class=x", "<div><p class=x>a</div>b"]
    trees = [_Tree(lambda tag, names: tag == "p" and "x" in names).read(page) for page in pages]
    assert values(lambda c: markup.elements(c, "p", "x"), pages) == trees
    assert values(lambda c: markup.first_element(c, "p", "x"), pages) == [tree[0] if tree else None for tree in trees]
    of_any = [_Tree(lambda tag, names: "x" in names).read(page) for page in pages]
    assert values(lambda c: markup.first_of_class(c, "x"), pages) == [tree[0] if tree else None for tree in of_any]
    assert any(len(tree) > 2 for tree in trees) and any(t.count("<p") > 1 for tree in trees for t in tree)
    assert values(lambda c: markup.elements(c, "p", "x"), [None]) == [None]


def test_deep_markup_ends(values):
    deep = "<p class=x>" + "<i>" * 3000 + "t" + "</i>" * 3000 + "</p>"
    unclosed = "<p class=x>" + "<i>" * 20_000
    assert values(lambda c: F.length(markup.elements(c, "p", "x")[0]), [deep, unclosed]) == [len(deep) - 4, len(unclosed)]
