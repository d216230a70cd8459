"""HTML expressions built on the JVM's regular expressions.

The patterns follow the HTML attribute grammar (quoted values may hold ``>``) and use possessive
loops, which Java runs without recursion, so a long tag or page can neither overflow the stack nor
backtrack. An element reaches from its start tag to the end tag that closes it: that of its name, past
elements of the same name inside it, or that of an element around it, or the end of the text. Void
elements (``br``) and self-closed ones hold nothing; an end tag that closes nothing is ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

_FLAGS = "(?is)"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"']++)"""
_ATTRIBUTE = rf"[^\s=>/]++(?:\s*+=\s*+{_VALUE})?+"
_ATTRIBUTES = rf"(?:[\s/]++(?:{_ATTRIBUTE})?+)*+"

# fixed values: elements without content, those of older HTML included
VOID = (
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input",
    "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
)
_VOID = f"(?:{'|'.join(VOID)})"
_ANY_NAME = r"[a-z][^\s/>]*+"
_TAG = rf"<(?:/[a-z][^>]*+|{_ANY_NAME}{_ATTRIBUTES})>"
_SELF_CLOSED = rf"^<{_ANY_NAME}(?:[\s/]++{_ATTRIBUTE})*+[\s/]*+(?<=/)>"

_HELD_AMPERSAND = "\ue000"  # a private-use character stands for & until the end

# fixed values: the named entities read, besides numeric ones
ENTITIES = {
    "&amp;": _HELD_AMPERSAND,
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&apos;": "'",
    "&nbsp;": "\xa0",
    "&cent;": "¢",
    "&pound;": "£",
    "&yen;": "¥",
    "&copy;": "©",
    "&reg;": "®",
    "&middot;": "·",
    "&hellip;": "…",
    "&ndash;": "–",
    "&mdash;": "—",
    "&lsquo;": "‘",
    "&rsquo;": "’",
    "&ldquo;": "“",
    "&rdquo;": "”",
    "&euro;": "€",
}
_ENTITY = "&(?:[a-zA-Z]++|#[0-9]{1,6}+|#[xX][0-9a-fA-F]{1,5}+);"


def start_tag(name: str) -> str:
    """Pattern of a start tag with any attributes. Adds no capture group."""
    return rf"<(?:{name})(?=[\s>/]){_ATTRIBUTES}>"


def start_tag_with_class(name: str, css_class: str) -> str:
    """Pattern of a start tag with ``css_class`` among its classes. Adds no capture group."""
    token = f"(?-i:{re.escape(css_class)})"
    among = rf"""(?:"(?:[^"]*\s)?{token}(?:\s[^"]*)?"|'(?:[^']*\s)?{token}(?:\s[^']*)?'|{token}(?=[\s>]))"""
    return (
        rf"<(?:{name})(?:[\s/]++(?!class[\s=]){_ATTRIBUTE})*+"
        rf"[\s/]++class\s*+=\s*+{among}{_ATTRIBUTES}>"
    )


def _content(name: str) -> str:
    """Pattern of everything up to the next end tag ``name``, taken in runs, not letter by letter."""
    return rf"(?:[^<]++|<(?!/{name}[\s>]))*+"


def without_inert(html: Column) -> Column:
    """Drop comments, scripts and styles, whose text may look like markup."""
    comment = "!--(?:[^-]++|-(?!->))*+-->"
    inert = rf"(script|style)(?=[\s>/]){_content('\\1')}</\1\s*+>"
    return F.regexp_replace(html, f"{_FLAGS}<(?:{comment}|{inert})", "")


def elements(html: Column, name: str, css_class: str) -> Column:
    """Every element ``name`` of a class, as an array of HTML text without the end tag, in order of start tags.

    One inside another is in the array by itself and in the text of the other."""
    opening = start_tag_with_class(name, css_class)

    def nested(page: Column) -> Column:
        found = F.regexp_extract_all(page, F.lit(_FLAGS + opening + _content(name)), F.lit(0))
        return _let(found, lambda f: F.when(F.forall(f, _is_plain), f).otherwise(_all_elements(page, opening)))

    return _let(html, nested)


def first_element(html: Column, name: str, css_class: str | None = None) -> Column:
    """The first element ``name`` as HTML text without its end tag; NULL when there is none."""
    opening = start_tag(name) if css_class is None else start_tag_with_class(name, css_class)
    return _first(html, opening, opening + _content(name))


def first_of_class(html: Column, css_class: str) -> Column:
    """The first element of any name with a class; NULL when there is none."""
    any_name = "[a-z][a-z0-9]*+"
    opening = start_tag_with_class(any_name, css_class)
    named = opening.replace(f"(?:{any_name})", f"({any_name})", 1)
    return _first(html, opening, named + _content(r"\1"))


def _first(html: Column, opening: str, upto_end_tag: str) -> Column:
    def nested(page: Column) -> Column:
        found = F.regexp_extract(page, _FLAGS + upto_end_tag, 0)
        parsed = F.get(_all_elements(page, opening), F.lit(0))
        return _let(found, lambda f: F.when(f == "", F.lit(None)).when(_is_plain(f), f).otherwise(parsed))

    return _let(html, nested)


def _plain_pattern(depth: int) -> str:
    """Pattern of a start tag and content in which every element is closed, up to ``depth`` levels of them."""
    # void elements are tried first, so a start tag that comes to this is no void one's
    start = rf"<({_ANY_NAME}){_ATTRIBUTES}(?<!/)>"
    content = "[^<]*+"
    for level in range(depth, 0, -1):
        content = rf"[^<]*+(?:(?:<{_VOID}(?=[\s/>]){_ATTRIBUTES}>|{start}{content}</\{level}\s*+>)[^<]*+)*+"
    return rf"{_FLAGS}^<(?!{_VOID}[\s/>]){_ANY_NAME}{_ATTRIBUTES}(?<!/)>{content}\z"


def _is_plain(element: Column) -> Column:
    """Whether the next end tag of an element's name is plainly the one that closes it."""
    return element.rlike(_plain_pattern(4))


def _all_elements(html: Column, opening: str) -> Column:
    """Elements whose start tag matches, by a stack of open elements over the page's sequence of tags.

    The stack is text, innermost name first, each behind a blank; its length tells how deep it is. An element
    is closed when the stack is no longer than before it.
    """
    text = rf"(?:[^<]++|<(?!{_TAG[1:]}))*+"
    pieces = F.regexp_extract_all(html, F.lit(f"{_FLAGS}{_TAG}{text}"), F.lit(0))
    name = lambda piece: F.lower(F.regexp_extract(piece, rf"{_FLAGS}^</?({_ANY_NAME})", 1))

    def read(piece: Column) -> Column:
        is_void = name(piece).isin(*VOID) | piece.rlike(_FLAGS + _SELF_CLOSED)
        return F.struct(
            name(piece).alias("name"),
            piece.startswith("</").alias("ends"),
            is_void.alias("void"),
            piece.rlike(f"{_FLAGS}^{opening}").alias("wanted"),
        )

    spans = "array<struct<first:int,last:int>>"
    begin = F.struct(
        F.lit(0).alias("i"),
        F.lit(" ").alias("stack"),
        F.array().cast("array<struct<first:int,under:int>>").alias("open"),
        F.array().cast(spans).alias("done"),
    )

    def step(state: Column, tag: Column) -> Column:
        stack, i = state["stack"], state["i"] + 1
        closes = F.call_function("locate", F.concat(F.lit(" "), tag["name"], F.lit(" ")), stack)
        popped = F.substr(stack, closes + F.length(tag["name"]) + 1)
        unchanged = F.struct(i.alias("i"), stack.alias("stack"), state["open"].alias("open"), state["done"].alias("done"))
        ended = _let(
            F.struct(i.alias("i"), popped.alias("stack")),
            lambda new: F.struct(
                new["i"].alias("i"),
                new["stack"].alias("stack"),
                F.filter(state["open"], lambda o: o["under"] < F.length(new["stack"])).alias("open"),
                F.concat(
                    state["done"],
                    F.transform(
                        F.filter(state["open"], lambda o: o["under"] >= F.length(new["stack"])),
                        lambda o: F.struct(o["first"].alias("first"), (new["i"] - 1).alias("last")),
                    ),
                ).alias("done"),
            ),
        )
        empty = F.array(F.struct(i.alias("first"), F.lit(0).alias("last")))
        held = F.struct(
            i.alias("i"),
            stack.alias("stack"),
            state["open"].alias("open"),
            F.when(tag["wanted"], F.concat(state["done"], empty)).otherwise(state["done"]).alias("done"),
        )
        entered = F.array(F.struct(i.alias("first"), F.length(stack).alias("under")))
        started = F.struct(
            i.alias("i"),
            F.concat(F.lit(" "), tag["name"], stack).alias("stack"),
            F.when(tag["wanted"], F.concat(state["open"], entered)).otherwise(state["open"]).alias("open"),
            state["done"].alias("done"),
        )
        return F.when(tag["ends"], F.when(closes > 0, ended).otherwise(unchanged)).when(tag["void"], held).otherwise(started)

    def finish(state: Column) -> Column:
        never_closed = F.transform(state["open"], lambda o: F.struct(o["first"].alias("first"), state["i"].alias("last")))
        return F.array_sort(F.concat(state["done"], never_closed))

    def cut(taken: Column, span: Column) -> Column:
        whole = F.array_join(F.slice(taken, span["first"], span["last"] - span["first"] + 1), "")
        tag_alone = F.regexp_extract(F.element_at(taken, span["first"]), f"{_FLAGS}^{_TAG}", 0)
        return F.when(span["last"] == 0, tag_alone).otherwise(whole)

    return _let(
        pieces,
        lambda taken: _let(
            F.aggregate(F.transform(taken, read), begin, step, finish),
            lambda found: F.transform(found, lambda span: cut(taken, span)),
        ),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once: a lambda computes what it names from outside for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def first_start_tag(html: Column, name: str, css_class: str | None = None) -> Column:
    """The first start tag ``name``; NULL when there is none."""
    return _match(html, start_tag(name) if css_class is None else start_tag_with_class(name, css_class))


def raw_attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a start tag as written; NULL when it is absent."""
    pattern = (
        rf"{_FLAGS}^<[^\s>/]++(?:[\s/]++(?!{name}[\s=]){_ATTRIBUTE})*+"
        rf"[\s/]++{name}\s*+=\s*+({_VALUE})"
    )
    # the match keeps its quotes, so that an empty value is not taken for an absent one
    quoted = F.nullif(F.regexp_extract(tag, pattern, 1), F.lit(""))
    return F.regexp_replace(quoted, r"""^["']|["']\z""", "")


def raw_text(html: Column) -> Column:
    """Text of an HTML fragment as written: tags dropped."""
    return F.regexp_replace(html, r"<[^>]*+>", "")


def unescape(c: Column) -> Column:
    """Read the listed named entities and all numeric ones; anything else stays as it is written.

    Ampersands are put in last, so that ``&amp;lt;`` reads as ``&lt;``. Refers to its input several
    times: give it a column, not an expression.
    """
    characters = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(_ENTITY), F.lit(0)))
    read = F.reduce(
        found,
        c,
        lambda text, e: F.replace(text, e, F.coalesce(F.element_at(characters, e), _numeric(e), e)),
    )
    return F.when(c.contains("&"), F.replace(read, F.lit(_HELD_AMPERSAND), F.lit("&"))).otherwise(c)


def _numeric(entity: Column) -> Column:
    digits = F.nullif(F.regexp_extract(entity, "^&#[xX]?([0-9a-fA-F]+);", 1), F.lit(""))
    base = F.when(F.lower(entity).startswith("&#x"), F.lit(16)).otherwise(F.lit(10))
    code_point = F.lpad(F.call_function("conv", digits, base, F.lit(16)), 8, "0")
    character = F.decode(F.unhex(code_point), "UTF-32")
    return F.when(character == "&", F.lit(_HELD_AMPERSAND)).otherwise(character)


def _match(html: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(html, _FLAGS + pattern, 0), F.lit(""))
