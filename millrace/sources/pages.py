"""Stored HTML pages: product records, and walks along next-page links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.functions import markup as M
from millrace.functions.text import parse_money, rating_from_word, strip_ws
from millrace.operators.columns import quoted
from millrace.session import materialize

_RECORD = ("title", "price", "availability", "rating")


def product_records(pages: DataFrame, html: str = "html", keep: Sequence[str] = (), source: str = "web") -> DataFrame:
    """One row per product on each page; a product lacking a part is skipped, its page is not.

    ``keep`` names page columns to carry along, such as the URL.
    """
    parsed = _parsed(pages, html, keep)
    whole = parsed.where(F.col("reason").isNull())
    return whole.select(*[quoted(c) for c in keep], *_RECORD).withColumn("source", F.lit(source))


def rejected_products(pages: DataFrame, html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """The products ``product_records`` skips, with the first part that is missing or unreadable."""
    parsed = _parsed(pages, html, keep, "block")
    return parsed.where(F.col("reason").isNotNull()).select(*[quoted(c) for c in keep], "block", "reason")


def _parsed(pages: DataFrame, html: str, keep: Sequence[str], *extra: str) -> DataFrame:
    """All products with the first part that is missing, as ``reason``; their HTML on request.

    Parsing goes in steps of one projection each: a match that later expressions use more than once
    is then computed once.
    """
    taken = {"block", "stars", "reason", "source", *_RECORD}.intersection(keep)
    if taken:
        raise ValueError(f"page columns {sorted(taken)} have names of product columns; rename them first")
    kept = [quoted(c) for c in keep]
    page = M.without_inert(quoted(html))
    products = pages.where(quoted(html).contains("product_pod")).select(
        *kept, F.explode(M.elements(page, "article", "product_pod")).alias("block")
    )
    block = F.col("block")
    found = products.select(
        *kept,
        block,
        M.first_element(block, "h3").alias("title"),
        M.first_of_class(block, "price_color").alias("price"),
        M.first_of_class(block, "availability").alias("availability"),
    )
    raw = found.select(
        *kept,
        block,
        M.raw_attribute(M.first_start_tag(F.col("title"), "a"), "title").alias("title"),
        M.raw_text(F.col("price")).alias("price"),
        M.raw_text(F.col("availability")).alias("availability"),
        M.raw_attribute(M.first_start_tag(block, "p", "star-rating"), "class").alias("stars"),
    )
    read = raw.select(
        *kept,
        block,
        M.unescape(F.col("title")).alias("title"),
        parse_money(M.unescape(F.col("price"))).alias("price"),
        strip_ws(M.unescape(F.col("availability"))).alias("availability"),
        F.get(F.split(strip_ws("stars"), r"\s+"), F.lit(1)).alias("stars"),
    )
    parts = {"title": "title", "price": "price", "availability": "availability", "stars": "rating"}
    reason = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(part)) for c, part in parts.items()])
    fields = [*extra, *_RECORD[:3], rating_from_word(F.col("stars")).alias("rating"), reason.alias("reason")]
    # a filter on generated columns stays above the generator; on projected ones it would move down
    # to the blocks and take a copy of all the parsing along
    return read.select(*kept, F.inline(F.array(F.struct(*fields))))


def with_next_url(pages: DataFrame, base_url: str, html: str = "html", name: str = "next_url") -> DataFrame:
    """Add the URL behind the first link of the first next-page list item, or NULL."""
    item = M.first_element(M.without_inert(quoted(html)), "li", "next")
    # in steps, so that an expression a later one names twice is computed once
    found = pages.withColumn(name, item)
    raw = found.withColumn(name, M.raw_attribute(M.first_start_tag(quoted(name), "a"), "href"))
    return raw.withColumn(name, F.concat(F.lit(base_url), M.unescape(quoted(name))))


def link_edges(links: DataFrame, url: str, next_url: str) -> DataFrame:
    """``(_at, _next)``: one row per stored URL, written out."""
    edges = links.where(quoted(url).isNotNull()).groupBy(quoted(url).alias("_at")).agg(F.min(quoted(next_url)).alias("_next"))
    return materialize(edges, "links")


def follow(going: DataFrame, edges: DataFrame) -> DataFrame:
    """Walks joined with the stored page at their ``_goal``."""
    return going.join(edges, F.col("_goal") == F.col("_at"))


def walk_pages(
    links: DataFrame,
    starts: DataFrame,
    max_pages: int | None,
    url: str = "url",
    next_url: str = "next_url",
) -> DataFrame:
    """Follow next links from every start URL over stored pages: at most ``max_pages``, or to the end.

    Gives ``(start_url, depth, url)``, depth counting from 1. A walk ends at a page without a link
    or at a URL that is not stored. With a bound, a loop is walked until the bound; to the end, a walk
    stops once it is back on a page, and each page of it counts at its least depth. A URL stored twice
    counts once.

    The links are reduced to one narrow row per URL and written out once, so that pages are parsed
    once and a link that many walks share is an ordinary skewed join side, which adaptive execution
    splits. A few steps are as many joins of one plan. Beyond that, jumps are joined with themselves:
    a table of jumps of 1, 2, 3 and 4 pages gives those of 4, 8, 12 and 16, and so on, so that a walk of
    ``n`` pages takes ``log4(n)`` tables, each written once. The walks are then put together from the
    longest jumps down, in one plan whose rows are never more than the result's.
    """
    if max_pages is not None and max_pages < 1:
        raise ValueError("max_pages must be at least 1")
    edges = link_edges(links, url, next_url)
    first = starts.select(quoted(url).alias("start_url")).distinct()
    if max_pages is not None and max_pages <= _FEW:
        return _few_steps(first, edges, max_pages)
    stored = edges.select(F.col("_at").alias("_stored"))
    jump = edges.join(stored, F.col("_next") == F.col("_stored")).select("_at", F.col("_next").alias("_goal"))
    walks = first.join(stored, F.col("start_url") == F.col("_stored")).select("start_url", F.lit(1).alias("depth"), F.col("start_url").alias("url"))
    if max_pages is not None:
        return _put_together(walks, _jump_tables(jump, max_pages - 1)[0], max_pages)
    jump = materialize(jump, "jumps")
    tables, endless = _jump_tables(jump, jump.count())
    if endless is None:
        return _put_together(walks, tables)
    # What a jump longer than all links together reaches lies on a loop. Each loop is cut before its least
    # page; a walk that comes to the cut goes once more round, and of a page met twice the least depth counts.
    loops = materialize(endless.select(F.col("_g4").alias("_on")).distinct(), "loops")
    around = jump.join(loops, F.col("_goal") == F.col("_on")).join(loops.select(F.col("_on").alias("_from")), F.col("_at") == F.col("_from"))
    around = materialize(around.select("_at", "_goal"), "around")
    least = _least_on_loop(around)
    cut = materialize(around.join(least, F.col("_goal") == F.col("_least")).select(F.col("_at").alias("_cut"), "_goal"), "cuts")
    tables, _ = _jump_tables(jump.join(cut.select("_cut"), F.col("_at") == F.col("_cut"), "left_anti"), None)
    once = materialize(_put_together(walks, tables), "walks")
    again = once.join(cut, F.col("url") == F.col("_cut")).select("start_url", (F.col("depth") + 1).alias("depth"), F.col("_goal").alias("url"))
    both = once.unionByName(_put_together(again, tables))
    return both.groupBy("start_url", "url").agg(F.min("depth").alias("depth")).select("start_url", "depth", "url")


#: So many steps are as many joins of one plan.
_FEW = 8


def _few_steps(starts: DataFrame, edges: DataFrame, n: int) -> DataFrame:
    walks = starts.select("start_url", F.array().cast("array<string>").alias("_path"), F.col("start_url").alias("_goal"))
    for _ in range(n):
        met = walks.join(edges, F.col("_goal") == F.col("_at"), "left")
        path = F.when(F.col("_at").isNull(), F.col("_path")).otherwise(F.concat("_path", F.array("_at")))
        walks = met.select("start_url", path.alias("_path"), F.col("_next").alias("_goal"))
    return walks.select("start_url", F.posexplode("_path").alias("_i", "url")).select("start_url", (F.col("_i") + 1).alias("depth"), "url")


def _jump_tables(jump: DataFrame, steps: int | None) -> tuple[list[DataFrame], DataFrame | None]:
    """Tables ``_at, _g1.._g4`` of jumps by 1 to 4 times 1, 4, 16, ... pages, for walks of up to ``steps`` links.

    They end when no walk is longer, if not before. Given back is also the last table if it still has
    jumps by 4 times its length, which is then more than ``steps``.
    """
    tables: list[DataFrame] = []
    while True:
        table = jump.select("_at", F.col("_goal").alias("_g1"))
        for i in (2, 3, 4):
            onward = jump.select(F.col("_at").alias("_from"), F.col("_goal").alias(f"_g{i}"))
            table = table.join(onward, F.col(f"_g{i - 1}") == F.col("_from"), "left").drop("_from")
        table = materialize(table.select("_at", "_g1", "_g2", "_g3", "_g4"), "jumps")
        tables.append(table)
        jump = table.where(F.col("_g4").isNotNull()).select("_at", F.col("_g4").alias("_goal"))
        if jump.isEmpty():
            return tables, None
        if steps is not None and 4 ** len(tables) > steps:
            return tables, table.where(F.col("_g4").isNotNull())


def _put_together(walks: DataFrame, tables: list[DataFrame], max_pages: int | None = None) -> DataFrame:
    """All pages of ``walks`` (``start_url, depth, url``: where they begin), longest jumps first."""
    for i, table in reversed(list(enumerate(tables))):
        steps = [F.struct((F.col("depth") + n * 4**i).cast("int").alias("depth"), F.col(f"_g{n}" if n else "url").alias("url")) for n in range(4)]
        # a walk is at most as long as the links are many, so depths of pages that are there fit
        there = F.filter(F.array(*steps), lambda s: s["url"].isNotNull() & (F.lit(max_pages is None) | (s["depth"] <= (max_pages or 0))))
        walks = walks.join(table, F.col("url") == F.col("_at"), "left").select("start_url", F.inline(there))
    return walks


def _least_on_loop(around: DataFrame) -> DataFrame:
    """``_least``: the least page of each loop of ``around``, whose links are all on loops."""
    # Jumps twice as long know the least page of twice as many; a loop is known when nothing changes.
    jump = around.select("_at", "_goal", F.least("_at", "_goal").alias("_least"))
    while True:
        onward = jump.select(F.col("_at").alias("_from"), F.col("_goal").alias("_to"), F.col("_least").alias("_other"))
        longer = jump.join(onward, F.col("_goal") == F.col("_from"))
        changed = F.col("_other") < F.col("_least")
        longer = longer.select("_at", F.col("_to").alias("_goal"), F.least("_least", "_other").alias("_least"), changed.alias("_changed"))
        longer = materialize(longer, "loops")
        if longer.where("_changed").isEmpty():
            return longer.select("_least").distinct()
        jump = longer.drop("_changed")
