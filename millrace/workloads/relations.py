"""Inputs of the queries, all derived from the given tables by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.operators.rows import union_sources

CATALOGUE_URL = "http://shop.example.com/catalogue/"
PRODUCTS_PER_PAGE = 20
PAGES_PER_SHOP = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_title() -> Column:
    return F.concat_ws(" ", "p_name", "p_brand")


def part_price() -> Column:
    return F.round(F.col("p_retailprice") - 900, 2)


def star_word(n: Column) -> Column:
    """A word for 0..5; ``Zero`` is none the parser knows."""
    words = F.array(*[F.lit(w) for w in ("Zero", "One", "Two", "Three", "Four", "Five")])
    return F.get(words, n)


def web_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_size") % 3
    return table(spark, sf_dir, "part").select(
        part_title().alias("title"),
        part_price().alias("price"),
        F.when(kind == 0, " In stock ").when(kind == 1, "Out of stock").alias("availability"),
        (F.col("p_size") % 6).cast("double").alias("rating"),
        F.lit(" Web ").alias("source"),
    )


def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_suppkey") % 10 != 0, F.col("s_name")).alias("title"),
        F.concat(F.lit("In Stock ("), "s_nationkey", F.lit(")")).alias("availability"),
        (F.col("s_nationkey") % 6).cast("double").alias("rating"),
        F.lit("csv").alias("source"),
    )


def sql_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("title"),
        F.lit(None).cast("double").alias("price"),
        F.col("c_name").alias("availability"),
        F.lit(0.0).alias("rating"),
        F.lit("sql").alias("source"),
    )


def all_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [web_rows(spark, sf_dir), csv_rows(spark, sf_dir), sql_rows(spark, sf_dir)]


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_sources(all_sources(spark, sf_dir))


def money_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as prices, as unreadable text, or missing."""
    i = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(i % 11 == 0, None)
        .when(i % 7 == 0, "n/a")
        .when(i % 5 == 0, F.concat(F.lit("Â£"), "value"))
        .when(i % 3 == 0, F.concat(F.lit("1."), "value"))
        .otherwise(F.concat(F.lit("£1,"), F.lpad(F.col("value").cast("string"), 6, "0")))
        .alias("raw_price"),
    )


def number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as text, most of it numeric."""
    i = F.col("event_id")
    value = F.col("value").cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(i % 11 == 0, None)
        .when(i % 7 == 0, "bad")
        .when(i % 5 == 0, F.concat(value, F.lit("d")))
        .when(i % 3 == 0, F.concat(F.lit(" -"), value, F.lit(" ")))
        .when(i % 2 == 0, F.concat(value, F.lit("e2")))
        .otherwise(value)
        .alias("raw_value"),
    )


def padded_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pad = F.get(F.array(*[F.lit(p) for p in ("", " ", "\t\n", " ", " \r")]), (F.col("event_id") % 5).cast("int"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(pad, "event_type", F.lit(" x"), pad).alias("raw")
    )


def product_fragment() -> Column:
    """One product of a catalogue page, in one of three attribute orders, some lacking a part."""
    i = F.col("p_partkey")
    title = F.concat("p_name", F.lit(" &amp; &quot;"), "p_brand", F.lit("&quot;"))
    link = (
        F.when(i % 3 == 0, F.concat(F.lit('<a href="p.html" title="'), title, F.lit('">')))
        .when(i % 3 == 1, F.concat(F.lit('<a title="'), title, F.lit('" href="p.html?a>b">')))
        .otherwise(F.concat(F.lit("<a class='t' title='"), title, F.lit("' href=p.html>")))
    )
    link = F.when(i % 37 == 0, F.lit('<a href="p.html">')).otherwise(link)
    price = F.when(i % 41 == 0, F.lit("")).otherwise(
        F.concat(F.lit('<p class="price_color">Â&pound;'), part_price().cast("string"), F.lit("</p>"))
    )
    star = F.when(i % 43 == 0, F.lit('<p class="star-rating">')).otherwise(
        F.concat(F.lit('<p class="star-rating '), star_word(F.col("p_size") % 6), F.lit('">'))
    )
    stock = F.when(F.col("p_size") % 3 == 0, "In stock").otherwise("Out of stock")
    return F.concat(
        F.lit('<li><article class="product_pod"><!-- <h3><a title="no">no</a></h3> -->'),
        star,
        F.lit('<i class="icon-star"></i></p><h3>'),
        link,
        F.lit("more</a></h3>"),
        price,
        F.lit('<p class="instock availability"><i class="icon-ok"></i>\n   '),
        stock,
        F.lit("\n</p></article></li>"),
    )


def catalogue_url(page: Column) -> Column:
    """URL of a page counted over all shops: ``shop-<s>/page-<n>.html``."""
    shop = F.floor(page / PAGES_PER_SHOP).cast("string")
    number = (page % PAGES_PER_SHOP + 1).cast("string")
    return F.concat(F.lit(CATALOGUE_URL + "shop-"), shop, F.lit("/page-"), number, F.lit(".html"))


def catalogue_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as stored catalogue pages of twenty products, eight linked pages to a shop."""
    # a stated number of partitions is kept as it is: pages are small to shuffle and slow to parse
    grouped = (
        table(spark, sf_dir, "part")
        .withColumn("page", F.floor(F.col("p_partkey") / PRODUCTS_PER_PAGE))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "page")
        .groupBy("page")
        .agg(F.array_sort(F.collect_list(F.struct("p_partkey", product_fragment().alias("html")))).alias("items"))
    )
    last = F.col("page") % PAGES_PER_SHOP == PAGES_PER_SHOP - 1
    href = F.substring(catalogue_url(F.col("page") + 1), len(CATALOGUE_URL) + 1, 1000)
    pager = F.when(last, F.lit("")).otherwise(
        F.concat(F.lit('<ul class="pager"><li class="next"><a href="'), href, F.lit('">next</a></li></ul>'))
    )
    return grouped.select(
        "page",
        catalogue_url(F.col("page")).alias("url"),
        F.concat(
            F.lit('<html><body><script>var a = "<article class=\'product_pod\'>";</script><ol>'),
            F.array_join("items.html", "\n"),
            F.lit("</ol>"),
            pager,
            F.lit("</body></html>"),
        ).alias("html"),
    )


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-z]+://([^/:?#]+)", 1)


_STRIDE = 4096


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the URL of the page that follows on the same host.

    A host may hold a third of all pages, so no window spans a host: pages are ordered within
    strides of their number, and only the first pages of the strides are ordered over the host.
    """
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", host_of(F.col("url")).alias("host"), F.floor(F.col("page_id") / _STRIDE).alias("stride")
    )
    firsts = pages.groupBy("host", "stride").agg(F.min_by("url", "page_id").alias("first_url"))
    over_host = Window.partitionBy("host").orderBy("stride")
    following = firsts.select("host", "stride", F.lead("first_url").over(over_host).alias("following_url"))
    within = Window.partitionBy("host", "stride").orderBy("page_id")
    return (
        pages.withColumn("near_url", F.lead("url").over(within))
        .join(following, ["host", "stride"])
        .select("page_id", "url", "host", F.coalesce("near_url", "following_url").alias("next_url"))
    )


def people_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per customer with up to three people, some broken."""
    n = F.col("c_nationkey") % 4
    people = F.transform(
        F.sequence(F.lit(1), n),
        lambda k: F.struct(F.col("c_mktsegment").alias("craft"), F.concat_ws(" ", "c_name", k.cast("string")).alias("name")),
    )
    whole = F.to_json(F.struct(n.alias("number"), F.filter(people, lambda p: n > 0).alias("people")))
    i = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(i % 97 == 0, "not json").when(i % 89 == 0, '{"number": 3}').otherwise(whole).alias("json"),
    )


def share_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    shared = F.concat(F.lit("https://drive.google.com/file/d/1s-x_"), i, F.lit("Ab/view?usp=sharing"))
    return table(spark, sf_dir, "pages").select("page_id", F.when(i % 2 == 0, shared).otherwise(F.col("url")).alias("url"))


def file_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the bytes of files of every format the sniffer tells apart."""
    i = F.col("doc_id")
    text = F.col("text").cast("binary")
    lead = {0: "504B0304", 1: "EFBBBF", 2: "FFFE", 3: "FEFF", 4: "1F8B08", 6: "736570"}
    content = F.when(i % 8 == 5, F.concat(F.lit(" <!DOCTYPE html><HTML>").cast("binary"), text))
    for k, magic in lead.items():
        content = content.when(i % 8 == k, F.concat(F.unhex(F.lit(magic)), text))
    return table(spark, sf_dir, "documents").select(
        "doc_id", content.otherwise(F.concat(F.lit("#").cast("binary"), text)).alias("content")
    )


def encoded_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as bytes: UTF-8 as they are, or with a Latin-1 letter put first or far behind."""
    i = F.col("doc_id")
    text = F.col("text").cast("binary")
    letter = F.unhex(F.lit("E9"))
    pad = F.repeat(F.lit("abcdefgh"), 1100).cast("binary")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(i % 3 == 0, F.concat(F.lit("caf").cast("binary"), letter, F.lit(" ").cast("binary"), text))
        .when(i % 3 == 1, F.concat(pad, letter, F.lit(" ").cast("binary"), text))
        .otherwise(text)
        .alias("content"),
    )


def header_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header lines with each delimiter, a name with a quoted comma among them."""
    sep = F.get(F.array(*[F.lit(d) for d in (",", ";", "\t", "|", "", " ", ":")]), (F.col("c_custkey") % 7).cast("int"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit('"a,,,b"'), sep, "c_name", sep, "c_mktsegment").alias("header"),
    )


def ragged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a three-column file: whole, short, long, with empty fields, with quoted commas."""
    i = F.col("p_partkey")
    key = i.cast("string")
    return table(spark, sf_dir, "part").select(
        F.when(i % 6 == 0, F.concat_ws(",", key, "p_name", "p_brand"))
        .when(i % 6 == 1, F.concat_ws(",", key, "p_name", "p_brand", "p_type"))
        .when(i % 6 == 2, F.concat_ws(",", key, "p_name"))
        .when(i % 6 == 3, F.concat_ws(",", key, "p_name", F.lit(""), F.lit(""), F.lit("")))
        .when(i % 6 == 4, F.concat(key, F.lit(',"'), "p_name", F.lit(', ""x""",'), "p_brand"))
        .otherwise(F.concat_ws(",", key, F.lit(""), F.lit("NA")))
        .alias("value")
    )


_PER_ARCHIVE = 500


def zip_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts packed into ZIP archives of at most 500 rows: ``(path, content)``."""
    packed = (
        table(spark, sf_dir, "part")
        .groupBy(F.floor(F.col("p_partkey") / _PER_ARCHIVE).alias("n"))
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "p_partkey",
                        F.concat(
                            F.lit('"'), part_title(), F.lit('";'), part_price().cast("string"), F.lit(";"), F.col("p_partkey").cast("string")
                        ).alias("line"),
                    )
                )
            ).alias("lines")
        )
        .select(
            F.concat(F.lit("parts-"), F.col("n").cast("string"), F.lit(".zip")).alias("path"),
            F.array_join(F.col("lines.line"), "\n").alias("body"),
        )
    )
    return packed.mapInPandas(_pack, "path string, content binary")


def _pack(batches):
    import io
    import zipfile

    for batch in batches:
        contents = []
        for body in batch["body"]:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("readme.txt", "not the data")
                archive.writestr("BOOKS.CSV", "title;price;part\n" + body + "\n1;2;3;4\n")
            contents.append(buffer.getvalue())
        yield batch[["path"]].assign(content=contents)
