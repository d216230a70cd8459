"""One query per operator: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace import sinks
from millrace.functions import buckets, text
from millrace.operators import catalogue, columns, quality, rows
from millrace.plans.job import Job, Source, run
from millrace.schemas import CANONICAL, SOURCES
from millrace.session import materialize, staging_path
from millrace.sources import delimited, pages, probe, relations as rel
from millrace.workloads import relations as R

RUN_TS = datetime(2026, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- the catalogue transform --------------------------------------------------------------


@query
def transform(spark, sf_dir):
    return catalogue.transform(R.all_sources(spark, sf_dir), RUN_TS)


@query
def transform_keep_nan(spark, sf_dir):
    """Missing numbers stay NaN and so land in the highest price class."""
    tables = [columns.coerce_and_fill(df, missing="keep") for df in R.all_sources(spark, sf_dir)]
    return catalogue.transform(tables, RUN_TS, missing="keep")


@query
def transform_conformed(spark, sf_dir):
    """Every source conformed first; blank titles count as missing, keys compare normalized."""
    tables = [columns.conform(df) for df in R.all_sources(spark, sf_dir)]
    return catalogue.transform(tables, RUN_TS, normalize_keys=True, blank_is_missing=True)


@query
def union_sources(spark, sf_dir):
    return R.books(spark, sf_dir)


@query
def union_single(spark, sf_dir):
    """One source alone is its own union."""
    return rows.union_sources([R.web_rows(spark, sf_dir)])


@query
def clean(spark, sf_dir):
    return catalogue.clean(R.books(spark, sf_dir))


@query
def normalize(spark, sf_dir):
    return catalogue.normalize(R.books(spark, sf_dir), RUN_TS)


@query
def enrich(spark, sf_dir):
    return catalogue.enrich(R.books(spark, sf_dir))


@query
def enrich_partial(spark, sf_dir):
    """What a missing column would give is not derived."""
    return catalogue.enrich(R.books(spark, sf_dir).drop("price", "availability"))


# --- duplicates ---------------------------------------------------------------------------


@query
def dedup_keys(spark, sf_dir):
    return rows.dedup(R.books(spark, sf_dir))


@query
def dedup_lineitem(spark, sf_dir):
    """One line per part and supplier of the largest table."""
    return rows.dedup(R.table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"])


@query
def dedup_count(spark, sf_dir):
    return rows.count_rows(rows.dedup_any(R.books(spark, sf_dir)), "n_kept")


@query
def dedup_normalized(spark, sf_dir):
    padded = R.books(spark, sf_dir).withColumn(
        "title", F.when(F.col("rating") >= 3, F.concat(F.lit(" "), "title")).otherwise(F.col("title"))
    )
    return rows.dedup(
        padded, ["title", "source"], {"title": F.trim("title"), "source": F.lower(F.trim("source"))}
    )


# --- columns ------------------------------------------------------------------------------


def _raw_headers(spark, sf_dir):
    return R.table(spark, sf_dir, "part").select(
        F.col("p_name").alias("Book-Title"),
        F.col("p_brand").alias("Book-Author"),
        F.col("p_size").alias("Year-Of-Publication"),
        F.col("p_partkey").alias("ISBN"),
    )


@query
def norm_columns(spark, sf_dir):
    return columns.normalize_names(_raw_headers(spark, sf_dir))


@query
def rename_columns(spark, sf_dir):
    from millrace.schemas import BOOK_FILE_COLUMNS

    return columns.rename(columns.normalize_names(_raw_headers(spark, sf_dir)), BOOK_FILE_COLUMNS)


@query
def conform_schema(spark, sf_dir):
    events = R.number_text(spark, sf_dir).withColumnRenamed("raw_value", "price")
    extra = events.withColumns(
        {"title": F.when(F.col("event_id") % 4 != 0, F.col("event_id")), "rating": F.col("event_id") % 6}
    )
    return columns.conform(extra)


@query
def coerce_numeric(spark, sf_dir):
    return R.number_text(spark, sf_dir).withColumn("value", text.coerce_numeric(F.col("raw_value")))


@query
def fill_text(spark, sf_dir):
    return columns.fill_text(R.books(spark, sf_dir))


@query
def tag_source(spark, sf_dir):
    nations = R.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("source"))
    kept = columns.tag_source(nations, "sql", only_if_absent=True)
    return columns.tag_source(kept, "sql", column="origin", only_if_absent=True)


@query
def run_timestamp(spark, sf_dir):
    stamped = catalogue.normalize(R.books(spark, sf_dir), RUN_TS)
    return stamped.groupBy("processed_at", "pipeline_version").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def sql_projection(spark, sf_dir):
    return rel.read_sql(
        spark,
        """
        SELECT c_custkey::string AS title, c_name AS availability, NULL::double AS price,
               0 AS rating, 'sql' AS source
        FROM {customer}
        """,
        source=None,
        customer=R.table(spark, sf_dir, "customer"),
    )


# --- scalar functions ---------------------------------------------------------------------


@query
def parse_money(spark, sf_dir):
    return R.money_text(spark, sf_dir).withColumn("price", text.parse_money(F.col("raw_price")))


@query
def rating_words(spark, sf_dir):
    words = R.table(spark, sf_dir, "part").select("p_partkey", R.star_word(F.col("p_size") % 7).alias("word"))
    return words.withColumn("rating", text.rating_from_word(F.col("word")))


@query
def strip_ws(spark, sf_dir):
    return R.padded_text(spark, sf_dir).select("event_id", text.strip_ws("raw").alias("stripped"))


@query
def price_category(spark, sf_dir):
    prices = R.books(spark, sf_dir).select("title", "price")
    return prices.withColumn("price_category", buckets.price_category(F.col("price")))


@query
def price_category_alt(spark, sf_dir):
    prices = R.books(spark, sf_dir).select("title", "price")
    return prices.withColumn("price_category", buckets.price_category_alt(F.col("price")))


@query
def event_value_buckets(spark, sf_dir):
    label = buckets.bucketize(F.col("value"), (50, 100, 250), ("small", "middle", "large", "huge"), "none")
    return (
        R.table(spark, sf_dir, "events")
        .groupBy("event_type", label.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


@query
def rating_label(spark, sf_dir):
    return R.books(spark, sf_dir).select("title", "rating", buckets.rating_label(F.col("rating")).alias("rating_label"))


@query
def is_available(spark, sf_dir):
    stock = R.books(spark, sf_dir).select("title", "availability")
    return stock.withColumn("is_available", text.in_stock(F.col("availability")))


@query
def url_rewrite(spark, sf_dir):
    return R.share_links(spark, sf_dir).withColumn("direct_url", text.direct_download_url(F.col("url")))


# --- filters, counts, limits --------------------------------------------------------------


@query
def drop_null_title(spark, sf_dir):
    return rows.drop_null(R.books(spark, sf_dir), "title")


@query
def blank_titles(spark, sf_dir):
    some = R.books(spark, sf_dir).withColumn(
        "title", F.when(F.col("rating") == 2, "").when(F.col("rating") == 4, " ").otherwise(F.col("title"))
    )
    return rows.blank_rows(some, "title")


@query
def suffix_filter(spark, sf_dir):
    return rows.with_suffix(R.table(spark, sf_dir, "pages").select("page_id", "url"), "url", ".HTML")


@query
def prefix_filter(spark, sf_dir):
    return rows.with_prefix(R.table(spark, sf_dir, "pages").select("page_id", "url"), "url", "https://blog.")


@query
def count_rows(spark, sf_dir):
    return rows.count_rows(R.table(spark, sf_dir, "customer"), "total")


@query
def rows_per_source(spark, sf_dir):
    return rows.rows_per_source(R.books(spark, sf_dir))


@query
def distinct_titles(spark, sf_dir):
    return rows.distinct_count(R.books(spark, sf_dir), "title", "n_titles")


@query
def source_domain(spark, sf_dir):
    return rows.distinct_values(R.books(spark, sf_dir), "source")


@query
def min_price(spark, sf_dir):
    return rows.smallest(R.books(spark, sf_dir), "price", "min_price")


@query
def all_positive(spark, sf_dir):
    return rows.all_rows(R.table(spark, sf_dir, "events"), F.col("value") > 0, "all_positive")


@query
def limit_rows(spark, sf_dir):
    return rows.first_rows(R.table(spark, sf_dir, "orders"), 500, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query
def preview(spark, sf_dir):
    documents = R.table(spark, sf_dir, "documents")
    return rows.preview(documents, ["doc_id", "text", "lang"], 5, F.asc("doc_id"))


# --- quality ------------------------------------------------------------------------------


@query
def dq_required(spark, sf_dir):
    rules = [quality.required(c) for c in (*CANONICAL.fieldNames(), "isbn")]
    return quality.quality_report(R.books(spark, sf_dir), rules)


@query
def dq_numeric(spark, sf_dir):
    return quality.quality_report(R.number_text(spark, sf_dir), [quality.numeric("raw_value")])


@query
def dq_unique(spark, sf_dir):
    return quality.quality_report(
        R.books(spark, sf_dir), [quality.unique("title"), quality.unique("title", "source")]
    )


@query
def dq_domain(spark, sf_dir):
    return quality.quality_report(
        R.table(spark, sf_dir, "events"), [quality.domain("event_type", ["click", "view", "purchase"])]
    )


@query
def dq_range(spark, sf_dir):
    return quality.quality_report(
        R.table(spark, sf_dir, "customer"),
        [quality.in_range("c_acctbal", 0, 9000), quality.above("c_acctbal", 0)],
    )


@query
def dq_blank(spark, sf_dir):
    return quality.quality_report(R.books(spark, sf_dir), [quality.not_blank("title")])


@query
def dq_report(spark, sf_dir):
    result = transform(spark, sf_dir)
    return quality.quality_report(
        result,
        [
            *[quality.required(c) for c in CANONICAL.fieldNames()],
            quality.not_blank("title"),
            quality.unique("title"),
            quality.domain("source", SOURCES),
            quality.in_range("rating", 1, 5),
            quality.above("price", 0),
        ],
    )


# --- pages --------------------------------------------------------------------------------


@query
def html_records(spark, sf_dir):
    return pages.product_records(R.catalogue_pages(spark, sf_dir), keep=["url"])


@query
def html_rejects(spark, sf_dir):
    rejected = pages.rejected_products(R.catalogue_pages(spark, sf_dir), keep=["url"])
    return rejected.groupBy("url", "reason").agg(F.count(F.lit(1)).alias("n_products"))


@query
def page_walk(spark, sf_dir):
    linked = R.linked_pages(spark, sf_dir)
    starts = linked.groupBy("host").agg(F.min_by("url", "page_id").alias("url"))
    return pages.walk_pages(linked, starts, max_pages=5)


@query
def catalogue_walk(spark, sf_dir):
    """Each shop read from its first page, at most five pages deep, as product records."""
    stored = materialize(R.catalogue_pages(spark, sf_dir), "pages")
    linked = pages.with_next_url(stored, R.CATALOGUE_URL)
    starts = stored.where(F.col("page") % R.PAGES_PER_SHOP == 0)
    walked = pages.walk_pages(linked, starts, max_pages=5)
    records = pages.product_records(stored, keep=["url"])
    return walked.join(records, "url").select("start_url", "depth", "title", "price", "availability", "rating", "source")


@query
def site_walk(spark, sf_dir):
    """Each shop walked to its end, however many pages that takes."""
    linked = pages.with_next_url(R.catalogue_pages(spark, sf_dir), R.CATALOGUE_URL)
    starts = linked.where(F.col("page") % R.PAGES_PER_SHOP == 0)
    return pages.walk_pages(linked, starts, max_pages=None)


# --- relations and documents --------------------------------------------------------------


@query
def src_sql(spark, sf_dir):
    return rel.read_sql(
        spark,
        "SELECT c_custkey AS id, c_name, c_mktsegment FROM {customer}",
        customer=R.table(spark, sf_dir, "customer"),
    )


@query
def json_people(spark, sf_dir):
    return rel.each_person(rel.people_documents(R.people_json(spark, sf_dir)).drop("json"))


@query
def json_messages(spark, sf_dir):
    people = rel.each_person(rel.people_documents(R.people_json(spark, sf_dir)).drop("json"))
    return rel.person_messages(people).select("c_custkey", "message")


# --- files --------------------------------------------------------------------------------


@query
def file_format(spark, sf_dir):
    return R.file_contents(spark, sf_dir).select(
        "doc_id", probe.file_format(F.col("content")).alias("format"), probe.magic_hex(F.col("content"), 2).alias("magic")
    )


@query
def file_encoding(spark, sf_dir):
    return R.encoded_contents(spark, sf_dir).select("doc_id", probe.file_encoding(F.col("content")).alias("encoding"))


@query
def malformed_bytes(spark, sf_dir):
    """Text of files with a stray byte, read as what they were taken for."""
    contents = R.encoded_contents(spark, sf_dir).withColumn("encoding", probe.file_encoding(F.col("content")))
    repaired = F.make_valid_utf8(F.col("content").cast("string"))
    decoded = F.when(F.col("encoding") == probe.UTF8, repaired).otherwise(F.decode("content", probe.LATIN1))
    return contents.select("doc_id", F.length(decoded).alias("n_chars"), decoded.contains("�").alias("replaced"))


@query
def file_delimiter(spark, sf_dir):
    return R.header_lines(spark, sf_dir).select("c_custkey", probe.header_delimiter(F.col("header")).alias("delimiter"))


@query
def src_csv(spark, sf_dir):
    """Parts written as files of three kinds, then read back without being told which is which."""
    root = staging_path(spark, "csv")
    title = F.concat(R.part_title(), F.lit(" é\n'\"q\""))
    for kind, (encoding, sep) in enumerate((("UTF-8", ","), ("ISO-8859-1", ";"), ("UTF-8", "\t"))):
        parts = R.table(spark, sf_dir, "part").where(F.col("p_partkey") % 3 == kind)
        flat = title if kind == 0 else F.replace(title, F.lit("\n"), F.lit(", "))
        sinks.write_csv(
            parts.select(flat.alias("title"), R.part_price().alias("price"), F.col("p_partkey").alias("part")),
            f"{root}/{kind}",
            encoding,
            sep,
        )
    return delimited.read_csv_auto(spark, root, "*.csv")


@query
def csv_late_latin1(spark, sf_dir):
    """Files whose only letters beyond ASCII come far behind their beginning."""
    root = staging_path(spark, "late")
    parts = R.table(spark, sf_dir, "part").repartitionByRange(2, "p_partkey").sortWithinPartitions("p_partkey")
    late = F.when(F.col("p_partkey") % 190 == 189, F.lit("café")).otherwise(F.lit("tea"))
    sinks.write_csv(parts.select(F.col("p_partkey").alias("part"), "p_name", "p_type", late.alias("drink")), root, "ISO-8859-1")
    return delimited.read_csv_auto(spark, root, "*.csv").select("part", "drink")


@query
def csv_formats(spark, sf_dir):
    """One table in UTF-8, UTF-16 and compressed files."""
    root = staging_path(spark, "formats")
    parts = R.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), F.concat("p_name", F.lit(" é")).alias("name"))
    for kind, options in enumerate(({}, {"encoding": "UTF-16"}, {"compression": "gzip"})):
        some = parts.where(F.col("part") % 3 == kind)
        some.write.option("header", True).options(**options).csv(f"{root}/{kind}")
    return delimited.read_csv_auto(spark, root, "*.csv*")


@query
def csv_bad_rows(spark, sf_dir):
    path = staging_path(spark, "lines")
    R.ragged_lines(spark, sf_dir).write.text(path)
    return delimited.read_csv(spark, path, ["a", "b", "c"], header=False)


@query
def src_zip_csv(spark, sf_dir):
    archives = R.zip_archives(spark, sf_dir)
    return delimited.read_archives(archives, ["part", "title", "price", "isbn"])


# --- sinks --------------------------------------------------------------------------------


def _written(spark, sf_dir, **options):
    result = transform(spark, sf_dir)
    receipt = sinks.write_parquet(result, staging_path(spark, "books"), **options)
    return receipt, sinks.read_back(spark, receipt)


@query
def sink_parquet_roundtrip(spark, sf_dir):
    return _written(spark, sf_dir)[1]


@query
def sink_observed_count(spark, sf_dir):
    receipt, dataset = _written(spark, sf_dir, rebalance=True)
    return rows.count_rows(dataset, "n_stored").withColumn("n_observed", F.lit(receipt.rows).cast("long"))


@query
def sink_inventory(spark, sf_dir):
    """Files and rows per partition, the files held against the listing."""
    receipt, dataset = _written(spark, sf_dir)
    listed = sinks.list_objects(spark, receipt.path).groupBy(F.regexp_extract("key", "^source=([^/]+)/", 1).alias("source")).agg(F.count(F.lit(1)).alias("n_listed"))
    both = sinks.inventory(dataset).join(listed, "source", "full")
    return both.select("source", "n_rows", F.col("n_files").eqNullSafe(F.col("n_listed")).alias("files_agree"))


@query
def sink_listing(spark, sf_dir):
    """Partitions of all listed keys, and of those below one prefix."""
    receipt, _ = _written(spark, sf_dir)
    prefix = F.regexp_extract("key", "^(source=[^/]+)/", 1).alias("prefix")
    every = sinks.list_objects(spark, receipt.path).select(prefix, F.lit("").alias("asked"))
    web = sinks.list_objects(spark, receipt.path, "source=web/").select(prefix, F.lit("source=web/").alias("asked"))
    return every.unionByName(web).distinct()


@query
def sink_first_keys(spark, sf_dir):
    """The first key in order lies in the first partition."""
    receipt, _ = _written(spark, sf_dir)
    first = sinks.list_objects(spark, receipt.path, first=1)
    return first.select(F.regexp_extract("key", "^(source=[^/]+)/", 1).alias("prefix"))


@query
def sink_csv_roundtrip(spark, sf_dir):
    table = R.books(spark, sf_dir)
    path = sinks.write_csv(table, staging_path(spark, "books-csv"))
    return columns.conform(
        delimited.read_csv(spark, path, table.columns, source=None), text_defaults={}
    )


@query
def etl_end_to_end(spark, sf_dir):
    """Files, pages and a relation through the whole job; rows per stored source."""
    root = staging_path(spark, "lake")
    sinks.write_csv(
        R.csv_rows(spark, sf_dir).select(
            F.col("title").alias("Book-Title"),
            F.col("availability").alias("Book-Author"),
            F.col("rating").alias("Year-Of-Publication"),
        ),
        f"{root}/raw/books",
    )
    from millrace.schemas import BOOK_FILE_COLUMNS

    job = Job(
        sources=[
            Source("web", lambda s: pages.product_records(R.catalogue_pages(s, sf_dir))),
            Source("csv", lambda s: delimited.read_csv_auto(s, f"{root}/raw/books"), BOOK_FILE_COLUMNS),
            Source("sql", lambda s: sql_projection(s, sf_dir)),
            Source("gone", lambda s: s.read.parquet(f"{root}/raw/none")),
        ],
        lake=root,
    )
    dataset = sinks.read_back(spark, run(spark, job, RUN_TS))
    return dataset.groupBy("source", "price_category", "is_available", "rating_label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("title").alias("first_title")
    )
