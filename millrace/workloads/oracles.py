"""The queries again, in SQL over the given tables."""

from __future__ import annotations

from millrace.schemas import FALLBACK_PEOPLE, GREETING

# --- inputs -------------------------------------------------------------------------------

WEB = """
SELECT p_name || ' ' || p_brand AS title, round(p_retailprice - 900, 2) AS price,
       CASE p_size % 3 WHEN 0 THEN ' In stock ' WHEN 1 THEN 'Out of stock' END AS availability,
       CAST(p_size % 6 AS DOUBLE) AS rating, ' Web ' AS source
FROM part"""

CSV = """
SELECT CASE WHEN s_suppkey % 10 <> 0 THEN s_name END AS title,
       'In Stock (' || s_nationkey || ')' AS availability,
       CAST(s_nationkey % 6 AS DOUBLE) AS rating, 'csv' AS source
FROM supplier"""

SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS title, CAST(NULL AS DOUBLE) AS price, c_name AS availability,
       CAST(0 AS DOUBLE) AS rating, 'sql' AS source
FROM customer"""

BOOKS = f"books AS ({WEB} UNION ALL BY NAME {CSV} UNION ALL BY NAME {SQL})"

NUMBERS = """
numbers AS (SELECT event_id, CASE
    WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'bad'
    WHEN event_id % 5 = 0 THEN value || 'd' WHEN event_id % 3 = 0 THEN ' -' || value || ' '
    WHEN event_id % 2 = 0 THEN value || 'e2' ELSE CAST(value AS VARCHAR) END AS raw_value
FROM events)"""

_PRODUCT = f"""
SELECT p_partkey, CAST(p_partkey // 20 AS BIGINT) AS page, p_name || ' & "' || p_brand || '"' AS title,
       round(p_retailprice - 900, 2) AS price,
       CASE WHEN p_size % 3 = 0 THEN 'In stock' ELSE 'Out of stock' END AS availability,
       CAST(p_size % 6 AS INTEGER) AS rating, 'web' AS source,
       CASE WHEN p_partkey % 37 = 0 THEN 'title' WHEN p_partkey % 41 = 0 THEN 'price'
            WHEN p_partkey % 43 = 0 THEN 'rating' END AS reason
FROM part"""


def _page_url(page: str) -> str:
    return f"'http://shop.example.com/catalogue/shop-' || ({page} // 8) || '/page-' || ({page} % 8 + 1) || '.html'"


PRODUCTS = f"products AS ({_PRODUCT})"

_FALLBACK = ", ".join(f"({i}, '{craft}', '{name}')" for i, (craft, name) in enumerate(FALLBACK_PEOPLE))

PEOPLE = f"""
people AS (
    SELECT c_custkey, CAST(c_nationkey % 4 AS INTEGER) AS number, false AS is_fallback,
           c_mktsegment AS craft, c_name || ' ' || k AS name
    FROM customer, range(1, 4) AS r(k)
    WHERE k <= c_nationkey % 4 AND c_custkey % 97 <> 0 AND c_custkey % 89 <> 0
    UNION ALL
    SELECT c_custkey, 12, true, craft, name
    FROM customer, (VALUES {_FALLBACK}) AS f(i, craft, name)
    WHERE c_custkey % 97 = 0 OR c_custkey % 89 = 0)"""

# --- steps --------------------------------------------------------------------------------

_CATEGORY = "CASE WHEN price < 10 THEN 'low' WHEN price < 30 THEN 'medium' WHEN price < 60 THEN 'high' ELSE 'premium' END"
_AVAILABLE = "coalesce(contains(lower(availability), 'in stock'), false)"
_LABEL = "CASE WHEN rating >= 4 THEN 'excellent' WHEN rating >= 3 THEN 'good' WHEN rating >= 2 THEN 'average' ELSE 'poor' END"
_STAMP = "TIMESTAMP '2026-01-01 00:00:00' AS processed_at, '1.0.0' AS pipeline_version"


def _nulls_first(*names: str) -> str:
    return ", ".join(f"{n} ASC NULLS FIRST" for n in names)


def _deduped(table: str, keys: str = "title, source", order: str = _nulls_first("price", "availability", "rating")) -> str:
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {table}) WHERE rn = 1"


def _transformed(table: str) -> str:
    """Clean, normalize and enrich a table whose duplicates are gone."""
    return f"""
    SELECT *, {_CATEGORY} AS price_category, {_AVAILABLE} AS is_available, {_LABEL} AS rating_label
    FROM (SELECT trim(title, ' ') AS title, coalesce(price, 0.0::DOUBLE) AS price,
                 coalesce(trim(availability, ' '), 'Unknown') AS availability, rating,
                 lower(trim(source, ' ')) AS source, {_STAMP}
          FROM {table})"""


def _report(table: str, *rules: tuple[str, str], ctes: str = BOOKS) -> str:
    lines = [
        f"SELECT '{name}' AS rule, count(*) AS checked, CAST({failed} AS BIGINT) AS failed, {failed} = 0 AS passed FROM {table}"
        for name, failed in rules
    ]
    return (f"WITH {ctes} " if ctes else "") + " UNION ALL ".join(lines)


_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)\s*$"
_COERCED = f"CASE WHEN regexp_matches(raw_value, '{_NUMBER}') THEN TRY_CAST(trim(raw_value) AS DOUBLE) END"

_DISTINCT = f"WITH {BOOKS}, kept AS ({_deduped('(SELECT * FROM books WHERE title IS NOT NULL)')})"

_KEEP_NAN = f"""
WITH {BOOKS}, filled AS (
    SELECT coalesce(title, '') AS title, source, rating,
           CASE WHEN source = 'csv' THEN price ELSE coalesce(price, 'nan'::DOUBLE) END AS price,
           CASE WHEN availability IS NULL THEN '' ELSE availability END AS availability
    FROM books),
kept AS ({_deduped('filled')})"""

_CONFORMED = f"""
WITH {BOOKS}, filled AS (
    SELECT title, coalesce(availability, '') AS availability, price, rating, source FROM books
    WHERE title <> ''),
kept AS ({_deduped('filled', "trim(title, ' '), lower(trim(source, ' '))", _nulls_first('title', 'source', 'availability', 'price', 'rating'))})"""

_WALK = r"""
WITH RECURSIVE linked AS (
    SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host,
           lead(url) OVER (PARTITION BY regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) ORDER BY page_id) AS next_url,
           row_number() OVER (PARTITION BY regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) ORDER BY page_id) AS n
    FROM pages),
walk AS (
    SELECT url AS start_url, 1 AS depth, url, next_url FROM linked WHERE n = 1
    UNION ALL
    SELECT w.start_url, w.depth + 1, l.url, l.next_url
    FROM walk w JOIN linked l ON l.url = w.next_url WHERE w.depth < 5)
SELECT start_url, depth, url FROM walk"""

_WORD = "CASE p_size % 7 WHEN 0 THEN 'Zero' WHEN 1 THEN 'One' WHEN 2 THEN 'Two' WHEN 3 THEN 'Three' WHEN 4 THEN 'Four' WHEN 5 THEN 'Five' END"

_RAGGED = """
SELECT CAST(p_partkey AS VARCHAR) AS a, 'csv' AS source,
       CASE p_partkey % 6 WHEN 4 THEN p_name || ', "x"' WHEN 5 THEN NULL ELSE p_name END AS b,
       CASE p_partkey % 6 WHEN 0 THEN p_brand WHEN 4 THEN p_brand END AS c
FROM part WHERE p_partkey % 6 NOT IN (1, 3)"""

_MONEY_TEXT = """
CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'n/a'
     WHEN event_id % 5 = 0 THEN 'Â£' || value WHEN event_id % 3 = 0 THEN '1.' || value
     ELSE '£1,' || lpad(CAST(value AS VARCHAR), 6, '0') END"""

ORACLES: dict[str, str] = {
    # the catalogue transform
    "transform": f"{_DISTINCT} {_transformed('kept')}",
    "transform_keep_nan": f"{_KEEP_NAN} {_transformed('kept')}",
    "transform_conformed": f"{_CONFORMED} {_transformed('kept')}",
    "union_sources": f"WITH {BOOKS} SELECT * FROM books",
    "union_single": WEB,
    "enrich_partial": f"WITH {BOOKS} SELECT title, rating, source, {_LABEL} AS rating_label FROM books",
    "clean": f"""{_DISTINCT} SELECT title, coalesce(price, 0.0::DOUBLE) AS price,
        coalesce(trim(availability, ' '), 'Unknown') AS availability, rating, source FROM kept""",
    "normalize": f"""WITH {BOOKS} SELECT trim(title, ' ') AS title, price, trim(availability, ' ') AS availability,
        rating, lower(trim(source, ' ')) AS source, {_STAMP} FROM books""",
    "enrich": f"WITH {BOOKS} SELECT *, {_CATEGORY} AS price_category, {_AVAILABLE} AS is_available, {_LABEL} AS rating_label FROM books",
    # duplicates
    "dedup_keys": f"WITH {BOOKS} {_deduped('books')}",
    "dedup_lineitem": _deduped(
        "lineitem",
        "l_partkey, l_suppkey",
        _nulls_first(
            "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate",
        ),
    ),
    "dedup_count": f"WITH {BOOKS} SELECT count(*) AS n_kept FROM (SELECT DISTINCT title, source FROM books)",
    "dedup_normalized": f"""WITH {BOOKS}, padded AS (
        SELECT * REPLACE (CASE WHEN rating >= 3 THEN ' ' || title ELSE title END AS title) FROM books)
        {_deduped('padded', "trim(title, ' '), lower(trim(source, ' '))", _nulls_first('title', 'source', 'price', 'availability', 'rating'))}""",
    # columns
    "norm_columns": "SELECT p_name AS book_title, p_brand AS book_author, p_size AS year_of_publication, p_partkey AS isbn FROM part",
    "rename_columns": "SELECT p_name AS title, p_brand AS availability, p_size AS rating, p_partkey AS isbn FROM part",
    "conform_schema": f"""WITH {NUMBERS} SELECT
        CASE WHEN event_id % 4 <> 0 THEN CAST(event_id AS VARCHAR) ELSE '' END AS title, '' AS availability,
        {_COERCED} AS price, CAST(event_id % 6 AS DOUBLE) AS rating, '' AS source FROM numbers""",
    "coerce_numeric": f"WITH {NUMBERS} SELECT event_id, raw_value, {_COERCED} AS value FROM numbers",
    "fill_text": f"""WITH {BOOKS} SELECT coalesce(title, '') AS title, price, coalesce(availability, '') AS availability,
        rating, coalesce(source, 'unknown') AS source FROM books""",
    "tag_source": "SELECT c_custkey, c_mktsegment AS source, 'sql' AS origin FROM customer",
    "run_timestamp": f"WITH {BOOKS} SELECT {_STAMP}, count(*) AS n_rows FROM books",
    "sql_projection": """SELECT CAST(c_custkey AS VARCHAR) AS title, c_name AS availability,
        CAST(NULL AS DOUBLE) AS price, 0 AS rating, 'sql' AS source FROM customer""",
    # scalar functions
    "parse_money": f"""SELECT event_id, raw_price, TRY_CAST(regexp_replace(raw_price, '[^0-9.]', '', 'g') AS DOUBLE) AS price
        FROM (SELECT event_id, {_MONEY_TEXT} AS raw_price FROM events)""",
    "rating_words": f"""SELECT p_partkey, {_WORD} AS word,
        CAST(CASE WHEN p_size % 7 BETWEEN 1 AND 5 THEN p_size % 7 ELSE 0 END AS INTEGER) AS rating FROM part""",
    "strip_ws": "SELECT event_id, event_type || ' x' AS stripped FROM events",
    "price_category": f"WITH {BOOKS} SELECT title, price, {_CATEGORY} AS price_category FROM books",
    "price_category_alt": f"""WITH {BOOKS} SELECT title, price, CASE WHEN price IS NULL OR isnan(price) THEN 'unknown'
        WHEN price < 10 THEN 'low' WHEN price < 25 THEN 'medium' ELSE 'high' END AS price_category FROM books""",
    "event_value_buckets": """SELECT event_type, CASE WHEN value IS NULL OR isnan(value) THEN 'none' WHEN value < 50 THEN 'small'
        WHEN value < 100 THEN 'middle' WHEN value < 250 THEN 'large' ELSE 'huge' END AS bucket, count(*) AS n_events
        FROM events GROUP BY 1, 2""",
    "rating_label": f"WITH {BOOKS} SELECT title, rating, {_LABEL} AS rating_label FROM books",
    "is_available": f"WITH {BOOKS} SELECT title, availability, {_AVAILABLE} AS is_available FROM books",
    "url_rewrite": r"""SELECT page_id, url, CASE WHEN regexp_matches(url, '/d/([a-zA-Z0-9_-]+)')
        THEN 'https://drive.google.com/uc?export=download&id=' || regexp_extract(url, '/d/([a-zA-Z0-9_-]+)', 1) ELSE url END AS direct_url
        FROM (SELECT page_id, CASE WHEN page_id % 2 = 0
              THEN 'https://drive.google.com/file/d/1s-x_' || page_id || 'Ab/view?usp=sharing' ELSE url END AS url FROM pages)""",
    # filters, counts, limits
    "drop_null_title": f"WITH {BOOKS} SELECT * FROM books WHERE title IS NOT NULL",
    "blank_titles": f"""WITH {BOOKS}, padded AS (SELECT * REPLACE (
        CASE rating WHEN 2 THEN '' WHEN 4 THEN ' ' ELSE title END AS title) FROM books)
        SELECT * FROM padded WHERE title IS NULL OR title = ''""",
    "suffix_filter": "SELECT page_id, url FROM pages WHERE lower(url) LIKE '%.html'",
    "prefix_filter": "SELECT page_id, url FROM pages WHERE starts_with(url, 'https://blog.')",
    "count_rows": "SELECT count(*) AS total FROM customer",
    "rows_per_source": f"""WITH {BOOKS} SELECT source, CAST(count(*) AS BIGINT) AS n_rows, CAST(grouping(source) AS INTEGER) AS is_total
        FROM books GROUP BY ROLLUP (source)""",
    "distinct_titles": f"WITH {BOOKS} SELECT count(DISTINCT title) AS n_titles FROM books",
    "source_domain": f"WITH {BOOKS} SELECT DISTINCT source FROM books",
    "min_price": f"WITH {BOOKS} SELECT min(price) AS min_price FROM books",
    "all_positive": "SELECT bool_and(coalesce(value > 0, false)) AS all_positive FROM events",
    "limit_rows": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500",
    "preview": """SELECT CAST(doc_id AS VARCHAR) AS doc_id,
        CASE WHEN length(text) > 35 THEN substring(text, 1, 32) || '...' ELSE text END AS text, lang
        FROM documents ORDER BY documents.doc_id LIMIT 5""",
    # quality
    "dq_required": _report(
        "books",
        *[(f"required:{c}", "0") for c in ("title", "availability", "price", "rating", "source")],
        ("required:isbn", "count(*)"),
    ),
    "dq_numeric": _report(
        "numbers", ("numeric:raw_value", f"count(*) FILTER (raw_value IS NOT NULL AND ({_COERCED}) IS NULL)"), ctes=NUMBERS
    ),
    "dq_unique": _report(
        "books",
        ("unique:title", "(count(title) - count(DISTINCT title))"),
        (
            "unique:title,source",
            "(count(*) FILTER (title IS NOT NULL AND source IS NOT NULL)"
            " - count(DISTINCT (title, source)) FILTER (title IS NOT NULL AND source IS NOT NULL))",
        ),
    ),
    "dq_domain": _report(
        "events",
        ("domain:event_type", "count(*) FILTER (event_type IS NULL OR event_type NOT IN ('click', 'view', 'purchase'))"),
        ctes="",
    ),
    "dq_range": _report(
        "customer",
        ("range:c_acctbal", "count(*) FILTER (c_acctbal IS NULL OR c_acctbal < 0 OR c_acctbal > 9000)"),
        ("above:c_acctbal", "count(*) FILTER (c_acctbal IS NULL OR c_acctbal <= 0)"),
        ctes="",
    ),
    "dq_blank": _report("books", ("not_blank:title", "count(*) FILTER (title IS NULL OR title = '')")),
    "dq_report": _report(
        "result",
        *[(f"required:{c}", "0") for c in ("title", "availability", "price", "rating", "source")],
        ("not_blank:title", "count(*) FILTER (title IS NULL OR title = '')"),
        ("unique:title", "(count(title) - count(DISTINCT title))"),
        ("domain:source", "count(*) FILTER (source IS NULL OR source NOT IN ('web', 'csv', 'sql'))"),
        ("range:rating", "count(*) FILTER (rating IS NULL OR rating < 1 OR rating > 5)"),
        ("above:price", "count(*) FILTER (price IS NULL OR price <= 0)"),
        ctes=f"{_DISTINCT.removeprefix('WITH ')}, result AS ({_transformed('kept')})",
    ),
    # pages
    "html_records": f"""WITH {PRODUCTS} SELECT {_page_url('page')} AS url, title, price, availability, rating, source
        FROM products WHERE reason IS NULL""",
    "html_rejects": f"""WITH {PRODUCTS} SELECT {_page_url('page')} AS url, reason, count(*) AS n_products
        FROM products WHERE reason IS NOT NULL GROUP BY ALL""",
    "page_walk": _WALK,
    "catalogue_walk": f"""WITH {PRODUCTS} SELECT {_page_url('(page - page % 8)')} AS start_url,
        CAST(page % 8 + 1 AS INTEGER) AS depth, title, price, availability, rating, source
        FROM products WHERE reason IS NULL AND page % 8 < 5""",
    "site_walk": f"""WITH {PRODUCTS} SELECT DISTINCT {_page_url('(page - page % 8)')} AS start_url,
        CAST(page % 8 + 1 AS INTEGER) AS depth, {_page_url('page')} AS url FROM products""",
    # relations and documents
    "src_sql": """SELECT c_custkey AS id, c_name, c_mktsegment, 'sql' AS source FROM customer""",
    "json_people": f"WITH {PEOPLE} SELECT * FROM people",
    "json_messages": f"""WITH {PEOPLE} SELECT c_custkey,
        name || ' is currently in space flying on the ' || craft || '! {GREETING}' AS message FROM people""",
    # files
    "file_format": """SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'zip' WHEN 1 THEN 'utf8_bom' WHEN 2 THEN 'utf16'
        WHEN 3 THEN 'utf16' WHEN 4 THEN 'gzip' WHEN 5 THEN 'html' WHEN 6 THEN 'utf8_bom' ELSE 'unknown' END AS format,
        CASE doc_id % 8 WHEN 0 THEN '504b' WHEN 1 THEN 'efbb' WHEN 2 THEN 'fffe' WHEN 3 THEN 'feff' WHEN 4 THEN '1f8b'
        WHEN 5 THEN '203c' WHEN 6 THEN '7365' ELSE lower(hex(encode('#' || substring(text, 1, 1))))[1:4] END AS magic
        FROM documents""",
    "file_encoding": "SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding FROM documents",
    "malformed_bytes": """SELECT doc_id, CAST(CASE doc_id % 3 WHEN 0 THEN 5 + strlen(text) WHEN 1 THEN 8802 + strlen(text)
        ELSE length(text) END AS INTEGER) AS n_chars, doc_id % 3 = 2 AND contains(text, '�') AS replaced FROM documents""",
    "file_delimiter": """SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN ',' WHEN 1 THEN ';' WHEN 2 THEN chr(9)
        WHEN 3 THEN '|' WHEN 5 THEN ' ' WHEN 6 THEN ':' ELSE ',' END AS delimiter FROM customer""",
    "src_csv": """SELECT p_name || ' ' || p_brand || ' é' || CASE WHEN p_partkey % 3 = 0 THEN chr(10) ELSE ', ' END || '''"q"' AS title,
        CAST(round(p_retailprice - 900, 2) AS VARCHAR) AS price, CAST(p_partkey AS VARCHAR) AS part, 'csv' AS source FROM part""",
    "csv_late_latin1": """SELECT CAST(p_partkey AS VARCHAR) AS part,
        CASE WHEN p_partkey % 190 = 189 THEN 'café' ELSE 'tea' END AS drink FROM part""",
    "csv_formats": "SELECT CAST(p_partkey AS VARCHAR) AS part, p_name || ' é' AS name, 'csv' AS source FROM part",
    "csv_bad_rows": _RAGGED,
    "src_zip_csv": """SELECT CAST(p_partkey AS VARCHAR) AS part, p_name || ' ' || p_brand AS title,
        CAST(round(p_retailprice - 900, 2) AS VARCHAR) AS price, CAST(NULL AS VARCHAR) AS isbn, 'csv' AS source FROM part""",
    # sinks
    "sink_parquet_roundtrip": f"{_DISTINCT} {_transformed('kept')}",
    "sink_observed_count": f"{_DISTINCT} SELECT count(*) AS n_stored, count(*) AS n_observed FROM kept",
    "sink_inventory": f"""{_DISTINCT} SELECT lower(trim(source, ' ')) AS source, count(*) AS n_rows, true AS files_agree
        FROM kept GROUP BY 1""",
    "sink_listing": f"""{_DISTINCT} SELECT DISTINCT 'source=' || lower(trim(source, ' ')) AS prefix, '' AS asked FROM kept
        UNION ALL SELECT DISTINCT 'source=web' AS prefix, 'source=web/' AS asked FROM part""",
    "sink_first_keys": f"{_DISTINCT} SELECT min('source=' || lower(trim(source, ' '))) AS prefix FROM kept",
    "sink_csv_roundtrip": f"WITH {BOOKS} SELECT title, availability, price, rating, source FROM books",
    "etl_end_to_end": f"""
WITH {PRODUCTS}, joined AS (
    SELECT title, price, availability, CAST(rating AS DOUBLE) AS rating, source FROM products WHERE reason IS NULL
    UNION ALL BY NAME
    SELECT coalesce(title, '') AS title, availability, rating, source FROM ({CSV})
    UNION ALL BY NAME
    SELECT title, price, availability, rating, source FROM ({SQL})),
kept AS ({_deduped('joined', order=_nulls_first('availability', 'price', 'rating'))}),
result AS ({_transformed('kept')})
SELECT source, price_category, is_available, rating_label, count(*) AS n_rows, min(title) AS first_title
FROM result GROUP BY ALL""",
}
