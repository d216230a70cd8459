"""Delimited text as lines, records and fields, whatever each file's layout.

Lines of all files come from one scan and meet their file's layout by its path. A line break inside quotes
parts lines, not records. Whether a line begins inside quotes depends on all lines before it, but each line
alone says what it makes of either case: it leaves the state as it is, turns it, or sets it. Such functions
compose, first within each block that Spark reads by itself, then over the blocks of a file, of which only
one row each is left. So a file with line breaks inside quotes is split like any other.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import materialize
from millrace.sources.probe import DELIMITERS, LATIN1, RARE_DELIMITERS, UTF8

QUOTED = '"[^"]*+(?:""[^"]*+)*+"'

#: stands between the columns of lines that are read whole; a line that has it is kept by its raw text
_NO_DELIMITER = "\x01"


def plain_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(uri, line)`` of all lines below a path but each file's header and blank ones; bytes are letters of Latin-1."""
    reader = spark.read.schema("line string, raw string")
    options = {
        "header": True, "sep": _NO_DELIMITER, "quote": "", "escape": "", "encoding": LATIN1, "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "raw", "columnPruning": False, "recursiveFileLookup": True,
    }
    if glob:
        options["pathGlobFilter"] = glob
    rows = reader.options(**options).csv(path)
    return rows.select(F.col("_metadata.file_path").alias("uri"), F.coalesce("raw", "line").alias("line"))


def decoded(line: Column, encoding: Column) -> Column:
    """Text of a line that was read as Latin-1. UTF-8's undecodable bytes become U+FFFD."""
    utf8 = F.make_valid_utf8(F.encode(line, LATIN1).cast("string"))
    return F.when((encoding != UTF8) | (F.octet_length(line) == F.char_length(line)), line).otherwise(utf8)


def _by_delimiter(sep: Column, used: Sequence[str], made: Callable[[str], Column]) -> Column:
    """``made(delimiter)`` for the one of ``used`` that ``sep`` is; patterns must be known when a query is planned."""
    out = made(used[-1])
    for d in used[:-1]:
        out = F.when(sep == d, made(d)).otherwise(out)
    return out


def fields(record: Column, sep: Column, used: Sequence[str] = DELIMITERS + RARE_DELIMITERS) -> Column:
    """The fields of a record: a quote opens one at its start only, two stand for one, and an empty one is NULL."""

    def of(d: str) -> Column:
        # a field that is never closed reaches to the end
        pattern = rf'{re.escape(d)}("[^"]*+(?:""[^"]*+)*+(?:"[^{re.escape(d)}]*+|\z)|[^{re.escape(d)}]*+)'
        found = F.regexp_extract_all(F.concat(F.lit(d), record), F.lit(pattern), F.lit(1))

        def bare(x: Column) -> Column:
            closed = r'(?s)^"([^"]*+(?:""[^"]*+)*+)"?+(.*)$'
            inner, rest = F.regexp_extract(x, closed, 1), F.regexp_extract(x, closed, 2)
            return F.when(x.startswith('"'), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)).when(x != "", x)

        plain = F.transform(F.split(record, re.escape(d), -1), lambda x: F.when(x != "", x))
        return F.when(record.contains('"'), F.transform(found, bare)).otherwise(plain)

    return _by_delimiter(sep, used, of)


def is_blank_record(record: Column) -> Column:
    """A line without text, or with one quoted field of blanks, is no row."""
    return record.rlike(r'^\s*+(?:"\s*+"\s*+)?+$')


def _open_after(line: Column, sep: Column, used: Sequence[str]) -> tuple[Column, Column]:
    """Is a quote open after the line, if none was before it, and if one was?"""

    def outside(d: str) -> Column:
        bare = F.regexp_replace(line, f"(^|{re.escape(d)}){QUOTED}", "$1")
        return bare.rlike(f'(?:^|{re.escape(d)})"')

    def inside(d: str) -> Column:
        rest = F.regexp_extract(line, r'(?s)^[^"]*+(?:""[^"]*+)*+"(?!")(.*)$', 1)
        bare = F.regexp_replace(rest, f"({re.escape(d)}){QUOTED}", "$1")
        return ~line.rlike(r'^[^"]*+(?:""[^"]*+)*+"(?!")') | bare.rlike(f'{re.escape(d)}"')

    quote = line.contains('"')
    return quote & _by_delimiter(sep, used, outside), ~quote | _by_delimiter(sep, used, inside)


def quoted_records(spark: SparkSession, path: str, files: DataFrame, used: Sequence[str], glob: str | None = None) -> DataFrame:
    """``(uri, record)`` of the files in ``files`` (``uri, delimiter, encoding``; delimiters are ``used``), headers and blank lines left out.

    A record has line breaks where its quoted fields have them. The header is one line. Lines end with a
    line feed, a carriage return before it counts as part of the end.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    block = F.col("_metadata.file_block_start")
    scanned = reader.text(path).select(F.col("_metadata.file_path").alias("uri"), block.alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    text = F.when(F.col("encoding") == LATIN1, F.decode(F.col("value").cast("binary"), LATIN1)).otherwise(F.make_valid_utf8("value"))
    lines = scanned.join(files.select("uri", "delimiter", "encoding"), "uri").select("uri", "block", "at", "delimiter", text.alias("line"))
    after_out, after_in = _open_after(F.col("line"), F.col("delimiter"), used)
    lines = lines.select("uri", "block", "at", "line", after_out.alias("from_out"), after_in.alias("from_in"))
    composed = materialize(spark.sql(_COMPOSED, lines=lines), "quoted-lines")
    return spark.sql(_ASSEMBLED, lines=composed)


#: What the lines of a block have made of the state so far: the value last set, if any, and the turns since. The
#: header, and what stands before it, set it to 0.
_COMPOSED = """
WITH seen AS (
    SELECT *, block = 0 AND count_if(line RLIKE '[^\\\\ufeff\\\\r]') OVER upto <= 1 AS head FROM {lines}
    WINDOW upto AS (PARTITION BY uri, block ORDER BY at ROWS UNBOUNDED PRECEDING)
), made AS (
    SELECT uri, block, at, line, head,
           CASE WHEN head THEN 0 WHEN from_out = from_in THEN int(from_out) END AS sets,
           int(NOT head AND from_out AND NOT from_in) AS turns
    FROM seen
), turned AS (
    SELECT *, sum(turns) OVER (PARTITION BY uri, block ORDER BY at ROWS UNBOUNDED PRECEDING) AS turned FROM made
), composed AS (
    SELECT *, last(CASE WHEN sets IS NOT NULL THEN struct(sets, turned) END) IGNORE NULLS OVER (
               PARTITION BY uri, block ORDER BY at ROWS UNBOUNDED PRECEDING) AS last
    FROM turned
), state AS (
    SELECT uri, block, at, line, head, struct(last.sets AS value, int((turned - coalesce(last.turned, 0)) % 2) AS odd) AS after
    FROM composed
)
SELECT *, lag(after) OVER (PARTITION BY uri, block ORDER BY at) AS before FROM state
"""

#: Of each block one row: what it makes of either state, and where its last record begins in either case. Lines that
#: are records by themselves pass; the others go to where their record begins.
_ASSEMBLED = """
WITH blocks AS (
    SELECT uri, block, max_by(after, at) AS made,
           max(at) FILTER (WHERE NOT head AND (coalesce(before.value, 0) + coalesce(before.odd, 0)) % 2 = 0) AS start0,
           max(at) FILTER (WHERE NOT head AND (coalesce(before.value, 1) + coalesce(before.odd, 0)) % 2 = 0) AS start1
    FROM {lines} GROUP BY uri, block
), turned AS (
    SELECT *, (made.value + made.odd) % 2 AS sets,
           sum(CASE WHEN made.value IS NULL THEN made.odd ELSE 0 END) OVER (PARTITION BY uri ORDER BY block) AS turned
    FROM blocks
), known AS (
    SELECT *, last(CASE WHEN sets IS NOT NULL THEN struct(sets, turned) END) IGNORE NULLS OVER earlier AS last,
           coalesce(lag(turned) OVER (PARTITION BY uri ORDER BY block), 0) AS sofar
    FROM turned WINDOW earlier AS (PARTITION BY uri ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), begun AS (
    SELECT uri, block, int((coalesce(last.sets, 0) + sofar - coalesce(last.turned, 0)) % 2) AS state, start0, start1 FROM known
), going AS (
    SELECT uri, block, state, last(CASE WHEN if(state = 0, start0, start1) IS NOT NULL
               THEN struct(block, if(state = 0, start0, start1) AS at) END) IGNORE NULLS OVER earlier AS going_on
    FROM begun WINDOW earlier AS (PARTITION BY uri ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), placed AS (
    SELECT l.uri, l.block, l.at, l.line, g.going_on,
           (coalesce(before.value, state) + coalesce(before.odd, 0)) % 2 = 0 AS begins,
           (coalesce(after.value, state) + after.odd) % 2 = 1 AS goes_on
    FROM {lines} l JOIN going g ON l.uri = g.uri AND l.block = g.block WHERE NOT head
), parts AS (
    SELECT uri, block, at, line, coalesce(last(CASE WHEN begins THEN struct(block, at) END) IGNORE NULLS OVER (
               PARTITION BY uri, block ORDER BY at ROWS UNBOUNDED PRECEDING), going_on) AS first
    FROM placed WHERE NOT begins OR goes_on
), joined AS (
    SELECT uri, line AS record FROM placed WHERE begins AND NOT goes_on
    UNION ALL
    SELECT uri, array_join(transform(array_sort(collect_list(struct(block, at, line))), x -> x.line), '\\n')
    FROM parts GROUP BY uri, first
)
SELECT uri, regexp_replace(record, '\\\\r\\\\z', '') AS record FROM joined
"""
