"""Delimited text: plain files and files inside ZIP archives.

The rules for rows follow what pandas' Python parser does with ``on_bad_lines="skip"``: a row with
too many fields is dropped, a short row is filled up with NULL, a row of one blank field is no row,
undecodable bytes become U+FFFD, doubled quotes stand for one, words such as ``NA`` are missing.
"""

from __future__ import annotations

import codecs
import contextlib
import csv
import io
import itertools
import json
import re
import sys
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.text import is_blank, na_to_null, strip_ws
from millrace.operators.columns import quoted, tag_source
from millrace.operators.rows import union_sources
from millrace.schemas import NA_TEXT
from millrace.session import materialize
from millrace.sources.lines import decoded, fields, is_blank_record, plain_lines, quoted_records
from millrace.sources.probe import DELIMITERS, LATIN1, RARE_DELIMITERS, UTF8, UTF16, as_literal_path, profile_files

_QUOTED = '"[^"]*+(?:""[^"]*+)*+"'


def field_count(line: Column, sep: str) -> Column:
    """Fields of a raw line. Delimiters inside quotes do not count; a quote opens at the start of a
    field only."""
    bare = F.regexp_replace(line, f"(^|{re.escape(sep)}){_QUOTED}", "$1")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    header: bool = True,
    multiline: bool = False,
    na_values: Sequence[str] = NA_TEXT,
    source: str | None = "csv",
    glob: str | None = None,
) -> DataFrame:
    """Delimited files with known columns, read as text and tagged with a source.

    Spark marks rows whose number of fields is not the schema's and keeps their raw text; only those
    rows are counted again, to tell the long ones from the short ones. ``multiline`` allows line
    breaks inside quotes, at the price that a file is read by one task.
    """
    raw_text = "_malformed"
    while raw_text in {c.lower() for c in columns}:
        raw_text = f"_{raw_text}"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, raw_text]])
    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    rows = (
        reader.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnPruning", False)  # a pruned parser does not see how many fields a row has
        .option("columnNameOfCorruptRecord", raw_text)
        .option("recursiveFileLookup", "true")
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    raw, first = F.col(raw_text), quoted(columns[0])
    # a row of one blank field is a blank line; it is malformed unless one column is all there is
    one_blank = raw.rlike(r'^\s*"\s*"\s*$') if len(columns) > 1 else is_blank(strip_ws(first))
    fits = raw.isNull() | (field_count(raw, sep) <= len(columns))
    # Spark refuses to read the raw text alone, which is all a count would leave of the row; the last
    # condition always holds, but takes a column along
    takes_along = F.coalesce(F.length(first) >= 0, F.lit(True))
    kept = rows.where(fits & ~F.coalesce(one_blank, F.lit(False)) & takes_along)
    table = kept.select(*[na_to_null(quoted(c), na_values).alias(c) for c in columns])
    return table if source is None else tag_source(table, source)


def read_csv_auto(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    multiline: bool | None = None,
    na_values: Sequence[str] = NA_TEXT,
    source: str | None = "csv",
) -> DataFrame:
    """Delimited files of any mix of encodings, delimiters and headers, in ZIP archives or not,
    united by column name.

    The files are profiled first. Lines of all of them then come from one scan, however many layouts there
    are, and meet their file's layout by its path; no path comes to the driver, only the different headers.
    Files with a quote left open at a line's end take a second scan that puts their records together, split
    like any other; pass ``multiline`` as True or False where that is known of all. Files in UTF-16 are read
    whole, by their paths and layouts, and so are archives. A file that is no delimited text (HTML, or bytes
    of another kind) is an error that names it.
    """
    files = profile_files(spark, path, glob).withColumn("open", F.col("open_quote") if multiline is None else F.lit(multiline))
    files = materialize(files.select("path", "uri", "format", "inner", "header", "delimiter", "encoding", "open"), "profile")
    # a packed file is opened by its name's ending; without it nobody would unpack it
    unread = F.col("inner").isin("html", "binary") | ((F.col("format") == "gzip") & ~F.lower("path").endswith(".gz"))
    wide, zipped = F.col("encoding") == UTF16, F.col("format") == "zip"
    # one row per header and what is to be done with it; unreadable files have none of their own
    header = F.when(~unread & ~zipped, F.col("header"))
    found = files.groupBy(header.alias("header"), F.when(header.isNotNull(), F.col("delimiter")).alias("delimiter")).agg(
        F.bool_or(wide).alias("wide"),
        F.bool_or(~wide & F.col("open")).alias("open"),
        F.bool_or(~wide & ~F.col("open")).alias("split"),
        F.bool_or(zipped).alias("zipped"),
        F.min(F.when(unread, F.concat("path", F.lit(" ("), "inner", F.lit(")")))).alias("refused"),
    )
    found = found.collect()
    refused = sorted(row["refused"] for row in found if row["refused"])
    if refused:
        raise ValueError(f"not delimited text: {', '.join(refused)}")
    layouts = sorted((row for row in found if row["header"]), key=lambda row: (row["header"], row["delimiter"]))
    plain = files.where(~zipped & (F.col("header") != ""))
    tables = []
    if any(row["zipped"] for row in found):
        tables.append(_read_archives_auto(spark, _paths(files.where(zipped)), na_values, source))
    known = plain.where(~wide)
    records = []
    if any(layout["split"] for layout in layouts):
        mine = known.where(~F.col("open")).select("uri", "encoding")
        lines = plain_lines(spark, path, glob).join(mine, "uri")
        records.append(lines.select("uri", decoded(F.col("line"), F.col("encoding")).alias("record")))
    if any(layout["open"] for layout in layouts):
        used = sorted({layout["delimiter"] for layout in layouts if layout["open"]})
        records.append(quoted_records(spark, path, known.where("open"), used, glob))
    if records:
        narrow = [layout for layout in layouts if layout["split"] or layout["open"]]
        tables.append(_table(spark, reduce(DataFrame.unionByName, records), known, narrow, na_values, source))
    for header, sep, *_ in (layout for layout in layouts if layout["wide"]):
        paths = _paths(plain.where(wide & (F.col("header") == header) & (F.col("delimiter") == sep)))
        tables.append(read_csv(spark, paths, _header_names(header, sep), sep, UTF16, True, True, na_values, source, glob))
    if not tables:
        raise FileNotFoundError(f"no delimited file with a header below {path}")
    return union_sources(tables)


def _header_names(header: str, sep: str) -> list[str]:
    return _unique_names(next(csv.reader([header], delimiter=sep)))


def _table(spark: SparkSession, records: DataFrame, files: DataFrame, layouts: list, na_values, source) -> DataFrame:
    """Records (``uri, record``) as the columns of all ``layouts``; long ones and blank ones are no rows."""
    names = [(layout["header"], layout["delimiter"], _header_names(layout["header"], layout["delimiter"])) for layout in layouts]
    columns = list(dict.fromkeys(name for _, _, of_file in names for name in of_file))
    used = sorted({sep for _, sep, _ in names})
    # where in a file's rows each column stands; only the different layouts are listed here
    places = [
        {"header": header, "delimiter": sep, "width": len(of_file), "places": [of_file.index(c) if c in of_file else -1 for c in columns]}
        for header, sep, of_file in names
    ]
    listed = F.from_json(F.lit(json.dumps(places)), "array<struct<header string, delimiter string, width int, places array<int>>>")
    known = spark.range(1).select(F.inline(listed))
    known = files.select("uri", "header", "delimiter").join(known, ["header", "delimiter"]).select("uri", "delimiter", "width", "places")
    rows = records.where(~is_blank_record(F.col("record"))).join(known, "uri")
    # the parts pass through a generator: a filter on them would else be pushed below and repeat the parsing
    parsed = rows.select(F.explode(F.array(F.struct(fields(F.col("record"), F.col("delimiter"), used).alias("f"), "width", "places"))).alias("r"))
    kept = parsed.where(F.size("r.f") <= F.col("r.width"))
    table = kept.select(*[na_to_null(F.get("r.f", F.get("r.places", F.lit(i))), na_values).alias(c) for i, c in enumerate(columns)])
    return table if source is None else tag_source(table, source)


def _paths(files: DataFrame) -> list[str]:
    return sorted(as_literal_path(row["path"]) for row in files.select("path").collect())


def _read_archives_auto(spark: SparkSession, paths: list[str], na_values, source) -> DataFrame:
    """All columns of some archives. A first pass collects the distinct headers."""
    archives = spark.read.format("binaryFile").load(paths).select("content")
    headers = sorted(archive_headers(archives).distinct().collect())
    names = [name for (header,) in headers for name in header]
    return read_archives(archives, list(dict.fromkeys(names)), na_values, source)


def _unique_names(header: Sequence[str]) -> list[str]:
    """Header names with repeats numbered and gaps named, as pandas does."""
    names: list[str] = []
    for i, name in enumerate(header):
        base = name or f"Unnamed: {i}"
        candidate, n = base, 0
        while candidate in names:
            n += 1
            candidate = f"{base}.{n}"
        names.append(candidate)
    return names


_BATCH_ROWS = 10_000
_BATCH_CHARS = 16 * 1024 * 1024


def read_zip_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    na_values: Sequence[str] = NA_TEXT,
    source: str | None = "csv",
) -> DataFrame:
    """Named columns of the delimited files inside the ZIP archives below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    archives = files.where(F.hex(F.substring("content", 1, 2)) == "504B")
    return read_archives(archives, columns, na_values, source)


def read_archives(
    archives: DataFrame,
    columns: Sequence[str],
    na_values: Sequence[str] = NA_TEXT,
    source: str | None = "csv",
    content: str = "content",
) -> DataFrame:
    """Named columns of the delimited file in each ZIP archive of a table, one task per archive.

    Of the members the first ending in ``.csv``, in any case, is taken, else the first. It is
    decompressed as a stream. Columns go by the names in each archive's own header; one it lacks is
    NULL. Long rows are dropped, short rows filled with NULL.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = archives.select(quoted(content).alias("content")).mapInPandas(_archive_rows(list(columns)), schema)
    table = rows.select(*[na_to_null(quoted(c), na_values).alias(c) for c in columns])
    return table if source is None else tag_source(table, source)


def archive_headers(archives: DataFrame, content: str = "content") -> DataFrame:
    """``(header)``, the column names of each archive's delimited file."""
    return archives.select(quoted(content).alias("content")).mapInPandas(_archive_headers, "header array<string>")


def _archive_rows(columns: list[str]):
    def read(batches):
        import pandas as pd

        for batch in batches:
            for content in batch["content"]:
                with _open_member(content) as text:
                    header, reader = _open_reader(text)
                    places = [header.index(c) if c in header else len(header) for c in columns]
                    for rows in _row_batches(reader, len(header)):
                        picked = [[row[i] if i < len(row) else None for i in places] for row in rows]
                        yield pd.DataFrame(picked, columns=columns, dtype=object)

    return read


def _archive_headers(batches) -> Iterator:
    import pandas as pd

    for batch in batches:
        headers = []
        for content in batch["content"]:
            with _open_member(content) as text:
                headers.append(_open_reader(text)[0])
        yield pd.DataFrame({"header": headers})


@contextlib.contextmanager
def _open_member(content: bytes):
    """The archive's delimited file as text; empty text when there is none."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        names = archive.namelist()
        if not names:
            yield io.StringIO()
            return
        member = next((m for m in names if m.lower().endswith(".csv")), names[0])
        with archive.open(member) as stream:
            encoding = _encoding_of(stream)
        with archive.open(member) as stream:
            yield io.TextIOWrapper(stream, encoding, errors="replace", newline="")


def _open_reader(text) -> tuple[list[str], Iterator[list[str]]]:
    """Header names, and the reader of the rows behind the header."""
    first = next((line for line in text if line.strip("\ufeff\r\n")), None)
    if first is None:
        return [], iter(())
    first = first.removeprefix("\ufeff")
    bare = re.sub(_QUOTED, "", first)
    known = DELIMITERS if any(d in bare for d in DELIMITERS) else (*RARE_DELIMITERS, DELIMITERS[0])
    sep = max(known, key=lambda d: (bare.count(d), -known.index(d) if any(k in bare for k in known) else d == DELIMITERS[0]))
    csv.field_size_limit(sys.maxsize)
    reader = csv.reader(itertools.chain([first], text), delimiter=sep)
    return _unique_names(next(reader)), reader


def _row_batches(reader, width: int) -> Iterator[list[list[str]]]:
    """Rows that are neither blank nor too long, in batches bounded by rows and by text."""
    rows: list[list[str]] = []
    chars = 0
    for fields in reader:
        blank = not fields or (len(fields) == 1 and not fields[0].strip())
        if blank or len(fields) > width:
            continue
        rows.append(fields)
        chars += sum(map(len, fields))
        if len(rows) == _BATCH_ROWS or chars > _BATCH_CHARS:
            yield rows
            rows, chars = [], 0
    if rows:
        yield rows


def _encoding_of(stream) -> str:
    """Encoding of all of a stream; it is read through once, a piece at a time."""
    head = stream.read(1 << 16)
    if head[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return UTF16
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        while head:
            decoder.decode(head)
            head = stream.read(1 << 16)
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return LATIN1
    return UTF8
