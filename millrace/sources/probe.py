"""What is in a file: format, delimiter and header from its first bytes, encoding from all of it.

The sniffing itself is column expressions over the head of a file, so a table that already holds
the bytes can use it as well.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UTF8 = "UTF-8"
LATIN1 = "ISO-8859-1"
UTF16 = "UTF-16"
DELIMITERS = (",", ";", "\t", "|")
#: considered only in a header that has none of the others
RARE_DELIMITERS = (" ", ":")
FORMAT_PROBE = 32
HEAD_BYTES = 64 * 1024
#: files above this size are not loaded whole to look at their head
WHOLE_FILE_LIMIT = 1024 * 1024
_GZIP_HEX = "1F8B"

_QUOTED = '"[^"]*+(?:""[^"]*+)*+"'


def magic_hex(content: Column, n: int = 4) -> Column:
    return F.lower(F.hex(F.substring(content, 1, n)))


def file_format(content: Column) -> Column:
    """zip, utf8_bom, utf16, html, gzip or unknown, by the leading bytes."""
    magic = magic_hex(content, 3)
    head = F.lower(F.decode(F.substring(content, 1, FORMAT_PROBE), LATIN1))
    return (
        F.when(magic.startswith("504b"), "zip")
        .when(magic.isin("efbbbf", "736570"), "utf8_bom")
        .when(magic.startswith("fffe") | magic.startswith("feff"), "utf16")
        .when(head.contains("<html") | head.contains("<!doc"), "html")
        .when(magic.startswith("1f8b"), "gzip")
        .otherwise("unknown")
    )


def file_encoding(content: Column) -> Column:
    """UTF-16 by its mark; else UTF-8 when all of the content decodes as such, else Latin-1, which
    takes any byte."""
    return (
        F.when(file_format(content) == "utf16", UTF16)
        .when(F.is_valid_utf8(content.cast("string")), UTF8)
        .otherwise(LATIN1)
    )


def header_line(content: Column, encoding: Column) -> Column:
    """First line of text that is not empty, without a byte-order mark."""
    utf8 = F.make_valid_utf8(content.cast("string"))
    text = F.when(encoding == UTF8, utf8).when(encoding == UTF16, _utf16(content)).otherwise(F.decode(content, LATIN1))
    return F.regexp_extract(text, "^\ufeff?[\r\n]*+([^\r\n]*+)", 1)


def _utf16(content: Column) -> Column:
    """Text of UTF-16 bytes: an odd last byte is half a letter that a cut left over, and so is the last
    letter, which may be half a pair."""
    whole = F.substring(content, F.lit(1), F.greatest(F.octet_length(content).bitwiseAND(F.lit(-2)) - 2, F.lit(0)))
    return F.decode(whole, UTF16)


def header_delimiter(header: Column) -> Column:
    """The candidate found most often outside quotes; the first of ``DELIMITERS`` wins a tie. Blank and
    colon stand in when there is none, then a comma."""
    bare = F.regexp_replace(header, _QUOTED, "")

    def most(candidates: tuple[str, ...]) -> Column:
        counts = [F.length(bare) - F.length(F.replace(bare, F.lit(d), F.lit(""))) for d in candidates]
        ranked = [F.struct(n.alias("n"), F.lit(-i).alias("rank"), F.lit(d).alias("d")) for i, (n, d) in enumerate(zip(counts, candidates))]
        return F.array_max(F.array(*ranked))

    usual, rare = most(DELIMITERS), most(RARE_DELIMITERS)
    return F.when(usual.getField("n") > 0, usual.getField("d")).when(rare.getField("n") > 0, rare.getField("d")).otherwise(DELIMITERS[0])


def as_literal_path(path: str) -> str:
    """A path whose name is taken as it is, although Spark reads paths as patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(path, length, modificationTime)`` of every file below a path. No file is opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def file_heads(spark: SparkSession, path: str, n: int = HEAD_BYTES, glob: str | None = None) -> DataFrame:
    """``(path, uri, length, content)`` with the head of every file: up to the end of its first line that
    is not empty, and at least ``n`` bytes where it has them. ``uri`` is the path as ``_metadata.file_path`` writes it.

    Small files come through Spark's own reader. Of others only the head is fetched, by a ranged read
    inside the task, so neither the size of a file nor of the dataset matters. Where the storage has
    no such reader, Spark's own reads these files whole.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).withColumn("uri", F.col("_metadata.file_path"))
    is_large = F.col("length") > WHOLE_FILE_LIMIT
    large = files.where(is_large).select("path", "uri", "length")
    some_large = large.select("uri").head()
    ranged = some_large is not None and _has_ranged_reads(some_large["uri"])
    # in Latin-1 every byte is a letter, so letters count bytes
    first_line = F.length(F.regexp_extract(F.decode("content", LATIN1), r"^[\r\n]*+[^\r\n]*+", 0))
    whole = (files.where(~is_large) if ranged else files).select(
        "path",
        "uri",
        "length",
        F.when(F.hex(F.substring("content", 1, 2)) == _GZIP_HEX, F.col("content"))
        .otherwise(F.substring(F.col("content"), F.lit(1), F.greatest(F.lit(n), first_line)))
        .alias("content"),
    )
    return whole.unionByName(large.mapInPandas(_range_reader(n), whole.schema)) if ranged else whole


def _has_ranged_reads(uri: str) -> bool:
    try:
        _filesystem(uri)
    except (ImportError, OSError, ValueError, NotImplementedError):
        return False
    return True


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _range_reader(n: int):
    def read(batches):
        for batch in batches:
            heads = []
            for uri in batch["uri"]:
                filesystem, name = _filesystem(uri)
                with filesystem.open_input_stream(name, compression=None) as stream:
                    head = [stream.read(n)]
                    ends = _line_ends(head[0])
                    while not ends(head[-1]):
                        head.append(stream.read(n))
                heads.append(b"".join(head))
            yield batch.assign(content=heads)

    return read


def _line_ends(start: bytes):
    """A function of a file's pieces, in order: has its first line with text ended, or the file? What a gzip file
    packs is looked at, not its own bytes."""
    import zlib

    unpack = zlib.decompressobj(31) if start.startswith(b"\x1f\x8b") else None
    begun = False

    def ends(piece: bytes) -> bool:
        nonlocal begun
        if not piece:
            return True
        if unpack is not None:
            try:
                piece = unpack.decompress(piece)
            except zlib.error:
                return True
        if not begun:
            piece = piece.lstrip(b"\r\n")
            begun = bool(piece)
        return b"\n" in piece or (unpack is not None and unpack.eof)

    return ends


def _unpacked(batches):
    """Heads of compressed files as the heads of what is in them: to the end of the first line with text, and
    16 times a head's size at least."""
    import zlib

    def first_line(packed: bytes) -> bytes | None:
        unpack, pieces, begun = zlib.decompressobj(31), [], False
        while True:
            try:
                piece = unpack.decompress(packed, 16 * HEAD_BYTES)
            except zlib.error:
                return None
            packed = unpack.unconsumed_tail
            pieces.append(piece)
            line = piece if begun else piece.lstrip(b"\r\n")
            begun = begun or bool(line)
            if not piece or b"\n" in line:
                return b"".join(pieces)

    for batch in batches:
        yield batch.assign(content=[first_line(head) for head in batch["content"]])


def line_facts(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``(uri, utf8, open_quote)`` of every file with a line: do all its lines decode as UTF-8, and does
    a quoted field stay open at the end of one?

    A quote opens a field only at its start, whichever of the delimiters parts the fields. The first line
    that leaves one open begins outside quotes, so it is judged rightly; a line taken wrongly for one
    costs splitting, not rows. One scan; files are counted per task before the shuffle.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    line = F.col("value")
    start = "(^\ufeff?|[" + "".join(DELIMITERS + RARE_DELIMITERS) + "])"
    latin = F.decode(line.cast("binary"), LATIN1)
    left_open = F.regexp_replace(latin, start + _QUOTED, "$1").rlike(start + '"')
    return (
        reader.text(path)
        .select(F.col("_metadata.file_path").alias("uri"), F.is_valid_utf8(line).alias("valid"), (line.contains('"') & left_open).alias("left"))
        .groupBy("uri")
        .agg(F.bool_and("valid").alias("utf8"), F.bool_or("left").alias("open_quote"))
    )


def profile_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file: format, encoding, header, delimiter, and whether a quote spans lines.

    ``format`` is what the leading bytes say; ``binary`` if there is a zero byte and no other reason for
    it. A compressed file is judged by what is in it, so is a compressed one's ``inner`` format.
    """
    heads = file_heads(spark, path, glob=glob).withColumn("format", file_format(F.col("content")))
    packed = heads.where(F.col("format") == "gzip").mapInPandas(_unpacked, heads.schema)
    heads = heads.where(F.col("format") != "gzip").unionByName(packed)
    inner = F.when(F.col("format") == "gzip", file_format(F.col("content"))).otherwise(F.col("format"))
    zero = F.instr(F.decode("content", LATIN1), "\0") > 0
    heads = heads.withColumn("inner", F.when(F.col("content").isNull(), "binary").when((inner == "unknown") & zero, "binary").otherwise(inner))
    facts = line_facts(spark, path, glob)
    encoding = F.when(F.col("inner") == "utf16", UTF16).when(F.coalesce("utf8", F.lit(True)), UTF8).otherwise(LATIN1)
    return (
        heads.join(facts, "uri", "left")
        .select("path", "uri", "length", magic_hex(F.col("content")).alias("magic"), "format", "inner", encoding.alias("encoding"), F.coalesce("open_quote", F.lit(False)).alias("open_quote"), "content")
        .withColumn("header", header_line(F.col("content"), F.col("encoding")))
        .withColumn("delimiter", header_delimiter(F.col("header")))
        .drop("content")
    )
