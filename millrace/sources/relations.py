"""SQL relations, JSON documents and rows in memory."""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions.text import person_message
from millrace.operators.columns import quoted, tag_source
from millrace.schemas import FALLBACK_PEOPLE, FALLBACK_PEOPLE_NUMBER, GREETING, PEOPLE_DOCUMENT


def read_sql(spark: SparkSession, query: str, source: str | None = "sql", **tables: DataFrame) -> DataFrame:
    """A query over registered views, or over tables given by name as ``{name}`` in the text."""
    result = spark.sql(query, **tables)
    return result if source is None else tag_source(result, source)


def jdbc_options(
    url: str,
    query: str | None = None,
    table: str | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    ssl: bool = True,
) -> dict[str, str]:
    """Options of a JDBC read, from a URL of the usual ``dialect+driver://user:password@host/db`` kind.

    With a partition column, bounds and a number of partitions the relation is read by that many
    tasks; a query is then wrapped as a derived table, since Spark splits tables only.
    """
    if (query is None) == (table is None):
        raise ValueError("give either a query or a table")
    split = (partition_column, bounds, num_partitions)
    if any(x is not None for x in split) and any(x is None for x in split):
        raise ValueError("a parallel read needs partition_column, bounds and num_partitions")
    options = {"fetchsize": str(fetch_size)}
    if url.startswith("jdbc:"):
        options["url"] = url
    else:
        parts = urlsplit(url)
        dialect = parts.scheme.split("+", 1)[0]
        port = f":{parts.port}" if parts.port else ""
        options["url"] = f"jdbc:{dialect}://{parts.hostname or ''}{port}{parts.path}"
        if parts.query:
            options["url"] += f"?{parts.query}"
        if parts.username:
            options["user"] = unquote(parts.username)
        if parts.password:
            options["password"] = unquote(parts.password)
        if ssl and dialect == "postgresql":
            options["sslmode"] = "require"
    if partition_column is None:
        options["query" if query is not None else "dbtable"] = query or table
    else:
        options["dbtable"] = f"({query}) AS q" if query is not None else table
        options["partitionColumn"] = partition_column
        options["lowerBound"], options["upperBound"] = (str(b) for b in bounds)
        options["numPartitions"] = str(num_partitions)
    return options


def read_jdbc(spark: SparkSession, url: str, source: str | None = "sql", **options) -> DataFrame:
    """A relation of another database; filters and columns are pushed down to it."""
    result = spark.read.format("jdbc").options(**jdbc_options(url, **options)).load()
    return result if source is None else tag_source(result, source)


def from_rows(spark: SparkSession, rows, schema: T.StructType | str) -> DataFrame:
    """Rows or a pandas table in memory, with a stated schema: a column of nothing but missing
    values has no type to infer."""
    return spark.createDataFrame(rows, schema)


def people_documents(documents: DataFrame, column: str = "json") -> DataFrame:
    """Read ``number`` and ``people`` of JSON documents. A document that cannot be read, or lacks
    either part, gets the stand-in list, and says so in ``is_fallback``."""
    parsed = F.from_json(quoted(column), PEOPLE_DOCUMENT, {"mode": "PERMISSIVE"})
    read = documents.withColumn("_doc", parsed)
    whole = F.col("_doc.number").isNotNull() & F.col("_doc.people").isNotNull()
    stand_in = F.array(
        *[F.struct(F.lit(craft).alias("craft"), F.lit(name).alias("name")) for craft, name in FALLBACK_PEOPLE]
    )
    return read.withColumns(
        {
            "number": F.when(whole, F.col("_doc.number")).otherwise(F.lit(FALLBACK_PEOPLE_NUMBER)),
            "people": F.when(whole, F.col("_doc.people")).otherwise(stand_in),
            "is_fallback": ~F.coalesce(whole, F.lit(False)),
        }
    ).drop("_doc")


def each_person(documents: DataFrame) -> DataFrame:
    """One row per person of each document."""
    others = [quoted(c) for c in documents.columns if c != "people"]
    return documents.select(*others, F.inline("people"))


def person_messages(people: DataFrame, greeting: str = GREETING, name: str = "message") -> DataFrame:
    return people.withColumn(name, person_message(F.col("name"), F.col("craft"), greeting))
