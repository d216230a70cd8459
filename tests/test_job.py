from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace import session, sinks
from millrace.plans.job import Job, Source, build, open_sources, run

SCHEMA = "title string, price double, availability string, rating double, source string"


@pytest.fixture
def books(spark):
    return spark.createDataFrame(
        [("A", 5.0, "In stock", 4.0, "web"), ("B", 50.0, None, 1.0, "csv"), ("C", None, "x", 3.0, None)], SCHEMA
    )


def test_write_counts_and_partitions(spark, books, tmp_path):
    path = str(tmp_path / "out")
    receipt = sinks.write_parquet(books, path)
    assert (receipt.path, receipt.rows) == (path, 3)
    back = sinks.read_back(spark, receipt)
    assert sorted(back.select(books.columns).collect(), key=str) == sorted(books.collect(), key=str)
    assert (tmp_path / "out" / "source=__HIVE_DEFAULT_PARTITION__").is_dir()
    web = back.where("source = 'web'")
    assert "PartitionFilters: [isnotnull(source" in web._jdf.queryExecution().executedPlan().toString()


def test_partition_values_stay_text(spark, books, tmp_path):
    receipt = sinks.write_parquet(books.withColumn("source", F.lit("007")), str(tmp_path / "out"))
    assert {r.source for r in sinks.read_back(spark, receipt).collect()} == {"007"}


def test_overwrite_static_and_dynamic(spark, books, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_parquet(books, path)
    again = sinks.write_parquet(books.where("source = 'web'").withColumn("title", F.lit("N")), path, replace="dynamic")
    assert again.rows == 1
    assert {r.title for r in sinks.read_back(spark, again).collect()} == {"N", "B", "C"}
    only = sinks.write_parquet(books.where("source = 'web'"), path, rebalance=True)
    assert only.rows == 1
    assert sinks.read_back(spark, only).count() == 1


def test_rebalance_splits_a_large_partition_and_gathers_small_ones(spark, tmp_path):
    df = spark.range(0, 200_000, 1, 16).selectExpr(
        "cast(id as string) title", "case when id % 3 < 2 then 'web' when id % 100 = 2 then 'csv' else 'sql' end source"
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "200k")
        plain = sinks.write_parquet(df, str(tmp_path / "plain"))
        even = sinks.write_parquet(df, str(tmp_path / "even"), rebalance=True)
    finally:
        spark.conf.set(key, before)
    assert plain.rows == even.rows == 200_000

    def files(receipt):
        return {r.source: r.n_files for r in sinks.inventory(sinks.read_back(spark, receipt)).collect()}

    assert files(plain)["csv"] == 16
    assert files(even)["csv"] == 1 and files(even)["web"] > files(even)["csv"]


def test_writing_nothing(spark, books, tmp_path):
    receipt = sinks.write_parquet(books.where("false"), str(tmp_path / "out"))
    assert receipt.rows == 0
    assert sinks.read_back(spark, receipt).count() == 0
    none = spark.createDataFrame([], SCHEMA)
    assert sinks.write_parquet(none, str(tmp_path / "out"), rebalance=True).rows == 0


def test_write_errors_reach_the_caller(books, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(Exception):
        sinks.write_parquet(books, str(tmp_path / "file" / "out"))


def test_listing_and_inventory(spark, books, tmp_path):
    path = str(tmp_path / "my out")
    receipt = sinks.write_parquet(books, path)
    keys = [r.key for r in sinks.list_objects(spark, path).collect()]
    assert len(keys) == 3 and all(k.startswith("source=") and k.endswith(".parquet") for k in keys)
    assert sinks.list_objects(spark, path, "source=web/").count() == 1
    assert [r.key for r in sinks.list_objects(spark, path, first=2).collect()] == sorted(keys)[:2]
    assert sinks.list_objects(spark, path, "source=w").count() == 1 and sinks.list_objects(spark, path, "none/").count() == 0
    got = {r.source: (r.n_files, r.n_rows) for r in sinks.inventory(sinks.read_back(spark, receipt)).collect()}
    assert got == {"web": (1, 1), "csv": (1, 1), None: (1, 1)}


def test_output_must_exist(spark, books, tmp_path):
    with pytest.raises(ValueError, match="no Parquet file"):
        sinks.require_output(spark, str(tmp_path / "none"))
    sinks.write_parquet(books, str(tmp_path / "out"))
    sinks.require_output(spark, str(tmp_path / "out"))
    with pytest.raises(ValueError):
        sinks.require_output(spark, str(tmp_path / "out"), "source=ftp/")
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError):
        sinks.require_output(spark, str(tmp_path / "empty"))


def test_missing_sources_are_tolerated(spark, books, tmp_path):
    there = Source("web", lambda s: books)
    gone = Source("gone", lambda s: s.read.parquet(str(tmp_path / "none")))
    assert list(open_sources(spark, Job([there, gone], "x"))) == ["web"]
    with pytest.raises(AnalysisException):
        open_sources(spark, Job([there, gone], "x", fail_on_source_error=True))
    with pytest.raises(AnalysisException):
        open_sources(spark, Job([there, Source("gone", gone.read, required=True)], "x"))
    broken = Source("broken", lambda s: books.select("no_such_column"))
    with pytest.raises(AnalysisException):
        open_sources(spark, Job([there, broken], "x"))
    with pytest.raises(ValueError, match="no source"):
        open_sources(spark, Job([gone], "x"))


def test_job(spark, books, tmp_path):
    raw = spark.createDataFrame([("T", "Author", 1999)], "`Book-Title` string, `Book-Author` string, `Year-Of-Publication` int")
    mapping = {"book_title": "title", "book_author": "availability", "year_of_publication": "rating"}
    job = Job([Source("web", lambda s: books), Source("csv", lambda s: raw, mapping)], str(tmp_path))
    receipt = run(spark, job, datetime(2026, 1, 1))
    assert receipt.path == f"{tmp_path}/processed/books" and receipt.rows == 4
    got = {r.title: (r.price_category, r.is_available, r.rating_label, r.source) for r in sinks.read_back(spark, receipt).collect()}
    assert got == {
        "A": ("low", True, "excellent", "web"), "B": ("high", False, "poor", "csv"),
        "C": ("low", False, "good", "unknown"), "T": ("low", False, "excellent", None),  # a blank partition value reads as NULL
    }
    assert build(spark, job)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_a_failed_run_leaves_the_dataset(spark, books, tmp_path):
    job = Job([Source("web", lambda s: books)], str(tmp_path))
    receipt = run(spark, job, datetime(2026, 1, 1))
    before = sorted(sinks.read_back(spark, receipt).collect(), key=str)
    fewer = Job([Source("web", lambda s: books.where("title = 'A'"))], str(tmp_path))

    def refuse(df):
        assert df.count() == 1
        raise ValueError("too few rows")

    with pytest.raises(ValueError, match="too few"):
        run(spark, fewer, check=refuse)
    with pytest.raises(ValueError, match="no Parquet"):
        run(spark, Job([Source("web", lambda s: books.where("false"))], str(tmp_path)))
    broken = Job([Source("web", lambda s: books.withColumn("title", F.raise_error(F.lit("broken"))))], str(tmp_path))
    with pytest.raises(Exception):
        run(spark, broken)
    assert sorted(sinks.read_back(spark, receipt).collect(), key=str) == before
    assert [p.name for p in (tmp_path / "processed").iterdir()] == ["books"]
    assert run(spark, fewer, check=lambda df: None).rows == 1
    assert sinks.read_back(spark, receipt).count() == 1
    assert [p.name for p in (tmp_path / "processed").iterdir()] == ["books"]


def test_publish(spark, books, tmp_path):
    old, new = str(tmp_path / "data"), str(tmp_path / "new")
    kept = sinks.write_parquet(books, old)
    fresh = sinks.write_parquet(books.where("source = 'web'").withColumn("title", F.lit("new")), new)
    got = sinks.publish(spark, fresh, old, replace="dynamic")
    assert got.path == old and got.rows == 1
    titles = {r.source: r.title for r in sinks.read_back(spark, kept).collect()}
    assert titles["web"] == "new" and len(titles) == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["data"]
    with pytest.raises(Exception):
        sinks.publish(spark, sinks.Receipt(str(tmp_path / "gone"), 0, books.schema), old)
    assert sinks.read_back(spark, kept).count() == 3
    fresh = sinks.write_parquet(books.where("source = 'web'"), new)
    sinks.publish(spark, fresh, old)
    assert sinks.read_back(spark, kept).count() == 1


def test_staging_uses_the_shared_folder(spark):
    assert session.staging_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.staging_path(spark, "x") != session.staging_path(spark, "x")
    df = session.materialize(spark.range(5), "numbers")
    assert df.count() == 5 and "FileScan" in df._jdf.queryExecution().executedPlan().toString()
