import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import catalogue, columns, quality, rows
from millrace.schemas import CANONICAL

SCHEMA = "title string, price double, availability string, rating double, source string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def three(spark):
    web = spark.createDataFrame([("A", 5.0, " In stock ", 4.0, " Web ")], SCHEMA)
    files = spark.createDataFrame([("B", "x", "csv")], "title string, extra string, source string")
    sql = spark.createDataFrame([("C", None, "sql")], "title string, price double, source string")
    return [web, files, sql]


def test_union_keeps_order_and_fills_missing_columns(three):
    got = rows.union_sources(three)
    assert got.columns == ["title", "price", "availability", "rating", "source", "extra"]
    assert got.count() == 3
    assert {r["title"]: r["extra"] for r in got.collect()} == {"A": None, "B": "x", "C": None}


def test_union_of_one_and_of_none(three):
    assert rows.union_sources(three[:1]).collect() == three[0].collect()
    with pytest.raises(ValueError, match="vide"):
        rows.union_sources([])
    with pytest.raises(ValueError, match="vide"):
        catalogue.transform([])


def test_union_widens_int_to_double(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(1.5,)], "x double")
    assert rows.union_sources([a, b]).dtypes == [("x", "double")]


def test_union_of_text_and_numbers(spark, three):
    text = spark.createDataFrame(
        [("D", "bad", "x", "9", "csv"), ("E", "20", None, "no", "csv"), ("F", None, "x", "3.5", "csv")],
        "title string, price string, availability string, rating string, source string",
    )
    assert dict(rows.union_sources([three[0], text]).dtypes)["price"] == "string"
    got = {r.title: (r.price, r.price_category, r.rating_label) for r in catalogue.transform([three[0], text]).collect()}
    assert got == {
        "A": (5.0, "low", "excellent"), "D": (None, "premium", "excellent"), "E": (20.0, "medium", "poor"),
        "F": (0.0, "low", "good"),
    }


def test_dedup_agrees_with_brute_force(spark):
    import random

    pick = random.Random(5)
    data = [
        (pick.choice(["a", " a", "A", None, ""]), pick.choice([1.0, 2.0, None]), pick.choice(["x", "y", None]), None,
         pick.choice(["web", "csv", None]))
        for _ in range(3000)
    ]
    want = {}
    for row in data:
        order = tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in row[1:4])
        key = (row[0], row[4])
        if key not in want or order < want[key][0]:
            want[key] = (order, row)
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    assert sorted(map(str, (tuple(r) for r in rows.dedup(df).collect()))) == sorted(str(r) for _, r in want.values())


def test_dedup_keeps_the_smallest_row(spark):
    df = spark.createDataFrame(
        [
            ("A", 2.0, "x", 1.0, "web"), ("A", 1.0, "y", 1.0, "web"), ("A", 1.0, "y", 1.0, "web"),
            ("a", 9.0, None, None, "web"), ("A", None, "z", 1.0, "csv"), ("A", 0.0, "z", 1.0, "csv"),
            (None, math.nan, "n", 1.0, None), (None, 3.0, "n", 1.0, None),
        ],
        SCHEMA,
    )
    got = {(r.title, r.source): (r.price, r.availability) for r in rows.dedup(df).repartition(3).collect()}
    assert got == {
        ("A", "web"): (1.0, "y"), ("a", "web"): (9.0, None), ("A", "csv"): (None, "z"), (None, None): (3.0, "n"),
    }
    assert rows.dedup(df).columns == df.columns
    assert rows.dedup_any(df).count() == 4


def test_dedup_of_keys_only_and_of_maps(spark):
    assert rows.dedup(spark.createDataFrame([("a",), ("a",)], "k string"), ["k"]).count() == 1
    df = spark.createDataFrame([("a", {"x": 2, "b": 1}), ("a", {"x": 1})], "k string, m map<string,int>")
    assert [r.m for r in rows.dedup(df, ["k"]).collect()] == [{"x": 2, "b": 1}]


def test_dedup_by_normalized_keys(spark):
    df = spark.createDataFrame([(" A", 1.0, "x", 1.0, "Web"), ("A", 0.5, "x", 1.0, "web"), ("B", 1.0, "x", 1.0, "web")], SCHEMA)
    got = rows.dedup(df, ["title", "source"], {"title": F.trim("title"), "source": F.lower("source")})
    assert sorted((r.title, r.source, r.price) for r in got.collect()) == [(" A", "Web", 1.0), ("B", "web", 1.0)]


def test_dedup_folds_a_hot_key_before_the_shuffle(spark):
    df = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("title"),
        F.col("id").cast("double").alias("price"),
    )
    got = rows.dedup(df, ["title"])
    got.collect()
    text = plan(got)
    assert text.index("partial_min") > text.index("hashpartitioning")
    assert got.where("title = 'hot'").head().price == 1.0


def test_clean(spark):
    df = spark.createDataFrame(
        [
            ("A", None, None, 1.0, "web"), ("B", math.nan, "  x ", 1.0, "web"), (None, 1.0, "x", 1.0, "web"),
            ("", 1.0, "x", 1.0, "web"), (" A", 1.0, "x", 1.0, "web"),
        ],
        SCHEMA,
    )
    got = {r.title: (r.price, r.availability) for r in catalogue.clean(df).collect()}
    assert got == {"A": (0.0, "Unknown"), "B": (0.0, "x"), "": (1.0, "x"), " A": (1.0, "x")}
    assert catalogue.clean(df, blank_is_missing=True).count() == 3
    # among " A" and "A" the smallest original key survives
    folded = catalogue.clean(df, normalize_keys=True).where("trim(title) = 'A'").collect()
    assert [(r.title, r.price) for r in folded] == [(" A", 1.0)]
    kept = {r.title: r.price for r in catalogue.clean(df, missing="keep").collect()}
    assert math.isnan(kept["B"]) and kept["A"] == 0.0


def test_text_prices(spark):
    df = spark.createDataFrame(
        [("A", "10.5", "x", "web"), ("B", "bad", "x", "web"), ("C", None, "x", "web"), ("D", "1.5d", "x", "web")],
        "title string, price string, availability string, source string",
    )
    assert dict(catalogue.normalize(df).dtypes)["price"] == "double"
    got = {r.title: (r.price, r.price_category) for r in catalogue.transform([df]).collect()}
    # an unreadable price has missed its default and falls through to the last class
    assert got == {"A": (10.5, "medium"), "B": (None, "premium"), "C": (0.0, "low"), "D": (None, "premium")}


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([("A", "web")], "title string, source string")
    with pytest.raises(ValueError, match="availability"):
        catalogue.clean(df)
    assert catalogue.transform([columns.conform(df)]).count() == 1


def test_normalize_stamps_the_run(spark, three):
    got = catalogue.normalize(three[0], datetime(2026, 1, 2, 3)).head()
    assert (got.source, got.availability, got.pipeline_version) == ("web", "In stock", "1.0.0")
    stamped = catalogue.normalize(three[0], datetime(2026, 1, 2, 3)).select(F.date_format("processed_at", "yyyy-MM-dd HH"))
    assert stamped.head()[0] == "2026-01-02 03"
    assert catalogue.normalize(three[0]).schema["processed_at"].dataType.simpleString() == "timestamp"


def test_enrich_only_where_the_column_is(spark):
    df = spark.createDataFrame([(5.0,), (100.0,)], "price double")
    assert catalogue.enrich(df).columns == ["price", "price_category"]
    assert [r.price_category for r in catalogue.enrich(df).collect()] == ["low", "premium"]


def test_transform_is_idempotent_on_normalized_keys(spark, three):
    once = catalogue.transform([columns.conform(t) for t in three], datetime(2026, 1, 1), normalize_keys=True)
    again = catalogue.transform([once], datetime(2026, 1, 1), normalize_keys=True)
    assert sorted(again.collect()) == sorted(once.collect())


def test_transform_has_one_shuffle_and_no_python(spark, three):
    df = catalogue.transform([columns.conform(t) for t in three])
    text = plan(df)
    assert text.count("Exchange") == 1
    assert "Python" not in text and "Pandas" not in text


def test_conform(spark):
    df = spark.createDataFrame([(1, "x", None, "2,5")], "title int, extra string, source string, rating string")
    got = columns.conform(df)
    assert got.schema.fieldNames() == CANONICAL.fieldNames()
    assert [f.dataType for f in got.schema] == [f.dataType for f in CANONICAL]
    assert got.collect() == [("1", "", None, None, "unknown")]
    # an absent column is blank, the default is for what is missing in one that is there
    assert columns.conform(df.drop("source")).collect() == [("1", "", None, None, "")]
    assert math.isnan(columns.conform(df, missing="keep").head().price)


def test_coerce_and_fill_leaves_other_columns(spark):
    df = spark.createDataFrame([(None, "x", "5")], "title string, extra string, price string")
    got = columns.coerce_and_fill(df)
    assert got.columns == ["title", "extra", "price"]
    assert got.collect() == [("", "x", 5.0)]


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Book-Title` int, `a.b` int")
    assert columns.normalize_names(df).columns == ["book_title", "a.b"]
    assert columns.rename(df, {"Book-Title": "title", "none": "x"}).columns == ["title", "a.b"]
    assert columns.fill_text(df, {"a.b": "x"}).head()["a.b"] == "2"


def test_tag_source(spark):
    df = spark.createDataFrame([("x",)], "source string")
    assert columns.tag_source(df, "csv").head().source == "csv"
    assert columns.tag_source(df, "csv", only_if_absent=True).head().source == "x"


def test_rows_per_source(spark):
    df = spark.createDataFrame([("web",), ("web",), (None,)], "source string")
    got = {(r.source, r.is_total): r.n_rows for r in rows.rows_per_source(df).collect()}
    assert got == {("web", 0): 2, (None, 0): 1, (None, 1): 3}


def test_limits_and_preview(spark):
    df = spark.createDataFrame([(i, "x" * 50 + str(i)) for i in range(20)], "k int, t string")
    assert [r.k for r in rows.first_rows(df, 3, F.desc("k")).collect()] == [19, 18, 17]
    assert "TakeOrderedAndProject" in plan(rows.first_rows(df, 3, "k"))
    assert rows.first_rows(df, 7).count() == 7
    shown = rows.preview(df, ["t"], 1, "k", width=10).head().t
    assert shown == "xxxxxxx..."


def test_all_rows(spark):
    df = spark.createDataFrame([(1,), (5,)], "r int")
    assert rows.all_rows(df, F.col("r").between(1, 5), "ok").head().ok is True
    assert rows.all_rows(df, F.col("r") > 1, "ok").head().ok is False
    assert rows.all_rows(df.where("false"), F.col("r") > 1, "ok").head().ok is True


def test_quality_report(spark):
    df = spark.createDataFrame(
        [("Atlas", 1, "1.5", "web"), ("", 6, "bad", "web"), (None, None, None, "ftp"), ("Atlas", 5, "2", None)],
        "title string, rating int, raw string, source string",
    )
    rules = [
        quality.required("title"), quality.required("isbn"), quality.numeric("raw"), quality.unique("title"),
        quality.unique("title", "source"), quality.domain("source", ["web", "csv", "sql"]),
        quality.in_range("rating", 1, 5), quality.not_blank("title"), quality.above("rating", 0),
    ]
    got = {r.rule: (r.checked, r.failed, r.passed) for r in quality.quality_report(df, rules).collect()}
    assert got == {
        "required:title": (4, 0, True), "required:isbn": (4, 4, False), "numeric:raw": (4, 1, False),
        "unique:title": (4, 1, False), "unique:title,source": (4, 0, True), "domain:source": (4, 2, False),
        "range:rating": (4, 2, False), "not_blank:title": (4, 2, False), "above:rating": (4, 1, False),
    }
    with pytest.raises(ValueError):
        quality.quality_report(df, [])


def test_quality_report_copies_no_rows(spark, tmp_path):
    spark.range(10).selectExpr("id", "cast(id as string) t").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    report = quality.quality_report(df, [quality.unique("t"), quality.not_blank("t"), quality.in_range("id", 0, 9)])
    # one scan for the plain rules, one for the key; "Expand" would copy every row for every key
    assert plan(report).count("FileScan") == 2 and "Expand" not in plan(report)
    two = quality.quality_report(df, [quality.unique("t"), quality.unique("t", "id")])
    assert "Expand" not in plan(two)


def test_above_fails_nan_like_ranges(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    report = quality.quality_report(df, [quality.above("x", 0), quality.in_range("x", 0, 9)])
    assert [r.failed for r in report.collect()] == [2, 2]


def test_null_filter_reaches_the_scan(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as string) title", "id").write.parquet(str(tmp_path / "t"))
    pushed = plan(rows.drop_null(spark.read.parquet(str(tmp_path / "t"))))
    assert "PushedFilters: [IsNotNull(title)]" in pushed
