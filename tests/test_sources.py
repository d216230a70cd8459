import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import delimited, pages, probe, relations

PAGE = """<html><body>
<script>var x = '<article class="product_pod"><h3><a title="js"></a></h3></article>';</script>
<article class="product_pod">
    <p class="star-rating Four"></p>
    <h3><a title="The Salt Road">The Salt ...</a></h3>
    <p class="price_color">£7.25</p><p class="instock availability"> In stock </p>
</article>
<!-- <article class="product_pod"><h3><a title="hidden"></a></h3></article> -->
<article class='big product_pod'>
    <p class="Two star-rating"></p>
    <h3><a href="x" title="Tom &amp; &quot;Jerry&quot;">T</a></h3>
    <div class="price_color">Â£51.77</div><p class="availability"><i class="ok"></i>\n Out\n</p>
</article>
<article class="product_pod"><h3><a>no title</a></h3><p class="price_color">1</p><p class="availability">x</p><p class="star-rating One"></p></article>
<article class="product_pod"><h3><a title="no price">x</a></h3><p class="availability">x</p><p class="star-rating One"></p></article>
<article class="product_pod"><h3><a title="bad price">x</a></h3><p class="price_color">free</p><p class="availability">x</p><p class="star-rating One"></p></article>
<article class="product_pod"><h3><a title="no stock">x</a></h3><p class="price_color">1</p><p class="star-rating One"></p></article>
<article class="product_pod"><h3><a title="one class">x</a></h3><p class="price_color">1</p><p class="availability">x</p><p class="star-rating"></p></article>
<article class="product_pod"><h3><a title="odd word">x</a></h3><p class="price_color">1</p><p class="availability">x</p><p class="star-rating Ten"></p></article>
<article class="other"><h3><a title="other">x</a></h3></article>
<ul><li class="previous"><a href="p0.html">p</a></li><li class="next"><a href="p2.html?a=1&amp;b=2">n</a></li></ul>
</body></html>"""


@pytest.fixture
def stored(spark):
    return spark.createDataFrame([("u1", PAGE), ("u2", "<html>nothing</html>"), ("u3", None)], "url string, html string")


def test_product_records(stored):
    got = pages.product_records(stored, keep=["url"])
    assert got.columns == ["url", "title", "price", "availability", "rating", "source"]
    assert sorted(tuple(r) for r in got.collect()) == [
        ("u1", "The Salt Road", 7.25, "In stock", 4, "web"),
        ("u1", 'Tom & "Jerry"', 51.77, "Out", 0, "web"),
        ("u1", "odd word", 1.0, "x", 0, "web"),
    ]


def test_rejected_products_say_why(stored):
    got = pages.rejected_products(stored).collect()
    assert sorted(r.reason for r in got) == ["availability", "price", "price", "rating", "title"]


def test_kept_columns_must_not_clash(stored):
    with pytest.raises(ValueError, match="title"):
        pages.product_records(stored.withColumnRenamed("url", "title"), keep=["title"])


def test_parsing_is_not_repeated_by_filters(stored):
    plan = pages.product_records(stored).where("title is not null")._jdf.queryExecution().executedPlan().toString()
    assert sum("price_color" in line for line in plan.splitlines()) == 1


def test_next_url(stored):
    got = {r.url: r.next_url for r in pages.with_next_url(stored, "http://x/c/").collect()}
    assert got == {"u1": "http://x/c/p2.html?a=1&b=2", "u2": None, "u3": None}


def test_walk_pages(spark):
    links = spark.createDataFrame(
        [("a1", "a2"), ("a2", "a3"), ("a2", "a3"), ("a3", None), ("b1", "gone"), ("c1", "c1"), (None, "a1")],
        "url string, next_url string",
    )
    starts = spark.createDataFrame([("a1",), ("b1",), ("c1",), ("none",), ("a1",)], "url string")
    got = sorted(tuple(r) for r in pages.walk_pages(links, starts, 4).collect())
    assert got == [
        ("a1", 1, "a1"), ("a1", 2, "a2"), ("a1", 3, "a3"), ("b1", 1, "b1"),
        ("c1", 1, "c1"), ("c1", 2, "c1"), ("c1", 3, "c1"), ("c1", 4, "c1"),
    ]
    assert pages.walk_pages(links, starts, 1).count() == 3
    with pytest.raises(ValueError):
        pages.walk_pages(links, starts, 0)


def test_walks_that_share_a_link_are_split(spark):
    n = 60_000
    following = {i: 7 if i % 3 == 0 else None if i % 11 == 0 else i + 1 for i in range(n)}
    want = 0
    for at in range(n):
        for _ in range(4):
            if at is None or at >= n:
                break
            want, at = want + 1, following[at]
    next_id = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 != 0, F.col("id") + 1)
    page = F.lit("http://site/page/")
    links = spark.range(0, n, 1, 4).select(
        F.concat(page, F.col("id").cast("string")).alias("url"), F.concat(page, next_id.cast("string")).alias("next_url")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert pages.walk_pages(links, links, 4).count() == want
        edges = pages.link_edges(links, "url", "next_url")
        second = pages.follow(links.select(F.col("url").alias("start_url"), F.col("next_url").alias("_goal")), edges)
        second.collect()
        assert "skew=true" in second._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_file_format(values):
    items = [b"PK\x03\x04", b"\xef\xbb\xbfa,b", b"sep=;", b"\xff\xfea", b"\xfe\xffa", b" <!DOCTYPE html>", b"x<HTML>", b"\x1f\x8b\x08", b"a,b", b""]
    assert values(probe.file_format, items, "binary") == [
        "zip", "utf8_bom", "utf8_bom", "utf16", "utf16", "html", "html", "gzip", "unknown", "unknown",
    ]


def test_file_encoding(values):
    two, three, four = "é".encode(), "€".encode(), "😀".encode()
    pad = b"a" * 8191
    items = [b"abc", "café".encode(), b"caf\xe9", b"\xef\xbb\xbfa", b"", pad + two, pad + three, pad + four, b"a" * 8190 + four,
             b"a" * 8189 + four, pad + b"\xff" + b"a", pad + b"a" + b"\xe9", b"caf\xc3"]
    assert values(probe.file_encoding, items, "binary") == [
        "UTF-8", "UTF-8", "ISO-8859-1", "UTF-8", "UTF-8", "UTF-8", "UTF-8", "UTF-8", "UTF-8", "UTF-8", "ISO-8859-1", "ISO-8859-1",
        "ISO-8859-1",
    ]


def test_header_delimiter(values):
    items = ["a,b", "a;b,c;d", "a\tb", "a|b|c", "abc", '"a,b,c";d', "", None]
    assert values(probe.header_delimiter, items)[:7] == [",", ";", "\t", "|", ",", ";", ","]


def test_bad_rows(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a,b,c\n1,2,3\n4,5,6,7\n8,9\n\n10,11,12,\n13,14,15,,\n"x,""y",NA,\n16,,\n17,"p,q",r,s\n')
    got = delimited.read_csv(spark, str(tmp_path), ["a", "b", "c"])
    assert sorted(tuple(r) for r in got.collect()) == [
        ("1", "2", "3", "csv"), ("16", None, None, "csv"), ("8", "9", None, "csv"), ('x,"y', None, None, "csv"),
    ]
    assert got.count() == 4
    assert sorted(r.b or "" for r in got.select("b").collect()) == ["", "", "2", "9"]


def test_bad_rows_with_line_breaks(spark, tmp_path):
    (tmp_path / "bad.csv").write_text('a;b\n"1\n2";x\n3;4;5\n6\n7" disk;8" y\n9" d;8" y;z\n')
    got = delimited.read_csv_auto(spark, str(tmp_path))
    assert {(r.a, r.b) for r in got.collect()} == {("1\n2", "x"), ("6", None), ('7" disk', '8" y')}
    assert got.count() == 3
    assert got.select("b").where("b is null").count() == 1


def test_csv_agrees_with_pandas(spark, tmp_path):
    import random

    import pandas as pd

    pick = random.Random(7)
    cells = ["1", "a", "", "NA", '"q"', '"a,b"', '"x""y"', " s ", '"l\nm"', '7" d', "-", "nan", "null", "é", '""']
    for case in range(12):
        sep = pick.choice(",;\t|")
        lines = [sep.join(("h1", "h2", "h3")), sep.join(("1", "2", "3"))]
        for _ in range(30):
            width = pick.choice((1, 2, 3, 3, 3, 4, 5))
            lines.append(sep.join(pick.choice(cells).replace(",", sep) for _ in range(width)))
        text = "\n".join(lines) + "\n"
        folder = tmp_path / str(case)
        folder.mkdir()
        (folder / "f.csv").write_bytes(text.encode())
        want = pd.read_csv(io.StringIO(text), sep=sep, engine="python", on_bad_lines="skip", dtype=str)
        want = sorted(tuple("~" if pd.isna(v) else v for v in r) for r in want.itertuples(index=False))
        got = delimited.read_csv_auto(spark, str(folder)).drop("source").na.fill("~").collect()
        assert sorted(tuple(r) for r in got) == want


def test_one_column_file(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a\n1\n""\n\n2,3\n" "\nNA\n')
    assert sorted(str(r.a) for r in delimited.read_csv_auto(spark, str(tmp_path)).collect()) == ["1", "None"]


def test_read_csv_auto_mixes_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "one.csv").write_bytes("title,price\nCafé,12.5\n".encode())
    (tmp_path / "two.csv").write_bytes("price;title\n1;Caf\xe9\n2;caf\xe9,x\n".encode("latin-1"))
    (tmp_path / "deep" / "three file.csv").write_bytes(b'\xef\xbb\xbftitle\tisbn\n"two\nlines"\t7\n')
    (tmp_path / "bad bytes.csv").write_bytes(b"title,price\n" + b"x" * 9000 + b",1\ncaf\xe9,2\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    got = delimited.read_csv_auto(spark, str(tmp_path))
    assert set(got.columns) == {"title", "price", "isbn", "source"}
    rows = {(r.title, r.price, r.isbn, r.source) for r in got.where("length(title) < 100").collect()}
    assert rows == {
        ("Café", "12.5", None, "csv"), ("Café", "1", None, "csv"), ("café,x", "2", None, "csv"),
        ("two\nlines", None, "7", "csv"), ("café", "2", None, "csv"),
    }
    assert got.count() == 6


def test_large_files_are_probed_by_range(spark, tmp_path, monkeypatch):
    (tmp_path / "a b.csv").write_bytes(b"h" * 70 + b";t\n" + b"1;2\n" * 5000)
    monkeypatch.setattr(probe, "WHOLE_FILE_LIMIT", 1000)
    row = probe.file_heads(spark, str(tmp_path), n=32).head()
    assert row.length > 1000 and 70 < len(row.content) < 200 and b";t\n" in row.content
    assert delimited.read_csv_auto(spark, str(tmp_path)).count() == 5000
    monkeypatch.setattr(probe, "_has_ranged_reads", lambda uri: False)
    assert probe.file_heads(spark, str(tmp_path), n=32).head().content.endswith(b";t")
    assert delimited.read_csv_auto(spark, str(tmp_path)).count() == 5000


def test_no_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    with pytest.raises(FileNotFoundError):
        delimited.read_csv_auto(spark, str(tmp_path))


def test_repeated_header_names():
    assert delimited._unique_names(["a", "a", "", "a.1", "a"]) == ["a", "a.1", "Unnamed: 2", "a.1.1", "a.2"]


def archive(**members) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, body in members.items():
            z.writestr(name.replace("__", "."), body)
    return buffer.getvalue()


def test_zip_csv(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(archive(readme__txt="no", B__CSV='title,price\nAtlas,8.75\n"x, ""y"",\nz",1\nlong,1,2\nshort\n', c__csv="title\nno\n"))
    (tmp_path / "b.zip").write_bytes(archive(data__tsv="price\ttitle\n3\tonly member\n"))
    (tmp_path / "c.bin").write_bytes(archive(d__csv="title;price\ncaf\xe9;4\n".encode("latin-1")))
    (tmp_path / "d.csv").write_text("title,price\nno,1\n")
    (tmp_path / "e.zip").write_bytes(archive())
    got = delimited.read_zip_csv(spark, str(tmp_path), ["title", "price", "isbn"])
    assert {tuple(r) for r in got.collect()} == {
        ("Atlas", "8.75", None, "csv"), ('x, "y",\nz', "1", None, "csv"), ("short", None, None, "csv"),
        ("only member", "3", None, "csv"), ("café", "4", None, "csv"),
    }


def test_read_csv_auto_opens_archives(spark, tmp_path):
    (tmp_path / "a.csv").write_text("title,price\nA,1\n")
    (tmp_path / "b.bin").write_bytes(archive(b__csv="title;isbn\nB;2\n"))
    (tmp_path / "c.zip").write_bytes(archive(c__csv="isbn,price\n3,4\n"))
    got = delimited.read_csv_auto(spark, str(tmp_path))
    assert set(got.columns) == {"title", "price", "isbn", "source"}
    assert {(r.title, r.price, r.isbn) for r in got.collect()} == {("A", "1", None), ("B", None, "2"), (None, "4", "3")}
    only = delimited.read_csv_auto(spark, str(tmp_path), "*.zip")
    assert [tuple(r) for r in only.collect()] == [("3", "4", "csv")]


def test_zip_member_with_long_fields_and_quoted_header(spark):
    body = '\ufeff"a,b;c",t\n' + "x" * 200_000 + ",1\n \n"
    df = spark.createDataFrame([("p", bytearray(archive(x__csv=body)))], "path string, content binary")
    got = delimited.read_archives(df, ["a,b;c", "t"])
    assert [(len(r[0]), r.t) for r in got.collect()] == [(200_000, "1")]


def test_zip_batches(spark):
    body = "n\n" + "\n".join(str(i) for i in range(25_000))
    df = spark.createDataFrame([("p", bytearray(archive(x__csv=body)))], "path string, content binary")
    got = delimited.read_archives(df, ["n"])
    assert got.agg(F.count("n"), F.sum(F.col("n").cast("long"))).head() == (25_000, sum(range(25_000)))


def test_read_sql(spark):
    customers = spark.createDataFrame([(1, "a@x"), (2, "b@x")], "id int, email string")
    got = relations.read_sql(spark, "SELECT id, email FROM {customers} WHERE id > 1", customers=customers)
    assert [tuple(r) for r in got.collect()] == [(2, "b@x", "sql")]
    customers.createOrReplaceTempView("customers")
    assert relations.read_sql(spark, "SELECT count(*) AS total FROM customers").collect() == [(2, "sql")]


def test_inline_values(spark):
    query = """SELECT first_name AS title, country AS availability, age::double AS price, 0 AS rating, 'sql' AS source
               FROM VALUES ('Ada', 'UK', 28), ('Bo', 'SE', 32) AS customers(first_name, country, age)"""
    got = relations.read_sql(spark, query)
    assert sorted(tuple(r) for r in got.collect()) == [("Ada", "UK", 28.0, 0, "sql"), ("Bo", "SE", 32.0, 0, "sql")]


def test_jdbc_options():
    options = relations.jdbc_options("postgresql+psycopg2://u:p%40ss@h:5432/db", query="SELECT 1")
    assert options == {
        "url": "jdbc:postgresql://h:5432/db", "user": "u", "password": "p@ss", "sslmode": "require",
        "query": "SELECT 1", "fetchsize": "10000",
    }
    split = relations.jdbc_options("jdbc:x:y", query="SELECT id FROM t", partition_column="id", bounds=(1, 9), num_partitions=4)
    assert split["dbtable"] == "(SELECT id FROM t) AS q" and "query" not in split
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "9", "4")
    with pytest.raises(ValueError):
        relations.jdbc_options("jdbc:x:y", query="q", table="t")
    with pytest.raises(ValueError):
        relations.jdbc_options("jdbc:x:y", table="t", partition_column="id")


def test_people_documents(spark):
    docs = spark.createDataFrame(
        [
            (1, '{"number": 2, "people": [{"craft": "ISS", "name": "A"}, {"name": "B", "craft": "T"}], "message": "success"}'),
            (2, "not json"), (3, '{"number": 1}'), (4, None), (5, '{"number": 0, "people": []}'),
        ],
        "id int, json string",
    )
    read = relations.people_documents(docs).orderBy("id").collect()
    assert [(r.id, r.number, len(r.people), r.is_fallback) for r in read] == [
        (1, 2, 2, False), (2, 12, 12, True), (3, 12, 12, True), (4, 12, 12, True), (5, 0, 0, False),
    ]
    people = relations.each_person(relations.people_documents(docs.where("id = 1")).drop("json"))
    got = [r.message for r in relations.person_messages(people).orderBy("name").collect()]
    assert got == [
        "A is currently in space flying on the ISS! Hello! :)", "B is currently in space flying on the T! Hello! :)",
    ]


def test_from_rows_needs_no_inference(spark):
    import pandas as pd

    df = relations.from_rows(spark, pd.DataFrame({"title": ["a"], "price": [None]}), "title string, price double")
    assert df.collect() == [("a", None)]


def write_files(root, **files):
    for name, content in files.items():
        (root / name).write_bytes(content)


def values_of(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("rows", [3_000, 200])
def test_latin1_letters_far_behind_are_kept(spark, tmp_path, rows):
    text = "title,price\n" + "".join(f"plain {i},1\n" for i in range(rows)) + "caf\xe9,2\n"
    write_files(tmp_path, **{"a.csv": text.encode("latin-1"), "b.zip": archive(c__csv=text.encode("latin-1"))})
    got = delimited.read_csv_auto(spark, str(tmp_path)).where("price = 2")
    assert values_of(got, "title") == [("café",), ("café",)]


def test_compressed_and_utf16_files(spark, tmp_path):
    import gzip

    text = "title,price\nÉté,1\n"
    write_files(tmp_path, **{"a.csv": text.encode(), "b.csv.gz": gzip.compress(text.encode("latin-1")), "c.csv": text.encode("utf-16"), "d.csv": text.encode("utf-16-le")[:0]})
    got = delimited.read_csv_auto(spark, str(tmp_path))
    assert got.columns == ["title", "price", "source"] and values_of(got, "title", "price") == [("Été", "1")] * 3


@pytest.mark.parametrize("limit", [1024 * 1024, 1000])
def test_long_header_of_a_compressed_file(spark, tmp_path, monkeypatch, limit):
    import gzip

    monkeypatch.setattr(probe, "WHOLE_FILE_LIMIT", limit)
    last = f"z{random.Random(1).randbytes(100_000).hex()}"  # little of it can be packed
    header = f"a,{'b' * 2_000_000},{last}"
    write_files(tmp_path, **{"a.csv.gz": gzip.compress(f"\n{header}\n1,2,3\n".encode()), "b.csv.gz": gzip.compress(b"a,c\n4,5\n")})
    profiled = probe.profile_files(spark, str(tmp_path)).select("header")
    assert sorted(r.header for r in profiled.collect()) == [header, "a,c"]


@pytest.mark.parametrize("content", [b"<!DOCTYPE html><html><body>expired, sorry</body></html>", b"\x7fELF\x00\x01\x02, \x00\n"])
def test_what_is_no_table_is_refused_by_name(spark, tmp_path, content):
    write_files(tmp_path, **{"good.csv": b"a,b\n1,2\n", "odd.csv": content})
    with pytest.raises(ValueError, match="odd.csv"):
        delimited.read_csv_auto(spark, str(tmp_path))


def test_names_are_not_patterns(spark, tmp_path):
    write_files(tmp_path, **{"a[1].csv": b"x,y\n1,2\n", "a1.csv": b"z;x\n9;8\n", "b{2}.csv": b"x,y\n3,4\n", "c*d?.csv": b"x,y\n5,6\n"})
    got = delimited.read_csv_auto(spark, str(tmp_path))
    assert values_of(got.where("y is not null"), "x", "y") == [("1", "2"), ("3", "4"), ("5", "6")]
    assert values_of(got.where("z is not null"), "x", "z") == [("8", "9")]


def test_long_header_behind_blank_lines(spark, tmp_path):
    names = [f"a long column name {i:05d}" for i in range(5_000)]
    write_files(tmp_path, **{"wide.csv": ("\n\n" + ",".join(names) + "\n" + ",".join(["1"] * 5_000) + "\n").encode()})
    heads = probe.file_heads(spark, str(tmp_path), n=1024)
    assert len(heads.first().content) > 100_000
    assert probe.profile_files(spark, str(tmp_path)).first().header == ",".join(names)


def test_stray_quotes_and_open_fields(spark, tmp_path):
    write_files(tmp_path, **{"a.csv": b'a,b\n7" d,"x\ny" z"\n1,2\n', "b.csv": b'a,b\n5" x,6" y\n"q ""r""",s\n'})
    facts = {r.uri.rsplit("/", 1)[1]: r.open_quote for r in probe.line_facts(spark, str(tmp_path)).collect()}
    assert facts == {"a.csv": True, "b.csv": False}
    got = delimited.read_csv_auto(spark, str(tmp_path))
    assert {r.a for r in got.collect()} == {'7" d', "1", '5" x', 'q "r"'}


@pytest.mark.parametrize("header,want", [("title price", " "), ("title:price", ":"), ("my title,my price", ","), ("one", ","), ("a b:c:d", ":")])
def test_rare_delimiters(values, header, want):
    assert values(probe.header_delimiter, [header]) == [want]


def test_walk_to_the_end(spark):
    links = [(f"u{i}", f"u{i + 1}") for i in range(12)] + [("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("s", "s")]
    df = spark.createDataFrame(links, "url string, next_url string")
    starts = spark.createDataFrame([("u3",), ("a",), ("s",), ("none",)], "url string")
    got = values_of(pages.walk_pages(df, starts, None), "start_url", "depth", "url")
    want = [("u3", i - 2, f"u{i}") for i in range(3, 12)] + [("a", 1, "a"), ("a", 2, "b"), ("a", 3, "c"), ("a", 4, "d"), ("s", 1, "s")]
    assert got == sorted(want)
    assert pages.walk_pages(df, starts.limit(0), None).count() == 0


def _walked_by_hand(links, starts, bound=None):
    following = {}
    for at, to in links:
        if at is not None and (at not in following or (to is not None and (following[at] is None or to < following[at]))):
            following[at] = to
    out = []
    for start in set(starts):
        at, seen, depth = start, set(), 1
        while at in following and (depth <= bound if bound else at not in seen):
            seen.add(at)
            out.append((start, depth, at))
            at, depth = following[at], depth + 1
    return sorted(out)


@pytest.mark.parametrize("bound", [None, 3, 9, 40])
def test_walks_over_random_links(spark, bound):
    rng = random.Random(bound)
    names = [f"p{i:03d}" for i in range(90)]
    links = [(n, rng.choice([*names, "gone", None])) for n in names[:70]] + [("p001", "p002"), (None, "p001"), ("p080", "p080")]
    links += [(f"q{i}", f"q{(i + 1) % 17}") for i in range(17)] + [("r", "q5"), ("r2", "r")]
    starts = rng.sample(names, 40) + ["q3", "r2", "q16", "nowhere", "p080", "q3"]
    df = spark.createDataFrame(links, "url string, next_url string")
    begin = spark.createDataFrame([(s,) for s in starts], "url string")
    got = values_of(pages.walk_pages(df, begin, bound), "start_url", "depth", "url")
    assert got == _walked_by_hand(links, starts, bound)


def test_deep_sites_take_few_jobs(spark):
    n = 10_000
    page = F.lit("http://site/")
    links = spark.range(n).select(
        F.concat(page, F.col("id").cast("string")).alias("url"), F.concat(page, (F.col("id") + 1).cast("string")).alias("next_url")
    )
    written = []
    build = pages.materialize
    try:
        pages.materialize = lambda df, name: written.append(name) or build(df, name)
        walked = pages.walk_pages(links, links.where("url IN ('http://site/0', 'http://site/9000')"), None)
        assert walked.agg(F.count("*"), F.max("depth"), F.sum("depth")).first() == (11_000, n, sum(range(1, n + 1)) + sum(range(1, 1_001)))
    finally:
        pages.materialize = build
    assert len(written) < 10


def test_many_layouts_take_one_scan(spark, tmp_path):
    want = set()
    for i in range(1000):
        sep = ",;\t|"[i % 4]
        body = f"id{sep}c{i}{sep}n\n{i}{sep}café{sep}x\n{i}{sep}1{sep}2{sep}long\n{i}{sep}id{sep}\"q{sep}q\"\n"
        (tmp_path / f"{i}.csv").write_bytes(body.encode("latin-1" if i % 3 else "utf-8"))
        want |= {(str(i), "café", "x"), (str(i), "id", f"q{sep}q")}
    got = delimited.read_csv_auto(spark, str(tmp_path))
    assert len(got.columns) == 1003
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") + plan.count("FileScan text") == 1
    rows = got.select("id", F.coalesce(*[f"c{i}" for i in range(1000)]).alias("c"), "n").collect()
    assert len(rows) == 2000 and set(map(tuple, rows)) == want


def test_header_line_may_come_again_as_a_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n\na,_malformed\n1,2\na,_malformed\na,_malformed\n")
    assert sorted(map(tuple, delimited.read_csv_auto(spark, str(tmp_path), source=None).collect())) == [("1", "2"), ("a", "_malformed"), ("a", "_malformed")]
    (tmp_path / "b.csv").write_bytes(b'\n\r\na,_malformed\n"1\n",2\na,_malformed\na,_malformed,x\n')
    assert delimited.read_csv_auto(spark, str(tmp_path), multiline=True).count() == 5
    got = delimited.read_csv(spark, str(tmp_path / "a.csv"), ["a", "_malformed"], source=None)
    assert sorted(map(tuple, got.collect())) == [("1", "2"), ("a", "_malformed"), ("a", "_malformed")]


@pytest.mark.parametrize("seed", range(3))
def test_quoted_line_breaks_are_split(spark, tmp_path, seed):
    import csv

    pick = random.Random(seed)
    cells = ["1", "ab", "", ' "x', 'y" z', '"q"', '"a,b"', '"x""y"', '"l\nm"', '"\n\n"', '"l\r\nm"', '""', '"a"b', '"\n,""\n"', '"' + "long\n" * 60 + '"', "é"]
    end = "\r\n" if seed else "\n"
    lines = ["h1,h2,h3"] + [",".join(pick.choice(cells) for _ in range(3)) for _ in range(1500)]
    if seed == 2:
        lines.append('1,"never closed\n,x')
    text = end.join(lines)
    (tmp_path / "a.csv").write_bytes(text.encode("latin-1" if seed == 1 else "utf-8"))
    (tmp_path / "b.csv").write_text("h1,h2,h3\nno,break,here\n")
    rows = [(*(x or None for x in r), *[None] * (3 - len(r))) for r in list(csv.reader(io.StringIO(text, newline="")))[1:]]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = delimited.read_csv_auto(spark, str(tmp_path), na_values=["?"], source=None)
        found = [tuple(x or None for x in r) for r in got.collect()]
        assert spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(found, key=str) == sorted([*rows, ("no", "break", "here")], key=str)


def test_long_quoted_fields(spark, tmp_path):
    odd = '"' + '""x\n' * 100_000 + '"'
    (tmp_path / "a.csv").write_text(f"a,b\n{odd},1\n\"{'y' * 1_000_000}\",2\n{'z,' * 50_000}\n")
    got = {r.b: r.a for r in delimited.read_csv_auto(spark, str(tmp_path)).collect()}
    assert got == {"1": '"x\n' * 100_000, "2": "y" * 1_000_000}
