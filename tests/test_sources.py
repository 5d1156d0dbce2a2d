"""File sources and sinks: snapshot CSV folders, page files, log files,
partitioned snapshot writes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscan.operators.report import read_log
from shelfscan.sources.pages import read_page_files
from shelfscan.sources.sinks import write_csv, write_snapshot
from shelfscan.sources.snapshots import read_csv_snapshots, read_name_column

HEADER = "product_id,product_name,product_price,product_image,product_url,product_rating,source,timestamp\n"
DAY1 = HEADER + (
    'agua-1-5-l,Água Mineral 1.5l,"0,35€ / UN",https://img.example/a.jpg,https://shop.example/p/agua-1-5-l/,,r2,20241113_101500\n'
    'vinho,"Vinho ""Reserva"" 0.75l","5,99€ / UN",https://img.example/v.jpg,https://shop.example/p/vinho/,,r2,20241113_101500\n'
    'na,NA,"1,00€ / UN",,,,r2,20241113_101500\n')
DAY2 = HEADER + 'arroz-1kg,Arroz Agulha 1kg,"4,49€ / UN",https://img.example/r.jpg,https://shop.example/p/arroz-1kg/,,r2,20241114_090000\n'


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_csv_snapshot_folders(spark, tmp_path):
    _write(tmp_path / "20241113" / "frescos-embalados.csv", DAY1)
    _write(tmp_path / "20241114" / "frescos-embalados.csv", DAY2)
    # a file is left out only if the caller names it
    _write(tmp_path / "20241113" / "processed_all_products.csv", HEADER + "x,y,z,,,,r2,1\n")
    df = read_csv_snapshots(spark, str(tmp_path), "r2", exclude=["processed_all_products.csv"])
    assert read_csv_snapshots(spark, str(tmp_path), "r2").count() == 5
    rows = sorted(df.collect(), key=lambda r: r.product_id)
    assert len(rows) == 4
    by = {r.product_id: r for r in rows}
    assert by["vinho"].product_name == 'Vinho "Reserva" 0.75l'
    assert by["agua-1-5-l"].product_price == "0,35€ / UN"
    assert by["agua-1-5-l"].product_rating is None          # empty field → NULL
    assert by["na"].product_name == "NA"                    # only the empty field is missing
    assert by["arroz-1kg"].snapshot_date == dt.date(2024, 11, 14)
    assert {r.category for r in rows} == {"frescos-embalados"}
    names = read_name_column(spark, str(tmp_path / "20241114"), "r2").collect()
    assert [r.product_name for r in names] == ["Arroz Agulha 1kg"]


def test_attr_source_file_names(spark, tmp_path):
    hdr = ("product_id,product_name,product_price,product_category,product_category2,"
           "product_category3,product_image,product_urls,product_ratings,product_labels,"
           "product_promotions,source,timestamp\n")
    _write(tmp_path / "20241112" / "limpeza_20241112.csv",
           hdr + "p1,Detergente 3l,4.5,a,b,,img,{},p1,[],,r3,20241112\n")
    r = read_csv_snapshots(spark, str(tmp_path), "r3").first()
    assert (r.category, r.snapshot_date, r.product_price) == ("limpeza", dt.date(2024, 11, 12), 4.5)


def test_snapshot_dynamic_overwrite_and_slash(spark, tmp_path):
    rows = [("1", 1.0, "r2", dt.date(2024, 11, 13), "frescos"),
            ("2", 2.0, "r2", dt.date(2024, 11, 14), "frescos"),
            ("3", 3.0, "r3", dt.date(2024, 11, 13), "saude/acne/")]
    df = spark.createDataFrame(rows, "product_id string, price double, source string, "
                                     "snapshot_date date, category string")
    out = str(tmp_path / "snap")
    write_snapshot(df, out)
    again = spark.createDataFrame([("9", 9.0, "r2", dt.date(2024, 11, 13), "frescos")], df.schema)
    write_snapshot(again, out)
    back = {r.product_id: r for r in spark.read.parquet(out).collect()}
    assert set(back) == {"9", "2", "3"}               # only the touched partition replaced
    assert back["3"].category == "saude/acne/"
    # CSV interchange keeps nested columns as JSON text
    nested = df.select("product_id", F.array(F.struct(F.lit("Bio").alias("alt"))).alias("labels"))
    write_csv(nested, str(tmp_path / "csv"))
    txt = (spark.read.option("header", True).option("escape", "\"")
           .csv(str(tmp_path / "csv")).first().labels)
    assert txt == '[{"alt":"Bio"}]'


def test_page_files(spark, tmp_path):
    _write(tmp_path / "r2" / "20241113" / "frescos" / "1.html", "<html>one</html>")
    _write(tmp_path / "r2" / "20241113" / "frescos" / "2.html", "<html>two</html>")
    df = read_page_files(spark, str(tmp_path / "*" / "*" / "*" / "*.html"), page_size=24)
    got = sorted((r.source, r.category, r.snapshot_date, r.page_no, r.page_start, r.html)
                 for r in df.collect())
    assert got == [("r2", "frescos", dt.date(2024, 11, 13), 1, 0, "<html>one</html>"),
                   ("r2", "frescos", dt.date(2024, 11, 13), 2, 24, "<html>two</html>")]


def test_log_reader(spark, tmp_path):
    _write(tmp_path / "run.log",
           "2024-11-13 12:42:35,200 - scraper - INFO - crawl.py:202 - run_all - Start - phase 1\n"
           "Traceback (most recent call last):\n")
    rows = read_log(spark, str(tmp_path / "run.log")).collect()
    assert rows[0].asDict() == {"logged_at": "2024-11-13 12:42:35,200", "logger": "scraper",
                                "level": "INFO", "file": "crawl.py", "line": 202,
                                "func": "run_all", "message": "Start - phase 1"}
    assert all(v is None for v in rows[1].asDict().values())


def test_pages_raw_sink_roundtrip(spark, tmp_path):
    from shelfscan.schemas import PAGES_RAW
    from shelfscan.sources.pages import read_pages_table
    from shelfscan.sources.sinks import write_pages
    d = dt.date(2024, 11, 13)
    first = spark.createDataFrame([("r2", "frescos", d, 1, None, "<p>a</p>"),
                                   ("r2", "frescos", d, 2, None, "<p>b</p>"),
                                   ("r2", "bebidas", d, 1, None, "<p>c</p>")], PAGES_RAW)
    out = str(tmp_path / "pages_raw")
    write_pages(first, out)
    relanded = spark.createDataFrame([("r2", "frescos", d, 1, None, "<p>a2</p>")], PAGES_RAW)
    write_pages(relanded, out)
    back = sorted((r.category, r.page_no, r.html) for r in read_pages_table(spark, out).collect())
    assert back == [("bebidas", 1, "<p>c</p>"), ("frescos", 1, "<p>a2</p>")]


def test_csv_quoted_newline(spark, tmp_path):
    _write(tmp_path / "20241113" / "x.csv",
           HEADER + 'a,"Linha 1\nLinha 2 500 g","1,00€ / UN",,,,r2,20241113_101500\n')
    rows = read_csv_snapshots(spark, str(tmp_path), "r2").collect()
    assert len(rows) == 1 and rows[0].product_name == "Linha 1\nLinha 2 500 g"


def test_csv_headers_that_do_not_fit(spark, tmp_path):
    """Blank lines, padding, case and a byte order mark are no matter; an unknown header is never
    read as rows of NULL."""
    _write(tmp_path / "20241113" / "a.csv", "\ufeff\n  \n Product_ID , product_name,Extra\n\n1,Água,x\n2,\"\",y\n")
    _write(tmp_path / "20241113" / "b.csv", "product_name,product_id,product_name\nfirst,3,second\n,4\nshort\n")
    _write(tmp_path / "20241113" / "blank.csv", "\n \n")
    good = read_csv_snapshots(spark, str(tmp_path), "r2")
    assert {(r.product_id, r.product_name) for r in good.collect()} == {
        ("1", "Água"), ("2", ""), ("3", "first"), ("4", None), (None, "short")}
    _write(tmp_path / "20241113" / "bad.csv", "codigo;nome;preco\n1;x;2\n3;y;4\n")
    _write(tmp_path / "20241114" / "half.csv", "product_id,source\n9,r2\n")
    with pytest.raises(Exception, match="bad.csv: header lacks product_id, product_name|half.csv"):
        read_csv_snapshots(spark, str(tmp_path), "r2").collect()
    rows = read_csv_snapshots(spark, str(tmp_path), "r2", error_rows=True).collect()
    bad = {(r.category, r.file_error, r.product_id) for r in rows if r.file_error}
    assert bad == {("bad", "header lacks product_id, product_name: codigo;nome;preco", None),
                   ("half", "header lacks product_name: product_id,source", None)}
    assert len(rows) == 7
    _write(tmp_path / "none" / "20241113" / "c.csv", "x,y\n1,2\n")
    own = T.StructType([T.StructField("a", T.LongType())])
    with pytest.raises(Exception, match="every declared column"):
        read_csv_snapshots(spark, str(tmp_path / "none"), own).collect()


def test_csv_is_read_once(spark, tmp_path):
    """One scan in the plan, no job before it, and the bytes of each file go by once."""
    for i in range(12):
        _write(tmp_path / f"2024111{i % 3}" / f"c{i}.csv", HEADER + f"p{i},Nome,1,,,,r2,t\n" * 50)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("csv-read", "reading")
    try:
        df = read_csv_snapshots(spark, str(tmp_path), "r2")
        assert list(tracker.getJobIdsForGroup("csv-read")) == []
        assert df.count() == 600
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") + plan.count("BatchScan") == 1
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_csv_columns_by_name_with_drift(spark, tmp_path):
    """Other column order, a missing and an extra column, odd file names."""
    _write(tmp_path / "20241113" / "Páginas be Acne+%7B.csv",
           "source,product_name,product_id,extra\nr2,Água,a,zzz\n")
    _write(tmp_path / "20241113" / "processed_cheese.csv", HEADER + "b,Queijo,1,,,,r2,t\n")
    _write(tmp_path / "20241114" / "category=saude%2Facne%2F" / "part-0.csv",
           "product_id,product_name\r\nc,Creme\r\n")
    _write(tmp_path / "20241114" / "vazio.csv", "")
    got = {r.product_id: r for r in read_csv_snapshots(spark, str(tmp_path), "r2").collect()}
    assert {k: (r.product_name, r.source, r.product_price, r.category) for k, r in got.items()} == {
        "a": ("Água", "r2", None, "Páginas be Acne+%7B"),
        "b": ("Queijo", "r2", "1", "processed_cheese"), "c": ("Creme", None, None, "saude/acne/")}
    assert got["c"].snapshot_date == dt.date(2024, 11, 14) and "extra" not in got["a"].asDict()


def test_write_evaluates_once(spark, tmp_path):
    acc = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b
    df = spark.range(2000).selectExpr("id", "'r1' source", "date'2024-11-13' snapshot_date",
                                      "concat('c', id % 3) category")
    write_snapshot(df.mapInArrow(count, df.schema), str(tmp_path / "once"))
    assert acc.value == 2000 and spark.read.parquet(str(tmp_path / "once")).count() == 2000
