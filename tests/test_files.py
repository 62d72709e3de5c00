import csv
import io
import os
import random
import time
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from lotwise.sources import files as FS
from lotwise.sources import sinks as SK
from lotwise.sources.records import ends_inside
from lotwise.sources.tables import read_dims, read_table, run_queries, select_rename
from lotwise.streaming.ingest import ingest_new_files
from lotwise.plans.upkeep import tenant_report

TENANTS = {"NorthX": "North Co", "North": "N Co", "South": "South Co"}


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_tenant_files(spark, rows, tmp_path):
    write(tmp_path / "SQL_Pay_NorthX_1.csv", 'ID,Name,Amount,Empty\n1,"Caf\xe9, Inc",10.5,\n2,b,x,\nTotal,,10.5,\n', "latin1")
    write(tmp_path / "SQL_Pay_South.csv", "Amount,ID\n7,3\n7,Total\n")
    write(tmp_path / "SQL_Pay_North_empty.csv", "")
    write(tmp_path / "SQL_Pay_North_header.csv", "ID,Name\n")
    report = tenant_report(
        spark, str(tmp_path), ["ID", "Name", "Amount", "Empty"], TENANTS, {"ID": "id", "Amount": "amount"},
        {"id": "string", "amount": "double"},
    )
    assert "Empty" not in report.columns
    assert rows(report, "id", "Name", "amount", "tenant") == [
        ("1", "Caf\xe9, Inc", 10.5, "North Co"), ("2", "b", None, "North Co"), ("3", None, 7.0, "South Co"),
    ]


def test_tenant_files_keep_every_header(spark, rows, tmp_path):
    write(tmp_path / "NorthX.csv", 'ID,Name,"Extra, own",ID,,Tenant\n1,a,x,9,u,t\nTotal,,,,,\n')
    write(tmp_path / "South.csv", "name,id,None,Late\nb,2,,z\nTotal,,,\n")
    combined = FS.combine_tenant_files(spark, str(tmp_path), None, TENANTS)
    assert combined.columns == ["Extra, own", "ID", "ID.1", "Late", "Name", "None", "Unnamed: 4", "tenant", "file_path"]
    report = tenant_report(spark, str(tmp_path), None, TENANTS, {"ID": "id"}, {"id": "int"})
    assert report.columns == ["Extra, own", "id", "ID.1", "Late", "Name", "Unnamed: 4", "tenant", "file_path"]
    assert rows(report.drop("file_path")) == [
        (None, 2, None, "z", "b", None, "South Co"), ("x", 1, "9", None, "a", "u", "North Co"),
    ][::-1]


def test_tenant_files_over_many_splits(spark, tmp_path):
    lines = "\n".join(f"{i},v{i}" for i in range(20000))
    write(tmp_path / "South.csv", f"ID,V\n{lines}\nTotal,20000\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = FS.combine_tenant_files(spark, str(tmp_path), ["ID", "V"], TENANTS)
        got = df.agg(F.count("*"), F.sum(F.col("ID").try_cast("long"))).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert tuple(got) == (20000, sum(range(20000)))


def csv_text(rng, n):
    """Rows with separators, quotes and line breaks in quoted cells, stray quotes in plain ones, and short cells."""
    cell = lambda: "".join(rng.choices(["a", "b", ",", '"', "\n", " ", "é"], k=rng.choice([0, 1, 2, 3, 9])))
    quoted = lambda c: '"' + c.replace('"', '""') + '"'
    plain = lambda: "x" + "".join(rng.choices(["a", '"', " "], k=rng.randint(0, 3)))
    rows = [",".join([str(i), quoted(cell()) if rng.random() < 0.5 else plain(), quoted(cell()), plain()]) for i in range(n)]
    return "ID,V,W,Z\n" + "\n".join(rows) + "\nTotal,,,\n"


def test_records_over_many_splits(spark, tmp_path):
    """Quoted line breaks across the borders of splits, against Python's reader."""
    rng = random.Random(11)
    texts = {"NorthX_1.csv": csv_text(rng, 3000), "South_2.csv": csv_text(rng, 40), "South_3.csv": 'ID,"V\n2",W\n1,a,b\nTotal,,\n'}
    texts["South_4.csv"] = "ID,V\n" + '7,"' + "line\n" * 4000 + 'end"\nTotal,\n'
    for name, text in texts.items():
        write(tmp_path / name, text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        found = FS.combine_tenant_files(spark, str(tmp_path), None, TENANTS, encoding="UTF-8")
        got = sorted((r["file_path"][-9:-4], r["ID"], *((r[c] or "") for c in ("V", "V\n2", "W", "Z"))) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = []
    for name, text in texts.items():
        head, *rows, _ = [r for r in csv.reader(io.StringIO(text)) if "".join(r).strip()]
        want += [(name[-9:-4], *(dict(zip(head, r)).get(c, "").strip(" ") if c == "ID" else dict(zip(head, r)).get(c, "") for c in ("ID", "V", "V\n2", "W", "Z"))) for r in rows]
    assert got == sorted(want)


def test_open_quote_is_an_error(spark, tmp_path):
    write(tmp_path / "South.csv", 'ID,V\n1,"open\n2,b\nTotal,\n')
    with pytest.raises(ValueError, match="South.csv"):
        FS.combine_tenant_files(spark, str(tmp_path), None, TENANTS)


@pytest.mark.parametrize(
    ("line", "outside", "inside"),
    [("a,b", 0, 1), ('"a,b', 1, 0), ('a"b,c', 0, 0), ('"a""b', 1, 0), ('"a"",b', 1, 0), ('"a"x"y",z', 0, 0), ('a,"b","c', 1, 1), ('",', 1, 0), ('""', 0, 1), ("", 0, 1), ('x",y', 0, 0), ('","', 0, 1)],
)
def test_ends_inside(spark, line, outside, inside):
    row = spark.createDataFrame([(line, '"' + line)], "a string, b string").select(ends_inside(F.col("a")), ends_inside(F.col("b"))).first()
    assert tuple(map(int, row)) == (outside, inside)


def test_unknown_tenant_is_named(spark, tmp_path):
    write(tmp_path / "West.csv", "ID\n1\nTotal\n")
    with pytest.raises(ValueError, match="West.csv"):
        FS.combine_tenant_files(spark, str(tmp_path), ["ID"], TENANTS)


def test_latest_file(spark, tmp_path):
    for age, name in ((30, "Daily_a.csv"), (20, "Daily_b.csv"), (10, "Daily_skip.csv"), (0, "Other.csv")):
        write(tmp_path / name, "x")
        os.utime(tmp_path / name, (time.time() - age, time.time() - age))
    assert FS.latest_file(spark, str(tmp_path), ["Daily"], ["skip"]).endswith("Daily_b.csv")
    assert FS.latest_file(spark, str(tmp_path), ["nothing"]) is None


def test_append_csv_reports_rows(spark, tmp_path):
    path = write(tmp_path / "in.csv", 'k,v\n1,"a"\nbad,b\n3,c\n')
    target = str(tmp_path / "table")
    assert FS.append_csv(spark, path, "k int, v string", target) == 2
    assert FS.append_csv(spark, path, "k int, v string", target) == 2
    assert spark.read.parquet(target).count() == 4


def test_standardize_only_existing(spark, rows):
    df = spark.createDataFrame([("1", "x"), ("a", "y")], ["Payment ID", "Other"])
    got = FS.standardize(df, {"Payment ID": "id", "Gone": "gone"}, {"id": "int", "gone": "int"})
    assert got.columns == ["id", "Other"] and rows(got) == [(1, "x"), (None, "y")]


def test_archive_once_per_day(spark, rows, tmp_path):
    root = str(tmp_path / "arch")
    assert SK.read_archive(spark, root) is None
    one, two = spark.range(1), spark.range(2)
    SK.archive_snapshot(one, root, date(2025, 1, 1))
    SK.archive_snapshot(two, root, date(2025, 1, 1))
    SK.archive_snapshot(two, root, date(2025, 1, 8), if_absent=False)
    kept = SK.read_archive(spark, root)
    assert SK.snapshot_at(kept, "as_of", date(2025, 1, 8)).count() == 1
    assert SK.snapshot_at(kept, "as_of", date(2025, 1, 20)).count() == 0


def test_csv_and_replace(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    SK.write_csv(df, str(tmp_path / "csv"), ["k"])
    assert rows(FS.read_delimited(spark, str(tmp_path / "csv"), "k int, v string")) == [(1, "a"), (2, "b")]
    path = str(tmp_path / "t")
    SK.replace_partitions(df, path, ["k"])
    SK.replace_partitions(df.filter("k = 2").withColumn("v", F.lit("c")), path, ["k"])
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "a"), (2, "c")]


def test_stream_handles_each_file_once(spark, rows, tmp_path):
    folder, table, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    os.mkdir(folder)
    schema = "year int, month int, v int"
    write(tmp_path / "in" / "a.csv", "year,month,v\n2025,1,1\n2025,2,2\n")
    ingest_new_files(spark, folder, schema, table, progress, ["year", "month"])
    assert rows(spark.read.parquet(table), "year", "month", "v") == [(2025, 1, 1), (2025, 2, 2)]
    write(tmp_path / "in" / "b.csv", "year,month,v\n2025,2,20\n")
    for _ in range(2):
        ingest_new_files(spark, folder, schema, table, progress, ["year", "month"])
    assert rows(spark.read.parquet(table), "year", "month", "v") == [(2025, 1, 1), (2025, 2, 20)]


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_stream_newest_file_wins(spark, rows, tmp_path, files_per_batch):
    folder, table, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    os.mkdir(folder)
    for age, name, text in ((30, "z", "2025,1,1\n2025,2,2\n2025,2,3\n"), (10, "a", "2025,2,20\n"), (20, "m", "2025,2,9\n2025,3,9\n")):
        write(tmp_path / "in" / f"{name}.csv", "year,month,v\n" + text)
        os.utime(tmp_path / "in" / f"{name}.csv", (time.time() - age, time.time() - age))
    ingest_new_files(spark, folder, "year int, month int, v int", table, progress, ["year", "month"], files_per_batch)
    assert rows(spark.read.parquet(table), "year", "month", "v") == [(2025, 1, 1), (2025, 2, 20), (2025, 3, 9)]


def test_role_schema_is_explicit(spark, tmp_path):
    spark.createDataFrame([("A", 2025, 1, 5)], "make string, sale_year int, sale_month int, sales long").write.parquet(
        str(tmp_path / "industry_make.parquet")
    )
    df = read_table(spark, "industry_make", str(tmp_path))
    assert df.columns == ["make", "sale_year", "sale_month", "file_date", "sales"]
    assert tuple(df.first()) == ("A", 2025, 1, None, 5)


def test_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "nums.parquet"))
    dims = read_dims(spark, ["nums"], str(tmp_path))
    frames = run_queries({"big": lambda: dims["nums"].filter("id > 0")}, register=True)
    assert frames["big"].count() == spark.table("big").count() == 2
    assert select_rename(spark.createDataFrame([(1, 2)], "a int, b int"), {"a": "x"}, ["b"]).columns == ["b", "x"]


QUOTED = 'k,v,z\n1,"say ""hi"", ok",x\nbad,b,y\n2,"two\nlines",w\n'


def test_doubled_quotes_and_line_breaks(spark, rows, tmp_path):
    path = write(tmp_path / "in.csv", QUOTED)
    schema = "k int, v string, z string"
    want = [(1, 'say "hi", ok', "x"), (2, "two\nlines", "w"), (None, "b", "y")]
    assert rows(FS.read_delimited(spark, path, schema, multi_line=True)) == want
    assert FS.append_csv(spark, path, schema, str(tmp_path / "table"), multi_line=True) == 2
    assert rows(spark.read.parquet(str(tmp_path / "table"))) == want[:2]
    rejected = FS.rejected_rows(spark, path, schema, multi_line=True)
    assert [r["line"] for r in rejected.collect()] == ["bad,b,y"] and rejected.count() == 1


def test_append_once(spark, rows, tmp_path):
    path, target = write(tmp_path / "in.csv", "k,v\n1,a\n2,b\n"), str(tmp_path / "table")
    other = write(tmp_path / "more.csv", "k,v\n3,c\n")
    for p, n in ((path, 2), (other, 1), (path, 2)):
        assert FS.append_csv_once(spark, p, "k int, v string", target) == n
    assert rows(spark.read.parquet(target), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]
    write(tmp_path / "in.csv", "")
    assert FS.append_csv_once(spark, str(tmp_path / "*.csv"), "k int, v string", target) == 1
    assert rows(spark.read.parquet(target), "k", "v") == [(3, "c")]


def test_stream_late_files(spark, rows, tmp_path):
    """A file that arrives later but is older: it fills its own period and overwrites none, however old it is."""
    folder, table, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    os.mkdir(folder)
    for age, name, text in ((0, "new", "2025,1,1\n"), (2, "late", "2025,1,9\n2025,2,9\n"), (30, "older", "2025,2,7\n2025,3,7\n")):
        write(tmp_path / "in" / f"{name}.csv", "year,month,v\n" + text)
        then = time.time() - age * 86_400
        os.utime(tmp_path / "in" / f"{name}.csv", (then, then))
        ingest_new_files(spark, folder, "year int, month int, v int", table, progress, ["year", "month"])
    assert rows(spark.read.parquet(table), "year", "month", "v") == [(2025, 1, 1), (2025, 2, 9), (2025, 3, 7)]


def test_half_written_archive_is_repaired(spark, rows, tmp_path):
    from datetime import date

    from lotwise.sources import sinks

    os.makedirs(tmp_path / "as_of=2025-01-01" / "_temporary")
    for value in (1, 2):
        sinks.archive_snapshot(spark.createDataFrame([(value,)], "v int"), str(tmp_path), date(2025, 1, 1))
    assert rows(spark.read.parquet(str(tmp_path / "as_of=2025-01-01"))) == [(1,)]


def test_archive_only_if_stale(spark, rows, tmp_path):
    (tmp_path / "in").mkdir()
    for name, day in (("old.csv", 1), ("new.csv", 3)):
        then = datetime(2025, 1, day, 12, tzinfo=timezone.utc).timestamp()
        os.utime(write(tmp_path / "in" / name, "x"), (then, then))
    df, root = spark.createDataFrame([(1,)], "v int"), str(tmp_path / "arch")
    SK.archive_snapshot(df, root, date(2025, 1, 3), source=str(tmp_path / "in"))
    assert SK.read_archive(spark, root) is None
    SK.archive_snapshot(df, root, date(2025, 1, 4), source=str(tmp_path / "in"))
    assert rows(SK.read_archive(spark, root)) == [(1, date(2025, 1, 4))]
