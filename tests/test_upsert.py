import pytest
from pyspark.sql import functions as F

from lotwise.sources.files import list_files
from lotwise.sources.sinks import _in_periods, fingerprints, upsert_changed

ROWS = "ym string, id int, name string, price double"
FIRST = [("202401", 1, "a", 1.0), ("202401", 2, None, 2.0), ("202401", 2, None, 2.0), ("202402", 3, "c", None), ("202403", 4, "d", 4.0), (None, 5, "e", 5.0)]


def files(spark, path):
    """Names of the table's files by period."""
    return {(r["path"].split("/")[-2], r["path"].split("/")[-1]) for r in list_files(spark, path).collect() if "/ym=" in r["path"]}


def actions(report):
    return {r["ym"]: (r["rows"], r["action"]) for r in report.collect()}


def test_only_changed_periods_are_rewritten(spark, rows, tmp_path):
    path = str(tmp_path / "plan")
    first = spark.createDataFrame(FIRST, ROWS)
    assert {a for _, a in actions(upsert_changed(first, path, ["ym"])).values()} == {"added"}
    before = files(spark, path)
    # other order and columns' order, nothing else: no file changes
    again = spark.createDataFrame(FIRST[::-1], ROWS).select("price", "name", "id", "ym").repartition(3)
    assert actions(upsert_changed(again, path, ["ym"])) == {"202401": (3, "kept"), "202402": (1, "kept"), "202403": (1, "kept"), None: (1, "kept")}
    assert files(spark, path) == before
    delivery = spark.createDataFrame([FIRST[0], FIRST[1], ("202402", 3, "c", None), ("202404", 9, "n", 9.0), (None, 6, "e", 5.0)], ROWS)
    assert actions(upsert_changed(delivery, path, ["ym"])) == {
        "202401": (2, "replaced"), "202402": (1, "kept"), "202404": (1, "added"), None: (1, "replaced"),
    }
    after = files(spark, path)
    kept = {f for f in before if f[0] in ("ym=202402", "ym=202403")}
    assert kept <= after and not (before - kept) & after
    held = spark.read.schema(ROWS).parquet(path).select("ym", "id", "name", "price")
    assert rows(held) == rows(delivery.unionAll(first.filter("ym = '202403'")))


@pytest.mark.parametrize("other", [
    [("x", 1, "b", 1.0), ("x", 2, "a", 1.0)],  # values moved between rows
    [("x", 1, None, 1.0), ("x", 2, "b", 1.0)],  # a value gone
    [("x", 1, "a", 1.0), ("x", 2, "b", 1.0), ("x", 2, "b", 1.0)],  # a row twice
    [("x", 1, "a", 1.0)],
    [("x", 1, "a", None), ("x", 2, "b", 1.0)],
])
def test_fingerprints_differ(spark, other):
    base = spark.createDataFrame([("x", 1, "a", 1.0), ("x", 2, "b", 1.0)], ROWS)
    mark = lambda df: fingerprints(df, ["ym"]).select("rows", "_sum", "_bits").first()
    assert mark(base) == mark(base.orderBy(F.desc("id"))) != mark(spark.createDataFrame(other, ROWS))


def test_nulls_keep_their_place(spark):
    mark = lambda a, b: fingerprints(spark.createDataFrame([("x", a, b)], "k string, a string, b string"), ["k"]).first()
    assert mark(None, "v") != mark("v", None)


def test_a_delivery_without_rows_and_one_with_other_columns(spark, rows, tmp_path):
    path = str(tmp_path / "plan")
    first = spark.createDataFrame(FIRST, ROWS)
    upsert_changed(first, path, ["ym"])
    assert upsert_changed(first.limit(0), path, ["ym"]).count() == 0
    assert spark.read.parquet(path).count() == len(FIRST)
    with pytest.raises(ValueError, match="extra"):
        upsert_changed(first.withColumn("extra", F.lit(1)), path, ["ym"])
    upsert_changed(first.limit(0), str(tmp_path / "empty"), ["ym"])
    assert actions(upsert_changed(first.limit(1), str(tmp_path / "empty"), ["ym"]))["202401"] == (1, "added")


def test_only_the_delivered_periods_are_scanned(spark, tmp_path):
    path = str(tmp_path / "plan")
    upsert_changed(spark.createDataFrame(FIRST, ROWS), path, ["ym"])
    periods = spark.createDataFrame([("202402",), (None,)], "ym string")
    scan = spark.read.schema(ROWS).parquet(path).filter(_in_periods(periods, ["ym"]))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "DataFilters: []" in plan  # the scan's choice of partitions does it all
    assert {f[0].split("/")[-2] for f in scan.select(F.input_file_name()).collect()} == {"ym=202402", "ym=__HIVE_DEFAULT_PARTITION__"}
