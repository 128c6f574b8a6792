"""Reading, writing, ingest and snapshots."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.sources import dimensions, ingest, readers, writers


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def test_wide_csv(spark, folder):
    path = f"{folder}/prices.csv"
    with open(path, "w") as f:
        f.write("Date,SPY,^VIX,A.B\n2020-01-01,1.5,,3\n2020-01-02 00:00:00,NaN,inf,4e-1\n2020-01-03,,,\n")
    got = {(r.symbol, r.ts.day): r.price for r in readers.read_wide_panel(spark, path).collect()}
    assert len(got) == 9
    assert got["SPY", 1] == 1.5 and got["SPY", 2] is None and got["^VIX", 2] is None
    assert got["A.B", 2] == 0.4
    macro = readers.read_indicators(spark, path, "macro")
    assert macro.count() == 3 and macro.columns == ["series_id", "kind", "ts", "value"]
    assert readers.read_indicators(spark, f"{folder}/none.csv", "macro") is None


def test_round_trip(spark, bars, folder):
    for kind in ("parquet", "csv", "feather"):
        writers.write_features(bars, f"{folder}/{kind}", kind)
    back = readers.read_features(spark, f"{folder}/parquet", ["symbol", "price"], F.col("panel_id") == "q")
    assert back.count() == bars.where("panel_id = 'q'").count()
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(panel_id" in plan
    with pytest.raises(ValueError):
        writers.write_features(bars, f"{folder}/x", "excel")
    paths = writers.write_results(folder, regimes_a=bars, metrics=bars)
    assert spark.read.parquet(paths["regimes_a"]).count() == bars.count()


def test_ingest(spark, folder):
    tries = f"{folder}/tries"

    def fetch(key):
        if key == "BAD":
            with open(tries, "a") as f:
                f.write("x")
            raise ConnectionError("no answer")
        for start in (0, 3):
            yield pd.DataFrame({"day": [start, start + 1], "price": [1.0, 2.0]})

    keys = spark.createDataFrame([("SPY",), ("TLT",), ("BAD",), ("SPY",)], "symbol string")
    schema = T.StructType([T.StructField("day", T.LongType()), T.StructField("price", T.DoubleType())])
    rows = ingest.ingest_by_key(keys, fetch, schema, retries=3, delay=0.01).cache()
    assert rows.where("error is null").count() == 8
    assert rows.where("error is not null").first().error == "ConnectionError: no answer"
    assert len(open(tries).read()) == 3
    assert [r.symbol for r in ingest.ingest_coverage(keys, ingest.fetched(rows)).collect()] == ["BAD"]
    bad = keys.where("symbol = 'BAD'")
    with pytest.raises(RuntimeError):
        ingest.fetched(ingest.ingest_by_key(bad, fetch, schema, retries=1))


def test_a_key_that_fails_half_way_goes_on_or_leaves_an_error(spark, folder):
    marks = f"{folder}/marks"

    def fetch(key):
        for page in range(4):
            if page == 2 and (key == "BROKEN" or not os.path.exists(f"{marks}-{key}")):
                open(f"{marks}-{key}", "w").close()
                raise TimeoutError("page 2")
            yield pd.DataFrame({"day": [page], "price": [1.0]})

    keys = spark.createDataFrame([("GOOD",), ("BROKEN",)], "symbol string")
    schema = T.StructType([T.StructField("day", T.LongType()), T.StructField("price", T.DoubleType())])
    rows = ingest.ingest_by_key(keys, fetch, schema, retries=2, delay=0.01).cache()
    got = sorted((r.symbol, -1 if r.day is None else r.day, r.error) for r in rows.collect())
    assert [g[:2] for g in got] == [("BROKEN", -1), ("BROKEN", 0), ("BROKEN", 1), *[("GOOD", i) for i in range(4)]]
    assert got[0][2] == "TimeoutError: page 2" and all(g[2] is None for g in got[1:])
    # a key that isn't whole doesn't count as arrived
    assert {r.symbol for r in ingest.fetched(rows).collect()} == {"GOOD"}


def test_files_are_read_by_spark_and_parsed_in_tasks(spark, folder):
    path = f"{folder}/files"
    rows = [("A/1", 1, 2.0), ("A/1", 2, 3.0), ("B", 5, None)]
    spark.createDataFrame(rows, "symbol string, day long, price double").write.partitionBy("symbol").csv(path)
    os.makedirs(f"{path}/symbol=C")
    with open(f"{path}/symbol=C/x.csv", "w") as f:
        f.write("one,two\n")

    def parse(content):
        return pd.DataFrame([(int(a), float(b or "nan")) for a, b in (x.split(",") for x in content.decode().split())], columns=["day", "price"])

    keys = spark.createDataFrame([("A/1",), ("B",), ("C",), ("D",), ("D",)], "symbol string")
    schema = T.StructType([T.StructField("day", T.LongType()), T.StructField("price", T.DoubleType())])
    got = ingest.ingest_files(keys, path, parse, schema).toPandas()
    assert sorted(got[got.symbol == "A/1"].day) == [1, 2] and got[got.symbol == "B"].day.tolist() == [5]
    assert got[got.symbol == "C"].error.str.startswith("ValueError").tolist() == [True]
    assert got[got.symbol == "D"].error.tolist() == ["FileNotFoundError: no file"]
    assert set(ingest.ingest_files(keys.where("symbol = 'B'"), path, parse, schema).toPandas().symbol) == {"B"}


def test_snapshots(spark, bars, folder):
    today = dt.date(2024, 5, 10)
    assert ingest.latest_snapshot(spark, f"{folder}/none", today) is None
    path = f"{folder}/pulls"
    ingest.snapshot(bars.where("panel_id = 'q'"), path, today - dt.timedelta(days=1))
    assert ingest.latest_snapshot(spark, path, today) is None
    assert ingest.latest_snapshot(spark, path, today, 2).count() == bars.where("panel_id = 'q'").count()
    ingest.snapshot(bars, path, today)
    assert ingest.latest_snapshot(spark, path, today).count() == bars.count()


def test_ingest_all(spark, bars):
    def broken():
        raise OSError("down")

    got = ingest.ingest_all({"prices": lambda: bars, "macro": broken})
    assert got["macro"] is None and got["prices"] is bars
    with pytest.raises(OSError):
        ingest.ingest_all({"prices": broken})


def test_dimensions(spark, bars):
    assert dimensions.dim_asset(spark).count() == 38
    assert dimensions.dim_indicator(spark).groupBy("kind").count().count() == 2
    classes = dimensions.class_counts(bars, dimensions.dim_asset(spark)).collect()
    assert len(classes) == 1 and classes[0].asset_class is None
