import datetime as dt
import math


from strata.functions import scalar as X


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_to_int_goes_through_double(spark):
    vals = _one(spark, X.to_int("s"), [("3.7",), ("1.0",), ("x",), (None,), ("1e12",), ("-2.9",)],
                "s string")
    assert vals == [3, 1, None, None, None, -2]


def test_to_float_and_date_are_lenient(spark):
    df = spark.createDataFrame([("12.5", "2023-01-02"), ("abc", "not a date"), (None, None)],
                               "f string, d string")
    rows = df.select(X.to_float("f").alias("f"), X.to_date("d").alias("d")).collect()
    assert rows[0]["f"] == 12.5 and rows[0]["d"] == dt.date(2023, 1, 2)
    assert rows[1]["f"] is None and rows[1]["d"] is None
    assert rows[2]["f"] is None and rows[2]["d"] is None


def test_trim_and_code(spark):
    df = spark.createDataFrame([(" Left ", "  a b  "), ("left", "\tx")], "foot string, s string")
    rows = df.select(X.clean_code("foot").alias("c"), X.clean_text("s").alias("t")).collect()
    assert [r["c"] for r in rows] == ["left", "left"]
    assert rows[0]["t"] == "a b" and rows[1]["t"] == "\tx"      # tabs are not spaces


def test_is_positive_excludes_nan_null_zero_negative(spark):
    rows = [(float("nan"),), (None,), (0.0,), (-1.0,), (2.0,)]
    vals = _one(spark, X.is_positive("v"), rows, "v double")
    assert vals == [False, None, False, False, True]
    kept = spark.createDataFrame(rows, "v double").filter(X.is_positive("v")).collect()
    assert [r["v"] for r in kept] == [2.0]


def test_years_between_uses_as_of_not_today(spark):
    df = spark.createDataFrame([(dt.datetime(1990, 5, 6),), (dt.datetime(2000, 12, 31),), (None,)],
                               "dob timestamp")
    vals = [r[0] for r in df.select(X.years_between(dt.date(2026, 1, 1), "dob")).collect()]
    assert vals == [36, 26, None]


def test_ratio_division_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 2, 4), (1, 0, 0), (2, 1, 8)], "g long, a long, n long")
    vals = [r[0] for r in df.select(X.ratio(["g", "a"], "n", 2)).collect()]
    assert vals == [0.75, None, 0.38]       # 3/8 = 0.375 rounds half-up


def test_bucket_edges(spark):
    edges = [(85, "elite"), (75, "good"), (65, "mid")]
    rows = [(v,) for v in (64, 65, 74, 75, 84, 85, None)]
    vals = _one(spark, X.bucket("r", edges, "low"), rows, "r int")
    assert vals == ["low", "mid", "mid", "good", "good", "elite", "low"]


def test_format_amount_rounds_half_up(spark):
    vals = _one(spark, X.format_amount("v"), [(2.5,), (1234567.49,), (0.0,)], "v double")
    assert vals == ["3 EUR", "1,234,567 EUR", "0 EUR"]


def test_paths_and_sizes(spark):
    df = spark.createDataFrame([("C:\\raw\\Transfermarkt\\players.csv", 1572864)],
                               "p string, n long")
    row = df.select(X.normalise_path("p").alias("p"), X.relative_to("p", "C:/raw").alias("r"),
                    X.bytes_to_mb("n").alias("mb")).collect()[0]
    assert row["p"] == "C:/raw/Transfermarkt/players.csv"
    assert row["r"] == "Transfermarkt/players.csv"
    assert math.isclose(row["mb"], 1.5)


def test_relative_to_escapes_regex_characters(spark):
    df = spark.createDataFrame([("/data/a+b (1)/x.csv",), ("/other/y.csv",)], "p string")
    vals = [r[0] for r in df.select(X.relative_to("p", "/data/a+b (1)")).collect()]
    assert vals == ["x.csv", "/other/y.csv"]


def test_years_between_accepts_iso_text(spark):
    df = spark.createDataFrame([(dt.date(2000, 6, 1),)], "d date")
    assert df.select(X.years_between("2026-01-01", "d")).collect()[0][0] == 26
