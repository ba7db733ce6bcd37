from pyspark.sql import functions as F

from reelkit.functions.clean import (id_text, title_year, to_bigint_id, to_date, to_double, to_int_or_zero,
                                     year_int, year_string)


def test_numeric_cases(spark):
    cases = ["12", " 12 ", "", None, "/path.jpg", "nan", "inf", "1_000", "1.0d", "1e3", "-2.5", ".5"]
    df = spark.createDataFrame([(c,) for c in cases], "x string")
    got = [r[0] for r in df.select(to_double("x")).collect()]
    assert got == [12.0, 12.0, None, None, None, None, None, None, None, 1000.0, -2.5, 0.5]


def test_ids_and_int_or_zero(spark):
    df = spark.createDataFrame([("862",), (" 7 ",), ("tt12",), (None,), ("1.5",)], "x string")
    ids = [r[0] for r in df.select(to_bigint_id("x")).collect()]
    assert ids == [862, 7, None, None, None]
    ints = [r[0] for r in df.select(to_int_or_zero("x")).collect()]
    assert ints == [862, 7, 0, 0, 0]


def test_dates_and_years(spark):
    df = spark.createDataFrame([("1995-10-30",), ("1",), (None,), ("1995-1-3",)], "d string")
    out = df.select(to_date("d").cast("string").alias("d"), year_string("d").alias("ys"),
                    year_int("d").alias("yi")).collect()
    assert [r.d for r in out] == ["1995-10-30", None, None, "1995-01-03"]
    assert [r.ys for r in out] == ["1995", None, None, "1995"]
    assert [r.yi for r in out] == [1995, 0, 0, 1995]


def test_title_year_and_id_text(spark):
    df = spark.createDataFrame([("Toy Story (1995)", "862.0"), ("Heat", "949"), (None, "x")], "t string, i string")
    out = df.select(title_year("t").alias("y"), id_text("i").alias("i")).collect()
    assert [r.y for r in out] == ["1995", None, None]
    assert [r.i for r in out] == ["862", "949", "x"]


def test_ansi_untouched(spark):
    # library code must not change the session's ANSI setting
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.range(1).select(F.lit("abc").try_cast("int")).first()[0] is None
