from datetime import date

from pyspark.sql import functions as F

from brandtrack.functions import (
    money_text,
    percent_text,
    saturdays,
    share,
    to_code,
    week_ending,
    weekly_mean,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_week_ends_on_saturday(spark):
    days = {
        date(2001, 6, 29): date(2001, 6, 30),
        date(2001, 6, 30): date(2001, 6, 30),
        date(2001, 7, 1): date(2001, 7, 7),
    }
    for day, end in days.items():
        assert one(spark, week_ending(F.lit(day))) == end


def test_saturdays_include_both_ends(spark):
    weeks = one(spark, saturdays(F.lit(date(2001, 6, 16)), F.lit(date(2001, 6, 30))))
    assert weeks == [date(2001, 6, 16), date(2001, 6, 23), date(2001, 6, 30)]


def test_saturdays_of_an_empty_period(spark):
    assert one(spark, saturdays(F.lit(date(2001, 7, 1)), F.lit(date(2001, 6, 30)))) == []
    assert one(spark, saturdays(F.lit(None).cast("date"), F.lit(date(2001, 6, 30)))) == []
    # a period of a few days without a Saturday
    assert one(spark, saturdays(F.lit(date(2001, 6, 24)), F.lit(date(2001, 6, 28)))) == []


def test_codes_read_from_text(spark):
    texts = {"12": 12, "12.0": 12, " 7 ": 7, "n/a": None, "NaN": None, "": None, None: None}
    texts |= {"4119000123": 4119000123, "12345678901234567": 12345678901234567, "-3": -3, "7.": 7}
    texts |= {"12.7": None, "28.5": None, "12d": None, "0x1p3": None, "123456789012345678901": None}
    for text, code in texts.items():
        assert one(spark, to_code(F.lit(text).cast("string"))) == code


def test_codes_that_do_not_fit_are_unknown(spark):
    assert one(spark, to_code(F.lit("99999999999"), "int")) is None
    assert one(spark, to_code(F.lit("3.0"), "int")) == 3


def test_share_of_nothing_is_null(spark):
    assert one(spark, share(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, share(F.lit(None), F.lit(4))) == 0.0
    assert one(spark, share(F.lit(1), F.lit(0))) is None
    assert one(spark, share(F.lit(1), F.lit(None))) is None


def test_mean_of_an_empty_slice_is_null(spark):
    df = spark.createDataFrame([(1, True), (2, True), (9, False)], "v int, s boolean")
    assert df.agg(weekly_mean(F.col("v"), F.col("s"))).first()[0] == 1.5
    assert df.agg(weekly_mean(F.col("v"), F.lit(False))).first()[0] is None


def test_report_texts(spark):
    money = {2.5: "$2", 3.5: "$4", 1234567.49: "$1,234,567", -0.3: "$0", -1234.6: "$-1,235"}
    for value, text in money.items():
        assert one(spark, money_text(F.lit(value))) == text == f"${round(value):,}"
    for value in (0.1225, 0.12345, 0.0, 1.0, 12.5, -0.031, 1 / 3):
        assert one(spark, percent_text(F.lit(value))) == "%.1f" % (value * 100) + "%"
    missing = F.lit(None).cast("double")
    assert one(spark, money_text(missing)) is None
    assert one(spark, percent_text(missing)) is None
