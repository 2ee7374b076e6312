import datetime

from pyspark.sql import functions as F

from tallybrook.functions import first_number, in_words, parsed_date, text_year


def _column(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [row[0] for row in df.select(expression, "i").orderBy("i").collect()]


def test_first_number(spark):
    texts = ["", "6-25", "More than 1000", "26-100", None, "x99999999999"]
    assert _column(spark, texts, first_number("s")) == [None, 6, 1000, 26, None, None]


def test_first_number_is_not_fooled_by_letter_d(spark):
    assert _column(spark, ["add12"], first_number("s")) == [12]


def test_dates_day_first(spark):
    texts = ["2010-01-01", "1/1/2000", "31/12/2000", "2000-13-45", "31/2/2000", None]
    expected = [None, 2000, 2000, None, None, None]
    assert _column(spark, texts, F.year(parsed_date("s", "d/M/yyyy"))) == expected


def test_dates_two_digits(spark):
    expected = [datetime.date(2010, 12, 1), None, None]
    texts = ["01-12-2010", "1-12-2010x", None]
    assert _column(spark, texts, parsed_date("s", "dd-MM-yyyy")) == expected


def test_year_of_text_compares_as_number(spark):
    texts = ["01-12-2010 8.26", "xx", None, "01-12-20x0"]
    same = text_year("s").try_cast("int") == 2010
    assert _column(spark, texts, same) == [True, None, None, None]


def test_in_words(spark):
    texts = ["Male", "m", "MALE", "female", "", None]
    assert _column(spark, texts, in_words("s", ["male", "m"])) == [1, 1, 1, 0, 0, 0]
