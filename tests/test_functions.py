import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from starmill.functions import dates, numbers, text

D = datetime.date


def apply(spark, values, make, stripped=False):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, s STRING")
    if stripped:
        df = df.select("i", text.strip(F.col("s")).alias("s"))
    return [r.out for r in df.select("i", make(F.col("s")).alias("out")).orderBy("i").collect()]


BOTH_RULES = {
    "2024-01-05": D(2024, 1, 5),
    "2024-1-5": D(2024, 1, 5),
    "13/01/2024": D(2024, 1, 13),
    "05/06/2024": D(2024, 6, 5),
    "01/25/2024": D(2024, 1, 25),
    "01.25.2024": D(2024, 1, 25),
    "31/02/2024": None,
    "13/13/2024": None,
    "x": None,
    "": None,
    "05-06-2024": D(2024, 6, 5),
    "05.06.2024": D(2024, 6, 5),
    "1/2/24": D(2024, 2, 1),
    "1/13/24": D(2024, 1, 13),
    "1/2/99": D(1999, 2, 1),
    "24/1/13": D(2013, 1, 24),
    "20240105": D(2024, 1, 5),
    "20241305": D(2024, 5, 13),
    "2024/02/03": D(2024, 2, 3),
    "2024/13/05": D(2024, 5, 13),
    "2024-02-03 10:00:00": D(2024, 2, 3),
    "2024-02-03T10:00:00Z": D(2024, 2, 3),
    "2024-13-05 10:00": D(2024, 5, 13),
    "2024-01-05 25:00:00": None,
    "2024-01-05 and more": None,
    "03/02/2024 10:00": D(2024, 2, 3),
    "Jan 5 2024": D(2024, 1, 5),
    "jan 5, 2024": D(2024, 1, 5),
    "5 January 2024": D(2024, 1, 5),
    "05-Jan-2024": D(2024, 1, 5),
    "5-Jan-24": D(2024, 1, 5),
    "Sept 5 2024": D(2024, 9, 5),
    "2024-Jan-05": D(2024, 1, 5),
    "Friday, 5 January 2024": D(2024, 1, 5),
    "5th Jan 2024": D(2024, 1, 5),
    "Jan 2024": D(2024, 1, 1),
    "31 Feb 2024": None,
    "Janx 5 2024": None,
    "2024": D(2024, 1, 1),
    "2024-01": D(2024, 1, 1),
    "01/2024": D(2024, 1, 1),
    "1677-09-21": None,
    "1677-09-22": D(1677, 9, 22),
    "2262-04-11": D(2262, 4, 11),
    "2262-04-12": None,
    "9999-12-31": None,
    "\xa0 13/01/2024\t": D(2024, 1, 13),
    "29/02/2023": None,
    "45000": None,
    "2024\n": D(2024, 1, 1),
}


@pytest.mark.parametrize("rule", [dates.parse_date_mixed, dates.parse_date_staged])
def test_dates_read_alike_by_both_rules(spark, rule):
    got = apply(spark, list(BOTH_RULES), lambda c: dates.in_span(rule(c)), stripped=True)
    assert dict(zip(BOTH_RULES, got, strict=True)) == BOTH_RULES


def test_iso_shaped_date_is_swapped_only_by_the_mixed_rule(spark):
    assert apply(spark, ["2024-13-05", None], dates.parse_date_mixed) == [D(2024, 5, 13), None]
    assert apply(spark, ["2024-13-05", None], dates.parse_date_staged) == [None, None]


def test_every_python_whitespace_character_is_stripped(spark):
    blanks = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    assert set(text.WHITESPACE) == set(blanks)
    assert apply(spark, [f"{c}a{c} b{c}" for c in blanks], text.strip) == [f"a{c} b" for c in blanks]


def test_missing_texts(spark):
    given = ["", "  ", "nan ", " None", "NaN", "null", "NULL", "none", " a b ", None]
    assert apply(spark, given, lambda c: text.missing_to_null(text.strip(c))) == [
        None, None, None, None, "NaN", "null", "NULL", "none", "a b", None,
    ]


NUMBERS = {
    "1e3": "1000.00", " 12 ": "12.00", "+5": "5.00", ".5": "0.50", "5.": "5.00", "1E+3": "1000.00",
    "1.005": "1.01", "-2.345": "-2.35", "1,234": None, "1_000": None, "1d": None, "1.5f": None, "0x1p3": None,
    "0x1A": None, "inf": None, "Infinity": None, "nan": None, "": None, "1e": None, "--5": None,
    "\xa012": None, "١٢": None, "1 2": None, "True": None, "5%": None,
    "9999999999999999.99": "9999999999999999.99", "9999999999999999.995": None, "1e30": None,
}


def test_numbers(spark):
    got = apply(spark, list(NUMBERS), lambda c: numbers.to_num(c, numbers.MONEY))
    assert dict(zip(NUMBERS, got, strict=True)) == {k: v and Decimal(v) for k, v in NUMBERS.items()}


def test_rounding_to_six_digits_happens_once(spark):
    got = apply(spark, ["0.12345649999999", "0.1234565"], lambda c: numbers.to_num(c, numbers.RATIO))
    assert got == [Decimal("0.123456"), Decimal("0.123457")]


def test_order_id_cuts_fractions_and_stays_exact(spark):
    given = ["12.7", "-12.7", "12.0", "9007199254740993", "9223372036854775807", "9223372036854775808", "ORD-1"]
    assert apply(spark, given, numbers.to_order_id) == [
        12, -12, 12, 9007199254740993, 9223372036854775807, None, None,
    ]


def test_overflow_is_told_from_bad_text(spark):
    given = ["99999.99", "99999.994", "99999.995", "-1e6", "1e300", "1e400", "inf", "12d", None]

    def flag(c):
        return F.coalesce(numbers.overflows(c, numbers.to_num(c, T.DecimalType(7, 2))), F.lit(False))

    assert apply(spark, given, flag) == [False, False, True, True, True, False, False, False, False]


def test_ratio(spark):
    df = spark.createDataFrame(
        [("1.07", "1.28"), ("1", "0"), ("1", None), ("-1", "3"), ("1e15", "0.01")], "a STRING, b STRING"
    )
    money = [F.col(c).cast(numbers.MONEY) for c in "ab"]
    got = [r[0] for r in df.select(numbers.ratio(*money)).collect()]
    assert got == [Decimal("0.835938"), None, None, Decimal("-0.333333"), None]
