from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from skyground.functions import clock, display, parsing


def column(spark, values, function, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    rows = df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


def test_acquisition_times(spark):
    times = ["9", "130", "", "2460", "12345", "ab", "2359", "24", "00130", None]
    got = column(spark, times, lambda t: parsing.moment(F.lit("2024-02-29"), t))
    day = datetime(2024, 2, 29)
    assert got == [day.replace(minute=9), day.replace(hour=1, minute=30), day, None, None, None,
                   day.replace(hour=23, minute=59), day.replace(minute=24), None, None]


def test_days(spark):
    texts = ["2024-02-29", "2023-02-29", "2024-1-5", "2024", " 2024-01-05", "x", None]
    got = column(spark, texts, parsing.day)
    assert got == [date(2024, 2, 29), None, date(2024, 1, 5), None, None, None, None]


def test_times_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = column(spark, ["130"], lambda t: clock.epoch_s(parsing.moment(F.lit("1970-01-02"), t)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [86_400 + 5_400]


def test_decimals(spark):
    texts = ["1.5", " -2 ", "1e3", ".5", "5.", "", "x", "1.0d", "0x1p3", "1,5", "\t7\n", None]
    assert column(spark, texts, lambda c: parsing.decimal(parsing.stripped(c))) == [
        1.5, -2.0, 1000.0, 0.5, 5.0, None, None, None, None, None, 7.0, None]


def test_integers(spark):
    texts = ["12", " 2 ", "-3", "+4", "2.0", "", "many", "99999999999", None]
    assert column(spark, texts, lambda c: parsing.whole(parsing.stripped(c))) == [12, 2, -3, 4, None, None, None, None, None]
    assert column(spark, ["40000", "7"], lambda c: parsing.whole(c, "smallint")) == [None, 7]


def test_clipped_is_not_trimmed_but_text_is(spark):
    assert column(spark, ["NOAA-20-VIIRS", " ", "", None], lambda c: parsing.clipped(c, 10)) == [
        "NOAA-20-VI", " ", None, None]
    assert column(spark, [" a b ", " \t", "", None], parsing.text_or_null) == [
        "a b", None, None, None]


def test_sources(spark):
    texts = ["A; B ;;C", " ; ", "", None, "A"]
    assert column(spark, texts, parsing.source_count) == [3, 1, 1, 1, 1]
    assert column(spark, texts, display.source_list_text) == ["A · B · C", "", "", "", "A"]


def test_unreadable_counts_only_text(spark):
    got = column(spark, ["x", "", None, "3"], lambda c: parsing.unreadable(c, parsing.whole(c)))
    assert got == [1, 0, None, 0]


@pytest.mark.parametrize("function,kind,values,expected", [
    (display.score_text, "double", [12.34, 31.25, None, 0.0], ["12.3", "31.3", "—", "0.0"]),
    (display.sources_text, "int", [1, 2, 0, None], ["1 source", "2 sources", "0 source",
                                                   "null source"]),
    (display.confidence_text, "string", ["h", "H", None], ["High confidence", "Nominal",
                                                           "Nominal"]),
    (display.distance_text, "float", [3150.0, 3160.0, 40.0], [
        "3.1 km apart", "3.2 km apart", "0.0 km apart"]),
    (display.marker_radius, "double", [None, 0.0, 100.0, 1000.0],
     [pytest.approx(6 + 1.8 * 2 ** 0.5)] * 2 + [22.0, 22.0]),
    (display.date_prefix, "string", ["2024-01-02 03:04:05", None], ["2024-01-02", ""]),
])
def test_display(spark, function, kind, values, expected):
    assert column(spark, values, function, kind) == expected


def test_batch_days():
    today = date(2026, 7, 2)
    assert clock.batch_days(today) == (today, today)
    assert clock.batch_days(today, extra_day=True) == (date(2026, 7, 1), today)
    assert clock.batch_days(today, lag_days=365, lookback_days=3) == (
        date(2025, 6, 30), date(2025, 7, 2))
    with pytest.raises(ValueError):
        clock.explicit_days(start=today)
    with pytest.raises(ValueError):
        clock.explicit_days(today, date(2026, 7, 1))


def _attempt(function, *args):
    try:
        return function(*args)
    except (ValueError, OverflowError):
        return None


def _random_texts(alphabet, longest, n=4000):
    rnd = random.Random(11)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(longest + 1)))
            for _ in range(n)]


def test_numbers_parse_as_plain_python_numbers(spark):
    texts = _random_texts(" +-..0123456789eE\tindfax", 6)
    got = column(spark, texts, lambda c: parsing.decimal(parsing.stripped(c)))
    assert [repr(x) for x in got] == [repr(_attempt(float, t)) for t in texts]
    got = column(spark, texts, lambda c: parsing.whole(parsing.stripped(c)))
    assert got == [_attempt(int, t) for t in texts]


def test_times_parse_as_padded_clock_times(spark):
    texts = _random_texts("0123459a", 5)
    got = column(spark, texts, lambda c: parsing.moment(F.lit("2024-01-31"), c))

    def clock_time(text):
        padded = text.zfill(4)
        return datetime.strptime(f"2024-01-31 {padded[:2]}:{padded[2:]}", "%Y-%m-%d %H:%M")

    assert got == [_attempt(clock_time, t) for t in texts]


def test_days_parse_as_calendar_days(spark):
    texts = _random_texts("0122-", 10) + [
        f"{y}-{m:02d}-{d}" for y in (2023, 2024) for m in range(14) for d in (0, 1, 29, 30, 31, 32)]
    got = column(spark, texts, parsing.day)
    expected = [_attempt(lambda t: datetime.strptime(t, "%Y-%m-%d").date(), t) for t in texts]
    assert got == expected
