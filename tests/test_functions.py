import hashlib
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterline import functions as fn
from meterline.functions.udfs import base_id_arrow
from meterline.schemas import PAYMENT_TYPES, VENDORS, payment_types

relaxed = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
stamps = st.datetimes(datetime(1995, 1, 1), datetime(2030, 1, 1))


def one(df):
    return [r[0] for r in df.collect()]


def spans(spark, pairs):
    return spark.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a timestamp_ntz, b timestamp_ntz"
    ).orderBy("i")


def at(text):
    return datetime.fromisoformat(f"2024-01-01 {text}")


def test_minutes_count_boundaries(spark):
    pairs = [
        (at("10:00:59"), at("10:01:01")),
        (at("10:00:00"), at("10:00:59")),
        (at("10:01:01"), at("10:00:59")),
        (at("10:05:00"), at("09:59:59")),
    ]
    got = one(spans(spark, pairs).select(fn.minutes_crossed(F.col("a"), F.col("b"))))
    assert got == [1, 0, -1, -6]


def test_elapsed_minutes_round_to_even(spark):
    base = at("10:00:00")
    pairs = [(base, base + timedelta(seconds=s)) for s in (150, 210, 90, 30, -90, -150, 149)]
    got = one(spans(spark, pairs).select(fn.elapsed_minutes(F.col("a"), F.col("b"))))
    assert got == [2, 4, 2, 0, -2, -2, 2]


@relaxed
@given(st.lists(st.tuples(stamps, stamps), min_size=1, max_size=30))
def test_durations_against_python(spark, pairs):
    rows = (
        spans(spark, pairs)
        .select(
            fn.minutes_crossed(F.col("a"), F.col("b")),
            fn.elapsed_minutes(F.col("a"), F.col("b")),
            fn.elapsed_hours(F.col("a"), F.col("b")),
        )
        .collect()
    )
    floor = lambda t: t.replace(second=0, microsecond=0)
    whole = lambda t: t.replace(microsecond=0)
    for (a, b), row in zip(pairs, rows):
        assert row[0] == (floor(b) - floor(a)) // timedelta(minutes=1)
        assert row[1] == round((b - a) / timedelta(microseconds=1) / 60e6)
        assert row[2] == (whole(b) - whole(a)) // timedelta(seconds=1) / 3600


def test_natural_key_text(spark):
    df = spark.createDataFrame(
        [
            ("1", "23", 1e-5, datetime(2024, 1, 2, 3, 4, 5)),
            ("12", "3", 12345678.9, datetime(2024, 1, 2, 3, 4, 5, 250000)),
            (None, "3", None, None),
        ],
        "a string, b string, x double, t timestamp",
    )
    got = one(df.select(fn.natural_key(["a", "b", "x", "t"])))
    texts = [
        "1231.0E-52024-01-02 03:04:05",
        "1231.23456789E72024-01-02 03:04:05.25",
        "3",
    ]
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in texts]


def test_key_without_separator_can_collide_and_surrogate_key_does_not(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), (None, "123")], "a string, b string")
    assert len(set(one(df.select(fn.natural_key(["a", "b"]))))) == 1
    assert len(set(one(df.select(fn.surrogate_key(["a", "b"]))))) == 3
    raw = one(df.select(fn.natural_key_bytes(["a", "b"])))
    assert bytes(raw[0]) == hashlib.md5(b"123").digest()


@relaxed
@given(
    st.lists(
        st.tuples(st.one_of(st.none(), st.integers(-99, 99)), st.one_of(st.none(), st.text(max_size=5))),
        min_size=1,
        max_size=20,
    )
)
def test_natural_key_against_python(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a int, b string")
    got = one(df.orderBy("i").select(fn.natural_key(["a", "b"])))
    text = lambda v: "" if v is None else str(v)
    assert got == [hashlib.md5((text(a) + text(b)).encode()).hexdigest() for a, b in rows]


def test_base_ids_native_and_arrow_agree(spark):
    bases = ["B02884", "B00003", "B00001", "B21", None, "Bxyz", "B", "", "B00000", "B9999999"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bases)], "i int, b string").orderBy("i")
    native = one(df.select(fn.base_id(F.col("b"))))
    arrow = one(df.select(fn.base_id_arrow(F.col("b"))))
    want = ["s/b44", "a/003", "e/001", "s/015", None, None, None, None, "s/000", "a/98967f"]
    assert native == want
    assert arrow == want


def test_safe_int(spark):
    df = spark.createDataFrame(
        [(0, "1"), (1, "1.0"), (2, "abc"), (3, None), (4, "99999999999")], "i int, s string"
    ).orderBy("i")
    assert one(df.select(fn.safe_int(F.col("s")))) == [1, 1, None, None, None]
    longs = spark.createDataFrame([(7,), (2**40,)], "n bigint")
    assert one(longs.select(fn.safe_int(F.col("n"), text=False))) == [7, None]


def test_decimal_keeps_cents(spark):
    df = spark.createDataFrame([(12.34,)], "x double")
    assert one(df.select(fn.decimal_of(F.col("x")))) == [Decimal("12.340")]


def test_code_name_and_label(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "c int")
    names = one(df.select(fn.code_name(F.col("c"), VENDORS)))
    assert names == [VENDORS[1], VENDORS[2], None, VENDORS[4], None]
    codes = spark.createDataFrame([("eng",), ("xx",), (None,)], "c string")
    assert one(codes.select(fn.label_or_self(F.col("c"), {"eng": "English"}))) == [
        "English",
        "xx",
        None,
    ]


def test_utc_naive(spark):
    df = spark.createDataFrame([(datetime(2024, 7, 1, 12),)], "t timestamp_ntz")
    assert one(df.select(fn.as_utc_naive(F.col("t"), "America/New_York"))) == [
        datetime(2024, 7, 1, 16)
    ]
    aware = df.select(F.col("t").cast("timestamp").alias("t"))
    assert one(aware.select(fn.as_utc_naive(F.col("t")))) == [datetime(2024, 7, 1, 12)]


def test_month_and_text_times(spark):
    df = spark.createDataFrame([(datetime(2024, 7, 31, 23, 59),)], "t timestamp_ntz")
    assert one(df.select(fn.month_of(F.col("t")))) == [datetime(2024, 7, 1)]
    texts = spark.createDataFrame([("2024-01-02 03:04:05",), ("soon",)], "s string")
    assert one(texts.select(fn.parse_timestamp(F.col("s")))) == [datetime(2024, 1, 2, 3, 4, 5), None]


def test_payment_lookup(spark):
    rows = {r["payment_type"]: r["description"] for r in payment_types(spark).collect()}
    assert rows == PAYMENT_TYPES
    assert rows[0] == rows[5] == "Unknown"


def test_base_id_of_long_numbers(spark):
    numbers = [0, 6, 21, 2884, 10**18 - 1, 10**18, 2**64, 7 * 2**64 * 3, 10**38 - 1, 123456789012345678901234567890]
    texts = [f"B{n}" for n in numbers] + ["B000000000000000000000000000000000000000000021", "Bx", "B", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, b string").orderBy("i")
    want = [f"{'s' if n % 7 == 0 else 'a' if n % 3 == 0 else 'e'}/{n:03x}" for n in numbers]
    want += ["s/015", None, None, None, None]
    assert one(df.select(fn.base_id(F.col("b")))) == want
    assert one(df.select(base_id_arrow("b"))) == want
    more = spark.createDataFrame([(f"B{10**38}",)], "b string")
    assert one(more.select(base_id_arrow("b"))) == [f"e/{10**38:x}"]
    with pytest.raises(Exception, match="more than 38 digits"):
        more.select(fn.base_id(F.col("b"))).collect()


def test_safe_int_goes_to_the_nearest(spark):
    texts = spark.createDataFrame([("1.0",), ("1.7",), ("2.5",), ("-2.5",), ("x",), ("1e10",)], "t string")
    assert one(texts.select(fn.safe_int(F.col("t")))) == [1, 2, 3, -3, None, None]
    numbers = spark.createDataFrame([(1.7,), (2.5,), (3.5,), (-2.5,), (1e10,), (None,)], "x double")
    assert one(numbers.select(fn.safe_int(F.col("x"), text=False))) == [2, 2, 4, -2, None, None]
