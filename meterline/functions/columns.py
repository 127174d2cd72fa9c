"""Column expressions. All stay on the JVM side and inside generated code where Spark allows."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "as_utc_naive",
    "base_id",
    "code_name",
    "date_of",
    "decimal_of",
    "elapsed_hours",
    "elapsed_minutes",
    "hash_text",
    "label_or_self",
    "minutes_crossed",
    "month_of",
    "natural_key",
    "natural_key_bytes",
    "or_default",
    "parse_timestamp",
    "round_money",
    "safe_int",
    "surrogate_key",
    "year_int",
]

MICROS_PER_MINUTE = 60_000_000


def month_of(ts: Column) -> Column:
    """First instant of the month, kept as a zone-less timestamp."""
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def date_of(ts: Column) -> Column:
    return F.to_date(ts)


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries between two timestamps: 10:00:59 to 10:01:01 counts one."""

    def minute_number(ts: Column) -> Column:
        return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(60))

    return (minute_number(end) - minute_number(start)).cast("bigint")


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Elapsed minutes as an integer; halves go to the even neighbour."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.rint(micros / F.lit(float(MICROS_PER_MINUTE))).cast("int")


def elapsed_hours(start: Column, end: Column) -> Column:
    """Elapsed hours as a double, from whole seconds."""
    seconds = F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))
    return seconds / F.lit(3600.0)


def parse_timestamp(text: Column, fmt: str | None = None) -> Column:
    """Text to timestamp; text that does not parse becomes null."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def as_utc_naive(ts: Column, zone: str | None = None) -> Column:
    """A timestamp as zone-less UTC.

    `zone` is the zone a zone-less input was written in; a zone-aware input needs none.
    """
    moved = F.to_utc_timestamp(ts, zone) if zone else F.to_utc_timestamp(ts, F.current_timezone())
    return moved.cast("timestamp_ntz")


def safe_int(value: Column, text: bool = True) -> Column:
    """Nearest integer, null instead of an error. Text goes through double so that '1.0' gives 1.

    Halves go away from zero in text and to the even neighbour in numbers.
    """
    number = value.try_cast("double")
    return (F.round(number) if text else F.rint(number)).try_cast("int")


def decimal_of(value: Column, precision: int = 18, scale: int = 3) -> Column:
    """Cast with a stated precision: a bare `numeric` would drop the cents."""
    return value.cast(T.DecimalType(precision, scale))


def or_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def round_money(value: Column) -> Column:
    return F.round(value, 2)


def year_int(value: Column) -> Column:
    return value.cast("int")


def code_name(code: Column, names: dict) -> Column:
    """Name of a code; codes without a name give null."""
    branches = iter(names.items())
    first_code, first_name = next(branches)
    chain = F.when(code == F.lit(first_code), F.lit(first_name))
    return reduce(lambda acc, kv: acc.when(code == F.lit(kv[0]), F.lit(kv[1])), branches, chain)


def label_or_self(code: Column, labels: dict[str, str]) -> Column:
    """Label of a code; codes without a label stay as they are."""
    flat = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*flat), code), code)


def hash_text(name: str) -> Column:
    """A column as text, with all its digits and fractions of a second; null gives an empty string."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def natural_key(names: list[str]) -> Column:
    """Hex hash of the joined column texts, without a separator."""
    return F.md5(F.concat(*[hash_text(n) for n in names]))


def natural_key_bytes(names: list[str]) -> Column:
    return F.unhex(natural_key(names))


NULL_MARK = "_null_"  # our own choice of text for a null part of a surrogate key


def surrogate_key(names: list[str]) -> Column:
    """Hex hash of the column texts joined by '-', with a mark for nulls."""
    parts = [
        F.when(F.col(n).isNull(), F.lit(NULL_MARK)).otherwise(hash_text(n))
        for n in names
    ]
    return F.md5(F.concat_ws("-", *parts))


def base_id(base: Column) -> Column:
    """Short form of a base number such as B02884.

    The digits after the first letter, in lower-case hex of at least three places, behind `s/` for
    multiples of 7, else `a/` for multiples of 3, else `e/`. Anything but digits gives null. More than 38 digits,
    without leading zeros, raise an error; `functions.base_id_arrow` takes any number.
    """
    digits = F.substr(base, F.lit(2))
    # Almost all numbers fit a long. Expressions inside of a branch are not shared by Spark, so this one has none that is costly.
    n = digits.cast("bigint")
    padded = F.when(n < 256, F.lpad(F.hex(n), 3, "0")).otherwise(F.hex(n))
    short = F.concat(_base_prefix(n % 7 == 0, n % 3 == 0), F.lower(padded))
    return F.when(base.rlike("^.[0-9]{1,18}$"), short).when(base.rlike("^.[0-9]+$"), _wide_base_id(digits, base))


def _base_prefix(sevenfold: Column, threefold: Column) -> Column:
    return F.when(sevenfold, "s/").when(threefold, "a/").otherwise("e/")


def _wide_base_id(digits: Column, base: Column) -> Column:
    """The same for any number of up to 38 digits behind its leading zeros, by exact decimals."""
    text = F.regexp_replace(digits, "^0+(?=.)", "")
    known = F.when(F.length(text) <= 38, text).otherwise(
        F.raise_error(F.concat(F.lit("more than 38 digits: "), base)).cast("string")
    )
    wide = known.cast("decimal(38,0)")
    word = F.lit(Decimal(2**64))
    low = wide % word
    limbs = [F.call_function("div", wide, word), F.call_function("div", low, F.lit(Decimal(2**32)))]
    limbs.append((low % F.lit(Decimal(2**32))).cast("bigint"))
    joined = F.concat(F.hex(limbs[0]), *[F.lpad(F.hex(x), 8, "0") for x in limbs[1:]])
    places = F.lower(F.regexp_replace(joined, "^0+(?=.)", ""))
    padded = F.when(F.length(places) < 3, F.lpad(places, 3, "0")).otherwise(places)
    return F.concat(_base_prefix((wide % 7) == 0, (wide % 3) == 0), padded)
