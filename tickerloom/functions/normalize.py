"""Parsing and normalisation of source text as column expressions.

Nothing here raises on bad data. A value that cannot be parsed becomes NULL, and
the row carries the reason in a ``reasons`` array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickerloom.schemas import MONEY, PRICE

# ---- fixed values: source formats -----------------------------------------
KEY_PATTERN = r"^[A-Z0-9]+\z"
TRADE_DATE_PATTERN = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[T ]00:00:00(?:\.0+)?)?\z"
ISO_DATE_PATTERN = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})\z"
MIDNIGHT_PATTERN = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})T00:00:00\z"
AMOUNT_PATTERN = r"^[0-9]+(\.[0-9]+)?\z"
YEAR_PATTERN = r"^[0-9]{4}\z"
TICKER_SUFFIX_PATTERN = r"\.JK\z"
BOM = "﻿"
#: What surrounds a cell without being part of it: ASCII and Unicode blanks.
WHITESPACE = (
    " \t\r\n\f\u000b\u001c\u001d\u001e\u001f\u0085\u00a0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
#: A fraction that is not zero, written without an exponent.
FRACTION_PATTERN = r"^[^eE.]*\.[0-9]*[1-9][^eE]*\z"

#: Most whole numbers as they are written; others are looked at more closely.
WHOLE_PATTERN = r"^[0-9]+(?:\.0*)?\z"

#: Digits before and after the point, and the exponent, of a number that has one.
EXPONENT_PATTERN = r"^[+-]?([0-9]*)\.?([0-9]*)[eE]([+-]?[0-9]{1,4})\z"

NUMBER = "decimal(38,10)"  # wide enough to test a value before it is rounded


def strip(text: Column) -> Column:
    """Text without surrounding whitespace."""
    return F.btrim(text, F.lit(WHITESPACE))


def security_id_text(prefix: str, key: Column) -> Column:
    """Development identity of a source key; NULL when the key is invalid."""
    return F.when(key.rlike(KEY_PATTERN), F.concat(F.lit(prefix), key))


def source_key(prefix: str, security_id: Column) -> Column:
    """Inverse of `security_id_text`; NULL when the id is not of this source."""
    key = F.substring(security_id, F.lit(len(prefix) + 1), F.length(security_id))
    return F.when(security_id.startswith(prefix) & key.rlike(KEY_PATTERN), key)


def _date(text: Column, pattern: str) -> Column:
    """The date in `text` when it matches and exists in the calendar.

    The pattern comes first: casting alone would accept '2024-2-1' and '2024'.
    """
    return F.regexp_extract(text, pattern, 1).try_cast("date")


def trade_date(text: Column) -> Column:
    """``YYYY-MM-DD``, optionally with a midnight time; NULL when malformed."""
    return _date(F.ltrim(strip(text), F.lit(BOM)), TRADE_DATE_PATTERN)


def iso_date(text: Column) -> Column:
    """Exactly ``YYYY-MM-DD``; NULL when malformed."""
    return _date(text, ISO_DATE_PATTERN)


def midnight_date(text: Column) -> Column:
    """Date of a ``YYYY-MM-DDT00:00:00`` timestamp; NULL for any other time."""
    return _date(text, MIDNIGHT_PATTERN)


def number(text: Column) -> Column:
    """Finite decimal in `text`, NULL when it is not one.

    Only a text that is no number as it stands is stripped and tried again.
    """
    return F.coalesce(text.try_cast(NUMBER), strip(text).try_cast(NUMBER))


def is_whole(value: Column) -> Column:
    return value == F.floor(value)


def written_fraction(text: Column) -> Column:
    """Whether a number has a fraction as it is written, however small.

    With an exponent, the digits after the moved point must all be zeros.
    """
    plain = strip(text)
    before, after, exponent = (F.regexp_extract(plain, EXPONENT_PATTERN, i) for i in (1, 2, 3))
    digits = F.concat(before, after)
    kept = F.rtrim(digits, F.lit("0"))
    moved = F.length(after) - F.coalesce(exponent.try_cast("int"), F.lit(0))
    moved_fraction = (kept != "") & (moved > F.length(digits) - F.length(kept))
    return (
        F.when(text.rlike(WHOLE_PATTERN), F.lit(False))
        .when(plain.rlike("[eE]"), moved_fraction)
        .otherwise(plain.rlike(FRACTION_PATTERN))
    )


def integer(text: Column) -> Column:
    """Whole number in `text` (``5``, ``5.0`` or ``0.5e1``), NULL otherwise.

    The text is asked as well: a fraction too small for `NUMBER` is rounded away in it.
    """
    value = number(text)
    whole = is_whole(value) & ~written_fraction(text)
    return F.when(whole, value).try_cast("bigint")


def positive_or_null(value: Column) -> Column:
    """A zero price in the source means it was not supplied."""
    return F.nullif(value, F.lit(0).cast("decimal(1,0)"))


def trading_status(volume: Column, high: Column, low: Column) -> Column:
    """Status from the regular-market volume and the published range."""
    return (
        F.when(volume > 0, "traded")
        .when((volume == 0) & (high == 0) & (low == 0), "no_regular_market_trade")
        .otherwise("unknown")
    )


def row_flags(non_regular_volume: Column | None, date: Column) -> Column:
    """Documented row flags, sorted and unique."""
    flags = [F.when(F.weekday(date) >= 5, "unverified_trading_date")]
    if non_regular_volume is not None:
        flags.insert(0, F.when(non_regular_volume > 0, "non_regular_activity_present"))
    return F.array_sort(F.array_compact(F.array(*flags)))


def merge_flag(flags: Column, flag: str) -> Column:
    """`flags` with one more flag, sorted and unique."""
    return F.array_sort(F.array_union(flags, F.array(F.lit(flag))))


def normalize_ticker(text: Column) -> Column:
    """Trimmed upper-case ticker when it is a plain code, else NULL."""
    ticker = F.upper(strip(text))
    return F.when(ticker.rlike(KEY_PATTERN), ticker)


def record_ref(path: Column, sha256: Column, line: Column) -> Column:
    """Provenance text of one source line."""
    return F.concat(path, F.lit("@sha256:"), sha256, F.lit("#line="), line.cast("string"))


def first_reason(*reasons: Column) -> Column:
    """The first problem as a one-element array, or an empty array.

    Written without `array_compact`, whose lambda would have the reasons interpreted.
    """
    found = F.coalesce(*reasons)
    return F.when(found.isNotNull(), F.array(found)).otherwise(F.array().cast("array<string>"))


def _quoted(text: Column) -> Column:
    return F.concat(F.lit("'"), F.coalesce(text, F.lit("")), F.lit("'"))


def wrong_width(cells: Column, expected: int) -> Column:
    return F.when(
        F.size(cells) != expected,
        F.concat(F.size(cells).cast("string"), F.lit(f" fields, expected {expected}")),
    )


def cell(cells: Column, header: Sequence[str], name: str) -> Column:
    """The cell under a header name, NULL when the row is too short."""
    return F.get(cells, F.lit(header.index(name)))


def _numbers(rows: DataFrame, header: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Rows with each named cell parsed once, as ``_n_<name>``.

    Later expressions use a number many times; as a column of its own it is
    computed once per row.
    """
    return rows.withColumns(
        {f"_n_{n}": number(cell(F.col("cells"), header, n)) for n in names}
    )


def _whole(name: str) -> Column:
    value = F.col(f"_n_{name}")
    return F.when(is_whole(value), value).try_cast("bigint")


def _number_reason(header: Sequence[str], name: str) -> Column:
    text = cell(F.col("cells"), header, name)
    return F.when(
        F.col(f"_n_{name}").isNull(),
        F.concat(F.lit(f"{name}="), _quoted(text), F.lit(" is not a number")),
    )


def _integer_reason(header: Sequence[str], name: str) -> Column:
    text = cell(F.col("cells"), header, name)
    fraction = ~is_whole(F.col(f"_n_{name}")) | written_fraction(text)
    return F.coalesce(
        _number_reason(header, name),
        F.when(fraction, F.concat(F.lit(f"{name}="), _quoted(text), F.lit(" is not an integer"))),
        _range_reason(header, name, "bigint"),
    )


def _range_reason(header: Sequence[str], name: str, stored: T.DataType | str) -> Column:
    """A number that the stored column cannot hold."""
    value = F.col(f"_n_{name}")
    return F.when(
        value.isNotNull() & value.try_cast(stored).isNull(),
        F.concat(
            F.lit(f"{name}="), _quoted(cell(F.col("cells"), header, name)), F.lit(" is out of range")
        ),
    )


def _stored_reason(header: Sequence[str], name: str, stored: T.DataType) -> Column:
    return F.coalesce(_number_reason(header, name), _range_reason(header, name, stored))


PRICE_NUMBERS = (
    "High", "Low", "Volume", "NonRegularVolume", "Close", "Open", "Previous", "Value", "Frequency",
)


def price_rows(rows: DataFrame, header: Sequence[str], key: str) -> DataFrame:
    """Stock rows with all normalised columns and their ``reasons``.

    A row is accepted when ``reasons`` is empty. Checks run in reading order and
    only the first failure is reported.
    """

    def raw(name: str) -> Column:
        return cell(F.col("cells"), header, name)

    parsed = _numbers(rows, header, PRICE_NUMBERS).withColumns(
        {"_date": trade_date(raw("Date")), "_ticker": strip(raw("Ticker"))}
    )
    n = {name: F.col(f"_n_{name}") for name in PRICE_NUMBERS}
    ticker, date, volume = F.col("_ticker"), F.col("_date"), _whole("Volume")
    reasons = first_reason(
        wrong_width(F.col("cells"), len(header)),
        F.when(
            (ticker != F.col(key)) & (F.upper(ticker) != F.col(key)),
            F.concat(F.lit("Ticker "), _quoted(ticker), F.lit(" does not match the file key")),
        ),
        F.when(date.isNull(), F.concat(F.lit("malformed date "), _quoted(raw("Date")))),
        _stored_reason(header, "High", PRICE),
        _stored_reason(header, "Low", PRICE),
        _integer_reason(header, "Volume"),
        _integer_reason(header, "NonRegularVolume"),
        _stored_reason(header, "Close", PRICE),
        _stored_reason(header, "Open", PRICE),
        _stored_reason(header, "Previous", PRICE),
        _stored_reason(header, "Value", MONEY),
        _integer_reason(header, "Frequency"),
    )
    return parsed.select(
        *rows.columns,
        date.alias("trading_date"),
        positive_or_null(n["Open"]).try_cast(PRICE).alias("open"),
        positive_or_null(n["High"]).try_cast(PRICE).alias("high"),
        positive_or_null(n["Low"]).try_cast(PRICE).alias("low"),
        n["Close"].try_cast(PRICE).alias("close"),
        positive_or_null(n["Previous"]).try_cast(PRICE).alias("reference_price"),
        volume.alias("volume"),
        n["Value"].try_cast(MONEY).alias("value"),
        _whole("Frequency").alias("frequency"),
        trading_status(volume, n["High"], n["Low"]).alias("trading_status"),
        row_flags(_whole("NonRegularVolume"), date).alias("quality_flags"),
        reasons.alias("reasons"),
    )


# ---- fixed value: tolerance of the published index change -------------------
CHANGE_TOLERANCE = "0.001"


INDEX_NUMBERS = (
    "Previous", "Highest", "Lowest", "Close", "Change", "Constituent", "Volume", "Value",
    "Frequency", "Capitalization",
)


def index_rows(rows: DataFrame, header: Sequence[str]) -> DataFrame:
    """Index rows with all normalised columns and their ``reasons``."""
    raw_date = cell(F.col("cells"), header, "Date")
    parsed = _numbers(rows, header, INDEX_NUMBERS).withColumn("_date", iso_date(raw_date))
    n = {name: F.col(f"_n_{name}") for name in INDEX_NUMBERS}
    previous, high, low, close = (n[x] for x in ("Previous", "Highest", "Lowest", "Close"))
    date = F.col("_date")
    unreadable = F.coalesce(
        wrong_width(F.col("cells"), len(header)),
        F.when(
            date.isNull(), F.concat(F.lit("Date="), _quoted(raw_date), F.lit(" is not YYYY-MM-DD"))
        ),
        *[_number_reason(header, x) for x in ("Previous", "Highest", "Lowest", "Close", "Change")],
    )
    problems = F.array_compact(
        F.array(
            F.when(F.least(previous, high, low, close) <= 0, "non_positive_value"),
            F.when(high < low, "high_below_low"),
            F.when((close < low) | (close > high), "close_outside_high_low"),
            F.when(
                F.abs(close - previous - n["Change"]) > F.lit(CHANGE_TOLERANCE).cast("decimal(4,3)"),
                "change_differs_from_close_minus_previous",
            ),
        )
    )
    later = first_reason(
        *[_range_reason(header, x, PRICE) for x in ("Previous", "Highest", "Lowest", "Close")],
        _integer_reason(header, "Constituent"),
        _range_reason(header, "Constituent", "int"),
        _integer_reason(header, "Volume"),
        _stored_reason(header, "Value", MONEY),
        _integer_reason(header, "Frequency"),
        _stored_reason(header, "Capitalization", MONEY),
    )
    staged = parsed.withColumns({"_unreadable": unreadable, "_problems": problems})
    reasons = (
        F.when(F.col("_unreadable").isNotNull(), F.array("_unreadable"))
        .when(F.size("_problems") > 0, F.col("_problems"))
        .otherwise(later)
    )
    return staged.select(
        *rows.columns,
        date.alias("trading_date"),
        previous.try_cast(PRICE).alias("previous"),
        high.try_cast(PRICE).alias("high"),
        low.try_cast(PRICE).alias("low"),
        close.try_cast(PRICE).alias("close"),
        _whole("Constituent").try_cast("int").alias("constituents"),
        _whole("Volume").alias("volume"),
        n["Value"].try_cast(MONEY).alias("value"),
        _whole("Frequency").alias("frequency"),
        n["Capitalization"].try_cast(MONEY).alias("capitalization"),
        row_flags(None, date).alias("quality_flags"),
        reasons.alias("reasons"),
    )
