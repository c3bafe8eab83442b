"""Event and dividend records in JSON files.

A file's outer map and lists are opened with a typed schema that keeps each
record as its own JSON text. Records are then read field by field, which keeps
apart an absent field, a null field and the JSON type of a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.functions.normalize import (
    AMOUNT_PATTERN,
    TICKER_SUFFIX_PATTERN,
    YEAR_PATTERN,
    first_reason,
    iso_date,
    midnight_date,
    normalize_ticker,
    number,
    strip,
)
from tickerloom.schemas import DIVIDEND, SHARES
from tickerloom.sources.csv_lines import decoded

ISSUES = "array<struct<field:string,raw:string,reason:string>>"

# ---- fixed values: JSON field names -----------------------------------------
ACTION_FIELDS = (
    "id",
    "KodeEmiten",
    "TanggalPencatatan",
    "JenisTindakan",
    "JumlahSaham",
    "JumlahSahamSetelahTindakan",
)

_ACTIONS = (
    "struct<totalRecordsAllTypes:string,"
    "categories:map<string,struct<count:string,data:array<string>>>>"
)
_DIVIDENDS = "map<string,array<string>>"


def with_fields(records: DataFrame) -> DataFrame:
    """Records with their fields parsed once, as ``map<string,string>`` and as ``typed`` values.

    The map keeps an absent field apart from a null one. It is NULL when the
    record is not an object.
    """
    return records.withColumns(
        {"fields": F.from_json("raw", "map<string,string>"), "typed": F.try_parse_json("raw")}
    )


def _text(field: str) -> Column:
    """Value of a field as text: strings unquoted, numbers as written."""
    return F.col("fields")[field]


def _is_string(field: str) -> Column:
    """Whether the field holds a JSON string (numbers look alike in the map)."""
    value = F.try_variant_get("typed", f"$.{field}", "variant")
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


#: Declared counts as numbers: a text that looks like one is none.
_DECLARED = "categories map<string, struct<count: double>>, totalRecordsAllTypes double"


def _parsed_actions(files: DataFrame) -> DataFrame:
    doc = F.from_json(decoded(F.col("content")), _ACTIONS)
    return files.withColumn("doc", doc)


def action_problems(files: DataFrame) -> DataFrame:
    """Structural problems: not JSON, no categories, wrong declared counts."""
    blocks = F.map_entries("doc.categories")
    no_list = F.exists(blocks, lambda b: b["value"]["data"].isNull())
    told = F.col("declared.categories")
    wrong = F.filter(
        blocks,
        lambda b: ~F.try_element_at(told, b["key"])["count"].eqNullSafe(F.size(b["value"]["data"]).cast("double")),
    )
    total = F.aggregate(blocks, F.lit(0), lambda a, b: a + F.size(b["value"]["data"]))
    problem = (
        F.when(F.json_object_keys(decoded(F.col("content"))).isNull(), "not a valid JSON object")
        .when(F.col("doc.categories").isNull(), "expected an object with categories")
        .when(no_list, "a category has no data list")
        .when(
            F.size(wrong) > 0,
            F.concat(
                F.lit("category "),
                F.get(wrong, F.lit(0))["key"],
                F.lit(" count "),
                F.coalesce(F.get(wrong, F.lit(0))["value"]["count"], F.lit("absent")),
                F.lit(" differs from its records"),
            ),
        )
        .when(
            ~F.col("declared.totalRecordsAllTypes").eqNullSafe(total.cast("double")),
            "totalRecordsAllTypes differs from the records",
        )
    )
    return (
        _parsed_actions(files)
        .withColumn("declared", F.from_json(decoded(F.col("content")), _DECLARED))
        .select("relative_path", problem.alias("problem"))
        .filter("problem IS NOT NULL")
    )


def _shares(field: str) -> tuple[Column, Column]:
    """Share count and the reason it is unusable; a null count is allowed."""
    text, value = _text(field), F.col(f"_n_{field}")
    bad = text.isNotNull() & (value.isNull() | (value < 0) | value.try_cast(SHARES).isNull())
    reason = F.when(bad, F.concat(F.lit(f"{field}: invalid share count '"), text, F.lit("'")))
    return value.try_cast(SHARES), reason


def action_records(files: DataFrame) -> DataFrame:
    """Event records with their values, reasons and match key."""
    categories = _parsed_actions(files).select(
        "relative_path", "sha256", F.explode("doc.categories").alias("source_category", "block")
    )
    listed = categories.select(
        "relative_path",
        "sha256",
        "source_category",
        F.posexplode("block.data").alias("index", "raw"),
    )
    return with_event_values(with_fields(listed)).select(
        "relative_path",
        "sha256",
        "raw",
        "source_category",
        F.struct("source_category", "index").alias("position"),
        F.concat(
            F.lit("categories."), "source_category", F.lit(".data["), F.col("index").cast("string"), F.lit("]")
        ).alias("record_ref"),
        *[c.alias(n) for n, c in event_columns().items()],
        F.array().cast(ISSUES).alias("issues"),
    )


def with_event_values(records: DataFrame) -> DataFrame:
    """Records with what `event_columns` looks at several times, computed once in a step of its own."""
    counts = {f"_n_{f}": number(_text(f)) for f in ("JumlahSaham", "JumlahSahamSetelahTindakan")}
    return records.withColumns(
        {
            "_ticker": F.when(_is_string("KodeEmiten"), _text("KodeEmiten")),
            "_day": midnight_date(_text("TanggalPencatatan")),
            **counts,
        }
    )


def event_columns() -> dict[str, Column]:
    """Columns of one event record, from its ``fields`` and the columns of `with_event_values`."""
    ticker, when = F.col("_ticker"), F.col("_day")
    involved, bad_involved = _shares("JumlahSaham")
    after, bad_after = _shares("JumlahSahamSetelahTindakan")
    required = F.array(*[F.lit(f) for f in ACTION_FIELDS])
    missing = F.array_except(required, F.map_keys("fields"))
    reasons = first_reason(
        F.when(F.col("fields").isNull(), "record is not an object"),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing fields "), F.array_join(missing, ", "))),
        F.when(
            when.isNull(),
            F.concat(
                F.lit("unexpected date '"),
                F.coalesce(_text("TanggalPencatatan"), F.lit("None")),
                F.lit("'"),
            ),
        ),
        F.when(ticker.isNull() | (strip(ticker) == ""), "empty ticker"),
        bad_involved,
        bad_after,
    )
    # A null id or label is kept as the text None, as published upstream.
    return {
        "source_record_id": F.coalesce(_text("id"), F.lit("None")),
        "source_action_label": F.coalesce(_text("JenisTindakan"), F.lit("None")),
        "source_ticker": ticker,
        "registration_date": when,
        "shares_involved": involved,
        "shares_after": after,
        "match_key": normalize_ticker(ticker),
        "reasons": reasons,
    }


def _parsed_dividends(files: DataFrame) -> DataFrame:
    return files.withColumn("doc", F.from_json(decoded(F.col("content")), _DIVIDENDS))


def dividend_problems(files: DataFrame) -> DataFrame:
    """Structural problems: not JSON, not a map, a ticker without a list."""
    no_list = F.exists(F.map_values("doc"), lambda v: v.isNull())
    problem = (
        F.when(F.json_object_keys(decoded(F.col("content"))).isNull(), "not a valid JSON object")
        .when(F.col("doc").isNull(), "expected an object keyed by ticker")
        .when(no_list, "a ticker does not hold a list")
    )
    return (
        _parsed_dividends(files)
        .select("relative_path", problem.alias("problem"))
        .filter("problem IS NOT NULL")
    )


def dividend_records(files: DataFrame) -> DataFrame:
    """Dividend records with their values, reasons, issues and match key."""
    tickers = _parsed_dividends(files).select(
        "relative_path", "sha256", F.explode("doc").alias("source_ticker", "list")
    )
    listed = tickers.select(
        "relative_path", "sha256", "source_ticker", F.posexplode("list").alias("index", "raw")
    )
    return with_dividend_values(with_fields(listed)).select(
        "relative_path",
        "sha256",
        "raw",
        "source_ticker",
        F.struct("source_ticker", "index").alias("position"),
        F.concat("source_ticker", F.lit("["), F.col("index").cast("string"), F.lit("]")).alias("record_ref"),
        normalize_ticker(F.regexp_replace("source_ticker", TICKER_SUFFIX_PATTERN, "")).alias("match_key"),
        *[c.alias(n) for n, c in dividend_columns().items()],
    )


def optional_date(text: Column, field: str) -> tuple[Column, Column]:
    """An optional date and its issues: malformed text gives NULL and one issue."""
    date = iso_date(text)
    issue = F.when(
        text.isNotNull() & (text != "") & date.isNull(),
        F.struct(
            F.lit(field).alias("field"),
            text.alias("raw"),
            F.concat(F.lit(f"{field}: unexpected date '"), text, F.lit("'")).alias("reason"),
        ),
    )
    return date, F.array_compact(F.array(issue))


def with_dividend_values(records: DataFrame) -> DataFrame:
    """Records with what `dividend_columns` looks at several times, computed once in a step of its own."""
    amount = _text("dividend")
    ex_text = F.when(_is_string("ex_date"), _text("ex_date"))
    return records.withColumns(
        {
            "_kind": F.when(_is_string("dividend_type"), _text("dividend_type")),
            "_ex_text": ex_text,
            "_ex_date": iso_date(ex_text),
            "_amount": F.when(amount.rlike(AMOUNT_PATTERN), number_wide(amount)),
        }
    )


def dividend_columns() -> dict[str, Column]:
    """Columns of one dividend record, from its ``fields`` and the columns of `with_dividend_values`."""
    amount, year = _text("dividend"), _text("fiscal_year")
    kind, ex_text, ex_date, value = (F.col(c) for c in ("_kind", "_ex_text", "_ex_date", "_amount"))
    payment, issues = optional_date(_text("payment_date"), "payment_date")

    def reason(test: Column, label: str, text: Column) -> Column:
        return F.when(test, F.concat(F.lit(label), F.lit(" '"), F.coalesce(text, F.lit("None")), F.lit("'")))

    reasons = first_reason(
        F.when(F.col("fields").isNull(), "record is not an object"),
        reason(value.isNull() | (value <= 0), "dividend: not a positive amount", amount),
        reason(~F.coalesce(year.rlike(YEAR_PATTERN), F.lit(False)), "fiscal_year: unexpected value", year),
        reason(kind.isNull() | (kind == ""), "dividend_type: unexpected value", kind),
        reason(ex_date.isNull(), "ex_date: unexpected date", ex_text),
    )
    return {
        "ex_date": ex_date,
        "amount": value,
        "amount_basis": F.lit("unstated"),
        "currency": F.lit("IDR"),
        "dividend_type": kind,
        "fiscal_year": year.try_cast("int"),
        "payment_date": payment,
        "reasons": reasons,
        "issues": issues,
    }


def number_wide(text: Column) -> Column:
    """Amount with all 16 stored decimals."""
    return strip(text).try_cast(DIVIDEND)
