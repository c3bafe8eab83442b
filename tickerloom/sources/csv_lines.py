"""CSV files as arrays of records with physical line numbers.

Spark's CSV reader drops blank lines and surplus fields and has no line numbers,
all of which matter here, so files are split with string functions. A file in
which a quoted field spans lines is parsed by Python's csv module instead; all
other files reach that function as NULL.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORDS = T.ArrayType(
    T.StructType(
        [
            T.StructField("line", T.IntegerType()),
            T.StructField("cells", T.ArrayType(T.StringType())),
        ]
    )
)
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
_WELL_FORMED = f"^{_FIELD}(?:,{_FIELD})*+$"
_TOKEN = f"(?:^|,){_FIELD}"


@F.pandas_udf(RECORDS)
def _multiline_records(texts: pd.Series) -> pd.Series:
    def parse(text):
        if text is None:
            return None
        reader = csv.reader(io.StringIO(text, newline=""))
        return [{"line": reader.line_num, "cells": cells} for cells in reader]

    return texts.map(parse)


def decoded(content: Column) -> Column:
    """File text without a byte-order mark; NULL when it is not valid UTF-8."""
    text = F.try_validate_utf8(content.cast("string"))
    return F.regexp_replace(text, "^﻿", "")


def _tokens(line: Column) -> Column:
    """The fields of a line with quotes, each but the first with the comma before it."""
    return F.regexp_extract_all(line, F.lit(_TOKEN), F.lit(0))


def _unquoted(tokens: Column) -> Column:
    def unquote(i_token: Column, i: Column) -> Column:
        # The first token has no leading comma, even when the field is empty.
        field = F.when(i == 0, i_token).otherwise(F.substring(i_token, F.lit(2), F.length(i_token)))
        inner = F.substring(field, F.lit(2), F.length(field) - 2)
        plain = F.when(field.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field)
        # Few fields of such a line are quoted themselves.
        return F.when(F.contains(i_token, F.lit('"')), plain).otherwise(field)

    return F.transform(tokens, unquote)


def _cells(line: Column) -> Column:
    return (
        F.when(line == "", F.array().cast("array<string>"))
        .when(F.contains(line, F.lit('"')), _unquoted(_tokens(line)))
        .otherwise(F.split(line, ","))
    )


def _with_lines(files: DataFrame) -> DataFrame:
    """Add ``_text``, its physical ``_lines``, and ``_spanning``.

    ``_spanning`` is the text again when some quoted field spans lines, else NULL.
    The end of the last line is not a line of its own. Each step is a column, so
    it runs once per file however often it is used.
    """
    newline = F.lit("\n")
    # One kind of line end, so that the split is by a character and not by a pattern.
    plain = F.replace(F.replace(F.col("_text"), F.lit("\r\n"), newline), F.lit("\r"), newline)
    lined = files.withColumn("_text", decoded(F.col("content"))).withColumn(
        "_lines", F.split(F.regexp_replace(plain, r"\n\z", ""), "\n")
    )
    quote = F.lit('"')
    spans = F.exists("_lines", lambda s: F.contains(s, quote) & ~s.rlike(_WELL_FORMED))
    return lined.withColumn(
        "_spanning", F.when(F.contains("_text", quote), F.when(spans, F.col("_text")))
    )


def with_records(files: DataFrame) -> DataFrame:
    """Add ``records``, all records of a file: ``array<struct<line, cells>>``.

    The header is included and a blank line is a record without cells. NULL when
    the content is not valid UTF-8.
    """
    simple = F.transform(
        "_lines",
        lambda s, i: F.struct((i + 1).cast("int").alias("line"), _cells(s).alias("cells")),
    )
    return (
        _with_lines(files)
        .withColumn("records", F.coalesce(_multiline_records("_spanning"), simple))
        .drop("_text", "_lines", "_spanning")
    )


def with_heads(files: DataFrame, first: int) -> DataFrame:
    """Add ``header`` and ``heads``: the cells of the first record, the starts of all records.

    ``heads`` is ``array<struct<line, width, cells>>`` with the `first` cells of each record,
    so that no file is held a second time as cells. Both are NULL when the content is not
    valid UTF-8.
    """

    def head(line: Column, fields: Column, cells: Callable[[Column], Column] = lambda c: c) -> Column:
        # An array of one lets the fields be split once, however often they are looked at.
        one = F.transform(
            F.array(fields),
            lambda f: F.struct(
                line.cast("int").alias("line"), F.size(f).alias("width"), cells(F.slice(f, 1, first)).alias("cells")
            ),
        )
        return F.get(one, F.lit(0))

    def of_line(s: Column, i: Column) -> Column:
        return (
            F.when(s == "", head(i + 1, F.array().cast("array<string>")))
            .when(F.contains(s, F.lit('"')), head(i + 1, _tokens(s), _unquoted))
            .otherwise(head(i + 1, F.split(s, ",")))
        )

    parsed = _with_lines(files).withColumn("_parsed", _multiline_records("_spanning"))
    return parsed.withColumns(
        {
            "header": F.coalesce(F.get("_parsed", F.lit(0))["cells"], _cells(F.get("_lines", F.lit(0)))),
            "heads": F.when(
                F.col("_parsed").isNotNull(), F.transform("_parsed", lambda r: head(r["line"], r["cells"]))
            ).otherwise(F.transform("_lines", of_line)),
        }
    ).drop("_text", "_lines", "_spanning", "_parsed")


def exploded_records(files: DataFrame, *keep: Column | str) -> DataFrame:
    """One row ``(*keep, line, cells)`` per record of every file.

    Lines are exploded as text and split into cells afterwards, in generated code
    rather than inside an array function.
    """
    prepared = _with_lines(files).select(*keep, "_lines", "_spanning")
    names = [c for c in prepared.columns if c not in ("_lines", "_spanning")]
    parsed = prepared.withColumn("_parsed", _multiline_records("_spanning"))
    # One explode serves both kinds of file: lines as text, or parsed records.
    staged = parsed.withColumns(
        {
            "text": F.when(F.col("_parsed").isNull(), F.col("_lines")).otherwise(F.array().cast("array<string>")),
            "rec": F.coalesce("_parsed", F.array().cast(RECORDS)),
        }
    )
    slots = F.arrays_zip("text", "rec")
    return staged.select(*names, F.posexplode(slots).alias("_i", "_s")).select(
        *names,
        F.coalesce("_s.rec.line", F.col("_i") + 1).alias("line"),
        F.coalesce("_s.rec.cells", _cells(F.col("_s.text"))).alias("cells"),
    )


def data_rows(records: Column) -> Column:
    """Records after the header."""
    return F.greatest(F.size(records) - 1, F.lit(0))


def with_data_row_count(files: DataFrame) -> DataFrame:
    """Add ``row_count``, the records after the header, without splitting cells.

    Bytes that are no UTF-8 are replaced, as they do not matter for a count.
    """
    records = F.coalesce(F.size(_multiline_records("_spanning")), F.size("_lines"))
    lenient = F.make_valid_utf8(F.col("content").cast("string")).cast("binary")
    return (
        _with_lines(files.withColumn("content", lenient))
        .withColumn("row_count", F.greatest(records - 1, F.lit(0)))
        .drop("_text", "_lines", "_spanning")
    )
