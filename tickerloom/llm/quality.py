"""Operator 9, quality rules: adaptive thresholds from mergeable quantile sketches.

Native: every step is a DataFrame or SQL function, no Python runs on executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.plans.durable import durable

BLANKS = r"[\x20\x09-\x0D]+"
WINDOW = 8
SALTS = 16
SKETCH_K = 400


#: Groups with fewer rows take the quantiles of all rows of their language, their own included.
SMALL = 30


@dataclass(frozen=True)
class Rule:
    """Reject a value above ``upper quartile + reach * spread`` of its group.

    The spread is the wider of the two quarters beside the median, so junk in up to a
    quarter of a group does not move the threshold, but no less than one `event` in the
    group's median text: where most texts have none, `reach` events are its limit. An
    event is so many words or lines, or one word as long as the measure's median. With `both`, a value below ``lower quartile - reach * spread`` goes too.
    """

    measure: str
    reach: float
    event: float | str
    size: str
    both: bool = False


RULES = (
    Rule("symbols_per_word", 6.0, 1.0, "n_words"),
    Rule("dup_line_share", 3.0, 1.0, "n_lines"),
    Rule("repeat_share", 3.0, 2.0 * WINDOW, "n_words"),
    Rule("word_length", 6.0, "word_length", "n_words", both=True),
)


def _measures(text: Column) -> list[dict[str, Column]]:
    """Counts of a text, in steps so that no array is computed twice."""
    hashes = F.transform(
        F.sequence(F.lit(1), F.col("n_words") - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice("words", i, F.lit(WINDOW))),
    )
    none = F.array().cast("array<bigint>")
    indexed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    gap = F.zip_with("again", F.slice("again", F.lit(2), F.size("again")), lambda a, b: b - a)
    repeated = F.filter(
        F.zip_with(
            "indexed",
            F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.col("indexed")),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
        ),
        lambda p: p.isNotNull(),
    )
    return [
        {
            "words": F.array_remove(F.split(text, BLANKS), ""),
            "lines": F.filter(
                F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
            ),
            "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint"),
        },
        {
            "n_words": F.size("words"),
            "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
            "n_lines": F.size("lines").cast("bigint"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        },
        {"windows": F.when(F.col("n_words") >= WINDOW, hashes).otherwise(none)},
        {"repeats": F.size(F.array_distinct("windows")) < F.size("windows")},
        {"indexed": F.when(F.col("repeats"), indexed)},
        {"again": F.sort_array(F.array_distinct(F.flatten(repeated)))},
        {
            "n_repeat_words": F.when(
                F.col("repeats"),
                F.lit(WINDOW)
                + F.aggregate(
                    gap,
                    F.lit(0),
                    lambda total, g: total + F.least(F.coalesce(g, F.lit(0)), F.lit(WINDOW)),
                ),
            )
            .otherwise(0)
            .cast("bigint")
        },
    ]


def measured(docs: DataFrame) -> DataFrame:
    """One row per document: key columns, counts, shares and the fixed base verdict."""
    rows = docs.select(
        "doc_id",
        "lang",
        "source",
        F.xxhash64("text").alias("text_hash"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    for step in _measures(F.col("text")):
        rows = rows.withColumns(step)
    words = F.greatest(F.col("n_words"), F.lit(1))
    return rows.select(
        "doc_id",
        "lang",
        "source",
        "text_hash",
        F.col("n_words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("n_symbols") / words).alias("symbols_per_word"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_line_share"),
        (F.col("n_repeat_words") / words).alias("repeat_share"),
        (F.col("word_chars") / words).alias("word_length"),
        (
            (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
        ).alias("base_failed"),
    )


def thresholds(rows: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per language and source the thresholds of each rule, from merged KLL sketches.

    Sketches are built per (language, source, salt) and merged, so that a source with
    a third of all rows is spread over tasks. Only rows that pass the base rules count.
    """
    kept = rows.where(~F.col("base_failed")).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS))
    )
    names = sorted({name for r in rules for name in (r.measure, r.size)})
    part = kept.groupBy("lang", "source", "salt").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(SKETCH_K)).alias(c) for c in names],
    )
    own = durable(
        part.groupBy("lang", "source").agg(
            F.sum("n").alias("n"), *[F.kll_merge_agg_double(c).alias(c) for c in names]
        )
    )
    whole = own.groupBy(F.col("lang").alias("_lang")).agg(
        *[F.kll_merge_agg_double(c).alias(f"{c}_whole") for c in names]
    )
    merged = own.join(whole, F.col("lang").eqNullSafe(F.col("_lang"))).select(
        "lang",
        "source",
        *[F.when(F.col("n") < SMALL, F.col(f"{c}_whole")).otherwise(F.col(c)).alias(c) for c in names],
    )

    def limits(r: Rule) -> list[Column]:
        at = lambda c, q: F.kll_sketch_get_quantile_double(c, F.lit(q))
        low, middle, high = (at(r.measure, q) for q in (0.25, 0.5, 0.75))
        event = at(r.event, 0.5) if isinstance(r.event, str) else F.lit(r.event)
        event = event / F.greatest(at(r.size, 0.5), F.lit(1.0))
        reach = r.reach * F.greatest(high - middle, middle - low, event)
        out = [(high + reach).alias(f"{r.measure}_limit")]
        return [*out, (low - reach).alias(f"{r.measure}_floor")] if r.both else out

    return merged.select("lang", "source", *[c for r in rules for c in limits(r)])


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every document with its counts, its group's thresholds and ``kept``.

    Null or empty text has no words and fails the base rules. Null language or source
    is a group of its own. Repeated rows are judged alike. A group whose rows all fail
    the base rules has no thresholds, and needs none. An empty table gives no rows.
    Other columns of `docs` are not read and cannot clash.
    """
    rows = durable(measured(docs))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    limits = thresholds(rows, rules).select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        salts,
        *[f"{r.measure}_limit" for r in rules],
        *[f"{r.measure}_floor" for r in rules if r.both],
    )
    salted = rows.withColumn("_salt_of", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)))
    joined = salted.join(
        limits,
        F.col("lang").eqNullSafe(F.col("_lang"))
        & F.col("source").eqNullSafe(F.col("_source"))
        & (F.col("_salt_of") == F.col("_salt")),
        "left",
    )
    fits = F.lit(True)
    for r in rules:
        fits = fits & (F.col(r.measure) <= F.col(f"{r.measure}_limit"))
        if r.both:
            fits = fits & (F.col(r.measure) >= F.col(f"{r.measure}_floor"))
    kept = ~F.col("base_failed") & F.coalesce(fits, F.lit(False))
    return joined.withColumn("kept", kept).drop("n_lines", "_lang", "_source", "_salt", "_salt_of")


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with all their columns.

    Rejected ones are named by id and text hash; repeated rows go or stay together.
    """
    bad = (
        judged(docs, rules)
        .where(~F.col("kept"))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
        .distinct()
    )
    same = F.xxhash64(docs["text"]) == bad["_hash"]
    return docs.join(bad, same & docs["doc_id"].eqNullSafe(bad["_id"]), "left_anti")
