"""Data-quality reports, each in one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwell.functions.bands import first_match
from brightwell.functions.numbers import percent, round_half_up
from brightwell.functions.strings import is_blank
from brightwell.operators.relational import metric_rows


def null_profile(df: DataFrame, required: Sequence[str], event: Column | None = None,
                 date: str | None = None) -> DataFrame:
    """Rows, NULLs per required column, rate of an event and range of a date."""
    columns = [F.count(F.lit(1)).alias("total_records")]
    columns += [F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in required]
    if event is not None:
        columns += [F.count_if(event).alias("event_count"),
                    percent(F.count_if(event), F.count(F.lit(1)), 2).alias("event_rate")]
    if date is not None:
        columns += [F.count_if(F.col(date).isNull()).alias("null_dates"),
                    F.min(date).alias("min_date"), F.max(date).alias("max_date")]
    return df.agg(*columns)


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(metric, value) rows: all records, then the rows that break each rule."""
    metrics = {"Total Records": F.count(F.lit(1))}
    metrics |= {name: F.count_if(F.coalesce(rule, F.lit(False))) for name, rule in rules.items()}
    return metric_rows(df, metrics)


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: records, filled records and the share in per cent."""
    counts = df.agg(F.count(F.lit(1)).alias("__all"),
                    *[F.count(name).alias(f"n{i}") for i, name in enumerate(columns)])
    rows = F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col("__all").alias("total_records"),
                 F.col(f"n{i}").alias("non_null_records"),
                 percent(F.col(f"n{i}"), F.col("__all"), 2).alias("completeness_pct"))
        for i, name in enumerate(columns)])
    return counts.select(F.inline(rows))


def row_score(columns: Sequence[str]) -> Column:
    """Per cent of the columns that are neither NULL nor blank."""
    filled = sum((F.when(is_blank(F.col(name)), 0).otherwise(1) for name in columns), F.lit(0))
    return round_half_up(filled.cast("double") * 100 / len(columns))


def row_status(rules: Sequence[tuple[Column, str]], valid: str = "Valid") -> Column:
    """The message of the first broken rule."""
    return first_match([(F.coalesce(rule, F.lit(False)), label) for rule, label in rules], valid)


def status_counts(df: DataFrame, rules: Sequence[tuple[Column, str]],
                  name: str = "validation_status") -> DataFrame:
    return df.groupBy(row_status(rules).alias(name)).agg(F.count(F.lit(1)).alias("count"))


def parse_rate(df: DataFrame, parsed: Column) -> DataFrame:
    """How many values an expression could parse."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), F.count(parsed).alias("parsed_records"),
        percent(F.count(parsed), F.count(F.lit(1)), 2).alias("success_rate"))


def reconcile(df: DataFrame, keys: Sequence[str], left: Column, right: Column) -> DataFrame:
    """Do two ways of computing an aggregate agree? Groups by outcome."""
    both = df.groupBy(*keys).agg(left.alias("l"), right.alias("r"))
    outcome = F.when(F.col("l").eqNullSafe(F.col("r")), "Match").otherwise("Mismatch")
    return both.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("groups"))
