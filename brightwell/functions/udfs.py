"""User-defined functions for DataFrames and SQL.

The native forms in ``bands`` and ``strings`` are the ones to use on large
tables. The functions here show the same rules as Arrow-batched Python UDFs,
for callers who need to plug in Python code; they run per Arrow batch on the
executors and never see the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from brightwell.functions.bands import first_match
from brightwell.functions.strings import CATEGORY_PATTERNS, is_blank, strip


@F.pandas_udf(StringType())
def standard_category_udf(text: pd.Series) -> pd.Series:
    """Same rules as ``strings.standard_category``, one Arrow batch at a time."""
    cleaned = text.fillna("").str.strip().str.lower()
    result = pd.Series("Unknown", index=text.index, dtype=object)
    for pattern, label in reversed(CATEGORY_PATTERNS):
        result[cleaned.str.contains(pattern, regex=True)] = label
    return result


@F.pandas_udf(StringType())
def response_summary_udf(age: pd.Series, category: pd.Series, place: pd.Series) -> pd.Series:
    """``<category> aged <age> from <place>``, or a fixed text when a part is missing.

    As in Python truth tests, zero and empty text count as missing.
    """
    complete = age.fillna(0).ne(0) & category.fillna("").ne("") & place.fillna("").ne("")
    summary = (category.astype(str) + " aged " + age.fillna(0).astype("int64").astype(str)
               + " from " + place.astype(str))
    return summary.where(complete, "Incomplete Response")


@F.udf(StringType(), useArrow=True)
def age_group_udf(age: str | None) -> str:
    """Scalar UDF form of ``bands.age_group`` for SQL callers."""
    try:
        years = int(age)
    except (TypeError, ValueError):
        return "Unknown"
    for limit, label in ((18, "Minor"), (25, "Young Adult"), (35, "Adult"),
                         (50, "Middle-aged"), (65, "Senior")):
        if years < limit:
            return label
    return "Elderly"


SQL_FUNCTIONS: dict[str, Callable] = {
    "standard_category_udf": standard_category_udf,
    "response_summary_udf": response_summary_udf,
    "age_group_udf": age_group_udf,
}


def register_all(spark: SparkSession) -> list[str]:
    """Make the functions callable from SQL text; returns their names."""
    for name, function in SQL_FUNCTIONS.items():
        spark.udf.register(name, function)
    return sorted(SQL_FUNCTIONS)


def registered_functions(spark: SparkSession, containing: str = "udf") -> list[str]:
    """Names in the function catalogue that contain a text."""
    return sorted(f.name for f in spark.catalog.listFunctions() if containing in f.name.lower())


def response_summary(age: Column, category: Column, place: Column) -> Column:
    """Native form of ``response_summary_udf``."""
    missing = age.isNull() | (age == 0) | F.coalesce(category, F.lit("")).eqNullSafe("") \
        | F.coalesce(place, F.lit("")).eqNullSafe("")
    return F.when(missing, "Incomplete Response").otherwise(
        F.concat(category, F.lit(" aged "), age.cast("string"), F.lit(" from "), place))


def quality_grade(category: Column, age: Column, place: Column) -> Column:
    """Grade of a three-field record by the share of usable fields.

    Three fields give 0, 33, 67 or 100 per cent, so "Good" cannot occur; the
    limits are kept so that the grade scale stays comparable.
    """
    usable = (F.when(~is_blank(category), 1).otherwise(0)
              + F.when(age.isNotNull() & (age > 0) & (age < 120), 1).otherwise(0)
              + F.when(F.length(strip(place)) > 1, 1).otherwise(0))
    return first_match([(usable * 100 >= 300, "Excellent"), (usable * 100 >= 225, "Good"),
                        (usable * 100 >= 150, "Fair")], "Poor")


def apply_where_present(df: DataFrame, column: str, function: Callable[[Column], Column],
                        output: str, missing: str = "No Data") -> DataFrame:
    """``missing`` for NULL, the function elsewhere. Spark runs a Python function on
    every row, whatever condition stands around it, so it must bear NULL."""
    value = F.col(column)
    return df.withColumn(output, F.when(value.isNotNull(), function(value)).otherwise(missing))
