"""Classifying the result of an outside chemistry lookup and joining it to features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionsift.functions.nulls import ifelse, max_if_complete, text_or_na
from ionsift.functions.text import to_number
from ionsift.operators.skew import balanced_join, heavy_keys, with_group
from ionsift.params import Params
from ionsift.session import settle_and_watch

# Columns of the lookup result.
ACTIVITY = "TOXCAST___ACTIVE"
EXPOSURE = "EXPOCAST_MEDIAN_EXPOSURE_PREDICTION_MG_KG_BW_DAY"
SOURCES = "DATA_SOURCES"


def _number(df: DataFrame, name: str):
    return to_number(F.col(name)) if dict(df.dtypes)[name] == "string" else F.col(name).cast("double")


def source_ratio(lookup: DataFrame, params: Params = Params()) -> DataFrame:
    """Each candidate's number of sources relative to the best of its input.

    One unknown count leaves the whole input undecided.
    """
    # A text file would be parsed again for each reader.
    counted, seen = settle_and_watch(lookup.withColumn("_s", _number(lookup, SOURCES)))
    best = with_group(
        counted, ["INPUT"], counted.columns, params.rows_per_task, seen["rows"], _best=max_if_complete(F.col("_s"))
    )
    return best.withColumn("DataSourceRatio", F.try_divide("_s", "_best")).drop("_s", "_best")


def chem_classify(lookup: DataFrame, params: Params = Params()) -> DataFrame:
    """Category by available evidence, class by sources, exposure decade, scaled activity."""
    activity, exposure = _number(lookup, ACTIVITY), _number(lookup, EXPOSURE)
    rated = source_ratio(lookup, params)
    return (
        rated.withColumn("Category", F.when(activity.isNull() | exposure.isNull(), "B").otherwise("A"))
        .withColumn("Category_Number", ifelse(F.col("DataSourceRatio") == 1, F.lit(1), F.lit(2)))
        .withColumn("Compound_Classification", F.concat("Category", text_or_na(F.col("Category_Number"))))
        # No exposure has no decade: NULL for that row only.
        .withColumn("ExposureCategory", F.when(exposure > 0, 9 + F.ceil(F.log10(exposure)).cast("double")))
        .withColumn("Tox21_Activities", activity / 100)
    )


def chem_lookup(
    rows: DataFrame, classified: DataFrame, params: Params = Params(), at_most: int | None = None
) -> DataFrame:
    """Every row with every candidate of its compound; rows without one stay.

    A compound carried by very many rows is cut into parts. The result is as large as the
    candidates make it.
    """
    counts = rows.groupBy("Compound").agg(F.count(F.lit(1)).alias("_n"))
    heavy = heavy_keys(counts, ["Compound"], "_n", params.rows_per_task, at_most)
    by = [c for c in ("ExpID", "IonMode", "Mass", "RetentionTime", "Score") if c in rows.columns]
    return balanced_join(rows, classified.withColumnRenamed("INPUT", "Compound"), ["Compound"], heavy, by)
