"""Per-feature quality flags, labels and the final filter: row-wise expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionsift.functions.nulls import ifelse
from ionsift.functions.text import compound_label, halogen
from ionsift.params import FEATURE_COLUMNS, Params

MASS_DEFECT_LIMIT = 0.05


def feature_table(prepared: DataFrame) -> DataFrame:
    """The distinct features of a long prepared table."""
    return prepared.select(*FEATURE_COLUMNS).distinct()


def halogen_flag(features: DataFrame) -> DataFrame:
    return features.withColumn("halogen", halogen(F.col("Compound")))


def score_mass_flags(features: DataFrame, params: Params = Params()) -> DataFrame:
    """Mass defect, missing / low score, and the weak match allowed for hard elements."""
    score, mass = F.col("Score"), F.col("Mass")
    defect = (mass - F.bround(mass, 0)) < MASS_DEFECT_LIMIT
    missing = score.isNull()
    return features.withColumns(
        {
            "NegMassDefect_Flag": defect,
            "MissingScore_Flag": missing,
            "LowScore_Flag": F.when(missing, F.lit(True)).otherwise(score < params.low_score),
            "WeakMatch_Flag": ifelse(defect & halogen(F.col("Compound")), score > params.weak_score, F.lit(False)),
        }
    )


def label() -> Column:
    return compound_label(
        F.col("Compound"), F.col("LowScore_Flag"), F.col("WeakMatch_Flag"), F.col("Mass"), F.col("RetentionTime")
    )


def relabel(flagged: DataFrame) -> DataFrame:
    """Replace names that were not accepted by the mass label."""
    return flagged.withColumn("Compound", label())


def passes() -> Column:
    """Real sample feature, above the blank, and unique or the kept one of its duplicates."""
    return (
        ~F.col("FalseSampleFeature_Flag")
        & ~F.col("BelowSpike_Flag")
        & (~F.col("Duplicate_Flag") | F.col("Duplicate_Keep_Flag"))
    )


def final_filter(processed: DataFrame) -> DataFrame:
    """Rows that pass every quality flag; an undecided flag drops the row."""
    return processed.where(passes())
