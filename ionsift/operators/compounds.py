"""The list of compound names handed to an outside lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionsift.functions.text import named


def unique_compounds(df: DataFrame) -> DataFrame:
    """Distinct real names of each experiment, cut before the first blank that is followed by a digit."""
    return (
        df.where(named(F.col("Compound")))
        .select("ExpID", F.regexp_replace("Compound", r"(?s)\s[0-9].*", "").alias("Compound"))
        .distinct()
    )
