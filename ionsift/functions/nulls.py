"""Column helpers with the source domain's missing-value rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from ionsift.params import NULL_TOKENS


def known(value: Column) -> Column:
    """NaN becomes NULL, so that NULL is the only missing value downstream."""
    return F.when(~F.isnan(value), value)


def ifelse(condition: Column, yes, no) -> Column:
    """Two-armed choice; an undecided condition gives NULL, unlike ``otherwise``."""
    return F.when(condition, yes).when(~condition, no)


def is_true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def clamp0(value: Column) -> Column:
    """Negative becomes 0, NULL stays NULL (``greatest`` would skip the NULL)."""
    return F.when(value < 0, F.lit(0.0)).when(value >= 0, value)


def text_or_na(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("NA"))


def max_if_complete(value: Column) -> Column:
    """Maximum of a group, NULL as soon as one member is NULL."""
    return F.when(~F.bool_or(value.isNull()), F.max(value))


def null_tokens(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Text cells holding a no-value token become NULL, all columns in one projection."""
    wanted = set(columns or [f.name for f in df.schema if isinstance(f.dataType, StringType)])
    return df.select(
        *[
            F.when(~F.trim(F.col(f"`{c}`")).isin(*NULL_TOKENS), F.col(f"`{c}`")).alias(c)
            if c in wanted
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def zero_to_null(df: DataFrame) -> DataFrame:
    """Cells equal to 0 (number or text) become NULL; booleans and others stay."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, BooleanType):
            out.append(c)
        elif isinstance(f.dataType, NumericType):
            out.append(F.nullif(c, F.lit(0).cast(f.dataType)).alias(f.name))
        elif isinstance(f.dataType, StringType):
            out.append(F.nullif(c, F.lit("0")).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
