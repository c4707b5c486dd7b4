"""Between long rows and one row per feature with a column per sample and measure."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionsift.params import FEATURE, MEASURES

# A sample column is five parts joined by "_": experiment, mode, mode detail, sample, replicate.
SAMPLE_COLUMN = r"^[^_]+(_[^_]+){4}$"
PARTS = ["ExpID", "IonMode", "ModeDetail", "SampleDetail", "Rep"]
MISSING_VOLUME = 1


def split_measure_name(df: DataFrame, column: str) -> DataFrame:
    """Cut a five-part name into its fields; missing parts are NULL, further ones dropped."""
    parts = F.split(F.col(column), "_")
    return df.withColumns({name: F.get(parts, F.lit(i)) for i, name in enumerate(PARTS)})


def sample_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if re.match(SAMPLE_COLUMN, c)]


def melt_measures(wide: DataFrame, blank_names: tuple[str, ...], columns: list[str] | None = None) -> DataFrame:
    """One row per feature and sample column, with the fields of the column's name.

    The names are cut here, once per column, and enter the plan as constants. A volume of 1
    stands for a missing value, and blank samples all become ``Blank``.
    """
    columns = columns or sample_columns(wide)
    rest = [F.col(f"`{c}`") for c in wide.columns if c not in columns]
    cells = []
    for c in columns:
        fields = dict(zip(PARTS, (c.split("_") + [None] * 5)[:5]))
        if fields["SampleDetail"] in blank_names:
            fields["SampleDetail"] = "Blank"
        cells += [F.lit(fields[p]).cast("string") for p in PARTS] + [F.col(f"`{c}`").cast("double")]
    volume = F.when(F.col("volume") != MISSING_VOLUME, F.col("volume"))
    return wide.select(*rest, F.stack(F.lit(len(columns)), *cells).alias(*PARTS, "volume")).withColumn("volume", volume)


def sample_names(long: DataFrame) -> list[str]:
    """The samples of a run, sorted: they become columns, so they fit in a list."""
    names = long.select("SampleDetail").where(F.col("SampleDetail").isNotNull()).distinct()
    return sorted(r[0] for r in names.collect())


def column_label(sample: str) -> str:
    """A sample as the start of a column name: odd characters to dots, no leading digit."""
    clean = re.sub(r"[^0-9A-Za-z_.]", ".", sample)
    return f"X{clean}" if clean[:1].isdigit() else clean


def wide_measures(long: DataFrame, samples: list[str]) -> DataFrame:
    """One row per feature with ``<sample>_<measure>`` columns, in sample then measure order.

    Rows of a feature that are already together (by feature and part) are folded there, and only
    one wide row per feature and part is shuffled. A sample that is not in the list ends the run: it
    would be lost from the table.
    """
    sample = F.col("SampleDetail")
    unknown = F.raise_error(F.concat(F.lit("sample not in the list of samples: "), sample))
    long = long.withColumn("SampleDetail", F.when(sample.isNull() | sample.isin(*samples), sample).otherwise(unknown))
    in_parts = FEATURE + [c for c in ("_part",) if c in long.columns]
    folded = (
        long.groupBy(*in_parts)
        .pivot("SampleDetail", samples)
        .agg(*[F.max(m).alias(m) for m in MEASURES])
    )
    names = [f"{s}_{m}" for s in samples for m in MEASURES]
    labels = [f"{column_label(s)}_{m}" for s in samples for m in MEASURES]
    if in_parts == FEATURE:
        return folded.select(*FEATURE, *[F.col(f"`{n}`").alias(x) for n, x in zip(names, labels)])
    return folded.groupBy(*FEATURE).agg(*[F.max(f"`{n}`").alias(x) for n, x in zip(names, labels)])


def columns_like(df: DataFrame, text: str) -> list[str]:
    """Column names containing a text, whatever the case."""
    return [c for c in df.columns if text.lower() in c.lower()]


def unite(df: DataFrame, name: str, columns: list[str], sep: str = "_") -> DataFrame:
    """Join columns to one text column, NULL shown as ``NA``."""
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")) for c in columns]
    return df.withColumn(name, F.concat_ws(sep, *cells)).drop(*columns)
