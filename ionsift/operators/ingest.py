"""From wide exports to features and long abundance rows."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ionsift.functions.text import annotation_score, before
from ionsift.operators.quality import feature_table
from ionsift.operators.skew import number_rows
from ionsift.operators.wide import SAMPLE_COLUMN, melt_measures, sample_columns
from ionsift.params import CONTRACT, FEATURE, FEATURE_COLUMNS, Params
from ionsift.session import settle
from ionsift.sources.readers import Layout, as_table, layouts, numbers
from ionsift.sources.records import COMMENT_LINES

ABUNDANCE_COLUMNS = FEATURE + ["ModeDetail", "SampleDetail", "Rep", "volume"]


@dataclass
class Prepared:
    """Features once, and their volumes as long rows."""

    features: DataFrame
    abundance: DataFrame

    def long(self) -> DataFrame:
        """The documented twelve-column input table."""
        on = [self.features[c] == self.abundance[c] for c in FEATURE]
        joined = self.abundance.join(self.features, on, "left").drop(*[self.features[c] for c in FEATURE])
        return joined.select(*CONTRACT)


def feature_number(df: DataFrame, groups: list[str]) -> DataFrame:
    """Number the features of each source by mass, then time; missing ones last.

    Ties are broken by the remaining feature columns, so the numbers do not depend on file order.
    """
    time = "Retention Time" if "Retention Time" in df.columns else "RetentionTime"
    order = [F.col("Mass").asc_nulls_last(), F.col(f"`{time}`").asc_nulls_last()]
    order += [F.col(c).asc_nulls_last() for c in ("Compound", "Annotations", "Frequency", "Score") if c in df.columns]
    return number_rows(df, groups, order, "FeatureNumber")


def score_extract(df: DataFrame, column: str = "Annotations") -> DataFrame:
    return df.withColumn("Score", annotation_score(F.col(column)))


def _clean(raw: DataFrame, samples: list[str]) -> DataFrame:
    """Numbered features of a wide export with their ``source`` and sample columns."""
    typed = numbers(raw, ["Mass", "Retention Time", "Frequency", *samples])
    numbered = feature_number(typed, ["source"])
    return score_extract(numbered).select(
        "source",
        "FeatureNumber",
        "Mass",
        F.col("`Retention Time`").alias("RetentionTime"),
        before(F.col("Compound"), " Esi").alias("Compound"),
        "Score",
        F.col("Frequency").cast("long").alias("Frequency"),
        *[F.col(f"`{c}`") for c in samples],
    )


def prepare(raw: DataFrame, params: Params = Params(), offsets: DataFrame | None = None) -> Prepared:
    """Number, clean and melt a wide export with a ``source`` column.

    Features are taken before melting, so no distinct over the long rows is needed. ``offsets`` (``source``, ``ExpID``,
    ``IonMode``, ``offset``) moves the numbers of a file's features in a dataset that other files hold as well.
    """
    samples = sample_columns(raw)
    clean = _clean(raw, samples)
    datasets = sorted(_datasets(samples))
    keys = F.array(*[F.struct(F.lit(e).alias("ExpID"), F.lit(m).alias("IonMode")) for e, m in datasets])
    features = clean.withColumn("_d", F.explode(keys)).select("*", "_d.*")
    long = melt_measures(
        clean.select("source", "FeatureNumber", *[F.col(f"`{c}`") for c in samples]), params.blank_names, samples
    )
    if offsets is not None:
        features, long = _moved(features, offsets), _moved(long, offsets)
    return Prepared(features.select(*FEATURE_COLUMNS), long.select(*ABUNDANCE_COLUMNS))


def _moved(df: DataFrame, offsets: DataFrame) -> DataFrame:
    moved = df.join(offsets, ["source", "ExpID", "IonMode"], "left")
    return moved.withColumn("FeatureNumber", F.col("FeatureNumber") + F.coalesce("offset", F.lit(0)))


def _datasets(columns: list[str]) -> set[tuple[str, ...]]:
    return {tuple(c.split("_")[:2]) for c in columns}


def refuse_shared_datasets(headers: dict[str, list[str]]) -> None:
    """Each file numbers its features from 1, so two files of one experiment and mode would mix."""
    owner: dict[tuple[str, ...], str] = {}
    for path, columns in headers.items():
        for dataset in sorted(_datasets([c for c in columns if re.match(SAMPLE_COLUMN, c)])):
            if dataset in owner:
                raise ValueError(
                    f"{owner[dataset]} and {path} both hold {'_'.join(dataset)}: process them in runs of their own, "
                    "give them different experiment names, or have them numbered on with shared_datasets=True"
                )
            owner[dataset] = path


def number_offsets(found: list[Layout]) -> DataFrame:
    """``source``, ``ExpID``, ``IonMode``, ``offset``: where the numbers of each file begin in each of its datasets.

    Files follow each other in the order of their paths. Features are counted per file in one pass over
    the records and added up by a window on one row a file and dataset.
    """
    counted = []
    for layout in found:
        datasets = sorted(_datasets([c for c in layout.names if re.match(SAMPLE_COLUMN, c)]))
        keys = F.array(*[F.struct(F.lit(e).alias("ExpID"), F.lit(m).alias("IonMode")) for e, m in datasets])
        n = layout.body.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        counted.append(n.withColumn("_d", F.explode(keys)).select("source", "_d.*", "n"))
    earlier = Window.partitionBy("ExpID", "IonMode").orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    stacked = reduce(lambda a, b: a.unionByName(b), counted)
    return settle(stacked.select("source", "ExpID", "IonMode", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")))


def prepare_files(
    spark, paths: list[str], params: Params = Params(), shared_datasets: bool = False, comments: str = COMMENT_LINES
) -> Prepared:
    """All exports of a run, stacked; headers may differ from file to file, paths may be patterns.

    Every file must hold experiments and modes of its own, or with ``shared_datasets`` the features of
    the files of a dataset are numbered on, file after file in the order of their paths.
    """
    found = layouts(spark, paths, comments)
    offsets = None
    if shared_datasets:
        offsets = number_offsets(found)
    else:
        refuse_shared_datasets({source: x.names for x in found for source in x.sources})
    parts = [prepare(as_table(x), params, offsets) for x in found]
    stack = lambda frames: reduce(lambda a, b: a.unionByName(b), frames)
    return Prepared(stack([p.features for p in parts]), stack([p.abundance for p in parts]))


def already_long(df: DataFrame) -> Prepared:
    """Input that has the documented twelve columns already."""
    return Prepared(feature_table(df), df.select(*ABUNDANCE_COLUMNS))
