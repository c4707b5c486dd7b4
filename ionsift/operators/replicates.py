"""Replicate statistics per feature and sample, and what follows from them per sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ionsift.functions.nulls import ifelse, known
from ionsift.operators.skew import MAX_HEAVY, join_on
from ionsift.params import DATASET, SAMPLE, Params
from ionsift.session import settle_and_watch

# The quantile sketch keeps every value of a group of up to EXACT_UP_TO values (its rank error
# times the count stays below one rank), and at most about ACCURACY entries of a larger one.
ACCURACY = 200_000
EXACT_UP_TO = 50_000
BUCKETS = 65_536


def _middle(quantiles: Column) -> Column:
    """Mean of the lower and upper middle value."""
    return (quantiles[0] + quantiles[1]) / 2


def _exact_medians(values: DataFrame, large: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """Medians of the groups in ``large``, by counting below a bracket that holds the middle.

    ``large`` has the keys, the count ``_n`` and the bracket ``_lo``/``_hi`` from the sketch;
    ``few`` says that it was counted and is small enough to broadcast.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    # At most BUCKETS rows: drops nearly all other groups before anything is shuffled.
    suspects = values.where(F.col("_v").isNotNull()).withColumn("_bucket", bucket).join(
        F.broadcast(large.select(bucket.alias("_bucket")).distinct()), "_bucket", "left_semi"
    )
    counted = suspects.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))
    near = join_on(counted, F.broadcast(large) if few else large, keys, "inner").where(F.col("_v") <= F.col("_hi"))
    # One row per group for all values under the bracket; the values inside stay single.
    inside = F.col("_v") >= F.col("_lo")
    steps = near.groupBy(*keys, "_n", F.when(inside, F.col("_v")).alias("_v")).agg(F.sum("_c").alias("_c"))
    upto = F.sum("_c").over(
        Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    )
    reached = steps.withColumn("_upto", upto)
    lower = F.floor((F.col("_n") + 1) / 2)
    upper = F.floor(F.col("_n") / 2) + 1
    below = F.coalesce(F.max(F.when(F.col("_v").isNull(), F.col("_upto"))), F.lit(0))
    at = lambda rank: F.min(F.when(F.col("_upto") >= rank, F.col("_v")))
    missed = (below >= lower) | (F.max("_upto") < upper)
    return (
        reached.groupBy(*keys, "_n")
        .agg(((at(lower) + at(upper)) / 2).alias("_exact"), missed.alias("_missed"))
    )


def _all_medians(values: DataFrame, large: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """``_exact_medians``; a bracket that misses the middle is opened to the whole group and counted again."""
    found, seen = settle_and_watch(_exact_medians(values, large, keys, few), missed=F.count_if("_missed"))
    good = found.where("NOT _missed").select(*keys, "_exact")
    if not seen["missed"]:
        return good
    ends = {"_lo": F.lit(float("-inf")), "_hi": F.lit(float("inf"))}
    again = found.where("_missed").select(*keys, "_n").withColumns(ends)
    return good.unionByName(_exact_medians(values, again, keys, few).select(*keys, "_exact"))


def replicate_stats(
    abundance: DataFrame, accuracy: int = ACCURACY, exact_up_to: int = EXACT_UP_TO
) -> DataFrame:
    """Count, median, mean, spread of the replicates of each feature in each sample.

    One shuffle: every aggregate is combined on the map side with bounded memory. The result is
    written once, since both the median's size check and all later steps read it. The median is
    exact; groups beyond ``exact_up_to`` values get it from a second look at their middle only.
    """
    values = abundance.select(*SAMPLE, known(F.col("volume")).alias("_v"))
    margin = 4.0 / accuracy
    points = f"array(0.5D, 0.5000001D, {0.5 - margin}D, {0.5 + margin}D)"
    groups = values.groupBy(*SAMPLE).agg(
        F.count("_v").alias("NAbun"),
        F.expr(f"percentile_approx(_v, {points}, {accuracy})").alias("_q"),
        F.bround(F.avg("_v"), 0).alias("MeanAbun"),
        F.bround(F.stddev_samp("_v"), 2).alias("StdAbun"),
        F.count(F.lit(1)).alias("Count"),
    )
    q = F.col("_q")
    groups = groups.select(
        "*", _middle(q).alias("_middle"), q[2].alias("_lo"), q[3].alias("_hi")
    ).drop("_q")
    table, seen = settle_and_watch(groups, large=F.count_if(F.col("NAbun") > exact_up_to))
    middle = F.col("_middle")
    if seen["large"]:
        large = table.where(F.col("NAbun") > exact_up_to).select(
            *SAMPLE, F.col("NAbun").alias("_n"), "_lo", "_hi"
        )
        table = join_on(table, _all_medians(values, large, SAMPLE, seen["large"] <= MAX_HEAVY), SAMPLE)
        middle = F.coalesce("_exact", middle)
    return table.select(*SAMPLE, "NAbun", F.bround(middle, 0).alias("MedAbun"), "MeanAbun", "StdAbun", "Count")


def _ratio(sd: Column, mean: Column) -> Column:
    return F.try_divide(sd, mean)


def sample_feature(stats: DataFrame, params: Params = Params()) -> DataFrame:
    """Relative spread, replicate flags and the 0/1 "seen in this sample" of each row."""
    sd, mean = F.col("StdAbun"), F.col("MeanAbun")
    if params.replicate_cv:
        # A mean of 0 with some spread is infinitely variable: above any threshold.
        cv_ok = F.when((mean == 0) & (sd > 0), F.lit(False)).otherwise(_ratio(sd, mean) < params.replicate_cv)
    else:
        cv_ok = F.lit(True)
    return (
        stats.withColumn("CV", F.bround(_ratio(sd, mean), 2))
        .withColumn("ReplicateThresholdFlag", F.col("NAbun") / F.col("Count") >= params.replicate_fraction)
        .withColumn("CVThresholdFlag", cv_ok)
        .withColumn(
            "SampleFeature",
            ifelse(
                F.col("ReplicateThresholdFlag") & F.col("CVThresholdFlag"),
                F.lit(1).cast("long"),
                F.lit(0).cast("long"),
            ),
        )
    )


def replicate_summary(abundance: DataFrame, params: Params = Params()) -> DataFrame:
    return sample_feature(replicate_stats(abundance), params)


def sample_counts(stats: DataFrame) -> DataFrame:
    """Number of distinct samples per dataset, the blank included."""
    return stats.groupBy(*DATASET).agg(F.countDistinct("SampleDetail").alias("n_samples"))
