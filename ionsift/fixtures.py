"""The domain's tables expressed over the shared test tables.

The text is plain SQL that Spark and other engines read alike, so a query and its check start
from the same rows. Every row of ``part`` and ``lineitem`` is used. Features come in runs of
twelve consecutive part keys that share a dataset; inside a run some features are ion partners,
near copies or exact copies of the first, at offsets on both sides of the tolerances. Masses are
whole steps of 0.00001 and times of 0.01, so that boundary cases occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_RUN = "({k} - {k} % 12)"


def _dataset(k: str) -> str:
    run = _RUN.format(k=k)
    return (
        f"concat('EXP', CAST({run} % 36 AS STRING)) AS ExpID, "
        f"CASE WHEN {run} % 24 = 0 THEN 'Positive' ELSE 'Negative' END AS IonMode"
    )


ABUNDANCE = f"""
SELECT l_partkey AS FeatureNumber, {_dataset("l_partkey")}, 'MS1' AS ModeDetail,
       CASE WHEN l_returnflag = 'N' THEN 'Blank' ELSE concat(l_returnflag, l_linestatus) END AS SampleDetail,
       CAST(l_linenumber AS STRING) AS Rep,
       CASE WHEN l_discount = 0 THEN NULL WHEN l_partkey % 23 = 5 THEN l_quantity / 1000.0E0
            ELSE l_quantity * (1 + l_partkey % 4) END AS volume
FROM {{lineitem}}
"""

_STEP = """CASE p_partkey % 12
    WHEN 0 THEN 0 WHEN 1 THEN 2198194 WHEN 2 THEN 1702655 WHEN 3 THEN 4404090
    WHEN 4 THEN 0 WHEN 5 THEN 0 ELSE 700000 * (p_partkey % 12) + p_partkey * p_partkey % 9973 END"""
_JITTER = "CASE WHEN p_partkey % 12 IN (0, 5) THEN 0 ELSE (p_partkey % 41 - 20) * 50 END"
_TIME_JITTER = "CASE WHEN p_partkey % 12 IN (0, 5) THEN 0 ELSE p_partkey % 9 END"

FEATURES = f"""
SELECT p_partkey AS FeatureNumber, {_dataset("p_partkey")},
       (10000000 + {_RUN.format(k="p_partkey")} * 7919 % 80000003 + {_STEP} + {_JITTER}) / 100000.0E0 AS Mass,
       (100 + {_RUN.format(k="p_partkey")} % 2510 + {_TIME_JITTER}) / 100.0E0 AS RetentionTime,
       CASE WHEN p_partkey % 7 = 6 THEN concat(CAST(p_retailprice AS STRING), '@', CAST(p_size AS STRING))
            WHEN p_partkey % 11 = 6 THEN concat('2,4-', p_name)
            WHEN p_partkey % 5 = 3 THEN concat('C12H8Cl2 ', p_name, CAST({_RUN.format(k="p_partkey")} AS STRING))
            WHEN p_partkey % 17 = 4 THEN NULL
            WHEN p_partkey % 8 = 1 THEN concat('Cmpd', CAST({_RUN.format(k="p_partkey")} AS STRING), ' ', CAST(p_size AS STRING))
            ELSE concat('Cmpd', CAST({_RUN.format(k="p_partkey")} AS STRING), ' ', p_type) END AS Compound,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 40.0E0 + (p_partkey * 13 % 60) END AS Score,
       CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_partkey % 9 END AS Frequency
FROM {{part}}
"""

# All features taken as one polarity, and the same ones seen again in the other with offsets on
# both sides of each tolerance.
POSITIVE = f"""
SELECT FeatureNumber, ExpID, 'Positive' AS IonMode, Mass, RetentionTime, Compound, Score, Frequency
FROM ({FEATURES}) f
"""
NEGATIVE = f"""
SELECT FeatureNumber, ExpID, 'Negative' AS IonMode, Mass + (FeatureNumber % 5) * 0.0015E0 AS Mass,
       RetentionTime + (FeatureNumber % 4) * 0.4E0 AS RetentionTime, Compound, Score, Frequency
FROM ({FEATURES}) f
"""

# Lookup result: one candidate per feature, so a compound has as many as features share its name; every
# seventh run of features was not found.
LOOKUP = f"""
SELECT f.Compound AS INPUT, concat(p.p_type, ' ', p.p_brand) AS Preferred_Name,
       concat('DTXSID', CAST(p.p_partkey AS STRING)) AS DTXSID,
       CASE WHEN p.p_partkey % 29 = 0 THEN NULL ELSE CAST(p.p_size AS DOUBLE) END AS DATA_SOURCES,
       CASE WHEN p.p_partkey % 14 = 0 THEN NULL ELSE p.p_size * 2.0E0 END AS TOXCAST___ACTIVE,
       CASE WHEN p.p_partkey % 9 = 0 THEN NULL ELSE p.p_size / 1.0E6 * (1 + p.p_partkey % 1000) END
         AS EXPOCAST_MEDIAN_EXPOSURE_PREDICTION_MG_KG_BW_DAY
FROM {{part}} p JOIN ({FEATURES}) f ON f.FeatureNumber = p.p_partkey
WHERE {_RUN.format(k="p.p_partkey")} % 84 <> 0
"""

# A wide export: one row per order line with five sample columns.
WIDE_COLUMNS = {
    "E1_Positive_MS1_MB01_1": "l_discount * 100",
    "E1_Positive_MS1_S1_1": "l_quantity",
    "E1_Positive_MS1_S1_2": "l_extendedprice",
    "E1_Positive_MS1_S2_1": "CASE WHEN l_tax = 0 THEN NULL ELSE l_tax * 100 END",
    "E1_Positive_MS1_S2_2": "CAST(l_suppkey AS DOUBLE)",
}
WIDE = "SELECT l_orderkey, l_linenumber, l_partkey, {} FROM {{lineitem}}".format(
    ", ".join(f"{expr} AS {name}" for name, expr in WIDE_COLUMNS.items())
)

# A wide export of features, as text the way a file has it, with blanks and a missing value written as 1.
EXPORT_COLUMNS = {
    "E1_Positive_MS1_MB01_1": "1 + p_partkey % 3",
    "E1_Positive_MS1_MB02_1": "p_size % 5",
    "E1_Positive_MS1_S1_1": "1 + p_size % 40",
    "E1_Positive_MS1_S1_2": "2 + p_partkey % 50",
    "E1_Positive_MS1_S2_1": "1 + p_partkey % 7 * p_size",
}
EXPORT = f"""
SELECT 'export' AS source, CAST(CASE WHEN FeatureNumber % 37 = 0 THEN NULL ELSE Mass END AS STRING) AS Mass,
       CAST(RetentionTime AS STRING) AS `Retention Time`, Compound || ' Esi+ ' || CAST(FeatureNumber AS STRING) AS Compound,
       CASE WHEN Score IS NULL THEN '[db, x]' ELSE concat('[db, overall=', CAST(Score AS STRING), ', x]') END AS Annotations,
       CAST(Frequency AS STRING) AS Frequency,
       {", ".join(f"CAST({expr} AS STRING) AS {name}" for name, expr in EXPORT_COLUMNS.items())}
FROM ({FEATURES}) f JOIN {{part}} p ON p.p_partkey = f.FeatureNumber
"""

TABLES = ("part", "lineitem")


def fixture(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run fixture text over the test tables it names."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **tables)


def plain(sql: str) -> str:
    """The same text over tables registered under their own names."""
    for t in TABLES:
        sql = sql.replace("{" + t + "}", t)
    return sql
