"""Plain SQL for the registered queries, written independently of the Spark operators.

Brute force throughout: self-joins for the range searches, ranking windows for the winners,
nested aggregates. It is the check, not the engine.
"""

from __future__ import annotations

import re

from ionsift import fixtures as fx

KEY = "ExpID, IonMode, FeatureNumber"
SAMPLES = ["AF", "AO", "RF", "RO"]
MEASURES = ["MeanAbun", "MedAbun", "subMeanAbun", "subMedAbun"]
POSITIVE = "('Positive', 'Pos', 'Esi+')"


def even(x: str, digits: int) -> str:
    """Half-even rounding of the decimal value as printed."""
    return f"CAST(round_even(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def near(x: str) -> str:
    """Six digits, for sums of floating-point terms."""
    return f"round({x}, 6)"


def clamp(x: str) -> str:
    return f"CASE WHEN {x} < 0 THEN 0.0E0 WHEN {x} >= 0 THEN {x} END"


PARTS: dict[str, str] = {
    "abundance": fx.plain(fx.ABUNDANCE),
    "feature": fx.plain(fx.FEATURES),
    "positive": fx.plain(fx.POSITIVE),
    "negative": fx.plain(fx.NEGATIVE),
    "lookup": fx.plain(fx.LOOKUP),
    "wide": fx.plain(fx.WIDE),
    "stats": f"""
        SELECT {KEY}, SampleDetail, count(volume) AS NAbun, {even("median(volume)", 0)} AS MedAbun,
               {even("avg(volume)", 0)} AS MeanAbun, {even("stddev_samp(volume)", 2)} AS StdAbun, count(*) AS Count
        FROM abundance GROUP BY {KEY}, SampleDetail""",
    "summary": f"""
        SELECT *, {even("StdAbun / nullif(MeanAbun, 0)", 2)} AS CV,
               NAbun / CAST(Count AS DOUBLE) >= 0.8E0 AS ReplicateThresholdFlag, true AS CVThresholdFlag,
               CAST(CASE WHEN NAbun / CAST(Count AS DOUBLE) >= 0.8E0 THEN 1 ELSE 0 END AS BIGINT) AS SampleFeature
        FROM stats""",
    "blank": f"""
        SELECT {KEY}, coalesce(MeanAbun, 0) AS Blank_avgvol, coalesce(MedAbun, 0) AS Blank_medvol
        FROM summary WHERE SampleDetail = 'Blank'""",
    "blanked": f"""
        SELECT {KEY}, SampleDetail, NAbun, MedAbun, MeanAbun, StdAbun, Count, CV, ReplicateThresholdFlag,
               CVThresholdFlag, SampleFeature, Blank_avgvol, Blank_medvol,
               {clamp("(MeanAbun - Blank_avgvol)")} AS subMeanAbun, {clamp("(MedAbun - Blank_medvol)")} AS subMedAbun
        FROM (SELECT * FROM summary WHERE SampleDetail <> 'Blank') s FULL JOIN blank USING ({KEY})""",
    "present": f"""
        SELECT {KEY}, CAST(coalesce(sum(SampleFeature), 0) AS BIGINT) AS PresentInSamples,
               coalesce(sum(SampleFeature), 0) < 1 AS FalseSampleFeature_Flag
        FROM blanked GROUP BY {KEY}""",
    "spike": f"""
        SELECT {KEY}, CAST(sum(CASE WHEN MedAbun / (Blank_medvol + 1) >= 3 THEN 1 ELSE 0 END) AS BIGINT)
                 AS SumSpikeThreshold,
               sum(CASE WHEN MedAbun / (Blank_medvol + 1) >= 3 THEN 1 ELSE 0 END) < 1 AS BelowSpike_Flag
        FROM blanked GROUP BY {KEY}""",
    "score_flags": f"""
        SELECT *, Mass - {even("Mass", 0)} < 0.05E0 AS NegMassDefect_Flag, Score IS NULL AS MissingScore_Flag,
               Score IS NULL OR Score < 90 AS LowScore_Flag,
               CASE WHEN (Mass - {even("Mass", 0)} < 0.05E0)
                      AND coalesce(regexp_matches(Compound, '([FP]|Br|Cl)[0-9]'), false)
                    THEN Score > 50 ELSE false END AS WeakMatch_Flag
        FROM feature""",
    "adduct_mass": """
        SELECT * FROM (VALUES ('Positive', 'Na', 21.98194E0), ('Positive', 'Ammonium', 17.02655E0),
                              ('Negative', 'Formate', 44.0409E0)) t(IonMode, adduct, delta)""",
    "top_mass": "SELECT ExpID, IonMode, max(Mass) AS top FROM feature GROUP BY ExpID, IonMode",
    "pair": """
        SELECT a.ExpID, a.IonMode, a.FeatureNumber, a.Mass, a.RetentionTime, d.adduct,
               b.FeatureNumber AS adduct_FeatureNumber, b.Mass AS adduct_Mass, b.RetentionTime AS adduct_RetentionTime
        FROM feature a JOIN feature b ON a.ExpID = b.ExpID AND a.IonMode = b.IonMode
        JOIN top_mass t ON t.ExpID = a.ExpID AND t.IonMode = a.IonMode
        JOIN adduct_mass d ON d.IonMode = a.IonMode
        WHERE a.FeatureNumber <> b.FeatureNumber AND abs(a.RetentionTime - b.RetentionTime) <= 0.05E0
          AND b.Mass - a.Mass >= d.delta - top * 20 * 1.0E-6 AND b.Mass - a.Mass <= d.delta + top * 20 * 1.0E-6
          AND (abs(b.Mass - a.Mass) - d.delta) / a.Mass * 1.0E6 <= 20""",
    "adduct_flag": """
        SELECT f.*, """ + ", ".join(
        f"CASE WHEN f.IonMode = '{mode}' THEN EXISTS (SELECT 1 FROM pair p WHERE p.ExpID = f.ExpID AND "
        f"p.IonMode = f.IonMode AND p.{col} = f.FeatureNumber AND p.adduct = '{name}') END AS {verb}_{name}_adduct"
        for mode, name in (("Positive", "Na"), ("Positive", "Ammonium"), ("Negative", "Formate"))
        for verb, col in (("is", "adduct_FeatureNumber"), ("has", "FeatureNumber"))
    ) + " FROM feature f",
    "twin": """
        SELECT a.ExpID, a.IonMode, a.FeatureNumber AS a, b.FeatureNumber AS b
        FROM feature a JOIN feature b ON a.ExpID = b.ExpID AND a.IonMode = b.IonMode
        JOIN top_mass t ON t.ExpID = a.ExpID AND t.IonMode = a.IonMode
        WHERE a.FeatureNumber <> b.FeatureNumber AND abs(a.RetentionTime - b.RetentionTime) <= 0.05E0
          AND b.Mass - a.Mass >= -(top * 10 * 1.0E-6) AND b.Mass - a.Mass <= top * 10 * 1.0E-6
          AND abs(b.Mass - a.Mass) / a.Mass * 1.0E6 <= 10""",
    "rough": f"""
        SELECT {KEY}, Compound, Score, Frequency, RetentionTime, word,
               CASE WHEN regexp_matches(word, '^[0-9]') THEN
                      CASE WHEN try_cast(word AS DOUBLE) IS NULL THEN NULL
                           WHEN {even("try_cast(word AS DOUBLE)", 1)} = 0 THEN word
                           ELSE printf('%.15g', {even("try_cast(word AS DOUBLE)", 1)}) END
                    ELSE word END AS Roughname,
               {even("RetentionTime", 1)} AS RT
        FROM (SELECT *, split_part(split_part(Compound, '@', 1), ' ', 1) AS word FROM feature) f""",
    "cluster_rank": f"""
        SELECT r.*, row_number() OVER (PARTITION BY ExpID, IonMode, Roughname, RT
                 ORDER BY coalesce(Score, 0) DESC, Frequency DESC NULLS LAST, FeatureNumber) AS place
        FROM rough r""",
    "twin_rank": """
        SELECT r.*, row_number() OVER (PARTITION BY ExpID, IonMode, Roughname, RT
                 ORDER BY coalesce(Score, 0) DESC, Frequency DESC NULLS LAST, FeatureNumber) AS place
        FROM rough r WHERE EXISTS (SELECT 1 FROM twin t WHERE t.ExpID = r.ExpID AND t.IonMode = r.IonMode
                                   AND (t.a = r.FeatureNumber OR t.b = r.FeatureNumber))""",
    "twin_flag": f"""
        SELECT {KEY}, r.place IS NOT NULL AS Duplicate_Flag,
               coalesce(r.place = 1 AND r.Frequency IS NOT NULL, false) AS Duplicate_Keep_Flag
        FROM feature f LEFT JOIN (SELECT {KEY}, Frequency, place FROM twin_rank) r USING ({KEY})""",
    "flags": f"""
        SELECT * FROM score_flags
        JOIN (SELECT {KEY}, is_Na_adduct, has_Na_adduct, is_Ammonium_adduct, has_Ammonium_adduct,
                     is_Formate_adduct, has_Formate_adduct FROM adduct_flag) a USING ({KEY})
        JOIN twin_flag USING ({KEY})
        JOIN (SELECT {KEY}, FalseSampleFeature_Flag FROM present) p USING ({KEY})
        JOIN (SELECT {KEY}, BelowSpike_Flag FROM spike) s USING ({KEY})""",
    "label": f"""
        SELECT {KEY}, CASE WHEN NOT LowScore_Flag OR (LowScore_Flag AND WeakMatch_Flag) THEN Compound
                           WHEN NOT (NOT LowScore_Flag OR (LowScore_Flag AND WeakMatch_Flag))
                             THEN concat(printf('%.15g', Mass), '@', printf('%.15g', RetentionTime)) END AS label
        FROM score_flags""",
}

FLAGS = [
    "FalseSampleFeature_Flag", "BelowSpike_Flag", "NegMassDefect_Flag", "MissingScore_Flag", "LowScore_Flag",
    "WeakMatch_Flag", "Duplicate_Flag", "Duplicate_Keep_Flag", "is_Na_adduct", "has_Na_adduct",
    "is_Ammonium_adduct", "has_Ammonium_adduct", "is_Formate_adduct", "has_Formate_adduct",
]
_FLAGS = ", ".join(FLAGS)
_CELLS = [f"{s}_{m}" for s in SAMPLES for m in MEASURES]
_SUBMED = [f"{s}_subMedAbun" for s in SAMPLES]

PARTS["long"] = f"""
    SELECT {KEY}, SampleDetail, MedAbun, MeanAbun, subMeanAbun, subMedAbun, Mass, RetentionTime, label AS Compound,
           Score, {_FLAGS}
    FROM blanked LEFT JOIN flags USING ({KEY}) LEFT JOIN label USING ({KEY})"""
PARTS["cells"] = f"SELECT {KEY}, " + ", ".join(
    f"max(CASE WHEN SampleDetail = '{s}' THEN {m} END) AS {s}_{m}" for s in SAMPLES for m in MEASURES
) + f" FROM blanked GROUP BY {KEY}"
PARTS["wide_flagged"] = f"""
    SELECT {KEY}, label AS Compound, Mass, RetentionTime, Score, {", ".join(_CELLS)}, {_FLAGS}
    FROM flags JOIN label USING ({KEY}) JOIN cells USING ({KEY})"""
PARTS["passing"] = """
    SELECT * FROM wide_flagged WHERE NOT FalseSampleFeature_Flag AND NOT BelowSpike_Flag
       AND (NOT Duplicate_Flag OR (Duplicate_Flag AND Duplicate_Keep_Flag))"""

# Two polarities with the measures of the same feature number.
PARTS["modes"] = f"""
    SELECT f.*, {", ".join(_CELLS)}
    FROM (SELECT * FROM positive UNION ALL SELECT * FROM negative) f
    JOIN (SELECT FeatureNumber, {", ".join(_CELLS)} FROM cells) c USING (FeatureNumber)"""
PARTS["cross"] = """
    SELECT a.ExpID, a.IonMode, a.FeatureNumber, a.Compound, a.Score, a.Mass, a.RetentionTime,
           b.FeatureNumber AS match_FeatureNumber, b.IonMode AS match_IonMode, b.Score AS match_Score,
           b.Mass AS match_Mass, b.RetentionTime AS match_RetentionTime,
           abs(b.Mass - a.Mass) / a.Mass * 1.0E6 AS ppm_error
    FROM positive a JOIN negative b ON a.ExpID = b.ExpID AND a.Compound = b.Compound
    WHERE abs(a.Mass - b.Mass) <= 0.005E0 AND abs(a.RetentionTime - b.RetentionTime) <= 1
      AND abs(b.Mass - a.Mass) / a.Mass * 1.0E6 <= 10"""
PARTS["mode_flag"] = """
    SELECT f.*, NOT EXISTS (SELECT 1 FROM cross_pair c WHERE c.ExpID = f.ExpID AND
        ((f.IonMode = 'Positive' AND c.FeatureNumber = f.FeatureNumber) OR
         (f.IonMode = 'Negative' AND c.match_FeatureNumber = f.FeatureNumber))) AS unique_mode
    FROM modes f"""
PARTS["cross_pair"] = PARTS.pop("cross")
PARTS["stacked"] = f"""
    SELECT ExpID, Compound, IonMode, Mass, RetentionTime, Score, {", ".join(_CELLS)}, NOT unique_mode AS BothModes_Flag
    FROM mode_flag"""
PARTS["hits"] = f"""
    SELECT ExpID, Compound, CAST(sum(n) AS BIGINT) AS N_CompoundHits
    FROM (SELECT ExpID, IonMode, BothModes_Flag, Compound, count(*) AS n FROM stacked
          GROUP BY ExpID, IonMode, BothModes_Flag, Compound) t
    WHERE NOT BothModes_Flag OR (BothModes_Flag AND IonMode IN {POSITIVE})
    GROUP BY ExpID, Compound"""
_ZEROED = ", ".join(f"nullif(s.{c}, 0) AS {c}" for c in ["Mass", "RetentionTime", "Score", *_CELLS])
PARTS["joined"] = f"""
    SELECT s.ExpID, s.Compound, s.IonMode, {_ZEROED}, s.BothModes_Flag, h.N_CompoundHits
    FROM stacked s LEFT JOIN hits h ON s.ExpID = h.ExpID AND s.Compound IS NOT DISTINCT FROM h.Compound"""

# The documented default: features that fail the sample flags are left out, and the others relabelled, before the
# searches. The same parts over that smaller population.
PARTS["early_feature"] = f"""
    SELECT f.* REPLACE (label AS Compound) FROM feature f JOIN label USING ({KEY})
    JOIN present p USING ({KEY}) JOIN spike s USING ({KEY})
    WHERE NOT p.FalseSampleFeature_Flag AND NOT s.BelowSpike_Flag"""
_SEARCHES = ("feature", "top_mass", "pair", "adduct_flag", "twin", "rough", "twin_rank", "twin_flag", "flags", "wide_flagged", "passing")
for _name in _SEARCHES[1:]:
    PARTS[f"early_{_name}"] = re.sub(rf"\b(FROM|JOIN)(\s+)({'|'.join(_SEARCHES)})\b", r"\1\2early_\3", PARTS[_name])

# Single injections, wide.
REP_SAMPLES = [f"{s}-{i}" for s in SAMPLES for i in range(1, 8)]
_INJECTIONS = [f'"{s.replace("-", ".")}_{m}"' for s in REP_SAMPLES for m in MEASURES]
PARTS["injection"] = f"""
    SELECT {KEY}, concat(SampleDetail, '-', regexp_extract(Rep, '^[0-9]*', 0)) AS SampleDetail, volume AS MeanAbun,
           volume AS MedAbun, {clamp("(volume - Blank_avgvol)")} AS subMeanAbun, {clamp("(volume - Blank_medvol)")} AS subMedAbun
    FROM (SELECT * FROM abundance WHERE SampleDetail <> 'Blank') a LEFT JOIN blank USING ({KEY})"""
PARTS["injection_cells"] = f"SELECT {KEY}, " + ", ".join(
    f"""max(CASE WHEN SampleDetail = '{s}' THEN {m} END) AS "{s.replace('-', '.')}_{m}" """ for s in REP_SAMPLES for m in MEASURES
) + f" FROM injection GROUP BY {KEY}"

PARTS["export"] = fx.plain(fx.EXPORT).replace("`", '"')
PARTS["export_feature"] = """
    SELECT *, row_number() OVER (ORDER BY try_cast(Mass AS DOUBLE) NULLS LAST, try_cast("Retention Time" AS DOUBLE) NULLS LAST,
             Compound NULLS LAST, Annotations NULLS LAST, try_cast(Frequency AS DOUBLE) NULLS LAST) AS FeatureNumber
    FROM export"""

PARTS["ratio"] = """
    SELECT l.*, DATA_SOURCES / best AS DataSourceRatio
    FROM lookup l JOIN (SELECT INPUT, CASE WHEN count(*) = count(DATA_SOURCES) THEN max(DATA_SOURCES) END AS best
                        FROM lookup GROUP BY INPUT) m ON l.INPUT IS NOT DISTINCT FROM m.INPUT"""
PARTS["classified"] = """
    SELECT *, concat(Category, coalesce(CAST(Category_Number AS VARCHAR), 'NA')) AS Compound_Classification
    FROM (SELECT *, CASE WHEN TOXCAST___ACTIVE IS NULL OR EXPOCAST_MEDIAN_EXPOSURE_PREDICTION_MG_KG_BW_DAY IS NULL
                         THEN 'B' ELSE 'A' END AS Category,
                 CASE WHEN DataSourceRatio = 1 THEN 1 WHEN DataSourceRatio <> 1 THEN 2 END AS Category_Number,
                 9 + ceil(log10(nullif(EXPOCAST_MEDIAN_EXPOSURE_PREDICTION_MG_KG_BW_DAY, 0))) AS ExposureCategory,
                 TOXCAST___ACTIVE / 100 AS Tox21_Activities
          FROM ratio) r"""
_PRESENT = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in _SUBMED)
PARTS["presence"] = f"""
    SELECT *, CAST(sum({_PRESENT}) OVER (PARTITION BY ExpID, Compound, Mass) AS BIGINT) AS SampleN
    FROM joined WHERE regexp_matches(Compound, '[A-Z]')"""
_LOGSUM = " + ".join(f"coalesce(CASE WHEN {c} > 0 THEN log10({c}) END, 0)" for c in _SUBMED)
_LOGN = " + ".join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END" for c in _SUBMED)
PARTS["measured"] = f"""
    SELECT ExpID, Compound, IonMode, Mass, RetentionTime, Score, SampleN, ({_LOGSUM}) / ({_LOGN}) AS log10_avgAbun
    FROM presence WHERE {_LOGN} > 0"""
_CANDIDATE = "Preferred_Name, DTXSID, Category, Compound_Classification, ExposureCategory, Tox21_Activities"
PARTS["candidate"] = f"""
    SELECT m.*, {_CANDIDATE} FROM measured m LEFT JOIN classified c ON c.INPUT = m.Compound"""
_SOURCES = {
    "Pi_Bioactivity": "Tox21_Activities", "Pi_Exposure": "ExposureCategory",
    "Pi_Abundance": "log10_avgAbun", "Pi_Frequency": "SampleN",
}
PARTS["scaled"] = "SELECT *, " + ", ".join(
    f"({s} - min({s}) OVER w) / nullif(CAST(max({s}) OVER w - min({s}) OVER w AS DOUBLE), 0) AS {p}"
    for p, s in _SOURCES.items()
) + " FROM candidate WINDOW w AS (PARTITION BY ExpID)"
PARTS["scored"] = """
    SELECT ExpID, IonMode, Compound, concat(Compound, ': ', Preferred_Name) AS full_name, Preferred_Name, Mass,
           RetentionTime, DTXSID, Pi_Bioactivity, Pi_Exposure, Pi_Abundance, Pi_Frequency,
           2 * Pi_Bioactivity + 1 * Pi_Exposure + 1 * Pi_Abundance + 2 * Pi_Frequency AS ToxPiScore,
           Category, Compound_Classification,
           CASE WHEN Preferred_Name IS NOT NULL THEN concat(Compound, ': ', Preferred_Name) END AS Chemical
    FROM scaled"""
PARTS["best"] = """
    SELECT * FROM (SELECT *, max(ToxPiScore) OVER c AS top, count(*) OVER c = count(ToxPiScore) OVER c AS complete
                   FROM scored WINDOW c AS (PARTITION BY ExpID, Chemical)) t
    WHERE NOT complete OR ToxPiScore = top"""
PARTS["ranked"] = """
    SELECT *, concat(coalesce(Compound_Classification, 'NA'), alpha_beta) AS Class
    FROM (SELECT *, CASE WHEN ToxPiScore IS NULL THEN 'γ'
                         WHEN ToxPiScore = max(ToxPiScore) OVER (PARTITION BY ExpID, Compound) THEN 'α'
                         ELSE 'β' END AS alpha_beta FROM best) t"""
_HEIGHTS = " UNION ALL ".join(
    f"SELECT ExpID, IonMode, Chemical, Mass, DTXSID, ToxPiScore, '{p}' AS sub_Pi, {p} AS height, "
    f"{weight}.0E0 AS weight, {end}.0E0 AS w, {start}.0E0 AS wm, {middle}E0 AS wt FROM scored_rows"
    for p, weight, end, start, middle in (
        ("Pi_Bioactivity", 2, 2, 0, 1.0), ("Pi_Abundance", 1, 3, 2, 2.5),
        ("Pi_Exposure", 1, 4, 3, 3.5), ("Pi_Frequency", 2, 6, 4, 5.0),
    )
)
PARTS["scored_rows"] = "SELECT * FROM ranked WHERE ToxPiScore IS NOT NULL"
PARTS["heights"] = _HEIGHTS

_PI = ", ".join(f"{near(p)} AS {p}" for p in (*_SOURCES, "ToxPiScore"))


def query(sql: str) -> str:
    """A statement with the named parts it needs in front."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name, body in PARTS.items():
            if name not in needed and re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                need(body)
                if name not in needed:
                    needed.append(name)

    need(sql)
    parts = ", ".join(f"{n} AS ({PARTS[n]})" for n in needed)
    return f"WITH {parts} {sql}" if parts else sql


def oracle() -> dict[str, str]:
    flag = lambda c: ", ".join(c)
    sql = {
        "feature_table": "SELECT DISTINCT * FROM feature",
        "replicate_stats": "SELECT * FROM stats",
        "sample_feature": "SELECT * FROM summary",
        "blank_subtract": "SELECT * FROM blanked",
        "present_in_samples": "SELECT * FROM present",
        "present_fraction": f"""
            SELECT p.ExpID, p.IonMode, FeatureNumber, PresentInSamples,
                   PresentInSamples / CAST(n AS DOUBLE) <= 0.6E0 AS FalseSampleFeature_Flag
            FROM present p JOIN (SELECT ExpID, IonMode, count(DISTINCT SampleDetail) AS n FROM stats
                                 GROUP BY ExpID, IonMode) c ON p.ExpID = c.ExpID AND p.IonMode = c.IonMode""",
        "cv_flag": f"""
            SELECT {KEY}, SampleDetail, CVThresholdFlag,
                   CAST(CASE WHEN ReplicateThresholdFlag AND CVThresholdFlag THEN 1
                        WHEN NOT (ReplicateThresholdFlag AND CVThresholdFlag) THEN 0 END AS BIGINT) AS SampleFeature
            FROM (SELECT * REPLACE (CASE WHEN MeanAbun = 0 AND StdAbun > 0 THEN false
                                    ELSE StdAbun / nullif(MeanAbun, 0) < 0.5E0 END AS CVThresholdFlag) FROM summary) s""",
        "spike_flag": "SELECT * FROM spike",
        "replicate_long": f"""
            SELECT {KEY}, ModeDetail, concat(SampleDetail, '-', regexp_extract(Rep, '^[0-9]*', 0)) AS SampleDetail,
                   regexp_extract(Rep, '^[0-9]*', 0) AS Rep, volume, Blank_avgvol, Blank_medvol,
                   volume AS MeanAbun, volume AS MedAbun,
                   {clamp("(volume - Blank_avgvol)")} AS subMeanAbun, {clamp("(volume - Blank_medvol)")} AS subMedAbun
            FROM (SELECT * FROM abundance WHERE SampleDetail <> 'Blank') a LEFT JOIN blank USING ({KEY})""",
        "melt_measures": " UNION ALL ".join(
            "SELECT l_orderkey, l_linenumber, l_partkey, "
            + ", ".join(
                f"'{'Blank' if v in ('MB01', 'MB02', 'MB03') else v}' AS {n}"
                for n, v in zip(("ExpID", "IonMode", "ModeDetail", "SampleDetail", "Rep"), c.split("_"))
            )
            + f", CASE WHEN {c} <> 1 THEN {c} END AS volume FROM wide"
            for c in fx.WIDE_COLUMNS
        ),
        "split_metadata": "SELECT ExpID, IonMode, ModeDetail, SampleDetail, Rep, volume FROM abundance",
        "null_tokens": "SELECT " + ", ".join(
            f"CASE WHEN trim({c}) NOT IN ('', 'NA', '-', '0') THEN {c} END AS {c}"
            for c in ("FeatureNumber", "SampleDetail", "volume")
        ) + f" FROM ({NULL_TOKEN_INPUT}) t",
        "score_extract": f"""
            SELECT FeatureNumber, Annotations, try_cast(regexp_extract(Annotations, 'overall=(.*),', 1) AS DOUBLE) AS Score
            FROM ({ANNOTATION_INPUT.replace("{features}", "feature")}) t""",
        "feature_number": """
            SELECT ExpID, Mass, RetentionTime, Compound, row_number() OVER (PARTITION BY ExpID
                     ORDER BY Mass NULLS LAST, RetentionTime NULLS LAST, Compound NULLS LAST, Frequency NULLS LAST,
                              Score NULLS LAST) AS FeatureNumber
            FROM feature""",
        "halogen_flag": """
            SELECT *, coalesce(regexp_matches(Compound, '([FP]|Br|Cl)[0-9]'), false) AS halogen FROM feature""",
        "score_mass_flags": "SELECT * FROM score_flags",
        "compound_label": f"SELECT {KEY}, label AS Compound FROM label",
        "rough_name": f"SELECT {KEY}, Compound, Roughname FROM rough",
        "duplicate_keep": f"SELECT {KEY}, Roughname, RT FROM cluster_rank WHERE place = 1 AND Frequency IS NOT NULL",
        "duplicate_flags": f"SELECT {KEY}, Duplicate_Flag, Duplicate_Keep_Flag FROM twin_flag",
        "adduct_pairs": "SELECT * FROM pair",
        "adduct_flags_positive": f"""
            SELECT {KEY}, is_Na_adduct, has_Na_adduct, is_Ammonium_adduct, has_Ammonium_adduct
            FROM adduct_flag WHERE IonMode = 'Positive'""",
        "adduct_flags_negative": f"""
            SELECT {KEY}, is_Formate_adduct, has_Formate_adduct FROM adduct_flag WHERE IonMode = 'Negative'""",
        "all_flags": f"SELECT {KEY}, Mass, RetentionTime, Compound, Score, Frequency, {_FLAGS} FROM flags",
        "processed_long": "SELECT * FROM long",
        "wide_pivot": f"SELECT {KEY}, {flag(_CELLS)} FROM cells",
        "filtered_features": "SELECT * FROM passing",
        "filtered_long": """
            SELECT * FROM long WHERE NOT FalseSampleFeature_Flag AND NOT BelowSpike_Flag
               AND (NOT Duplicate_Flag OR (Duplicate_Flag AND Duplicate_Keep_Flag))""",
        "prefiltered_features": "SELECT * FROM early_passing",
        "replicate_wide": f"""
            SELECT {KEY}, label AS Compound, Mass, RetentionTime, Score, {flag(_INJECTIONS)}, {_FLAGS}
            FROM flags JOIN label USING ({KEY}) JOIN injection_cells USING ({KEY})""",
        "prepare": " UNION ALL ".join(
            f"""
            SELECT FeatureNumber, 'E1' AS ExpID, 'Positive' AS IonMode, 'MS1' AS ModeDetail,
                   '{'Blank' if c.split('_')[3].startswith('MB') else c.split('_')[3]}' AS SampleDetail, '{c.split('_')[4]}' AS Rep,
                   nullif(try_cast({c} AS DOUBLE), 1) AS volume, try_cast(Mass AS DOUBLE) AS Mass,
                   try_cast("Retention Time" AS DOUBLE) AS RetentionTime, CASE WHEN Compound IS NOT NULL THEN split_part(Compound, ' Esi', 1) END AS Compound,
                   try_cast(regexp_extract(Annotations, 'overall=(.*),', 1) AS DOUBLE) AS Score,
                   CAST(Frequency AS BIGINT) AS Frequency
            FROM export_feature"""
            for c in fx.EXPORT_COLUMNS
        ),
        "score_chart_table": f"""
            SELECT g.*, page FROM (
              SELECT ExpID, IonMode, Chemical, Mass, DTXSID, sub_Pi, {near("height")} AS height, weight, w, wm, wt,
                     {near("sum(height * weight) OVER (PARTITION BY ExpID, Chemical)")} AS ToxPi FROM heights) g
            JOIN (SELECT ExpID, Chemical, CAST(ceil(row_number() OVER (PARTITION BY ExpID ORDER BY s DESC, Chemical) / 9.0E0)
                         AS BIGINT) AS page
                  FROM (SELECT ExpID, Chemical, max(ToxPiScore) AS s FROM scored_rows GROUP BY ExpID, Chemical) c) p
            ON g.ExpID = p.ExpID AND g.Chemical = p.Chemical""",
        "unique_compounds": r"""
            SELECT DISTINCT ExpID, regexp_replace(Compound, '\s[0-9].*', '') AS Compound FROM feature
            WHERE regexp_matches(Compound, '[A-Z]')""",
        "mode_pairs": """
            SELECT DISTINCT a.ExpID, a.IonMode, b.IonMode AS match_IonMode FROM positive a JOIN negative b
            ON a.ExpID = b.ExpID""",
        "cross_mode_match": "SELECT * FROM cross_pair",
        "unique_mode_flags": "SELECT ExpID, IonMode, FeatureNumber, unique_mode FROM mode_flag",
        "cross_mode_union": "SELECT * FROM stacked",
        "compound_hits": "SELECT * FROM hits",
        "zero_to_null": f"""
            SELECT {KEY}, SampleDetail, nullif(NAbun, 0) AS NAbun, nullif(MedAbun, 0) AS MedAbun,
                   nullif(SampleFeature, 0) AS SampleFeature, nullif(subMeanAbun, 0) AS subMeanAbun,
                   nullif(subMedAbun, 0) AS subMedAbun, ReplicateThresholdFlag
            FROM (SELECT ExpID, IonMode, nullif(FeatureNumber, 0) AS FeatureNumber, SampleDetail, NAbun, MedAbun,
                         SampleFeature, subMeanAbun, subMedAbun, ReplicateThresholdFlag FROM blanked) b""",
        "joined_modes": "SELECT * FROM joined",
        "source_ratio": "SELECT INPUT, DTXSID, DATA_SOURCES, DataSourceRatio FROM ratio",
        "chem_classify": f"""
            SELECT INPUT, Preferred_Name, DTXSID, DataSourceRatio, Category, Category_Number, Compound_Classification,
                   ExposureCategory, Tox21_Activities FROM classified""",
        "sample_presence": "SELECT ExpID, IonMode, Compound, Mass, RetentionTime, SampleN FROM presence",
        "avg_log_abundance": f"""
            SELECT ExpID, IonMode, Compound, Mass, RetentionTime, {near("log10_avgAbun")} AS log10_avgAbun
            FROM measured""",
        "chem_lookup": f"""
            SELECT ExpID, IonMode, Compound, Mass, RetentionTime, SampleN, {near("log10_avgAbun")} AS log10_avgAbun,
                   {_CANDIDATE} FROM candidate""",
        "pi_normalise": "SELECT ExpID, IonMode, Compound, Mass, DTXSID, "
        + ", ".join(f"{near(p)} AS {p}" for p in _SOURCES)
        + " FROM scaled",
        "weighted_score": f"""
            SELECT ExpID, IonMode, Compound, Chemical, Mass, DTXSID, {near("ToxPiScore")} AS ToxPiScore FROM scored""",
        "best_candidate": f"""
            SELECT ExpID, IonMode, Compound, Chemical, Mass, DTXSID, {near("ToxPiScore")} AS ToxPiScore FROM best""",
        "rank_letter": "SELECT ExpID, IonMode, Compound, Mass, DTXSID, alpha_beta, Class FROM ranked",
        "priority_scores": f"""
            SELECT ExpID, IonMode, Compound, Chemical, Preferred_Name, Mass, DTXSID, {_PI}, Category,
                   Compound_Classification, alpha_beta, Class FROM ranked""",
        "pi_melt": f"""
            SELECT ExpID, IonMode, Chemical, Mass, DTXSID, sub_Pi, {near("height")} AS height, weight, w, wm, wt
            FROM heights""",
        "pi_geometry": f"""
            SELECT ExpID, IonMode, Chemical, Mass, DTXSID, sub_Pi, {near("height")} AS height, weight, w, wm, wt,
                   {near("sum(height * weight) OVER (PARTITION BY ExpID, Chemical)")} AS ToxPi FROM heights""",
        "chart_pages": f"""
            SELECT ExpID, Chemical, {near("s")} AS ToxPiScore, position, CAST(ceil(position / 9.0E0) AS BIGINT) AS page
            FROM (SELECT ExpID, Chemical, s, row_number() OVER (PARTITION BY ExpID ORDER BY s DESC, Chemical) AS position
                  FROM (SELECT ExpID, Chemical, max(ToxPiScore) AS s FROM scored_rows
                        GROUP BY ExpID, Chemical) g) n""",
    }
    return {name: query(text) for name, text in sql.items()}


# Input rows made from every abundance row and every feature; the same text feeds both engines.
NULL_TOKEN_INPUT = """
SELECT CAST(l_partkey AS STRING) AS FeatureNumber,
       CASE WHEN l_returnflag = 'N' THEN ' ' ELSE concat(l_returnflag, l_linestatus) END AS SampleDetail,
       CASE WHEN l_discount = 0 THEN 'NA' WHEN l_tax = 0 THEN '0' WHEN l_linenumber = 3 THEN '-'
            ELSE CAST(l_quantity AS STRING) END AS volume
FROM lineitem
"""
ANNOTATION_INPUT = """
SELECT FeatureNumber, CASE WHEN Score IS NULL THEN '[db, x]'
            WHEN FeatureNumber % 7 = 0 THEN concat('[overall=', CAST(Score AS STRING), ', db=1, x]')
            ELSE concat('[db, overall=', CAST(Score AS STRING), ', x]') END AS Annotations
FROM {features}
"""
