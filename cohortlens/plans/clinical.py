"""The reference's questions on the clinical schema itself.

A user with the seven clinical tables (see FIXTURES.md) gets every answer
from one call: ``answer(tables, "gender_share")`` or the functions below.
Each function computes the question's *intent* (SURVEY 1.5): real equi-joins
instead of tautological ones, rates instead of raw counts, earliest instead
of arbitrary admissions, NULL groups handled explicitly, whole tables
instead of "any 10 rows".  Labels that must read as in the reference are
listed under "fixed values".

These are not registered in ``__spark_entry__`` (the driver has no clinical
tables); the driver-table restatements live in ``plans.catalog``.
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlens.functions import dates as fd
from cohortlens.functions import mathops as fm
from cohortlens.functions import text as ft
from cohortlens.operators import enrich, groups, joins, links, nested, pivots, ranking, rates, stats
from cohortlens.operators import timeseries as ts
from cohortlens.operators._util import join_null_safe
from cohortlens.sources.schemas import CLINICAL_SCHEMAS, clean_sentinels
from cohortlens.streaming import guards

K = "inpatient_number"

# --- fixed values (labels and symbols as the reference prints them; the
# NYHA class IV label is added here because the reference has no arm for it) --
NYHA_LABELS = {
    1: "Class I: No symptoms of heart failure",
    2: "Class II: Symptoms of heart failure with moderate exertion",
    3: "Class III: Symptoms of heart failure with minimal exertion",
    4: "Class IV: Symptoms of heart failure at rest",
}
KILLIP_LABELS = {
    1: "Class I: No signs of congestion",
    2: "Class II: S3 and basal rales on auscultation",
    3: "Class III: Acute pulmonary oedema",
    4: "Class IV: Cardiogenic shock",
}
PIE_SYMBOLS = '#;o:X"@+-=123456789abcdef'
BAR_SYMBOL = "▰"
WARDS = ["Cardiology", "GeneralWard", "ICU", "Others"]
OUTCOMES = ["Alive", "Dead", "DischargeAgainstOrder"]
READMISSION_FRAMES = {
    "28Days": "re_admission_within_28_days",
    "90Days": "re_admission_within_3_months",
    "180Days": "re_admission_within_6_months",
    "DWithin6months": "death_within_6_months",
}
CANCER_FLAGS = ["solid_tumor", "malignant_lymphoma", "leukemia"]
KIDNEY_OR_CANCER_FLAGS = ["moderate_to_severe_chronic_kidney_disease", "acute_renal_failure", *CANCER_FLAGS]
# ---------------------------------------------------------------------------


@dataclass
class ClinicalTables:
    demography: DataFrame
    hospitalization_discharge: DataFrame
    cardiaccomplications: DataFrame
    patient_precriptions: DataFrame
    labs: DataFrame
    patienthistory: DataFrame
    responsivenes: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, base_dir: str) -> "ClinicalTables":
        """Scan ``{base_dir}/{table}.parquet`` with the declared schemas; the
        ``'null'`` text sentinel of respiratory_support is cleaned on load (F11)."""
        frames = {
            n: spark.read.schema(s).parquet(os.path.join(base_dir, f"{n}.parquet")) for n, s in CLINICAL_SCHEMAS.items()
        }
        frames["hospitalization_discharge"] = clean_sentinels(frames["hospitalization_discharge"], ["respiratory_support"])
        return cls(**frames)


@dataclass(frozen=True)
class Question:
    number: str
    name: str
    fn: Callable[..., DataFrame]


QUESTIONS: dict[str, Question] = {}


def question(number: str, name: str):
    def deco(fn):
        QUESTIONS[name] = Question(number, name, fn)
        return fn

    return deco


def answer(c: ClinicalTables, name: str, **params) -> DataFrame:
    return QUESTIONS[name].fn(c, **params)


def _with_age(c: ClinicalTables, seed: int = 0) -> DataFrame:
    d = c.demography
    return d if "age" in d.columns else enrich.band_value(d, "agecat", K, seed=seed, out="age")


def _avg_as_text(df: DataFrame, by: str, col: str, suffix: str, factor: float = 1.0, out: str = "avg_text") -> DataFrame:
    """``CONCAT(CAST(ROUND(AVG(col) * factor) AS INT), suffix)``."""
    v = F.round(F.avg(col) * F.lit(factor)).cast("bigint")
    return df.groupBy(by).agg(F.concat(v.cast("string"), F.lit(suffix)).alias(out))


# ------------------------------------------------------------------ 1 - 20

@question("Q1", "random_age_in_band")
def random_age_in_band(c: ClinicalTables, seed: int = 0) -> DataFrame:
    return enrich.band_value(c.demography, "agecat", K, seed=seed, out="age")


@question("Q2", "birth_year")
def birth_year(c: ClinicalTables, seed: int = 0) -> DataFrame:
    d = enrich.first_event_year(_with_age(c, seed), c.hospitalization_discharge, K, K, "admission_date", out="_first")
    return d.withColumn("birth_year", (F.col("_first") - F.col("age")).cast("int")).drop("_first")


@question("Q3", "present_age")
def present_age(c: ClinicalTables, as_of: str | None = None, seed: int = 0) -> DataFrame:
    """``as_of=None`` means today (the reference's CURRENT_DATE); pass a date
    for reproducible results."""
    d = birth_year(c, seed)
    if as_of is None:
        age = (F.year(F.current_date()) - F.col("birth_year")).cast("bigint")
    else:
        age = fd.age_as_of("birth_year", as_of)
    return d.select(age.alias("present_age"), *d.columns)


@question("Q4", "gender_share")
def gender_share(c: ClinicalTables, denominator: str = "all") -> DataFrame:
    s = rates.share_of_total(c.demography, "gender", denominator=denominator, count_col="total_count")
    return s.where(F.col("gender").isNotNull())


@question("Q5", "farmers")
def farmers(c: ClinicalTables, occupation: str = "farmer") -> DataFrame:
    return groups.count_by(c.demography, "occupation", where=F.col("occupation") == occupation, out="total_patients")


@question("Q6", "age_band_slices")
def age_band_slices(c: ClinicalTables) -> DataFrame:
    g = groups.count_by(c.demography, "agecat", where=F.col("agecat").isNotNull(), out="value")
    w = Window.orderBy("agecat")  # over the aggregated bands only
    total = F.sum("value").over(Window.partitionBy())
    s = g.select(
        F.row_number().over(w).cast("int").alias("slice"), F.col("agecat").alias("name"), "value",
        (F.col("value") * 100.0 / total).alias("percentage"),
        (F.lit(2 * math.pi) * F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)) / total).alias(
            "radians"),
    )
    sym = F.substring(F.lit(PIE_SYMBOLS), F.col("slice"), 1)
    return s.withColumn("legend", F.concat(F.repeat(sym, 2), F.lit(" "), F.col("name"), F.lit(" : "),
                                           F.col("value").cast("string"), F.lit(" : "),
                                           F.round("percentage").cast("bigint").cast("string"), F.lit("%")))


@question("Q7", "bmi_slabs")
def bmi_slabs(c: ClinicalTables) -> DataFrame:
    d = c.demography.where((F.col("bmi") != 0) & (F.col("bmi") < 50))
    return groups.histogram(d, "bmi", 0, 50, 5, bucket="bmi_ranges", out="patients_counts")


@question("Q8", "share_over_70")
def share_over_70(c: ClinicalTables, seed: int = 0) -> DataFrame:
    return rates.share_where(_with_age(c, seed), F.col("age") > 70, match_col="patients_over_70")


@question("Q9", "least_readmitted_band")
def least_readmitted_band(c: ClinicalTables) -> DataFrame:
    j = c.demography.where(F.col("agecat").isNotNull()).join(c.hospitalization_discharge, K)
    r = rates.conditional_rate(j, "agecat", F.col("re_admission_within_28_days") == 1, flag_col="readmitted")
    return r.orderBy(F.col("rate").asc(), F.col("agecat").asc()).limit(1)


@question("Q10", "serial_numbers")
def serial_numbers(c: ClinicalTables) -> DataFrame:
    return ranking.serial_number(c.demography, [(K, True)])


@question("Q11", "mean_readmission_days_men")
def mean_readmission_days_men(c: ClinicalTables, gender: str = "Male") -> DataFrame:
    j = c.hospitalization_discharge.join(c.demography.where(F.col("gender") == gender), K)
    return _avg_as_text(j, "gender", "readmission_time_days_from_admission", " days", out="avg_readmission_days")


@question("Q12", "nyha_commonest_type")
def nyha_commonest_type(c: ClinicalTables, labels: Mapping[int, str] = NYHA_LABELS) -> DataFrame:
    lab = enrich.code_labels(c.cardiaccomplications, "nyha_cardiac_function_classification", labels, out="nyha_class")
    return groups.top_per_group(lab, "nyha_class", "type_of_heart_failure")


@question("Q13", "killip_severity")
def killip_severity(c: ClinicalTables, labels: Mapping[int, str] = KILLIP_LABELS) -> DataFrame:
    return enrich.code_labels(c.cardiaccomplications, "killip_grade", labels, out="killip_grade_severity_score")


@question("Q14", "mean_height_women_cm")
def mean_height_women_cm(c: ClinicalTables, gender: str = "Female") -> DataFrame:
    return _avg_as_text(c.demography.where(F.col("gender") == gender), "gender", "height", " cm", 100.0, out="avg_height")


@question("Q15", "severity_outcome_corr")
def severity_outcome_corr(c: ClinicalTables) -> DataFrame:
    j = c.hospitalization_discharge.join(c.cardiaccomplications, K)
    return stats.correlate(j, "killip_grade", "dischargeday", scale=None, out="correlation_value")


@question("Q16", "march_daily_gaps")
def march_daily_gaps(c: ClinicalTables, start: str = "2017-03-01", end: str = "2017-04-01") -> DataFrame:
    return ts.day_gap(c.hospitalization_discharge, "admission_date", start, end)


@question("Q17", "demographic_conditions_view")
def demographic_conditions_view(c: ClinicalTables, view: str | None = "patient_demographic_details_view") -> DataFrame:
    cond = c.cardiaccomplications.select(K, "myocardial_infarction", "peripheral_vascular_disease", "congestive_heart_failure")
    demo = c.demography.select(K, "gender", "height", "weight")
    v = joins.outer_join(cond, demo, K)  # demography RIGHT JOIN cardiaccomplications
    if view:
        v.createOrReplaceTempView(view)
    return v


@question("Q18", "unique_patients_per_drug")
def unique_patients_per_drug(c: ClinicalTables, prefix: str = "Hydrochloroth") -> DataFrame:
    p = c.patient_precriptions.where(F.col("drug_name").ilike(ft.escape_like(prefix) + "%"))
    return groups.count_by(p, "drug_name", distinct=K, out="unique_patient_count")


@question("Q19", "drug_second_word")
def drug_second_word(c: ClinicalTables) -> DataFrame:
    p = c.patient_precriptions.select("drug_name", ft.word("drug_name", 2).alias("second_word"))
    return p.where(F.col("second_word").isNotNull()).distinct()


@question("Q20", "e_then_x_drugs")
def e_then_x_drugs(c: ClinicalTables) -> DataFrame:
    return c.patient_precriptions.where(F.col("drug_name").like("E%x%")).select("drug_name")


# ------------------------------------------------------------------ 21 - 40

@question("Q21", "readmission_crosstab")
def readmission_crosstab(c: ClinicalTables, wards: Sequence[str] = WARDS,
                         frames: Mapping[str, str] = READMISSION_FRAMES) -> DataFrame:
    long = pivots.flag_counts(c.hospitalization_discharge, "admission_ward",
                              {k: F.col(v) == 1 for k, v in frames.items()}, flag_col="time_frame", out="n")
    return long.groupBy("time_frame").agg(
        *[F.coalesce(F.sum(F.when(F.col("admission_ward") == w, F.col("n"))), F.lit(0)).cast("bigint").alias(w) for w in wards]
    )


@question("Q22", "deleted_patients")
def deleted_patients(c: ClinicalTables, next_snapshot: DataFrame | None = None, strict: bool = False) -> DataFrame:
    nxt = next_snapshot if next_snapshot is not None else c.demography
    return guards.delete_guard(c.demography, nxt, K, strict=strict)


@question("Q23", "admission_span_days")
def admission_span_days(c: ClinicalTables) -> DataFrame:
    return ts.date_span(c.hospitalization_discharge, "admission_date").select(F.col("span_days").alias("total_days"))


@question("Q24", "discharge_per_visit")
def discharge_per_visit(c: ClinicalTables) -> DataFrame:
    h = c.hospitalization_discharge.where(F.col("dischargeday").isNotNull() & F.col("visit_times").isNotNull())
    return h.select(K, "dischargeday", "visit_times",
                    fm.quotient("dischargeday", "visit_times").alias("discharge_per_visit"),
                    F.when(F.col("visit_times") != 0, fm.remainder_capped("dischargeday", "visit_times"))
                    .alias("discharge_minus_least"))


@question("Q25", "admission_way_letters")
def admission_way_letters(c: ClinicalTables) -> DataFrame:
    h = c.hospitalization_discharge
    return h.groupBy(F.left("admission_way", F.lit(1)).alias("first_letter")).agg(
        F.count(F.lit(1)).cast("bigint").alias("patient_count"))


@question("Q26", "personal_markers")
def personal_markers(c: ClinicalTables) -> DataFrame:
    j = c.demography.select(K, "gender", "bmi").join(c.labs.select(K, "map_value", "pulse"), K)
    return nested.collect_sorted(j, K, ["gender", "bmi", "map_value", "pulse"], ["map_value", "pulse"], out="markers")


@question("Q27", "hydro_drugs")
def hydro_drugs(c: ClinicalTables) -> DataFrame:
    return c.patient_precriptions.where(F.col("drug_name").ilike("%hydro%")).select(F.col("drug_name").alias("H20"))


@question("Q29", "cancer_patients")
def cancer_patients(c: ClinicalTables, flags: Sequence[str] = CANCER_FLAGS) -> DataFrame:
    if not flags:
        raise ValueError("name at least one diagnosis flag")
    cond = None
    for f in flags:
        cond = (F.col(f) == 1) if cond is None else cond | (F.col(f) == 1)
    return groups.count_by(c.patienthistory, where=cond, distinct=K, out="unique_cancer_patients")


@question("Q30", "admissions_moving_average")
def admissions_moving_average(c: ClinicalTables, spine: bool = True) -> DataFrame:
    m = ts.counts_by_period(c.hospitalization_discharge, "admission_date", "month", spine=spine,
                            out_period="admission_month", out="patient_count")
    return ts.moving_average(m, "admission_month", "patient_count", 2, out="moving_average_3_months")


@question("Q31", "oxygen_support_feb_2017")
def oxygen_support_feb_2017(c: ClinicalTables, start: str = "2017-02-01", end: str = "2017-03-01") -> DataFrame:
    h = clean_sentinels(c.hospitalization_discharge, ["respiratory_support"])
    return h.where(
        (F.col("oxygen_inhalation") == "OxygenTherapy") & F.col("respiratory_support").isNotNull()
        & (F.col("admission_date") >= F.lit(start).cast("timestamp_ntz"))
        & (F.col("admission_date") < F.lit(end).cast("timestamp_ntz"))
    ).select(K, "respiratory_support")


@question("Q32", "both_failure_peaks")
def both_failure_peaks(c: ClinicalTables, hf_type: str = "Both") -> DataFrame:
    j = c.cardiaccomplications.where(F.col("type_of_heart_failure") == hf_type).select(K, "type_of_heart_failure").join(
        c.labs, K)
    return j.groupBy(K, "type_of_heart_failure").agg(F.max("map_value").alias("highest_map"),
                                                      F.max("pulse").alias("highest_pulse"))


@question("Q34", "monocyte_pct_by_band")
def monocyte_pct_by_band(c: ClinicalTables) -> DataFrame:
    j = c.demography.select(K, "agecat").join(c.labs, K)
    r = fm.safe_ratio("monocyte_count", "white_blood_cell")
    return j.groupBy("agecat").agg(F.round(F.avg(r) * 100, 2).alias("average_monocyte_percentage"))


@question("Q35", "patient_history_with_labs")
def patient_history_with_labs(c: ClinicalTables) -> DataFrame:
    parent = c.demography.select(K, "gender", "agecat")
    child = parent.join(c.labs.select(K, "systolic_blood_pressure", "diastolic_blood_pressure"), K)
    return enrich.stack_child(parent, child)


@question("Q36", "admission_calendar")
def admission_calendar(c: ClinicalTables) -> DataFrame:
    return ts.calendar_spine(c.hospitalization_discharge, "admission_date", "day")


@question("Q37", "group_share")
def group_share(c: ClinicalTables, group_column: str = "admission_ward") -> DataFrame:
    return rates.share_of_total(c.hospitalization_discharge, group_column, count_col="patient_count",
                                pct_col="percentage").withColumnRenamed(group_column, "group_value")


@question("Q38", "cci_parity")
def cci_parity(c: ClinicalTables) -> DataFrame:
    h = c.patienthistory
    return h.select("cci_score", K, fm.parity(F.round("cci_score").cast("bigint"), "Even", "odd").alias("score_odd_even"))


@question("Q39", "monthly_neighbours")
def monthly_neighbours(c: ClinicalTables) -> DataFrame:
    m = ts.counts_by_period(c.hospitalization_discharge, "admission_date", "month", out_period="month",
                            out="hospitalization_count")
    return ts.neighbours(m, "month", "hospitalization_count", prev="previous_month", next_="next_month")


@question("Q40", "patient_details_text")
def patient_details_text(c: ClinicalTables, patient: int | None = None, seed: int = 0) -> DataFrame:
    demo = _with_age(c, seed).select(K, "gender", "age")
    adm = c.hospitalization_discharge.select(K, "outcome_during_hospitalization", "admission_ward", "admission_date")
    d = nested.entity_digest([demo, c.patient_precriptions.select(K, "drug_name"), adm], K,
                             [K, "gender", "age", "drug_name", "outcome_during_hospitalization", "admission_ward"],
                             ["admission_date", "drug_name"], sep=",", field_sep=":", out="patient_details")
    return d.where(F.col(K) == patient) if patient is not None else d


# ------------------------------------------------------------------ 41 - 60

@question("Q41", "many_drug_patients")
def many_drug_patients(c: ClinicalTables, more_than: int = 15, seed: int = 0) -> DataFrame:
    drugs = groups.count_by(c.patient_precriptions, K, having=F.col("drugs") > more_than, out="drugs")
    j = drugs.join(_with_age(c, seed).select(K, "age"), K).join(
        c.hospitalization_discharge.select(K, "outcome_during_hospitalization"), K)
    return j.select(K, "age", "outcome_during_hospitalization", "drugs")


@question("Q42", "patient_lookup")
def patient_lookup(c: ClinicalTables, ids: DataFrame, strict: bool = False) -> DataFrame:
    return guards.lookup_or_report(c.demography, K, ids, ["gender"], strict=strict)


@question("Q43", "random_patients")
def random_patients(c: ClinicalTables, n: int = 10, seed: int = 0) -> DataFrame:
    return ranking.stable_sample(c.cardiaccomplications.select(K, "type_of_heart_failure"), K, n, seed)


@question("Q44", "long_drug_names")
def long_drug_names(c: ClinicalTables, longer_than: int = 20) -> DataFrame:
    p = c.patient_precriptions.select("drug_name", ft.char_count("drug_name").alias("length_of_drug_name"))
    return p.where(F.col("length_of_drug_name") > longer_than)


@question("Q45", "cci_rank")
def cci_rank(c: ClinicalTables) -> DataFrame:
    h = c.patienthistory.where(F.col("cci_score").isNotNull()).select(K, "cci_score")
    return ranking.rank_rows(h, [("cci_score", False)], out="rank")


@question("Q46", "sound_to_pain_ratio")
def sound_to_pain_ratio(c: ClinicalTables) -> DataFrame:
    return rates.category_ratio(c.responsivenes, "consciousness", "ResponsiveToSound", "ResponsiveToPain",
                                out="sound_to_pain_ratio")


@question("Q47", "max_map_by_way_occupation")
def max_map_by_way_occupation(c: ClinicalTables) -> DataFrame:
    j = c.labs.select(K, "map_value").join(c.hospitalization_discharge.select(K, "admission_way"), K).join(
        c.demography.select(K, "occupation"), K)
    return j.groupBy("admission_way", "occupation").agg(F.max("map_value").alias("max_map"))


@question("Q48", "highest_bmi")
def highest_bmi(c: ClinicalTables) -> DataFrame:
    return links.extreme_rows(c.demography.select(K, "bmi"), "bmi", "max")


@question("Q49", "leukopenia")
def leukopenia(c: ClinicalTables, below: float = 4.0) -> DataFrame:
    return c.labs.where(F.col("white_blood_cell") < below).select(K)


@question("Q50", "busiest_weekday")
def busiest_weekday(c: ClinicalTables) -> DataFrame:
    w = ts.weekday_counts(c.hospitalization_discharge, "admission_date", days=[1, 2, 3, 4, 5], out="frequency")
    return w.orderBy(F.col("frequency").desc(), F.col("dow").asc()).limit(1).withColumnRenamed("dow", "days_of_week")


@question("Q51", "band_bar_chart")
def band_bar_chart(c: ClinicalTables, more_than: int = 100) -> DataFrame:
    g = groups.count_by(c.demography, "agecat", having=F.col("frequency") > more_than, out="frequency")
    return g.withColumn("bar_chart", ft.text_bar("frequency", g.agg(F.max("frequency")).scalar(), symbol=BAR_SYMBOL))


@question("Q52", "ddimer_variance_corr")
def ddimer_variance_corr(c: ClinicalTables) -> DataFrame:
    j = c.labs.join(c.patienthistory.select(K, "cci_score"), K, "left")
    return j.agg(F.round(F.var_samp("d_dimer"), 2).alias("variation"),
                 F.round(F.corr("d_dimer", "cci_score"), 2).alias("correlation"))


@question("Q53", "lowest_death_rate_ward")
def lowest_death_rate_ward(c: ClinicalTables) -> DataFrame:
    r = rates.conditional_rate(c.hospitalization_discharge, "admission_ward",
                               F.col("time_of_death__days_from_admission").isNotNull(), flag_col="outcome_death_frequency")
    return r.orderBy(F.col("rate").asc(), F.col("admission_ward").asc()).limit(1)


@question("Q54", "coma_diabetes_pct")
def coma_diabetes_pct(c: ClinicalTables, coma_gcs: int = 8) -> DataFrame:
    j = c.responsivenes.join(c.patienthistory.select(K, "diabetes"), K, "left").where(F.col("gcs") <= coma_gcs)
    return rates.conditional_rate(j, [], F.col("diabetes") == 1, scale=2, count_col="in_coma",
                                  flag_col="with_diabetes", rate_col="percentage")


@question("Q55", "youngest_patient_drugs")
def youngest_patient_drugs(c: ClinicalTables, seed: int = 0) -> DataFrame:
    young = links.extreme_rows(_with_age(c, seed).select(K, "age"), "age", "min")
    return young.join(c.patient_precriptions, K).select("age", "drug_name")


@question("Q56", "gcs_checked_split")
def gcs_checked_split(c: ClinicalTables, above: int = 8) -> DataFrame:
    """The accepted rows of the ``gcs > 8`` check; see guards.constrained_ingest
    for the rejected side with reasons."""
    accepted, _ = guards.constrained_ingest(c.responsivenes, {"gcs_above_8": F.col("gcs") > above})
    return accepted


@question("Q57", "palindromes")
def palindromes(c: ClinicalTables, column: str = "occupation") -> DataFrame:
    w = c.demography.select(F.col(column).alias("words")).where(F.col("words").isNotNull()).distinct()
    return w.select("words", ft.is_palindrome("words").alias("is_palindrome"))


@question("Q58", "common_visits_readmitted")
def common_visits_readmitted(c: ClinicalTables) -> DataFrame:
    return groups.top_group(c.hospitalization_discharge, "visit_times",
                            where=F.col("re_admission_within_6_months") == 1, out="frequency")


@question("Q60", "gcd_lcm_columns")
def gcd_lcm_columns(c: ClinicalTables) -> DataFrame:
    h = c.hospitalization_discharge.select(K, "dischargeday", "visit_times")
    return fm.with_gcd_lcm(h, "dischargeday", "visit_times")


# ------------------------------------------------------------------ 61 - 80

@question("Q61", "readmission_halves")
def readmission_halves(c: ClinicalTables) -> DataFrame:
    r = rates.conditional_rate(c.hospitalization_discharge, "destinationdischarge",
                               F.col("re_admission_within_28_days") == 1, scale=2,
                               count_col="total_patients", flag_col="total_readmitted", rate_col="readmission_rate")
    h = ranking.ntile_rows(r, 2, [("readmission_rate", False), ("destinationdischarge", True)], out="part",
                           method="window")  # one row per destination
    return h.withColumn("category", F.when(F.col("part") == 1, F.lit("High Rate of Readmission"))
                        .otherwise(F.lit("Low Rate of Readmission"))).drop("part")


@question("Q63", "id_age_gender_text")
def id_age_gender_text(c: ClinicalTables, seed: int = 0) -> DataFrame:
    return _with_age(c, seed).select(K, ft.join_text([K, "age", "gender"], ";").alias("concat"))


@question("Q64", "reversed_drug_names")
def reversed_drug_names(c: ClinicalTables) -> DataFrame:
    d = c.patient_precriptions.select("drug_name").distinct()
    return d.select("drug_name", F.reverse("drug_name").alias("reversed"))


@question("Q65", "gcs_variance")
def gcs_variance(c: ClinicalTables) -> DataFrame:
    return stats.spread(c.responsivenes, "gcs", scale=None).select(F.col("var_pop").alias("variance"))


@question("Q67", "month_number_name")
def month_number_name(c: ClinicalTables, pad_name: bool = False) -> DataFrame:
    name = F.date_format("admission_date", "MMMM")
    return c.hospitalization_discharge.select(K, "admission_date", F.date_format("admission_date", "MM").alias("month_number"),
                                              (F.rpad(name, 9, " ") if pad_name else name).alias("month_name"))


@question("Q68", "both_failure_kidney_or_cancer")
def both_failure_kidney_or_cancer(c: ClinicalTables, flags: Sequence[str] = KIDNEY_OR_CANCER_FLAGS) -> DataFrame:
    if not flags:
        raise ValueError("name at least one diagnosis flag")
    cond = None
    for f in flags:
        cond = (F.col(f) == 1) if cond is None else cond | (F.col(f) == 1)
    j = c.patienthistory.where(cond).select(K).join(
        c.cardiaccomplications.where(F.col("type_of_heart_failure") == "Both").select(K), K, "left_semi")
    return groups.count_by(j, distinct=K, out="patient_count")


@question("Q69", "occupation_bits")
def occupation_bits(c: ClinicalTables) -> DataFrame:
    return c.demography.select(K, "occupation", ft.char_count("occupation").alias("num_of_chars"),
                               ft.bit_count("occupation").alias("num_of_bits"))


@question("Q70", "add_todays_date")
def add_todays_date(c: ClinicalTables, as_of: str | None = None) -> DataFrame:
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return enrich.add_if_missing(c.cardiaccomplications, "todaysdate", day)


@question("Q71", "second_bmi_of_top_myoglobin")
def second_bmi_of_top_myoglobin(c: ClinicalTables, k: int = 5) -> DataFrame:
    top = ranking.top_k_with_ties(c.labs.select(K, "myoglobin"), "myoglobin", k)
    j = top.join(c.demography.select(K, "bmi"), K)
    return j.orderBy(F.col("bmi").desc_nulls_last(), F.col(K).asc()).offset(1).limit(1).select(K, "bmi")


@question("Q72", "pulse_mean_std")
def pulse_mean_std(c: ClinicalTables) -> DataFrame:
    return c.labs.agg(F.avg("pulse").alias("mean_pulse"), F.stddev_samp("pulse").alias("stddev_pulse"))


@question("Q73", "drop_age")
def drop_age(c: ClinicalTables, seed: int = 0) -> DataFrame:
    return enrich.drop_if_present(_with_age(c, seed), "age")


@question("Q74", "cci_by_bmi_band")
def cci_by_bmi_band(c: ClinicalTables, cut: float = 30.0, null_label: str | None = "unknown") -> DataFrame:
    j = c.demography.select(K, groups.band("bmi", [cut], [f"<= {cut:g}", f"> {cut:g}"], null_label=null_label)
                            .alias("bmi_category")).join(c.patienthistory.select(K, "cci_score"), K)
    return j.groupBy("bmi_category").agg(F.avg("cci_score").alias("average_cci_score"))


@question("Q75", "bmi_alerts")
def bmi_alerts(c: ClinicalTables, above: float = 40.0, frame: DataFrame | None = None) -> DataFrame:
    src = frame if frame is not None else c.demography
    msg = F.concat(F.lit("Warning: patient "), F.col(K).cast("string"), F.lit(" has BMI "), F.col("bmi").cast("string"),
                   F.lit(", a high risk of heart problems"))
    return guards.alerts(src, F.col("bmi") > above, msg, keep=[K])


@question("Q76", "most_obese_band_gender")
def most_obese_band_gender(c: ClinicalTables, obese_from: float = 30.0) -> DataFrame:
    return groups.top_group(c.demography, ["agecat", "gender"], where=F.col("bmi") >= obese_from, out="obese_patient_count")


@question("Q77", "responses_json")
def responses_json(c: ClinicalTables) -> DataFrame:
    return nested.json_per_entity(c.responsivenes, K, ["consciousness", "gcs"], out="response_detail")


@question("Q78", "upper_respiratory_failure")
def upper_respiratory_failure(c: ClinicalTables) -> DataFrame:
    return enrich.apply_update(c.patienthistory, {"type_ii_respiratory_failure": F.upper("type_ii_respiratory_failure")})


@question("Q79", "digoxin_or_furosemide")
def digoxin_or_furosemide(c: ClinicalTables) -> DataFrame:
    return c.patient_precriptions.where(F.col("drug_name").rlike("(?i)(Digoxin|Furosemide)")).select(K, "drug_name")


@question("Q80", "patients_linked_to_drug")
def patients_linked_to_drug(c: ClinicalTables, drug: str = "Furosemide injection", hops: int = 1) -> DataFrame:
    return links.linked_rows(c.patient_precriptions, K, "drug_name", F.col("drug_name") == drug, hops=hops)


# ------------------------------------------------------------ additional 1-25

@question("B1", "yearly_outcomes")
def yearly_outcomes(c: ClinicalTables, outcomes: Sequence[str] = OUTCOMES) -> DataFrame:
    h = c.hospitalization_discharge.withColumn("admission_year", F.year("admission_date"))
    return pivots.pivot_counts(h, "admission_year", "outcome_during_hospitalization", outcomes, prefix="")


@question("B2", "gender_with_max_cci_per_band")
def gender_with_max_cci_per_band(c: ClinicalTables) -> DataFrame:
    j = c.demography.select(K, "agecat", "gender").join(c.patienthistory.select(K, "cci_score"), K)
    top = ranking.first_value_by(j.where(F.col("cci_score").isNotNull()), ["agecat"], "gender",
                                 [("cci_score", False), (K, True)], out="gender_with_max_cci_score")
    # on every record, as the reference shows it; records without a band are a
    # partition of their own, as under PARTITION BY
    return join_null_safe(j, top, ["agecat"], "left")


@question("B3", "fifth_highest_bmi")
def fifth_highest_bmi(c: ClinicalTables, n: int = 5) -> DataFrame:
    return ranking.nth_highest(c.demography.where(F.col("bmi").isNotNull()), "bmi", n, out="fifth_highest_bmi")


@question("B4", "bmi_quartiles")
def bmi_quartiles(c: ClinicalTables) -> DataFrame:
    return ranking.ntile_rows(c.demography.select(K, "bmi"), 4, [("bmi", False), (K, True)], out="bmi_quartile")


@question("B5", "glucose_cume_dist")
def glucose_cume_dist(c: ClinicalTables) -> DataFrame:
    j = c.labs.select(K, "glucose_blood_gas").join(c.patienthistory.where(F.col("diabetes") == 1).select(K), K)
    return ranking.cume_dist_rows(j.where(F.col("glucose_blood_gas").isNotNull()), [("glucose_blood_gas", True)],
                                  out="cum_dist")


@question("B6", "systolic_profile")
def systolic_profile(c: ClinicalTables, method: str = "exact", scale: int = 1) -> DataFrame:
    j = c.labs.select(K, "systolic_blood_pressure").join(c.demography.select(K, "agecat"), K)
    return groups.profile(j, "agecat", "systolic_blood_pressure", method=method, scale=scale)


@question("B7", "band_support_text")
def band_support_text(c: ClinicalTables) -> DataFrame:
    j = c.demography.select(K, "agecat").join(
        clean_sentinels(c.hospitalization_discharge, ["respiratory_support"]).select(K, "respiratory_support"), K)
    return j.select(K, F.concat_ws(";", F.col(K).cast("string"), F.coalesce("agecat", F.lit("")),
                                   F.coalesce("respiratory_support", F.lit("n/a"))).alias("concat"))


@question("B8", "diabetic_over_50_drugs")
def diabetic_over_50_drugs(c: ClinicalTables, older_than: int = 50, seed: int = 0) -> DataFrame:
    pts = _with_age(c, seed).where(F.col("age") > older_than).select(K).join(
        c.patienthistory.where(F.col("diabetes") == 1).select(K), K)
    # WHERE on the outer side made the reference's outer joins inner: said plainly
    return pts.join(c.patient_precriptions, K).groupBy("drug_name").agg(F.count(K).cast("bigint").alias("totalpatients"))


@question("B9", "common_band_death_6m")
def common_band_death_6m(c: ClinicalTables) -> DataFrame:
    j = c.demography.select(K, "agecat").join(c.hospitalization_discharge.select(K, "death_within_6_months"), K)
    return groups.top_group(j, "agecat", where=F.col("death_within_6_months") == 1,
                            out="frequency_of_patientsindeath_in6months")


@question("B10", "urban_residents")
def urban_residents(c: ClinicalTables) -> DataFrame:
    return farmers(c, "UrbanResident")


@question("B11", "mean_readmission_days_women")
def mean_readmission_days_women(c: ClinicalTables) -> DataFrame:
    return mean_readmission_days_men(c, "Female")


@question("B12", "mean_height_men_cm")
def mean_height_men_cm(c: ClinicalTables) -> DataFrame:
    return mean_height_women_cm(c, "Male")


@question("B13", "top_drug_in_month")
def top_drug_in_month(c: ClinicalTables, start: str = "2018-10-01", end: str = "2018-11-01") -> DataFrame:
    h = c.hospitalization_discharge.where((F.col("admission_date") >= F.lit(start).cast("timestamp_ntz"))
                                          & (F.col("admission_date") < F.lit(end).cast("timestamp_ntz"))).select(K)
    return groups.top_group(h.join(c.patient_precriptions, K), "drug_name", out="prescription_count")


@question("B14", "diabetic_pct_by_band")
def diabetic_pct_by_band(c: ClinicalTables) -> DataFrame:
    j = c.demography.select(K, "agecat").join(c.patienthistory.select(K, "diabetes"), K).join(
        c.cardiaccomplications.select(K), K)
    return rates.conditional_rate(j, "agecat", F.col("diabetes") == 1, count_col="totalheartfailurepatients",
                                  flag_col="diabeticheartfailurepatients", rate_col="percentagediabetic")


@question("B15", "readmission_death_by_type_kidney")
def readmission_death_by_type_kidney(c: ClinicalTables) -> DataFrame:
    j = c.cardiaccomplications.select(K, "type_of_heart_failure").join(
        c.patienthistory.select(K, "moderate_to_severe_chronic_kidney_disease"), K).join(c.hospitalization_discharge, K)
    return j.groupBy("type_of_heart_failure", "moderate_to_severe_chronic_kidney_disease").agg(
        F.count_if(F.col("re_admission_within_6_months") == 1).cast("bigint").alias("readmissioncount"),
        F.count_if(F.col("death_within_6_months") == 1).cast("bigint").alias("deathcount"))


@question("B16", "readmitted_by_killip_type")
def readmitted_by_killip_type(c: ClinicalTables) -> DataFrame:
    j = c.cardiaccomplications.join(c.hospitalization_discharge.where(F.col("re_admission_within_6_months") == 1)
                                    .select(K), K)
    return groups.count_by(j, ["killip_grade", "type_of_heart_failure"], out="readmission_count")


@question("B17", "pressure_difference_mi")
def pressure_difference_mi(c: ClinicalTables) -> DataFrame:
    j = c.labs.join(c.cardiaccomplications.where(F.col("myocardial_infarction") == 1).select(K), K)
    return j.select(K, "systolic_blood_pressure", "diastolic_blood_pressure",
                    (F.col("systolic_blood_pressure") - F.col("diastolic_blood_pressure")).alias("pressure_difference"))


@question("B18", "uric_acid_mi")
def uric_acid_mi(c: ClinicalTables) -> DataFrame:
    j = c.labs.join(c.cardiaccomplications.where(F.col("myocardial_infarction") == 1).select(K), K)
    return stats.min_max_avg(j, "uric_acid", scale=None)


@question("B19", "mortality_28d_high_nyha")
def mortality_28d_high_nyha(c: ClinicalTables, above: int = 3) -> DataFrame:
    j = c.cardiaccomplications.where(F.col("nyha_cardiac_function_classification") > above).join(
        c.hospitalization_discharge, K)
    return rates.conditional_rate(j, "nyha_cardiac_function_classification", F.col("death_within_28_days") == 1,
                                  rate_col="mortality_rate")


@question("B20", "cumulative_admissions")
def cumulative_admissions(c: ClinicalTables) -> DataFrame:
    d = ts.counts_by_period(c.hospitalization_discharge, "admission_date", "day", out_period="admission_day",
                            out="daily_admissions")
    return ts.cumulative(d, "admission_day", "daily_admissions", out="cumulative_admissions")


@question("B21", "mean_pressures_by_band")
def mean_pressures_by_band(c: ClinicalTables) -> DataFrame:
    j = c.demography.select(K, "agecat").join(c.labs, K)
    return j.groupBy("agecat").agg(F.avg("systolic_blood_pressure").alias("avg_systolic_bp"),
                                   F.avg("diastolic_blood_pressure").alias("avg_diastolic_bp"))


@question("B22", "heart_failure_pct_by_band")
def heart_failure_pct_by_band(c: ClinicalTables) -> DataFrame:
    # patients are counted once, however many complication rows they have
    failing = c.cardiaccomplications.groupBy(K).agg(F.max("congestive_heart_failure").alias("congestive_heart_failure"))
    j = c.demography.select(K, "agecat").join(failing, K, "left")
    return rates.conditional_rate(j, "agecat", F.col("congestive_heart_failure") == 1, count_col="total",
                                  flag_col="heart_failure_count", rate_col="percentage")


@question("B23", "hypertension_low_lvef")
def hypertension_low_lvef(c: ClinicalTables, lvef_below: float = 50.0) -> DataFrame:
    j = c.demography.select(K).join(c.labs, K).join(c.cardiaccomplications.select(K, "lvef"), K)
    cond = ((F.col("systolic_blood_pressure") > 140) | (F.col("diastolic_blood_pressure") > 90)) & (F.col("lvef") < lvef_below)
    return j.where(cond).select(K, "systolic_blood_pressure", "diastolic_blood_pressure", "lvef")


@question("B24", "readmission_vs_death_pct")
def readmission_vs_death_pct(c: ClinicalTables) -> DataFrame:
    return rates.multi_rate(c.hospitalization_discharge, {
        "re_admission": F.col("re_admission_within_6_months") == 1, "death": F.col("death_within_6_months") == 1,
    })


@question("B25", "admissions_by_quarter")
def admissions_by_quarter(c: ClinicalTables) -> DataFrame:
    h = c.hospitalization_discharge
    return h.groupBy(F.quarter("admission_date").cast("bigint").alias("quarter")).agg(
        F.count(F.lit(1)).cast("bigint").alias("admissions_count"))
