"""SURVEY 1.5, one test per defect of the reference queries: the clinical
answers compute the intent, not the letter."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import clinical
from cohortlens.operators import enrich
from cohortlens.plans.clinical import ClinicalTables, answer


@pytest.fixture(scope="module")
def c(spark):
    db = clinical.load(spark)
    return ClinicalTables(
        demography=db["demography"], hospitalization_discharge=db["admissions"], cardiaccomplications=db["cardiac"],
        patient_precriptions=db["prescriptions"], labs=db["labs"], patienthistory=db["history"],
        responsivenes=db["responses"],
    )


def test_tautological_join_is_an_equi_join(c):
    """ON h.k = h.k crossed every admission with every patient."""
    r = answer(c, "mean_readmission_days_men").first()
    assert r["avg_readmission_days"] == "20 days"  # only patient 101's own readmission


def test_random_age_stays_inside_its_band(spark):
    """21 + floor(r * 10) can reach 30, outside '21-29'."""
    df = spark.range(5000).select(F.col("id").alias("inpatient_number"), F.lit("21-29").alias("agecat"))
    ages = enrich.band_value(df, "agecat", "inpatient_number", seed=9).agg(F.min("value"), F.max("value")).first()
    assert (ages[0], ages[1]) == (21, 29)


def test_birth_year_uses_the_earliest_admission(spark):
    """a patient with several admissions got an arbitrary year."""
    demo = spark.createDataFrame([(1, "21-29")], "inpatient_number long, agecat string")
    adm = spark.createDataFrame([(1, dt.datetime(2019, 5, 1)), (1, dt.datetime(2017, 1, 2)), (1, dt.datetime(2018, 3, 3))],
                                "inpatient_number long, admission_date timestamp_ntz")
    r = enrich.first_event_year(demo, adm, "inpatient_number", "inpatient_number", "admission_date", out="y").first()
    assert r["y"] == 2017


def test_rates_are_exact_not_integer_division(c):
    """integer division before rounding lost all decimals."""
    got = {r["gender"]: r["pct"] for r in answer(c, "gender_share").collect()}
    assert got["Male"] == 44.44


def test_least_likely_is_a_rate_not_a_count(c):
    """'least likely' was computed as a raw count."""
    r = answer(c, "least_readmitted_band").first()
    assert "rate" in r.asDict() and r["rate"] == 0.0


def test_nyha_labels_are_not_shifted(c):
    """class 2 was labelled 'Class I' and class 1 had no label."""
    lab = {r["nyha_cardiac_function_classification"]: r["nyha_class"] for r in
           enrich.code_labels(c.cardiaccomplications, "nyha_cardiac_function_classification",
                              {1: "I", 2: "II", 3: "III", 4: "IV"}, out="nyha_class").collect()}
    assert lab[2] == "II" and lab[1] == "I"
    assert answer(c, "nyha_commonest_type").count() == 4  # one row per class: the commonest type (:183-184)


def test_day_range_is_half_open(c):
    """BETWEEN ... '2017-03-31' lost that day after midnight."""
    days = [r["day"] for r in answer(c, "march_daily_gaps").collect()]
    assert dt.date(2017, 3, 31) in days


def test_second_word_filter_drops_empty(c):
    """split_part past the end is '', so IS NOT NULL filtered nothing."""
    assert answer(c, "drug_second_word").where(F.col("second_word") == "").count() == 0


def test_divide_without_slash_is_a_quotient(c):
    """the query subtracted min(x, y) instead of dividing."""
    got = {(r["dischargeday"], r["visit_times"]): r["discharge_per_visit"] for r in answer(c, "discharge_per_visit").collect()}
    assert got[(7, 2)] == 3 and got[(3, 0)] is None


def test_monocyte_share_is_a_per_patient_ratio(c):
    """monocyte_count / count(wbc) grouped by the value itself."""
    m = {r["agecat"]: r["average_monocyte_percentage"] for r in answer(c, "monocyte_pct_by_band").collect()}
    assert m["69-79"] == round((0.3 / 3.5 + 0.4 / 5.0) / 2 * 100, 2)


def test_child_rows_carry_their_keys(c):
    """the child table was filled with NULL keys."""
    s = answer(c, "patient_history_with_labs")
    assert s.where(F.col("inpatient_number").isNull()).count() == 0
    assert s.where(F.col("systolic_blood_pressure").isNotNull()).count() == c.labs.count()


def test_drug_count_has_no_admission_fan_out(c):
    """joining admissions multiplied the drug count."""
    from cohortlens.operators import groups

    counts = dict((r["inpatient_number"], r["n"]) for r in groups.count_by(c.patient_precriptions, "inpatient_number").collect())
    assert counts[101] == 3  # patient 101 has two admissions and three drugs


def test_round_happens_last(c):
    """rounding before x100 gave whole percents only."""
    r = answer(c, "readmission_vs_death_pct").first()
    assert r["pct_re_admission"] == 66.6667


def test_groups_with_zero_events_are_kept(spark):
    """an inner join to the readmitted counts dropped groups without any."""
    from cohortlens.operators import rates

    df = spark.createDataFrame([("Home", 1), ("Home", 0), ("Transfer", 0)], "destinationdischarge string, re int")
    r = {x["destinationdischarge"]: x["rate"] for x in
         rates.conditional_rate(df, "destinationdischarge", F.col("re") == 1).collect()}
    assert r == {"Home": 50.0, "Transfer": 0.0}


def test_cancer_includes_solid_tumors(c):
    """'cancer' omitted solid_tumor."""
    assert answer(c, "both_failure_kidney_or_cancer").first()["patient_count"] == 3
    assert answer(c, "cancer_patients").first()["unique_cancer_patients"] == 3


def test_bits_are_real_utf8_bits(c):
    """chars x 8 is wrong for multibyte text."""
    r = {x["occupation"]: x["num_of_bits"] for x in answer(c, "occupation_bits").collect()}
    assert r["Ärztin"] == 56


def test_null_bmi_is_not_in_the_low_band(c):
    """NULL BMI landed in '<= 30'."""
    from cohortlens.operators import groups

    b = groups.band_by(c.demography, "bmi", [30], ["<= 30", "> 30"], out="bmi_category")
    got = {r["inpatient_number"]: r["bmi_category"] for r in b.collect()}
    assert got[106] == "unknown" and got[101] == "<= 30"  # 106 has no BMI


def test_recursion_is_bounded_and_complete(c):
    """the recursion only stopped because of LIMIT 10."""
    rows = answer(c, "patients_linked_to_drug", hops=3).collect()
    assert len(rows) == 4  # all rows of the linked patients, each once


def test_crosstab_aligns_by_value(c):
    """a missing category shifted values left."""
    r = {x["admission_year"]: x for x in answer(c, "yearly_outcomes").collect()}
    assert (r[2018]["Alive"], r[2018]["Dead"], r[2018]["DischargeAgainstOrder"]) == (2, 0, 0)


def test_profile_reports_two_sigma_and_quartiles(c):
    """quartiles were labelled '2 std above/below mean'."""
    cols = set(answer(c, "systolic_profile").columns)
    assert {"q1", "q3", "iqr", "lower_2sd", "upper_2sd"} <= cols


def test_outer_join_made_inner_is_said_plainly(c):
    """WHERE age > 50 on the nullable side turned the outer joins inner."""
    assert answer(c, "diabetic_over_50_drugs").where(F.col("drug_name").isNull()).count() == 0


def test_global_rates_in_one_aggregate(c):
    """the statement did not parse; one conditional aggregate instead."""
    r = answer(c, "readmission_vs_death_pct").first()
    assert (r["n_re_admission"], r["n_death"], r["n"]) == (6, 3, 9)
