"""Operators on hand-made clinical rows, asserting the *intent* of each
reference question (SURVEY 1.5), with invented ids."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

import clinical
from cohortlens.functions import mathops as fm
from cohortlens.functions import text as ft
from cohortlens.operators import enrich, groups, links, nested, pivots, ranking, rates, stats
from cohortlens.operators import timeseries as ts
from cohortlens.sources import clean_sentinels
from cohortlens.streaming import guards


@pytest.fixture(scope="module")
def db(spark):
    return clinical.load(spark)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def test_share_of_total_gender(db):  # Q4, Q37
    res = rates.share_of_total(db["demography"], "gender")
    got = {r["gender"]: (r["n"], r["pct"]) for r in res.collect()}
    assert got == {"Male": (4, 44.44), "Female": (4, 44.44), None: (1, 11.11)}
    nn = rates.share_of_total(db["demography"], "gender", denominator="non_null")
    assert {r["gender"]: r["pct"] for r in nn.collect()} == {"Male": 50.0, "Female": 50.0}
    tr = rates.share_of_total(db["demography"], "gender", truncate=True)
    assert {r["gender"]: r["pct"] for r in tr.collect()}["Male"] == 44


def test_share_where_and_count(db):  # Q5, Q8
    assert groups.count_by(db["demography"], where=F.col("occupation") == "farmer").first()["n"] == 4
    r = rates.share_where(db["demography"], F.col("agecat").isin("69-79", "79-89", "89-110")).first()
    assert (r["n"], r["n_match"], r["pct"]) == (9, 6, 66.67)


def test_histogram_bmi(db):  # Q7: 0 below lo, bins+1 at/above hi, NULL own row
    h = groups.histogram(db["demography"], "bmi", 0, 50, 5)
    got = dict(rows(h, "bucket", "n"))
    assert got[6] == 1 and got[5] == 3 and got[1] == 1 and got[3] == 2 and got[None] == 1


def test_conditional_rate_and_least(db, spark):  # Q9 intent: rate, not raw count
    j = db["demography"].join(db["admissions"], "inpatient_number")
    r = rates.conditional_rate(j, "agecat", F.col("re_admission_within_28_days") == 1)
    got = {x["agecat"]: (x["n"], x["n_flag"], x["rate"]) for x in r.collect()}
    assert got["21-29"] == (3, 2, 66.6667)
    low = r.where(F.col("agecat").isNotNull()).orderBy("rate", "agecat").first()
    assert low["rate"] == 0.0


def test_join_avg_text(db):  # Q11 / B11: real equi-join, mean as 'n days'
    j = db["admissions"].join(db["demography"].where(F.col("gender") == "Male"), "inpatient_number")
    m = j.agg(F.avg("readmission_time_days_from_admission").alias("m")).first()["m"]
    assert m == 20.0  # 101 has 20.0 and NULL; 105/108 NULL


def test_top_per_group_nyha(db):  # Q12: commonest HF type per NYHA class
    labels = enrich.code_labels(db["cardiac"], "nyha_cardiac_function_classification",
                                {1: "I", 2: "II", 3: "III", 4: "IV"}, out="nyha")
    top = groups.top_per_group(labels, "nyha", "type_of_heart_failure")
    got = {r["nyha"]: r["type_of_heart_failure"] for r in top.collect()}
    assert got == {"I": "Right", "II": "Both", "III": "Left", "IV": "Both"}  # II: 1-1 tie, item order


def test_day_gap_half_open(db):  # Q16: 23:59 on the 31st is inside March
    d = ts.day_gap(db["admissions"], "admission_date", "2017-03-01", "2017-04-01")
    got = d.collect()
    assert [(r["day"], r["n"]) for r in got] == [(dt.date(2017, 3, 31), 1)]


def test_unique_patients_per_drug_prefix(db):  # Q18: ILIKE prefix, escaped input
    p = db["prescriptions"].where(F.col("drug_name").ilike(ft.escape_like("furo") + "%"))
    got = rows(groups.count_by(p, "drug_name", distinct="inpatient_number"), "drug_name", "n")
    assert got == [("Furosemide injection", 2)]
    assert ft.escape_like("50%_x") == "50\\%\\_x"


def test_second_word_past_end(db):  # Q19 / D7
    w = db["prescriptions"].select(ft.word("drug_name", 2).alias("w")).distinct().where(F.col("w").isNotNull())
    assert "Aspirin" not in {r["w"] for r in w.collect()}
    assert {"injection", "tablet", "cream", "sodium"} <= {r["w"] for r in w.collect()}


def test_like_patterns(db):  # Q20, Q27, Q79
    e = db["prescriptions"].where(F.col("drug_name").like("E%x%"))
    assert [r["drug_name"] for r in e.collect()] == ["Enoxaparin sodium injection"]
    h = db["prescriptions"].where(F.col("drug_name").ilike("%hydro%")).select(F.col("drug_name").alias("H20"))
    assert len(h.collect()) == 2
    rx = db["prescriptions"].where(F.col("drug_name").rlike("(?i)(digoxin|furosemide)"))
    assert rx.count() == 3


def test_flag_counts_and_pivot(db):  # Q21, B1
    a = db["admissions"]
    long = pivots.flag_counts(a, "admission_ward", {
        "28d": F.col("re_admission_within_28_days") == 1,
        "6m": F.col("re_admission_within_6_months") == 1,
    })
    got = rows(long, "admission_ward", "flag", "n")
    assert ("ICU", "28d", 1) in got and ("Others", "6m", 1) in got
    assert not any(r[0] == "Others" and r[1] == "28d" for r in got)  # zero counts are absent (UNION semantics)
    p = pivots.pivot_counts(a.withColumn("y", F.year("admission_date")), "y", "outcome_during_hospitalization",
                            ["Alive", "Dead", "DischargeAgainstOrder", "Transferred"])
    got = {r["y"]: (r["n_Alive"], r["n_Dead"], r["n_DischargeAgainstOrder"], r["n_Transferred"]) for r in p.collect()}
    assert got == {2017: (4, 2, 1, 0), 2018: (2, 0, 0, 0)}  # missing category is a zero column, no shift


def test_delete_guard(db):  # Q22
    prev = db["demography"]
    nxt = prev.where(F.col("inpatient_number") != 103)
    assert rows(guards.delete_guard(prev, nxt, "inpatient_number"), "inpatient_number") == [(103,)]
    with pytest.raises(ValueError):
        guards.delete_guard(prev, nxt, "inpatient_number", strict=True)
    assert guards.delete_guard(prev, prev, "inpatient_number", strict=True).count() == 0


def test_date_span_floors(spark):  # Q23 / D10
    df = spark.createDataFrame([(dt.datetime(2017, 1, 1, 1, 0),), (dt.datetime(2017, 1, 5, 0, 0),)], "t timestamp_ntz")
    assert ts.date_span(df, "t").first()["span_days"] == 3


def test_quotient_and_capped(db):  # Q24 / M9
    a = db["admissions"].select(
        fm.quotient("dischargeday", "visit_times").alias("q"), fm.remainder_capped("dischargeday", "visit_times").alias("c"),
        "inpatient_number", "dischargeday", "visit_times")
    got = {(r["dischargeday"], r["visit_times"]): (r["q"], r["c"]) for r in a.collect()}
    assert got[(5, 1)] == (5, 4) and got[(3, 0)] == (None, 0) and got[(7, 2)] == (3, 5)


def test_records_and_json_per_entity(db):  # Q26, Q77: order kept, NULL fields kept
    j = db["demography"].join(db["labs"], "inpatient_number")
    r = nested.records_per_entity(j, "gender", ["inpatient_number", "bmi", "pulse"], ["inpatient_number"])
    male = [x for x in r.collect() if x["gender"] == "Male"][0]
    assert [rec["inpatient_number"] for rec in male["records"]] == [101, 105, 108]
    js = nested.json_per_entity(db["responses"], "inpatient_number", ["consciousness"])
    txt = {x["inpatient_number"]: x["rows_json"] for x in js.collect()}
    assert '"gcs":null' in txt[104]


def test_moving_average_with_spine(db):  # Q30: months without rows count as 0
    m = ts.counts_by_period(db["admissions"], "admission_date", "month", spine=True, out_period="month")
    m = ts.moving_average(m, "month", "n", 2, out="ma3")
    got = {r["month"]: (r["n"], r["ma3"]) for r in m.collect()}
    assert got[dt.date(2017, 6, 1)][0] == 0
    assert got[dt.date(2017, 4, 1)] == (1, 1.3333)


def test_sentinel_cleaning(db):  # Q31 / F11
    c = clean_sentinels(db["admissions"], ["respiratory_support"])
    assert c.where(F.col("respiratory_support").isNull()).count() == 6


def test_entity_extremes_and_guarded_ratio(db):  # Q32, Q34
    mono = db["labs"].select(fm.safe_ratio("monocyte_count", "white_blood_cell").alias("r"))
    assert mono.where(F.col("r").isNull()).count() == 1  # wbc 0 -> NULL, no error


def test_stack_child(spark):  # Q35: parent scan includes child rows
    parent = spark.createDataFrame([(1, "Male", "21-29")], "inpatient_number long, gender string, agecat string")
    child = spark.createDataFrame([(2, "Female", "29-39", 120, 80)],
                                  "inpatient_number long, gender string, agecat string, sbp long, dbp long")
    s = enrich.stack_child(parent, child)
    assert s.count() == 2 and s.where(F.col("sbp").isNull()).count() == 1


def test_parity_and_cast(db):  # Q38 / D2
    h = db["history"].select(fm.parity(F.round("cci_score").cast("int")).alias("p"), "inpatient_number")
    got = dict(rows(h, "inpatient_number", "p"))
    assert got[101] == "even" and got[105] == "odd" and got[104] is None


def test_entity_digest(db):  # Q40: all entities at once, filter afterwards
    d = nested.entity_digest([db["demography"], db["prescriptions"]], "inpatient_number",
                             ["gender", "drug_name"], ["drug_name"])
    got = {r["inpatient_number"]: r["digest"] for r in d.collect()}
    assert got[102] == "Female,Aspirin;Female,hydrocortisone cream"


def test_having_preaggregated(db):  # Q41: no fan-out from admissions
    c = groups.count_by(db["prescriptions"], "inpatient_number", having=F.col("n") > 15)
    assert rows(c, "inpatient_number", "n") == [(108, 16)]


def test_lookup_or_report(db, spark):  # Q42
    ids = spark.createDataFrame([(101,), (999,)], "inpatient_number long")
    r = guards.lookup_or_report(db["demography"], "inpatient_number", ids, ["gender"])
    assert rows(r, "inpatient_number", "status") == [(101, "found"), (999, "not found")]
    with pytest.raises(KeyError):
        guards.lookup_or_report(db["demography"], "inpatient_number", ids, ["gender"], strict=True)


def test_stable_sample_is_stable(db):  # Q43 / D20
    a = ranking.stable_sample(db["demography"], "inpatient_number", 3, seed=5).collect()
    b = ranking.stable_sample(db["demography"].repartition(4), "inpatient_number", 3, seed=5).collect()
    assert a == b and len(a) == 3


def test_rank_with_ties_and_nulls(db):  # Q45
    r = ranking.rank_rows(db["history"], [("cci_score", False)], out="rnk")
    got = dict(rows(r, "inpatient_number", "rnk"))
    assert got[105] == 1 and got[102] == 2 and got[103] == 2 and got[108] == 4 and got[104] == 8


def test_category_ratio(db):  # Q46
    assert rates.category_ratio(db["responses"], "consciousness", "ResponsiveToSound", "ResponsiveToPain").first()["ratio"] == "3:2"


def test_extreme_rows_ties(db):  # Q48, Q55
    assert rows(links.extreme_rows(db["history"], "cci_score", "max"), "inpatient_number") == [(105,)]
    top = links.extreme_rows(db["labs"], "myoglobin", "max")
    assert rows(top, "inpatient_number") == [(102,), (103,)]


def test_weekday_sunday_zero(db):  # Q50 / D8
    w = ts.weekday_counts(db["admissions"], "admission_date")
    # 2017-07-16 was a Sunday
    assert dict(rows(w, "dow", "n"))[0] >= 1


def test_spread_and_corr(db):  # Q52, Q65, Q72
    s = stats.spread(db["responses"], "gcs").first()
    vals = [15, 8, 9, 7, 12]
    mean = sum(vals) / 5
    assert s["var_pop"] == round(sum((v - mean) ** 2 for v in vals) / 5, 4)
    assert s["std_samp"] == round(math.sqrt(sum((v - mean) ** 2 for v in vals) / 4), 4)


def test_coma_diabetes_rate(db):  # Q54: round last
    j = db["responses"].join(db["history"], "inpatient_number", "left")
    r = rates.conditional_rate(j.where(F.col("gcs") <= 8), [], F.col("diabetes") == 1).first()
    assert (r["n"], r["n_flag"]) == (2, 0)


def test_constrained_ingest(db):  # Q56: NULL is rejected, accepted + rejected = input
    acc, rej = guards.constrained_ingest(db["responses"], {"gcs_above_8": F.col("gcs") > 8})
    assert acc.count() + rej.count() == db["responses"].count()
    assert rows(rej, "inpatient_number", "reason") == [(102, "gcs_above_8"), (104, "gcs_above_8"), (105, "gcs_above_8")]


def test_palindrome_and_bits(spark):  # Q57, Q69 (multibyte)
    df = spark.createDataFrame([("level",), ("abc",), ("aé",)], "w string")
    r = df.select("w", ft.is_palindrome("w").alias("p"), ft.char_count("w").alias("c"), ft.bit_count("w").alias("b"))
    got = {x["w"]: (x["p"], x["c"], x["b"]) for x in r.collect()}
    assert got == {"level": (True, 5, 40), "abc": (False, 3, 24), "aé": (False, 2, 24)}


def test_gcd_lcm(spark):  # Q60 / D14
    df = spark.createDataFrame([(12, 18), (0, 5), (0, 0), (-4, 6), (2**40, 2**20 * 3)], "a long, b long")
    g = fm.with_gcd_lcm(df, "a", "b").collect()
    assert [(r["gcd"], r["lcm"]) for r in g] == [(6, 36), (5, 0), (0, 0), (2, 12), (2**20, 2**40 * 3)]
    g2 = df.select(fm.gcd("a", "b").alias("g")).collect()
    assert [r["g"] for r in g2] == [6, 5, 0, 2, 2**20]


def test_readmission_halves(db):  # Q61: single-pass rate, ntile over the groups
    j = db["demography"].join(db["admissions"], "inpatient_number")
    r = rates.conditional_rate(j, "agecat", F.col("re_admission_within_6_months") == 1)
    h = ranking.ntile_rows(r, 2, [("rate", False), ("agecat", True)], out="half", method="window")
    assert sorted(x["half"] for x in h.collect()) == [1, 1, 1, 2, 2]


def test_join_text_null_safe(db):  # Q63, B7 / D5
    t = db["demography"].select(ft.join_text(["inpatient_number", "agecat", "gender"], ";").alias("t"))
    assert "103;79-89;" in {r["t"] for r in t.collect()}
    n = db["demography"].select(ft.join_text(["gender"], ";", null_text="n/a").alias("t"))
    assert "n/a" in {r["t"] for r in n.collect()}


def test_month_labels(db):  # Q67 / D18
    m = db["admissions"].select(F.date_format("admission_date", "MM").alias("mm"),
                                F.date_format("admission_date", "MMMM").alias("name"))
    assert ("03", "March") in {(r["mm"], r["name"]) for r in m.collect()}


def test_add_and_drop_columns(db):  # Q70, Q73
    c = enrich.add_if_missing(db["cardiac"], "todaysdate", F.lit("2020-01-01").cast("date"))
    c2 = enrich.add_if_missing(c, "todaysdate", F.lit("1999-01-01").cast("date"))
    assert c2.select("todaysdate").first()[0] == dt.date(2020, 1, 1)
    assert "lvef" not in enrich.drop_if_present(c2, "lvef").columns
    assert enrich.drop_if_present(c2, "nope").columns == c2.columns


def test_topk_then_second(db):  # Q71: rank <= 5 with ties, then OFFSET 1
    top = ranking.top_k_with_ties(db["labs"], "myoglobin", 2)
    assert rows(top, "inpatient_number") == [(102,), (103,)]
    top5 = ranking.top_k_with_ties(db["labs"], "myoglobin", 5)
    assert top5.count() == 5


def test_band_with_unknown(db):  # Q74 / 1.5: NULL BMI not in '<= 30'
    b = db["demography"].select("inpatient_number", groups.band("bmi", [30], ["<= 30", "> 30"]).alias("band"))
    got = dict(rows(b, "inpatient_number", "band"))
    assert got[106] == "unknown" and got[101] == "<= 30" and got[102] == "> 30"


def test_alerts_batch(db):  # Q75
    a = guards.alerts(db["demography"], F.col("bmi") > 40,
                      F.concat(F.lit("BMI high for "), F.col("inpatient_number").cast("string")), keep=["inpatient_number"])
    assert rows(a, "inpatient_number") == [(104,), (105,)]


def test_update_returning(db):  # Q78
    u = enrich.apply_update(db["history"], {"type_ii_respiratory_failure": F.upper("type_ii_respiratory_failure")})
    assert u.count() == db["history"].count() and {r[0] for r in u.select("type_ii_respiratory_failure").collect()} == {"NO", "YES"}


def test_linked_rows(db):  # Q80: all drugs of patients on Furosemide
    l = links.linked_rows(db["prescriptions"], "inpatient_number", "drug_name",
                          F.col("drug_name").ilike("furosemide%"))
    assert {r["inpatient_number"] for r in l.collect()} == {101, 105}
    assert l.count() == 4
    l2 = links.linked_rows(db["prescriptions"], "inpatient_number", "drug_name",
                           F.col("drug_name") == "Drug3 tablet", hops=3)
    assert {r["inpatient_number"] for r in l2.collect()} == {107, 108}


def test_first_value_and_nth(db):  # B2, B3, B4, B5
    j = db["demography"].join(db["history"], "inpatient_number")
    f = ranking.first_value_by(j, ["agecat"], "gender", [("cci_score", False), ("inpatient_number", True)], out="g")
    got = dict(rows(f, "agecat", "g"))
    assert got["69-79"] == "Female"
    assert ranking.nth_highest(db["demography"], "bmi", 5, out="x").first()["x"] == 25.0
    assert ranking.nth_highest(db["demography"], "bmi", 20, out="x").first()["x"] is None
    q = ranking.ntile_rows(db["demography"], 4, [("bmi", True), ("inpatient_number", True)], out="q")
    assert sorted(r["q"] for r in q.collect()) == [1, 1, 1, 2, 2, 3, 3, 4, 4]
    cd = ranking.cume_dist_rows(db["labs"].where(F.col("glucose_blood_gas").isNotNull()), [("glucose_blood_gas", True)])
    assert max(r["cume_dist"] for r in cd.collect()) == 1.0


def test_profile_exact_matches_builtin(db):  # B6
    j = db["demography"].join(db["labs"], "inpatient_number")
    a = groups.profile(j, "gender", "systolic_blood_pressure", method="exact").collect()
    b = groups.profile(j, "gender", "systolic_blood_pressure", method="builtin").collect()
    key = lambda r: str(r["gender"])
    assert sorted(a, key=key) == sorted(b, key=key)


def test_cumulative_and_multi_rate(db):  # B20, B24
    d = ts.counts_by_period(db["admissions"], "admission_date", "day", out_period="day")
    c = ts.cumulative(d, "day", "n", out="running")
    assert max(r["running"] for r in c.collect()) == db["admissions"].count()
    m = rates.multi_rate(db["admissions"], {"readm": F.col("re_admission_within_28_days") == 1,
                                             "death": F.col("death_within_6_months") == 1}).first()
    assert (m["n_readm"], m["n_death"]) == (3, 3)


def test_band_value_within_band(db):  # Q1: value inside the band, stable
    d = db["demography"].where(F.col("agecat").isNotNull())
    v = enrich.band_value(d, "agecat", "inpatient_number", seed=1)
    for r in v.collect():
        lo, hi = enrich.parse_band(r["agecat"])
        assert lo <= r["value"] <= hi
    again = enrich.band_value(d.repartition(3), "agecat", "inpatient_number", seed=1)
    assert rows(v, "inpatient_number", "value") == rows(again, "inpatient_number", "value")


def test_first_event_year_and_update(db):  # Q2, Q13
    f = enrich.first_event_year(db["demography"], db["admissions"], "inpatient_number", "inpatient_number",
                                "admission_date", out="birth_ref")
    got = dict(rows(f, "inpatient_number", "birth_ref"))
    assert got[101] == 2017 and got[106] is None


def test_snapshot_roundtrip_prunes_partitions(db, scratch):  # S8 + F7 partition pruning
    import os

    from cohortlens.plans.inspect import plan_text
    from cohortlens.sources import write_snapshot

    snap = db["admissions"].withColumn("adm_year", F.year("admission_date"))
    back = write_snapshot(snap, os.path.join(scratch, "admissions"), partition_by=["adm_year"])
    assert back.count() == snap.count()
    q = back.where(F.col("adm_year") == 2018)
    assert "PartitionFilters: [isnotnull(adm_year" in plan_text(q)
    assert q.count() == 2


def test_flag_coercion_in_schema(db):  # '1' and 1 compare the same on an int column
    h = db["history"]
    assert h.where(F.col("diabetes") == "1").count() == h.where(F.col("diabetes") == 1).count() == 4


def test_clustered_snapshot_ranges_do_not_overlap(spark, scratch):
    import os

    from cohortlens.sources import tables, write_clustered_snapshot

    o = tables(spark, "/root/testdata/sf0.01").orders
    back = write_clustered_snapshot(o, os.path.join(scratch, "orders_by_date"), ["o_orderdate"], files=4)
    spans = sorted(tuple(r[1:]) for r in back.groupBy(F.input_file_name()).agg(
        F.min("o_orderdate"), F.max("o_orderdate")).collect())
    assert len(spans) == 4 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert back.count() == o.count()


def test_text_operators_and_band_by(db):
    from cohortlens.operators import textops

    p = db["prescriptions"]
    assert textops.matching(p, "drug_name", prefix="FURO").count() == 2
    assert textops.matching(p, "drug_name", like="E%x%").count() == 1
    assert textops.matching(p, "drug_name", regex="(?i)digoxin|furosemide").count() == 3
    assert textops.matching(p, "drug_name", ilike="%tablet", longer_than=20).count() == 1
    f = textops.text_features(db["demography"], "occupation", prefix="o_")
    r = {x["occupation"]: (x["o_chars"], x["o_bits"]) for x in f.collect()}
    assert r["Ärztin"] == (6, 56)
    b = groups.band_by(db["demography"], "bmi", [30], ["low", "high"], out="b")
    assert dict(rows(b, "inpatient_number", "b"))[106] == "unknown"
    r2 = rates.conditional_rate(db["responses"].join(db["history"], "inpatient_number", "left"), [],
                                F.col("diabetes") == 1, within=F.col("gcs") <= 8).first()
    assert r2["n"] == 2


def test_delete_guard_null_keys(spark):
    prev = spark.createDataFrame([(1,), (None,), (3,)], "k long")
    nxt = spark.createDataFrame([(None,), (3,)], "k long")
    assert [r["k"] for r in guards.delete_guard(prev, nxt, "k").collect()] == [1]


def test_review_fixes(spark):
    from cohortlens.operators import nested, pivots
    from cohortlens.operators import timeseries as ts2

    # update_from: a matched NULL overwrites
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    src = spark.createDataFrame([(1, None), (2, "B")], "k long, v string")
    got = dict((r["k"], r["v"]) for r in enrich.update_from(base, src, "k", ["v"]).collect())
    assert got == {1: None, 2: "B", 3: "c"}
    # band with no cuts
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert sorted(str(r[0]) for r in df.select(groups.band("x", [], ["all"])).collect()) == ["all", "unknown"]
    # band labels with negative bounds
    neg = spark.createDataFrame([(i, "-5-5") for i in range(200)], "k long, b string")
    vals = [r["value"] for r in enrich.band_value(neg, "b", "k").collect()]
    assert min(vals) >= -5 and max(vals) <= 5 and None not in vals
    # spine keeps the NULL-period row
    ev = spark.createDataFrame([(dt.datetime(2020, 1, 5),), (dt.datetime(2020, 3, 1),), (None,)], "t timestamp_ntz")
    sp = {r["period"]: r["n"] for r in ts2.counts_by_period(ev, "t", "month", spine=True).collect()}
    assert sp[None] == 1 and sp[dt.date(2020, 2, 1)] == 0 and sum(sp.values()) == 3
    # nested: NULL sort keys last
    rec = spark.createDataFrame([(1, None, "x"), (1, 2, "y"), (1, 1, "z")], "e long, o long, v string")
    arr = nested.collect_sorted(rec, "e", ["v"], ["o"]).first()["records"]
    assert [r["v"] for r in arr] == ["z", "y", "x"]
    # flag names are not SQL text
    fl = pivots.flag_counts(rec, "e", {"o'neil": F.col("o") > 0, "a.b`c": F.col("o").isNull()})
    assert sorted((r["flag"], r["n"]) for r in fl.collect()) == [("a.b`c", 1), ("o'neil", 2)]
    # empty rule sets
    acc, rej = guards.constrained_ingest(rec, {})
    assert acc.count() == 3 and rej.count() == 0
    assert [r["outcome"] for r in guards.ingest_summary(rec, {}).collect()] == ["accepted"]


@pytest.mark.parametrize("period,expected", [
    ("week", [(dt.date(2020, 1, 6), 1), (dt.date(2020, 1, 13), 0), (dt.date(2020, 1, 20), 2)]),
    ("quarter", [(dt.date(2020, 1, 1), 3), (dt.date(2020, 4, 1), 0), (dt.date(2020, 7, 1), 1)]),
    ("year", [(dt.date(2020, 1, 1), 4)]),
])
def test_period_spines(spark, period, expected):
    rows = [(dt.datetime(2020, 1, 8, 10),), (dt.datetime(2020, 1, 20),), (dt.datetime(2020, 1, 26, 23, 59),),
            (dt.datetime(2020, 7, 1),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = sorted((r["period"], r["n"]) for r in ts.counts_by_period(df, "t", period, spine=True).collect())
    assert got[:len(expected)] == expected and sum(n for _, n in got) == 4
    if period == "week":  # every Monday from 2020-01-06 to 2020-06-29
        assert len(got) == 26 and got[-1] == (dt.date(2020, 6, 29), 1)


def test_snapshot_read_back_keeps_schema(spark, scratch):
    import os

    from cohortlens.sources import write_clustered_snapshot, write_snapshot

    df = spark.createDataFrame([("01", 1, dt.date(2020, 1, 1)), ("02", 2, dt.date(2020, 2, 1))],
                               "code string, n int, d date")
    a = write_snapshot(df, os.path.join(scratch, "snap"), partition_by=["code"])
    b = write_clustered_snapshot(df, os.path.join(scratch, "clus"), ["n"], partition_by=["code"], files=2)
    for back in (a, b):
        assert back.schema == df.schema  # '01' stays a string, columns keep their order
        assert sorted(back.collect()) == sorted(df.collect())


def test_lcm_beyond_64_bits_raises(spark):
    df = spark.createDataFrame([(2**62 - 1, 2**61 - 1)], "a long, b long")
    for out in (lambda: df.select(fm.lcm("a", "b")).collect(), lambda: fm.with_gcd_lcm(df, "a", "b").collect()):
        with pytest.raises(Exception, match="64-bit"):
            out()


def test_text_bar_does_not_grow_with_the_data(spark):
    df = spark.createDataFrame([(10**11,), (5 * 10**10,), (0,)], "n long")
    got = [r["b"] for r in df.select(ft.text_bar("n", F.lit(10**11), 40).alias("b")).collect()]
    assert [len(b) for b in got] == [40, 20, 0]


class _Tables:
    """Just the tables that a question reads."""

    def __init__(self, **frames):
        self.__dict__.update(frames)


def test_patients_with_two_complication_rows_count_once(spark):
    from cohortlens.plans import clinical as questions

    c = _Tables(
        demography=spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "inpatient_number long, agecat string"),
        cardiaccomplications=spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "inpatient_number long, congestive_heart_failure int"))
    got = {r["agecat"]: (r["total"], r["heart_failure_count"], r["percentage"]) for r in questions.heart_failure_pct_by_band(c).collect()}
    assert got == {"a": (2, 1, 50.0), "b": (1, 0, 0.0)}


def test_records_without_a_band_get_their_own_groups_value(spark):
    from cohortlens.plans import clinical as questions

    c = _Tables(
        demography=spark.createDataFrame([(1, None, "m"), (2, None, "f"), (3, "b", "m")], "inpatient_number long, agecat string, gender string"),
        patienthistory=spark.createDataFrame([(1, 1.0), (2, 5.0), (3, None)], "inpatient_number long, cci_score double"))
    got = {r["inpatient_number"]: r["gender_with_max_cci_score"] for r in questions.gender_with_max_cci_per_band(c).collect()}
    assert got == {1: "f", 2: "f", 3: None}
