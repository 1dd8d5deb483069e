"""Explicit schemas.  Reading with a declared schema avoids a footer-inference
pass over every file and fixes the types the operators rely on (F21: a flag
compared with both '1' and 1 is cast once here, not per query)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, D, S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DRIVER_SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", I), ("r_name", S)),
    "nation": _schema(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _schema(
        ("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D), ("c_mktsegment", S)
    ),
    "supplier": _schema(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _schema(
        ("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
        ("p_retailprice", D),
    ),
    "orders": _schema(
        ("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
        ("o_orderdate", TS), ("o_orderpriority", S),
    ),
    "lineitem": _schema(
        ("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
        ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
        ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", TS),
    ),
    "events": _schema(
        ("event_id", L), ("ts", TS), ("user_id", L), ("event_type", S), ("value", D), ("props", S)
    ),
    "documents": _schema(("doc_id", L), ("text", S), ("lang", S), ("source", S), ("n_chars", L)),
    "embeddings": _schema(("vec_id", L), ("embedding", T.ArrayType(T.FloatType())), ("label", I)),
    "pages": _schema(("page_id", L), ("url", S), ("html", S)),
    "benchmark": _schema(("item_id", L), ("text", S)),
    "labels": _schema(("doc_id", L), ("quality", I), ("toxic", I)),
    "conversations": _schema(("conv_id", L), ("turn", L), ("role", S), ("text", S)),
}

# Clinical tables (inferred from use; see FIXTURES.md).  Flags are integers.
CLINICAL_SCHEMAS: dict[str, T.StructType] = {
    "demography": _schema(
        ("inpatient_number", L), ("gender", S), ("agecat", S), ("occupation", S),
        ("height", D), ("weight", D), ("bmi", D),
    ),
    "hospitalization_discharge": _schema(
        ("inpatient_number", L), ("admission_date", TS), ("admission_ward", S),
        ("admission_way", S), ("destinationdischarge", S), ("outcome_during_hospitalization", S),
        ("dischargeday", I), ("visit_times", I), ("re_admission_within_28_days", I),
        ("re_admission_within_3_months", I), ("re_admission_within_6_months", I),
        ("readmission_time_days_from_admission", D), ("death_within_28_days", I),
        ("death_within_6_months", I), ("time_of_death__days_from_admission", D),
        ("oxygen_inhalation", S), ("respiratory_support", S),
    ),
    "cardiaccomplications": _schema(
        ("inpatient_number", L), ("nyha_cardiac_function_classification", I), ("killip_grade", I),
        ("type_of_heart_failure", S), ("myocardial_infarction", I),
        ("congestive_heart_failure", I), ("peripheral_vascular_disease", I), ("lvef", D),
    ),
    "patient_precriptions": _schema(("inpatient_number", L), ("drug_name", S)),
    "labs": _schema(
        ("inpatient_number", L), ("map_value", D), ("pulse", D), ("systolic_blood_pressure", L),
        ("diastolic_blood_pressure", L), ("white_blood_cell", D), ("monocyte_count", D),
        ("d_dimer", D), ("myoglobin", D), ("glucose_blood_gas", D), ("uric_acid", D),
    ),
    "patienthistory": _schema(
        ("inpatient_number", L), ("cci_score", D), ("diabetes", I), ("solid_tumor", I),
        ("malignant_lymphoma", I), ("leukemia", I),
        ("moderate_to_severe_chronic_kidney_disease", I), ("acute_renal_failure", I),
        ("type_ii_respiratory_failure", S),
    ),
    "responsivenes": _schema(("inpatient_number", L), ("consciousness", S), ("gcs", I)),
}


def clean_sentinels(df: DataFrame, columns: list[str] | None = None, sentinel: str = "null") -> DataFrame:
    """turn the text sentinel ``'null'`` into a real NULL once, at load.

    Applies to every string column unless ``columns`` names a subset.
    """
    targets = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cleaned: dict[str, Column] = {c: F.nullif(F.col(c), F.lit(sentinel)) for c in targets}
    return df.withColumns(cleaned)
