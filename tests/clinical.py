"""Small clinical fixtures in the FIXTURES.md schemas, invented ids.

Covers the edge rows of FIXTURES.md section 2: NULL gender/agecat/bmi,
bmi 0/10/40/49.9/50, a patient with two admissions and one with none, ties,
an admission at 23:59 on a month's last day, a month without admissions,
visit_times 0 and NULL, the 'null' text sentinel, one-word and mixed-case
drug names, 15 and 16 drugs, multibyte occupation, gcs 8/9/NULL, NYHA 1.
"""

import datetime as dt

from cohortlens.sources.schemas import CLINICAL_SCHEMAS


def ts(s):
    return dt.datetime.fromisoformat(s)


DEMOGRAPHY = [
    # id, gender, agecat, occupation, height, weight, bmi
    (101, "Male", "21-29", "farmer", 1.70, 70.0, 24.2),
    (102, "Female", "69-79", "UrbanResident", 1.60, 102.4, 40.0),
    (103, None, "79-89", "Ärztin", 1.55, 60.0, 25.0),
    (104, "Female", None, "farmer", 1.65, 136.0, 50.0),
    (105, "Male", "89-110", "UrbanResident", 1.80, 160.0, 49.9),
    (106, "Male", "69-79", "other", 1.75, None, None),
    (107, "Female", "21-29", "farmer", 1.62, 26.0, 10.0),
    (108, "Male", "79-89", "UrbanResident", 1.72, 0.0, 0.0),
    (109, "Female", "69-79", "farmer", 1.58, 100.0, 40.0),
]

ADMISSIONS = [
    # id, admission_date, ward, way, dest, outcome, dischargeday, visit_times,
    # re28, re3m, re6m, readm_days, death28, death6m, death_days, oxygen, resp
    (101, ts("2017-03-31 23:59:00"), "Cardiology", "Emergency", "Home", "Alive", 5, 1, 1, 1, 1, 20.0, 0, 0, None, "OxygenTherapy", "null"),
    (101, ts("2017-05-02 08:00:00"), "ICU", "NonEmergency", "Home", "Alive", 7, 2, 0, 0, 1, None, 0, 0, None, "OxygenTherapy", None),
    (102, ts("2017-02-10 10:00:00"), "GeneralWard", "Emergency", "Home", "Dead", 3, 0, 0, 0, 0, None, 1, 1, 3.0, "OxygenTherapy", "NIV"),
    (103, ts("2017-02-20 09:00:00"), "Cardiology", "Emergency", "Home", "Alive", 10, None, 1, 1, 1, 12.0, 0, 0, None, "None", "NIV"),
    (104, ts("2017-04-01 00:00:00"), "Others", "Emergency", "Home", "DischargeAgainstOrder", None, 3, 0, 1, 1, 60.0, 0, 1, 100.0, "OxygenTherapy", None),
    (105, ts("2018-10-05 12:00:00"), "Cardiology", "NonEmergency", "Home", "Alive", 4, 1, 0, 0, 0, None, 0, 0, None, "OxygenTherapy", "null"),
    (107, ts("2018-10-06 12:00:00"), "ICU", "Emergency", "Home", "Alive", 6, 2, 1, 1, 1, 9.0, 0, 0, None, "None", None),
    (108, ts("2017-07-15 12:00:00"), "Cardiology", "Emergency", "Home", "Dead", 2, 1, 0, 0, 0, None, 1, 1, 1.0, "OxygenTherapy", "NIV"),
    (109, ts("2017-07-16 12:00:00"), "GeneralWard", "Emergency", "Home", "Alive", 8, 1, 0, 0, 1, 100.0, 0, 0, None, "None", None),
]  # 106 has no admission; June 2017 has none

PRESCRIPTIONS = (
    [(101, "Furosemide injection"), (101, "Digoxin tablet"), (101, "HYDROchlorothiazide tablet"),
     (102, "hydrocortisone cream"), (102, "Aspirin"), (103, "Enoxaparin sodium injection"),
     (105, "Furosemide injection")]
    + [(107, f"Drug{i} tablet") for i in range(15)]
    + [(108, f"Drug{i} tablet") for i in range(16)]
)

CARDIAC = [
    # id, nyha, killip, type, mi, chf, pvd, lvef
    (101, 2, 1, "Both", 1, 1, 0, 55.0),
    (102, 3, 2, "Left", 0, 1, 0, 35.0),
    (103, 4, 3, "Both", 1, 0, 1, None),
    (104, 1, 4, "Right", 0, 1, 0, 30.0),
    (105, 4, 2, "Both", 0, 1, 0, 45.0),
    (107, 3, 1, "Left", 1, 0, 0, 60.0),
    (108, 4, 4, "Both", 1, 1, 1, 25.0),
    (109, 2, 1, "Left", 0, 0, 0, 50.0),
]

HISTORY = [
    # id, cci, diabetes, solid_tumor, lymphoma, leukemia, ckd, arf, t2rf
    (101, 2.0, 1, 0, 0, 0, 1, 0, "no"),
    (102, 4.0, 0, 1, 0, 0, 0, 0, "yes"),
    (103, 4.0, None, 0, 1, 0, 0, 1, "no"),
    (104, None, 1, 0, 0, 0, 0, 0, "no"),
    (105, 7.0, 0, 0, 0, 1, 1, 0, "yes"),
    (107, 1.0, 1, 0, 0, 0, 0, 0, "no"),
    (108, 3.0, 0, 0, 0, 0, 0, 0, "no"),
    (109, 2.0, 1, 0, 0, 0, 0, 0, "no"),
]

RESPONSES = [(101, "ResponsiveToSound", 15), (102, "ResponsiveToPain", 8), (103, "ResponsiveToSound", 9),
             (104, "Clear", None), (105, "ResponsiveToSound", 7), (108, "ResponsiveToPain", 12)]

LABS = [
    # id, map, pulse, sbp, dbp, wbc, mono, ddimer, myoglobin, glucose, uric
    (101, 90.0, 80.0, 130, 80, 6.0, 0.5, 1.2, 100.0, 5.5, 400.0),
    (102, 85.0, 95.0, 120, 70, 3.5, 0.3, 2.0, 300.0, None, 350.0),
    (103, 100.0, 70.0, 150, 90, 8.0, 0.0, 0.8, 300.0, 7.0, 500.0),
    (105, 95.0, 88.0, 140, 85, 0.0, 0.2, 3.1, 250.0, 9.1, 420.0),
    (108, 70.0, 110.0, 100, 60, 12.0, 1.1, 5.0, None, 6.0, 600.0),
    (109, 88.0, 76.0, 125, 75, 5.0, 0.4, 1.0, 200.0, 5.0, 380.0),
]


def load(spark):
    s = CLINICAL_SCHEMAS
    return {
        "demography": spark.createDataFrame(DEMOGRAPHY, s["demography"]),
        "admissions": spark.createDataFrame(ADMISSIONS, s["hospitalization_discharge"]),
        "prescriptions": spark.createDataFrame(PRESCRIPTIONS, s["patient_precriptions"]),
        "cardiac": spark.createDataFrame(CARDIAC, s["cardiaccomplications"]),
        "history": spark.createDataFrame(HISTORY, s["patienthistory"]),
        "responses": spark.createDataFrame(RESPONSES, s["responsivenes"]),
        "labs": spark.createDataFrame(LABS, s["labs"]),
    }
