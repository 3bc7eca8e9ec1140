"""An own 4-row raw table (exact duplicate, new case, mostly-NULL case) for the whole load."""

from pyspark.sql import types as T

RAW_COLUMNS = [
    ("case_id", "string"), ("et_date", "string"), ("female_age", "int"), ("female_bmi", "double"),
    ("amh_level", "double"), ("fsh_level", "double"), ("afc", "int"), ("male_age", "int"),
    ("male_factor", "string"), ("semen_count_mill_per_ml", "double"), ("motility_percent", "double"),
    ("morphology_percent", "double"), ("retrieved_oocytes", "int"), ("mii_count", "int"),
    ("num_embryos_generated", "int"), ("fertilization_rate", "double"), ("good_embryos", "int"),
    ("class_a_rate", "double"), ("fresh_et_stage", "string"), ("embryos_transferred", "int"),
    ("grading", "string"), ("pregnancy_test_result", "string"), ("clinical_pregnancy", "int"),
    ("live_birth", "int"), ("success_probability_score", "double"), ("response_type", "string"),
    ("risk_level", "string"), ("recommended_protocol", "string"),
    ("suggested_waiting_period_days", "int"), ("failure_reason", "string"),
    ("doctor_recommendation", "string"),
]


def raw_schema() -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in RAW_COLUMNS])


_ROW1 = ("CASE_TEST_001", "2023-03-07", 32, 22.5, 2.1, 6.5, 12, 35, "Normal", 40.0, 55.0, 4.0, 8, 4, 4,
         0.75, 1, 0.5, "Blastocyst", 2, "AA", "Negative", 0, 0, 0.76, "Poor", "High", "Antagonist", 90,
         "Implantation failure", "Good response")
_ROW3 = ("CASE_TEST_002", "2022-11-15", 30, 24.0, 3.0, 7.0, 15, 33, "OAT", 20.0, 40.0, 3.0, 10, 5, 5,
         0.8, 2, 0.6, "Cleavage", 1, "AB", "Positive", 1, 0, 0.88, "Normal", "Medium", "Long", 45,
         None, "Monitor closely")
_ROW4 = ("CASE_TEST_003", None, 29) + (None,) * 21 + (0.00,) + (None,) * 6


def raw_rows():
    return [_ROW1, _ROW1, _ROW3, _ROW4]
