"""ICD-9 → ICD-10 mapping edge cases (hand-made frames)."""

from pyspark.sql import functions as F

from ehrspark.functions.codes import like_family, strip_last_digit
from ehrspark.operators import codes

CONV = "conversion_id int, icd10 string, convertion_type int, icd9 string"


def _codes(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "condition_source_value string")


def _map(spark, conv_rows, *values):
    conv = spark.createDataFrame(conv_rows, CONV)
    rows = codes.map_codes(_codes(spark, *values), conv).collect()
    return {r["condition_source_value"]: r for r in rows}


def test_tier_beats_candidate(spark):
    m = _map(spark, [(1, "A", 1, "25009"), (2, "B", 9, "2500")], "2500")
    assert m["2500"]["icd10"] == "A"
    assert (m["2500"]["tier"], m["2500"]["candidate"]) == (1, 4)


def test_candidate_order(spark):
    rows = [(1, "S", 1, "25"), (2, "Z", 1, "2500"), (3, "N", 1, "2509"), (4, "O", 1, "2501")]
    assert _map(spark, rows, "250")["250"]["icd10"] == "S"
    assert _map(spark, rows[1:], "250")["250"]["icd10"] == "Z"


def test_first_row_with_null_target_is_a_miss(spark):
    rows = [(1, None, 1, "250"), (2, "X", 1, "250"), (3, "Y", 9, "250")]
    assert _map(spark, rows, "250")["250"]["icd10"] == "Y"


def test_no_relationship_type_stays_unmapped(spark):
    m = _map(spark, [(1, "Q", 4, "777")], "777")
    assert m["777"]["icd10"] is None and m["777"]["tier"] is None


def test_null_code_not_mapped_but_counted(spark):
    cond = spark.createDataFrame([(1, None), (2, "250")], "condition_source_concept_id long, condition_source_value string")
    conv = spark.createDataFrame([(1, "E11.9", 1, "250")], CONV)
    mapper = codes.build_mapper(cond, conv).collect()
    assert [r["condition_source_value"] for r in mapper] == ["250"]
    counts = {r[0]: r[1] for r in codes.condition_counts(cond).collect()}
    assert counts[None] == 0 and counts["250"] == 1


def test_strip_last_digit(spark):
    df = spark.createDataFrame([("2501",), ("250",), ("V12",), ("E11.",)], "v string")
    got = [r[0] for r in df.select(strip_last_digit(F.col("v"))).collect()]
    assert got == ["250", "25", "V1", "E11."]


def test_code_pattern(spark):
    df = spark.createDataFrame([("E11",), ("E11.",), ("E11.9",), ("E110",), ("e11.9",)], "v string")
    got = [r[0] for r in df.where(like_family(F.col("v"), "E11")).collect()]
    assert got == ["E11.9"]
    got_ci = [r[0] for r in df.where(like_family(F.col("v"), "E11", ignore_case=True)).collect()]
    assert got_ci == ["E11.9", "e11.9"]


def test_mapper_one_icd10_per_code_and_stable_under_repartition(spark):
    from ehrspark.sources.fixtures import OmopData
    d = OmopData(spark, "/root/testdata/sf0.001")
    m = codes.map_codes(d.condition_occurrence, d.icdcode_converter)
    assert m.groupBy("condition_source_value").count().where("count > 1").count() == 0
    shuffled = codes.map_codes(d.condition_occurrence.repartition(5), d.icdcode_converter.repartition(3))
    assert sorted(map(tuple, m.collect()), key=str) == sorted(map(tuple, shuffled.collect()), key=str)


def test_conversion_fallback_without_broadcast_matches(spark, monkeypatch):
    from ehrspark.sources.fixtures import OmopData
    d = OmopData(spark, "/root/testdata/sf0.001")
    fast = codes.convert_conditions(d.condition_occurrence, d.icdcode_converter)
    monkeypatch.setattr(codes, "MAX_BROADCAST_CODES", 1)
    slow = codes.convert_conditions(d.condition_occurrence, d.icdcode_converter)
    assert fast.count() == slow.count() and fast.exceptAll(slow).count() == 0


def test_strip_dot_option_matches_dotless_dictionary(spark):
    rows = [(1, "E11.42", 1, "25042")]
    assert _map(spark, rows, "250.42")["250.42"]["icd10"] is None
    conv = spark.createDataFrame(rows, CONV)
    m = codes.map_codes(_codes(spark, "250.42"), conv, strip_dot=True).first()
    assert (m["icd10"], m["tier"], m["candidate"]) == ("E11.42", 1, 1)


def test_strip_dot_reaches_every_operator(spark):
    conv = spark.createDataFrame([(1, "E11.42", 1, "25042")], "conversion_id int, icd10 string, convertion_type int, icd9 string")
    rows = spark.createDataFrame([(1, "250.42"), (2, "J10")], "person_id long, condition_source_value string")
    desc = spark.createDataFrame([("E11.42", "nerve damage")], "code string, description string")
    got = {r.condition_source_value: (r.is_icd9, r.converted) for r in codes.code_labels(rows, conv, strip_dot=True).collect()}
    assert got == {"250.42": (True, "E11.42"), "J10": (False, "J10")}
    assert sorted(r.condition_source_value for r in codes.convert_conditions(rows, conv, strip_dot=True).collect()) == ["E11.42", "J10"]
    assert codes.count_icd9_codes(rows, conv, strip_dot=True).first()[0] == 1
    assert {r[0] for r in codes.mapped_condition_counts(rows, conv, desc, strip_dot=True).collect()} == {"nerve damage", "J10"}
