"""End to end: the command line over an OMOP CSV folder."""

import os

import pytest
from pyspark.sql import functions as F

from fixture_paths import SF_SMALL
from ehrspark import cli
from ehrspark.operators import codes
from ehrspark.sources.fixtures import OmopData
from ehrspark.sources.files import read_code_converter

TABLES = ("person", "visit_occurrence", "death", "condition_occurrence", "drug_exposure", "procedure_occurrence",
          "measurement", "observation", "observation_period")


def _export(spark, root):
    d = OmopData(spark, SF_SMALL)
    omop = os.path.join(root, "omop")
    for t in TABLES:
        d.table(t).write.option("header", True).csv(os.path.join(omop, f"{t}.csv"))
    d.concept.write.option("header", True).csv(os.path.join(root, "concept.csv"))
    d.code_description.write.option("header", True).csv(os.path.join(root, "descriptions.csv"))
    d.icdcode_converter.write.option("header", False).csv(os.path.join(root, "icdconverter.csv"))
    sets = os.path.join(root, "sets")
    for name in ("cancer", "HD", "COPD", "T2DM", "stroke"):
        (d.concept_set.where(F.col("set_name") == name).select("concept_id")
         .write.option("header", True).csv(os.path.join(sets, f"{name}_condition_id.csv")))
    return d, omop, sets


def test_command_line_jobs(spark, tmp_path):
    root = str(tmp_path)
    d, omop, sets = _export(spark, root)
    out = os.path.join(root, "out")
    conv = os.path.join(root, "icdconverter.csv")
    run = lambda *args: cli.main(list(args), spark=spark)

    run("mapper", "--omop", omop, "--converter", conv, "--out", out)
    mapper = spark.read.parquet(os.path.join(out, "icd9_icd10_mapper"))
    want = codes.build_mapper(d.condition_occurrence, read_code_converter(spark, conv))
    assert mapper.count() == want.count() and mapper.exceptAll(want).count() == 0

    run("conditions", "--omop", omop, "--converter", conv, "--descriptions", os.path.join(root, "descriptions.csv"),
        "--out", out)
    assert spark.read.option("header", True).csv(os.path.join(out, "mapped_condition_count")).count() > 0

    run("convert", "--omop", omop, "--converter", conv, "--out", out)
    converted = spark.read.option("header", True).csv(os.path.join(out, "condition_occurrence_icd10"))
    assert converted.count() == d.condition_occurrence.count()

    run("cohort", "--omop", omop, "--out", os.path.join(root, "cohort"), "--months", "24")
    assert spark.read.option("header", True).csv(os.path.join(root, "cohort", "condition_occurrence")).count() > 0

    run("drugs", "--omop", omop, "--concept", os.path.join(root, "concept.csv"), "--out", out)
    t1 = os.path.join(out, "t1_drug")
    assert spark.read.option("header", True).csv(t1).columns == ["drug", "count"]

    run("compare", "--real", omop, "--synthetic", omop, "--out", out, "--real-drugs", t1,
        "--synthetic-drugs", t1)
    table = spark.read.option("header", True).csv(os.path.join(out, "integrate_table"))
    assert table.where(F.col("p_value").isNotNull()).count() == 10

    models_dir = os.path.join(root, "models")
    for model in ("five", "concepts"):
        run("train", "--model", model, "--omop", omop, "--model-dir", models_dir, "--concept-sets", sets, "--k", "50")
        pred_dir = os.path.join(root, f"pred_{model}")
        run("infer", "--model", model, "--omop", omop, "--model-dir", models_dir, "--concept-sets", sets,
            "--out", pred_dir)
        pred = spark.read.option("header", True).csv(os.path.join(pred_dir, "predictions"))
        assert pred.columns == ["person_id", "score"] and pred.count() > 0

    with pytest.raises(SystemExit):
        run("train", "--model", "five", "--omop", omop, "--model-dir", models_dir)


def test_demographic_model_with_its_own_scaler(spark, tmp_path):
    """A person scores the same alone and in a crowd if the ages are scaled by the training rows."""
    root = str(tmp_path)
    d, omop, _ = _export(spark, root)
    models_dir, few = os.path.join(root, "models"), os.path.join(root, "few")
    run = lambda *args: cli.main(list(args), spark=spark)
    run("train", "--model", "demographic", "--omop", omop, "--model-dir", models_dir, "--fit-on", "train")
    grid = spark.read.option("header", True).csv(os.path.join(models_dir, "grid"))
    assert grid.count() == 8 and grid.columns == ["max_iter", "penalty", "accuracy"]
    for t in TABLES:
        some = d.table(t).where("person_id % 17 = 3") if "person_id" in d.table(t).columns else d.table(t)
        some.write.option("header", True).csv(os.path.join(few, f"{t}.csv"))

    def scores(folder):
        run("infer", "--model", "demographic", "--omop", folder, "--model-dir", models_dir, "--out", folder)
        return {r.person_id: float(r.score) for r in spark.read.option("header", True).csv(os.path.join(folder, "predictions")).collect()}

    all_, alone = scores(omop), scores(few)
    assert alone and alone == {p: all_[p] for p in alone}
