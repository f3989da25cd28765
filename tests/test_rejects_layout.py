"""The reject channel and the layout by person bucket and year."""

import datetime
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from fixture_paths import SF_SMALL
from ehrspark import cli, schemas
from ehrspark.operators import cohort, labels
from ehrspark.sources import rejects, store
from ehrspark.sources.fixtures import OmopData

LINES = ("Extra,person_id,visit_start_date,visit_occurrence_id",
         "a,1,2020-01-02,10", "b,x,2020-01-02,11", "c,2.5,02/01/2020,12", "d,3.0,,13",
         "e,4,2020-02-30,14", "f,5,2020", "g,6,2020-01-02,15,more", ",,,", "h,99999999999999999999,2020-01-02,16")


def _checked(spark, folder, lines, name="visit_occurrence", **kw):
    path = folder / "t.csv"
    path.write_text("".join(line + "\n" for line in lines))
    return rejects.read_checked(spark, str(path), name, **kw)


def test_good_and_rejected_rows_add_up(spark, tmp_path):
    got = _checked(spark, tmp_path, LINES)
    assert (got.n_good, got.n_rejected) == (3, 6) and got.n_good + got.n_rejected == len(LINES) - 1
    assert got.good.columns == [*schemas.VISIT_OCCURRENCE.fieldNames(), "Extra"]
    assert sorted(map(tuple, got.good.collect()), key=str) == sorted([(10, 1, datetime.date(2020, 1, 2), "a"), (13, 3, None, "d"), (None, None, None, None)], key=str)
    faults = {(r["column"], r["value"], r["reason"]) for r in got.rejected.collect()}
    assert faults == {("person_id", "x", "no number"), ("person_id", "2.5", "no whole number"), ("visit_start_date", "02/01/2020", "no date"),
                      ("visit_start_date", "2020-02-30", "no date"), (None, None, "malformed line"), ("person_id", "9" * 20, "out of range")}
    lines = {r["line"] for r in got.rejected.collect()}
    assert lines == {LINES[i] for i in (2, 3, 5, 6, 7, 9)} and all(r["file"].endswith("/t.csv") for r in got.rejected.collect())
    with pytest.raises(ValueError, match="6 of 9 rows rejected.*malformed line"):
        got.require(0.5)
    assert got.require(0.7) is got


def test_no_rows_all_bad_and_required_fields(spark, tmp_path):
    empty = _checked(spark, tmp_path, LINES[:1]).require(0.0)
    assert empty.n_good == empty.n_rejected == empty.good.count() == empty.rejected.count() == 0
    bad = _checked(spark, tmp_path, [LINES[0], LINES[2]])
    assert (bad.n_good, bad.n_rejected, bad.good.count()) == (0, 1, 0)
    schema = StructType([StructField("id", IntegerType(), False), StructField("code", StringType(), True)])
    got = _checked(spark, tmp_path, ["1,A", ",B", "3,", "4,\"C,D\""], "codes", schema=schema, header=False)
    assert sorted(map(tuple, got.good.collect())) == [(1, "A"), (3, None), (4, "C,D")]
    assert [tuple(r)[2:] for r in got.rejected.collect()] == [(",B", "id", None, "missing")]
    with pytest.raises(ValueError, match="reject channel"):
        rejects.check(spark.createDataFrame([("1",)], "_good string"), None, "t", F.lit("f"))


def _files_read(df):
    """Files that the scans of the plan that ``df`` ran with have read."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "FileSourceScanExec" and "visit_occurrence" in node.simpleString(1000):
            n += node.metrics().apply("numFiles").value()
        else:
            todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return n


def _final(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_jobs_on_the_stored_layout(spark, tmp_path):
    d = OmopData(spark, SF_SMALL)
    root = str(tmp_path / "store")
    # Dates over ten years, a null date and a null person.
    visits = (d.visit_occurrence.withColumn("visit_start_date", F.expr("visit_start_date - cast(visit_occurrence_id % 3 * 1200 as int)"))
              .unionByName(spark.createDataFrame([(None, 5, None), (7, None, datetime.date(1990, 1, 1))], schemas.VISIT_OCCURRENCE)))
    tables = {"person": d.person, "visit_occurrence": visits, "death": d.death}
    store.store_dated(spark, tables, root, 4, cohort.DATE_COLUMNS)
    t = store.attach(spark, root, "layout_test")
    for name, df in tables.items():
        back = t[name].drop(schemas.STORED_YEAR)
        assert back.count() == df.count() and back.select(*df.columns).exceptAll(df).count() == 0
    years = visits.select(F.year("visit_start_date")).distinct().count()
    files = spark.read.parquet(os.path.join(root, "visit_occurrence")).select("_metadata.file_path").distinct().count()
    assert years > 5 and files <= 4 * years

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = {n: t[n].drop(schemas.STORED_YEAR) for n in t}
        dates = labels.prediction_dates(plain["visit_occurrence"], plain["death"])
        assert "Exchange hashpartitioning" not in _final(dates)
        assert dates.exceptAll(labels.prediction_dates(visits, d.death)).count() == 0
        persons = cohort.select_persons(plain["person"], plain["visit_occurrence"], plain["death"])
        assert "Exchange hashpartitioning" not in _final(persons)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    cut = cohort.cutoff_date(t["death"], 60)
    want = cohort.extract_tables({"visit_occurrence": visits}, persons, cut)["visit_occurrence"]
    got = cohort.extract_tables({"visit_occurrence": t["visit_occurrence"]}, persons, cut)["visit_occurrence"]
    assert got.columns == want.columns and got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    assert "Exchange hashpartitioning" not in _final(got)
    n = _files_read(got.select("*"))        # a plan that ran once: a repeated run has its metrics reset
    assert 0 < n < files, (n, files)


def test_jobs_with_rejects_and_from_the_store(spark, tmp_path):
    d = OmopData(spark, SF_SMALL)
    omop, root = str(tmp_path / "omop"), str(tmp_path / "store")
    run = lambda *args: cli.main(list(args), spark=spark)
    for name in cli.NEEDS["cohort"]:
        df = d.table(name)
        if name == "measurement":       # one faulty date
            df = df.withColumn("measurement_date", F.col("measurement_date").cast("string")).unionByName(spark.createDataFrame([(1, "soon")], "person_id long, measurement_date string"))
        df.write.option("header", True).csv(os.path.join(omop, f"{name}.csv"))
    with pytest.raises(ValueError, match="measurement: 1 of"):
        run("cohort", "--omop", omop, "--out", str(tmp_path / "none"), "--rejects", str(tmp_path / "r0"))
    run("cohort", "--omop", omop, "--out", str(tmp_path / "a"), "--months", "24", "--rejects", str(tmp_path / "r"), "--max-rejects", "0.01")
    bad = spark.read.parquet(str(tmp_path / "r" / "measurement")).collect()
    assert [(r["table_name"], r["line"], r["column"], r["value"], r["reason"]) for r in bad] == [("measurement", "1,soon", "measurement_date", "soon", "no date")]
    run("store", "--omop", omop, "--out", root, "--buckets", "3", "--rejects", str(tmp_path / "r2"), "--max-rejects", "0.01")
    run("cohort", "--omop", root, "--format", "store", "--out", str(tmp_path / "b"), "--months", "24")
    for name in cli.NEEDS["cohort"]:
        a, b = (spark.read.option("header", True).csv(str(tmp_path / x / name)) for x in "ab")
        assert a.columns == b.columns and a.count() == b.count() and a.exceptAll(b).count() == 0, name
    assert a.count() > 0
    with pytest.raises(SystemExit):
        run("cohort", "--omop", root, "--format", "store", "--out", root, "--rejects", root)
