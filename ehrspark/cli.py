"""Command line for the batch jobs, one sub-command per original entry point.

    python -m ehrspark.cli mapper      --omop DIR --converter FILE --out DIR
    python -m ehrspark.cli conditions  --omop DIR --converter FILE --descriptions FILE --out DIR
    python -m ehrspark.cli convert     --omop DIR --converter FILE --out DIR
    python -m ehrspark.cli cohort      --omop DIR --out DIR [--months 6] [--min-visits 3]
    python -m ehrspark.cli drugs       --omop DIR --concept FILE --out DIR
    python -m ehrspark.cli compare     --real DIR --synthetic DIR --out DIR [--real-drugs F --synthetic-drugs F]
    python -m ehrspark.cli train       --model demographic|five|concepts --omop DIR --model-dir DIR
                                       [--concept-sets DIR] [--fit-on rows|train]
    python -m ehrspark.cli infer       --model demographic|five|concepts --omop DIR --model-dir DIR --out DIR
                                       [--concept-sets DIR]

    python -m ehrspark.cli store       --omop DIR --out ROOT [--buckets N]

``--omop`` folders hold one file per OMOP table (``person.csv``, …; or
``--format parquet``; or ``--format store`` for what ``store`` wrote). Results are written as header CSV folders (or parquet
for the mapper table). On a cluster, paths are shared storage.

With ``--rejects DIR`` faulty rows of CSV tables go to ``DIR/<table>`` (file, line, column, value, reason)
and the job goes on with the good ones, if at most the share ``--max-rejects`` of a table's rows is faulty.
"""

from __future__ import annotations

import argparse
import hashlib
import os
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from .operators import codes, cohort, drugs, features, labels, models, stats
from .schemas import STORED_YEAR
from .session import materialize
from .sources import files, rejects, sinks, store
from .sources.fixtures import OmopData

# The tables each job reads.
NEEDS = {
    "mapper": ("condition_occurrence",),
    "conditions": ("condition_occurrence",),
    "convert": ("condition_occurrence",),
    "cohort": ("person", *cohort.DATE_COLUMNS),
    "store": store.PERSON_KEYED,
    "drugs": ("condition_occurrence", "drug_exposure"),
    "compare": ("condition_occurrence", "person"),
    "demographic": ("person", "visit_occurrence", "death"),
    "five": ("person", "visit_occurrence", "death", "condition_occurrence"),
    "concepts": ("visit_occurrence", "death", "condition_occurrence", "drug_exposure", "procedure_occurrence"),
}


def _omop(spark: SparkSession, a, folder: str | None = None, dated: bool = False) -> OmopData:
    """The tables the job needs; ``dated`` keeps a stored layout's year column."""
    folder = folder or a.omop
    needs = NEEDS[getattr(a, "model", None) or a.cmd]
    if a.format == "store":
        stored = store.attach(spark, folder, "omop_" + hashlib.sha256(folder.encode()).hexdigest()[:16])
        return OmopData.from_tables(spark, {n: stored[n] if dated else stored[n].drop(STORED_YEAR) for n in needs if n in stored})
    if not a.rejects:
        return OmopData.from_tables(spark, files.read_omop_folder(spark, folder, a.format))
    tables = {}
    for name in needs:
        path = os.path.join(folder, f"{name}.csv")
        if files.exists(spark, path):
            checked = rejects.read_checked(spark, path, name)
            # The report is written also if the job ends here.
            checked.rejected.write.mode("append").parquet(os.path.join(a.rejects, name))
            tables[name] = checked.require(a.max_rejects).good
    return OmopData.from_tables(spark, tables)


def _concept_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Concept-set files named ``<set>_condition_id.csv`` (cancer, HD, COPD, T2DM, stroke)."""
    paths = {name: os.path.join(folder, f"{name}_condition_id.csv") for name in features.DISEASE_SETS}
    missing = [v for v in paths.values() if not files.exists(spark, v)]
    if missing:
        raise FileNotFoundError(f"concept sets: {missing}")
    return files.read_concept_sets(spark, paths)


def cmd_mapper(spark, a):
    d = _omop(spark, a)
    conv = files.read_code_converter(spark, a.converter)
    # The conditions are scanned once, for the pairs; the report is on their codes.
    pairs = materialize(codes.code_pairs(d.condition_occurrence), "pairs")
    sinks.write_table(codes.build_mapper(pairs, conv, a.strip_dot), os.path.join(a.out, "icd9_icd10_mapper"))
    report = codes.mapper_report(codes.map_codes(pairs, conv, a.strip_dot))
    sinks.write_csv(report, os.path.join(a.out, "mapper_report"), single_file=True)


def cmd_conditions(spark, a):
    d = _omop(spark, a)
    conv = files.read_code_converter(spark, a.converter)
    desc = files.read_table(spark, a.descriptions, "code_description")
    # The conditions are scanned once, for the count of each code; all rankings start from these.
    counts = materialize(codes.code_counts(d.condition_occurrence), "counts")
    print("number of icd9 codes:", codes.count_icd9_codes(counts, conv, a.strip_dot).first()[0])
    sinks.write_csv(codes.ranked(counts), os.path.join(a.out, "condition_count"), single_file=True)
    for name, level in (("mapped_condition_count", "converted"), ("hierarchy_condition_count", "category")):
        sinks.write_csv(codes.relabelled_counts(counts, conv, desc, F.col(level), a.strip_dot),
                        os.path.join(a.out, name), single_file=True)


def cmd_convert(spark, a):
    d = _omop(spark, a)
    conv = files.read_code_converter(spark, a.converter)
    target = os.path.join(a.out, "condition_occurrence_icd10")
    sinks.write_csv(codes.convert_conditions(d.condition_occurrence, conv, a.strip_dot), target)
    # Counted on the written file: the rows are converted once.
    converted = spark.read.option("header", True).csv(target)
    print("distinct codes after conversion:", codes.distinct_converted(converted).first()[0])


def cmd_cohort(spark, a):
    d = _omop(spark, a, dated=True)
    persons = materialize(cohort.select_persons(d.person, d.visit_occurrence, d.death, a.min_visits), "person")
    sinks.write_csv(persons, os.path.join(a.out, "person"))
    present = {n: d.table(n) for n in cohort.DATE_COLUMNS if d.has(n)}
    extracted = cohort.extract_tables(present, persons, cohort.cutoff_date(d.death, a.months))
    sinks.write_extract(extracted, a.out)


def cmd_store(spark, a):
    d = _omop(spark, a)
    present = {n: d.table(n) for n in store.PERSON_KEYED if d.has(n)}
    store.store_dated(spark, present, a.out, a.buckets, cohort.DATE_COLUMNS)


def cmd_drugs(spark, a):
    d = _omop(spark, a)
    concept = files.read_table(spark, a.concept, "concept")
    for name, family, codes_, link in (("t2_drug", drugs.T2_FAMILY, drugs.T2_CODES, "visit"),
                                       ("t1_drug", drugs.T1_FAMILY, drugs.T1_CODES, "person")):
        counts = drugs.cohort_drug_counts(d.condition_occurrence, d.drug_exposure, family, codes_,
                                          link=link, count=a.count, k=a.k)
        named = drugs.name_drugs(counts, concept).orderBy(F.desc("count"), F.asc("drug"))
        sinks.write_csv(named, os.path.join(a.out, name), single_file=True)


def cmd_compare(spark, a):
    real, syn = _omop(spark, a, a.real), _omop(spark, a, a.synthetic)
    flag = "_is_real"
    both = (real.condition_occurrence.withColumn(flag, F.lit(True))
            .unionByName(syn.condition_occurrence.withColumn(flag, F.lit(False))))
    # Person ids of the two sources may collide: count distinct (source, person).
    keyed = both.withColumn("person_id", F.concat_ws(":", F.col(flag).cast("string"), F.col("person_id")))
    table = materialize(stats.disease_counts(keyed, F.col(flag)), "prevalence")     # read by the tests and by the ranks
    n_real = real.person.select(F.count(F.lit(1))).scalar()
    n_syn = syn.person.select(F.count(F.lit(1))).scalar()
    out = stats.prevalence_binomial(table, n_syn, n_real, a.tests).orderBy(F.desc(stats.REAL))
    sinks.write_csv(out, os.path.join(a.out, "integrate_table"), single_file=True)
    rho, p, n = stats.spearman(table, stats.REAL, stats.SYNTH)
    print(f"spearman rho={rho:.6f} p={p:.6g} n={n}")
    if a.real_drugs and a.synthetic_drugs:
        read = lambda p_: (spark.read.option("header", True).csv(p_)
                           .select("drug", F.col("count").cast("long").alias("count")))
        ov = drugs.drug_overlap(read(a.real_drugs), read(a.synthetic_drugs), a.k)
        sinks.write_csv(ov, os.path.join(a.out, "integrate_drug_table"), single_file=True)
        print("overlap rate:", drugs.overlap_rate(ov, a.k).first()[0])


def _features(spark, a, d: OmopData, train: bool, raw_age: bool = False) -> DataFrame:
    how = "inner" if train and a.model == "five" else "left"
    dates, date_col = ((labels.prediction_dates(d.visit_occurrence, d.death), "prediction_date") if train else
                       (labels.last_visits(d.visit_occurrence), "last_visit_date"))
    demo = features.demographic_features(dates, d.person, date_col, how, raw_age=raw_age)
    if a.model == "five":
        return features.condition_flags(demo, d.condition_occurrence, _concept_sets(spark, a.concept_sets))
    return demo.na.drop(how="any") if train else demo


def cmd_train(spark, a):
    d = _omop(spark, a)
    own_scaler = a.fit_on == "train" and a.model != "concepts"
    if a.model == "concepts":
        ev = materialize(features.event_concepts(d.condition_occurrence, d.drug_exposure,
                                                 d.procedure_occurrence), "events")
        vocab = features.top_concepts(ev, a.k)
        sinks.save_vocabulary(vocab, os.path.join(a.model_dir, "vocabulary"))
        vectors, _ = features.concept_vectors(ev, vocab)
        label = labels.prediction_dates(d.visit_occurrence, d.death).select("person_id", "death")
        train = vectors.join(label, "person_id", "left").na.fill(0.0, ["death"])
        model = models.train_logistic(train, None, "l1", 1.0, max_iter=10000)
    else:
        train = _features(spark, a, d, True, raw_age=own_scaler)
        if own_scaler:
            train = materialize(train, "train")     # read for the ages' bounds, then for the fits
            scaler = models.age_scaler(train)
            train = scaler.transform(train)
        if a.model == "five":
            model = models.train_logistic(train, features.FIVE_DISEASE_COLUMNS, "l2", 1.0, max_iter=1500)
        else:
            train = materialize(train, "train")     # read by the grid and by the cross-validation
            grid = models.grid_search(train, features.DEMOGRAPHIC_COLUMNS)
            sinks.write_csv(grid, os.path.join(a.model_dir, "grid"), single_file=True)     # eight rows
            best = grid.orderBy(F.desc("accuracy"), "max_iter", "penalty").first()
            print(f"grid: max_iter={best.max_iter} penalty={best.penalty} accuracy={best.accuracy:.4f}")
            model, c, acc = models.train_logistic_cv(train, features.DEMOGRAPHIC_COLUMNS, "l2", 10, 20, max_iter=100)
            print(f"best C={c:g} cross-validated accuracy={acc:.4f}")
        if own_scaler:
            model = models.with_scaler(scaler, model)
    models.save_model(model, os.path.join(a.model_dir, a.model))


def cmd_infer(spark, a):
    d = _omop(spark, a)
    model = models.load_model(os.path.join(a.model_dir, a.model))
    if a.model == "concepts":
        ev = features.event_concepts(d.condition_occurrence, d.drug_exposure, d.procedure_occurrence)
        vocab = sinks.load_vocabulary(spark, os.path.join(a.model_dir, "vocabulary"))
        vectors, _ = features.concept_vectors(ev, vocab)
        pred = models.score_with_fallback(model, vectors, d.visit_occurrence)
    else:
        pred = models.score(model, _features(spark, a, d, False, raw_age=models.scales_age(model)))
    pred = materialize(pred, "predictions")     # scored once, for the file and for its check
    sinks.write_csv(pred, os.path.join(a.out, "predictions"))
    print("violations (rows, missing, out of range):", tuple(models.validate_predictions(pred).first()))


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="ehrspark")
    sub = ap.add_subparsers(dest="cmd", required=True)

    def add(name, fn, *args):
        p = sub.add_parser(name)
        p.set_defaults(fn=fn)
        p.add_argument("--format", default="csv", choices=["csv", "parquet", "store"])
        p.add_argument("--rejects", help="folder for the rejected rows of CSV tables")
        p.add_argument("--max-rejects", type=float, default=0.0, help="share of a table's rows that may be rejected")
        for flag, kw in args:
            p.add_argument(flag, **kw)
        return p

    req = {"required": True}
    add("mapper", cmd_mapper, ("--omop", req), ("--converter", req), ("--out", req),
        ("--strip-dot", {"action": "store_true"}))
    add("conditions", cmd_conditions, ("--omop", req), ("--converter", req), ("--descriptions", req),
        ("--out", req), ("--strip-dot", {"action": "store_true"}))
    add("convert", cmd_convert, ("--omop", req), ("--converter", req), ("--out", req),
        ("--strip-dot", {"action": "store_true"}))
    add("cohort", cmd_cohort, ("--omop", req), ("--out", req), ("--months", {"type": int, "default": 6}),
        ("--min-visits", {"type": int, "default": 3}))
    add("store", cmd_store, ("--omop", req), ("--out", req), ("--buckets", {"type": int, "default": 200}))
    add("drugs", cmd_drugs, ("--omop", req), ("--concept", req), ("--out", req),
        ("--count", {"default": "rows", "choices": ["rows", "patients"]}), ("--k", {"type": int, "default": 100}))
    add("compare", cmd_compare, ("--real", req), ("--synthetic", req), ("--out", req),
        ("--tests", {"type": int, "default": 10}), ("--real-drugs", {}), ("--synthetic-drugs", {}),
        ("--k", {"type": int, "default": 50}))
    for name, fn in (("train", cmd_train), ("infer", cmd_infer)):
        p = add(name, fn, ("--model", {"required": True, "choices": ["demographic", "five", "concepts"]}),
                ("--omop", req), ("--model-dir", req), ("--concept-sets", {}),
                ("--k", {"type": int, "default": 1000}))
        if name == "infer":
            p.add_argument("--out", required=True)
        else:
            p.add_argument("--fit-on", default="rows", choices=["rows", "train"],
                           help="scale ages by the rows at hand, or always by those of the training rows")
    return ap


def main(argv=None, spark: SparkSession | None = None) -> int:
    ap = parser()
    a = ap.parse_args(argv)
    if getattr(a, "model", None) == "five" and not a.concept_sets:
        ap.error("--model five needs --concept-sets")
    if a.rejects and a.format != "csv":
        ap.error("--rejects reads CSV tables")
    if spark is None:
        from .session import build_session
        spark = build_session()
    a.fn(spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
