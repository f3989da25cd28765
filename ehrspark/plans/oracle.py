"""DuckDB SQL oracles, one per catalogue query.

Each oracle is written independently of the Spark plan, closer to the
original row-by-row formulation (e.g. fifteen left joins for the tiered code
lookup instead of an exploded candidate list), so agreement between the two is
a real check. Every oracle is prefixed with the fixture views as CTEs.
"""

from __future__ import annotations

from ..operators.drugs import T1_CODES, T2_CODES
from ..operators.features import DISEASE_SETS, GENDER_CONCEPTS, RACE_CONCEPTS
from ..sources.fixtures import duckdb_ctes

# Parameters shared with the Spark catalogue (FIXTURES.md).
CUTOFF_MONTHS = 6
EXTRACT_MONTHS = 24
TOP_K = 50
DRUG_LIMIT = 100
BINOMIAL_TESTS = 10
CV_FOLDS = 20
CV_CS = 10
ROUND = 9
P_ROUND = 6



def _tier_join_sql() -> str:
    """Code map written as 3 tiers × 5 candidates of left joins + COALESCE."""
    keys = ["c.v", "regexp_replace(c.v, '[0-9]$', '')", "c.v || '0'", "c.v || '9'", "c.v || '1'"]
    types = [1, 9, 10]
    joins, cols = [], []
    for t_i, typ in enumerate(types, start=1):
        for k_i, key in enumerate(keys, start=1):
            a = f"t{t_i}k{k_i}"
            joins.append(f"LEFT JOIN dict {a} ON {a}.convertion_type = {typ} AND {a}.icd9 = {key}")
            cols.append(f"{a}.icd10 AS {a}")
    all_cols = [f"t{t}k{k}" for t in range(1, 4) for k in range(1, 6)]
    tier_cases = " ".join(
        f"WHEN COALESCE({', '.join(f't{t}k{k}' for k in range(1, 6))}) IS NOT NULL THEN {t}" for t in range(1, 4))
    cand_cases = " ".join(
        f"WHEN t{t}k{k} IS NOT NULL THEN {k}" for t in range(1, 4) for k in range(1, 6))
    return f"""
dict AS (
  SELECT icd9, convertion_type, icd10 FROM (
    SELECT icd9, convertion_type, icd10,
           row_number() OVER (PARTITION BY icd9, convertion_type ORDER BY conversion_id) AS r
    FROM icdcode_converter WHERE convertion_type IN (1, 9, 10)) z
  WHERE r = 1),
codes AS (SELECT DISTINCT condition_source_value AS v FROM condition_occurrence WHERE condition_source_value IS NOT NULL),
wide AS (
  SELECT c.v, {', '.join(cols)}
  FROM codes c
  {chr(10).join('  ' + j for j in joins)}),
code_map AS (
  SELECT v AS condition_source_value, COALESCE({', '.join(all_cols)}) AS icd10,
         CASE {tier_cases} END AS tier,
         CASE {cand_cases} END AS candidate
  FROM wide),
icd9_dict AS (SELECT DISTINCT icd9 FROM icdcode_converter WHERE icd9 IS NOT NULL),
code_lab AS (
  SELECT m.condition_source_value,
         (i.icd9 IS NOT NULL) AS is_icd9,
         CASE WHEN i.icd9 IS NOT NULL THEN m.icd10 ELSE m.condition_source_value END AS converted
  FROM code_map m LEFT JOIN icd9_dict i ON i.icd9 = m.condition_source_value)"""


CODE_CTES = _tier_join_sql()



PERSONS_SQL = """
persons_sel AS (
  SELECT p.* FROM person p
  WHERE NOT EXISTS (SELECT 1 FROM visit_occurrence v
                    WHERE v.person_id = p.person_id
                      AND v.visit_start_date < make_date(p.year_of_birth, p.month_of_birth, p.day_of_birth))
    AND NOT EXISTS (SELECT 1 FROM visit_occurrence v, death d
                    WHERE v.person_id = p.person_id AND d.person_id = p.person_id
                      AND v.visit_start_date > d.death_date)
    AND (SELECT count(DISTINCT v.visit_occurrence_id) FROM visit_occurrence v
         WHERE v.person_id = p.person_id) >= 3)"""


def _cut_sql(months: int) -> str:
    return f"cut AS (SELECT CAST(CAST(max(death_datetime) AS DATE) - INTERVAL {months} MONTH AS DATE) AS c FROM death)"


EXTRACT_DATES = {
    "condition_occurrence": "condition_start_date",
    "death": "death_datetime",
    "drug_exposure": "drug_exposure_start_date",
    "measurement": "measurement_date",
    "observation": "observation_date",
    "observation_period": "observation_period_start_date",
    "procedure_occurrence": "procedure_date",
    "visit_occurrence": "visit_start_date",
}


def _extract_sql(table: str) -> str:
    col = EXTRACT_DATES[table]
    bound = "CAST((SELECT c FROM cut) AS TIMESTAMP)" if col == "death_datetime" else "(SELECT c FROM cut)"
    return (f"SELECT * FROM {table} WHERE person_id IN (SELECT person_id FROM persons_sel) "
            f"AND {col} < {bound}")


def _in_list(codes) -> str:
    return ", ".join(f"'{c}'" for c in codes)


def _drug_sql(link: str, count: str, population: int | None = None, limit: int = DRUG_LIMIT) -> str:
    if link == "visit":
        family, codes, key = "E11", T2_CODES, "visit_occurrence_id"
    else:
        family, codes, key = "E10", T1_CODES, "person_id"
    measure = "count(*)" if count == "rows" else "count(DISTINCT k.person_id)"
    pop = "" if population is None else f" AND person_id % 2 = {population}"
    return f"""WITH k AS (
    SELECT person_id, {key} AS link_key FROM condition_occurrence
    WHERE (regexp_matches(condition_source_value, '^{family}[.][A-Z0-9]')
           OR condition_source_value IN ({_in_list(codes)})){pop})
  SELECT e.drug_concept_id, {measure} AS count
  FROM k LEFT JOIN drug_exposure e ON e.{key} = k.link_key
  GROUP BY e.drug_concept_id
  ORDER BY count DESC, e.drug_concept_id ASC NULLS LAST
  LIMIT {limit}"""


def _named_sql(inner: str) -> str:
    return f"""SELECT cn.concept_name AS drug, t.count FROM ({inner}) t
  JOIN concept cn ON cn.concept_id = t.drug_concept_id"""


OVERLAP_SQL = f"""
real_named AS ({_named_sql(_drug_sql("person", "rows", 0))}),
syn_named AS ({_named_sql(_drug_sql("person", "rows", 1))}),
real_top AS (SELECT * FROM real_named ORDER BY count DESC, drug ASC LIMIT {TOP_K}),
overlap AS (SELECT r.drug, r.count, s.count AS synpuf_count FROM real_top r LEFT JOIN syn_named s ON s.drug = r.drug)"""

PREVALENCE_SQL = """
pairs AS (SELECT DISTINCT condition_concept_id, person_id, person_id % 2 = 0 AS is_real
          FROM condition_occurrence WHERE person_id IS NOT NULL AND condition_concept_id IS NOT NULL),
tab AS (SELECT condition_concept_id,
               count(*) FILTER (WHERE is_real) AS disease_conut_in_real_patients,
               count(*) FILTER (WHERE NOT is_real) AS disease_conut_in_synpuf_patients
        FROM pairs GROUP BY condition_concept_id
        HAVING count(*) FILTER (WHERE is_real) > 0)"""

RANKS_SQL = PREVALENCE_SQL + """,
rk AS (SELECT CAST(rank() OVER (ORDER BY disease_conut_in_real_patients) AS DOUBLE)
              + CAST(count(*) OVER (PARTITION BY disease_conut_in_real_patients) - 1 AS DOUBLE) / 2.0 AS ra,
              CAST(rank() OVER (ORDER BY disease_conut_in_synpuf_patients) AS DOUBLE)
              + CAST(count(*) OVER (PARTITION BY disease_conut_in_synpuf_patients) - 1 AS DOUBLE) / 2.0 AS rb
       FROM tab)"""

BINOMIAL_SQL = PREVALENCE_SQL + f""",
pop AS (SELECT count(*) FILTER (WHERE person_id % 2 = 0) AS n_real,
               count(*) FILTER (WHERE person_id % 2 <> 0) AS n_syn FROM person),
tests AS (SELECT t.condition_concept_id, t.disease_conut_in_synpuf_patients AS x, pop.n_syn AS n,
                 t.disease_conut_in_real_patients / pop.n_real AS p
          FROM tab t CROSS JOIN pop
          ORDER BY t.disease_conut_in_real_patients DESC, t.condition_concept_id LIMIT {BINOMIAL_TESTS}),
grid AS (SELECT t.*, unnest(generate_series(0, t.n)) AS k FROM tests t),
lp AS (SELECT condition_concept_id, x, n, p, k,
              exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(p) + (n - k) * ln(1 - p)) AS pmf,
              exp(lgamma(n + 1) - lgamma(x + 1) - lgamma(n - x + 1) + x * ln(p) + (n - x) * ln(1 - p)) AS d
       FROM grid),
pv AS (SELECT condition_concept_id,
              CASE WHEN min(x) = min(n * p) THEN 1.0
                   ELSE least(1.0, sum(CASE WHEN x < n * p
                        THEN (CASE WHEN k <= x OR (k >= ceil(n * p) AND pmf <= d * (1 + 1e-7)) THEN pmf ELSE 0 END)
                        ELSE (CASE WHEN (k <= floor(n * p) AND pmf <= d * (1 + 1e-7)) OR k >= x THEN pmf ELSE 0 END)
                        END)) END AS p_value
       FROM lp GROUP BY condition_concept_id)"""

DATES_SQL = """
pos AS (SELECT v.person_id, min(v.visit_start_date) AS prediction_date, CAST(1.0 AS DOUBLE) AS death
        FROM death d JOIN visit_occurrence v ON d.person_id = v.person_id
        WHERE d.death_date - v.visit_start_date <= 180
        GROUP BY v.person_id),
neg AS (SELECT person_id, max(visit_start_date) AS prediction_date, CAST(0.0 AS DOUBLE) AS death
        FROM visit_occurrence
        WHERE person_id IS NOT NULL AND person_id NOT IN (SELECT person_id FROM pos)
        GROUP BY person_id),
pdates AS (SELECT * FROM pos UNION ALL SELECT * FROM neg)"""

GENDERS = GENDER_CONCEPTS
RACES = RACE_CONCEPTS


def _demo_sql(name: str, dates: str, date_col: str, with_death: bool, inner: bool = False) -> str:
    death = "j.death, " if with_death else ""
    flags = ", ".join([f"CASE WHEN j.gender_concept_id = {g} THEN 1.0 ELSE 0.0 END::DOUBLE AS g_{g}" for g in GENDERS]
                      + [f"CASE WHEN j.race_concept_id = {r} THEN 1.0 ELSE 0.0 END::DOUBLE AS r_{r}" for r in RACES])
    keep = "WHERE j.known" if inner else ""
    return f"""
{name}_j AS (SELECT dd.*, (dd.{date_col} - make_date(p.year_of_birth, 1, 1)) / 365.25 AS age,
                 p.gender_concept_id, p.race_concept_id, p.person_id IS NOT NULL AS known
          FROM {dates} dd LEFT JOIN person p ON p.person_id = dd.person_id),
{name}_b AS (SELECT min(age) AS lo, max(age) AS hi FROM {name}_j),
{name} AS (SELECT {death}j.person_id,
             COALESCE(CASE WHEN b.hi > b.lo THEN (j.age - b.lo) / (b.hi - b.lo) ELSE j.age - b.lo END, 0.0)
               AS scaled_age, {flags}
           FROM {name}_j j CROSS JOIN {name}_b b {keep})"""


# Complete training rows per class, dealt to the folds as evenly as can be.
FOLDS_SQL = DATES_SQL + "," + _demo_sql("demo", "pdates", "prediction_date", True) + f""",
classes AS (SELECT death, count(*) AS n FROM demo WHERE death IS NOT NULL AND scaled_age IS NOT NULL GROUP BY death),
folds AS (SELECT CAST(f AS INTEGER) AS fold, death,
                 n // {CV_FOLDS} + CASE WHEN f < n % {CV_FOLDS} THEN 1 ELSE 0 END AS n_rows
          FROM classes, range({CV_FOLDS}) t(f))"""

LAST_SQL = """
lastv AS (SELECT person_id, max(visit_start_date) AS last_visit_date FROM visit_occurrence
          WHERE person_id IS NOT NULL GROUP BY person_id)"""

SETS = DISEASE_SETS
HITS_SQL = """
hits AS (SELECT DISTINCT c.person_id, s.set_name FROM condition_occurrence c
         JOIN concept_set s ON s.concept_id = c.condition_concept_id)"""

EVENTS_SQL = """
ev AS (SELECT DISTINCT person_id, condition_concept_id AS concept_id, 'condition' AS domain FROM condition_occurrence
       UNION ALL SELECT DISTINCT person_id, drug_concept_id AS concept_id, 'drug' AS domain FROM drug_exposure
       UNION ALL SELECT DISTINCT person_id, procedure_concept_id AS concept_id, 'procedure' AS domain
       FROM procedure_occurrence)"""

VOCAB_SQL = EVENTS_SQL + f""",
cnt AS (SELECT concept_id, count(*) AS count FROM ev WHERE concept_id IS NOT NULL GROUP BY concept_id),
vocab AS (SELECT CAST(row_number() OVER (ORDER BY count DESC, concept_id) - 1 AS INTEGER) AS pos, concept_id, count
          FROM cnt ORDER BY count DESC, concept_id LIMIT {TOP_K}),
clong AS (SELECT DISTINCT e.person_id, v.pos, e.concept_id FROM ev e JOIN vocab v ON v.concept_id = e.concept_id)"""


def _r(expr: str, digits: int = ROUND) -> str:
    return f"round({expr}, {digits})"


def _relabel_sql(label_expr: str) -> str:
    return f"""
counts AS (SELECT condition_source_value, count(condition_source_value) AS cnt
           FROM condition_occurrence GROUP BY condition_source_value),
lab AS (SELECT condition_source_value, {label_expr} AS lbl FROM code_lab)
SELECT COALESCE(d.description, l.lbl) AS condition_source_value, CAST(sum(c.cnt) AS BIGINT) AS count
FROM counts c JOIN lab l ON l.condition_source_value = c.condition_source_value
LEFT JOIN code_description d ON d.code = l.lbl
WHERE l.lbl IS NOT NULL
GROUP BY 1"""


ORACLES: dict[str, str] = {
    "code_map": CODE_CTES + "\nSELECT * FROM code_map",
    "icd_mapper": CODE_CTES + """
SELECT DISTINCT co.condition_source_concept_id, m.condition_source_value, m.icd10
FROM code_map m JOIN condition_occurrence co ON m.condition_source_value = co.condition_source_value""",
    "mapper_report": CODE_CTES + """,
g AS (SELECT tier, candidate, count(*) AS n_codes FROM code_map GROUP BY tier, candidate)
SELECT g.tier, g.candidate, g.n_codes,
       (SELECT count(*) FROM code_map)
       - (SELECT count(*) FROM code_map m WHERE m.tier IS NOT NULL AND (g.tier IS NULL OR m.tier <= g.tier))
         AS unresolved_after_tier
FROM g""",
    "unresolved_codes": CODE_CTES + "\nSELECT condition_source_value FROM code_map WHERE icd10 IS NULL",
    "tier1_nine_hits": CODE_CTES + "\nSELECT v AS condition_source_value, t1k4 AS icd10 FROM wide WHERE t1k4 IS NOT NULL",
    "condition_counts": """
SELECT condition_source_value, count(condition_source_value) AS count
FROM condition_occurrence GROUP BY condition_source_value""",
    "mapped_condition_counts": CODE_CTES + "," + _relabel_sql("converted"),
    "hierarchy_condition_counts": CODE_CTES + "," + _relabel_sql(
        "CASE WHEN converted IS NULL THEN NULL ELSE split_part(converted, '.', 1) END"),
    "icd9_code_count": """
SELECT count(*) AS n_icd9_codes FROM (SELECT DISTINCT condition_source_value FROM condition_occurrence) c
WHERE c.condition_source_value IN (SELECT icd9 FROM icdcode_converter)""",
    "code_labels": CODE_CTES + """
SELECT condition_source_value, is_icd9, converted,
       CASE WHEN converted IS NULL THEN NULL ELSE split_part(converted, '.', 1) END AS category
FROM code_lab""",
    "converted_conditions": CODE_CTES + """
SELECT co.person_id, co.visit_occurrence_id, co.condition_concept_id, co.condition_source_concept_id,
       co.condition_start_date, l.converted AS condition_source_value
FROM condition_occurrence co LEFT JOIN code_lab l ON l.condition_source_value = co.condition_source_value""",
    "converted_distinct": CODE_CTES + """
SELECT count(DISTINCT l.converted) AS n_distinct_codes
FROM condition_occurrence co JOIN code_lab l ON l.condition_source_value = co.condition_source_value""",
    "rejected_conditions": """
SELECT * FROM (
  SELECT 'person_id' AS "column", 'out of range' AS reason, count(*) AS n_rows FROM condition_occurrence WHERE person_id % 101 = 9
  UNION ALL SELECT 'visit_occurrence_id', 'no number', count(*) FROM condition_occurrence WHERE visit_occurrence_id % 89 = 7
  UNION ALL SELECT 'condition_concept_id', 'no whole number', count(*) FROM condition_occurrence WHERE condition_concept_id % 83 = 11
  UNION ALL SELECT 'condition_start_date', 'no date', count(*) FROM condition_occurrence WHERE person_id % 97 = 5) f
WHERE n_rows > 0
UNION ALL SELECT '', 'good', count(*) FROM condition_occurrence
WHERE NOT (person_id % 101 = 9 OR visit_occurrence_id % 89 = 7 OR condition_concept_id % 83 = 11 OR person_id % 97 = 5)""",
    "delivered_counts": """
SELECT condition_source_value, count(condition_source_value) AS count, count(DISTINCT person_id) AS n_patients
FROM condition_occurrence GROUP BY condition_source_value""",
    "delivered_distinct": "SELECT count(DISTINCT condition_source_value) AS n_keys FROM condition_occurrence",
    "delivered_set_patients": HITS_SQL + """
SELECT set_name, count(*) AS n_patients FROM hits WHERE person_id IS NOT NULL GROUP BY set_name""",
    "cutoff": f"SELECT CAST(CAST(max(death_datetime) AS DATE) - INTERVAL {CUTOFF_MONTHS} MONTH AS DATE) AS cutoff_date "
              "FROM death",
    "persons_selected": PERSONS_SQL + "\nSELECT * FROM persons_sel",
    "cohort_id_buckets": PERSONS_SQL + """
SELECT CAST(CASE WHEN person_id > 0 THEN 1 + (person_id - 1) // 32768 ELSE -((-person_id) // 32768) END AS BIGINT) AS bucket,
       count(DISTINCT person_id) AS n
FROM persons_sel WHERE person_id IS NOT NULL GROUP BY 1""",
    "extract_conditions": PERSONS_SQL + ",\n" + _cut_sql(EXTRACT_MONTHS) + "\n" + _extract_sql("condition_occurrence"),
    "extract_row_counts": PERSONS_SQL + ",\n" + _cut_sql(EXTRACT_MONTHS) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM ({_extract_sql(t)}) x" for t in EXTRACT_DATES),
    "drugs_by_visit": _drug_sql("visit", "rows"),
    "drugs_by_visit_patients": _drug_sql("visit", "patients"),
    "drugs_by_person": _drug_sql("person", "rows"),
    "drugs_by_person_patients": _drug_sql("person", "patients"),
    "drug_names": _named_sql(_drug_sql("visit", "rows")),
    "drug_overlap": OVERLAP_SQL + "\nSELECT * FROM overlap",
    "drug_overlap_rate": OVERLAP_SQL + f"""
SELECT round(1.0::DOUBLE - CAST(count(*) FILTER (WHERE synpuf_count IS NULL) AS DOUBLE) / {TOP_K}.0, {ROUND})
  AS overlap_rate FROM overlap""",
    "prevalence_binomial": BINOMIAL_SQL + f"""
SELECT t.*, round(pv.p_value, {P_ROUND}) AS p_value FROM tab t LEFT JOIN pv USING (condition_concept_id)""",
    "prevalence_spearman": RANKS_SQL + f"""
SELECT count(*) AS n_rows, round(corr(ra, rb), {ROUND}) AS rho FROM rk""",
    # Twice the tail of Student's t beyond |t|: with t = sqrt(df) tan(a) the density is that of cos(a)^(df - 1),
    # which Simpson's rule integrates from a to pi / 2.
    "prevalence_spearman_test": RANKS_SQL + f""",
r AS (SELECT count(*) AS n, corr(ra, rb) AS rho FROM rk),
a AS (SELECT n, rho, n - 2 AS df, atan(abs(rho) / sqrt((1 + rho) * (1 - rho))) AS lo FROM r),
grid AS (SELECT a.*, k, (pi() / 2 - lo) / 20000 AS h, lo + k * (pi() / 2 - lo) / 20000 AS x,
                CASE WHEN k IN (0, 20000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END AS weight FROM a, range(20001) t(k))
SELECT n AS n_rows, round(rho, {P_ROUND}) AS rho,
       round(2 * exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0)) / sqrt(pi()) * sum(weight * pow(greatest(cos(x), 0.0), df - 1)) * min(h) / 3, {P_ROUND}) AS p_value
FROM grid GROUP BY n, rho, df""",
    "prediction_dates": DATES_SQL + "\nSELECT * FROM pdates",
    "class_balance": DATES_SQL + "\nSELECT death, count(*) AS n_persons FROM pdates GROUP BY death",
    "last_visits": LAST_SQL + "\nSELECT * FROM lastv",
    "demographic_train": DATES_SQL + "," + _demo_sql("demo", "pdates", "prediction_date", True) + f"""
SELECT death, person_id, {_r("scaled_age")} AS scaled_age, g_8532, r_8516, r_8515, r_8527, r_8557, r_8657 FROM demo""",
    "demographic_infer": LAST_SQL + "," + _demo_sql("demo", "lastv", "last_visit_date", False) + f"""
SELECT person_id, {_r("scaled_age")} AS scaled_age, g_8532, r_8516, r_8515, r_8527, r_8557, r_8657 FROM demo""",
    "condition_flags": DATES_SQL + "," + _demo_sql("demo", "pdates", "prediction_date", True, inner=True) + ","
    + HITS_SQL + f"""
SELECT f.death, f.person_id, {_r("f.scaled_age")} AS scaled_age, f.g_8532, f.r_8516, f.r_8515, f.r_8527, f.r_8557,
       f.r_8657, """ + ", ".join(
        f"CASE WHEN EXISTS (SELECT 1 FROM hits h WHERE h.person_id = f.person_id AND h.set_name = '{s}') "
        f"THEN 1.0 ELSE 0.0 END::DOUBLE AS {s}" for s in SETS) + "\nFROM demo f",
    "demographic_infer_train_scaled": DATES_SQL + "," + LAST_SQL + "," + _demo_sql("tr", "pdates", "prediction_date", True)
    + "," + _demo_sql("inf", "lastv", "last_visit_date", False) + f"""
SELECT i.person_id, {_r("COALESCE(CASE WHEN b.hi > b.lo THEN (j.age - b.lo) / (b.hi - b.lo) ELSE j.age - b.lo END, 0.0)")} AS scaled_age,
       i.g_8532, i.r_8516, i.r_8515, i.r_8527, i.r_8557, i.r_8657
FROM inf i JOIN inf_j j USING (person_id) CROSS JOIN tr_b b""",
    "demographic_folds": FOLDS_SQL + "\nSELECT * FROM folds WHERE n_rows > 0",
    "demographic_fit_check": FOLDS_SQL + f"""
SELECT CAST(f AS INTEGER) AS fold, CAST(c AS INTEGER) AS c_index,
       CAST((SELECT sum(n_rows) FROM folds) - (SELECT sum(n_rows) FROM folds x WHERE x.fold = f) AS BIGINT) AS n_train, true AS at_optimum
FROM range({CV_FOLDS}) a(f), range({CV_CS}) b(c)""",
    "person_composition": """
SELECT 'gender' AS attribute, CAST(gender_concept_id AS INTEGER) AS concept_id, count(*) AS n_persons
FROM person GROUP BY gender_concept_id
UNION ALL
SELECT 'race' AS attribute, CAST(race_concept_id AS INTEGER) AS concept_id, count(*) AS n_persons
FROM person GROUP BY race_concept_id""",
    "condition_patients": HITS_SQL + "\nSELECT set_name, count(*) AS n_patients FROM hits GROUP BY set_name",
    "event_concepts": EVENTS_SQL + "\nSELECT * FROM ev",
    "top_concepts": VOCAB_SQL + "\nSELECT * FROM vocab",
    "top_concepts_certified": VOCAB_SQL + "\nSELECT concept_id, count FROM vocab",
    "top_codes_certified": f"""
SELECT condition_source_value, count(*) AS count FROM condition_occurrence WHERE condition_source_value IS NOT NULL
GROUP BY condition_source_value ORDER BY count DESC, condition_source_value LIMIT {DRUG_LIMIT}""",
    "concept_long": VOCAB_SQL + "\nSELECT * FROM clong",
    "concept_wide": VOCAB_SQL + "\nSELECT person_id, " + ", ".join(
        f"max(CASE WHEN pos = {i} THEN 1.0 ELSE 0.0 END)::DOUBLE AS f_{i:03d}" for i in range(TOP_K))
    + "\nFROM clong GROUP BY person_id",
    "complete_rows": DATES_SQL + "," + _demo_sql("demo", "pdates", "prediction_date", True) + f"""
SELECT death, {_r("scaled_age")} AS scaled_age, g_8532, r_8516, r_8515, r_8527, r_8557, r_8657 FROM demo
WHERE death IS NOT NULL AND scaled_age IS NOT NULL""",
    # The output contract: one probability for each person with a visit.
    "prediction_violations": LAST_SQL + """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_out_of_range FROM lastv""",
}


def full_sql(name: str) -> str:
    """The oracle for ``name`` with the fixture views in front."""
    body = ORACLES[name].strip()
    ctes = duckdb_ctes()
    head = body.upper()
    if head.startswith("SELECT"):
        return ctes + "\n" + body
    if head.startswith("WITH"):
        return ctes + "\nSELECT * FROM (" + body + ") q"
    return ctes + ",\n" + body
