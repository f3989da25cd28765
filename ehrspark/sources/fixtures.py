"""OMOP-shaped views over the driver's TPC-H-style tables.

The view texts are written once with ``{table}`` placeholders. Spark runs them
through ``spark.sql(text, **frames)`` (no global temp views, so two scale
factors can live in one session); the DuckDB oracle formats the placeholders
to plain names and puts the views in front of a query as CTEs. Both engines
therefore see exactly the same definitions.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed fixture definitions (FIXTURES.md); the order is the dependency order.
VIEW_SQL: dict[str, str] = {
    "visit_occurrence": """
SELECT o_orderkey AS visit_occurrence_id, o_custkey AS person_id, CAST(o_orderdate AS DATE) AS visit_start_date
FROM {orders} WHERE o_custkey % 11 <> 0""",
    "person": """
SELECT c_custkey AS person_id, CASE WHEN c_custkey % 2 = 0 THEN 8532 ELSE 8507 END AS gender_concept_id,
  CAST(1920 + c_custkey % 80 AS INT) AS year_of_birth, CAST(1 + c_custkey % 12 AS INT) AS month_of_birth,
  CAST(1 + c_custkey % 28 AS INT) AS day_of_birth,
  CASE c_nationkey % 6 WHEN 0 THEN 8516 WHEN 1 THEN 8515 WHEN 2 THEN 8527 WHEN 3 THEN 8557 WHEN 4 THEN 8657 ELSE 0 END AS race_concept_id
FROM {customer}""",
    "death": """
SELECT person_id, death_date, CAST(death_date AS TIMESTAMP) AS death_datetime FROM (
  SELECT c_custkey AS person_id, CAST(MAX(o_orderdate) AS DATE) + CAST(c_custkey % 400 - 40 AS INT) AS death_date
  FROM {customer} JOIN {orders} ON o_custkey = c_custkey WHERE c_mktsegment = 'MACHINERY' GROUP BY c_custkey) d""",
    "li": """
SELECT o_custkey, o_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, CAST(l_shipdate AS DATE) AS d
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "condition_occurrence": """
SELECT o_custkey AS person_id, o_orderkey AS visit_occurrence_id, l_partkey % 700 AS condition_concept_id,
  l_partkey AS condition_source_concept_id, d AS condition_start_date,
  CASE WHEN l_partkey % 7 = 0 THEN concat('E11.', CAST(l_partkey % 10 AS STRING))
       WHEN l_partkey % 7 = 1 THEN concat('E10.', CAST(l_partkey % 10 AS STRING))
       WHEN l_partkey % 7 = 2 AND l_partkey % 2 = 0 THEN '250.42'
       WHEN l_partkey % 31 = 3 THEN NULL
       ELSE concat(lpad(CAST(l_partkey % 600 AS STRING), 3, '0'),
                   CASE WHEN l_partkey % 3 = 0 THEN '' ELSE CAST(l_partkey % 10 AS STRING) END) END AS condition_source_value
FROM {li} WHERE l_returnflag = 'A'""",
    "drug_exposure": """
SELECT o_custkey AS person_id, o_orderkey AS visit_occurrence_id, l_suppkey * 3 % 700 AS drug_concept_id, d AS drug_exposure_start_date
FROM {li} WHERE l_returnflag = 'N'""",
    "procedure_occurrence": """
SELECT o_custkey AS person_id, o_orderkey AS visit_occurrence_id, l_partkey % 900 AS procedure_concept_id, d AS procedure_date
FROM {li} WHERE l_returnflag = 'R'""",
    "measurement": """
SELECT o_custkey AS person_id, d AS measurement_date FROM {li} WHERE l_linenumber = 1""",
    "observation": """
SELECT o_custkey AS person_id, d AS observation_date FROM {li} WHERE l_linenumber = 2""",
    "observation_period": """
SELECT o_custkey AS person_id, MIN(d) AS observation_period_start_date FROM {li} GROUP BY o_custkey""",
    "icdcode_converter": """
SELECT p_partkey AS conversion_id,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE concat('E', lpad(CAST(p_partkey % 90 AS STRING), 2, '0'), '.', CAST(p_size AS STRING)) END AS icd10,
  CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 1 WHEN 'MEDIUM' THEN 9 WHEN 'SMALL' THEN 9 WHEN 'LARGE' THEN 10 ELSE 4 END AS convertion_type,
  concat(lpad(CAST(p_partkey % 600 AS STRING), 3, '0'),
    CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '9' WHEN 3 THEN '1' ELSE CAST(p_partkey % 10 AS STRING) END) AS icd9
FROM {part}""",
    "code_description": """
SELECT code, MIN(description) AS description FROM (
  SELECT icd10 AS code, concat('D', CAST(conversion_id % 40 AS STRING)) AS description FROM {icdcode_converter} WHERE icd10 IS NOT NULL
  UNION ALL
  SELECT substring(icd10, 1, 3) AS code, concat('G', CAST(conversion_id % 20 AS STRING)) AS description FROM {icdcode_converter} WHERE icd10 IS NOT NULL) x
GROUP BY code""",
    "concept": """
SELECT p_partkey AS concept_id, p_name AS concept_name FROM {part} WHERE p_partkey % 9 <> 0""",
    "concept_set": """
SELECT CASE c % 23 WHEN 0 THEN 'cancer' WHEN 1 THEN 'HD' WHEN 2 THEN 'COPD' WHEN 3 THEN 'T2DM' ELSE 'stroke' END AS set_name, c AS concept_id
FROM (SELECT DISTINCT p_partkey % 700 AS c FROM {part}) x WHERE c % 23 < 5""",
}

# Tables each view reads (driver tables or earlier views).
VIEW_INPUTS: dict[str, tuple[str, ...]] = {
    "visit_occurrence": ("orders",),
    "person": ("customer",),
    "death": ("customer", "orders"),
    "li": ("lineitem", "orders"),
    "condition_occurrence": ("li",),
    "drug_exposure": ("li",),
    "procedure_occurrence": ("li",),
    "measurement": ("li",),
    "observation": ("li",),
    "observation_period": ("li",),
    "icdcode_converter": ("part",),
    "code_description": ("icdcode_converter",),
    "concept": ("part",),
    "concept_set": ("part",),
}

OMOP_TABLES = tuple(v for v in VIEW_SQL if v != "li")


def duckdb_ctes() -> str:
    """All views as one DuckDB ``WITH`` prefix (no trailing query)."""
    names = {t: t for t in DRIVER_TABLES + tuple(VIEW_SQL)}
    parts = [f"{name} AS ({sql.format(**names).strip()})" for name, sql in VIEW_SQL.items()]
    return "WITH " + ",\n".join(parts)


class OmopData:
    """Lazily built OMOP DataFrames for one scale-factor folder.

    Nothing is read until a table is asked for; each table is one lazy plan,
    so Catalyst prunes columns and pushes filters down to the parquet scans.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def from_tables(cls, spark: SparkSession, tables: dict[str, DataFrame]) -> "OmopData":
        """Stored OMOP tables (e.g. ``files.read_omop_folder`` or ``store.load_tables``)."""
        d = cls(spark, "")
        d._frames.update(tables)
        return d

    def has(self, name: str) -> bool:
        """Whether ``name`` can be served (always for fixture folders)."""
        return bool(self.sf_dir) or name in self._frames

    def raw(self, name: str) -> DataFrame:
        if name not in self._frames:
            if not self.sf_dir:
                raise KeyError(f"table {name} is not among the stored tables")
            self._frames[name] = self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        return self._frames[name]

    def table(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.raw(name)
        if name not in self._frames:
            if not self.sf_dir:
                raise KeyError(f"table {name} is not among the stored tables")
            inputs = {t: self.table(t) for t in VIEW_INPUTS[name]}
            self._frames[name] = self.spark.sql(VIEW_SQL[name], **inputs)
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in VIEW_SQL:
            return self.table(name)
        raise AttributeError(name)

    def tables(self, names=OMOP_TABLES) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in names}
