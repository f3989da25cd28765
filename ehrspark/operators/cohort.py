"""Cohort selection by data-quality rules, cut-off date and table extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import birth_date, months_before
from ..functions.idsets import measured_set, members
from ..schemas import STORED_YEAR

PID = "person_id"

# The date column the cut-off applies to, per extracted table.
DATE_COLUMNS = {
    "condition_occurrence": "condition_start_date",
    "death": "death_datetime",
    "drug_exposure": "drug_exposure_start_date",
    "measurement": "measurement_date",
    "observation": "observation_date",
    "observation_period": "observation_period_start_date",
    "procedure_occurrence": "procedure_date",
    "visit_occurrence": "visit_start_date",
}


def cutoff_date(death: DataFrame, months: int = 6) -> DataFrame:
    """One row, the latest death date minus ``months`` calendar months."""
    return death.agg(months_before(F.to_date(F.max("death_datetime")), months).alias("cutoff_date"))


def select_persons(person: DataFrame, visit: DataFrame, death: DataFrame, min_visits: int = 3) -> DataFrame:
    """Every person column of persons who pass the three data-quality rules.

    * no visit before the birth date,
    * no visit after a recorded death date,
    * at least ``min_visits`` distinct visits.

    Visits and deaths are reduced to one row per person (partial aggregation,
    so a person holding a large share of the visits costs no single task) and
    joined on the person key only.
    """
    visits = (visit.where(F.col(PID).isNotNull())
              .groupBy(PID)
              .agg(F.min("visit_start_date").alias("_first_visit"),
                   F.max("visit_start_date").alias("_last_visit"),
                   F.countDistinct("visit_occurrence_id").alias("_n_visits"))
              .where(F.col("_n_visits") >= min_visits))
    deaths = (death.where(F.col(PID).isNotNull())
              .groupBy(PID).agg(F.min("death_date").alias("_first_death")))
    born = birth_date(F.col("year_of_birth"), F.col("month_of_birth"), F.col("day_of_birth"))
    return (person.join(visits, PID)
            .join(deaths, PID, "left")
            .where(~F.coalesce(F.col("_first_visit") < born, F.lit(False)))
            .where(~F.coalesce(F.col("_last_visit") > F.col("_first_death"), F.lit(False)))
            .select(*person.columns))


def extract_tables(tables: dict[str, DataFrame], persons: DataFrame, cutoff: DataFrame,
                   date_columns: dict[str, str] = DATE_COLUMNS) -> dict[str, DataFrame]:
    """Each table restricted to cohort members and dates strictly before the cut-off.

    The cohort's ids become an exact set of bitmaps by bucket, computed and
    written once for all tables and broadcast if its bytes allow, so a table is read,
    filtered by date and by one bit, and not shuffled; a set beyond the bound is joined by bucket.
    The cut-off is a scalar subquery, evaluated once. NULL dates and NULL ids drop.
    A table stored by the year of its date (``sources.store.store_dated``) is read up to the cut-off's year only.
    """
    ids, small = measured_set(persons, PID)
    limit = cutoff.select("cutoff_date").scalar()

    def before(df: DataFrame, date: str) -> DataFrame:
        rows = df.where(F.col(date) < limit)
        return rows.where(F.col(STORED_YEAR) <= F.year(limit)).drop(STORED_YEAR) if STORED_YEAR in df.columns else rows

    return {name: members(before(df, date_columns[name]), PID, ids, small) for name, df in tables.items()}


def extract_row_counts(extracted: dict[str, DataFrame]) -> DataFrame:
    """Rows per extracted table: (table_name, n_rows)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in extracted.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
