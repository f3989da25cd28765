"""Mortality labels: prediction dates and last visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import days_between
from ..functions.joins import measured

PID = "person_id"

# Upper bound (rows) for broadcasting the recorded deaths; above it the visits
# are joined by shuffle, one row per day of a person.
MAX_BROADCAST_DEATHS = 5_000_000


def prediction_dates(visit: DataFrame, death: DataFrame, horizon: int = 180, order: str = "earliest",
                     min_days: int | None = None) -> DataFrame:
    """(person_id, prediction_date, death) for every person with a visit.

    Positive (death 1.0): a visit at most ``horizon`` days before a recorded
    death (no lower bound unless ``min_days``: visits after death count);
    the prediction date is the earliest such visit (``order="latest"``: the
    latest). Everyone else with a visit is negative (0.0) at their last visit.

    All visits are shuffled once, as one partially aggregated maximum per
    person. The hits come from an inner join, so only visits of persons with a
    death go on: found by broadcast when the deaths are few (checked), else
    from distinct (person, date) pairs, which spread a skewed person's rows
    over the shuffle by date.
    """
    days = visit.select(PID, "visit_start_date").where(F.col(PID).isNotNull())
    deaths = death.select(PID, "death_date").where(F.col(PID).isNotNull()).distinct()
    deaths, small = measured(deaths, MAX_BROADCAST_DEATHS, name="deaths")
    if small:
        deaths = F.broadcast(deaths)
    else:
        days = days.distinct()
    gap = days_between(F.col("death_date"), F.col("visit_start_date"))
    qualifies = gap <= horizon
    if min_days is not None:
        qualifies = qualifies & (gap >= min_days)
    pick = F.min("visit_start_date") if order == "earliest" else F.max("visit_start_date")
    hits = days.join(deaths, PID).where(qualifies).groupBy(PID).agg(pick.alias("_pos"))
    return last_visits(visit).join(hits, PID, "left").select(
        PID,
        F.coalesce("_pos", "last_visit_date").alias("prediction_date"),
        F.when(F.col("_pos").isNotNull(), 1.0).otherwise(0.0).alias("death"))


def last_visits(visit: DataFrame) -> DataFrame:
    """(person_id, last_visit_date)."""
    return (visit.where(F.col(PID).isNotNull()).groupBy(PID)
            .agg(F.max("visit_start_date").alias("last_visit_date")))


def class_balance(dates: DataFrame) -> DataFrame:
    """Persons per label: (death, n_persons)."""
    return dates.groupBy("death").agg(F.count(F.lit(1)).alias("n_persons"))
