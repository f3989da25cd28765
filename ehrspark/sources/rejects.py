"""Reject channel: the good rows and the rejected rows of a delivered CSV file, written in one pass.

A field that isn't of its column's type, a missing required field or a line
with too many or too few fields rejects its row, not the job. Good and
rejected rows are written side by side under ``spark.checkpoint.dir``, so the
input is read once and both are Parquet tables from then on. How many rows
may be rejected is the caller's choice (``Checked.require``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, DateType, IntegralType, StringType, StructField, StructType

from .. import schemas
from ..session import scratch_path

FILE, LINE, FAULTS, GOOD = "_file", "_line", "_faults", "_good"
CORRUPT = "_corrupt"
STRICT_DATE = r"^\d{4}-\d{2}-\d{2}$"


@dataclass
class Checked:
    """A read table: ``good`` holds its typed rows, ``rejected`` one row per fault."""

    name: str
    good: DataFrame
    rejected: DataFrame     # table_name, file, line, column, value, reason
    n_good: int
    n_rejected: int         # rows, not faults

    def require(self, allowed: float) -> "Checked":
        """Itself, or ValueError if more than the share ``allowed`` of all rows was rejected."""
        n = self.n_good + self.n_rejected
        if self.n_rejected > allowed * n:
            worst = self.rejected.groupBy("column", "reason").count().orderBy(F.desc("count"), "column", "reason").limit(10).collect()
            reasons = "; ".join(f"{r['column'] or 'line'}: {r['reason']} ({r['count']})" for r in worst)
            raise ValueError(f"{self.name}: {self.n_rejected} of {n} rows rejected, more than the allowed share {allowed:g}: {reasons}")
        return self


def field(raw: Column, f: StructField) -> tuple[Column, Column]:
    """A text as the field's type, null if it can't be, and why not (null if it can).

    Dates are strict, year-month-day in ten characters. Whole numbers may be
    written with a fraction of zeros. A null is a fault only in a field that
    isn't nullable.
    """
    if isinstance(f.dataType, StringType):
        value, reason = raw, F.lit(None).cast("string")
    elif isinstance(f.dataType, IntegralType):
        number = raw.try_cast("decimal(38,6)")
        value = F.when(number % 1 == 0, number.try_cast(f.dataType))
        reason = (F.when(number.isNull(), "no number").when(number % 1 != 0, "no whole number")
                  .when(value.isNull(), "out of range"))
    elif isinstance(f.dataType, DateType):
        value = F.when(raw.rlike(STRICT_DATE), raw.try_cast("date"))
        reason = F.when(value.isNull(), "no date")
    else:
        value = raw.try_cast(f.dataType)
        reason = F.when(value.isNull(), f"no {f.dataType.simpleString()}")
    absent = F.lit(None).cast("string") if f.nullable else F.lit("missing")
    return value, F.when(raw.isNull(), absent).otherwise(reason)


def check(raw: DataFrame, schema: StructType | None, name: str, file: Column, corrupt: Column | None = None) -> Checked:
    """Write the rows of ``raw``, all strings, typed by ``schema``, good and rejected ones apart.

    Columns are matched by name as in ``files.read_table``: absent ones become
    typed nulls (a fault if required), others follow as text. ``corrupt`` holds
    the text of a line whose fields couldn't be told apart. ``line`` of other
    rejected rows is their fields written as CSV again.
    """
    spark = raw.sparkSession
    present = {c.lower(): c for c in raw.columns}
    if clash := {FILE, LINE, FAULTS, GOOD} & set(present):
        raise ValueError(f"{name}: columns {sorted(clash)} are names of the reject channel")
    fields = list(schema.fields) if schema else []
    known = {f.name.lower() for f in fields}
    extra = [c for c in raw.columns if c.lower() not in known and c != CORRUPT]
    values, faults = [], []
    for f in fields:
        text = F.col(f"`{present[f.name.lower()]}`") if f.name.lower() in present else F.lit(None).cast("string")
        value, reason = field(text, f)
        values.append(value.alias(f.name))
        faults.append(F.when(reason.isNotNull(), F.struct(F.lit(f.name).alias("column"), text.alias("value"), reason.alias("reason"))))
    malformed = F.lit(False) if corrupt is None else corrupt.isNotNull()
    none = F.lit(None).cast("string")
    whole = F.array(F.struct(none.alias("column"), none.alias("value"), F.lit("malformed line").alias("reason")))
    found = F.when(malformed, whole).otherwise(F.array_compact(F.array(*faults)) if faults else F.filter(whole, lambda _: F.lit(False)))
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in raw.columns if c != CORRUPT]))
    line = line if corrupt is None else F.coalesce(corrupt, line)
    good = F.size(FAULTS) == 0
    out = (raw.select(*values, *[F.col(f"`{c}`") for c in extra], file.alias(FILE), line.alias(LINE), found.alias(FAULTS))
           .withColumn(GOOD, good).withColumn(LINE, F.when(~good, F.col(LINE))).withColumn(FILE, F.when(~good, F.col(FILE)))
           .withColumn(FAULTS, F.when(~good, F.col(FAULTS))))
    path = scratch_path(spark, f"checked-{name}-{uuid.uuid4().hex}")
    out.write.partitionBy(GOOD).parquet(path)
    stored = StructType([*[f for f in out.schema.fields if f.name != GOOD], StructField(GOOD, BooleanType())])
    both = spark.read.schema(stored).parquet(path)
    counts = {r[GOOD]: r["count"] for r in both.groupBy(GOOD).count().collect()}
    rejected = (both.where(~F.col(GOOD)).select(FILE, LINE, F.explode(FAULTS).alias("fault"))
                .select(F.lit(name).alias("table_name"), F.col(FILE).alias("file"), F.col(LINE).alias("line"), "fault.*"))
    return Checked(name, both.where(F.col(GOOD)).drop(GOOD, FILE, LINE, FAULTS), rejected, counts.get(True, 0), counts.get(False, 0))


def read_checked(spark: SparkSession, path: str, name: str, schema: StructType | None = None, header: bool = True) -> Checked:
    """A CSV table with its reject channel; ``schema`` defaults to that of the OMOP table ``name``.

    Without a header the columns are those of ``schema``, in its order.
    """
    schema = schema or schemas.OMOP_SCHEMAS.get(name)
    names = spark.read.option("header", True).csv(path).columns if header else schema.fieldNames()
    text = StructType([StructField(c, StringType()) for c in [*names, CORRUPT]])
    raw = (spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))
    return check(raw, schema, name, F.col("_metadata.file_path"), F.col(CORRUPT))
