"""Fixed schemas of the OMOP tables and side files (no inference at read)."""

from __future__ import annotations

from pyspark.sql.types import (DateType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


PERSON = _s(("person_id", LongType()), ("gender_concept_id", IntegerType()), ("year_of_birth", IntegerType()),
            ("month_of_birth", IntegerType()), ("day_of_birth", IntegerType()), ("race_concept_id", IntegerType()))
VISIT_OCCURRENCE = _s(("visit_occurrence_id", LongType()), ("person_id", LongType()),
                      ("visit_start_date", DateType()))
DEATH = _s(("person_id", LongType()), ("death_date", DateType()), ("death_datetime", TimestampType()))
CONDITION_OCCURRENCE = _s(("person_id", LongType()), ("visit_occurrence_id", LongType()),
                          ("condition_concept_id", LongType()), ("condition_source_concept_id", LongType()),
                          ("condition_source_value", StringType()), ("condition_start_date", DateType()))
DRUG_EXPOSURE = _s(("person_id", LongType()), ("visit_occurrence_id", LongType()),
                   ("drug_concept_id", LongType()), ("drug_exposure_start_date", DateType()))
PROCEDURE_OCCURRENCE = _s(("person_id", LongType()), ("visit_occurrence_id", LongType()),
                          ("procedure_concept_id", LongType()), ("procedure_date", DateType()))
MEASUREMENT = _s(("person_id", LongType()), ("measurement_date", DateType()))
OBSERVATION = _s(("person_id", LongType()), ("observation_date", DateType()))
OBSERVATION_PERIOD = _s(("person_id", LongType()), ("observation_period_start_date", DateType()))
CONCEPT = _s(("concept_id", LongType()), ("concept_name", StringType()))
CODE_DESCRIPTION = _s(("code", StringType()), ("description", StringType()))

# Partition column of a stored layout: the year of a table's date (see sources.store).
STORED_YEAR = "stored_year"

# The code dictionary file has no header; the column order is fixed.
ICDCODE_CONVERTER = StructType([
    StructField("conversion_id", IntegerType(), False),
    StructField("icd10", StringType(), True),
    StructField("convertion_type", IntegerType(), False),
    StructField("icd9", StringType(), True),
])

OMOP_SCHEMAS = {
    "person": PERSON,
    "visit_occurrence": VISIT_OCCURRENCE,
    "death": DEATH,
    "condition_occurrence": CONDITION_OCCURRENCE,
    "drug_exposure": DRUG_EXPOSURE,
    "procedure_occurrence": PROCEDURE_OCCURRENCE,
    "measurement": MEASUREMENT,
    "observation": OBSERVATION,
    "observation_period": OBSERVATION_PERIOD,
    "concept": CONCEPT,
    "code_description": CODE_DESCRIPTION,
}
