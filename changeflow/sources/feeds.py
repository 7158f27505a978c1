"""Change feeds for the three hospital entities, derived from order and event tables.

Pure functions of the tables. They have what change data has: repeated keys, deletes, late
and tied changes, NULL keys, malformed codes, and stays that end before they begin.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Tables = Callable[[str], DataFrame]

# What orders changes of equal time stamp, per feed.
TIE_BREAKS = {
    "encounters": ("s2", "s3", "s4", "s5"),
    "diagnoses": ("s3", "s4", "s5"),
    "procedures": ("s3",),
}


def tables_in(spark: SparkSession, folder: str) -> Tables:
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")


def _recode(column: str, codes: dict[str, str], other: str) -> Column:
    value = F.lit(other)
    for source, target in reversed(codes.items()):
        value = F.when(F.col(column) == source, target).otherwise(value)
    return value


def _null_if_divides(divisor: int, column: str) -> Column:
    return F.when(F.col("l_partkey") % divisor != 0, F.col(column))


def _id(value: Column) -> Column:
    return value.cast("string")


_OPERATION = {"N": "I", "A": "U"}


def encounters_feed(tables: Tables) -> DataFrame:
    """One encounter per order; each of its line items is a change to it."""
    # Orders get their customer first: line items, the most rows, are then shuffled once and not twice.
    places = tables("orders").join(tables("customer"), F.col("o_custkey") == F.col("c_custkey"))
    changes = tables("lineitem").join(places, F.col("l_orderkey") == F.col("o_orderkey"))
    types = {
        "1-URGENT": "EMERGENCY",
        "2-HIGH": "INPATIENT",
        "3-MEDIUM": "OUTPATIENT",
        "4-NOT SPECIFIED": "OBSERVATION",
    }
    return changes.select(
        _id(_null_if_divides(101, "l_orderkey")).alias("encounter_id"),
        _id(_null_if_divides(97, "o_custkey")).alias("patient_id"),
        _recode("o_orderpriority", types, "TELEHEALTH").alias("encounter_type"),
        F.col("c_nationkey").alias("facility_code"),
        _null_if_divides(89, "o_orderdate").alias("admit_date"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("discharge_date"),
        _recode("l_returnflag", _OPERATION, "D").alias("cdc_operation"),
        F.col("l_shipdate").alias("cdc_timestamp"),
        F.col("l_linenumber").alias("s2"),
        F.col("l_partkey").alias("s3"),
        F.col("l_suppkey").alias("s4"),
        F.col("l_extendedprice").alias("s5"),
    )


def diagnoses_feed(tables: Tables) -> DataFrame:
    """One diagnosis per order and line number; about one code in ten is malformed."""
    part = F.col("l_partkey")
    # chr of 65 to 90, the letters A to Z
    letter = F.when(part % 10 == 0, "x").otherwise(F.chr(65 + part % 26))
    tail = F.when(part % 3 == 0, "").otherwise(F.concat(F.lit("."), (part % 7).cast("string")))
    return tables("lineitem").select(
        _id(F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("diagnosis_id"),
        _id(_null_if_divides(101, "l_orderkey")).alias("encounter_id"),
        _id(F.col("l_suppkey")).alias("patient_id"),
        F.concat(letter, F.lpad((part % 100).cast("string"), 2, "0"), tail).alias("diagnosis_code"),
        F.when(F.col("l_tax") > 0.04, "ICD-10-CM").otherwise("ICD-10-PCS").alias("code_system"),
        (F.col("l_quantity") > 12).alias("is_active"),
        _recode("l_returnflag", _OPERATION, "D").alias("cdc_operation"),
        F.col("l_shipdate").alias("cdc_timestamp"),
        part.alias("s3"),
        F.col("l_suppkey").alias("s4"),
        F.col("l_extendedprice").alias("s5"),
    )


def procedures_feed(tables: Tables) -> DataFrame:
    """One procedure per user and length of event type; an error deletes the click's row."""
    statuses = {"purchase": "COMPLETED", "click": "SCHEDULED", "view": "CANCELLED", "signup": "REQUESTED"}
    operation = F.when(F.col("event_type") == "error", "D").when(F.col("event_id") % 3 == 0, "U").otherwise("I")
    return tables("events").select(
        _id(F.col("user_id") * 10 + F.length("event_type")).alias("procedure_id"),
        _id(F.col("user_id")).alias("encounter_id"),
        F.col("event_type").alias("procedure_code"),
        F.col("ts").alias("procedure_date"),
        _recode("event_type", statuses, "UNKNOWN").alias("procedure_status"),
        operation.alias("cdc_operation"),
        F.col("ts").alias("cdc_timestamp"),
        F.col("event_id").alias("s3"),
    )


FEEDS = {
    "encounters": encounters_feed,
    "diagnoses": diagnoses_feed,
    "procedures": procedures_feed,
}
