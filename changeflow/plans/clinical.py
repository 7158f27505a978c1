"""The three hospital entities and three reports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame

from changeflow.functions import elapsed_hours, flag_equals, in_order, matches, not_null, one_of
from changeflow.operators import (
    daily_admissions,
    diagnosis_distribution,
    drop_deletes,
    drop_rescued,
    expect,
    expect_or_drop,
    facility_summary,
    keep_active,
)
from changeflow.plans.specs import ReportSpec, TableSpec

# Results depend on them. So do, below, the names of datasets, rules and columns,
# the keys, the sequence columns and the layouts.
ICD10_PATTERN = r"^[A-Z][0-9]{2}(\.[0-9A-Z]{1,4})?$"
PROCEDURE_STATUSES = ("COMPLETED", "SCHEDULED", "CANCELLED")
EMERGENCY = "EMERGENCY"


def clean_encounters(changes: DataFrame) -> DataFrame:
    stay = elapsed_hours("admit_date", "discharge_date")
    kept = drop_rescued(drop_deletes(changes))
    return kept.withColumns(
        {"length_of_stay_hours": stay, "is_emergency": flag_equals("encounter_type", EMERGENCY)}
    )


def clean_diagnoses(changes: DataFrame) -> DataFrame:
    return drop_rescued(keep_active(drop_deletes(changes)))


def clean_procedures(changes: DataFrame) -> DataFrame:
    return drop_rescued(drop_deletes(changes))


ENCOUNTERS = TableSpec(
    name="encounters",
    keys=("encounter_id",),
    sequence_by="cdc_timestamp",
    clean=clean_encounters,
    rules=(
        expect_or_drop("valid_encounter_id", not_null("encounter_id")),
        expect_or_drop("valid_patient_id", not_null("patient_id")),
        expect_or_drop("valid_admit_date", not_null("admit_date")),
        expect("valid_discharge_order", in_order("admit_date", "discharge_date")),
    ),
    raw_layout=("admit_date",),
    layout=("facility_code", "admit_date"),
    comments={
        "bronze": "Encounter changes as they arrived",
        "silver": "Encounter changes that passed the checks, with length of stay",
        "gold": "Encounters, latest row per encounter_id",
    },
)

DIAGNOSES = TableSpec(
    name="diagnoses",
    keys=("diagnosis_id",),
    sequence_by="cdc_timestamp",
    clean=clean_diagnoses,
    rules=(
        expect_or_drop("valid_diagnosis_id", not_null("diagnosis_id")),
        expect_or_drop("valid_encounter_id", not_null("encounter_id")),
        expect("valid_icd10_format", matches("diagnosis_code", ICD10_PATTERN)),
    ),
    raw_layout=("cdc_timestamp",),
    layout=("diagnosis_code",),
    comments={
        "bronze": "Diagnosis changes as they arrived",
        "silver": "Active diagnosis changes that passed the checks",
        "gold": "Diagnoses, latest row per diagnosis_id",
    },
)

PROCEDURES = TableSpec(
    name="procedures",
    keys=("procedure_id",),
    sequence_by="cdc_timestamp",
    clean=clean_procedures,
    rules=(
        expect_or_drop("valid_procedure_id", not_null("procedure_id")),
        expect_or_drop("valid_encounter_id", not_null("encounter_id")),
        expect("valid_status", one_of("procedure_status", PROCEDURE_STATUSES)),
    ),
    raw_layout=("procedure_date",),
    layout=("procedure_code", "procedure_date"),
    comments={
        "bronze": "Procedure changes as they arrived",
        "silver": "Procedure changes that passed the checks",
        "gold": "Procedures, latest row per procedure_id",
    },
)

TABLES = (ENCOUNTERS, DIAGNOSES, PROCEDURES)

REPORTS = (
    ReportSpec(
        name="gold_facility_summary",
        build=lambda tables: facility_summary(tables["encounters"]),
        layout=("facility_code",),
        comment="For each facility and encounter type: stays, patients, emergencies, first and last admission",
        uses={
            "encounters": (
                "facility_code", "encounter_type", "length_of_stay_hours", "patient_id", "is_emergency", "admit_date",
            )
        },
    ),
    ReportSpec(
        name="gold_diagnosis_distribution",
        build=lambda tables: diagnosis_distribution(tables["diagnoses"], tables["encounters"]),
        layout=("facility_code", "diagnosis_code"),
        comment="How often surviving diagnoses name a code, in how many encounters and patients of a facility",
        uses={
            "encounters": ("encounter_id", "facility_code", "encounter_type"),
            "diagnoses": ("encounter_id", "patient_id", "diagnosis_code", "code_system"),
        },
    ),
    ReportSpec(
        name="gold_daily_admissions",
        build=lambda tables: daily_admissions(tables["encounters"]),
        layout=("facility_code", "admit_date_day"),
        comment="Admissions that passed the checks, for each facility and UTC day",
        uses={"encounters": ("facility_code", "admit_date", "is_emergency", "encounter_type", "length_of_stay_hours")},
    ),
)


def with_tie_breaks(specs: tuple[TableSpec, ...], columns: dict[str, tuple[str, ...]]) -> tuple[TableSpec, ...]:
    """The same entities with the order of rows of equal sequence given by name."""
    return tuple(replace(spec, tie_break=columns.get(spec.name, spec.tie_break)) for spec in specs)
