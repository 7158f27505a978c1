"""The registered queries again, as plain SQL over the given tables."""

from __future__ import annotations

_FEEDS = {
    "encounters": """
        select cast(case when l_partkey % 101 = 0 then null else l_orderkey end as varchar) as encounter_id,
          cast(case when l_partkey % 97 = 0 then null else o_custkey end as varchar) as patient_id,
          case o_orderpriority when '1-URGENT' then 'EMERGENCY' when '2-HIGH' then 'INPATIENT'
            when '3-MEDIUM' then 'OUTPATIENT' when '4-NOT SPECIFIED' then 'OBSERVATION'
            else 'TELEHEALTH' end as encounter_type,
          c_nationkey as facility_code,
          case when l_partkey % 89 = 0 then null else o_orderdate end as admit_date,
          case when l_linestatus = 'F' then l_shipdate end as discharge_date,
          case l_returnflag when 'N' then 'I' when 'A' then 'U' else 'D' end as cdc_operation,
          l_shipdate as cdc_timestamp,
          l_linenumber as s2, l_partkey as s3, l_suppkey as s4, l_extendedprice as s5
        from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey""",
    "diagnoses": """
        select cast(l_orderkey * 8 + l_linenumber as varchar) as diagnosis_id,
          cast(case when l_partkey % 101 = 0 then null else l_orderkey end as varchar) as encounter_id,
          cast(l_suppkey as varchar) as patient_id,
          concat(case when l_partkey % 10 = 0 then 'x' else chr(cast(65 + l_partkey % 26 as int)) end,
            lpad(cast(l_partkey % 100 as varchar), 2, '0'),
            case when l_partkey % 3 = 0 then '' else concat('.', cast(l_partkey % 7 as varchar)) end)
            as diagnosis_code,
          case when l_tax > 0.04 then 'ICD-10-CM' else 'ICD-10-PCS' end as code_system,
          l_quantity > 12 as is_active,
          case l_returnflag when 'N' then 'I' when 'A' then 'U' else 'D' end as cdc_operation,
          l_shipdate as cdc_timestamp, l_partkey as s3, l_suppkey as s4, l_extendedprice as s5
        from lineitem""",
    "procedures": """
        select cast(user_id * 10 + length(event_type) as varchar) as procedure_id,
          cast(user_id as varchar) as encounter_id,
          event_type as procedure_code, ts as procedure_date,
          case event_type when 'purchase' then 'COMPLETED' when 'click' then 'SCHEDULED'
            when 'view' then 'CANCELLED' when 'signup' then 'REQUESTED' else 'UNKNOWN' end
            as procedure_status,
          case when event_type = 'error' then 'D' when event_id % 3 = 0 then 'U' else 'I' end
            as cdc_operation,
          ts as cdc_timestamp, event_id as s3
        from events""",
}

_CLEAN = {
    "encounters": """
        select *, case when discharge_date is not null then
            round(date_diff('second', admit_date, discharge_date) / 3600.0::double, 1) end
            as length_of_stay_hours,
          encounter_type = 'EMERGENCY' as is_emergency
        from feed where cdc_operation <> 'D'""",
    "diagnoses": "select * from feed where cdc_operation <> 'D' and is_active",
    "procedures": "select * from feed where cdc_operation <> 'D'",
}

# Names of datasets and rules, predicates, and the columns of the reports below.
_RULES = {
    "encounters": (
        ("valid_encounter_id", "drop", "encounter_id is not null"),
        ("valid_patient_id", "drop", "patient_id is not null"),
        ("valid_admit_date", "drop", "admit_date is not null"),
        ("valid_discharge_order", "warn", "discharge_date is null or discharge_date >= admit_date"),
    ),
    "diagnoses": (
        ("valid_diagnosis_id", "drop", "diagnosis_id is not null"),
        ("valid_encounter_id", "drop", "encounter_id is not null"),
        (
            "valid_icd10_format",
            "warn",
            r"regexp_matches(diagnosis_code, '^[A-Z][0-9]{2}(\.[0-9A-Z]{1,4})?$')",
        ),
    ),
    "procedures": (
        ("valid_procedure_id", "drop", "procedure_id is not null"),
        ("valid_encounter_id", "drop", "encounter_id is not null"),
        ("valid_status", "warn", "procedure_status in ('COMPLETED', 'SCHEDULED', 'CANCELLED')"),
    ),
}

_ORDER = {
    "encounters": ("encounter_id", "cdc_timestamp desc, s2 desc, s3 desc, s4 desc, s5 desc"),
    "diagnoses": ("diagnosis_id", "cdc_timestamp desc, s3 desc, s4 desc, s5 desc"),
    "procedures": ("procedure_id", "cdc_timestamp desc, s3 desc"),
}


def feed(entity: str) -> str:
    return _FEEDS[entity]


def clean(entity: str) -> str:
    return f"with feed as ({_FEEDS[entity]}) {_CLEAN[entity]}"


def silver(entity: str) -> str:
    kept = " and ".join(f"({p})" for _, action, p in _RULES[entity] if action == "drop")
    return f"select * from ({clean(entity)}) where {kept}"


def current(entity: str) -> str:
    key, order = _ORDER[entity]
    return f"""select * exclude (pos) from (
        select *, row_number() over (partition by {key} order by {order}) as pos
        from ({silver(entity)})) where pos = 1"""


def _changes_with_deletes(entity: str) -> str:
    """Checked changes and keyed deletes; a delete comes after other changes of equal rank."""
    key, _ = _ORDER[entity]
    return f"""select *, false as gone from ({silver(entity)})
        union all by name
        select *, true as gone from ({feed(entity)}) where cdc_operation = 'D' and {key} is not null"""


def current_with_deletes(entity: str) -> str:
    key, order = _ORDER[entity]
    return f"""select * exclude (pos, gone) from (
        select *, row_number() over (partition by {key} order by {order}, gone desc) as pos
        from ({_changes_with_deletes(entity)})) where pos = 1 and not gone"""


def history(entity: str) -> str:
    key, order = _ORDER[entity]
    return f"""select * exclude (pos, gone), cdc_timestamp as valid_from, valid_to is null as is_current from (
        select *, lead(cdc_timestamp) over (partition by {key} order by cdc_timestamp) as valid_to from (
          select *, row_number() over (partition by {key}, cdc_timestamp order by {order}, gone desc) as pos
          from ({_changes_with_deletes(entity)})) where pos = 1) where not gone"""


def _gated(cuts: tuple[str, ...], predicate: str) -> str:
    """Checked encounters with the number of their delivery and whether it has a row that fails."""
    number = " + ".join(f"cast(cdc_timestamp >= timestamp '{cut}' as int)" for cut in cuts)
    return f"""select *, bool_or(not coalesce({predicate}, false)) over (partition by delivery) as refused
        from (select *, {number} as delivery from ({clean('encounters')}))"""


def gated_silver(cuts: tuple[str, ...], predicate: str) -> str:
    kept = " and ".join(f"({p})" for _, action, p in _RULES["encounters"] if action == "drop")
    return f"select * exclude (refused) from ({_gated(cuts, predicate)}) where not refused and {kept}"


def gated_refused(cuts: tuple[str, ...], rule: str, predicate: str) -> str:
    return f"""select * exclude (refused), '{rule}' as failed_rules from ({_gated(cuts, predicate)})
        where refused and not coalesce({predicate}, false)"""


def quality(entity: str) -> str:
    parts = [
        f"""select 'silver_{entity}' as dataset, '{name}' as "rule", '{action}' as "action",
            count(*) as total_rows, count(*) filter (where coalesce({p}, false)) as passed_rows,
            count(*) filter (where not coalesce({p}, false)) as failed_rows,
            count(*) filter (where not coalesce({p}, false)) * 100.0::double / count(*) as failed_pct
            from clean"""
        for name, action, p in _RULES[entity]
    ]
    return f"with clean as ({clean(entity)}) " + " union all ".join(parts)


def facility_summary() -> str:
    return f"""select facility_code, encounter_type, count(*) as total_encounters,
          avg(length_of_stay_hours) as avg_length_of_stay_hours,
          count(distinct patient_id) as unique_patients,
          cast(sum(case when is_emergency then 1 else 0 end) as bigint) as emergency_count,
          min(admit_date) as earliest_admit, max(admit_date) as latest_admit
        from ({current('encounters')}) group by facility_code, encounter_type"""


def diagnoses_with_facility() -> str:
    return f"""select d.*, e.facility_code, e.encounter_type
        from ({current('diagnoses')}) d join ({current('encounters')}) e
        on d.encounter_id = e.encounter_id"""


def diagnosis_distribution() -> str:
    return f"""select facility_code, diagnosis_code, code_system, count(*) as diagnosis_count,
          count(distinct encounter_id) as encounter_count, count(distinct patient_id) as patient_count
        from ({diagnoses_with_facility()}) group by facility_code, diagnosis_code, code_system"""


def top_codes(n: int) -> str:
    return f"""select * exclude (pos), cast(pos as int) as "rank" from (
        select *, row_number() over (partition by facility_code order by diagnosis_count desc, diagnosis_code, code_system) as pos
        from ({diagnosis_distribution()})) where pos <= {n}"""


def daily_admissions() -> str:
    return f"""select facility_code, cast(cast(admit_date as date) as timestamp) as admit_date_day,
          count(*) as total_admissions,
          cast(sum(case when is_emergency then 1 else 0 end) as bigint) as emergency_admissions,
          cast(sum(case when encounter_type = 'INPATIENT' then 1 else 0 end) as bigint)
            as inpatient_admissions,
          cast(sum(case when encounter_type = 'OUTPATIENT' then 1 else 0 end) as bigint)
            as outpatient_admissions,
          avg(length_of_stay_hours) as avg_length_of_stay_hours
        from ({current('encounters')}) group by facility_code, cast(admit_date as date)"""


def bronze(entity: str, folder: str) -> str:
    return f"""select *, {folder} as source_folder, true as ingest_time_set
        from ({feed(entity)})"""


def rescued_types() -> str:
    """Whole numbers stay; texts that are none and numbers with a fraction are kept as JSON."""
    return f"""select * replace (case when s3 % 3 = 1 and s3 % 7 = 0 or s3 % 3 = 2 and s3 % 5 = 0 then null
            else cast(s3 as varchar) end as s3), 'bigint' as s3_type,
          case when s3 % 3 = 1 then 'text' end as origin,
          case when s3 % 3 = 1 and s3 % 7 = 0 then concat('{{"s3":"n/a ', s3, '"}}')
            when s3 % 3 = 2 and s3 % 5 = 0 then concat('{{"s3":', s3, '.5}}') end as _rescued_data,
          case s3 % 3 when 0 then 'whole' when 1 then 'text' else 'fraction' end as source_folder
        from ({feed('procedures')})"""


def row_counts() -> str:
    counted = {}
    for entity in _FEEDS:
        counted[f"bronze_{entity}"] = feed(entity)
        counted[f"silver_{entity}"] = silver(entity)
        counted[f"gold_{entity}_current"] = current(entity)
    counted["gold_facility_summary"] = facility_summary()
    counted["gold_diagnosis_distribution"] = diagnosis_distribution()
    counted["gold_daily_admissions"] = daily_admissions()
    return " union all ".join(
        f"select '{name}' as dataset, count(*) as row_count from ({sql})" for name, sql in counted.items()
    )


def comments(told: dict[str, str]) -> str:
    known = ", ".join(f"('{name}', '{text}')" for name, text in told.items())
    return f"""select dataset, table_comment, row_count from ({row_counts()})
        join (values {known}) as told(dataset, table_comment) using (dataset)"""


def evolving() -> str:
    """Ties in time go to the greater values, column by column in the order of names."""
    ties = (
        "admit_date, cdc_operation, discharge_date, encounter_type, facility_code, is_emergency,"
        " length_of_stay_hours, patient_id, s5"
    )
    order = ", ".join(f"{name.strip()} desc nulls last" for name in ("cdc_timestamp, " + ties).split(","))
    return f"""select * exclude (pos), cast(2 as bigint) as orders from (
        select *, row_number() over (partition by encounter_id order by {order}) as pos
        from (select * exclude (s3, s4) replace (0 as s2) from ({silver('encounters')}))) where pos = 1"""
