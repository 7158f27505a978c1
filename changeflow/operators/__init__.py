from changeflow.operators.clean import drop_deletes, drop_rescued, keep_active
from changeflow.operators.current import CurrentTable
from changeflow.operators.history import HistoryTable, with_next
from changeflow.operators.latest import latest_by_key
from changeflow.operators.layout import cluster_by_curve, cluster_globally, cluster_within, file_skips, key_ranges, write_clustered
from changeflow.operators.quality import (
    BatchRefused,
    Rule,
    apply_rules,
    expect,
    expect_or_drop,
    expect_or_fail,
    observe_rules,
    quality_history,
    quality_report,
    refused_rows,
)
from changeflow.operators.reports import (
    daily_admissions,
    diagnoses_with_facility,
    diagnosis_distribution,
    facility_summary,
    top_codes,
    top_per_group,
)

__all__ = [
    "BatchRefused",
    "CurrentTable",
    "HistoryTable",
    "Rule",
    "apply_rules",
    "cluster_by_curve",
    "cluster_globally",
    "cluster_within",
    "daily_admissions",
    "diagnoses_with_facility",
    "diagnosis_distribution",
    "drop_deletes",
    "drop_rescued",
    "expect",
    "expect_or_drop",
    "expect_or_fail",
    "facility_summary",
    "file_skips",
    "keep_active",
    "key_ranges",
    "latest_by_key",
    "observe_rules",
    "quality_history",
    "quality_report",
    "refused_rows",
    "top_codes",
    "top_per_group",
    "with_next",
    "write_clustered",
]
