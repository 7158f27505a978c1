from changeflow.plans.layers import Layers, checked, current, with_deletes
from changeflow.plans.spec_table import SpecError, check_specs, load_specs
from changeflow.plans.specs import ReportSpec, TableSpec

__all__ = ["Layers", "ReportSpec", "SpecError", "TableSpec", "check_specs", "checked", "current", "load_specs", "with_deletes"]
