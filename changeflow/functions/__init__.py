from changeflow.functions.columns import count_where, day_bucket, elapsed_hours, flag_equals
from changeflow.functions.predicates import in_order, matches, not_null, one_of

__all__ = [
    "count_where",
    "day_bucket",
    "elapsed_hours",
    "flag_equals",
    "in_order",
    "matches",
    "not_null",
    "one_of",
]
