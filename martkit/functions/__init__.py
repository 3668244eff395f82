from martkit.functions.digests import CHECKSUM, canonical, checksum, checksum_dict, checksum_metrics, row_digest
from martkit.functions.expressions import (
    bool_default,
    category_string,
    clamp,
    clamp_iqr,
    contained,
    floor_rule_independent,
    floor_rule_joint,
    iqr_fences,
    is_finite,
    is_integral,
    nan_to_null,
    not_null_positive,
    pct,
    try_double,
)

__all__ = [
    "CHECKSUM",
    "bool_default",
    "canonical",
    "category_string",
    "checksum",
    "checksum_dict",
    "checksum_metrics",
    "clamp",
    "clamp_iqr",
    "contained",
    "floor_rule_independent",
    "floor_rule_joint",
    "iqr_fences",
    "is_finite",
    "is_integral",
    "nan_to_null",
    "not_null_positive",
    "pct",
    "row_digest",
    "try_double",
]
