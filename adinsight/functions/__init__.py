"""Column expressions shared by the operators (all built-in functions)."""

from adinsight.functions.columns import (
    id_list,
    missing_to_null,
    size_label,
    day_of_week,
)

__all__ = [
    "id_list",
    "missing_to_null",
    "size_label",
    "day_of_week",
]
