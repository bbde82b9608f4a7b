"""Column expressions (all JVM-side, codegen-friendly)."""

from tabml.functions.expressions import (
    hash_bucket,
    is_missing,
    numeric_fields,
    round_half_up,
    split_label,
)

__all__ = ["hash_bucket", "is_missing", "numeric_fields", "round_half_up", "split_label"]
