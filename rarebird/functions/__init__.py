"""Column expressions used across the library (all JVM-side, codegen friendly)."""

from rarebird.functions.columns import (
    MOMENT_FORMAT,
    as_array,
    membership_flag,
    run_moment,
    vector_text,
)

__all__ = ["MOMENT_FORMAT", "as_array", "membership_flag", "run_moment", "vector_text"]
