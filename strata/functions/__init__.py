"""Column-level helpers (built-in Spark functions only, no Python UDFs)."""

from strata.functions.keys import row_hash, surrogate_key
from strata.functions.metrics import safe_divide, tier
from strata.functions.text import clean_columns, standardize

__all__ = ["clean_columns", "row_hash", "safe_divide", "standardize", "surrogate_key", "tier"]
