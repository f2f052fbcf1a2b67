"""The concrete five-zone medallion job built from ``strata.operators``."""
