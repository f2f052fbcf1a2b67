"""DataFrame operators: validation, dedupe, loads, SCD2, checks, run log, clones."""
