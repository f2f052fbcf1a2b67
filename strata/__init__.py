"""strata: medallion-style data pipelines on Spark DataFrames.

Reusable DataFrame operators (validation with reject capture, latest-per-key
deduplication, standardisation, surrogate keys, incremental loads, type-2
history, data-quality checks, run log, table clones) and the concrete
five-zone job built from them (``strata.plans``).
"""

__version__ = "0.1.0"
