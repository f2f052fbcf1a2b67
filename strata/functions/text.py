"""Text standardisation: trim + case rules + renames, as one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RULES = {
    "trim": lambda c: F.trim(c),
    "initcap": lambda c: F.initcap(F.trim(c)),
    "lower": lambda c: F.lower(F.trim(c)),
    "upper": lambda c: F.upper(F.trim(c)),
    "keep": lambda c: c,
}


def standardize(col: str | Column, rule: str) -> Column:
    """Apply one named rule (trim / initcap / lower / upper / keep) to a column."""
    try:
        fn = _RULES[rule]
    except KeyError:
        raise ValueError(f"unknown standardisation rule {rule!r}; expected one of {sorted(_RULES)}") from None
    return fn(F.col(col) if isinstance(col, str) else col)


def clean_columns(
    df: DataFrame,
    spec: Sequence[tuple[str, str] | tuple[str, str, str]],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Project ``df`` to the columns named in ``spec`` (in order), then ``keep``.

    Each spec entry is ``(source_column, rule)`` or ``(source_column, rule,
    output_name)``. Everything happens in one ``select`` so Catalyst prunes the
    scan to exactly these columns.
    """
    out: list[Column] = []
    for entry in spec:
        src, rule = entry[0], entry[1]
        name = entry[2] if len(entry) > 2 else src
        out.append(standardize(src, rule).alias(name))
    out.extend(F.col(k) for k in keep)
    return df.select(*out)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns (missing names are an error, unlike ``withColumnsRenamed``)."""
    missing = [k for k in mapping if k not in df.columns]
    if missing:
        raise ValueError(f"cannot rename missing columns {missing}")
    return df.withColumnsRenamed(dict(mapping))
