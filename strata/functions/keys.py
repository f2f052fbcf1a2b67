"""Hash keys built from columns.

``surrogate_key`` is an md5 over the text form of each column joined by
``-``; a NULL becomes a fixed marker so that (NULL, 'a') and ('a', NULL)
differ and a NULL never silently vanishes (``concat_ws`` skips NULLs).
Floating-point columns are refused: their text form differs between engines
and ``-0.0``/``0.0`` hash differently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: text that stands for NULL inside a surrogate key.
NULL_MARKER = "_strata_null_"


def _as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column, df: DataFrame | None = None) -> Column:
    """md5 hex of ``coalesce(cast(c as string), marker)`` joined by ``-``.

    Pass ``df`` to have floating-point columns rejected up front.
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    if df is not None:
        types = {f.name: f.dataType for f in df.schema.fields}
        bad = [c for c in cols if isinstance(c, str) and isinstance(types.get(c), (T.FloatType, T.DoubleType))]
        if bad:
            raise TypeError(f"surrogate_key refuses floating-point columns: {bad}")
    parts = [F.coalesce(_as_column(c).cast("string"), F.lit(NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def row_hash(*cols: str | Column) -> Column:
    """64-bit hash of a column list, for change detection (not a key).

    ``xxhash64`` skips NULLs, so each column is hashed with its NULL flag: ('x', NULL)
    and (NULL, 'x') differ.
    """
    if not cols:
        raise ValueError("row_hash needs at least one column")
    return F.xxhash64(*[x for c in map(_as_column, cols) for x in (c, c.isNull())])
