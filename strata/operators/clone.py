"""CI table clones: sampled or slim copies of zone tables, PII masking, teardown.

One independent sample-and-write job per table (Bernoulli sampling is a
per-partition filter: no shuffle), or one linked sample by key, in which every row
finds the rows it refers to. ``pct = 0`` means a full copy.
Masking is driven by each table's ``_sensitivity_tag`` column or an explicit
rule map and uses built-in functions only.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.tables import drop_path, materialize, write_table

MASK_RULES = ("hash", "redact_email", "null", "keep_last4")
# what a clone masks where the caller gives no masks: personal columns by name
PERSONAL_MASKS = {
    "email": "redact_email", "phone": "keep_last4", "first_name": "hash", "last_name": "hash",
    **{c: "hash" for c in ("address", "shipping_address", "billing_address", "city", "postal_code", "zip_code")},
}

# what may be created or dropped: one name, no path
_CI_SCHEMA = re.compile(r"(?:PR|CI)_[A-Za-z0-9_]+", re.IGNORECASE)


def mask_expr(col: str, rule: str) -> Column:
    c = F.col(col)
    if rule == "hash":
        return F.sha2(c.cast("string"), 256)
    if rule == "redact_email":
        # keep the domain, replace the local part
        return F.regexp_replace(c, r"^[^@]*", "***")
    if rule == "null":
        return F.lit(None)
    if rule == "keep_last4":
        return F.concat(F.lit("***"), F.substring(c.cast("string"), -4, 4))
    raise ValueError(f"unknown mask rule {rule!r}; expected one of {MASK_RULES}")


def mask_columns(df: DataFrame, rules: Mapping[str, str], only_tag: str | None = "pii", unless_tag: str | None = None) -> DataFrame:
    """Mask ``rules`` columns; with ``only_tag`` only rows tagged that sensitivity, with ``unless_tag`` all but these (untagged rows are masked)."""
    types = dict(df.dtypes)
    out = {}
    for col, rule in rules.items():
        # masked values are text, except NULL-ing which keeps the column type
        out_type = types[col] if rule == "null" else "string"
        m = mask_expr(col, rule).cast(out_type)
        if only_tag and "_sensitivity_tag" in df.columns:
            m = F.when(F.col("_sensitivity_tag") == only_tag, m).otherwise(F.col(col).cast(out_type))
        elif unless_tag and "_sensitivity_tag" in df.columns:
            m = F.when(F.col("_sensitivity_tag") == unless_tag, F.col(col).cast(out_type)).otherwise(m)
        out[col] = m
    return df.withColumns(out)


def sample_table(df: DataFrame, pct: float, seed: int = 42) -> DataFrame:
    """``pct`` percent Bernoulli sample; 0 → the whole table."""
    if pct < 0 or pct > 100:
        raise ValueError("pct must be within [0, 100]")
    return df if pct == 0 else df.sample(withReplacement=False, fraction=pct / 100.0, seed=seed)


def sample_by_key(df: DataFrame, key: str, pct: float, seed: int = 42) -> DataFrame:
    """About ``pct`` percent of the keys, with all their rows: the same keys in every table and on every run.

    A key belongs to one of 10,000 buckets by the md5 of seed and key; NULL keys count as the empty text.
    """
    if pct < 0 or pct > 100:
        raise ValueError("pct must be within [0, 100]")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10_000
    return df if pct == 0 else df.where(bucket < round(pct * 100))


@dataclass(frozen=True)
class Reference:
    """Rows of ``child`` belong to rows of ``parent`` by an equal column (the parent's may have another name)."""

    child: str
    parent: str
    column: str
    parent_column: str | None = None


def sample_with_references(tables: Mapping[str, DataFrame], root: str, key: str, pct: float, references: Sequence[Reference], seed: int = 42) -> dict[str, DataFrame]:
    """A sample in which every kept row finds its parents: ``root`` is sampled by ``key``, the rest follows.

    Walking from the root, a table's children keep the rows whose parent was kept (a row with
    several sampled parents must find each), and other parents keep the rows that a kept child
    needs. A NULL reference points nowhere and asks for nothing. Tables that no reference
    connects with the root are sampled by nothing and stay whole. ``pct`` 0: everything.
    """
    if root not in tables:
        raise ValueError(f"no table {root!r} to sample")
    unknown = {t for r in references for t in (r.child, r.parent)} - set(tables)
    if unknown:
        raise ValueError(f"references to unknown tables: {sorted(unknown)}")
    out = {root: sample_by_key(tables[root], key, pct, seed)}
    if pct == 0:
        return dict(tables)
    todo = [root]
    while todo:  # the graph of tables is small
        now = todo.pop(0)
        for r in references:
            if r.parent == now and r.child not in out:
                kept = tables[r.child]
                for up in references:
                    if up.child == r.child and up.parent in out:
                        kept = _semi(kept, up.column, out[up.parent], up.parent_column or up.column, nulls=True)
                out[r.child] = kept
                todo.append(r.child)
    reached = True
    while reached:  # parents that were not on the way: what the kept children ask for
        reached = False
        for parent in [t for t in tables if t not in out]:
            asked = [r for r in references if r.parent == parent and r.child in out]
            if asked:
                keys = reduce(DataFrame.unionByName, [out[r.child].select(F.col(r.column).alias("_key")) for r in asked]).distinct()
                out[parent] = _semi(tables[parent], asked[0].parent_column or asked[0].column, keys, "_key")
                reached = True
    return {t: out.get(t, df) for t, df in tables.items()}


def _semi(df: DataFrame, column: str, keys: DataFrame, key_column: str, nulls: bool = False) -> DataFrame:
    """Rows whose ``column`` is among the keys (with ``nulls``: or NULL); distinct keys, so a hot key is one row of them."""
    own = keys.select(F.col(key_column).alias("_wanted")).where("_wanted is not null").distinct()
    found = df.join(own, df[column] == own["_wanted"], "left_semi")
    return found.unionByName(df.where(F.col(column).isNull())) if nulls else found


def clone_name(schema: str, table: str) -> str:
    return f"{schema}_{table}".upper()


def parse_table_list(table_list: str) -> list[tuple[str, str]]:
    """'SILVER.SLV_CUSTOMERS, GOLD.DIM_PRODUCTS' → [(schema, table), ...]."""
    out = []
    for entry in table_list.split(","):
        entry = entry.strip()
        if not entry:
            continue
        schema, _, table = entry.partition(".")
        if not table:
            raise ValueError(f"slim clone entries are SCHEMA.TABLE, got {entry!r}")
        out.append((schema.strip(), table.strip()))
    return out


def clone_for_ci(
    spark: SparkSession,
    tables: Mapping[tuple[str, str], DataFrame],
    target_root: str,
    target_schema: str,
    pct: float = 0,
    table_list: str = "*",
    seed: int = 42,
    masks: Mapping[str, Mapping[str, str]] | None = None,
    by_key: tuple[str, str] | None = None,
    references: Sequence[Reference] = (),
) -> str:
    """Copy (or sample) every table, or only ``table_list`` entries, to ``<root>/<schema>/<SCHEMA>_<TABLE>``.

    Refuses targets that are not CI schemas (must start with ``PR_`` or ``CI_``). ``masks`` (table → column →
    rule) replaces the default, under which every table's personal columns (``PERSONAL_MASKS``) are masked in
    all rows but those tagged ``public``; masks given apply to rows tagged ``pii`` (all rows of a table without tags). ``masks={}`` copies everything as it is.
    Each table is sampled on its own, unless ``by_key`` names (table, key column) and ``references`` what hangs
    together: then the key's rows and all that belongs to them are cloned, and nothing refers to a row left out.
    """
    if not _CI_SCHEMA.fullmatch(target_schema):
        raise ValueError("clone target must be a CI schema (PR_* or CI_*, letters, digits and underscores)")
    wanted = None if table_list.strip() == "*" else {(s.upper(), t.upper()) for s, t in parse_table_list(table_list)}
    there = {(s.upper(), t.upper()) for s, t in tables}
    if wanted is not None and wanted - there:
        raise ValueError(f"no such tables: {sorted('.'.join(x) for x in wanted - there)}")
    tags = {"only_tag": "pii"} if masks is not None else {"only_tag": None, "unless_tag": "public"}
    if masks is None:
        masks = {t: {c: r for c, r in PERSONAL_MASKS.items() if c in df.columns} for (_, t), df in tables.items()}
    masks = {t.upper(): m for t, m in masks.items()}
    if set(masks) - {t for _, t in there}:
        raise ValueError(f"masks for unknown tables: {sorted(set(masks) - {t for _, t in there})}")
    n = 0
    if by_key and pct:
        linked = sample_with_references({t: df for (_, t), df in tables.items()}, by_key[0], by_key[1], pct, references, seed)
        # the parts of the sample depend on each other: each is drawn once
        tables, pct_each = {(s, t): materialize(linked[t], f"clone_{t}") for s, t in tables}, 0
    else:
        pct_each = pct
    for (schema, table), df in tables.items():
        if wanted is not None and (schema.upper(), table.upper()) not in wanted:
            continue
        out = sample_table(df, pct_each, seed)
        if masks.get(table.upper()):
            out = mask_columns(out, masks[table.upper()], **tags)
        write_table(out, f"{target_root.rstrip('/')}/{target_schema}/{clone_name(schema, table)}")
        n += 1
    mode = "full" if wanted is None else "slim"
    return f"{n} tables in {target_schema}; mode={mode}; {f'{pct}% sampled' if pct else 'all rows'}"


def clone_zones(
    spark: SparkSession,
    root: str,
    zones: str,
    target_root: str,
    target_schema: str,
    pct: float = 0,
    table_list: str = "*",
    seed: int = 42,
    masks: Mapping[str, Mapping[str, str]] | None = None,
    by_key: tuple[str, str] | None = None,
    references: Sequence[Reference] = (),
) -> str:
    """Full mode: every table found in the comma-separated ``zones`` under ``root``;
    slim mode: only the ``SCHEMA.TABLE`` entries of ``table_list``."""
    from strata.sources.tables import list_tables

    tables: dict[tuple[str, str], DataFrame] = {}
    for zone in [z.strip() for z in zones.split(",") if z.strip()]:
        for t in list_tables(spark, f"{root.rstrip('/')}/{zone}"):
            tables[(zone, t)] = spark.read.parquet(f"{root.rstrip('/')}/{zone}/{t}")
    return clone_for_ci(spark, tables, target_root, target_schema, pct, table_list, seed, masks, by_key, references)


def drop_ci_schema(spark: SparkSession, root: str, schema: str) -> None:
    """Teardown of a CI schema (only PR_/CI_ names, to protect real zones)."""
    if not _CI_SCHEMA.fullmatch(schema):
        raise ValueError("only CI schemas can be dropped")
    drop_path(spark, f"{root.rstrip('/')}/{schema}")


def select_tables(tables: Mapping[tuple[str, str], DataFrame], table_list: str) -> dict[tuple[str, str], DataFrame]:
    wanted = {(s.upper(), t.upper()) for s, t in parse_table_list(table_list)}
    return {k: v for k, v in tables.items() if (k[0].upper(), k[1].upper()) in wanted}

