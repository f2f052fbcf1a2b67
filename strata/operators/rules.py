"""Row validation with a first-failing-rule reason, and the clean/reject split.

A rule is a name plus a boolean condition that is TRUE when the row *fails*.
``tag_rules`` adds the reason (name of the first rule whose condition is TRUE,
NULL when none is) and a validity flag ``reason IS NULL``. A condition that
evaluates to NULL (e.g. ``qty <= 0`` on a NULL qty) does not fail the row:
SQL three-valued logic, kept on purpose.

Both flag and reason come from a single CASE expression, so the clean and the
reject side of one tagged DataFrame can never disagree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``reason`` is emitted when ``condition`` is TRUE (the row fails)."""

    reason: str
    condition: Column | str

    def expr(self) -> Column:
        return F.expr(self.condition) if isinstance(self.condition, str) else self.condition


def not_null(*cols: str) -> list[Rule]:
    """Technical rules ``<col> is null`` in the given order."""
    return [Rule(f"{c} is null", F.col(c).isNull()) for c in cols]


def reason_expr(rules: Sequence[Rule]) -> Column:
    """CASE WHEN r1 THEN 'r1' WHEN r2 THEN 'r2' ... END (NULL when all pass)."""
    if not rules:
        return F.lit(None).cast("string")
    out = None
    for r in rules:
        # coalesce(cond, false): a NULL condition counts as "not failed".
        cond = F.coalesce(r.expr(), F.lit(False))
        out = F.when(cond, F.lit(r.reason)) if out is None else out.when(cond, F.lit(r.reason))
    return out


def valid_expr(rules: Sequence[Rule]) -> Column:
    """TRUE when no rule fails: ``NOT coalesce(c1, false) AND NOT coalesce(c2, false) ...``.

    Equal to ``reason_expr(rules) IS NULL`` but written as a conjunction, so
    Catalyst can simplify each term (``NOT coalesce(isnull(a), false)`` →
    ``isnotnull(a)``) and push them into the parquet scan.
    """
    out = None
    for r in rules:
        term = ~F.coalesce(r.expr(), F.lit(False))
        out = term if out is None else out & term
    return F.lit(True) if out is None else out


def tag_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    flag_col: str = "_is_valid",
    reason_col: str | None = "_reject_reason",
) -> DataFrame:
    """Add ``reason_col`` (first failing rule) and ``flag_col`` (no rule failed)."""
    cols = {flag_col: valid_expr(rules)}
    if reason_col:
        cols = {reason_col: reason_expr(rules), flag_col: valid_expr(rules)}
    return df.withColumns(cols)


def split_valid(
    df: DataFrame,
    rules: Sequence[Rule] | None = None,
    flag_col: str = "_is_valid",
    reason_col: str = "_reject_reason",
) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects) from one tagged DataFrame; together they equal the input.

    When ``rules`` is None, ``df`` must already carry ``flag_col``. At scale the
    tagged frame should be written once (partitioned by the flag) and both sides
    read from it, instead of evaluating the source twice.
    """
    tagged = df if rules is None else tag_rules(df, rules, flag_col, reason_col)
    return tagged.where(F.col(flag_col)), tagged.where(~F.col(flag_col))


# ---------------------------------------------------------------------------
# Rule sets of the four entities, in the reference's order.
# Technical (transient) rules are not-null checks; business (silver) rules
# carry these exact reason texts.
# ---------------------------------------------------------------------------
ORDER_STATUSES = ("COMPLETED", "SHIPPED", "PROCESSING", "CANCELLED", "PENDING")

TECHNICAL_NOT_NULL = {
    "customers": ("customer_id", "email", "created_at"),
    "orders": ("order_id", "customer_id", "order_date", "total_amount"),
    "order_items": ("order_item_id", "order_id", "product_id", "quantity"),
    "products": ("product_id", "product_name", "price", "cost"),
}


def technical_rules(entity: str) -> list[Rule]:
    return not_null(*TECHNICAL_NOT_NULL[entity])


def business_rules(entity: str) -> list[Rule]:
    c = F.col
    if entity == "customers":
        return [
            Rule("invalid email format", ~c("email").like("%@%.%")),
            Rule("invalid postal code", F.length(F.trim(c("postal_code"))) < 3),
            Rule("missing country code", c("country_code").isNull() | (F.trim(c("country_code")) == "")),
        ]
    if entity == "orders":
        return [
            Rule("missing order date", c("order_date").isNull()),
            Rule("invalid total amount", c("total_amount") <= 0),
            Rule("unknown order status", ~c("status").isin(*ORDER_STATUSES)),
        ]
    if entity == "order_items":
        return [
            Rule("invalid quantity", c("quantity") <= 0),
            Rule("invalid unit price", c("unit_price") <= 0),
            Rule("invalid total price", c("total_price") <= 0),
        ]
    if entity == "products":
        return [
            Rule("invalid price", c("price") <= 0),
            Rule("invalid cost", c("cost") < 0),
            Rule("cost exceeds price", c("cost") > c("price")),
        ]
    raise ValueError(f"unknown entity {entity!r}")


def foreign_key_rule(
    df: DataFrame, parent: DataFrame, fk: str, pk: str | None = None, reason: str = "orphan foreign key"
) -> DataFrame:
    """Optional FK business rule: tag rows whose non-NULL ``fk`` has no parent.

    Implemented as a left join against the *distinct* parent keys (a semi-join
    shaped lookup); returns ``df`` plus a boolean ``_fk_missing`` that can be
    used in a ``Rule``. NULL foreign keys are not orphans.
    """
    pk = pk or fk
    keys = parent.select(F.col(pk).alias("__pk")).where(F.col("__pk").isNotNull()).distinct()
    keys = keys.withColumn("__hit", F.lit(True))
    joined = df.join(keys, df[fk] == keys["__pk"], "left")
    return joined.withColumn("_fk_missing", F.col(fk).isNotNull() & F.col("__hit").isNull()).drop("__pk", "__hit")
