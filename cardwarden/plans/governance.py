"""Masks, tags and division views as projections."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.masks import mask_email, mask_pan

CYBER, CREDIT, SHARED = "cyber", "credit", "shared"

_KEYS = ["txn_id", "account_id", "txn_ts"]
DIVISION_COLUMNS = {
    CYBER: [
        *_KEYS, "minutes_since_new_device_login", "geo_mismatch_flag", "failed_logins_1h",
        "recent_ato_label", "device_is_new", "risk_score",
    ],
    CREDIT: [
        *_KEYS, "amount", "mcc", "channel", "decision", "fraud_label", "segment", "risk_score",
    ],
    SHARED: [*_KEYS, "risk_score", "reason_codes"],
}


@dataclass(frozen=True)
class ColumnPolicy:
    """Tags of a column, and its mask for everyone but the privileged roles."""

    table: str
    column: str
    tags: dict[str, str] = field(default_factory=dict)
    mask: Callable[[str], Column] | None = None
    privileged: tuple[str, ...] = ()


POLICY = [
    ColumnPolicy("accounts", "email", {"pii": "email", "division": CREDIT}, mask_email),
    ColumnPolicy("accounts", "pan_token", {"pii": "pan", "division": CREDIT}, mask_pan),
    ColumnPolicy("txn", "pan_token", {"pii": "pan", "division": CREDIT}, mask_pan),
    ColumnPolicy("auth", "ip_geo", {"division": CYBER}),
    ColumnPolicy("auth", "device_id", {"division": CYBER}),
]


def apply_policy(
    df: DataFrame, table: str, role: str, policy: Sequence[ColumnPolicy] = tuple(POLICY)
) -> DataFrame:
    """Masks what the role may not read and attaches the tags as column metadata."""
    rules = {p.column: p for p in policy if p.table == table}

    def shown(name: str) -> Column:
        rule = rules.get(name)
        if rule is None:
            return F.col(name)
        hidden = rule.mask is not None and role not in rule.privileged
        col = rule.mask(name) if hidden else F.col(name)
        return col.alias(name, metadata={"tags": dict(rule.tags)})

    return df.select(*[shown(c) for c in df.columns])


def tags_of(df: DataFrame) -> dict[str, dict[str, str]]:
    """The tags a frame's columns carry."""
    return {f.name: f.metadata["tags"] for f in df.schema.fields if "tags" in f.metadata}


def division_view(scored: DataFrame, role: str) -> DataFrame:
    """The columns a division may read."""
    return scored.select(*DIVISION_COLUMNS[role])


def row_filter(df: DataFrame, predicate: str | Column | None = None) -> DataFrame:
    """Rows a division may read. Off unless a predicate is given; a null outcome hides the row."""
    if predicate is None:
        return df
    cond = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.where(F.coalesce(cond, F.lit(False)))
