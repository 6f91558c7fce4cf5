"""Risk features, reason codes and actions as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reason codes in their published order.
NEW_DEVICE_RECENT = "new_device_recent"
GEO_MISMATCH = "geo_mismatch"
FAILED_LOGINS_BURST = "failed_logins_burst"
ATO_SIGNAL = "ato_signal"
REASON_CODES = [NEW_DEVICE_RECENT, GEO_MISMATCH, FAILED_LOGINS_BURST, ATO_SIGNAL]

# Rule thresholds.
NEW_DEVICE_MINUTES = 15
BURST_FAILURES = 3
ATO_LINKED_MINUTES = 15
HOLD_SCORE = 0.8
ESCALATE_SCORE = 0.5

# Action labels and their rationale.
ACTION_HOLD = "Hold + step-up authentication"
ACTION_ESCALATE = "Escalate to fraud analyst"
ACTION_APPROVE = "Approve"
RATIONALE = {
    ACTION_HOLD: "ATO signal fired within minutes of the spend; verify the cardholder before approving.",
    ACTION_ESCALATE: "Elevated risk without a confirmed ATO pattern; review before the next authorization.",
    ACTION_APPROVE: "No fused Cyber signal; approve and avoid a false-positive decline.",
}


def cents(amount: str | Column) -> Column:
    """Money in whole cents, so sums do not depend on the order of the rows."""
    col = F.col(amount) if isinstance(amount, str) else amount
    return F.round(col * 100).cast("bigint")


def minutes_between(later: str, earlier: str) -> Column:
    """Minutes from ``earlier`` to ``later``, fractions of a second kept, to 2 decimals half up.

    Worked in whole microseconds, so the outcome is exact and the same everywhere.
    """
    gap = f"(unix_micros({later}) - unix_micros({earlier}))"
    return F.expr(f"sign({gap}) * ((abs({gap}) + 300000) div 600000) / 1e2")


def minutes_since(df: DataFrame, name: str = "minutes_since_new_device_login") -> DataFrame:
    """Minutes since the matched login, of whatever kind it was; null without a login."""
    return df.withColumn(name, minutes_between("txn_ts", "last_auth_ts"))


def geo_mismatch(df: DataFrame) -> DataFrame:
    """1 where login and home place differ; an unknown place on either side is no evidence."""
    flag = F.expr("cast(coalesce(ip_geo <> home_geo, false) AS int)")
    return df.withColumn("geo_mismatch_flag", flag)


def null_safe_counts(df: DataFrame) -> DataFrame:
    """Login counts and flags with 0 where no login was matched."""
    return df.withColumns({
        "failed_logins_1h": F.expr("coalesce(failed_attempts_1h, 0)"),
        "recent_ato_label": F.expr("coalesce(ato_label, 0)"),
        "device_is_new": F.expr("coalesce(device_is_new, 0)"),
    })


def ato_label(df: DataFrame) -> DataFrame:
    """Takeover label of a login: new device, foreign place and a burst of failures."""
    hit = f"device_is_new = 1 AND ip_geo <> home_geo AND failed_attempts_1h >= {BURST_FAILURES}"
    return df.withColumn("ato_label", F.expr(f"cast(coalesce({hit}, false) AS int)"))


def geo_is_new(df: DataFrame) -> DataFrame:
    """1 where a login comes from elsewhere than home."""
    return df.withColumn("geo_is_new", F.expr("cast(coalesce(ip_geo <> home_geo, false) AS int)"))


def reason_code_array(minutes: str = "minutes_since_new_device_login") -> Column:
    """The fired codes in published order.

    A login that lies after the transaction (latest-row join only) is not a
    recent login, hence the lower bound on the minutes.
    """
    return F.expr(f"""array_compact(array(
        CASE WHEN device_is_new = 1 AND {minutes} BETWEEN 0 AND {NEW_DEVICE_MINUTES}
             THEN '{NEW_DEVICE_RECENT}' END,
        CASE WHEN geo_mismatch_flag = 1 THEN '{GEO_MISMATCH}' END,
        CASE WHEN failed_logins_1h >= {BURST_FAILURES} THEN '{FAILED_LOGINS_BURST}' END,
        CASE WHEN recent_ato_label = 1 THEN '{ATO_SIGNAL}' END))""")


def add_reason_codes(df: DataFrame) -> DataFrame:
    """``codes`` as an array and ``reason_codes`` as comma-joined text ('' when none fired)."""
    return df.withColumn("codes", reason_code_array()).withColumn(
        "reason_codes", F.concat_ws(",", "codes")
    )


def split_codes(reason_codes: str | Column = "reason_codes") -> Column:
    """Comma-joined codes back to an array; empty or null text gives an empty array."""
    col = F.col(reason_codes) if isinstance(reason_codes, str) else reason_codes
    return F.filter(F.split(F.coalesce(col, F.lit("")), ","), lambda c: c != "")


def has_code(code: str, reason_codes: str | Column = "reason_codes") -> Column:
    """Exact membership of one code (a code that merely contains the name does not count)."""
    return F.array_contains(split_codes(reason_codes), code)


def recommended_action(df: DataFrame) -> DataFrame:
    """Adds ``recommended_action`` and ``action_rationale``; both null when there is no score."""
    takeover = F.arrays_overlap(
        split_codes(), F.array(F.lit(NEW_DEVICE_RECENT), F.lit(ATO_SIGNAL))
    )
    score = F.col("risk_score")
    action = (
        F.when((score >= HOLD_SCORE) & takeover, ACTION_HOLD)
        .when(score >= ESCALATE_SCORE, ACTION_ESCALATE)
        .when(score.isNotNull(), ACTION_APPROVE)
    )
    rationale = F.lit(None).cast("string")
    for name, text in RATIONALE.items():
        rationale = F.when(F.col("recommended_action") == name, text).otherwise(rationale)
    return df.withColumn("recommended_action", action).withColumn("action_rationale", rationale)


def is_ato_linked_curated() -> Column:
    """The curated definition: strictly under 15 minutes and a place mismatch."""
    gap = F.col("minutes_since_new_device_login")
    return F.coalesce((gap < ATO_LINKED_MINUTES) & (F.col("geo_mismatch_flag") == 1), F.lit(False))


def has_ato_signal() -> Column:
    """The definition behind the executed example: signal code or label."""
    return has_code(ATO_SIGNAL) | (F.col("recent_ato_label") == 1)
