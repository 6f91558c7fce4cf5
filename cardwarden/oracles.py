"""The registered queries once more, as SQL for DuckDB on the same tables."""

from __future__ import annotations

import re

_ACCOUNT = 7

_BASE = """
ev AS (
  SELECT *, TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events
),
accts AS (
  SELECT c_custkey AS account_id, DATE '2018-01-01' + CAST(c_custkey % 2500 AS INTEGER) AS open_date,
    c_acctbal AS credit_limit, c_mktsegment AS segment, n_regionkey AS home_geo,
    'user' || c_custkey || '@example.invalid' AS email,
    'tok_' || substr(sha256('pan|' || c_custkey || '|42'), 1, 16) AS pan_token
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
login AS (
  SELECT event_id, user_id AS account_id, ts AS event_ts, 'dev_' || k AS device_id,
    CAST(k < 40 AS INTEGER) AS device_is_new,
    CASE WHEN k % 10 <> 9 THEN k % 5 END AS ip_geo,
    CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS auth_result,
    CASE WHEN event_type = 'error' THEN k % 7 ELSE k % 2 END AS failed_attempts_1h,
    k % 2 AS mfa_used, k
  FROM ev WHERE event_type <> 'purchase'
),
auth AS (
  SELECT l.*, CAST(coalesce(l.ip_geo <> a.home_geo, false) AS INTEGER) AS geo_is_new,
    CAST(coalesce(l.device_is_new = 1 AND l.ip_geo <> a.home_geo AND l.failed_attempts_1h >= 3,
                  false) AS INTEGER) AS ato_label
  FROM login l LEFT JOIN accts a USING (account_id)
),
txn AS (
  SELECT event_id AS txn_id, user_id AS account_id, ts AS txn_ts, value AS amount,
    CAST(round(value * 100) AS BIGINT) AS c,
    ['5411', '5812', '5541', '7011', '4511', '5999', '7995', '5732'][k % 8 + 1] AS mcc,
    ['US', 'GB', 'CA'][k % 3 + 1] AS merchant_country,
    CASE WHEN k % 3 = 2 THEN 'card-present' ELSE 'ecom' END AS channel,
    CASE WHEN k % 7 = 0 THEN 'decline' ELSE 'approve' END AS decision,
    CAST(value >= 150 OR k % 25 = 0 AS INTEGER) AS fraud_label
  FROM ev WHERE event_type = 'purchase' AND value > 0
)"""

_FUSED = _BASE + """,
matched AS (
  SELECT t.*, a.event_ts AS last_auth_ts, a.event_id AS last_event_id, a.ip_geo,
    c.home_geo, c.segment, c.credit_limit,
    @MINUTES(t.txn_ts, a.event_ts) AS minutes_since_new_device_login,
    CAST(coalesce(a.ip_geo <> c.home_geo, false) AS INTEGER) AS geo_mismatch_flag,
    coalesce(a.failed_attempts_1h, 0) AS failed_logins_1h,
    coalesce(a.ato_label, 0) AS recent_ato_label,
    coalesce(a.device_is_new, 0) AS device_is_new
  FROM txn t
  ASOF LEFT JOIN auth a ON t.account_id = a.account_id AND t.txn_ts >= a.event_ts
  LEFT JOIN accts c ON t.account_id = c.account_id
),
fused AS (
  SELECT *, concat_ws(',',
    CASE WHEN device_is_new = 1 AND minutes_since_new_device_login <= 15
         THEN 'new_device_recent' END,
    CASE WHEN geo_mismatch_flag = 1 THEN 'geo_mismatch' END,
    CASE WHEN failed_logins_1h >= 3 THEN 'failed_logins_burst' END,
    CASE WHEN recent_ato_label = 1 THEN 'ato_signal' END) AS reason_codes
  FROM matched
)"""

_SCORED = _FUSED + """,
scored AS (
  SELECT *, 'rule_points_v1' AS model_version,
    least(100, 5 + least(20, CAST(floor(amount / 25) AS INTEGER))
      + CASE WHEN reason_codes LIKE '%new_device_recent%' THEN 35 ELSE 0 END
      + CASE WHEN reason_codes LIKE '%geo_mismatch%' THEN 15 ELSE 0 END
      + CASE WHEN reason_codes LIKE '%failed_logins_burst%' THEN 20 ELSE 0 END
      + CASE WHEN reason_codes LIKE '%ato_signal%' THEN 25 ELSE 0 END) / 100.0::DOUBLE
      AS risk_score
  FROM fused
),
stories AS (
  SELECT *, CASE WHEN reason_codes <> '' THEN
    'Account ' || account_id || ' spent $' || printf('%.2f', amount) || ' after ' ||
    concat_ws(', ',
      CASE WHEN reason_codes LIKE '%new_device_recent%'
           THEN 'a login from a new device shortly before' END,
      CASE WHEN reason_codes LIKE '%geo_mismatch%' THEN 'a login away from the home place' END,
      CASE WHEN reason_codes LIKE '%failed_logins_burst%' THEN 'a burst of failed logins' END,
      CASE WHEN reason_codes LIKE '%ato_signal%' THEN 'an account-takeover signal' END) ||
    '. Codes: ' || reason_codes || '.' END AS reason_narrative
  FROM scored
),
latest AS (
  SELECT account_id, txn_id, risk_score, reason_codes, amount, txn_ts, model_version
  FROM scored QUALIFY row_number() OVER (
    PARTITION BY account_id ORDER BY txn_ts DESC, txn_id DESC) = 1
)"""

_RAW = _BASE + """,
raw_txn AS (
  SELECT CASE WHEN k % 29 <> 3 THEN CAST(event_id AS VARCHAR) END AS txn_id,
    CASE WHEN k % 31 <> 5 THEN CAST(user_id AS VARCHAR) END AS account_id,
    CASE WHEN k <> 11 THEN ts END AS txn_ts,
    CASE WHEN k % 23 <> 7 THEN value END AS amount,
    ['5411', '5812', '5541', '7011', '4511', '5999', '7995', '5732'][k % 8 + 1] AS mcc,
    ['US', 'GB', 'CA'][k % 3 + 1] AS merchant_country,
    CASE WHEN k % 3 = 2 THEN 'card-present' ELSE 'ecom' END AS channel,
    'tok_' || substr(sha256('pan|' || user_id || '|42'), 1, 16) AS pan_token,
    CASE WHEN k % 7 = 0 THEN 'decline' ELSE 'approve' END AS decision,
    CAST(value >= 150 OR k % 25 = 0 AS INTEGER) AS fraud_label
  FROM ev WHERE event_type = 'purchase'
),
raw_auth AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
    CASE WHEN k % 31 <> 5 THEN CAST(account_id AS VARCHAR) END AS account_id,
    CASE WHEN k <> 13 THEN event_ts END AS event_ts,
    device_id, device_is_new, CAST(ip_geo AS VARCHAR) AS ip_geo, 0 AS geo_is_new, auth_result,
    CASE WHEN k <> 17 THEN failed_attempts_1h END AS failed_attempts_1h, mfa_used, 0 AS ato_label
  FROM login
),
raw_accounts AS (
  SELECT CASE WHEN account_id % 37 <> 1 THEN CAST(account_id AS VARCHAR) END AS account_id,
    open_date, CASE WHEN account_id % 41 <> 2 THEN credit_limit END AS credit_limit, segment,
    CAST(home_geo AS VARCHAR) AS home_geo, email, pan_token
  FROM accts
)"""

_GOLD_COLUMNS = """txn_id, account_id, txn_ts, amount, mcc, channel, decision, fraud_label,
  minutes_since_new_device_login, geo_mismatch_flag, failed_logins_1h, recent_ato_label,
  device_is_new, segment, reason_codes"""

_FEATURES = [
    ("amount", 0.8347), ("minutes_since_new_device_login", 0.1542), ("failed_logins_1h", 0.0093),
    ("geo_mismatch_flag", 0.0017), ("recent_ato_label", 0.0), ("device_is_new", 0.0),
]

# Conditional counts and sums that several reports share.
_DECLINES = "CAST(count(*) FILTER (decision = 'decline') AS BIGINT)"
_FALSE = "CAST(count(*) FILTER (decision = 'decline' AND fraud_label = 0) AS BIGINT)"
_FRAUDS = "CAST(count(*) FILTER (fraud_label = 1) AS BIGINT)"


def _cents(cond: str) -> str:
    return f"CAST(coalesce(sum(c) FILTER ({cond}), 0) AS BIGINT)"


_LOSS = _cents("fraud_label = 1 AND decision = 'approve'")
_AVOIDED = _cents("fraud_label = 1 AND decision = 'decline'")


def _rate(num: str, den: str, digits: int = 6) -> str:
    return f"round(CAST({num} AS DOUBLE) / nullif({den}, 0), {digits})"


_FP_COLUMNS = f"""{_DECLINES} AS declines, {_FALSE} AS false_positive_declines,
  {_rate(_FALSE, _DECLINES)} AS fp_decline_rate"""
_NEWEST = "(SELECT max(txn_ts) FROM txn)"
_LINKED = "(reason_codes LIKE '%ato_signal%' OR recent_ato_label = 1)"


def _region(hours: int, linked: str) -> str:
    return f"""SELECT home_geo, count(*) AS n_declines, CAST(sum(c) AS BIGINT) / 100.0::DOUBLE
      AS declined_amount
      FROM fused WHERE txn_ts > {_NEWEST} - INTERVAL {hours} HOUR AND decision = 'decline'
      AND {linked} GROUP BY home_geo"""


def _followed(extra: str = "") -> str:
    return f"""pairs AS (
  SELECT a.event_id, a.account_id, a.event_ts, t.txn_id, t.txn_ts, t.amount, t.c
  FROM auth a JOIN txn t ON a.account_id = t.account_id AND t.txn_ts >= a.event_ts
    AND t.txn_ts <= a.event_ts + INTERVAL 2 HOUR
  WHERE a.device_is_new = 1 AND t.amount >= 60 {extra}
),
hits AS (
  SELECT event_id, account_id, event_ts, arg_min(txn_id, (txn_ts, txn_id)) AS first_txn_id,
    min(txn_ts) AS first_txn_ts, arg_min(amount, (txn_ts, txn_id)) AS first_amount,
    arg_min(c, (txn_ts, txn_id)) AS first_c,
    count(*) AS n_purchases, CAST(sum(c) AS BIGINT) AS spend_cents
  FROM pairs GROUP BY ALL
)"""


_TREND = """SELECT CAST(event_ts AS DATE) AS day, count(*) AS n_logins,
  CAST(sum(n_purchases) AS BIGINT) AS n_purchases,
  CAST(sum(first_c) AS BIGINT) / 100.0::DOUBLE AS first_purchase_spend FROM hits GROUP BY 1"""


def _devices(where: str = "") -> str:
    return f"""SELECT device_id, count(DISTINCT account_id) AS n_accounts FROM auth
      WHERE device_id IS NOT NULL {where} GROUP BY 1 HAVING count(DISTINCT account_id) > 5"""


def _range(span: str, value: str, source: str, ts: str) -> str:
    return f"""CAST(coalesce({value} OVER (PARTITION BY account_id ORDER BY {ts}
      RANGE BETWEEN INTERVAL {span} PRECEDING AND CURRENT ROW), 0) AS BIGINT)"""


_VELOCITY = _range("1 HOUR", "count(*)", "txn", "txn_ts")
_HISTORY = """OVER (PARTITION BY account_id ORDER BY txn_ts RANGE BETWEEN
  INTERVAL 30 DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"""
_VS_AVG = f"""CAST((CAST(c AS HUGEINT) * count(*) {_HISTORY} * 20000 + sum(c) {_HISTORY})
  // (2 * nullif(sum(c) {_HISTORY}, 0)) AS DOUBLE) / 1e4"""


def _small(span: str) -> str:
    return _range(span, "sum(CAST(amount < 10 AS INTEGER))", "txn", "txn_ts")


def _pilot(by: str, source: str, cut: str) -> str:
    missed = "fraud_label = 1 AND decision = 'approve'"
    held = f"risk_score >= {cut}"
    saved = _cents(f"{missed} AND {held}")
    now = f"CAST(count(*) FILTER (fraud_label = 0 AND decision = 'decline') AS BIGINT)"
    policy = f"CAST(count(*) FILTER (fraud_label = 0 AND {held}) AS BIGINT)"
    return f"""SELECT {by}, {_cents(missed)} / 100.0::DOUBLE AS loss_now,
      {saved} / 100.0::DOUBLE AS loss_prevented, {_rate(saved, _cents(missed))} AS loss_cut,
      {now} AS false_declines_now, {policy} AS false_holds_policy,
      CAST(count(*) FILTER (fraud_label = 0 AND decision = 'approve' AND {held}) AS BIGINT)
        AS added_false_holds,
      CAST(coalesce({_rate(saved, _cents(missed))} >= 0.15 AND {policy} <= {now}, false) AS INTEGER)
        AS pilot_pass
      FROM {source} GROUP BY {by}"""


def _contributors() -> str:
    entries = " UNION ALL ".join(
        f"""SELECT txn_id, account_id, {i} AS pos, '{name}' AS feature,
          CAST(coalesce({name}, 0) AS DOUBLE) AS value, CAST({imp} AS DOUBLE) AS importance
          FROM fused"""
        for i, (name, imp) in enumerate(_FEATURES)
    )
    return f"""SELECT txn_id, account_id, CAST(rn AS INTEGER) AS rank, feature, value, importance,
      contribution, CASE WHEN value <> 0 THEN 'Yes' ELSE 'No' END AS fired FROM (
        SELECT *, row_number() OVER (
          PARTITION BY txn_id ORDER BY contribution DESC, importance DESC, pos) AS rn FROM (
          SELECT *, CASE WHEN value <> 0 THEN greatest(importance, 0.05::DOUBLE)
                    ELSE 0.0::DOUBLE END AS contribution FROM ({entries})))
      WHERE rn <= 5"""


_PSI_EDGES = [
    ("amount", [10, 25, 50, 100, 150, 250]),
    ("minutes_since_new_device_login", [15, 60, 240, 1440, 4320]),
    ("geo_mismatch_flag", [1]),
    ("failed_logins_1h", [1, 3, 5]),
    ("recent_ato_label", [1]),
    ("device_is_new", [1]),
]


def _psi() -> str:
    entries = " UNION ALL ".join(
        f"""SELECT '{name}' AS feature, {len(cuts) + 2} AS bins, txn_ts > {_NEWEST}
          - INTERVAL 14 DAY AS cur, CASE WHEN {name} IS NULL THEN -1 ELSE """
        + " + ".join(f"CAST({name} >= {c} AS INTEGER)" for c in cuts)
        + " END AS bin FROM fused"
        for name, cuts in _PSI_EDGES
    )
    empty = " UNION ALL ".join(
        f"SELECT '{name}', {len(cuts) + 2}, unnest(range(-1, {len(cuts) + 1})), 0, 0" for name, cuts in _PSI_EDGES
    )
    return f"""SELECT feature, CAST(sum(nb) AS BIGINT) AS n_base, CAST(sum(nc) AS BIGINT) AS n_current,
      round(sum((pc - pb) * ln(pc / pb)), 6) AS psi FROM (
        SELECT feature, nb, nc,
          (nb + 0.5::DOUBLE) / (sum(nb) OVER (PARTITION BY feature) + 0.5::DOUBLE * bins) AS pb,
          (nc + 0.5::DOUBLE) / (sum(nc) OVER (PARTITION BY feature) + 0.5::DOUBLE * bins) AS pc
        FROM (SELECT feature, bins, bin, sum(nb) AS nb, sum(nc) AS nc FROM (
                SELECT feature, bins, bin, count(*) FILTER (NOT cur) AS nb,
                  count(*) FILTER (cur) AS nc FROM ({entries}) GROUP BY ALL
                UNION ALL {empty}) GROUP BY ALL))
      GROUP BY feature"""


def _rule_lines(feed: str, source: str, rules: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{feed}' AS feed, '{name}' AS rule, count(*) AS n_in,
          count(*) FILTER ({cond}) AS n_pass,
          round(100.0::DOUBLE * count(*) FILTER ({cond}) / nullif(count(*), 0), 4) AS pass_pct
          FROM {source}"""
        for name, cond in rules
    )


_REPORT = " UNION ALL ".join([
    _rule_lines("auth", "raw_auth", [
        ("valid_account", "account_id IS NOT NULL"), ("ts_present", "event_ts IS NOT NULL"),
        ("all_drop_rules", "account_id IS NOT NULL"),
    ]),
    _rule_lines("txn", "raw_txn", [
        ("valid_txn", "txn_id IS NOT NULL AND account_id IS NOT NULL"),
        ("valid_amount", "amount > 0"),
        ("all_drop_rules", "txn_id IS NOT NULL AND account_id IS NOT NULL AND amount > 0"),
    ]),
    _rule_lines("accounts", "raw_accounts", [
        ("valid_acct_master", "account_id IS NOT NULL"),
        ("all_drop_rules", "account_id IS NOT NULL"),
    ]),
])

_QUEUE = "risk_score DESC, txn_ts DESC, txn_id"
_ACTION = """CASE WHEN risk_score >= 0.8 AND (reason_codes LIKE '%new_device_recent%'
  OR reason_codes LIKE '%ato_signal%') THEN 'Hold + step-up authentication'
  WHEN risk_score >= 0.5 THEN 'Escalate to fraud analyst' ELSE 'Approve' END"""
_RATIONALE = f"""CASE {_ACTION}
  WHEN 'Hold + step-up authentication' THEN
    'ATO signal fired within minutes of the spend; verify the cardholder before approving.'
  WHEN 'Escalate to fraud analyst' THEN
    'Elevated risk without a confirmed ATO pattern; review before the next authorization.'
  ELSE 'No fused Cyber signal; approve and avoid a false-positive decline.' END"""


def _split_hash(expr: str) -> str:
    return f"CASE WHEN {expr} THEN 'test' ELSE 'train' END AS split"


_SQL: dict[str, tuple[str, str]] = {
    "p1_silver_auth": (_RAW, "SELECT * FROM raw_auth"),
    "p1_silver_txn": (_RAW, "SELECT * FROM raw_txn"),
    "p1_silver_accounts": (_RAW, "SELECT * FROM raw_accounts"),
    "p2_drop_rules_txn": (
        _RAW,
        "SELECT * FROM raw_txn WHERE txn_id IS NOT NULL AND account_id IS NOT NULL AND amount > 0",
    ),
    "p2_drop_rules_accounts": (_RAW, "SELECT * FROM raw_accounts WHERE account_id IS NOT NULL"),
    "p3_warn_rule": (
        _RAW,
        """SELECT CAST(event_ts IS NULL AS INTEGER) AS violates_ts_present, count(*) AS n
           FROM raw_auth WHERE account_id IS NOT NULL GROUP BY 1""",
    ),
    "p4_rule_report": (_RAW, _REPORT),
    "p5_filter_account": (
        _BASE, f"SELECT txn_id, account_id, txn_ts, amount FROM txn WHERE account_id = {_ACCOUNT}",
    ),
    "p6_nonempty_codes": (
        _FUSED, "SELECT txn_id, reason_codes FROM fused WHERE length(reason_codes) > 0"),
    "p7_code_membership": (
        _FUSED, "SELECT txn_id, reason_codes FROM fused WHERE reason_codes LIKE '%ato_signal%'"),
    "p8_p9_pruned_renamed": (
        _FUSED,
        """SELECT txn_id AS "transaction", failed_logins_1h AS failed_logins, home_geo AS home
           FROM fused""",
    ),
    "u1_dedup_txn": (
        _BASE,
        """SELECT txn_id, account_id, txn_ts, amount FROM (
             SELECT txn_id, account_id, txn_ts, amount FROM txn UNION ALL
             SELECT txn_id, account_id, txn_ts + INTERVAL 1 SECOND, amount + 1 FROM txn)
           QUALIFY row_number() OVER (PARTITION BY txn_id ORDER BY txn_ts DESC) = 1""",
    ),
    "u1_dedup_auth": (
        _BASE,
        """SELECT event_id, account_id, event_ts, ato_label FROM (
             SELECT event_id, account_id, event_ts, ato_label FROM auth UNION ALL
             SELECT event_id + 1000000000, account_id, event_ts, ato_label FROM auth)
           QUALIFY row_number() OVER (
             PARTITION BY account_id, event_ts ORDER BY event_id DESC) = 1""",
    ),
    "u2_dedup_accounts": (
        _BASE,
        """SELECT account_id, open_date, segment FROM (
             SELECT account_id, open_date, segment FROM accts UNION ALL
             SELECT account_id, open_date + 30, lower(segment) FROM accts)
           QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY open_date DESC) = 1""",
    ),
    "u3_named_then_earliest": (
        _SCORED,
        """SELECT DISTINCT txn_id, account_id, txn_ts, risk_score, reason_codes FROM (
             SELECT * FROM scored WHERE txn_id = (SELECT min(txn_id) FROM txn) UNION ALL
             (SELECT * FROM scored WHERE reason_codes LIKE '%ato_signal%'
              ORDER BY txn_ts, txn_id LIMIT 8))""",
    ),
    "j1_asof_fuse": (_FUSED, f"SELECT {_GOLD_COLUMNS} FROM fused"),
    "j1_since_new_device": (
        _BASE,
        """SELECT t.txn_id, a.event_ts AS new_device_ts,
             @MINUTES(t.txn_ts, a.event_ts)
               AS minutes_since_last_new_device
           FROM txn t ASOF LEFT JOIN (SELECT * FROM auth WHERE device_is_new = 1) a
           ON t.account_id = a.account_id AND t.txn_ts >= a.event_ts""",
    ),
    "j1_asof_tolerance": (
        _BASE,
        """SELECT t.txn_id, CASE WHEN t.txn_ts - a.event_ts <= INTERVAL 2 HOUR THEN
             @MINUTES(t.txn_ts, a.event_ts) END
               AS minutes_since_last_new_device
           FROM txn t ASOF LEFT JOIN (SELECT * FROM auth WHERE device_is_new = 1) a
           ON t.account_id = a.account_id AND t.txn_ts >= a.event_ts""",
    ),
    "j2_latest_join": (
        _BASE + """,
        newest AS (SELECT * FROM auth QUALIFY row_number() OVER (
          PARTITION BY account_id ORDER BY event_ts DESC, event_id DESC) = 1),
        state AS (SELECT t.txn_id, n.event_ts AS last_auth_ts, n.device_is_new,
            @MINUTES(t.txn_ts, n.event_ts) AS gap,
            CAST(coalesce(n.ip_geo <> c.home_geo, false) AS INTEGER) AS geo_mismatch_flag,
            n.failed_attempts_1h, n.ato_label
          FROM txn t LEFT JOIN newest n ON t.account_id = n.account_id
          LEFT JOIN accts c ON t.account_id = c.account_id)""",
        """SELECT txn_id, last_auth_ts, gap AS minutes_since_new_device_login, geo_mismatch_flag,
             concat_ws(',',
               CASE WHEN device_is_new = 1 AND gap >= 0 AND gap <= 15 THEN 'new_device_recent' END,
               CASE WHEN geo_mismatch_flag = 1 THEN 'geo_mismatch' END,
               CASE WHEN failed_attempts_1h >= 3 THEN 'failed_logins_burst' END,
               CASE WHEN ato_label = 1 THEN 'ato_signal' END) AS reason_codes FROM state""",
    ),
    "j3_enrich_accounts": (
        _BASE,
        """SELECT t.txn_id, c.home_geo, c.segment, c.credit_limit
           FROM txn t LEFT JOIN accts c USING (account_id)""",
    ),
    "j4_gold_with_cases": (_SCORED, "SELECT txn_id, reason_codes, reason_narrative FROM stories"),
    "j7_login_then_spend": (
        _BASE + ",\n" + _followed(),
        """SELECT event_id, account_id, event_ts, first_txn_id, first_txn_ts, first_amount,
             n_purchases, spend_cents FROM hits""",
    ),
    "j8_lookup": (_SCORED, f"SELECT * FROM latest WHERE account_id = {_ACCOUNT}"),
    "j8_lookup_many": (
        _SCORED,
        """SELECT a.account_id, l.txn_id, l.risk_score, l.reason_codes
           FROM accts a LEFT JOIN latest l ON a.account_id = l.account_id""",
    ),
    "f1_minutes_since": (
        _FUSED, "SELECT txn_id, last_auth_ts, minutes_since_new_device_login FROM fused"),
    "f2_geo_mismatch": (_FUSED, "SELECT txn_id, ip_geo, home_geo, geo_mismatch_flag FROM fused"),
    "f3_null_safe_counts": (
        _FUSED, "SELECT txn_id, failed_logins_1h, recent_ato_label, device_is_new FROM fused"),
    "f4_reason_codes": (
        _FUSED,
        """SELECT txn_id, reason_codes, CAST(CASE WHEN reason_codes = '' THEN 0
             ELSE len(string_split(reason_codes, ',')) END AS INTEGER) AS n_codes FROM fused""",
    ),
    "f5_split_codes": (
        _FUSED,
        """SELECT txn_id, CAST(CASE WHEN reason_codes = '' THEN 0
             ELSE len(string_split(reason_codes, ',')) END AS INTEGER) AS n_codes,
             nullif(split_part(reason_codes, ',', 1), '') AS first_code FROM fused""",
    ),
    "f6_f7_login_labels": (_BASE, "SELECT event_id, ip_geo, geo_is_new, ato_label FROM auth"),
    "f8_txn_velocity": (_BASE, f"SELECT txn_id, {_VELOCITY} AS txn_velocity_1h FROM txn"),
    "f9_amount_vs_avg": (_BASE, f"SELECT txn_id, {_VS_AVG} AS amount_vs_30d_avg FROM txn"),
    "f9_w3_gold_tiles": (
        _SCORED,
        f"""SELECT {_GOLD_COLUMNS}, {_VELOCITY} AS txn_velocity_1h,
              {_VS_AVG} AS amount_vs_30d_avg, risk_score FROM scored""",
    ),
    "f10_card_test_burst": (
        _BASE,
        f"""SELECT txn_id, n AS small_txns_1h, CAST(n >= 2 AS INTEGER) AS card_test_burst
            FROM (SELECT txn_id, {_small('24 HOUR')} AS n FROM txn)""",
    ),
    "f8_f9_f10_spend_features": (
        _BASE,
        f"""SELECT txn_id, {_VELOCITY} AS txn_velocity_1h, {_small('1 HOUR')} AS small_txns_1h,
              {_VS_AVG} AS amount_vs_30d_avg FROM txn""",
    ),
    "f11_geo_impossible": (
        _BASE,
        """SELECT event_id, account_id, prev_event_id, prev_geo, ip_geo,
             @MINUTES(event_ts, prev_ts) AS gap_minutes FROM (
             SELECT *, lag(event_id) OVER w AS prev_event_id, lag(ip_geo) OVER w AS prev_geo,
               lag(event_ts) OVER w AS prev_ts FROM auth
             WINDOW w AS (PARTITION BY account_id ORDER BY event_ts, event_id))
           WHERE ip_geo <> prev_geo AND event_ts - prev_ts < INTERVAL 1 HOUR""",
    ),
    "f12_failed_attempts": (
        _BASE,
        "SELECT event_id, "
        + _range("24 HOUR", "sum(CAST(auth_result = 'failure' AS INTEGER))", "auth", "event_ts")
        + " AS failed_in_span FROM auth",
    ),
    "f13_tokenize": (_BASE, "SELECT account_id, pan_token FROM accts"),
    "f14_actions": (
        _SCORED,
        f"""SELECT txn_id, risk_score, {_ACTION} AS recommended_action,
              {_RATIONALE} AS action_rationale FROM scored""",
    ),
    "a1_profile": (
        _BASE,
        f"""SELECT *, {_rate('fraud', 'card_transactions')} AS fraud_rate FROM (SELECT
              (SELECT count(*) FROM accts) AS accounts, (SELECT count(*) FROM auth) AS auth_events,
              (SELECT count(*) FROM auth WHERE ato_label = 1) AS ato_logins,
              count(*) AS card_transactions, {_FRAUDS} AS fraud, {_DECLINES} AS declines,
              {_FALSE} AS false_positive_declines FROM txn)""",
    ),
    "a2_row_counts": (
        _FUSED,
        """SELECT 'gold' AS name, count(*) AS n_rows FROM fused UNION ALL
           SELECT 'auth', count(*) FROM auth UNION ALL
           SELECT 'accounts', count(*) FROM accts""",
    ),
    "a3_label_counts": (
        _FUSED, "SELECT fraud_label, count(*) AS n FROM fused GROUP BY fraud_label"),
    "a4_latest_per_account": (_SCORED, "SELECT * FROM latest"),
    "a5_fp_decline_rate": (_FUSED, f"SELECT segment, {_FP_COLUMNS} FROM fused GROUP BY segment"),
    "a6_shared_devices": (_BASE, _devices()),
    "a7_net_fraud_loss": (
        _FUSED,
        f"SELECT segment, {_LOSS} / 100.0::DOUBLE AS net_fraud_loss FROM fused GROUP BY segment",
    ),
    "a8_loss_bps": (
        _BASE,
        f"""SELECT channel, {_LOSS} / 100.0::DOUBLE AS net_fraud_loss,
              {_cents("decision = 'approve'")} / 100.0::DOUBLE AS approved_volume,
              {_rate(_LOSS + ' * 10000', _cents("decision = 'approve'"), 4)} AS loss_bps
            FROM txn GROUP BY channel""",
    ),
    "a9_false_declines_per_fraud": (
        _BASE,
        f"""SELECT {_FALSE} AS false_declines, {_FRAUDS} AS frauds,
              {_rate(_FALSE, _FRAUDS)} AS false_declines_per_fraud FROM txn""",
    ),
    "a10_mean_time_to_detect": (
        _FUSED,
        """SELECT (SELECT count(*) FROM auth WHERE ato_label = 1) AS n_ato_logins,
             count(*) AS n_detected,
             round(CAST(sum(d) AS DOUBLE) / (count(*) * 60e6), 4) AS mean_minutes_to_detect
           FROM (SELECT last_event_id, min(epoch_us(txn_ts) - epoch_us(last_auth_ts)) AS d
                 FROM fused WHERE recent_ato_label = 1 GROUP BY 1)""",
    ),
    "a11_travel_fp_rate": (
        _BASE, f"SELECT {_FP_COLUMNS} FROM txn WHERE mcc IN ('7011', '4511')"),
    "a12_weekly_loss_avoided": (
        _BASE,
        f"""SELECT week, x / 100.0::DOUBLE AS loss_avoided,
              lag(x) OVER (ORDER BY week) / 100.0::DOUBLE AS loss_avoided_prev_week,
              (x - lag(x) OVER (ORDER BY week)) / 100.0::DOUBLE AS change
            FROM (SELECT CAST(date_trunc('week', txn_ts) AS DATE) AS week, {_AVOIDED} AS x
                  FROM txn GROUP BY 1)""",
    ),
    "a13_daily_loss_and_fp": (
        _BASE,
        f"""SELECT CAST(txn_ts AS DATE) AS day, {_AVOIDED} / 100.0::DOUBLE AS loss_avoided,
              {_FP_COLUMNS} FROM txn WHERE txn_ts > {_NEWEST} - INTERVAL 7 DAY GROUP BY 1""",
    ),
    "a14_device_then_spend_trend": (_BASE + ",\n" + _followed(), _TREND),
    "a15_ato_declines_by_region": (_FUSED, _region(24 * 14, _LINKED)),
    "a16_avg_by_segment": (
        _FUSED,
        """SELECT segment, count(minutes_since_new_device_login) AS n,
             round(CAST(sum(CAST(minutes_since_new_device_login AS DECIMAL(18,2))) AS DOUBLE)
               / nullif(count(minutes_since_new_device_login), 0), 4) AS mean
           FROM fused GROUP BY segment""",
    ),
    "a17_shadow_eval": (_SCORED, _pilot("segment", "scored", "0.3")),
    "a17_threshold_sweep": (
        _SCORED,
        _pilot(
            "segment, threshold",
            "(SELECT *, unnest([0.2, 0.3, 0.4, 0.5, 0.8]::DOUBLE[]) AS threshold FROM scored)",
            "threshold",
        ),
    ),
    "a21_code_frequency": (
        _FUSED,
        """SELECT reason_code, count(*) AS n FROM (
             SELECT unnest(string_split(reason_codes, ',')) AS reason_code FROM fused)
           WHERE reason_code <> '' GROUP BY 1""",
    ),
    "t1_case_queue": (
        _SCORED,
        f"""SELECT txn_id, account_id, risk_score, reason_codes, reason_narrative FROM stories
            WHERE txn_id = (SELECT min(txn_id) FROM txn) OR reason_codes LIKE '%ato_signal%'
            ORDER BY CASE WHEN txn_id = (SELECT min(txn_id) FROM txn) THEN 0 ELSE 1 END, {_QUEUE}
            LIMIT 12""",
    ),
    "t2_flagged": (
        _SCORED,
        f"""SELECT txn_id, account_id, risk_score, reason_codes FROM scored
            WHERE reason_codes <> ''
            ORDER BY CASE WHEN account_id = {_ACCOUNT} THEN 0 ELSE 1 END, {_QUEUE} LIMIT 10""",
    ),
    "t4_head_by_time": (
        _FUSED,
        """SELECT txn_id, txn_ts, reason_codes FROM fused WHERE reason_codes LIKE '%ato_signal%'
           ORDER BY txn_ts, txn_id LIMIT 8""",
    ),
    "t5_top_risk_approved": (
        _SCORED,
        f"""SELECT txn_id, risk_score, amount, reason_narrative FROM stories
            WHERE decision = 'approve' ORDER BY {_QUEUE} LIMIT 10""",
    ),
    "t6_top_contributors": (_FUSED, _contributors()),
    "g1_g2_masks": (
        _BASE,
        """SELECT account_id, left(email, 2) || '***@***.invalid' AS email,
             'tok_****' || right(pan_token, 4) AS pan_token FROM accts""",
    ),
    "g4_division_cyber": (
        _SCORED,
        """SELECT txn_id, account_id, txn_ts, minutes_since_new_device_login, geo_mismatch_flag,
             failed_logins_1h, recent_ato_label, device_is_new, risk_score FROM scored""",
    ),
    "g4_division_credit": (
        _SCORED,
        """SELECT txn_id, account_id, txn_ts, amount, mcc, channel, decision, fraud_label, segment,
             risk_score FROM scored""",
    ),
    "g4_division_shared": (
        _SCORED, "SELECT txn_id, account_id, txn_ts, risk_score, reason_codes FROM scored"),
    "g5_row_filter": (
        _SCORED,
        """SELECT txn_id, account_id, txn_ts, risk_score, reason_codes FROM scored
           WHERE reason_codes <> ''""",
    ),
    "m1_feature_frame": (
        _FUSED,
        "SELECT txn_id, "
        + ", ".join(f"CAST(coalesce({n}, 0) AS DOUBLE) AS {n}" for n, _ in _FEATURES)
        + " FROM fused",
    ),
    "m2_split_exact": (
        _FUSED,
        "SELECT txn_id, fraud_label, "
        + _split_hash("rn <= round(n * 0.25::DOUBLE)")
        + """ FROM (SELECT txn_id, fraud_label, count(*) OVER (PARTITION BY fraud_label) AS n,
            row_number() OVER (PARTITION BY fraud_label
              ORDER BY md5(txn_id || '|42'), txn_id) AS rn FROM fused)""",
    ),
    "m2_split_hash": (
        _FUSED,
        "SELECT txn_id, fraud_label, "
        + _split_hash(
            "CAST('0x' || substr(md5(txn_id || '|42'), 1, 8) AS BIGINT) < 0.25 * 4294967296")
        + " FROM fused",
    ),
    "m6_roc_auc": (
        _SCORED,
        """SELECT CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(q) AS BIGINT) AS n_neg,
             round(CAST(sum(p * (2 * below + q)) AS DOUBLE)
               / (2.0::DOUBLE * sum(p) * sum(q)), 6) AS roc_auc FROM (
             SELECT p, q, coalesce(sum(q) OVER (
               ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
               SELECT risk_score AS s, count(*) FILTER (fraud_label = 1) AS p,
                 count(*) FILTER (fraud_label = 0) AS q FROM scored GROUP BY 1))""",
    ),
    "m7_precision_recall": (
        _SCORED,
        """SELECT 0.3::DOUBLE AS threshold,
             coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS "precision",
             coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall FROM (
             SELECT count(*) FILTER (fraud_label = 1 AND risk_score >= 0.3) AS tp,
               count(*) FILTER (fraud_label = 0 AND risk_score >= 0.3) AS fp,
               count(*) FILTER (fraud_label = 1 AND risk_score < 0.3) AS fn FROM scored)""",
    ),
    "m8_confusion": (
        _SCORED,
        """SELECT l AS label, p AS predicted, (SELECT count(*) FROM scored
             WHERE fraud_label = l AND CAST(risk_score >= 0.3 AS INTEGER) = p) AS n
           FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(l, p)""",
    ),
    "m10_psi": (_FUSED, _psi()),
    "m11_rule_score": (_SCORED, "SELECT txn_id, risk_score, model_version FROM scored"),
    "n1_narratives": (_SCORED, "SELECT txn_id, reason_narrative FROM stories"),
    "n2_n3_case_table": (
        _SCORED,
        """SELECT 'CASE-' || txn_id AS case_id, txn_id, account_id, amount, risk_score,
             reason_codes, reason_narrative, 'open' AS analyst_status, 'shared' AS division_view
           FROM stories WHERE reason_codes <> ''""",
    ),
    "n4_q0_cases_of_account": (
        _SCORED,
        f"""SELECT txn_id, account_id, amount, reason_codes, reason_narrative, decision
            FROM stories WHERE account_id = {_ACCOUNT} AND {_LINKED}""",
    ),
    "n4_q1_ato_declines_by_region": (
        _FUSED,
        _region(1, "minutes_since_new_device_login < 15 AND geo_mismatch_flag = 1"),
    ),
    "n4_q2_shared_devices": (
        _BASE,
        _devices("AND CAST(event_ts AS DATE) = (SELECT CAST(max(event_ts) AS DATE) FROM auth)"),
    ),
    "n4_q3_device_then_spend": (
        _BASE + ",\n"
        + _followed("AND a.event_ts > (SELECT max(event_ts) FROM auth) - INTERVAL 7 DAY"),
        _TREND,
    ),
    "n4_q4_travel_fp_rate": (
        _BASE,
        f"""SELECT {_FP_COLUMNS} FROM txn WHERE mcc IN ('7011', '4511')
            AND CAST(txn_ts AS DATE) = CAST({_NEWEST} AS DATE)""",
    ),
    "n4_q5_top_risk_approved": (
        _SCORED,
        f"""SELECT txn_id, account_id, risk_score, reason_narrative FROM stories
            WHERE decision = 'approve' ORDER BY {_QUEUE} LIMIT 10""",
    ),
    "n4_q7_latency_by_segment": (
        _FUSED,
        f"""SELECT segment, count(minutes_since_new_device_login) AS n,
              round(CAST(sum(CAST(minutes_since_new_device_login AS DECIMAL(18,2))) AS DOUBLE)
                / nullif(count(minutes_since_new_device_login), 0), 4) AS mean
            FROM fused WHERE CAST(txn_ts AS DATE) = CAST({_NEWEST} AS DATE) GROUP BY segment""",
    ),
    "n5_payload": (
        _SCORED,
        f"""SELECT account_id, txn_id, risk_score AS score, reason_codes, amount, txn_ts AS as_of,
              model_version, {_ACTION} AS recommended_action FROM latest""",
    ),
}
_SQL["n4_q6_loss_avoided"] = (
    _BASE, "SELECT * FROM (" + _SQL["a12_weekly_loss_avoided"][1] + ") ORDER BY week DESC LIMIT 1")
_SQL["n4_q8_loss_and_fp"] = _SQL["a13_daily_loss_and_fp"]


for _name in ("j1_asof_fuse", "j7_login_then_spend", "f9_amount_vs_avg", "f11_geo_impossible"):
    _SQL[f"{_name}_sliced"] = _SQL[_name]
_SQL["s1_csv_feed"] = _SQL["st2_silver_stream"] = _SQL["p2_drop_rules_txn"]
_SQL["s4_gold_sink"] = _SQL["j5_st3_stream_enrich"] = _SQL["j1_asof_fuse"]
_SQL["s5_serving_sink"] = _SQL["st7_serving_upsert"] = _SQL["a4_latest_per_account"]
_SQL["s6_case_table_sink"] = _SQL["n2_n3_case_table"]
_SQL["s8_json_export"] = (
    _SCORED, "SELECT txn_id, account_id, amount, risk_score, reason_codes FROM scored")
_SQL["u4_dedup_stream"] = (_BASE, "SELECT event_id, ts, user_id FROM events")
_SQL["j6_st5_stream_asof"] = (
    _BASE,
    """SELECT t.txn_id, t.account_id, t.txn_ts, a.event_ts AS last_auth_ts,
         a.event_id AS last_event_id, a.device_is_new, a.failed_attempts_1h, a.ato_label, a.ip_geo
       FROM txn t ASOF LEFT JOIN auth a
       ON t.account_id = a.account_id AND t.txn_ts >= a.event_ts""",
)
_SQL["st6_velocity_per_row"] = _SQL["f8_txn_velocity"]
_SQL["st6_velocity_stream"] = (
    _BASE,
    """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, account_id,
         count(*) AS n_txns, CAST(sum(c) AS BIGINT) AS spend_cents FROM (
         SELECT *, time_bucket(INTERVAL 15 MINUTE, txn_ts)
           - INTERVAL 15 MINUTE * unnest([0, 1, 2, 3]) AS window_start FROM txn)
       GROUP BY ALL""",
)


def _spelled_out(sql: str) -> str:
    """Writes out @MINUTES(later, earlier): minutes to 2 decimals, half up, in whole numbers."""

    def minutes(match: re.Match) -> str:
        gap = f"(epoch_us({match[1]}) - epoch_us({match[2]}))"
        return f"(sign({gap}) * ((abs({gap}) + 300000) // 600000) / 1e2)"

    return re.sub(r"@MINUTES\(([\w.]+), ([\w.]+)\)", minutes, sql)


def oracle_sql() -> dict[str, str]:
    """SQL text per registered query that SQL can express."""
    return {name: _spelled_out(f"WITH {ctes}\n{body}") for name, (ctes, body) in _SQL.items()}
