"""Reference SQL (DuckDB dialect) for every registered query.

The SQL is an independent statement of each query's semantics over the raw
driver tables, used as the correctness oracle.  Parameters come from the same
:class:`~riskloom.config.RuleConfig` as the Spark plans.
"""

from __future__ import annotations

from .. import config as C
from ..config import RuleConfig
from ..sources.csv import PANDAS_NA_TOKENS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def tx_cte() -> str:
    return """
ev AS (
  SELECT event_id, ts, user_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
tx AS (
  SELECT CAST(ev.event_id AS VARCHAR) AS txn_id,
         CAST(ev.user_id AS VARCHAR) AS user_id,
         ev.value AS amount,
         'GBP' AS currency,
         cn.n_name AS card_country,
         CASE WHEN ev.k = 99 THEN NULL WHEN ev.k < 10 THEN kn.n_name ELSE cn.n_name END AS ip_country,
         CASE WHEN ev.k % 20 = 3 THEN 7995 WHEN ev.k % 20 = 7 THEN 4829 ELSE 5411 END AS merchant_mcc,
         'DEV-' || CAST(ev.k % 7 AS VARCHAR) AS device_id,
         ev.ts AS "timestamp",
         ev.event_id AS seq
  FROM ev
  LEFT JOIN customer c ON c.c_custkey = ev.user_id
  LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey
  LEFT JOIN nation kn ON kn.n_nationkey = ev.k
)"""


def _mcc_list(rules: RuleConfig) -> str:
    return ", ".join(str(m) for m in rules.blacklisted_mcc)


def points_sql(rules: RuleConfig, dialect: str) -> dict[str, str]:
    t = rules.high_amount_threshold
    nan_guard = "NOT isnan(amount) AND " if dialect == C.DIALECT_HISTORY else ""
    empty_guard = " AND card_country <> '' AND ip_country <> ''" if dialect == C.DIALECT_HISTORY else ""
    blacklist = (f"CASE WHEN merchant_mcc IN ({_mcc_list(rules)}) THEN 25 ELSE 0 END"
                 if rules.blacklisted_mcc else "0")
    if dialect == C.DIALECT_WINDOW:
        new_dev = 'CASE WHEN "timestamp" > first_seen_device THEN 0 ELSE 20 END'
    else:
        new_dev = "CASE WHEN rn_u > 1 AND rn_p = 1 THEN 20 ELSE 0 END"
    return {
        "r_high_amount": f"CASE WHEN {nan_guard}amount >= {t * 2!r} THEN 50 "
                         f"WHEN {nan_guard}amount >= {t!r} THEN 30 ELSE 0 END",
        "r_country_mismatch": "CASE WHEN card_country IS NOT NULL AND ip_country IS NOT NULL"
                              f"{empty_guard} AND card_country <> ip_country THEN 40 ELSE 0 END",
        "r_blacklisted_mcc": blacklist,
        "r_high_velocity": f"CASE WHEN txn_count_window >= {int(rules.velocity_max_allowed)} THEN 30 ELSE 0 END",
        "r_night_time": 'CASE WHEN hour("timestamp") >= 0 AND hour("timestamp") < 5 THEN 10 ELSE 0 END',
        "r_new_device": new_dev,
    }


def _floor_seconds(us: str) -> str:
    """Whole epoch seconds, floored like CAST(ts AS BIGINT) (DuckDB's // truncates toward zero)."""
    return f"(({us}) - ((({us}) % 1000000 + 1000000) % 1000000)) // 1000000"


def context_cte(rules: RuleConfig, dialect: str, source: str = "tx") -> str:
    if dialect == C.DIALECT_WINDOW:
        return f"""
ctx AS (
  SELECT {source}.*,
    COUNT(*) OVER (PARTITION BY user_id ORDER BY {_floor_seconds('epoch_us("timestamp")')}
                   RANGE BETWEEN {rules.window_seconds} PRECEDING AND CURRENT ROW) AS txn_count_window,
    MIN("timestamp") OVER (PARTITION BY user_id, device_id ORDER BY "timestamp") AS first_seen_device
  FROM {source}
)"""
    vel = (f"""COUNT(*) OVER (PARTITION BY user_id ORDER BY epoch_us("timestamp")
                   RANGE BETWEEN {rules.window_micros} PRECEDING AND 1 PRECEDING)"""
           if rules.window_micros > 0 else "0")
    return f"""
ctx AS (
  SELECT {source}.*,
    CAST(CASE WHEN "timestamp" IS NULL THEN 0 ELSE {vel} END AS BIGINT) AS txn_count_window,
    ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY "timestamp" NULLS LAST, seq) AS rn_u,
    ROW_NUMBER() OVER (PARTITION BY user_id, device_id ORDER BY "timestamp" NULLS LAST, seq) AS rn_p
  FROM {source}
)"""


def scored_cte(rules: RuleConfig, dialect: str) -> str:
    pts = points_sql(rules, dialect)
    cols = ",\n    ".join(f"{expr} AS {name}" for name, expr in pts.items())
    total = " + ".join(pts)
    return f"""
pts AS (
  SELECT ctx.*,
    {cols}
  FROM ctx
),
scored AS (
  SELECT pts.*, {total} AS total_score
  FROM pts
),
final AS (
  SELECT scored.*,
    CASE WHEN total_score >= 80 THEN 'HIGH' WHEN total_score >= 50 THEN 'MEDIUM'
         WHEN total_score >= 20 THEN 'LOW' ELSE 'INFO' END AS severity,
    CASE WHEN total_score >= {int(rules.flag_threshold)} THEN 'FLAG' ELSE 'OK' END AS status
  FROM scored
)"""


def with_scored(rules: RuleConfig, dialect: str) -> str:
    return "WITH " + tx_cte() + "," + context_cte(rules, dialect) + "," + scored_cte(rules, dialect)


def iso_sql(col: str) -> str:
    # microsecond() is the sub-minute part, never negative (epoch_us % 1e6 is, before 1970)
    return (f"(strftime({col}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({col}) % 1000000 = 0 THEN '' "
            f"ELSE '.' || strftime({col}, '%f') END)")


def hits_cte(rules: RuleConfig) -> str:
    t = repr(float(rules.high_amount_threshold))
    w = int(rules.velocity_window_minutes)
    return f"""
hits0 AS (
  SELECT seq, txn_id, 1 AS o, 'HighAmount' AS name, r_high_amount AS points,
         'Amount ' || format('{{:.2f}}', amount) || ' >= {t}' AS details FROM final WHERE r_high_amount > 0
  UNION ALL
  SELECT seq, txn_id, 2, 'CountryMismatch', r_country_mismatch,
         'Card country ' || coalesce(card_country, 'None') || ' != IP country ' || coalesce(ip_country, 'None')
  FROM final WHERE r_country_mismatch > 0
  UNION ALL
  SELECT seq, txn_id, 3, 'BlacklistedMCC', r_blacklisted_mcc,
         'MCC ' || CAST(merchant_mcc AS VARCHAR) || ' is blacklisted' FROM final WHERE r_blacklisted_mcc > 0
  UNION ALL
  SELECT seq, txn_id, 4, 'HighVelocity', r_high_velocity,
         CAST(txn_count_window AS VARCHAR) || ' txns in last {w} minutes for user ' || coalesce(user_id, 'None')
  FROM final WHERE r_high_velocity > 0
  UNION ALL
  SELECT seq, txn_id, 5, 'NightTime', r_night_time,
         'Transaction at ' || lpad(CAST(hour("timestamp") AS VARCHAR), 2, '0') || ':00' FROM final WHERE r_night_time > 0
  UNION ALL
  SELECT seq, txn_id, 6, 'NewDevice', r_new_device,
         'New device ' || coalesce(device_id, 'None') || ' for user ' || coalesce(user_id, 'None')
  FROM final WHERE r_new_device > 0
),
hit_text AS (
  SELECT seq,
    string_agg(name || ' (+' || CAST(points AS VARCHAR) || ')', '; ' ORDER BY o) AS short_text,
    string_agg(name || ' (+' || CAST(points AS VARCHAR) || ') [' || details || ']', '; ' ORDER BY o) AS detailed_text,
    string_agg('- ' || name || ' (+' || CAST(points AS VARCHAR) || '): ' || details, chr(10) ORDER BY o) AS bullets,
    string_agg(name, ', ' ORDER BY o) AS names
  FROM hits0 GROUP BY seq
),
flat AS (
  SELECT final.*, coalesce(h.short_text, '') AS short_text, coalesce(h.detailed_text, '') AS detailed_text,
         coalesce(h.bullets, 'None') AS bullets, coalesce(h.names, '') AS names
  FROM final LEFT JOIN hit_text h ON h.seq = final.seq
)"""


def _json_str(col: str) -> str:
    return f"coalesce(CAST(to_json({col}) AS VARCHAR), 'null')"


WINDOW_COLS = ("txn_id, user_id, amount, currency, card_country, ip_country, merchant_mcc, device_id, "
               '"timestamp", r_high_amount, r_country_mismatch, r_blacklisted_mcc, txn_count_window, '
               "r_high_velocity, r_night_time, first_seen_device, r_new_device, total_score, severity, status")
HISTORY_COLS = WINDOW_COLS.replace("first_seen_device, ", "")


def oracle_queries(rules: RuleConfig = C.EVENTS_RULES) -> dict[str, str]:
    W, H = C.DIALECT_WINDOW, C.DIALECT_HISTORY
    sw, sh = with_scored(rules, W), with_scored(rules, H)
    pw, ph = points_sql(rules, W), points_sql(rules, H)
    na = ", ".join(_q(t) for t in PANDAS_NA_TOKENS)
    flat_h = sh + "," + hits_cte(rules)
    ts_iso = iso_sql('"timestamp"')
    q: dict[str, str] = {}
    q["transactions"] = "WITH " + tx_cte() + "\nSELECT * FROM tx"
    for name, col in [("rule_high_amount", "r_high_amount"), ("rule_country_mismatch", "r_country_mismatch"),
                      ("rule_blacklisted_mcc", "r_blacklisted_mcc"), ("rule_night_time", "r_night_time")]:
        q[name] = "WITH " + tx_cte() + f"\nSELECT txn_id, {pw[col]} AS points FROM tx"
    q["rule_country_mismatch_upload"] = ("WITH " + tx_cte() + f""",
up AS (
  SELECT txn_id,
    CASE WHEN card_country IS NULL OR card_country IN ({na}) THEN 'nan' ELSE card_country END AS card_country,
    CASE WHEN ip_country IS NULL OR ip_country IN ({na}) THEN 'nan' ELSE ip_country END AS ip_country
  FROM tx
)
SELECT txn_id, card_country, ip_country, {ph['r_country_mismatch']} AS points FROM up""")
    q["velocity_window"] = sw + "\nSELECT txn_id, txn_count_window, r_high_velocity FROM final"
    q["velocity_history"] = sh + "\nSELECT txn_id, txn_count_window, r_high_velocity FROM final"
    q["new_device_window"] = sw + "\nSELECT txn_id, first_seen_device, r_new_device FROM final"
    q["new_device_history"] = sh + "\nSELECT txn_id, r_new_device FROM final"
    q["score_window"] = sw + f"\nSELECT {WINDOW_COLS} FROM final"
    q["score_history"] = sh + f"\nSELECT {HISTORY_COLS} FROM final"
    q["score_window_skewproof"] = q["score_window"]
    q["score_history_skewproof"] = q["score_history"]
    q["stream_score_history"] = q["score_history"]
    q["stream_score_window"] = q["score_window"]
    q["score_history_slices"] = q["score_history"]
    q["score_window_slices"] = q["score_window"]
    q["score_window_csv_sink"] = q["score_window"]
    text_cols = ("txn_id", "user_id", "currency", "card_country", "ip_country", "device_id")
    ingested = {
        "score_csv_permissive": {c: c for c in text_cols},
        "score_csv_strict": {c: f"coalesce({c}, '')" for c in text_cols},
        "score_csv_upload": {c: f"CASE WHEN {c} IS NULL OR {c} IN ({na}) THEN 'nan' ELSE {c} END" for c in text_cols},
    }
    for name, read in ingested.items():
        replaced = ", ".join(f"{expr} AS {c}" for c, expr in read.items())
        q[name] = ("WITH " + tx_cte() + f",\nread AS (SELECT * REPLACE ({replaced}) FROM tx),"
                   + context_cte(rules, H, "read") + "," + scored_cte(rules, H)
                   + f"\nSELECT txn_id, user_id, amount, card_country, ip_country, merchant_mcc, device_id, {ts_iso} AS "
                     "ts_text, r_high_amount, r_country_mismatch, r_blacklisted_mcc, r_high_velocity, r_night_time, "
                     "r_new_device, total_score, severity, status FROM final")
    # times with offsets: order by the instant, hour and text by the time's own wall clock
    there = 'SELECT *, (seq % 5 - 2) * 5400 AS off, "timestamp" + to_seconds((seq % 5 - 2) * 5400) AS here FROM tx'
    iso_here = ts_iso.replace('"timestamp"', "here")
    q["score_csv_offsets"] = (
        "WITH " + tx_cte() + f",\nread AS ({there})," + context_cte(rules, H, "read") + ","
        + scored_cte(rules, H).replace('hour("timestamp")', "hour(here)")
        + f"\nSELECT txn_id, {iso_here} || CASE WHEN off < 0 THEN '-' ELSE '+' END || lpad(CAST(abs(off) // 3600 AS VARCHAR), "
          "2, '0') || ':' || lpad(CAST(abs(off) % 3600 // 60 AS VARCHAR), 2, '0') AS ts_text, txn_count_window, "
          "r_night_time, r_new_device, total_score, severity, status FROM final")
    odd = "device_id || chr(10) || '\"a, b\",' || chr(10) || txn_id"
    q["score_csv_quoted"] = (
        "WITH " + tx_cte() + f",\nread AS (SELECT * REPLACE (coalesce(CASE WHEN seq % 3 = 0 THEN {odd} ELSE device_id END, "
        "'') AS device_id, coalesce(user_id, '') AS user_id, coalesce(card_country, '') AS card_country, "
        "coalesce(ip_country, '') AS ip_country) FROM tx)," + context_cte(rules, H, "read") + "," + scored_cte(rules, H)
        + "\nSELECT txn_id, user_id, amount, device_id, txn_count_window, r_new_device, total_score, status FROM final")
    q["score_history_ordered"] = sh + ('\nSELECT ROW_NUMBER() OVER (ORDER BY "timestamp" NULLS LAST, seq) AS position, '
                                       f"{HISTORY_COLS} FROM final")
    q["rule_mcc_from_text"] = "WITH " + tx_cte() + ("\nSELECT txn_id, merchant_mcc, CASE WHEN merchant_mcc IN "
                                                    "(5411, 4829) THEN 25 ELSE 0 END AS points FROM tx")
    # the code table's intervals, overlapping ones merged: days 1 to 4 of a code's own span and from day 9 on
    listed = """,
spans AS (
  SELECT merchant_mcc AS mcc, CAST(date_trunc('day', MIN("timestamp")) AS TIMESTAMP) AS t
  FROM tx WHERE merchant_mcc <> 5411 GROUP BY merchant_mcc
),
read AS (
  SELECT tx.*, EXISTS (SELECT 1 FROM spans s WHERE s.mcc = tx.merchant_mcc
    AND ((tx."timestamp" >= s.t + INTERVAL 1 DAY AND tx."timestamp" < s.t + INTERVAL 5 DAY)
         OR tx."timestamp" >= s.t + INTERVAL 9 DAY)) AS listed
  FROM tx
)"""
    q["rule_mcc_table"] = ("WITH " + tx_cte() + listed
                           + "\nSELECT txn_id, merchant_mcc, CASE WHEN listed THEN 25 ELSE 0 END AS points FROM read")
    q["score_mcc_table"] = ("WITH " + tx_cte() + listed + "," + context_cte(rules, H, "read") + ","
                            + scored_cte(rules, H).replace(ph["r_blacklisted_mcc"], "CASE WHEN listed THEN 25 ELSE 0 END")
                            + f"\nSELECT {HISTORY_COLS} FROM final")
    q["csv_path_order"] = ("WITH " + tx_cte() + "\nSELECT txn_id, CAST(ROW_NUMBER() OVER (ORDER BY seq) - 1 AS BIGINT) "
                           "AS seq FROM tx")
    spoilt = ("CASE seq % 5 WHEN 0 THEN 'amount' WHEN 1 THEN 'merchant_mcc' WHEN 2 THEN 'timestamp' ELSE 'fields' END")
    q["csv_rejects"] = "WITH " + tx_cte() + f"\nSELECT txn_id, {spoilt} AS reason FROM tx WHERE seq % 3 = 0"
    q["csv_checked"] = ("WITH " + tx_cte() + "\nSELECT txn_id, user_id, amount, merchant_mcc, device_id FROM tx "
                        "WHERE seq % 3 <> 0")
    q["score_console"] = sw + ("\nSELECT txn_id, user_id, amount, currency, \"timestamp\", total_score, severity, "
                               "status, r_high_amount, r_country_mismatch, r_blacklisted_mcc, r_high_velocity, "
                               "r_night_time, r_new_device FROM final")
    q["rule_hits"] = flat_h + ("\nSELECT txn_id, CAST(ROW_NUMBER() OVER (PARTITION BY seq ORDER BY o) AS INTEGER) "
                               "AS pos, name, points, details FROM hits0")
    q["nested_results"] = flat_h + f""",
hit_json AS (
  SELECT seq, CAST(to_json(list(struct_pack(name := name, points := points, details := details) ORDER BY o))
              AS VARCHAR) AS rules_json
  FROM hits0 GROUP BY seq
)
SELECT txn_id, user_id, amount, currency, card_country, ip_country, {ts_iso} AS "timestamp",
       total_score AS score, severity, status, coalesce(j.rules_json, '[]') AS rules_triggered
FROM final LEFT JOIN hit_json j ON j.seq = final.seq"""
    q["result_flat_short"] = flat_h + f"""
SELECT {ts_iso} AS "Timestamp", txn_id AS "Txn ID", user_id AS "User ID", amount AS "Amount",
       currency AS "Currency", total_score AS "Score", severity AS "Severity", status AS "Status",
       short_text AS "Rules Triggered"
FROM flat"""
    q["result_flat_detailed"] = flat_h + f"""
SELECT txn_id, user_id, amount, currency, card_country, ip_country, merchant_mcc, device_id,
       {ts_iso} AS "timestamp", total_score AS score, severity, status, detailed_text AS rules_triggered
FROM flat"""
    q["result_display"] = flat_h + f"""
SELECT {ts_iso} AS "timestamp", txn_id, user_id, '$' || format('{{:,.2f}}', amount) AS amount,
       total_score AS score, severity, status, detailed_text AS rules_triggered
FROM flat"""
    q["result_explained"] = flat_h + f"""
SELECT txn_id, user_id, amount, currency, card_country, ip_country, merchant_mcc, device_id,
       {ts_iso} AS "timestamp", total_score AS score, severity, status, detailed_text AS rules_triggered,
       CASE WHEN status = 'FLAG' THEN txn_id || ' scored ' || CAST(total_score AS VARCHAR) || ' (' || severity || '): '
            || CASE WHEN names = '' THEN 'no rules triggered' ELSE names END ELSE '' END AS ai_explanation
FROM flat"""
    q["summary"] = sh + """
SELECT COUNT(*) AS total, CAST(count_if(status = 'FLAG') AS BIGINT) AS flagged,
       COUNT(*) - CAST(count_if(status = 'FLAG') AS BIGINT) AS ok
FROM final"""
    q["summary_window"] = q["summary"].replace(sh, sw)
    q["score_sink_summary"] = q["summary_window"].replace("AS ok", "AS ok, COUNT(*) AS stored")
    q["result_explained_calls"] = q["result_explained"]
    sample = sh + f""",
sample AS (
  SELECT txn_id, user_id, total_score AS score, {ts_iso} AS ts_text, "timestamp" AS ts_raw, seq
  FROM final WHERE status = 'FLAG'
  ORDER BY "timestamp" NULLS LAST, seq LIMIT 10
)"""
    q["flagged_sample"] = sample + """
SELECT txn_id, user_id, score, ts_text AS "timestamp", seq,
       coalesce(txn_id, 'None') || ' | ' || coalesce(user_id, 'None') || ' | ' || CAST(score AS VARCHAR)
       || ' | ' || coalesce(ts_text, 'None') AS line
FROM sample"""
    txn_json = ("'{' || chr(10) || "
                + " || ',' || chr(10) || ".join(
                    f"'  \"{f}\": ' || " + _json_str(ts_iso if f == "timestamp" else f)
                    for f in ("txn_id", "user_id", "amount", "currency", "card_country", "ip_country", "timestamp"))
                + " || chr(10) || '}'")
    q["explain_prompt"] = flat_h + f"""
SELECT txn_id,
  'Explain in one to three sentences, for an analyst''s screen, why this card transaction received a risk score of '
  || CAST(total_score AS VARCHAR) || ' (' || severity || ').' || chr(10) || chr(10)
  || 'Transaction:' || chr(10) || {txn_json}
  || chr(10) || chr(10) || 'Rules that fired:' || chr(10) || bullets
  || chr(10) || chr(10) || 'Use only these facts. If they are not conclusive, call the transaction suspicious '
  || 'and suggest a next step such as verifying the customer''s identity.' AS prompt
FROM flat WHERE status = 'FLAG'"""
    q["explain_template"] = flat_h + """
SELECT txn_id, seq,
  txn_id || ' scored ' || CAST(total_score AS VARCHAR) || ' (' || severity || '): '
  || CASE WHEN names = '' THEN 'no rules triggered' ELSE names END AS ai_explanation
FROM flat WHERE status = 'FLAG'"""
    q["summary_prompt"] = sample + """,
lines AS (
  SELECT coalesce(txn_id, 'None') || ' | ' || coalesce(user_id, 'None') || ' | ' || CAST(score AS VARCHAR)
         || ' | ' || coalesce(ts_text, 'None') AS line, ts_text, seq FROM sample
)
SELECT COUNT(*) AS n_flagged_sample,
  CASE WHEN COUNT(*) = 0 THEN 'No flagged transactions to summarize.'
  ELSE 'Below is a sample of flagged card transactions (txn | user | score | timestamp). In two to four '
    || 'sentences describe the patterns you see (for example cross-border use, large amounts, new devices '
    || 'or bursts of activity) and propose up to three follow-up checks.' || chr(10) || chr(10)
    || string_agg(line, chr(10) ORDER BY ts_text, seq) END AS prompt
FROM lines"""
    q["summary_text"] = sample + """
SELECT COUNT(*) AS n_flagged_sample,
  CASE WHEN COUNT(*) = 0 THEN 'No flagged transactions to summarize.'
  ELSE COUNT(*) || ' flagged transactions of ' || COUNT(DISTINCT user_id) || ' users, scores ' || MIN(score)
    || ' to ' || MAX(score) || '.' END AS summary
FROM sample"""
    q["overtime_pay"] = """
SELECT s.s_suppkey AS employee_id, s.s_name AS name,
  CASE WHEN l.l_quantity <= 40 THEN l.l_quantity * l.l_extendedprice
       WHEN l.l_quantity > 40 THEN (l.l_quantity - 40) * 1.5 * l.l_extendedprice + 40 * l.l_extendedprice END AS pay,
  l.l_returnflag AS position
FROM supplier s JOIN lineitem l ON s.s_suppkey = l.l_suppkey"""
    return q
