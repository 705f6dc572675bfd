"""The committed 8-row sample and its scored output, both dialects."""

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_CSV
from riskloom.config import SKEWPROOF_EXEC, ExecConfig, RuleConfig
from riskloom.operators import reports as P
from riskloom.operators.scoring import hits_long, score, scored_table
from riskloom.schema import SCORED_WINDOW_COLUMNS
from riskloom.sources import read_transactions_csv

# Expected window-dialect rows (the committed output, written in Europe/London):
# txn, amount, mcc, device, hh:mm, r_high, r_country, r_mcc, count, r_vel, r_night, first_seen hh:mm, r_dev,
# total, severity, status
GOLDEN_WINDOW = [
    ("T001", 45.0, 5411, "DEV-A", "00:15", 0, 0, 0, 1, 0, 10, "00:15", 20, 30, "LOW", "OK"),
    ("T002", 2100.0, 7995, "DEV-A", "00:20", 30, 0, 25, 2, 0, 10, "00:15", 0, 65, "MEDIUM", "FLAG"),
    ("T003", 15.0, 5411, "DEV-B", "00:25", 0, 40, 0, 2, 0, 10, "00:25", 20, 70, "MEDIUM", "FLAG"),
    ("T004", 3000.0, 4829, "DEV-X", "14:10", 30, 0, 25, 1, 0, 0, "14:10", 20, 75, "MEDIUM", "FLAG"),
    ("T005", 20.0, 5411, "DEV-Y", "14:11", 0, 0, 0, 2, 0, 0, "14:11", 20, 20, "LOW", "OK"),
    ("T006", 25.0, 5411, "DEV-Y", "14:12", 0, 0, 0, 3, 30, 0, "14:11", 0, 30, "LOW", "OK"),
    ("T007", 30.0, 5411, "DEV-Y", "14:13", 0, 0, 0, 4, 30, 0, "14:11", 0, 30, "LOW", "OK"),
    ("T008", 35.0, 5411, "DEV-Y", "14:14", 0, 0, 0, 5, 30, 0, "14:11", 0, 30, "LOW", "OK"),
]

# History dialect: txn -> (prior count, total, severity, status, fired rules in order)
GOLDEN_HISTORY = {
    "T001": (0, 10, "INFO", "OK", ["NightTime"]),
    "T002": (1, 65, "MEDIUM", "FLAG", ["HighAmount", "BlacklistedMCC", "NightTime"]),
    "T003": (1, 70, "MEDIUM", "FLAG", ["CountryMismatch", "NightTime", "NewDevice"]),
    "T004": (0, 55, "MEDIUM", "FLAG", ["HighAmount", "BlacklistedMCC"]),
    "T005": (1, 20, "LOW", "OK", ["NewDevice"]),
    "T006": (2, 0, "INFO", "OK", []),
    "T007": (3, 30, "LOW", "OK", ["HighVelocity"]),
    "T008": (4, 30, "LOW", "OK", ["HighVelocity"]),
}

EXECS = [ExecConfig(), SKEWPROOF_EXEC, ExecConfig(hot_key_rows=4)]


@pytest.fixture()
def london(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("exec_cfg", EXECS, ids=["windows", "skewproof", "hybrid"])
def test_window_dialect_matches_committed_output(london, exec_cfg):
    tx = read_transactions_csv(london, SAMPLE_CSV)
    df = scored_table(tx, RuleConfig(), "window", exec_cfg)
    assert df.columns == SCORED_WINDOW_COLUMNS
    df = df.withColumn("hm", F.date_format("timestamp", "HH:mm")).withColumn(
        "first_hm", F.date_format("first_seen_device", "HH:mm"))
    rows = {r.txn_id: r for r in df.collect()}
    assert len(rows) == 8
    for (txn, amount, mcc, dev, hm, rh, rc, rb, cnt, rv, rn, first, rd, total, sev, status) in GOLDEN_WINDOW:
        r = rows[txn]
        assert (r.amount, r.merchant_mcc, r.device_id, r.hm) == (amount, mcc, dev, hm)
        assert (r.currency, r.card_country) == ("GBP", "GB")
        assert (r.r_high_amount, r.r_country_mismatch, r.r_blacklisted_mcc, r.txn_count_window,
                r.r_high_velocity, r.r_night_time, r.first_hm, r.r_new_device,
                r.total_score, r.severity, r.status) == (rh, rc, rb, cnt, rv, rn, first, rd, total, sev, status)


@pytest.mark.parametrize("exec_cfg", EXECS, ids=["windows", "skewproof", "hybrid"])
def test_history_dialect(london, exec_cfg):
    cfg = RuleConfig()
    tx = read_transactions_csv(london, SAMPLE_CSV)
    s = score(tx, cfg, "history", exec_cfg)
    got = {r.txn_id: (r.txn_count_window, r.total_score, r.severity, r.status) for r in s.collect()}
    assert got == {k: v[:4] for k, v in GOLDEN_HISTORY.items()}
    hits = hits_long(s, cfg).collect()
    by_txn = {}
    for h in sorted(hits, key=lambda h: (h.txn_id, h.pos)):
        by_txn.setdefault(h.txn_id, []).append(h.name)
    assert {k: by_txn.get(k, []) for k in GOLDEN_HISTORY} == {k: v[4] for k, v in GOLDEN_HISTORY.items()}


def test_summary_both_dialects(london):
    tx = read_transactions_csv(london, SAMPLE_CSV)
    for dialect in ("window", "history"):
        row = P.summary(score(tx, RuleConfig(), dialect)).first()
        assert (row.total, row.flagged, row.ok) == (8, 3, 5)


def test_detail_texts(london):
    cfg = RuleConfig()
    tx = read_transactions_csv(london, SAMPLE_CSV)
    s = score(tx, cfg, "history")
    details = {(h.txn_id, h.name): h.details for h in hits_long(s, cfg).collect()}
    assert details[("T002", "HighAmount")] == "Amount 2100.00 >= 2000.0"
    assert details[("T003", "CountryMismatch")] == "Card country GB != IP country US"
    assert details[("T004", "BlacklistedMCC")] == "MCC 4829 is blacklisted"
    assert details[("T007", "HighVelocity")] == "3 txns in last 5 minutes for user U200"
    assert details[("T001", "NightTime")] == "Transaction at 00:00"
    assert details[("T003", "NewDevice")] == "New device DEV-B for user U100"
    flat = {r["txn_id"]: r for r in P.flat_detailed(s, cfg).collect()}
    assert flat["T002"]["rules_triggered"] == (
        "HighAmount (+30) [Amount 2100.00 >= 2000.0]; BlacklistedMCC (+25) [MCC 7995 is blacklisted]; "
        "NightTime (+10) [Transaction at 00:00]")
    assert flat["T002"]["timestamp"] == "2025-10-06T00:20:00"
    assert flat["T006"]["rules_triggered"] == ""
    short = {r["Txn ID"]: r["Rules Triggered"] for r in P.flat_short(s, cfg).collect()}
    assert short["T003"] == "CountryMismatch (+40); NightTime (+10); NewDevice (+20)"


def test_first_seen_is_timestamp(london):
    tx = read_transactions_csv(london, SAMPLE_CSV)
    df = scored_table(tx, RuleConfig(), "window")
    assert dict(df.dtypes)["first_seen_device"] == "timestamp"
    r = df.where("txn_id = 'T008'").select(F.date_format("first_seen_device", "yyyy-MM-dd HH:mm").alias("f")).first()
    assert r.f == "2025-10-06 14:11"


def test_rule_hit_type(london):
    from riskloom.schema import RULE_HITS
    from riskloom.operators.scoring import with_hits
    s = with_hits(score(read_transactions_csv(london, SAMPLE_CSV), RuleConfig(), "history"), RuleConfig())
    assert s.schema["rules_triggered"].dataType.simpleString() == RULE_HITS.simpleString()
