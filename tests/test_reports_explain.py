"""Result shapes, text renderings, explanation payloads, payroll join."""

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_CSV
from helpers import T0, tx_rows
from riskloom.config import RuleConfig
from riskloom.functions import text as X
from riskloom.functions.timecols import iso_format
from riskloom.operators import explain as E
from riskloom.operators import reports as P
from riskloom.operators.payroll import overtime_pay
from riskloom.operators.scoring import score
from riskloom.sources import read_transactions_csv


def test_number_and_time_formats_follow_python(spark):
    vals = [0.125, 2.675, 1234567.891, -5.0, 0.005, 1e6]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.select(X.fixed2(F.col("x")).alias("a"), X.money(F.col("x")).alias("m")).collect()
    assert [r.a for r in got] == [f"{v:.2f}" for v in vals]
    assert [r.m for r in got] == ["${:,.2f}".format(v) for v in vals]
    ts = [T0, T0 + timedelta(microseconds=5), None]
    tdf = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    assert [r.s for r in tdf.select(iso_format("t").alias("s")).collect()] == [
        T0.isoformat(), (T0 + timedelta(microseconds=5)).isoformat(), None]


def test_indented_json_matches_json_dumps(spark):
    df = spark.createDataFrame([("T1", None, 12.5, 'q"x')], "a string, b string, c double, d string")
    got = df.select(X.indented_json([(c, F.col(c), c != "c") for c in "abcd"]).alias("j")).first().j
    assert got == json.dumps({"a": "T1", "b": None, "c": 12.5, "d": 'q"x'}, indent=2)


def test_summary_of_no_rows_is_zeros(spark):
    df = tx_rows(spark, [{}]).where("false")
    r = P.summary(score(df, RuleConfig(), "history")).first()
    assert (r.total, r.flagged, r.ok) == (0, 0, 0)


def test_flagged_sample_in_time_order_not_score_order(spark):
    rows = [{"amount": 5000.0, "ip_country": "US", "user_id": f"U{i}", "timestamp": T0 + timedelta(minutes=10 - i)}
            for i in range(5)]
    rows.append({"amount": 150.0, "ip_country": "US", "user_id": "Z", "timestamp": T0 + timedelta(minutes=20)})
    df = tx_rows(spark, rows)
    s = score(df, RuleConfig(high_amount_threshold=100.0), "history")
    top = P.flagged_sample(s, top_n=3).orderBy("timestamp", "seq").collect()
    assert [r.txn_id for r in top] == ["X0004", "X0003", "X0002"]
    assert top[0].line == f"X0004 | U4 | {top[0].score} | {(T0 + timedelta(minutes=6)).isoformat()}"


def test_explain_payloads(spark):
    cfg = RuleConfig()
    s = score(read_transactions_csv(spark, SAMPLE_CSV), cfg, "history")
    prompts = {r.txn_id: r.prompt for r in E.explain_prompts(s, cfg).collect()}
    assert set(prompts) == {"T002", "T003", "T004"}
    assert '"txn_id": "T002"' in prompts["T002"] and "- HighAmount (+30): Amount 2100.00 >= 2000.0" in prompts["T002"]
    ex = {r.txn_id: r.ai_explanation for r in E.explain_with(s, cfg).collect()}
    assert ex["T004"] == "T004 scored 55 (MEDIUM): HighAmount, BlacklistedMCC"

    def failing(rec):
        if rec["txn_id"] == "T003":
            raise RuntimeError("service down")
        return "  fine  "
    ex = {r.txn_id: r.ai_explanation for r in E.explain_with(s, cfg, failing).collect()}
    assert ex == {"T002": "fine", "T003": X.EXPLANATION_FALLBACK, "T004": "fine"}
    flat = E.attach_explanations(P.flat_detailed(s, cfg).withColumn("seq", F.lit(None).cast("long")), E.explain_with(s, cfg))
    assert set(r.ai_explanation for r in flat.collect()) == {""}
    sp = E.summary_prompt(s, top_n=10).first()
    assert sp.n_flagged_sample == 3 and sp.prompt.count("\n") >= 4
    none = E.summary_prompt(s.where("false")).first()
    assert (none.n_flagged_sample, none.prompt) == (0, X.NO_FLAGGED_TEXT)


def test_display_table_money_and_explanation(spark):
    cfg = RuleConfig()
    s = score(read_transactions_csv(spark, SAMPLE_CSV), cfg, "history")
    flat = P.flat_detailed(s, cfg).withColumn("ai_explanation", F.lit(""))
    d = P.display_table(flat)
    assert d.columns[-1] == "ai_explanation"
    assert {r.txn_id: r.amount for r in d.collect()}["T004"] == "$3,000.00"


@pytest.mark.parametrize("max_dim", [10, 0])
def test_overtime_pay(spark, max_dim):
    from riskloom.config import ExecConfig
    emp = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2"), (None, "n")], "employee_id long, name string")
    pay = spark.createDataFrame([(1, 40.0, 10.0, "x"), (2, 41.0, 10.0, "y"), (1, None, 10.0, "z"),
                                 (None, 1.0, 1.0, "w"), (3, 1.0, 1.0, "v")],
                                "employee_id long, hours_worked double, hourly_rate double, position string")
    key = repr
    got = sorted(((r.employee_id, r.name, r.pay, r.position)
                  for r in overtime_pay(emp, pay, ExecConfig(max_broadcast_dim_rows=max_dim)).collect()), key=key)
    assert got == sorted([(1, "a", 400.0, "x"), (1, "a", None, "z"),
                          (2, "b", 415.0, "y"), (2, "b2", 415.0, "y")], key=key)


def test_in_time_order(spark):
    from riskloom.operators.reports import in_time_order
    rows = [{"timestamp": T0 + timedelta(minutes=m), "user_id": u} for m, u in [(3, "a"), (1, "b"), (1, "c"), (2, "d")]]
    rows.append({"timestamp": None, "user_id": "e"})
    got = [r.user_id for r in in_time_order(tx_rows(spark, rows)).collect()]
    assert got == ["b", "c", "d", "a", "e"]


def test_two_decimal_formats_match_python_on_many_values(spark):
    import random
    rnd = random.Random(0)
    vals = [rnd.uniform(-1e4, 1e4) for _ in range(300)] + [round(rnd.uniform(0, 1000), 3) for _ in range(300)]
    vals += [x + 0.005 for x in range(0, 300)] + [0.125, 0.375, 2.675, 1.005, -0.0, 1e15 + 0.5, 4.5e-3]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for r in df.select("x", X.fixed2(F.col("x")).alias("a"), X.money(F.col("x")).alias("m")).collect():
        assert (r.a, r.m) == (f"{r.x:.2f}", "${:,.2f}".format(r.x)), r.x


def test_templates_render_like_python_format(spark):
    row = {"amount": 2.675, "card": "GB", "ip": None, "mcc": 7995, "count": 4, "user": "U1", "device": None,
           "hour": 3, "name": "NightTime", "points": 10, "details": "Transaction at 03:00"}
    df = spark.createDataFrame([tuple(row.values())],
                               "amount double, card string, ip string, mcc int, count bigint, user string, "
                               "device string, hour int, name string, points int, details string")
    consts = {"threshold": 100.0, "minutes": 1440}
    templates = list(X.DETAIL_TEMPLATES.values()) + [X.HIT_SHORT, X.HIT_DETAILED, X.HIT_BULLET]
    cols = {k: F.col(k) for k in row}
    got = df.select(*[X.render(t, **cols, **consts).alias(f"t{i}") for i, t in enumerate(templates)]).first()
    for i, t in enumerate(templates):
        assert got[f"t{i}"] == t.format(**row, **consts), t


def test_json_strings_escape_like_python(spark):
    import random
    rnd = random.Random(3)
    vals = ["".join(rnd.choice([chr(c) for c in range(128)]) for _ in range(rnd.randrange(0, 10))) for _ in range(200)]
    vals += ['q"x', "a\\b", "\n\t\r\b\f", "/", "\x00\x1f\x7f", "café", "€5", "\U0001F600!", "", "ÿĀ"]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "s string")
    for r in df.select("s", X.json_string(F.col("s")).alias("j")).collect():
        assert r.j == json.dumps(r.s), repr(r.s)


def test_iso_format_like_python_isoformat(spark):
    import random
    from datetime import datetime
    rnd = random.Random(5)
    base = datetime(1960, 1, 1)
    vals = [base + timedelta(microseconds=rnd.randrange(0, 80 * 365 * 86400 * 10**6)) for _ in range(300)]
    vals += [v.replace(microsecond=0) for v in vals[:50]] + [datetime(1969, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(v,) for v in vals], "t timestamp_ntz")
    for r in df.select("t", iso_format("t").alias("s")).collect():
        assert r.s == r.t.isoformat(), r.t


def test_explanations_follow_the_row_and_not_the_txn_id(spark):
    """An OK row that shares its txn_id with a flagged one gets no text; a missing txn_id is written as None."""
    from helpers import NTZ_SCHEMA, T0
    from riskloom.config import RuleConfig
    from riskloom.operators import explain as E
    from riskloom.operators.scoring import score

    rows = [("X", "U1", 9000.0, "GBP", "GB", "US", 4829, "A", T0, 0), ("X", "U2", 1.0, "GBP", "GB", "GB", 5411, "A", T0, 1),
            (None, "U3", 9000.0, "GBP", "GB", "US", 4829, "A", T0, 2)]
    cfg = RuleConfig()
    scored = score(spark.createDataFrame(rows, NTZ_SCHEMA), cfg, "history")
    table = E.explained_table(scored, cfg)
    got = {r.user_id: r.ai_explanation for r in table.collect()}
    assert got["U1"].startswith("X scored ") and got["U2"] == "" and got["U3"].startswith("None scored ")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Join" not in plan and plan.count("Exchange") <= 2
    own = E.explained_table(scored, cfg, lambda row: f"{row['seq']}!")
    assert {r.user_id: r.ai_explanation for r in own.collect()} == {"U1": "0!", "U2": "", "U3": "2!"}
    assert own.columns == table.columns
