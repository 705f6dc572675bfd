"""Registered queries: name -> ``fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (``events`` mapped to transactions,
``supplier``/``lineitem`` mapped to employees/payroll) in full and is lazy,
except for the small eager steps a query needs to choose a safe physical plan
(bounded counts before broadcasts, hot-key detection, reliable checkpoints).
Oracle SQL for each name lives in :mod:`riskloom.plans.oracle`.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_EXEC, EVENTS_RULES, SKEWPROOF_EXEC, ExecConfig, RuleConfig
from ..functions import rules as R
from ..operators import explain as E
from ..operators import reports as P
from ..operators.blacklist import LISTED, with_listed
from ..operators.payroll import overtime_pay
from ..operators.scoring import hits_long, score, scored_table
from ..operators.slices import SliceScorer, write_by_day
from ..functions.timecols import iso_format, iso_time, offset_text
from ..sources.csv import (read_transactions_checked, read_transactions_csv, read_transactions_strict,
                           read_transactions_upload, upload_missing_to_nan)
from ..sources.sinks import CSV_MICROS_OPTIONS, publish_scored, read_published, read_scored_csv, write_scored
from ..schema import RULE_POINT_COLUMNS, SCORED_HISTORY_COLUMNS, SCORED_WINDOW_COLUMNS, SEQ, TRANSACTION_COLUMNS
from ..sources.tables import employees_from_supplier, events_inputs, payroll_from_lineitem, transactions_from_events

QueryFn = Callable[[SparkSession, str], DataFrame]

RULES: RuleConfig = EVENTS_RULES
W, H = C.DIALECT_WINDOW, C.DIALECT_HISTORY
MCC_TEXT = " 5411, 4829,, "


def _tx(spark: SparkSession, sf_dir: str, exec_cfg: ExecConfig = DEFAULT_EXEC) -> DataFrame:
    return transactions_from_events(spark, sf_dir, exec_cfg)


def _scored(spark, sf_dir, dialect, exec_cfg: ExecConfig = DEFAULT_EXEC) -> DataFrame:
    """Score the events table; hot users are detected on raw events (see ``events_inputs``)."""
    inp = events_inputs(spark, sf_dir, exec_cfg)
    return score(inp["tx"], RULES, dialect, exec_cfg, inp["key_counts"], inp["rows_upper_bound"], inp["split"])


def transactions(spark, sf_dir):
    return _tx(spark, sf_dir)


def _rule_query(point_col: str):
    def q(spark, sf_dir):
        tx = _tx(spark, sf_dir)
        exprs = {
            "r_high_amount": R.high_amount_points(F.col("amount"), RULES.high_amount_threshold, W),
            "r_country_mismatch": R.country_mismatch_points(F.col("card_country"), F.col("ip_country"), W),
            "r_blacklisted_mcc": R.blacklisted_mcc_points(F.col("merchant_mcc"), RULES.blacklisted_mcc),
            "r_night_time": R.night_time_points(F.col("timestamp")),
        }
        return tx.select("txn_id", exprs[point_col].alias("points"))
    q.__name__ = f"rule_{point_col[2:]}"
    return q


def rule_country_mismatch_upload(spark, sf_dir):
    up = upload_missing_to_nan(_tx(spark, sf_dir))
    return up.select("txn_id", "card_country", "ip_country",
                     R.country_mismatch_points(F.col("card_country"), F.col("ip_country"), H).alias("points"))


def velocity_window(spark, sf_dir):
    return _scored(spark, sf_dir, W).select("txn_id", "txn_count_window", "r_high_velocity")


def velocity_history(spark, sf_dir):
    return _scored(spark, sf_dir, H).select("txn_id", "txn_count_window", "r_high_velocity")


def new_device_window(spark, sf_dir):
    return _scored(spark, sf_dir, W).select("txn_id", "first_seen_device", "r_new_device")


def new_device_history(spark, sf_dir):
    return _scored(spark, sf_dir, H).select("txn_id", "r_new_device")


def score_window(spark, sf_dir):
    return _scored(spark, sf_dir, W).select(*SCORED_WINDOW_COLUMNS)


def score_history(spark, sf_dir):
    return _scored(spark, sf_dir, H).select(*SCORED_HISTORY_COLUMNS)


def score_window_skewproof(spark, sf_dir):
    """Every user through the skew-proof strategy (as if every user were hot)."""
    return scored_table(_tx(spark, sf_dir, SKEWPROOF_EXEC), RULES, W, SKEWPROOF_EXEC)


def score_history_skewproof(spark, sf_dir):
    return scored_table(_tx(spark, sf_dir, SKEWPROOF_EXEC), RULES, H, SKEWPROOF_EXEC)


def score_window_csv_sink(spark, sf_dir):
    """The 20-column table through the CSV sink (in the checkpoint folder) and back."""
    from ..session import ensure_checkpoint_dir
    import uuid
    scored = score_window(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskloom-csv-{uuid.uuid4().hex}"
    write_scored(scored, path, options=CSV_MICROS_OPTIONS)  # the events carry microseconds
    return read_scored_csv(spark, path, scored.schema, CSV_MICROS_OPTIONS)


def _score_through_csv(spark, sf_dir, read) -> DataFrame:
    """History scores of the transactions written as CSV (in the checkpoint folder) and read back by ``read``.

    Arrival order is the event id again: several files have no order of their own.
    """
    from ..session import ensure_checkpoint_dir
    import uuid
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskloom-tx-{uuid.uuid4().hex}"
    write_scored(_tx(spark, sf_dir).select(*TRANSACTION_COLUMNS), path, options=CSV_MICROS_OPTIONS)
    tx = read(spark, path).withColumn(SEQ, F.col("txn_id").cast("long"))
    return score(tx, RULES, H).select("txn_id", "user_id", "amount", "card_country", "ip_country", "merchant_mcc",
                                      "device_id", iso_format("timestamp").alias("ts_text"), *RULE_POINT_COLUMNS,
                                      "total_score", "severity", "status")


def score_csv_permissive(spark, sf_dir):
    """S1."""
    return _score_through_csv(spark, sf_dir, read_transactions_csv)


def score_csv_strict(spark, sf_dir):
    """Missing text fields read as ''."""
    return _score_through_csv(spark, sf_dir, read_transactions_strict)


def score_csv_upload(spark, sf_dir):
    """S3: missing text fields read as 'nan'."""
    return _score_through_csv(spark, sf_dir, read_transactions_upload)


def score_csv_offsets(spark, sf_dir):
    """Times written with offsets from -03:00 to +03:00, read back, scored, and told with their own."""
    import uuid

    from ..session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskloom-offsets-{uuid.uuid4().hex}"
    tx = _tx(spark, sf_dir)
    offset = ((F.col(SEQ) % 5 - 2) * 5400).cast("int")
    there = F.timestamp_add("SECOND", offset, F.col("timestamp"))
    text = F.concat(iso_format(there), F.when(offset == 0, F.lit("Z")).otherwise(offset_text(offset)))
    write_scored(tx.withColumn("timestamp", text).select(*TRANSACTION_COLUMNS), path)
    back = read_transactions_strict(spark, path).withColumn(SEQ, F.col("txn_id").cast("long"))
    scored = score(back, RULES, H)
    return scored.select("txn_id", iso_time(scored).alias("ts_text"), "txn_count_window", "r_night_time", "r_new_device",
                         "total_score", "severity", "status")


def score_csv_quoted(spark, sf_dir):
    """S2 with line breaks, quotes and commas inside fields: one file's records are put together from its splits."""
    import uuid

    from ..session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskloom-quoted-{uuid.uuid4().hex}"
    odd = F.concat(F.col("device_id"), F.lit('\n"a, b",\n'), F.col("txn_id"))
    tx = _tx(spark, sf_dir).withColumn("device_id", F.when(F.col(SEQ) % 3 == 0, odd).otherwise(F.col("device_id")))
    write_scored(tx.select(*TRANSACTION_COLUMNS), path, options={**CSV_MICROS_OPTIONS, "escape": '"'})
    back = read_transactions_strict(spark, path).withColumn(SEQ, F.col("txn_id").cast("long"))
    return score(back, RULES, H).select("txn_id", "user_id", "amount", "device_id", "txn_count_window", "r_new_device",
                                        "total_score", "status")


def score_history_ordered(spark, sf_dir):
    """O1: the history table with each row's place in time order."""
    return P.with_position(_scored(spark, sf_dir, H)).select("position", *SCORED_HISTORY_COLUMNS)


def rule_mcc_from_text(spark, sf_dir):
    """the blacklist rule with codes parsed from text."""
    codes = C.parse_mcc_list(MCC_TEXT)
    return _tx(spark, sf_dir).select("txn_id", "merchant_mcc",
                                     R.blacklisted_mcc_points(F.col("merchant_mcc"), codes).alias("points"))


def mcc_table(spark, sf_dir) -> DataFrame:
    """A code table with validity times out of the transactions: each rarer code for two stretches of the data's span.

    The second stretch stands in two overlapping rows; a NULL code and an empty interval are in it too.
    """
    tx = _tx(spark, sf_dir).where(F.col("merchant_mcc") != 5411)
    spans = tx.groupBy(F.col("merchant_mcc").alias("mcc")).agg(
        F.date_trunc("DAY", F.min("timestamp")).cast("timestamp_ntz").alias("t"))

    def day(n):
        return F.timestamp_add("DAY", F.lit(n), F.col("t"))

    null_time = F.lit(None).cast("timestamp_ntz")
    rows = F.array(*[F.struct(code.alias("mcc"), a.alias("valid_from"), b.alias("valid_to")) for code, a, b in (
        (F.col("mcc"), day(1), day(5)), (F.col("mcc"), day(9), day(14)), (F.col("mcc"), day(12), null_time),
        (F.lit(None).cast("int"), null_time, null_time), (F.lit(5411), day(4), day(2)))])
    return spans.select(F.explode(rows).alias("r")).select("r.*")


def rule_mcc_table(spark, sf_dir):
    """R3 with the blacklist as a table of codes and validity times."""
    listed = with_listed(_tx(spark, sf_dir), mcc_table(spark, sf_dir))
    return listed.select("txn_id", "merchant_mcc", R.listed_mcc_points(F.col(LISTED)).alias("points"))


def score_mcc_table(spark, sf_dir):
    """The history scores with the blacklist as a table."""
    inp = events_inputs(spark, sf_dir)
    return score(inp["tx"], RULES, H, DEFAULT_EXEC, inp["key_counts"], inp["rows_upper_bound"], inp["split"],
                 mcc_table(spark, sf_dir)).select(*SCORED_HISTORY_COLUMNS)


def _scratch(spark, label: str) -> str:
    import uuid

    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskloom-{label}-{uuid.uuid4().hex}"


def score_sink_summary(spark, sf_dir):
    """S4 and A1 in one job: the counts observed on the write, and the rows that the published table holds."""
    path = _scratch(spark, "published")
    scored = score_window(spark, sf_dir)
    counts = publish_scored(scored, path, options=CSV_MICROS_OPTIONS)
    back = read_published(spark, path, scored.schema, options=CSV_MICROS_OPTIONS)
    return back.agg(F.count(F.lit(1)).alias("stored")).select(
        *[F.lit(counts[k]).cast("long").alias(k) for k in ("total", "flagged", "ok")], "stored")


def csv_path_order(spark, sf_dir):
    """The transactions in several CSV files, numbered like the rows of one file."""
    path = _scratch(spark, "ordered-csv")
    ordered = _tx(spark, sf_dir).repartitionByRange(10, SEQ).sortWithinPartitions(SEQ)
    write_scored(ordered.select(*TRANSACTION_COLUMNS), path, options=CSV_MICROS_OPTIONS)
    return read_transactions_csv(spark, path, in_path_order=True).select("txn_id", SEQ)


def _checked(spark, sf_dir):
    """The checked reader over the transactions with every third row spoilt in one of five ways."""
    path = _scratch(spark, "checked-csv")
    tx = _tx(spark, sf_dir)
    cols = [F.coalesce((iso_format("timestamp") if c == "timestamp" else F.col(c)).cast("string"), F.lit(""))
            for c in TRANSACTION_COLUMNS]
    at = {c: i for i, c in enumerate(TRANSACTION_COLUMNS)}
    way = F.when(F.col(SEQ) % 3 == 0, F.col(SEQ) % 5).otherwise(-1)
    for name, k, text in (("amount", 0, "twelve"), ("merchant_mcc", 1, "grocer"), ("timestamp", 2, "yesterday")):
        cols[at[name]] = F.when(way == k, F.lit(text)).otherwise(cols[at[name]])
    line = F.concat_ws(",", *cols)
    line = F.when(way == 3, F.concat(line, F.lit(",more"))).when(
        way == 4, F.concat_ws(",", *cols[:4])).otherwise(line)
    # every file needs a header line of its own: the text sink has none, the CSV sink would quote the commas
    parts = tx.select(line.alias("value")).repartition(8).mapInPandas(_with_header(",".join(TRANSACTION_COLUMNS)),
                                                                      "value string")
    parts.write.text(path)
    return read_transactions_checked(spark, path)


def _with_header(header: str):
    def run(batches):
        import pandas as pd

        yield pd.DataFrame({"value": [header]})
        yield from batches
    return run


def csv_rejects(spark, sf_dir):
    """The rejected rows (first field of the raw line) and the reasons."""
    return _checked(spark, sf_dir)[1].select(F.substring_index("raw", ",", 1).alias("txn_id"), "reason")


def csv_checked(spark, sf_dir):
    """The rows that the checked reader keeps."""
    return _checked(spark, sf_dir)[0].select("txn_id", "user_id", "amount", "merchant_mcc", "device_id")


def score_console(spark, sf_dir):
    return P.console_view(_scored(spark, sf_dir, W))


def rule_hits(spark, sf_dir):
    return hits_long(_scored(spark, sf_dir, H), RULES)


def nested_results(spark, sf_dir):
    """S6 with the ordered hit list as JSON text (nested values compare reliably as text)."""
    n = P.nested_results(_scored(spark, sf_dir, H), RULES)
    return n.withColumn("rules_triggered", F.to_json("rules_triggered"))


def result_flat_short(spark, sf_dir):
    return P.flat_short(_scored(spark, sf_dir, H), RULES)


def result_flat_detailed(spark, sf_dir):
    return P.flat_detailed(_scored(spark, sf_dir, H), RULES, keep_rule_objects=False)


def result_display(spark, sf_dir):
    return P.display_table(P.flat_detailed(_scored(spark, sf_dir, H), RULES, keep_rule_objects=False))


def result_explained(spark, sf_dir):
    """The detailed flat table of all rows with ``ai_explanation``: the template's text on flagged rows, else ''."""
    return E.explained_table(_scored(spark, sf_dir, H), RULES)


def result_explained_calls(spark, sf_dir):
    """U1(b): the explained table with the texts of a Python function, called once a distinct prompt."""
    return E.explained_table(_scored(spark, sf_dir, H), RULES, explainer=lambda row: E.template_explainer(row))


def summary_text(spark, sf_dir):
    """The summariser's text over the flagged sample."""
    return E.summarise(_scored(spark, sf_dir, H), top_n=10)


def summary(spark, sf_dir):
    return P.summary(_scored(spark, sf_dir, H))


def summary_window(spark, sf_dir):
    return P.summary(_scored(spark, sf_dir, W))


def flagged_sample(spark, sf_dir):
    return P.flagged_sample(_scored(spark, sf_dir, H), top_n=10)


def explain_prompt(spark, sf_dir):
    return E.explain_prompts(_scored(spark, sf_dir, H), RULES)


def explain_template(spark, sf_dir):
    return E.explain_with(_scored(spark, sf_dir, H), RULES)


def summary_prompt(spark, sf_dir):
    return E.summary_prompt(_scored(spark, sf_dir, H), top_n=10)


def stream_score_history(spark, sf_dir):
    """The events table as a file stream through the stateful online scorer (availableNow)."""
    from ..streaming.runner import score_events_stream_table
    return score_events_stream_table(spark, sf_dir, RULES)


def stream_score_window(spark, sf_dir):
    """The window dialect as a stream: rows wait until their whole second has passed."""
    from ..streaming.runner import score_events_stream_table
    return score_events_stream_table(spark, sf_dir, RULES, dialect=W)


def _score_slices(spark, sf_dir, dialect, columns, slices: int = 4) -> DataFrame:
    """The events table partitioned by day and scored in a few slices of days, one after the other."""
    table = _scratch(spark, "by-day")
    write_by_day(_tx(spark, sf_dir), table, dialect)
    scorer = SliceScorer(table, _scratch(spark, "slices"), RULES, dialect)
    days = scorer.days(spark)
    step = max(-(-len(days) // slices), 1)
    for i in range(0, len(days), step):
        scorer.score_days(spark, days[i], days[min(i + step, len(days)) - 1])
    scorer.finish(spark)
    return scorer.scores(spark).select(*columns)


def score_history_slices(spark, sf_dir):
    return _score_slices(spark, sf_dir, H, SCORED_HISTORY_COLUMNS)


def score_window_slices(spark, sf_dir):
    return _score_slices(spark, sf_dir, W, SCORED_WINDOW_COLUMNS)


def overtime_pay_query(spark, sf_dir):
    return overtime_pay(employees_from_supplier(spark, sf_dir), payroll_from_lineitem(spark, sf_dir))


def registry() -> dict[str, QueryFn]:
    q: dict[str, QueryFn] = {
        "transactions": transactions,
        "rule_high_amount": _rule_query("r_high_amount"),
        "rule_country_mismatch": _rule_query("r_country_mismatch"),
        "rule_blacklisted_mcc": _rule_query("r_blacklisted_mcc"),
        "rule_night_time": _rule_query("r_night_time"),
        "rule_country_mismatch_upload": rule_country_mismatch_upload,
        "velocity_window": velocity_window,
        "velocity_history": velocity_history,
        "new_device_window": new_device_window,
        "new_device_history": new_device_history,
        "score_window": score_window,
        "score_history": score_history,
        "score_window_skewproof": score_window_skewproof,
        "score_history_skewproof": score_history_skewproof,
        "score_console": score_console,
        "score_window_csv_sink": score_window_csv_sink,
        "score_csv_permissive": score_csv_permissive,
        "score_csv_strict": score_csv_strict,
        "score_csv_upload": score_csv_upload,
        "score_csv_offsets": score_csv_offsets,
        "score_csv_quoted": score_csv_quoted,
        "score_history_ordered": score_history_ordered,
        "rule_mcc_from_text": rule_mcc_from_text,
        "rule_mcc_table": rule_mcc_table,
        "score_mcc_table": score_mcc_table,
        "score_sink_summary": score_sink_summary,
        "csv_path_order": csv_path_order,
        "csv_rejects": csv_rejects,
        "csv_checked": csv_checked,
        "rule_hits": rule_hits,
        "nested_results": nested_results,
        "result_flat_short": result_flat_short,
        "result_flat_detailed": result_flat_detailed,
        "result_display": result_display,
        "result_explained": result_explained,
        "result_explained_calls": result_explained_calls,
        "summary_text": summary_text,
        "summary": summary,
        "summary_window": summary_window,
        "flagged_sample": flagged_sample,
        "explain_prompt": explain_prompt,
        "explain_template": explain_template,
        "summary_prompt": summary_prompt,
        "overtime_pay": overtime_pay_query,
        "stream_score_history": stream_score_history,
        "stream_score_window": stream_score_window,
        "score_history_slices": score_history_slices,
        "score_window_slices": score_window_slices,
    }
    return q
