"""Explanation payloads for flagged transactions.

The reference hands each flagged transaction to a hosted language model.  Here
that boundary is a caller-supplied Python function, called once a distinct prompt
of the flagged rows, its replies kept in a durable table (:mod:`.replies`);
everything it receives — the transaction as indented JSON, the rule bullets,
score and severity — is built JVM-side.  The default explainer is a
deterministic template; no network client is included.

* :func:`explain_prompts` — U1(a): the prompt text per flagged row.
* :func:`explain_with` — U1(b): ``ai_explanation`` per flagged row from a
  pluggable function; a failing call yields the fallback text, the row stays.
* :func:`summary_prompt`, :func:`summarise` — U2: one row with the prompt over the flagged
  sample, and the text that a caller's function makes of it.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import RuleConfig
from ..functions import text as X
from ..functions.timecols import iso_time
from ..session import materialize
from .replies import ReplyTable, answer
from .reports import flagged, flagged_sample, flat_detailed
from .scoring import with_hits

# The record handed to the explainer (field order of the JSON rendering).
TXN_FIELDS = ("txn_id", "user_id", "amount", "currency", "card_country", "ip_country", "timestamp")


def _txn_json(scored: DataFrame):
    fields = [(f, iso_time(scored) if f == "timestamp" else F.col(f), f != "amount") for f in TXN_FIELDS]
    return X.indented_json(fields)


def explain_inputs(scored: DataFrame, rules: RuleConfig) -> DataFrame:
    """Flagged rows with the explainer's inputs (all JVM-side expressions)."""
    h = with_hits(flagged(scored), rules)
    return h.select(
        "txn_id", "seq", F.col("total_score").alias("score"), "severity",
        _txn_json(scored).alias("txn_json"),
        X.hits_bullets(F.col("rules_triggered")).alias("rules_text"),
        X.hits_names(F.col("rules_triggered")).alias("rule_names"),
    )


def prompt_text(score, severity, txn_json, rules_text):
    return F.concat(
        F.lit("Explain in one to three sentences, for an analyst's screen, why this card transaction "
              "received a risk score of "), score.cast("string"), F.lit(" ("), severity, F.lit(").\n\n"),
        F.lit("Transaction:\n"), txn_json, F.lit("\n\nRules that fired:\n"), rules_text,
        F.lit("\n\nUse only these facts. If they are not conclusive, call the transaction suspicious "
              "and suggest a next step such as verifying the customer's identity."),
    )


def explain_prompts(scored: DataFrame, rules: RuleConfig) -> DataFrame:
    i = explain_inputs(scored, rules)
    return i.select("txn_id", prompt_text(F.col("score"), F.col("severity"), F.col("txn_json"),
                                          F.col("rules_text")).alias("prompt"))


def template_explainer(row: dict) -> str:
    """Default explainer: ``<txn> scored <score> (<severity>): <rules>``."""
    names = row.get("rule_names") or "no rules triggered"
    return f"{row['txn_id']} scored {row['score']} ({row['severity']}): {names}"


def template_text(txn_id, score, severity, rule_names):
    """The default explanation as a column (missing values as ``None``, like :func:`template_explainer`)."""
    names = F.when(rule_names == "", F.lit("no rules triggered")).otherwise(rule_names)
    return F.concat(X.py_str(txn_id), F.lit(" scored "), X.py_str(score), F.lit(" ("), X.py_str(severity), F.lit("): "),
                    F.coalesce(names, F.lit("no rules triggered")))


def explain_with(scored: DataFrame, rules: RuleConfig,
                 explainer: Callable[[dict], str] = template_explainer,
                 replies: ReplyTable | None = None) -> DataFrame:
    """``txn_id, seq, ai_explanation`` for the flagged rows.

    The default template is one ``concat``; only a caller's function runs in Python.  Its replies are
    kept in ``replies`` (default: a new table in the checkpoint folder), so a prompt is asked once.
    """
    if explainer is template_explainer:
        return explain_inputs(scored, rules).select("txn_id", "seq", template_text(
            F.col("txn_id"), F.col("score"), F.col("severity"), F.col("rule_names")).alias("ai_explanation"))
    rows = explain_inputs(scored, rules).withColumn("prompt", F.coalesce(prompt_text(
        X.py_str(F.col("score")), X.py_str(F.col("severity")), F.col("txn_json"), F.col("rules_text")), F.lit("")))
    rows = materialize(rows, "to-explain")      # read by the calls and by the join that follows
    return answer(rows, explainer, X.EXPLANATION_FALLBACK, replies, reply_col="ai_explanation", key_col="seq").select(
        "txn_id", "seq", "ai_explanation")


def explained_table(scored: DataFrame, rules: RuleConfig,
                    explainer: Callable[[dict], str] = template_explainer,
                    replies: ReplyTable | None = None) -> DataFrame:
    """The flat detailed table with ``ai_explanation``: the row's own text where it is flagged, else ``''``.

    The default template is part of the one projection.  With a caller's function the scored
    rows are written once, flagged ones go through it, and texts come back by ``seq``, which is unique
    where a txn_id may repeat.
    """
    if explainer is template_explainer:
        text = F.when(F.col("status") == C.STATUS_FLAG, template_text(
            F.col("txn_id"), F.col("total_score"), F.col("severity"), X.hits_names(F.col("rules_triggered")))
        ).otherwise(F.lit(""))
        return flat_detailed(scored, rules, keep_rule_objects=False, extra={"ai_explanation": text})
    scored = materialize(scored, "scored")
    flat = flat_detailed(scored, rules, keep_rule_objects=False, extra={"__row": F.col("seq")})
    texts = explain_with(scored, rules, explainer, replies).select(F.col("seq").alias("__row"), "ai_explanation")
    return flat.join(texts, "__row", "left").drop("__row").withColumn(
        "ai_explanation", F.coalesce("ai_explanation", F.lit("")))


def attach_explanations(flat: DataFrame, explanations: DataFrame) -> DataFrame:
    """Left-join explanations onto a flat table; rows that are not flagged get ``''``.

    Joined by ``seq`` where the flat table has it, else by ``txn_id`` (one
    explanation a transaction id, so rows are never multiplied).
    """
    key = "seq" if "seq" in flat.columns else "txn_id"
    e = explanations.groupBy(F.col(key).alias("__ekey")).agg(F.min("ai_explanation").alias("ai_explanation"))
    out = flat.join(e, flat[key] == e["__ekey"], "left").drop("__ekey")
    return out.withColumn("ai_explanation", F.when(F.col("status") == C.STATUS_FLAG, F.coalesce(
        F.col("ai_explanation"), F.lit(""))).otherwise(F.lit("")))


def summary_prompt(scored: DataFrame, top_n: int = 10, facts: tuple[str, ...] = ()) -> DataFrame:
    """One row — the fallback text, or a prompt over the first ``top_n`` flagged lines.

    ``facts``: further columns about the sample, of ``n_users``, ``min_score``, ``max_score`` and ``lines``.
    """
    sample = flagged_sample(scored, top_n)
    agg = sample.agg(
        F.count(F.lit(1)).alias("n_flagged_sample"), F.count_distinct("user_id").alias("n_users"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("timestamp", "seq", "line"))),
                                 lambda s: s["line"]), "\n").alias("lines"),
    )
    prompt = F.concat(
        F.lit("Below is a sample of flagged card transactions (txn | user | score | timestamp). In two to four "
              "sentences describe the patterns you see (for example cross-border use, large amounts, new devices "
              "or bursts of activity) and propose up to three follow-up checks.\n\n"),
        F.col("lines"))
    return agg.select("n_flagged_sample", *facts,
                      F.when(F.col("n_flagged_sample") == 0, F.lit(X.NO_FLAGGED_TEXT)).otherwise(prompt)
                      .alias("prompt"))


SUMMARY_FACTS = ("n_users", "min_score", "max_score", "lines")


def template_summariser(sample: dict) -> str:
    """Default summary: how many flagged transactions, of how many users, with which scores."""
    return (f"{sample['n_flagged_sample']} flagged transactions of {sample['n_users']} users, "
            f"scores {sample['min_score']} to {sample['max_score']}.")


def summarise(scored: DataFrame, summariser: Callable[[dict], str] = template_summariser, top_n: int = 10,
              replies: ReplyTable | None = None) -> DataFrame:
    """One row ``n_flagged_sample, summary``; the function gets the bounded sample's lines and prompt.

    Without flagged rows it is not called and the summary says so; where it fails, the fallback text stands.
    """
    row = materialize(summary_prompt(scored, top_n, SUMMARY_FACTS), "summary-prompt")
    some = row.where(F.col("n_flagged_sample") > 0)
    told = answer(some, summariser, X.EXPLANATION_FALLBACK, replies, reply_col="summary")
    none = row.where(F.col("n_flagged_sample") == 0).withColumn("summary", F.lit(X.NO_FLAGGED_TEXT))
    return told.unionByName(none).select("n_flagged_sample", "summary")
