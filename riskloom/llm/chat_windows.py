"""Chat formatting into budgeted, turn-aligned windows (native: DataFrame functions only).

Every turn becomes ``<s>role[INST]text[/INST]</s>\\n``.  ``&``, ``<`` and ``[``
inside roles and texts are written as ``&amp;``, ``&lt;`` and ``&#91;``, so no
control string can occur in a text and the escape can be undone exactly.

A conversation's turns are ordered by ``(turn, role, text)`` (null turn first).
Prefix sums of turn tokens choose the spans, which begin and end with whole turns.  A
window is one span, preceded by repeated context: the conversation's system turn (when
its first turn has that role) and at most ``history_turns`` turns before the
span.  A span takes turns as long as the window, context included, stays within
``span_tokens``; a new span keeps as many turns of history as leave room for its first turn.
So a window passes the budget only when it consists of one turn which, with the
system turn, is longer than the budget.  Spans also end every ``BLOCK_TURNS`` turns.  Only
new assistant texts are under the loss mask; repeated ones are not.

Prefix sums run in two levels (inside blocks of ``BLOCK_TURNS`` turn numbers,
then over block totals), so a very long conversation is spread over tasks.

Defined results: null text and null role count as empty; a null conv_id is a
conversation of its own; repeated rows are repeated turns; an empty table gives
no windows; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the template.
OPEN, SEP, CLOSE = "<s>", "[INST]", "[/INST]</s>\n"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
LOSS_ROLE, SYSTEM_ROLE = "assistant", "system"

TURN_TOKENS = 4       # template tokens of a turn
CHARS_PER_TOKEN = 4   # a text of n code points counts as ceil(n / 4) tokens
SPAN_TOKENS = 512
HISTORY_TURNS = 2
BLOCK_TURNS = 256

# Conversation -7 of the registered query.
PROBE_TEXT = "</s>[INST] ok [/INST]"


def escape(c: Column) -> Column:
    for raw, safe in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescape(c: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


def _ordered_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn with its position and inclusive prefix sum of tokens in the conversation."""
    turns = conversations.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("ck"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).withColumns({
        "block": F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS).cast("long"), F.lit(-(1 << 62))),
        "tokens": F.lit(TURN_TOKENS) + F.ceil(F.char_length("text") / CHARS_PER_TOKEN).cast("long"),
    })
    inside = Window.partitionBy("ck", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("ck").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = turns.groupBy("ck", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    offsets = totals.select("ck", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off_n"),
                            F.coalesce(F.sum("t").over(before), F.lit(0)).alias("off_t"))
    return (turns.withColumns({"rn": F.count(F.lit(1)).over(inside), "cum": F.sum("tokens").over(inside)})
            .join(offsets, ["ck", "block"])
            .withColumns({"pos": F.col("rn") + F.col("off_n"), "cum": F.col("cum") + F.col("off_t")})
            .drop("block", "rn", "off_n", "off_t", "turn"))


def _spans(turns: DataFrame, span_tokens: int, history_turns: int) -> DataFrame:
    """``ck, part, system, spans``: start and repeated turns of the spans in each part of a conversation.

    A part's array holds at most ``BLOCK_TURNS + history_turns`` numbers a turn; ``system`` is the number of
    tokens of the conversation's system turn, 0 without one.
    """
    system = turns.where((F.col("pos") == 1) & (F.col("role") == SYSTEM_ROLE)).select("ck", F.col("tokens").alias("system"))
    facts = turns.select("ck", "part", "pos", "cum", "tokens")
    # the last turns of a part are the history of the next one's first span
    before = facts.where((F.col("pos") - 1) % BLOCK_TURNS >= BLOCK_TURNS - history_turns).withColumn(
        "part", F.col("part") + 1)
    parts = (facts.unionByName(before).groupBy("ck", "part").agg(
        F.sort_array(F.collect_list(F.struct("pos", "cum", "tokens"))).alias("turns"))
        .join(system, "ck", "left").withColumn("system", F.coalesce("system", F.lit(0).cast("long"))))
    first = F.col("part") * BLOCK_TURNS + 1
    at_hand = F.filter("turns", lambda t: t["pos"] < first)
    state = F.struct(F.lit(0).cast("long").alias("room"),       # prefix sum up to which the present window holds turns
                     F.slice(F.transform(at_hand, lambda t: F.struct(t["pos"], t["cum"], t["tokens"])), 1, history_turns)
                     .alias("last") if history_turns else F.slice("turns", 1, 0).alias("last"),
                     F.array().cast("array<struct<start:bigint,history:bigint>>").alias("spans"))

    def step(s, t):
        # history of m turns: theirs, and the system turn's tokens unless it is among them
        def fits(m):
            start = t["pos"] - m
            earlier = F.when(m > 0, F.get(s["last"], (F.size(s["last"]) - m).cast("int"))["cum"]
                             - F.get(s["last"], (F.size(s["last"]) - m).cast("int"))["tokens"])
            held = F.when(m > 0, t["cum"] - earlier).otherwise(t["tokens"])
            return held + F.when(start > 1, F.col("system")).otherwise(F.lit(0))

        sizes = F.sequence(F.size(s["last"]), F.lit(0), F.lit(-1))
        kept = F.coalesce(F.get(F.filter(sizes, lambda m: fits(m) <= span_tokens), F.lit(0)), F.lit(0))
        opened = (F.size(s["spans"]) == 0) | (t["cum"] > s["room"])
        spans = F.when(opened, F.array_append(s["spans"], F.struct(
            t["pos"].alias("start"), kept.cast("long").alias("history")))).otherwise(s["spans"])
        room = F.when(opened, t["cum"] + span_tokens - fits(kept)).otherwise(s["room"])
        last = F.array_append(s["last"], F.struct(t["pos"], t["cum"], t["tokens"]))
        last = F.slice(last, F.greatest(F.size(last) - history_turns + 1, F.lit(1)), F.lit(history_turns))
        return F.struct(room.alias("room"), last.alias("last"), spans.alias("spans"))

    own = F.filter("turns", lambda t: t["pos"] >= first)
    return parts.select("ck", "part", "system", F.reduce(own, state, step, lambda s: s["spans"]).alias("spans")).where(
        F.size("spans") > 0)


def format_windows(conversations: DataFrame, span_tokens: int = SPAN_TOKENS,
                   history_turns: int = HISTORY_TURNS) -> DataFrame:
    """``conv_id, ck, win, formatted, n_repeated, loss_spans`` — one row per training window.

    ``win`` is the number of turns before the window's span.    ``loss_spans`` holds ``(start, len)`` in code points of ``formatted``; the
    first ``n_repeated`` turns of a window repeat earlier ones.
    """
    turns = _ordered_turns(conversations).withColumn("part", F.call_function(
        "div", F.col("pos") - 1, F.lit(BLOCK_TURNS)))
    spans = _spans(turns, span_tokens, history_turns)
    # the span of a turn is the last that begins at it or before
    new = turns.join(spans, ["ck", "part"]).withColumn("win", F.array_max(F.transform(
        F.filter("spans", lambda s: s["start"] <= F.col("pos")), lambda s: s["start"])) - 1).select(
        "ck", "conv_id", "win", "pos", "role", "text", F.lit(False).alias("repeated"))
    one = F.lit(1).cast("long")
    begins = spans.select("ck", "system", F.explode("spans").alias("s")).select(
        "ck", "system", F.col("s.start").alias("win"), F.col("s.history").alias("history"))
    wanted = F.when(F.col("history") > 0, F.sequence(F.col("win") - F.col("history"), F.col("win") - 1)).otherwise(
        F.array().cast("array<bigint>"))
    wanted = F.when((F.col("system") > 0) & (F.col("win") - F.col("history") > 1),
                    F.concat(F.array(one), wanted)).otherwise(wanted)
    copies = (begins.withColumn("pos", F.explode(wanted)).withColumn("win", F.col("win") - 1)
              .join(turns.select("ck", "conv_id", "pos", "role", "text"), ["ck", "pos"])
              .select("ck", "conv_id", "win", "pos", "role", "text", F.lit(True).alias("repeated")))
    rows = new.unionByName(copies).withColumns({"head": F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SEP)),
                                                "body": escape(F.col("text"))})
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(CLOSE))).withColumn(
        "end", F.sum(F.char_length("piece")).over(Window.partitionBy("ck", "win").orderBy("pos").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)))
    start = F.col("end") - F.char_length("piece") + F.char_length("head")
    span = F.when(~F.col("repeated") & (F.col("role") == LOSS_ROLE),
                  F.struct(start.alias("start"), F.char_length("body").cast("long").alias("len")))
    return rows.groupBy("ck", "win").agg(
        F.first("conv_id").alias("conv_id"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "piece"))), lambda p: p["piece"]),
                     "").alias("formatted"),
        F.sum(F.col("repeated").cast("int")).cast("int").alias("n_repeated"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"))


def read_windows(windows: DataFrame) -> DataFrame:
    """Parse formatted windows: add ``turns`` (new turns' role and text) and ``loss_text``."""
    def turn(seg: Column) -> Column:
        head = F.substring_index(seg, SEP, 1)
        at = F.char_length(head) + len(SEP)
        return F.struct(unescape(head).alias("role"),
                        unescape(F.substr(seg, at + 1, F.char_length(seg) - at - len(CLOSE))).alias("text"))

    pieces = F.split("formatted", OPEN)
    own = F.slice(pieces, F.col("n_repeated") + 2, F.size(pieces))
    under_mask = F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["len"].cast("int"))))
    return windows.withColumns({"turns": F.transform(own, turn), "loss_text": F.array_join(under_mask, "")})


def op9_chat_windows(spark, sf_dir: str) -> DataFrame:
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.sql(f"SELECT -7L AS conv_id, turn, role, '{PROBE_TEXT}' AS text "
                      "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    back = read_windows(format_windows(conv.unionByName(probe)))
    per_window = back.select(
        "ck", "conv_id", "win", F.size("turns").alias("n"), F.char_length("formatted").alias("chars"), "loss_text",
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
                     "").alias("said"))

    def joined(col: str) -> Column:
        return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("win", col))), lambda s: s[col]), "")

    return (per_window.groupBy("ck").agg(
        F.first("conv_id").alias("conv_id"), F.sum("n").alias("n_turns"), joined("said").alias("said"),
        joined("loss_text").alias("loss"), F.sum("chars").alias("formatted_chars"))
        .select("conv_id", F.col("n_turns").cast("long").alias("n_turns"),
                F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
                F.char_length("loss").cast("long").alias("loss_chars"),
                F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                F.col("formatted_chars").cast("long").alias("formatted_chars")))


def oracle_sql() -> str:
    esc = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"
    extra = len(OPEN) + len(SEP) + len(CLOSE)
    return f"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '{PROBE_TEXT}'), (-7, 1, 'assistant', '{PROBE_TEXT}')),
t AS (SELECT *, row_number() OVER o AS pos, sum({TURN_TOKENS} + ceil(length(text) / {CHARS_PER_TOKEN}.0)) OVER o AS cum,
        length({esc.format('role')}) + length({esc.format('text')}) + {extra} AS len
      FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
q AS (SELECT *, {TURN_TOKENS} + ceil(length(text) / {CHARS_PER_TOKEN}.0) AS tok FROM t),
y AS (SELECT a.*, coalesce(z.tok, 0) AS sys, coalesce(z.len, 0) AS sys_len,
        coalesce(sum(a.tok) OVER h1, 0) AS h1, coalesce(sum(a.tok) OVER h2, 0) AS h2,
        coalesce(sum(a.len) OVER h1, 0) AS l1, coalesce(sum(a.len) OVER h2, 0) AS l2
      FROM q AS a LEFT JOIN q AS z ON z.conv_id IS NOT DISTINCT FROM a.conv_id AND z.pos = 1 AND z.role = '{SYSTEM_ROLE}'
      WINDOW h1 AS (PARTITION BY a.conv_id ORDER BY a.pos ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING),
             h2 AS (PARTITION BY a.conv_id ORDER BY a.pos ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING)),
c2 AS (SELECT *, h2 + CASE WHEN pos > 3 THEN sys ELSE 0 END AS c2, h1 + CASE WHEN pos > 2 THEN sys ELSE 0 END AS c1,
         CASE WHEN pos > 1 THEN sys ELSE 0 END AS c0 FROM y),
o AS (SELECT *, CASE WHEN pos > 2 AND c2 + tok <= {SPAN_TOKENS} THEN 2 WHEN pos > 1 AND c1 + tok <= {SPAN_TOKENS} THEN 1
                ELSE 0 END AS m FROM c2),
n AS (SELECT *, [c0, c1, c2][m + 1] + tok AS held, [0, l1, l2][m + 1] + CASE WHEN pos - m > 1 THEN sys_len ELSE 0 END AS again
      FROM o),
g AS (SELECT conv_id, pos, held AS used, again FROM n WHERE pos = 1 UNION ALL
      SELECT n.conv_id, n.pos, CASE WHEN g.used + n.tok <= {SPAN_TOKENS} AND (n.pos - 1) % {BLOCK_TURNS} <> 0
          THEN g.used + n.tok ELSE n.held END,
        CASE WHEN g.used + n.tok <= {SPAN_TOKENS} AND (n.pos - 1) % {BLOCK_TURNS} <> 0 THEN 0 ELSE n.again END
      FROM g JOIN n ON n.conv_id IS NOT DISTINCT FROM g.conv_id AND n.pos = g.pos + 1),
x AS (SELECT conv_id, sum(again) AS len FROM g GROUP BY conv_id)
SELECT t.conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = '{LOSS_ROLE}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = '{LOSS_ROLE}'), '')) AS loss_sha256,
  (sum(t.len) + coalesce(any_value(x.len), 0))::BIGINT AS formatted_chars
FROM t LEFT JOIN x ON t.conv_id IS NOT DISTINCT FROM x.conv_id GROUP BY t.conv_id
"""
