"""Quality rules: a threshold table compiled into one Spark projection (native, no user functions).

Measures per document, over the whole text (null text: no words, all zero):

* words are ``[^\\x20\\x09-\\x0D]+``; ``word_chars`` their code points;
* ``n_symbols`` characters of ``[#*$%&|<>]``; ``n_shouts`` runs of two or more ``!``;
* ``n_lines`` lines (split at ``\\n``) with a word, ``n_dup_lines`` of them equal to an earlier one;
* ``n_stop`` words that are stop words, in lower case or with a capital first letter;
* ``n_repeat_words`` words inside 5-word windows that occur twice or more in the text.

Windows are compared by a 64-bit hash inside one document.  Equal inputs give
equal rows: repeated rows are judged one by one, an empty table gives an empty
result, and other columns of the input pass through (an input column named
like a measure is replaced by the measure).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word separators, symbol class and window length of the measures.
WORD_SEP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW_WORDS = 5

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not he his are at this from or an they which a "
    "le la les de des du et un une que qui pour dans en au ce par "
    "der die und das den von zu mit dem ist nicht ein eine als für auf im es "
    "el los del se las por con para su al lo como más"
).split()

STOP_FORMS = tuple(dict.fromkeys([*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]))

MEASURES = ("n_words", "word_chars", "n_symbols", "n_shouts", "n_lines", "n_dup_lines", "n_stop", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Reject when ``100 * measure`` is above ``max_pct`` (or below ``min_pct``) percent of ``of``."""

    name: str
    measure: str
    of: str
    max_pct: int | None = None
    min_pct: int | None = None
    from_words: int = 0  # the rule applies to texts with at least this many words


#: The method's thresholds (length, symbol, line and stop-word ratios).
RULES = (
    Rule("word_length_high", "word_chars", "n_words", max_pct=2000),
    Rule("word_length_low", "word_chars", "n_words", min_pct=200),
    Rule("symbol_ratio", "n_symbols", "n_words", max_pct=15),
    Rule("shout_ratio", "n_shouts", "n_words", max_pct=10),
    Rule("dup_line_ratio", "n_dup_lines", "n_lines", max_pct=30),
    Rule("stop_word_ratio", "n_stop", "n_words", min_pct=2, from_words=100),
)
MIN_WORDS = 10
MAX_REPEAT_PCT = 20


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_SEP), "")


def _repeat_words(grams: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; ``grams[i]`` starts at word ``i``."""
    ranked = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda g, k: (F.get(s, k - 1)["h"] == g["h"]) | (F.get(s, k + 1)["h"] == g["h"]))
        at = F.sort_array(F.transform(twice, lambda g: g["i"]))
        # each start covers five words, or as many as there are up to the next start
        return F.aggregate(
            at, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW_WORDS).alias("last")),
            lambda acc, x: F.struct((acc["n"] + F.least(F.lit(WINDOW_WORDS), x - acc["last"])).alias("n"),
                                    x.alias("last")),
            lambda acc: acc["n"])

    # binding the sorted array to a lambda variable evaluates it once
    once = F.transform(F.array(ranked), covered)
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(F.element_at(once, 1))


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the measures (long) to every row of ``docs``."""
    own = [c for c in docs.columns if c not in MEASURES]
    base = docs.select(*own, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    split = base.withColumns({
        "__words": _words(F.col("__text")),
        "__lines": F.filter(F.split(F.col("__text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    w, n = F.col("__words"), F.size("__words")
    starts = F.slice(w, F.lit(1), F.greatest(n - (WINDOW_WORDS - 1), F.lit(0)))
    grams = split.withColumn("__grams", F.transform(
        starts, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW_WORDS)])))
    measures = {
        "n_words": n,
        "word_chars": F.char_length(F.array_join(w, "")),
        "n_symbols": F.char_length("__text") - F.char_length(F.regexp_replace("__text", SYMBOLS + "+", "")),
        "n_shouts": F.size(F.split("__text", "!!+")) - 1,
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_stop": F.size(F.filter(w, lambda x: x.isin(*STOP_FORMS))),
        "n_repeat_words": _repeat_words(F.col("__grams")),
    }
    return grams.select(*own, *[measures[m].cast("long").alias(m) for m in MEASURES])


def _fails(rule: Rule) -> Column:
    scaled, of = F.lit(100) * F.col(rule.measure), F.col(rule.of)
    tests = []
    if rule.max_pct is not None:
        tests.append(scaled > F.lit(rule.max_pct) * of)
    if rule.min_pct is not None:
        tests.append(scaled < F.lit(rule.min_pct) * of)
    return reduce(lambda a, b: a | b, tests) & (F.col("n_words") >= F.lit(rule.from_words))


def quality_rules(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
                  min_words: int = MIN_WORDS, max_repeat_pct: int = MAX_REPEAT_PCT) -> DataFrame:
    """Add the measures, ``base_failed``, ``failed_rules`` (names) and ``kept`` to every row.

    ``base_failed``: fewer than ``min_words`` words, or more than
    ``max_repeat_pct`` percent of the words lie in repeated 5-word windows.
    Null and empty texts have no words and fail.
    """
    out = with_measures(docs.drop("base_failed", "failed_rules", "kept"), text_col)
    failed = F.array_compact(F.array(*[F.when(_fails(r), F.lit(r.name)) for r in rules])) if rules \
        else F.array().cast("array<string>")
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    # always true, but not deterministic: a caller's filter stays above the projection.  Pushed below, it
    # would hold the measures' expressions again, with the text split anew for every word.
    here = F.monotonically_increasing_id() >= 0
    return (out.withColumns({"base_failed": base, "failed_rules": failed})
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0) & here))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", *MEASURES, "base_failed", "kept")


def oracle_sql() -> str:
    stop = ", ".join("'" + w + "'" for w in STOP_FORMS)
    tests = []
    for r in RULES:
        own = []
        if r.max_pct is not None:
            own.append(f"100 * {r.measure} > {r.max_pct} * {r.of}")
        if r.min_pct is not None:
            own.append(f"100 * {r.measure} < {r.min_pct} * {r.of}")
        tests.append(f"(({' OR '.join(own)}) AND n_words >= {r.from_words})")
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS i FROM (
        SELECT doc_id, unnest(p) AS word, generate_subscripts(p, 1) AS k
        FROM (SELECT doc_id, string_split_regex(t, '[\x20\x09-\x0D]+') AS p FROM d)) WHERE word <> ''),
ws AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars,
        count(*) FILTER (WHERE word IN ({stop})) AS n_stop FROM w GROUP BY doc_id),
g AS (SELECT doc_id, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
        lead(word, 4) OVER o) AS gram, lead(word, 4) OVER o AS fifth FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g
        WHERE fifth IS NOT NULL) WHERE c > 1),
rw AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, range(5) AS x(k) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
        SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(string_split_regex(t, '!!+')) - 1)::BIGINT AS n_shouts,
        coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
        coalesce(n_stop, 0)::BIGINT AS n_stop, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN ws USING (doc_id) LEFT JOIN rw USING (doc_id) LEFT JOIN l USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND NOT ({' OR '.join(tests)}) AS kept FROM b
"""
