"""Transaction CSV readers (three ingest modes) and the arrival-order key.

* :func:`read_transactions_csv` — declared schema, positional under a header,
  PERMISSIVE: bad or empty values become NULL (the batch scorer's reader).
* :func:`read_transactions_strict` — columns by header name, every value
  must parse; a bad or missing number / time fails the job (the sequential
  scorer's reader).  Empty string fields read as ``''``.
* :func:`read_transactions_upload` — like the upload apps: the pandas
  missing-value tokens turn string fields into the text ``'nan'`` and the
  amount into NaN; a missing MCC or time fails.

The strict and the upload reader keep the offset of a time that has one, in seconds, as
``utc_offset``: such times are ordered by their instant, and their hour is that of their own wall clock.
Quoted fields may hold line breaks.  A file stays splittable: if every line has an even number of
quotes, lines are records; else :func:`quoted_records` puts the lines together.

All readers add ``seq``, the arrival order used as the tie-breaker of the
history dialect (file order within a split, splits in order).  ``in_path_order`` numbers the
rows densely in the order of file paths instead, as if the files were one.

:func:`read_transactions_checked` is the permissive reader with the bad rows apart: a typed table and a
table of rejects, out of one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecols import OFFSET
from ..schema import SEQ, STRING_COLUMNS, TRANSACTION_COLUMNS, TRANSACTION_SCHEMA
from ..session import materialize

# The strings pandas.read_csv reads as missing by default.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The date-times and numbers that the sequential scorer's parsers accept.
ISO_TIME = r"\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{3}(\d{3})?)?)?([+-]\d{2}:\d{2}|Z)?)?"
FLOAT = r"[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?|(?i:inf|infinity|nan))"
INTEGER = r"[+-]?\d+(_\d+)*"


def _number(c: Column, pattern: str, kind: str) -> Column:
    text = F.trim(c)
    return F.when(text.rlike(f"^(?:{pattern})$"), F.replace(text, F.lit("_"), F.lit("")).try_cast(kind))


def _time(c: Column) -> Column:
    return F.when(c.rlike(f"^(?:{ISO_TIME})$"), c.try_cast("timestamp"))


def _offset(c: Column) -> Column:
    """Seconds east of UTC written in a time text, NULL without."""
    text = F.regexp_extract(c, r"[T ].*?([+-]\d{2}:\d{2}|Z)$", 1)
    size = F.substring(text, 2, 2).try_cast("int") * 3600 + F.substring(text, 5, 2).try_cast("int") * 60
    return F.when(text == "Z", F.lit(0)).when(text != "", F.when(text.startswith("-"), -size).otherwise(size))


def with_arrival_seq(df: DataFrame) -> DataFrame:
    return df.withColumn(SEQ, F.monotonically_increasing_id())


def with_path_seq(scan: DataFrame) -> DataFrame:
    """Add ``seq`` from 0 without gaps: by file path, then by the row's place in the file.

    ``scan`` is a file source's frame.  The rows are written once, which pins the numbers against retries.
    A split's rows have consecutive ids, so a row's number is its place in the split plus the rows
    of earlier splits: one number a split.
    """
    own = scan.columns
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
             F.monotonically_increasing_id().alias("__at")]
    rows = materialize(scan.select(*own, *place), "csv-rows")
    splits = rows.groupBy("__file", "__block").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("__file", "__block", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"))
    # joined by split, not broadcast unseen: Spark sees the size of the written rows' few splits
    return rows.join(splits, ["__file", "__block"]).select(*own, (F.col("__at") + F.col("__shift")).alias(SEQ))


def read_transactions_csv(spark: SparkSession, path, in_path_order: bool = False) -> DataFrame:
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").schema(TRANSACTION_SCHEMA).csv(path)
    return with_path_seq(df) if in_path_order else with_arrival_seq(df)


# Reasons of a reject, in the order in which they are looked for.
REJECT_FIELDS, REJECT_AMOUNT, REJECT_MCC, REJECT_TIME = "fields", "amount", "merchant_mcc", "timestamp"
REJECT_OTHER = "unreadable"
QUOTED_FIELD = r'"(\\.|[^"\\])*"'


def read_transactions_checked(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """The typed rows (with ``seq``) and the rejects ``raw, file, reason, seq``, which add up to the files' lines.

    A row is rejected if a number or a time does not parse or its number of fields is wrong.  An empty
    field is a NULL, no error.  Both tables come from one scan, written once; ``reason`` is ``fields`` (too few or
    too many), ``amount``, ``merchant_mcc``, ``timestamp`` or ``unreadable``.
    """
    raw, file = "_raw", "_file"
    schema = T.StructType([*TRANSACTION_SCHEMA.fields, T.StructField(raw, T.StringType())])
    scan = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", raw)
            .option("enforceSchema", True).schema(schema).csv(path))
    rows = materialize(scan.select("*", F.col("_metadata.file_path").alias(file),
                                   F.monotonically_increasing_id().alias(SEQ)), "csv-checked")
    typed = rows.where(F.col(raw).isNull()).select(*TRANSACTION_COLUMNS, SEQ)
    n_fields = F.size(F.split(F.regexp_replace(raw, QUOTED_FIELD, "q"), ",", -1))
    texts = F.from_csv(F.col(raw), ", ".join(f"`{c}` string" for c in TRANSACTION_COLUMNS), {"mode": "PERMISSIVE"})
    kinds = {f.name: f.dataType for f in TRANSACTION_SCHEMA.fields}

    def bad(name: str) -> Column:
        # a text whose typed column came out NULL
        return F.col("_texts")[name].isNotNull() & F.col(name).isNull()

    reason = F.when(n_fields != len(kinds), F.lit(REJECT_FIELDS))
    for name in (REJECT_AMOUNT, REJECT_MCC, REJECT_TIME):
        reason = reason.when(bad(name), F.lit(name))
    rejects = rows.where(F.col(raw).isNotNull()).withColumn("_texts", texts).select(
        F.col(raw).alias("raw"), F.col(file).alias("file"), reason.otherwise(F.lit(REJECT_OTHER)).alias("reason"), SEQ)
    return typed, rejects


def _raw_strings(spark: SparkSession, path: str, in_path_order: bool = False) -> DataFrame:
    # quoting as in Python's csv module: doubled quotes, line breaks inside quotes
    raw = spark.read.option("header", True).option("mode", "FAILFAST").option("encoding", "UTF-8")
    raw = raw.option("quote", '"').option("escape", '"')
    head = raw.option("multiLine", True).csv(path)      # only its header is used
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    if lines.agg(F.count_if(quotes % 2 == 1)).first()[0] == 0:
        raw = raw.option("multiLine", False).csv(path)
        raw = with_path_seq(raw) if in_path_order else raw
    else:
        raw = quoted_records(spark, path, head.columns)
    missing = [c for c in TRANSACTION_COLUMNS if c not in raw.columns]
    if missing:
        raise KeyError(f"CSV {path} lacks columns {missing}")
    return raw


def quoted_records(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Records of CSV files whose quoted fields hold line breaks, as text columns and ``seq``.

    A line begins a record where the quotes before it in its file are even in number.  Each split of a
    file counts its quotes and, for both parities it may begin with, its beginnings; prefix sums over the
    splits (one row each) give the parity and number each begins with.  So a file is read by as many tasks
    as it has splits.  ``seq`` numbers the records in the order of file paths, as in one file.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"))
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("long")
    # read once: line numbers must be those of one reading
    lines = materialize(lines.withColumn("quotes", quotes), "csv-lines")
    inside = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("before", F.coalesce(F.sum("quotes").over(inside), F.lit(0)) % 2)
    blocks = lines.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("parity"), F.count_if(F.col("before") == 0).alias("even"),
        F.count_if(F.col("before") == 1).alias("odd"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("enters", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("enters") == 0, F.col("even")).otherwise(F.col("odd"))
    blocks = materialize(blocks.select("file", "block", "enters", begun.alias("begun"), F.coalesce(
        F.sum(begun).over(earlier), F.lit(0)).alias("records")), "csv-blocks")
    # one row a file; its first record is the header
    files = blocks.groupBy("file").agg((F.sum("begun") - 1).alias("n"))
    files = files.select("file", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    upto = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    begins = (F.col("before") + F.col("enters")) % 2 == 0
    lines = lines.join(blocks.select("file", "block", "enters", "records"), ["file", "block"])
    lines = lines.withColumn("record", F.col("records") + F.sum(begins.cast("long")).over(upto))
    records = lines.groupBy("file", "record").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("block", "line", "value"))), lambda v: v["value"]), "\n").alias("text"))
    text = F.regexp_replace("text", r"\r$", "")
    schema = ", ".join(f"`{c}` string" for c in columns)
    parsed = F.from_csv(text, schema, {"quote": '"', "escape": '"', "mode": "FAILFAST", "multiLine": "true"})
    return (records.where((F.col("record") > 1) & (text != "")).join(files, "file")
            .select(parsed.alias("r"), (F.col("offset") + F.col("record") - 2).alias(SEQ)).select("r.*", SEQ))


def _must(parsed: Column, raw: Column, what: str) -> Column:
    msg = F.concat(F.lit(f"invalid {what}: "), F.coalesce(raw, F.lit("<missing>")))
    return F.when(parsed.isNull(), F.raise_error(msg)).otherwise(parsed)


def _typed(raw_df: DataFrame, amount: Column, strings: dict[str, Column]) -> DataFrame:
    mcc_raw, ts_raw = F.col("merchant_mcc"), F.col("timestamp")
    cols = dict(strings)
    cols["amount"] = amount
    cols["merchant_mcc"] = _must(_number(mcc_raw, INTEGER, "int"), mcc_raw, "merchant_mcc")
    cols["timestamp"] = _must(_time(ts_raw), ts_raw, "timestamp")
    own = [SEQ] if SEQ in raw_df.columns else []
    typed = raw_df.select(*[cols[c].alias(c) for c in TRANSACTION_COLUMNS], _offset(ts_raw).alias(OFFSET), *own)
    # a filter on the checked columns: later projections and counts cannot prune the checks
    valid = F.col("amount").isNotNull() & F.col("merchant_mcc").isNotNull() & F.col("timestamp").isNotNull()
    typed = typed.where(valid)
    return typed if own else with_arrival_seq(typed)


def read_transactions_strict(spark: SparkSession, path: str, in_path_order: bool = False) -> DataFrame:
    raw = _raw_strings(spark, path, in_path_order)
    amount = _must(_number(F.col("amount"), FLOAT, "double"), F.col("amount"), "amount")
    # Spark reads an empty CSV field as NULL; Python's csv module reads ''.
    return _typed(raw, amount, {c: F.coalesce(F.col(c), F.lit("")) for c in STRING_COLUMNS})


def upload_missing(c: Column) -> Column:
    """True where the upload apps' pandas reader would see a missing value."""
    return c.isNull() | c.isin(list(PANDAS_NA_TOKENS))


def upload_string(c: Column) -> Column:
    """``str(value)`` after pandas ingest: a missing value becomes the text ``'nan'``."""
    return F.when(upload_missing(c), F.lit("nan")).otherwise(c)


def upload_missing_to_nan(df: DataFrame) -> DataFrame:
    """Apply the upload apps' missing-value rule to the string columns of any transaction frame."""
    return df.withColumns({c: upload_string(F.col(c)) for c in STRING_COLUMNS if c in df.columns})


def read_transactions_upload(spark: SparkSession, path: str, in_path_order: bool = False) -> DataFrame:
    raw = _raw_strings(spark, path, in_path_order)
    strings = {c: upload_string(F.col(c)) for c in STRING_COLUMNS}
    a = F.col("amount")
    amount = F.when(upload_missing(a), F.lit(float("nan"))).otherwise(
        _must(_number(a, FLOAT, "double"), a, "amount"))
    return _typed(raw, amount, strings)
