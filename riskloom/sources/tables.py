"""Adapters from the driver's Parquet tables to the canonical inputs.

``events`` -> transactions (mapping fixed in FIXTURES.md §5):

* txn_id = event_id as text, seq = event_id, user_id = user_id as text,
  amount = value, currency = 'GBP';
* card_country = name of the customer's nation (customer.c_custkey = user_id);
* with k = props.k: ip_country is NULL for k = 99, nation k's name for k < 10,
  else the card country; merchant_mcc is 7995 / 4829 / 5411 for k % 20 = 3 / 7 /
  other; device_id = 'DEV-' || k % 7; timestamp = ts.

``supplier`` / ``lineitem`` -> employees / payroll.

Only the needed columns are read (Parquet column pruning); dimension sides are
broadcast only when their footer row count is within ``max_broadcast_dim_rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_EXEC, ExecConfig
from ..operators.joins import broadcast_dimension, join_nullsafe, table_rows
from ..schema import CANONICAL_COLUMNS
from ..session import materialize

# Fixed values of the events -> transactions mapping.
CURRENCY = "GBP"
NO_IP_K = 99
IP_NATION_BELOW_K = 10
MCC_BY_K_MOD_20 = {3: 7995, 7: 4829}
MCC_DEFAULT = 5411
DEVICE_MODULUS = 7
DEVICE_PREFIX = "DEV-"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions_from_events(spark: SparkSession, sf_dir: str, exec_cfg: ExecConfig = DEFAULT_EXEC) -> DataFrame:
    return transactions_from_event_frame(table(spark, sf_dir, "events"), spark, sf_dir, exec_cfg)


def events_inputs(spark: SparkSession, sf_dir: str, exec_cfg: ExecConfig = DEFAULT_EXEC) -> dict:
    """Transactions plus the hot-user routing inputs; each table is read (listed) once.

    Returns ``tx``, ``key_counts`` (rows per user from raw events, no joins),
    ``rows_upper_bound`` (the events row count, from footers) and ``split``, which
    takes the raw events of hot users apart before the dimension joins.
    """
    events = table(spark, sf_dir, "events")
    dims = {"nation": table(spark, sf_dir, "nation"), "customer": table(spark, sf_dir, "customer")}
    rows = table_rows({"events": events, **dims})
    tx = transactions_from_event_frame(events, spark, sf_dir, exec_cfg, rows, dims)
    key_counts = events.groupBy(F.col("user_id").cast("string").alias("user_id")).agg(F.count(F.lit(1)).alias("_n"))

    def split(keys: DataFrame, bounded: bool) -> tuple[DataFrame, DataFrame]:
        text_id = F.col("user_id").cast("string")
        parts = []
        for how in ("left_semi", "left_anti"):
            own = join_nullsafe(events.withColumn("_user", text_id), keys.withColumnRenamed("user_id", "_user"),
                                ["_user"], how).drop("_user")
            own_dims, own_rows = dims, rows
            if how == "left_semi" and bounded:
                # only the hot users' customers: counted, so that a broadcast needs no trust in unique keys
                few = join_nullsafe(dims["customer"].withColumn("_user", F.col("c_custkey").cast("string")),
                                    keys.withColumnRenamed("user_id", "_user"), ["_user"], "left_semi").drop("_user")
                few = materialize(few.select("c_custkey", "c_nationkey"), "hot-customers")
                own_dims, own_rows = {**dims, "customer": few}, {**rows, "customer": few.count()}
            parts.append(transactions_from_event_frame(own, spark, sf_dir, exec_cfg, own_rows, own_dims))
        return parts[0], parts[1]

    return {"tx": tx, "key_counts": key_counts, "rows_upper_bound": rows["events"], "split": split}


def transactions_from_event_frame(events: DataFrame, spark: SparkSession, sf_dir: str,
                                  exec_cfg: ExecConfig = DEFAULT_EXEC, dim_rows: dict | None = None,
                                  dims: dict | None = None) -> DataFrame:
    """Map an events frame (batch or streaming) to transactions; dimensions are static."""
    ev = events.select("event_id", "ts", "user_id", "value", "props")
    bound = exec_cfg.max_broadcast_dim_rows
    dims = dims or {n: table(spark, sf_dir, n) for n in ("nation", "customer")}
    nation = dims["nation"].select("n_nationkey", "n_name")
    customer = dims["customer"].select("c_custkey", "c_nationkey")
    if dim_rows is None:
        dim_rows = table_rows({"nation": nation, "customer": customer})
    nation = broadcast_dimension(nation, bound, dim_rows["nation"])
    # customer grows with the data: broadcast below the bound, else a shuffle
    # join on the user key (not split by AQE where the per-user windows need its partitioning).
    customer = broadcast_dimension(customer, bound, dim_rows["customer"])
    cardn = nation.select(F.col("n_nationkey").alias("card_nationkey"), F.col("n_name").alias("card_country"))
    ipn = nation.select(F.col("n_nationkey").alias("ip_nationkey"), F.col("n_name").alias("ip_nation"))

    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    e = ev.withColumn("k", k).withColumn("user_key", F.col("user_id").cast("string"))
    # Join on the text user id (the canonical key): when customer is too big to
    # broadcast, the sort-merge join's hashpartitioning(user_key) is exactly
    # what the per-user windows need, so events are shuffled once, not twice.
    customer = customer.withColumn("cust_key", F.col("c_custkey").cast("string"))
    e = e.join(customer, e["user_key"] == customer["cust_key"], "left")
    e = e.join(cardn, e["c_nationkey"] == cardn["card_nationkey"], "left")
    e = e.join(ipn, e["k"] == ipn["ip_nationkey"], "left")
    mcc = F.lit(MCC_DEFAULT)
    for rem, code in reversed(list(MCC_BY_K_MOD_20.items())):
        mcc = F.when(F.col("k") % 20 == rem, F.lit(code)).otherwise(mcc)
    out = e.select(
        F.col("event_id").cast("string").alias("txn_id"),
        F.col("user_key").alias("user_id"),
        F.col("value").alias("amount"),
        F.lit(CURRENCY).alias("currency"),
        F.col("card_country"),
        F.when(F.col("k") == NO_IP_K, F.lit(None).cast("string"))
         .when(F.col("k") < IP_NATION_BELOW_K, F.col("ip_nation"))
         .otherwise(F.col("card_country")).alias("ip_country"),
        mcc.cast("int").alias("merchant_mcc"),
        F.concat(F.lit(DEVICE_PREFIX), (F.col("k") % DEVICE_MODULUS).cast("string")).alias("device_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").cast("long").alias("seq"),
    )
    return out.select(*CANONICAL_COLUMNS)


def employees_from_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("long").alias("employee_id"), F.col("s_name").alias("name"))


def payroll_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("long").alias("employee_id"),
        F.col("l_quantity").cast("double").alias("hours_worked"),
        F.col("l_extendedprice").cast("double").alias("hourly_rate"),
        F.col("l_returnflag").alias("position"),
    )
