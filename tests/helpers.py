from datetime import datetime, timedelta

from pyspark.sql import types as T

from riskloom.schema import TRANSACTION_SCHEMA

NTZ_SCHEMA = T.StructType(
    [f if f.name != "timestamp" else T.StructField("timestamp", T.TimestampNTZType()) for f in TRANSACTION_SCHEMA.fields]
    + [T.StructField("seq", T.LongType())]
)

T0 = datetime(2025, 10, 6, 10, 0, 0)


def tx_rows(spark, rows):
    """rows: dicts with any canonical fields; defaults fill the rest; seq = position."""
    full = []
    for i, r in enumerate(rows):
        d = {"txn_id": f"X{i:04d}", "user_id": "U1", "amount": 10.0, "currency": "GBP", "card_country": "GB",
             "ip_country": "GB", "merchant_mcc": 5411, "device_id": "D1", "timestamp": T0, "seq": i}
        d.update(r)
        full.append(tuple(d[f.name] for f in NTZ_SCHEMA.fields))
    return spark.createDataFrame(full, NTZ_SCHEMA)


def minutes(m):
    return timedelta(minutes=m)
