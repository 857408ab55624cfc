"""Table schemas and the fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: given by the data model, not free to choose -----------------------------
REQUIRED_FIELDS = ("object_id", "object_type", "sent_dttm", "payload")
LOAD_SRC = "kafka-transaction-service-input"
TRANSACTION = "TRANSACTION"
CURRENCY = "CURRENCY"
BASE_CURRENCY = 420
DONE = "done"
TEST_ACCOUNT = -1
BATCH_INTERVAL = "20 seconds"
CSV_NULL = "NULL"
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"
# -------------------------------------------------------------------------------------------

MESSAGES = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

OUTBOX = T.StructType([
    T.StructField("object_id", T.StringType()),
    T.StructField("object_type", T.StringType()),
    T.StructField("sent_dttm", T.TimestampNTZType()),
    T.StructField("payload", T.StringType()),
    T.StructField("load_src", T.StringType()),
    T.StructField("sent_date", T.DateType()),
])

MESSAGE_REJECTS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.StringType()),
    T.StructField("reason", T.StringType()),
])

INGEST_BATCHES = T.StructType([
    T.StructField("stream", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("first_offset", T.LongType()),
    T.StructField("last_offset", T.LongType()),
    T.StructField("n_messages", T.LongType()),
    T.StructField("n_rejected", T.LongType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("operation_id", T.StringType()),
    T.StructField("account_number_from", T.LongType()),
    T.StructField("account_number_to", T.LongType()),
    T.StructField("currency_code", T.IntegerType()),
    T.StructField("country", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("amount", T.LongType()),
    T.StructField("transaction_dt", T.TimestampNTZType()),
])

CURRENCIES = T.StructType([
    T.StructField("date_update", T.TimestampNTZType()),
    T.StructField("currency_code", T.IntegerType()),
    T.StructField("currency_code_with", T.IntegerType()),
    T.StructField("currency_with_div", T.DoubleType()),
])

# On disk both staging tables carry the day they were loaded for, and the day of the event.
LOAD_COLUMNS = [T.StructField("load_date", T.DateType()), T.StructField("event_date", T.DateType())]
STAGED_TRANSACTIONS = T.StructType(TRANSACTIONS.fields + LOAD_COLUMNS)
STAGED_CURRENCIES = T.StructType(CURRENCIES.fields + LOAD_COLUMNS)

STAGING_REJECTS = T.StructType([
    T.StructField("object_id", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("object_type", T.StringType()),
    T.StructField("load_date", T.DateType()),
])

GLOBAL_METRICS = T.StructType([
    T.StructField("date_update", T.DateType()),
    T.StructField("currency_from", T.IntegerType()),
    T.StructField("amount_total", T.DecimalType(18, 2)),
    T.StructField("cnt_transactions", T.LongType()),
    T.StructField("avg_transactions_per_account", T.DecimalType(18, 2)),
    T.StructField("cnt_accounts_make_transactions", T.LongType()),
])

BOOKMARKS = T.StructType([
    T.StructField("workflow_key", T.StringType()),
    T.StructField("date_to_load", T.DateType()),
])

TRANSACTION_KEY = ["operation_id", "status"]
CURRENCY_KEY = ["date_update", "currency_code", "currency_code_with"]
PAYMENT_KEY = ["operation_id", "account_number_from", "account_number_to"]
METRICS_KEY = ["date_update", "currency_from"]
METRICS_VALUES = [f.name for f in GLOBAL_METRICS.fields if f.name not in METRICS_KEY]
