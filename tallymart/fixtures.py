"""Payments derived from the ``events`` table, as described in FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.envelope import accepted, read_envelope
from .operators.keyed import first_per_key
from .schemas import CURRENCIES, CURRENCY, OUTBOX, TRANSACTION, TRANSACTIONS

RATE_CODES = (410, 430, 440, 450)
RATE_CODES_WITH = (420, 840)
DAYS_WITHOUT_RATES = (10, 20, 30)

#: Partition of the messages that are sent again; all others are in partition 0.
REPEATS = 1


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def fx_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions: four events make one payment."""
    step, op = F.col("event_id") % 4, F.col("op")
    reversed_payment = op % 5 == 0
    status = (
        F.when(step == 0, "queued").when(step == 1, "in_progress")
        .when(step == 2, F.when(reversed_payment, "done").otherwise("authorized"))
        .otherwise(F.when(reversed_payment, "chargeback").otherwise("done"))
    )
    account = (F.when(op % 53 == 0, F.lit(-1)).when(op % 53 == 26, F.lit(-2))
               .otherwise(op * 7919 % 150 + 1))
    late = (step == 3) & (op % 7 == 0)
    return (
        events(spark, sf_dir)
        .withColumn("op", F.floor(F.col("event_id") / 4).cast("bigint"))
        .withColumn("sent_dttm", F.date_trunc("second", "ts").cast("timestamp_ntz"))
        .select(
            "event_id",
            F.md5(F.col("event_id").cast("string")).alias("object_id"),
            "sent_dttm",
            F.md5(F.concat(F.lit("op"), op.cast("string"))).alias("operation_id"),
            account.cast("bigint").alias("account_number_from"),
            (op * 104729 % 150 + 1).alias("account_number_to"),
            (410 + 10 * (op % 6)).cast("int").alias("currency_code"),
            F.concat(F.lit("country_"), (op % 9).cast("string")).alias("country"),
            status.alias("status"),
            F.col("event_type").alias("transaction_type"),
            F.round(F.col("value") * 100).cast("bigint").alias("amount"),
            F.when(late, F.col("sent_dttm") + F.expr("INTERVAL 1 DAY"))
            .otherwise(F.col("sent_dttm")).alias("transaction_dt"),
        )
    )


def tx_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_tx(spark, sf_dir).select(
        *TRANSACTIONS.names, F.to_date("sent_dttm").alias("load_date"),
        F.to_date("transaction_dt").alias("event_date"))


def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates for each event day except the 10th, 20th and 30th."""
    codes = F.explode(F.array(*[F.lit(code) for code in RATE_CODES]))
    codes_with = F.explode(F.array(*[F.lit(code) for code in RATE_CODES_WITH]))
    thousandths = (500 + (F.col("currency_code") - 400) * 10 + F.day("day")
                   + (F.col("currency_code_with") - 420))
    return (
        events(spark, sf_dir)
        .select(F.to_date("ts").alias("day")).distinct()
        .where(~F.day("day").isin(*DAYS_WITHOUT_RATES))
        .withColumn("currency_code", codes)
        .withColumn("currency_code_with", codes_with)
        .select(F.col("day").cast("timestamp_ntz").alias("date_update"), "currency_code",
                "currency_code_with",
                (thousandths.cast("double") / 1000).alias("currency_with_div"))
    )


def rates_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_rates(spark, sf_dir).select(
        *CURRENCIES.names, F.to_date("date_update").alias("load_date"),
        F.to_date("date_update").alias("event_date"))


def _message(object_id: Column, object_type: str, sent_dttm: Column, payload: Column) -> Column:
    return F.to_json(F.struct(
        object_id.alias("object_id"),
        F.lit(object_type).alias("object_type"),
        F.date_format(sent_dttm, "yyyy-MM-dd'T'HH:mm:ss").alias("sent_dttm"),
        payload.alias("payload"),
    ), {"ignoreNullFields": "false"})


def _payload(names, time_column: str, **changes: Column) -> Column:
    time = F.date_format(time_column, "yyyy-MM-dd HH:mm:ss")
    fields = {name: time if name == time_column else F.col(name) for name in names}
    return F.struct(*[column.alias(name) for name, column in {**fields, **changes}.items()])


def fx_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event, six kinds of spoiled ones, and repeats under a later offset."""
    tx = fx_tx(spark, sf_dir)
    kind = F.col("event_id") % 97
    payload = _payload(TRANSACTIONS.names, "transaction_dt")
    stated = lambda pay, object_id=F.col("object_id"): _message(
        object_id, TRANSACTION, F.col("sent_dttm"), pay)
    time = F.date_format("sent_dttm", "yyyy-MM-dd'T'HH:mm:ss")
    value = (
        F.when(kind == 1, F.to_json(F.struct(
            "object_id", F.lit(TRANSACTION).alias("object_type"), time.alias("sent_dttm"))))
        .when(kind == 2, stated(payload, F.lit("zz")))
        .when(kind == 3, F.to_json(F.struct(
            "object_id", F.lit(TRANSACTION).alias("object_type"),
            F.lit("01.10.2022").alias("sent_dttm"), payload.alias("payload"))))
        .when(kind == 4, "not json")
        .when(kind == 5, stated(F.lit("x")))
        .when(kind == 6, stated(F.lit(None).cast("string")))
        .otherwise(stated(payload))
    )
    repeated = _payload(TRANSACTIONS.names, "transaction_dt", status=F.lit("DUPLICATE"))
    once = tx.select(value.alias("value"), F.lit(0).alias("partition"),
                     F.col("event_id").alias("offset"))
    again = tx.where((F.col("event_id") % 10 == 0) & ~kind.between(1, 6)).select(
        stated(repeated).alias("value"), F.lit(REPEATS).alias("partition"),
        F.col("event_id").alias("offset"))
    return once.unionByName(again)


def fx_rate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates as messages, sent five minutes past midnight."""
    day = F.to_date("date_update").cast("string")
    name = F.concat_ws("-", F.concat(F.lit("rate"), F.col("currency_code").cast("string")),
                       F.col("currency_code_with").cast("string"), day)
    sent = F.col("date_update") + F.expr("INTERVAL 5 MINUTES")
    days = F.datediff("date_update", F.lit("2000-01-01").cast("date")).cast("bigint")
    offset = (20_000_000 + days * 1_000_000
              + F.col("currency_code") * 1_000 + F.col("currency_code_with"))
    return fx_rates(spark, sf_dir).select(
        _message(F.md5(name), CURRENCY, sent, _payload(CURRENCIES.names, "date_update"))
        .alias("value"),
        F.lit(0).alias("partition"), offset.cast("bigint").alias("offset"))


def fx_all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_messages(spark, sf_dir).unionByName(fx_rate_messages(spark, sf_dir))


def fx_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the outbox holds after all messages."""
    rows = accepted(read_envelope(fx_all_messages(spark, sf_dir)))
    return first_per_key(rows, ["object_id"], ["partition", "offset"]).select(*OUTBOX.names)


def fx_odd_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbox rows with payloads that bend or break the row contract, by payment number."""
    op = F.floor(F.col("event_id") / 4)
    amount = (F.when(op % 11 == 1, F.concat(F.col("amount").cast("string"), F.lit(".5")))
              .when(op % 11 == 2, F.lit("many")).otherwise(F.col("amount").cast("string")))
    country = F.when(op % 11 != 3, F.col("country"))
    time = F.date_format("transaction_dt", "yyyy-MM-dd HH:mm:ss")
    time = F.when(op % 11 == 4, F.lit("yesterday")).otherwise(time)
    operation = F.when(op % 11 == 5, F.lit("op")).otherwise(F.col("operation_id"))
    payload = _payload(TRANSACTIONS.names, "transaction_dt", amount=amount, country=country,
                       transaction_dt=time, operation_id=operation)
    return fx_tx(spark, sf_dir).select(
        "object_id", F.lit(TRANSACTION).alias("object_type"), "sent_dttm",
        F.to_json(payload).alias("payload"), F.lit("fixture").alias("load_src"),
        F.to_date("sent_dttm").alias("sent_date"))
