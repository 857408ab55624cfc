"""Headline operators and jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Inputs are derived from the events table and written as Parquet first, outside the timing. Each
query runs once to warm up and is then timed; its rows go to a sink that drops them.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallymart import fixtures as fx  # noqa: E402
from tallymart.operators import conversion, envelope, keyed, metrics, ranking, staging  # noqa: E402
from tallymart.plans.datamart import backfill_range, update_datamart_day  # noqa: E402
from tallymart.plans.import_day import import_days  # noqa: E402
from tallymart.schemas import (  # noqa: E402
    OUTBOX, STAGED_CURRENCIES, STAGED_TRANSACTIONS, TRANSACTION, TRANSACTION_KEY, TRANSACTIONS,
)
from tallymart.sources.files import file_messages  # noqa: E402
from tallymart.sources.tables import Tables, append_rows, read_table, scratch_path  # noqa: E402
from tallymart.streaming.ingest import ingest_available  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FIRST, LAST, DAY = date(2024, 1, 1), date(2024, 2, 29), date(2024, 1, 15)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    tables = Tables(scratch_path(spark, "bench"))
    inbox = f"{tables.root}/inbox"
    fx.fx_all_messages(spark, SF_DIR).repartition(int(CPUS)).write.parquet(inbox)
    messages = spark.read.parquet(inbox)
    append_rows(fx.fx_outbox(spark, SF_DIR), tables.outbox, ["sent_date"],
                ["object_type", "sent_dttm"])
    append_rows(fx.tx_staging(spark, SF_DIR), tables.transactions, ["load_date", "event_date"],
                ["transaction_dt"])
    append_rows(fx.rates_staging(spark, SF_DIR), tables.currencies, ["load_date", "event_date"])
    envelope.accepted(envelope.read_envelope(messages)).write.parquet(f"{tables.root}/arrivals")
    arrivals = spark.read.parquet(f"{tables.root}/arrivals")
    outbox = read_table(spark, tables.outbox, OUTBOX)
    tx = read_table(spark, tables.transactions, STAGED_TRANSACTIONS)
    rates = read_table(spark, tables.currencies, STAGED_CURRENCIES)

    def by_rows():
        done = ranking.done_on_day(ranking.latest_status(ranking.drop_test_accounts(tx)))
        rows = conversion.union_branches(
            conversion.convert_to_base(done, conversion.rates_on_day(rates)),
            conversion.base_currency_rows(done))
        return metrics.metrics_of_rows(rows)

    def contract():
        rows = staging.extract_transactions(
            staging.outbox_day_slice(outbox, TRANSACTION, FIRST, LAST))
        return staging.valid_rows(staging.row_contract(rows, TRANSACTIONS))

    def fresh(**borrowed):
        """Empty tables, but for those borrowed from the set-up."""
        kind = type("BenchTables", (Tables,), borrowed)
        return kind(scratch_path(spark, "bench"))

    staged = {"transactions": tables.transactions, "currencies": tables.currencies}

    def stream():
        target = fresh()
        ingest_available(spark, file_messages(spark, inbox, int(CPUS)), target,
                         f"{target.root}/stream-checkpoint")

    frames = {
        "read_envelope": lambda: envelope.read_envelope(messages),
        "insert_if_absent": lambda: keyed.insert_if_absent(
            arrivals, outbox.where(F.col("sent_date") < F.lit(DAY))),
        "extract_and_contract": contract,
        "both_present_gate": lambda: staging.both_present_gate(staging.day_counts(outbox)),
        "key_violations": lambda: keyed.key_violations(tx, TRANSACTION_KEY),
        "latest_status": lambda: ranking.latest_status(ranking.drop_test_accounts(tx)),
        "global_metrics": lambda: metrics.global_metrics(tx, rates),
        "global_metrics_by_rows": by_rows,
        "global_metrics_one_day": lambda: metrics.global_metrics(tx, rates, DAY, DAY),
    }
    jobs = {
        "ingest_stream": stream,
        "import_days": lambda: import_days(spark, fresh(outbox=tables.outbox), FIRST, LAST),
        "update_datamart_day": lambda: update_datamart_day(spark, fresh(**staged)),
        "backfill_range": lambda: backfill_range(spark, fresh(**staged), FIRST, LAST),
    }

    def drain(make):
        make().write.format("noop").mode("overwrite").save()

    runs = {**{name: (lambda make=make: drain(make)) for name, make in frames.items()}, **jobs}
    seconds = {}
    for name, run in runs.items():
        run()
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": float(Path(SF_DIR).name.removeprefix("sf"))}))
    spark.stop()


if __name__ == "__main__":
    main()
