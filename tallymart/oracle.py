"""The registry's queries as plain SQL for DuckDB, over the base tables only."""

from __future__ import annotations

from .schemas import LOAD_SRC, TRANSACTIONS

DAY, MART_FROM = "DATE '2024-01-15'", "DATE '2024-01-08'"

TX_COLUMNS = TRANSACTIONS.names
TX = ", ".join(TX_COLUMNS)
RATE = "date_update, currency_code, currency_code_with, currency_with_div"


def _uuid(column: str) -> str:
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({column}, {at}, {n})" for at, n in parts)


def _tx_payload(status: str = "status") -> str:
    fields = {name: name for name in TX_COLUMNS}
    fields["status"] = status
    fields["transaction_dt"] = "strftime(transaction_dt, '%Y-%m-%d %H:%M:%S')"
    return "json_object(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")::VARCHAR"


CTES = {
    "numbered": ("", "SELECT *, event_id // 4 AS op FROM events"),
    "fx_tx": ("numbered", """
        SELECT event_id, op, md5(CAST(event_id AS VARCHAR)) AS object_id,
               date_trunc('second', ts)::TIMESTAMP AS sent_dttm,
               md5('op' || CAST(op AS VARCHAR)) AS operation_id,
               CAST(CASE op % 53 WHEN 0 THEN -1 WHEN 26 THEN -2 ELSE op * 7919 % 150 + 1 END
                    AS BIGINT) AS account_number_from,
               CAST(op * 104729 % 150 + 1 AS BIGINT) AS account_number_to,
               CAST(410 + 10 * (op % 6) AS INTEGER) AS currency_code,
               'country_' || CAST(op % 9 AS VARCHAR) AS country,
               CASE event_id % 4
                    WHEN 0 THEN 'queued' WHEN 1 THEN 'in_progress'
                    WHEN 2 THEN CASE WHEN op % 5 = 0 THEN 'done' ELSE 'authorized' END
                    ELSE CASE WHEN op % 5 = 0 THEN 'chargeback' ELSE 'done' END END AS status,
               event_type AS transaction_type,
               CAST(round(value * 100) AS BIGINT) AS amount,
               date_trunc('second', ts)::TIMESTAMP
                 + CASE WHEN event_id % 4 = 3 AND op % 7 = 0 THEN INTERVAL 1 DAY
                        ELSE INTERVAL 0 DAY END AS transaction_dt
        FROM numbered"""),
    "tx_staging": ("fx_tx", """
        SELECT *, CAST(sent_dttm AS DATE) AS load_date, CAST(transaction_dt AS DATE) AS event_date
        FROM fx_tx"""),
    "fx_rates": ("", """
        SELECT day::TIMESTAMP AS date_update, currency_code, currency_code_with,
               CAST(500 + (currency_code - 400) * 10 + extract(day FROM day)
                    + (currency_code_with - 420) AS DOUBLE) / 1000 AS currency_with_div,
               day
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) AS days
             CROSS JOIN (VALUES (410), (430), (440), (450)) AS a(currency_code)
             CROSS JOIN (VALUES (420), (840)) AS b(currency_code_with)
        WHERE extract(day FROM day) NOT IN (10, 20, 30)"""),
    # kind 0 stands for a sound message; repeats exist of sound messages only
    "messages": ("fx_tx", f"""
        SELECT *, 0 AS part, event_id AS "offset",
               CASE WHEN event_id % 97 BETWEEN 1 AND 6 THEN event_id % 97 ELSE 0 END AS kind,
               {_tx_payload()} AS sound_payload
        FROM fx_tx
        UNION ALL
        SELECT *, 1, event_id, 0, {_tx_payload("'DUPLICATE'")}
        FROM fx_tx WHERE event_id % 10 = 0 AND event_id % 97 NOT BETWEEN 1 AND 6"""),
    "decoded": ("messages", """
        SELECT CAST(part AS INTEGER) AS "partition", "offset",
               CASE kind WHEN 2 THEN 'zz' WHEN 4 THEN NULL ELSE object_id END AS object_id,
               CASE WHEN kind <> 4 THEN 'TRANSACTION' END AS object_type,
               CASE kind WHEN 3 THEN '01.10.2022' WHEN 4 THEN NULL
                    ELSE strftime(sent_dttm, '%Y-%m-%dT%H:%M:%S') END AS sent_dttm,
               CASE WHEN kind IN (1, 4, 6) THEN NULL WHEN kind = 5 THEN 'x'
                    ELSE sound_payload END AS payload,
               kind, sent_dttm AS sent_at, object_id AS sound_id
        FROM messages"""),
    "outbox": ("messages, fx_rates", f"""
        SELECT {_uuid("object_id")} AS object_id, 'TRANSACTION' AS object_type, sent_dttm,
               sound_payload AS payload, '{LOAD_SRC}' AS load_src,
               CAST(sent_dttm AS DATE) AS sent_date
        FROM messages WHERE kind = 0 AND part = 0
        UNION ALL
        SELECT {_uuid("id")}, 'CURRENCY', date_update + INTERVAL 5 MINUTE,
               json_object('date_update', strftime(date_update, '%Y-%m-%d %H:%M:%S'),
                           'currency_code', currency_code,
                           'currency_code_with', currency_code_with,
                           'currency_with_div', currency_with_div)::VARCHAR,
               '{LOAD_SRC}', day
        FROM (SELECT *, md5('rate' || currency_code || '-' || currency_code_with || '-' || day) AS id
              FROM fx_rates) AS r"""),
    # transactions that come through the stream and the both-present gate
    "imported": ("tx_staging", f"""
        SELECT {_uuid("operation_id")} AS operation_id, {", ".join(TX_COLUMNS[1:])},
               load_date, event_date
        FROM tx_staging
        WHERE event_id % 97 NOT BETWEEN 1 AND 6 AND extract(day FROM load_date) NOT IN (10, 20, 30)
        """),
    "odd": ("tx_staging", f"""
        SELECT {_uuid("object_id")} AS dashed_id, *,
               CASE op % 11 WHEN 1 THEN 'amount' WHEN 2 THEN 'amount' WHEN 3 THEN 'country'
                    WHEN 4 THEN 'transaction_dt' WHEN 5 THEN 'operation_id' END AS bad
        FROM tx_staging"""),
    "bookmarks": ("", """
        SELECT event_type AS workflow_key, max(CAST(ts AS DATE)) AS date_to_load
        FROM events GROUP BY event_type"""),
}


def _ranked(name: str, source: str, keep: str) -> dict:
    order = "transaction_dt DESC, status DESC, currency_code DESC, amount DESC"
    return {name: (source, f"""
        SELECT operation_id, account_number_from, account_number_to, currency_code, status, amount,
               transaction_dt
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY operation_id, account_number_from, account_number_to
                  ORDER BY {order}) AS rn
              FROM {source} WHERE {keep}) AS r
        WHERE rn = 1""")}


def _done(name: str, ranked: str) -> dict:
    return {name: (ranked, f"""
        SELECT account_number_from, account_number_to, currency_code, amount, operation_id,
               CAST(transaction_dt AS DATE) AS date_update
        FROM {ranked} WHERE status = 'done'""")}


def _rows(name: str, done: str) -> dict:
    """Two branches, joined payment by payment."""
    columns = "d.account_number_from, d.account_number_to, d.amount, d.currency_code"
    return {name: (f"{done}, fx_rates", f"""
        SELECT {columns}, r.currency_with_div, d.date_update
        FROM {done} AS d JOIN fx_rates AS r
          ON r.currency_code = d.currency_code AND r.day = d.date_update
         AND r.currency_code_with = 420
        UNION ALL
        SELECT {columns}, CAST(1 AS DOUBLE), d.date_update FROM {done} AS d
        WHERE d.currency_code = 420""")}


def _metrics(name: str, rows: str) -> dict:
    """The ratio is rounded half up in whole numbers, as DuckDB divides decimals as doubles."""
    n, m = "count(*)", "count(DISTINCT account_number_from)"
    return {name: (rows, f"""
        SELECT date_update, currency_code AS currency_from,
               CAST(sum(amount * CAST(currency_with_div AS DECIMAL(17, 9))) * 0.01
                    AS DECIMAL(18, 2)) AS amount_total,
               {n} AS cnt_transactions,
               CAST((200 * {n} + {m}) // (2 * {m}) * 0.01 AS DECIMAL(18, 2))
                 AS avg_transactions_per_account,
               {m} AS cnt_accounts_make_transactions
        FROM {rows} GROUP BY date_update, currency_code""")}


for suffix, source, keep in (
    ("", "tx_staging", "account_number_from >= 0"),
    ("_minus_one", "tx_staging", "account_number_from <> -1"),
    ("_imported", "imported", "account_number_from >= 0"),
):
    CTES |= _ranked(f"ranked{suffix}", source, keep)
    CTES |= _done(f"done{suffix}", f"ranked{suffix}")
    CTES |= _rows(f"rows{suffix}", f"done{suffix}")
    CTES |= _metrics(f"metrics{suffix}", f"rows{suffix}")


def _with(sources: str, query: str) -> str:
    """``query`` behind the CTEs it needs, in order."""
    needed: list[str] = []

    def add(names: str) -> None:
        for name in filter(None, names.split(", ")):
            if name not in needed:
                add(CTES[name][0])
                needed.append(name)

    add(sources)
    head = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in needed)
    return f"WITH {head}\n{query}" if head else query


ENVELOPE = '"partition", "offset", object_id, object_type, sent_dttm, payload'
REASON = """CASE kind WHEN 1 THEN 'missing:payload' WHEN 4 THEN 'bad_json' END AS reason"""
FULL_REASON = """CASE kind WHEN 1 THEN 'missing:payload' WHEN 2 THEN 'bad_uuid'
                 WHEN 3 THEN 'bad_timestamp' WHEN 4 THEN 'bad_json'
                 WHEN 5 THEN 'bad_payload' WHEN 6 THEN 'bad_payload' END AS reason"""
TX_TEXT = ", ".join(
    "strftime(transaction_dt, '%Y-%m-%d %H:%M:%S') AS transaction_dt" if name == "transaction_dt"
    else f"CAST({name} AS VARCHAR) AS {name}" for name in TX_COLUMNS)
STAGED = f"SELECT {TX}, load_date, event_date FROM "
METRICS = """date_update, currency_from, amount_total, cnt_transactions,
             avg_transactions_per_account, cnt_accounts_make_transactions"""

ORACLE = {
    "decode_envelope": _with("decoded", f"""
        SELECT {ENVELOPE}, CASE WHEN kind = 4 THEN 'bad_json' END AS reason FROM decoded"""),
    "require_fields": _with("decoded", f'SELECT "partition", "offset", {REASON} FROM decoded'),
    "type_envelope": _with("decoded", f"""
        SELECT "partition", "offset", CASE WHEN kind NOT IN (2, 4) THEN {_uuid("sound_id")} END
                 AS object_id,
               object_type, CASE WHEN kind NOT IN (3, 4) THEN sent_at END AS sent_dttm, payload,
               {FULL_REASON}, '{LOAD_SRC}' AS load_src,
               CASE WHEN kind NOT IN (3, 4) THEN CAST(sent_at AS DATE) END AS sent_date
        FROM decoded"""),
    "bounded_batches": _with("outbox", "SELECT * FROM outbox"),
    "message_rejects": _with("decoded", f"""
        SELECT '' AS topic, "partition", "offset", {FULL_REASON},
               CASE kind WHEN 4 THEN 'not json'
                    WHEN 1 THEN json_object('object_id', object_id, 'object_type', object_type,
                                            'sent_dttm', sent_dttm)::VARCHAR
                    ELSE json_object('object_id', object_id, 'object_type', object_type,
                                     'sent_dttm', sent_dttm, 'payload',
                                     CASE WHEN kind = 5 THEN '"x"'::JSON ELSE payload::JSON END
                                    )::VARCHAR END AS value
        FROM decoded WHERE kind > 0"""),
    "ingest_batches": _with("messages", """
        SELECT CAST(count(*) AS BIGINT) AS n_messages, CAST(count_if(kind > 0) AS BIGINT) AS n_rejected,
               min("offset") AS first_offset, max("offset") AS last_offset
        FROM messages GROUP BY CASE WHEN part = 1 THEN -1 ELSE "offset" % 6 END"""),
    "keyed_ingest": _with("outbox", "SELECT * FROM outbox"),
    "compact_outbox": _with("outbox", "SELECT * FROM outbox"),
    "compact_outbox_layout": _with("outbox", """
        SELECT sent_date, CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_unordered
        FROM outbox GROUP BY sent_date"""),
    "stored_oldest_days": _with("outbox, tx_staging", """
        SELECT min(sent_date) AS oldest_day, 'outbox' AS table_name FROM outbox
        UNION ALL
        SELECT CAST(min(transaction_dt) AS DATE), 'transactions' FROM tx_staging"""),
    "insert_if_absent": _with("outbox", f"SELECT * FROM outbox WHERE sent_date >= {DAY}"),
    "kafka_sink_encode": _with("fx_tx", """
        SELECT json_object('operation_id', operation_id, 'currency_code', currency_code,
                           'amount', amount, 'country', nullif(country, 'country_0'))::VARCHAR
                 AS value
        FROM fx_tx"""),
    "oldest_outbox_day": _with("outbox", "SELECT min(sent_date) AS oldest_day FROM outbox"),
    "outbox_day_slice": _with("outbox", f"""
        SELECT object_id, object_type, sent_dttm, sent_date FROM outbox
        WHERE object_type = 'TRANSACTION' AND CAST(sent_dttm AS DATE) = {DAY}"""),
    "stored_day_slice": _with("outbox", f"""
        SELECT object_id, object_type, sent_dttm, sent_date FROM outbox
        WHERE object_type = 'TRANSACTION' AND CAST(sent_dttm AS DATE) = {DAY}"""),
    "extract_transactions": _with("messages", f"""
        SELECT {_uuid("object_id")} AS object_id, CAST(sent_dttm AS DATE) AS load_date, {TX_TEXT}
        FROM messages WHERE kind = 0 AND part = 0"""),
    "extract_currencies": _with("fx_rates", f"""
        SELECT {_uuid("id")} AS object_id, day AS load_date,
               strftime(date_update, '%Y-%m-%d %H:%M:%S') AS date_update,
               CAST(currency_code AS VARCHAR) AS currency_code,
               CAST(currency_code_with AS VARCHAR) AS currency_code_with,
               CAST(currency_with_div AS VARCHAR) AS currency_with_div
        FROM (SELECT *, md5('rate' || currency_code || '-' || currency_code_with || '-' || day) AS id
              FROM fx_rates) AS r"""),
    "row_contract": _with("odd", f"""
        SELECT object_id, load_date,
               CASE WHEN bad IS DISTINCT FROM 'operation_id' THEN {_uuid("operation_id")} END
                 AS operation_id,
               account_number_from, account_number_to, currency_code,
               CASE WHEN bad IS DISTINCT FROM 'country' THEN country END AS country,
               status, transaction_type,
               CASE WHEN bad IS DISTINCT FROM 'amount' THEN amount END AS amount,
               CASE WHEN bad IS DISTINCT FROM 'transaction_dt' THEN transaction_dt END
                 AS transaction_dt,
               'bad:' || bad AS reason
        FROM odd"""),
    "both_present_gate": _with("outbox", """
        SELECT sent_date, count(*) FILTER (object_type = 'TRANSACTION') AS n_transactions,
               count(*) FILTER (object_type = 'CURRENCY') AS n_currencies,
               count(DISTINCT object_type) = 2 AS loaded
        FROM outbox GROUP BY sent_date"""),
    "csv_interchange": _with("fx_tx", """
        SELECT operation_id, account_number_from, account_number_to, currency_code,
               ' "' || country || '", ' || status AS country, status, transaction_type, amount,
               transaction_dt
        FROM fx_tx"""),
    "csv_interchange_currencies": _with("fx_rates", f"SELECT {RATE} FROM fx_rates"),
    "staging_load": _with("tx_staging", f"{STAGED} tx_staging"),
    "key_violations": _with("tx_staging", f"""
        SELECT operation_id, status, CAST(2 AS BIGINT) AS n_rows FROM tx_staging
        WHERE load_date = {DAY}"""),
    "key_violations_currencies": _with("fx_rates", f"""
        SELECT date_update, currency_code, currency_code_with, CAST(2 AS BIGINT) AS n_rows
        FROM fx_rates WHERE day = {DAY}"""),
    "load_faults": _with("tx_staging, fx_rates", f"""
        SELECT 'TRANSACTION' AS object_type, 'repeated_key' AS fault, operation_id || '|' || status AS key,
               CAST(2 AS BIGINT) AS n_rows
        FROM tx_staging WHERE load_date = {DAY}
        UNION ALL
        SELECT 'CURRENCY', 'repeated_key', CAST(date_update AS VARCHAR) || '|' || currency_code || '|'
               || currency_code_with, 2
        FROM fx_rates WHERE day = {DAY}
        UNION ALL
        SELECT DISTINCT 'CURRENCY', 'base_to_base', CAST(date_update AS VARCHAR) || '|420|420', 1
        FROM fx_rates WHERE day = {DAY}"""),
    "staging_layout": _with("tx_staging", """
        SELECT load_date, event_date, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_misplaced,
               CAST(0 AS BIGINT) AS n_unordered
        FROM tx_staging GROUP BY load_date, event_date"""),
    "bookmark_read": _with("bookmarks, outbox", """
        SELECT workflow_key, date_to_load FROM bookmarks WHERE workflow_key = 'click'
        UNION ALL
        SELECT 'never_run', min(sent_date) FROM outbox"""),
    "bookmark_upsert": _with("bookmarks", """
        SELECT workflow_key, date_to_load FROM bookmarks WHERE workflow_key <> 'click'
        UNION ALL
        SELECT k, CAST(min(ts) AS DATE) + 1 FROM events
               CROSS JOIN (VALUES ('click'), ('never_run')) AS keys(k) GROUP BY k"""),
    "import_days": _with("imported", f"{STAGED} imported"),
    "import_day": _with("imported", f"{STAGED} imported"),
    "import_day_bookmark": _with("outbox", """
        SELECT 'outbox_to_staging' AS workflow_key, max(sent_date) + 1 AS date_to_load FROM outbox"""),
    "import_days_currencies": _with("fx_rates", f"""
        SELECT {RATE}, day AS load_date, day AS event_date FROM fx_rates"""),
    "import_rejects": _with("odd", """
        SELECT object_id, 'bad:' || bad AS reason, 'TRANSACTION' AS object_type, load_date FROM odd
        WHERE bad IS NOT NULL AND extract(day FROM load_date) NOT IN (10, 20, 30)"""),
    "oldest_staging_day": _with("tx_staging", """
        SELECT CAST(min(transaction_dt) AS DATE) AS oldest_day FROM tx_staging"""),
    "drop_test_accounts": _with("tx_staging", f"""
        SELECT {TX} FROM tx_staging WHERE account_number_from >= 0"""),
    "latest_status": _with("ranked", "SELECT * FROM ranked"),
    "latest_status_since": _with("ranked", f"""
        SELECT * FROM ranked WHERE CAST(transaction_dt AS DATE) >= {DAY}"""),
    "done_on_day": _with("done", "SELECT * FROM done"),
    "rates_on_day": _with("fx_rates", f"""
        SELECT currency_code, currency_code_with, currency_with_div, day AS date_update
        FROM fx_rates WHERE day <= {DAY}"""),
    "convert_to_base": _with("rows", "SELECT * FROM rows WHERE currency_code <> 420"),
    "convert_to_base_salted": _with("rows", "SELECT * FROM rows WHERE currency_code <> 420"),
    "base_currency_rows": _with("rows", "SELECT * FROM rows WHERE currency_code = 420"),
    "union_branches": _with("rows", "SELECT * FROM rows"),
    "global_metrics": _with("metrics", "SELECT * FROM metrics"),
    "global_metrics_minus_one": _with("metrics_minus_one", "SELECT * FROM metrics_minus_one"),
    "global_metrics_by_rows": _with("metrics", "SELECT * FROM metrics"),
    # A group's total is its amounts times its rates; the wide ones have ten places here.
    "global_metrics_wide_rates": _with("metrics, done, fx_rates", """
        SELECT m.date_update, currency_from,
               CASE WHEN currency_from IN (430, 440) THEN w.total ELSE m.amount_total END AS amount_total,
               cnt_transactions, avg_transactions_per_account, cnt_accounts_make_transactions
        FROM metrics AS m LEFT JOIN (
            SELECT date_update, currency_code,
                   CAST(round(CAST(sum(amount) AS DECIMAL(12, 0))
                        * CASE currency_code WHEN 430 THEN CAST('0.0000000004' AS DECIMAL(20, 10))
                                             ELSE CAST('250000000' AS DECIMAL(20, 10)) END, 0)
                        * CAST('0.01' AS DECIMAL(3, 2)) AS DECIMAL(18, 2)) AS total
            FROM done GROUP BY date_update, currency_code) AS w
          ON w.date_update = m.date_update AND w.currency_code = m.currency_from"""),
    "refresh_after_load": _with("metrics", "SELECT * FROM metrics"),
    "merge_metrics": _with("metrics, metrics_minus_one", f"""
        SELECT {METRICS} FROM metrics WHERE date_update >= {MART_FROM}
        UNION ALL
        SELECT {METRICS} FROM metrics_minus_one AS m
        WHERE date_update <= {DAY} AND NOT EXISTS (
            SELECT 1 FROM metrics AS n WHERE n.date_update >= {MART_FROM}
               AND n.date_update = m.date_update AND n.currency_from = m.currency_from)"""),
    "update_datamart_day": _with("metrics, tx_staging", """
        SELECT * FROM metrics
        WHERE date_update < (SELECT CAST(min(transaction_dt) AS DATE) + 3 FROM tx_staging)"""),
    "update_datamart_bookmark": _with("tx_staging", """
        SELECT 'staging_to_mart' AS workflow_key,
               CAST(min(transaction_dt) AS DATE) + 1 AS date_to_load
        FROM tx_staging"""),
    "backfill_range": _with("metrics", "SELECT * FROM metrics"),
    "backfill_stored_mart": _with("metrics, metrics_minus_one", f"""
        SELECT {METRICS} FROM metrics WHERE date_update >= {DAY}
        UNION ALL
        SELECT {METRICS} FROM metrics_minus_one WHERE date_update < {DAY}"""),
    "messages_to_mart": _with("metrics_imported", "SELECT * FROM metrics_imported"),
}
ORACLE["keyed_ingest_rejects"] = ORACLE["message_rejects"]
ORACLE["kafka_sink_stream"] = ORACLE["kafka_sink_encode"]
