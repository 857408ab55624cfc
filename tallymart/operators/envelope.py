"""Message envelope: decode, check, type.

Each step adds to ``reason``, the first fault found, and drops no row. ``accepted`` and ``rejected``
split at the end, so accepted plus rejected is always the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import canonical_uuid, json_texts
from ..functions.time import parse_sent_dttm
from ..schemas import LOAD_SRC, MESSAGE_REJECTS, OUTBOX, REQUIRED_FIELDS
from .once import computed_once


#: What tells the members' types: the last one counts where a key is repeated.
_TYPES = "object_id variant, object_type variant, payload map<string, string>"
_STRICT = {"allowSingleQuotes": "false"}


def _items(text: Column) -> Column:
    """Two array items, the second one 0, if the text is one JSON value with nothing after it.

    Spark's parsers stop after the first value and ignore what follows, so the text is parsed as the
    first of two array items; text after the value then breaks the array.
    """
    return F.from_json(F.concat(F.lit("["), text, F.lit(",0]")), "array<string>", _STRICT)


def _members(text: Column, types: Column, payload: Column) -> Column:
    """What the text of members cannot tell: which are there, and of what type they are."""
    is_text = lambda name: F.coalesce(
        F.schema_of_variant(types[name]) == "STRING", F.lit(False))
    return F.struct(
        F.coalesce(F.json_object_keys(text), F.array().cast("array<string>")).alias("names"),
        is_text("object_id").alias("id_is_text"),
        is_text("object_type").alias("type_is_text"),
        # A later value that is no object leaves the earlier one in ``types``, but not in the text.
        (types["payload"].isNotNull() & payload.startswith("{")).alias("payload_is_object"))


def decode_envelope(messages: DataFrame) -> DataFrame:
    """Read ``value`` (STRING or BINARY) as JSON and lift the envelope members as text.

    ``doc`` keeps what text cannot tell: whether a member is missing or null, and whether the
    payload is an object or a string that looks like one. Of a repeated key the last value counts.
    """
    text = F.col("value").cast("string")
    alone = F.is_valid_utf8("value") & (F.size("items") == 2) & (F.get("items", F.lit(1)) == "0")
    return (
        messages
        .withColumn("value", text)
        .withColumn("types", F.from_json("value", _TYPES))
        .withColumn("env", json_texts(F.col("value"), REQUIRED_FIELDS))
        .withColumn("items", _items(F.col("value")))
        .withColumn("alone", F.coalesce(alone, F.lit(False)))
        .select(
            *messages.columns,
            _members(F.col("value"), F.col("types"), F.col("env.payload")).alias("doc"),
            *[F.when(F.col("alone"), F.col(f"env.{name}")).alias(name) for name in REQUIRED_FIELDS],
            F.when(~F.col("alone"), "bad_json").alias("reason"),
        )
    )


def require_fields(decoded: DataFrame, fields=REQUIRED_FIELDS) -> DataFrame:
    """Name the first missing key. A key whose value is null is present."""
    missing = F.coalesce(*[F.when(~F.array_contains("doc.names", name), f"missing:{name}")
                          for name in fields])
    return decoded.withColumn("reason", F.coalesce("reason", missing))


def type_envelope(decoded: DataFrame, load_src: str = LOAD_SRC) -> DataFrame:
    """Typed envelope: canonical UUID, TIMESTAMP_NTZ, object payload, constant source."""
    object_id = F.when(F.col("doc.id_is_text"), canonical_uuid(F.col("object_id")))
    sent_dttm = parse_sent_dttm(F.col("sent_dttm"))  # only a text has this form
    fault = (
        F.when(F.col("typed_id").isNull(), "bad_uuid")
        .when(F.col("typed_dttm").isNull(), "bad_timestamp")
        .when(~F.col("doc.payload_is_object"), "bad_payload")
        .when(~F.col("doc.type_is_text"), "bad_object_type")
    )
    others = [name for name in decoded.columns if name not in ("doc", "reason", *REQUIRED_FIELDS)]
    typed = (
        decoded
        .withColumn("typed_id", object_id)
        .withColumn("typed_dttm", sent_dttm)
        .select(
            *others,
            F.col("typed_id").alias("object_id"),
            "object_type",
            F.col("typed_dttm").alias("sent_dttm"),
            "payload",
            F.lit(load_src).alias("load_src"),
            F.to_date("typed_dttm").alias("sent_date"),
            F.coalesce("reason", fault).alias("reason"),
        )
    )
    return computed_once(typed, keep=others)


def read_envelope(messages: DataFrame) -> DataFrame:
    """All three steps."""
    return type_envelope(require_fields(decode_envelope(messages)))


def accepted(typed: DataFrame) -> DataFrame:
    """Outbox rows, with ``partition`` and ``offset`` kept for the arrival order."""
    return typed.where(F.col("reason").isNull()).select(*OUTBOX.names, "partition", "offset")


def rejected(typed: DataFrame) -> DataFrame:
    """Messages at fault, with their position; ``topic`` is empty for a source without one."""
    topic = F.coalesce("topic", F.lit("")) if "topic" in typed.columns else F.lit("")
    return (typed.where(F.col("reason").isNotNull()).withColumn("topic", topic)
            .select(*MESSAGE_REJECTS.names))
