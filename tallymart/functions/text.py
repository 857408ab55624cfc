"""JSON text and identifier expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_texts(json: Column, names: Iterable[str]) -> Column:
    """Struct of the named members as text, NULL where missing or null.

    Every member is read as STRING, so ``5`` and ``"5"`` both give ``5`` and a nested value keeps
    its JSON text. One parse serves all members: put the struct in its own ``withColumn`` and
    select from it, as ``from_json(...).*`` written in one step is parsed once per member.
    """
    return F.from_json(json, ", ".join(f"`{name}` STRING" for name in names))


_HEX_GROUPS = r"([0-9a-fA-F]{8})-?([0-9a-fA-F]{4})-?([0-9a-fA-F]{4})-?([0-9a-fA-F]{4})-?([0-9a-fA-F]{12})"
_USUAL_UUID = r"\A\{?" + _HEX_GROUPS + r"\}?\z"
_BARE_UUID = r"\A" + _HEX_GROUPS.replace("-?", "") + r"\z"
_HYPHENS = "$1-$2-$3-$4-$5"


def canonical_uuid(text: Column) -> Column:
    """Lower-case 8-4-4-4-12 form; NULL when the text is no UUID.

    Accepts braces, a ``urn:uuid:`` prefix, capitals, and any placing of the hyphens. The usual
    forms take two regex passes; only others are stripped first.
    """
    bare = F.replace(F.replace(text, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    bare = F.replace(F.btrim(bare, F.lit("{}")), F.lit("-"), F.lit(""))
    return F.lower(
        F.when(text.rlike(_USUAL_UUID), F.regexp_replace(text, _USUAL_UUID, _HYPHENS))
        .when(bare.rlike(_BARE_UUID), F.regexp_replace(bare, _BARE_UUID, _HYPHENS)))


def number_text(text: Column) -> Column:
    """The text if it is a finite decimal number, else NULL.

    Spark's cast to DOUBLE also takes ``NaN``, ``inf`` and Java suffixes such as ``1d``.
    """
    return F.when(text.rlike(r"\A\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"), text)
