"""Keep a filter above the columns it tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``df`` with all columns but ``keep`` computed before any later filter on them.

    Catalyst pushes a filter below the projection that computes its column by putting the whole
    expression into the filter. For a verdict over parsed JSON this repeats the parse for every
    member it looks at, and once more for the rows that pass. A one-row ``inline`` stops the push.
    """
    columns = [name for name in df.columns if name not in keep]
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))
