"""JSON text in one canonical form, for strings whose hashes must agree.

Two blanks of indent, keys in the order of the text (of a repeated key the first place and the last
value), ASCII escapes, and numbers as Python writes them: whole numbers with all digits, others by
the shortest digits that give the same double. Only Python's writer is just this writer, so one
Arrow-batched function calls it; everything around it stays in the JVM.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def indented_json(text: Column, keep: tuple[str, ...] | None = None, drop: tuple[str, ...] = ()) -> Column:
    """The JSON in ``text``, indented; of an object only the keys in ``keep``, where given, and none
    in ``drop``. Null for a null text and for what is no JSON."""

    def one(value: str | None) -> str | None:
        try:
            read = json.loads(value) if value is not None else None
        except ValueError:
            return None
        if value is None:
            return None
        if isinstance(read, dict):
            read = {k: v for k, v in read.items() if k not in drop and (keep is None or k in keep)}
        return json.dumps(read, indent=2)

    def batch(values: pd.Series) -> pd.Series:
        return values.map(one, na_action="ignore").astype(object)

    return written(batch)(text)


def written(batch: Callable[[pd.Series], pd.Series]):
    batch.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(batch, StringType())
