"""The Arrow batch function: what Spark has no expression for.  It takes and returns whole columns of a batch."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUOTES = str.maketrans({"“": '"', "”": '"', "‘": "'", "’": "'"})


def _match_text(value: str | None) -> str:
    text = unicodedata.normalize("NFKC", value or "").translate(_QUOTES)
    return " ".join(text.split()).casefold()


@F.pandas_udf(T.StringType())
def match_text(values: pd.Series) -> pd.Series:
    """NFKC, straight quotes, single blanks, case folded: the form quotes are compared in."""
    return values.map(_match_text)
