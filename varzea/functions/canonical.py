"""One text for each JSON value, and its hash: keys sorted at every depth, ASCII only, a blank after each comma and colon.

Numbers keep their kind (1, 1.0 and 1e0 are an integer and two equal floats), the last of equal keys counts, and what is no
JSON has no text. The recursion runs over Arrow batches; strings, structs, maps and arrays may come in.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def canonical_text(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        return json.dumps(json.loads(text), sort_keys=True)
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(StringType())
def _canonical(texts: pd.Series) -> pd.Series:
    return texts.map(canonical_text)


def canonical_json(x: Column, is_text: bool = True) -> Column:
    """Of a column of JSON texts, or (`is_text` false) of structs, maps or arrays, whose null fields stay."""
    return _canonical(x if is_text else F.to_json(x, {"ignoreNullFields": "false"}))


def content_hash(x: Column, is_text: bool = True) -> Column:
    """SHA-256 of the canonical text in hex."""
    return F.sha2(canonical_json(x, is_text), 256)
