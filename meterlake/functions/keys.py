"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what keys put between their parts.
KEY_SEPARATOR = "||"


def surrogate_key(*parts: str | Column) -> Column:
    """SHA-256 over the text of the parts. Null parts are skipped, not replaced."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *texts), 256)
