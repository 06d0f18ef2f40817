"""Audit columns of ingested rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_audit_columns(
    df: DataFrame,
    run_id: str,
    source_file: str = "_metadata.file_path",
    ingested_at: dt.datetime | None = None,
) -> DataFrame:
    """Ingestion time and date, source file and run id.

    ``source_file`` names the column holding the file path; the file source's own hidden
    column by default, which exists only directly on a file scan. ``ingested_at`` is taken
    as the clock when not given.
    """
    moment = F.current_timestamp() if ingested_at is None else F.lit(ingested_at)
    return df.withColumns(
        {
            "ingestion_timestamp": moment,
            "ingestion_date": F.to_date(moment),
            "source_file_name": F.col(source_file),
            "batch_id": F.lit(run_id),
        }
    )
