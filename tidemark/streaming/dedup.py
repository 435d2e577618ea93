"""Repeated samples removed on the stream, within a window of arrival time.

A sample is told by its asset and instant. The state holds one key for each sample that
arrived within the window, whatever its own time: the watermark runs on the time rows are
processed at, so a sample of an old day is not late and never dropped for its age. Copies
that arrive further apart than the window are both let through, for `ingest.dedup_observations`
or `raw.merge_raw` to settle; where copies disagree the one processed first stays. Rows
without an asset or an instant are no samples: equal keys do not make them copies, and all
of them pass.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schema as s
from tidemark.operators.bronze import to_bronze
from tidemark.streaming.bronze import append_stream, raw_stream

# overlapping loads follow each other within days; a week leaves room for retries
WINDOW = "7 days"

_ARRIVED = "_arrived"
_EXTRA = "_extra"


def drop_repeats(rows: DataFrame, window: str = WINDOW, keys: tuple[str, ...] = (s.ID, s.TIMESTAMP)) -> DataFrame:
    """A stream of rows without those whose keys arrived before, within `window`.

    Keys are shuffled as they are, one row each; the state is spread over the session's shuffle
    partitions, which a checkpoint fixes when it is made.
    """
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    # incomplete rows get a key of their own
    stamped = rows.withColumn(_ARRIVED, F.current_timestamp()).withColumn(_EXTRA, F.when(~whole, F.uuid()))
    return (
        stamped.withWatermark(_ARRIVED, window)
        .dropDuplicatesWithinWatermark([*keys, _EXTRA])
        .drop(_ARRIVED, _EXTRA)
    )


def bronze_stream_dedup(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType = s.RAW,
    ingested_at: dt.datetime | str | None = None,
    files_per_batch: int | None = None,
    window: str = WINDOW,
) -> StreamingQuery:
    """Load raw files not seen before into bronze, each sample once, and stop."""
    rows = drop_repeats(raw_stream(spark, source, schema, files_per_batch), window)
    return append_stream(to_bronze(rows, ingested_at), target, checkpoint, s.LOAD_DAY)
