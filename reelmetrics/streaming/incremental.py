"""Incremental collection: overlap window, skip what is there, re-runnable keyed loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from reelmetrics.functions.coerce import LOOKBACK_DAYS, look_back
from reelmetrics.operators.aggregates import high_water_mark
from reelmetrics.operators.dedup import keep_last_merge
from reelmetrics.operators.joins import pending
from reelmetrics.sources.dated import moment as moment_of, read_days
from reelmetrics.sources.keyed import upsert


def window_start(known: DataFrame, name: str = "publishedAt", days: int = LOOKBACK_DAYS) -> str:
    """Start of the next collection: the mark minus the overlap, one scalar for the driver."""
    mark = high_water_mark(known, name).select(look_back(F.col("mark").cast("string"), days).alias("start"))
    return mark.first()["start"]


def in_window(
    items: DataFrame, start: str, end: str | None = None, name: str = "publishedAt", undated: bool = True
) -> DataFrame:
    """Items published inside [start, end], without an end all from ``start`` on.

    Items without a readable date can't be shown to be old, so they stay unless ``undated`` is
    off. The bounds are literals; on a timestamp column they prune files, on text they don't
    (``read_new`` reads a table that lies by day).
    """
    moment = moment_of(items, name)
    kind = items.select(moment.alias("m")).schema["m"].dataType.simpleString()

    def bound(text: str) -> Column:
        return F.lit(text.replace("T", " ").rstrip("Z")).cast(kind)

    inside = moment >= bound(start)
    if end is not None:
        inside = inside & (moment <= bound(end))
    return items.where(inside | moment.isNull() if undated else inside)


def collect_new(
    known: DataFrame, items: DataFrame, name: str = "publishedAt", days: int = LOOKBACK_DAYS, end: str | None = None
) -> DataFrame:
    """Items at or after the known mark minus the overlap, and undated ones."""
    return in_window(items, window_start(known, name, days), end, name)


def read_new(
    spark: SparkSession,
    known: DataFrame,
    path: str,
    name: str = "publishedAt",
    days: int = LOOKBACK_DAYS,
    end: str | None = None,
    undated: bool = True,
) -> DataFrame:
    """As ``collect_new``, over a table that ``write_by_day`` wrote: only the window's days are read."""
    start = window_start(known, name, days)
    return in_window(read_days(spark, path, start, end, undated), start, end, name, undated)


def append_pending(
    old: DataFrame, incoming: DataFrame, skip_key: str, row_key: str, order: tuple[str, ...] = ()
) -> DataFrame:
    """Old rows plus incoming rows of groups not collected yet; later rows of a key win.

    This moves the old rows; a history that grows load by load is kept with ``sources.history``.
    """
    return keep_last_merge(old, pending(incoming, old, skip_key), [row_key], list(order))


def stream_upsert(
    source: DataFrame, root: str, key: str, checkpoint: str, order: str | None = None
) -> StreamingQuery:
    """Load every new file of a streaming source into a keyed table and stop.

    A batch that is delivered again sets the same rows again, so the table does not change.
    """
    return (
        source.writeStream.foreachBatch(lambda batch, _: upsert(batch, root, key, order))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
