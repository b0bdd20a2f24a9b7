"""The per-row operators on a stream: evidence arrives in files and leaves as date and event-type rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossier.operators.units import dates_of, disclosed_counts, event_types


def annotated(units: DataFrame, text: str = "line") -> DataFrame:
    """Types, dates and disclosed counts of each unit; works on batch and streaming DataFrames alike, as no row needs another."""
    c = F.col(text)
    return units.select("*", event_types(c).alias("event_types"), dates_of(c).alias("dates"), disclosed_counts(c).alias("counts"))


def daily_types(units: DataFrame, time: str = "ts", text: str = "line", late: str = "2 days") -> DataFrame:
    """Event types by day with a watermark, so that late rows close after `late`."""
    t = units.withWatermark(time, late).select(time, F.explode(event_types(F.col(text))).alias("event_type"))
    return t.groupBy(F.window(time, "1 day"), "event_type").count()
