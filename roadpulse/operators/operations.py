"""Health of the pipeline from its run log, its files and component metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.display import (
    NOT_AVAILABLE, format_bytes, format_lag, format_size, humanize_seconds, one_decimal,
)

PIPELINE_DELAY_SECONDS = 180
TABLE_STALE_SECONDS = 120


def pipeline_freshness(run_log: DataFrame, now: Column) -> DataFrame:
    """Last flush of every component with its lag and status; ``now`` in epoch seconds."""
    entry = F.struct("batch_id", "last_flush_time", "total_events", "gold_records")
    last = run_log.groupBy("component").agg(
        F.max_by(entry, F.struct("last_flush_time", "batch_id")).alias("r")
    )
    flush = F.coalesce("r.last_flush_time", F.lit(0.0))
    lag = F.when(flush > 0, now.cast("double") - flush)
    human = humanize_seconds(lag)
    metric = lambda name, shown: F.concat(F.lit(f"{name}: "), F.coalesce(shown.cast("string"), F.lit(NOT_AVAILABLE)))
    return last.select(
        "component",
        F.lit("pipeline").alias("category"),
        F.when(lag.isNull(), "unknown").when(lag > PIPELINE_DELAY_SECONDS, "delayed").otherwise("ok").alias("status"),
        lag.alias("lag_seconds"),
        F.col("r.total_events").alias("total_events"),
        F.col("r.gold_records").alias("gold_records"),
        human.alias("human_lag"),
        F.concat_ws(
            " | ", metric("Lag", human), metric("Events", F.col("r.total_events")),
            metric("Gold records", F.col("r.gold_records")),
        ).alias("summary"),
        F.when(flush > 0, F.date_format(F.timestamp_seconds(flush), "yyyy-MM-dd'T'HH:mm:ssxxx")).alias("updated_at"),
    )


def table_freshness(files: DataFrame, now: Column) -> DataFrame:
    """Age and size of every table; ``files`` holds (table, modified, size)."""
    newest = files.groupBy("table").agg(F.max("modified").alias("modified"), F.sum("size").alias("size_bytes"))
    lag = now.cast("double") - F.col("modified").cast("double")
    return newest.select(
        "table",
        F.when(lag < TABLE_STALE_SECONDS, "ok").otherwise("stale").alias("status"),
        lag.alias("lag_seconds"), "size_bytes",
        humanize_seconds(lag).alias("human_lag"),
        format_bytes(F.col("size_bytes")).alias("human_size"),
    )


def resource_rows(payload: DataFrame) -> DataFrame:
    """Rows of a status payload: those of its ``sections`` first, then its own, numbered in order."""
    sections = F.flatten(F.transform(F.coalesce("sections", F.array()), lambda s: F.coalesce(s["rows"], F.array())))
    return payload.select(
        F.posexplode(F.concat(sections, F.coalesce("rows", F.array()))).alias("ord", "row")
    ).select("ord", "row.*")


# Names of the shown metrics in status payloads, best first, and the categories left out.
MEMORY_NAMES = ("ram usada", "ram", "memoria")
STORAGE_NAMES = ("almacenamiento", "tamano", "uso")
STORAGE_FALLBACK = ("uso", "tamano")
CPU_NAMES = ("cpu", "porcentaje")
NOT_COMPONENTS = ("storage", "system")


def _metric(metrics: Column, names: Sequence[str]) -> Column:
    """The first of ``names`` among the metrics; the last entry of a repeated name wins."""

    def last(name: str) -> Column:
        same = F.filter(metrics, lambda m: F.lower(F.trim(m["name"])) == name)
        return F.get(F.reverse(same), F.lit(0))

    return F.coalesce(*[last(n) for n in names])


def _shown(metric: Column) -> Column:
    value, unit = metric["value"], metric["unit"]
    number = value.try_cast("double")
    return F.coalesce(
        F.nullif(metric["human"], F.lit("")),
        F.when(value.isNull() | F.isnan(F.coalesce(number, F.lit(0.0))), F.lit(None).cast("string"))
        .when(unit == "bytes", format_size(number))
        .when(unit == "percent", F.concat(one_decimal(number), F.lit("%")))
        .when(value.rlike(r"^-?\d+$") | number.isNull(), value)
        .otherwise(F.format_string("%.2f", F.bround(number, 2))),
    )


def component_metrics(rows: DataFrame, order: str = "ord") -> DataFrame:
    """Latest row of every component as a display table.

    ``rows``: component, status, category, human_lag, lag_seconds, usage_percent, metrics
    and an order column. Rows without a component are separate components.
    """
    fields = ["component", "status", "category", "human_lag", "lag_seconds", "usage_percent", "metrics"]
    named = F.nullif("component", F.lit(""))
    key = F.coalesce(F.concat(F.lit("c"), named), F.concat(F.lit("#"), F.col(order).cast("string")))
    last = rows.groupBy(key.alias("_key")).agg(F.max_by(F.struct(*fields), order).alias("r")).select("r.*")
    last = last.where(~F.coalesce("category", F.lit("")).isin(*NOT_COMPONENTS))
    m = F.col("metrics")
    memory = _shown(_metric(m, MEMORY_NAMES))
    storage = F.coalesce(_shown(_metric(m, STORAGE_NAMES)), _shown(_metric(m, STORAGE_FALLBACK)))
    usage = F.col("usage_percent").try_cast("double")
    cpu = F.coalesce(
        _shown(_metric(m, CPU_NAMES)),
        F.when(usage.isNotNull() & ~F.isnan(usage), F.concat(one_decimal(usage), F.lit("%"))),
    )
    shown = lambda c: F.coalesce(c, F.lit(NOT_AVAILABLE))
    return last.select(
        F.coalesce(named, F.lit("desconocido")).alias("component"),
        F.coalesce(F.nullif("status", F.lit("")), F.lit("unknown")).alias("status"),
        F.coalesce(F.nullif("human_lag", F.lit("")), format_lag(F.col("lag_seconds"))).alias("latency"),
        shown(memory).alias("memory"), shown(storage).alias("storage"), shown(cpu).alias("cpu"),
    ).orderBy(F.lower("component"))
