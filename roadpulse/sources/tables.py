"""Choosing and reading stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.schemas import STORED_GOLD

# A longer window than this is read from the whole table instead of naming its hours.
LISTED_HOURS = 2000


def first_available(sources: Sequence[DataFrame]) -> DataFrame:
    """The first source that has any row, else the last. One row of a source tells, so the
    sources after the chosen one are never run, and the chosen one alone is in the plan."""
    return next((df for df in sources if not df.isEmpty()), sources[-1])


def prefer_root(roots: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of several writers of one table: for every key, those of the first root that has it."""
    tagged = reduce(DataFrame.unionByName, [
        df.withColumn("source_root", F.lit(i)) for i, df in enumerate(roots)
    ])
    # Null key columns are values of their own here, so they join as such.
    firsts = tagged.groupBy(*keys).agg(F.min("source_root").alias("_first")).select(
        *[F.col(k).alias(f"_{k}") for k in keys], "_first"
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return tagged.join(firsts, same & (F.col("source_root") == F.col("_first")), "left_semi")


def failover_union(roots: Sequence[DataFrame], batch: str = "batch_id") -> DataFrame:
    """One table that batches wrote to several roots, each batch wholly to one of them.

    Every batch of every root counts; a batch that several roots hold (it failed over, and a
    retry reached the first root) comes from the first of them. Different batches of one minute
    both stay. The batch ids are few, so the join needs no exchange of the rows.
    """
    return prefer_root(roots, [batch]).drop("source_root")


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A parquet table under a fixed schema, or no rows where it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing.getCondition()):
            raise
        return spark.createDataFrame([], schema)


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """JSON lines under a fixed schema; blank and broken lines are skipped."""
    paths = path if isinstance(path, str) else list(path)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(paths)


def list_files(spark: SparkSession, roots: Sequence[str], *, max_depth: int | None = None) -> DataFrame:
    """Data files (path, modified, size) below the roots, each once, at any depth unless
    ``max_depth`` says otherwise. Contents are not read; a root that does not exist has no files."""
    found = [spark.createDataFrame([], "path string, modified timestamp, size bigint")]
    for root in dict.fromkeys(roots):
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing.getCondition()):
                raise
            continue
        if max_depth is not None:
            # Folders between the root and the file; the root itself is level one.
            below = F.regexp_replace("path", r"^.*?" + _quoted(root.rstrip("/")) + "/", "")
            files = files.where(F.size(F.split(below, "/")) <= max_depth)
        found.append(files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size")))
    return reduce(DataFrame.unionByName, found).distinct()


def _quoted(text: str) -> str:
    return r"\Q" + text.split("://")[-1] + r"\E"


def recent_files(spark: SparkSession, roots: Sequence[str], k: int, *, max_depth: int | None = None) -> DataFrame:
    """The ``k`` newest files, oldest of them first."""
    newest = list_files(spark, roots, max_depth=max_depth).orderBy(F.desc("modified"), F.desc("path")).limit(k)
    return newest.orderBy("modified", "path")


def read_recent(spark: SparkSession, roots: Sequence[str], schema: T.StructType, since: datetime) -> DataFrame:
    """Rows of all JSON-lines files changed at or after ``since`` (UTC), at any depth below the
    roots; absent roots have none. No path reaches the driver."""
    found = [spark.createDataFrame([], schema)]
    # The option means "strictly later", to the second.
    after = (since - timedelta(seconds=1)).strftime("%Y-%m-%dT%H:%M:%S")
    for root in dict.fromkeys(roots):
        try:
            found.append(
                spark.read.schema(schema).option("mode", "DROPMALFORMED").option("recursiveFileLookup", True)
                .option("modifiedAfter", after).option("timeZone", "UTC").json(root)
            )
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing.getCondition()):
                raise
    return reduce(DataFrame.unionByName, found)


def read_gold_window(
    spark: SparkSession, path: str, minutes: int, newest: datetime | None, *, schema: T.StructType | None = None
) -> DataFrame:
    """The trailing window of a stored gold table (``dt=/hour=/batch_id=``) before ``newest``.

    ``newest`` comes from the job's high-water mark, so nothing is scanned to find it. Only the
    folders of the window's hours are listed: the cost does not grow with the table's age.
    """
    if newest is None:
        return table_or_empty(spark, path, schema or STORED_GOLD)
    if minutes <= 0:
        return table_or_empty(spark, path, schema or STORED_GOLD)
    start = newest - timedelta(minutes=minutes)
    inside = (F.col("event_timestamp") >= F.lit(start)) & (F.col("event_timestamp") <= F.lit(newest))
    if minutes > LISTED_HOURS * 60:
        return table_or_empty(spark, path, schema or STORED_GOLD).where(inside)
    reader = spark.read.schema(schema or STORED_GOLD)
    # Folders are named in UTC, the session's zone.
    first = start.astimezone(timezone.utc).replace(minute=0, second=0, microsecond=0)
    hours = [first + timedelta(hours=n) for n in range(int((newest.astimezone(timezone.utc) - first) / timedelta(hours=1)) + 1)]
    folders = "{" + ",".join(h.strftime("dt=%Y%m%d/hour=%H") for h in hours) + "}"
    try:
        rows = reader.option("basePath", path).parquet(f"{path.rstrip('/')}/{folders}")
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing.getCondition()):
            raise
        return spark.createDataFrame([], schema or STORED_GOLD)
    return rows.where(inside)
