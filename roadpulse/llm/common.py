"""Small helpers of the training-data operators."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from roadpulse.session import checkpoint_dir, configure

# ASCII white space as the contracts define it.
ASCII_SPACE = " \t\n\x0b\x0c\r"


_shipped: set[str] = set()


def prepared(spark: SparkSession) -> SparkSession:
    """The session with its settings, and with this package sent to the executors, whose Python
    tasks import it. Sent once per application, as any job sends its own modules."""
    context = configure(spark).sparkContext
    package = Path(__file__).resolve().parent.parent
    if context.applicationId not in _shipped and package.is_dir():
        folder = os.path.realpath(tempfile.mkdtemp(prefix="roadpulse-code-"))
        context.addPyFile(shutil.make_archive(f"{folder}/roadpulse-code", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark only (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share."""
    root = checkpoint_dir(spark)
    root = root if "://" in root or root.startswith("file:") else f"file://{root}"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage, outlives
    lost executors, and lets later jobs prune columns."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_slices(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``max_bytes``, however long single texts are: a slice
    is halved while it is above the bound and has more than one row. No row is dropped."""
    for batch in batches:
        waiting = [batch]
        while waiting:
            part = waiting.pop()
            if part.num_rows > 1 and part.nbytes > max_bytes:
                half = part.num_rows // 2
                waiting += [part.slice(half), part.slice(0, half)]
            elif part.num_rows:
                yield part


_UNEVEN = re.compile(r"^\s|\s\s|\s$")


def is_even(text: str) -> bool:
    """Whether all white space of a text is single and inside, so that every space is a lone one."""
    return len(text.split()) == text.count(" ") + text.count("\n") + 1 or _UNEVEN.search(text) is None


def hashed_below(column: Column, parts: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest`` on division by ``parts``; false for null."""
    return F.coalesce(F.crc32(column.cast("string")) % parts == rest, F.lit(False))


def clean_name(taken: list[str], wanted: str) -> str:
    """``wanted``, or a variant that clashes with none of ``taken`` (case is ignored, as Spark does)."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted


def with_column_type(schema: StructType, name: str, kind: str) -> StructType:
    """``schema`` and one more column, its type given as DDL."""
    return StructType([*schema.fields, StructField(name, StructType.fromDDL(f"c {kind}").fields[0].dataType)])
