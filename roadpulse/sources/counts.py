"""Reading road counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.cleaning import MissingColumns
from roadpulse.schemas import CLEAN_COUNTS, NULL_TEXTS, PROFILE_REQUIRED

# File names of the raw counts, best first.
RAW_FILES = ("dft_traffic_counts_raw_counts.csv", "dft_traffic_counts.csv")


def find_raw_file(spark: SparkSession, folder: str) -> str:
    """The counts file of a folder: a known name if there, else any CSV."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][sS][vV]").load(folder).select("path")
    )
    name = F.element_at(F.split("path", "/"), -1)
    rank = F.coalesce(F.array_position(F.array(*[F.lit(n) for n in RAW_FILES]), name), F.lit(0))
    best = files.orderBy(F.when(rank > 0, rank).otherwise(99), "path").limit(1).first()
    if best is None:
        raise FileNotFoundError(f"no CSV in {folder}")
    return best["path"]


def read_raw_counts(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file, glob, or folder (its counts file) with every column as text.

    Columns follow the header, so their order and extra columns do not matter; only the
    header line is read before the scan.
    """
    file = path if path.lower().endswith(".csv") or "*" in path else find_raw_file(spark, path)
    return spark.read.option("header", True).option("escape", '"').csv(file)


def read_clean_counts(spark: SparkSession, path: str, *, form: str = "parquet") -> DataFrame:
    """The clean table with its types; columns beyond the schema pass through. In the CSV form the
    usual texts for a missing value are null."""
    if form == "parquet":
        df = spark.read.parquet(path)
    elif form == "csv":
        text = spark.read.option("header", True).option("escape", '"').csv(path)
        types = {f.name: f.dataType for f in CLEAN_COUNTS.fields}
        known = {c: F.when(~F.col(f"`{c}`").isin(*NULL_TEXTS), F.col(f"`{c}`")) for c in text.columns}
        df = text.select(*[v.try_cast(types[c]).alias(c) if c in types else v.alias(c) for c, v in known.items()])
    else:
        raise ValueError(f"unknown form: {form}")
    absent = sorted(set(PROFILE_REQUIRED) - set(df.columns))
    if absent:
        raise MissingColumns(", ".join(absent))
    return df
