"""Readers and writers. Sessions are passed in; sinks stay distributed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlytics.functions.frames import lower_names
from eventlytics.sources.schemas import schema_of


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header; without a schema every column is text.

    Columns are matched by header order, so a schema must list the file's own.
    ``multi_line`` reads quoted line ends, but then a file is one task.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return lower_names(reader.csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def optional_source(read, *args) -> DataFrame | None:
    """The frame, or None where the path does not exist."""
    try:
        return read(*args)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def first_available(read, spark: SparkSession, paths: Sequence[str], *args) -> DataFrame | None:
    """The first of several paths that exists."""
    for path in paths:
        found = optional_source(read, spark, path, *args)
        if found is not None:
            return found
    return None


def load_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """The CSV tables that exist in a folder, by name; others are skipped."""
    found = {
        n: optional_source(read_csv, spark, f"{folder}/{n}.csv", schema_of(n)) for n in names
    }
    return {n: df for n, df in found.items() if df is not None}


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite; rows of a partition value are spread, not gathered in one file."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_metrics(df: DataFrame, path: str, extra: Mapping[str, object] | None = None) -> None:
    """Metrics rows as JSON with the time of writing."""
    extra = {k: F.lit(v) for k, v in (extra or {}).items()}
    df.withColumns({**extra, "timestamp": F.current_timestamp()}).write.mode("overwrite").json(path)


def write_lines(spark: SparkSession, lines: Sequence[str], path: str) -> None:
    """A short list (feature names) as text."""
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
