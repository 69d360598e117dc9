"""Graph features of the clean contests."""

from __future__ import annotations

from pyspark.sql import SparkSession

from eventlytics.operators.graph import appearance_share, graph_features
from eventlytics.sources import files


def run(spark: SparkSession, data: str, out: str, cheap: bool = False) -> None:
    """Write the graph features; ``cheap`` counts appearances only."""
    fights = files.first_available(
        files.read_parquet, spark, [f"{data}/processed/fights", f"{data}/raw/fights"]
    )
    made = appearance_share(fights) if cheap else graph_features(fights)
    files.write_parquet(made, f"{out}/features/graph_features")
