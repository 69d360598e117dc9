"""Choose the contests of many cards."""

from __future__ import annotations

from pyspark.sql import SparkSession

from eventlytics.operators.cards import optimize_cards
from eventlytics.sources import files


def run(spark: SparkSession, candidates: str, out: str, capacity: int = 20_000) -> None:
    """Read the candidate table, write the chosen contests and the estimates."""
    chosen, estimates = optimize_cards(files.read_parquet(spark, candidates), capacity)
    files.write_parquet(chosen, f"{out}/cards")
    files.write_parquet(estimates, f"{out}/card_estimates")
