"""Time the headline queries; prints one JSON line.

Each query is run to the end with the no-op sink after one small warm-up query.
BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma list, or "all") may be set.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "w_entity_history", "w4_days_since_same_type", "j4_pair_history", "j3_matchup_features",
    "j10_linkage_cascade", "j15_trailing_buzz", "event_features", "p02_multi_format_date",
    "p11_split_sides", "p21_number_from_text", "p25_odds_features", "p26_lexicon_sentiment",
    "a4_adaptive_rollup", "a6_sentiment_rollup", "a13_box_by_priority", "a14_correlations",
    "s11_profile", "s12_refresh_store", "s13_merge_sources", "t6_first_per_group",
    "g2_pagerank", "g3_connected_components", "g4_triangle_count", "g6_label_propagation",
    "o2_greedy_cards", "o3_improved_cards", "o5_card_validity", "h1_page_facts", "h2_links",
    "h4_round_stats", "h6_odds_records", "m3_boosted_trees",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from eventlytics.catalog import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = HEADLINE if not wanted else tuple(QUERIES) if wanted == "all" else tuple(wanted.split(","))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["s3_parquet_scan"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{times[name]:8.2f} {name}", file=sys.stderr, flush=True)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
