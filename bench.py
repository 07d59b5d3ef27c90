"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

import registry
from tastegraph.session import start_session

HEADLINES = [
    "convert_text",
    "tfidf_features",
    "nb_multinomial",
    "model_comparison",
    "score_games",
    "sgd_game_scores",
    "game_features",
    "describe_numeric_by_class",
    "term_frequency_by_class",
    "user_category_profile",
    "content_scores",
    "recommend",
    "exclude_owned",
    "playtime_map",
    "drop_duplicate_rows",
    "assign_row_id",
    "stream_user_games",
    "stream_to_recommendations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = start_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.all_queries()
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(",")
    seconds = {}
    for name in names:
        started = time.perf_counter()
        # The whole result is computed and written nowhere.
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
