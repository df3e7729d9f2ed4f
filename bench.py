"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

from pyspark.sql import SparkSession  # noqa: E402

from foliant.plans.registry import QUERIES  # noqa: E402

HEADLINE = (
    "ned_by_role token_prf token_length_stats bleu_mean eval_summary_delta formula_micro_prf line_tags line_ngrams duplicate_lines inverted_index candidate_lines islands seek_map paper_split page_concat "
    "citation_join nearest_lines page_index reading_order box_overlaps box_dedup table_scores grid_neighbours running_variance stop_steps class_median_mad staircase_pages plain_formulas "
    "html_to_markup markup_lines split_pages postprocessed truncate_repetitions"
).split()


def main() -> None:
    folder, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "2"))):
            began = time.time()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        took[name] = round(min(runs) if len(runs) < 3 else median(runs), 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, warm", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
