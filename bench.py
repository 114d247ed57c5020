"""Times the headline queries once cold and once warm; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tabloom.plans.queries import QUERIES
from tabloom.session import local_session

HEADLINE = (
    "prepare_table", "missing_report", "numeric_summary", "correlation_matrix", "group_terciles",
    "impute_median_unknown", "impute_group_median", "impute_knn", "outlier_report", "collinear_pairs",
    "tier_and_score", "passenger_features", "scale_standard", "onehot", "pca_variance",
    "split_stratified", "folds_shuffled", "threshold_scan", "class_report", "vote_soft",
    "train_logreg", "train_decision_tree", "train_random_forest", "train_boosted_trees", "train_svm", "tuned_threshold",
)
#: Once each: whole workflows.
ONCE = ("train_svm_rbf", "ranked_models", "scored_table")


def timed(spark, name: str, folder: str, failed: dict) -> float | None:
    start = time.perf_counter()
    try:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    except Exception as error:  # the other queries are still measured
        failed[name] = f"{type(error).__name__}: {error}"[:300]
        return None
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tabloom-bench")
    failed: dict[str, str] = {}
    cold = {name: timed(spark, name, folder, failed) for name in HEADLINE + ONCE}
    warm = {name: timed(spark, name, folder, failed) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_total_warm", "value": round(sum(t for t in warm.values() if t is not None), 3), "unit": "sec",
        "queries": warm, "cold": cold, "failed": failed, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
