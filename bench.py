"""Times the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores), BENCH_RUNS (best of n, default 3). A query that
takes over LONG seconds is run once.
Every query is written to the noop sink, so all rows and columns are computed and nothing is collected.
The written tables are timed as queries of their own; later queries read them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellpulse.queries import views  # noqa: E402
from cellpulse.queries.catalog import CATALOG  # noqa: E402
from cellpulse.session import session  # noqa: E402

HEADLINE = [
    "grid_time_panel", "clean_incidents", "assign_cells", "time_windows", "calendar_hist", "corr_matrix",
    "density_matrix", "feat_lags", "feat_neighbors", "feat_ewma", "feat_slot_avgs", "feature_matrix", "feat_advanced",
    "predictions", "time_split", "error_by_decile", "report_accuracy", "report_concentration", "cell_risk",
    "temporal_trends", "label_encode", "dash_filter", "dash_metrics", "hotspots", "robust_scale", "ensemble_weights", "model_ranking",
    "roc_curve", "model_comparison", "fairness_report", "train_gbt", "stack_models", "tune_gbt",
    "panel_dense", "feat_slots_before", "panel_incremental", "ensemble_weights_six",
]

LONG = 5.0


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/events.parquet").count()  # start-up of the session is not a query

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return round(time.perf_counter() - start, 3)

    seconds = {"stage_incidents": timed(lambda: views.stages(spark, folder))}
    chain = views.stages(spark, folder)
    seconds |= {
        "stage_panel": timed(lambda: chain.panel),
        "stage_features": timed(lambda: chain.features),
        "stage_daily": timed(lambda: views.daily_predictions(spark, folder)),
    }
    for name in HEADLINE:
        run = lambda: timed(lambda: CATALOG[name](spark, folder).write.format("noop").mode("overwrite").save())
        seconds[name] = run()
        for _ in range(runs - 1 if seconds[name] <= LONG else 0):
            seconds[name] = min(seconds[name], run())
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
