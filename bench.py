"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up, then the median of $BENCH_REPEATS runs is
kept. Results are consumed with Spark's ``noop`` sink, so the full plan runs
on the executors and no result rows travel to the driver. Also measures the
reference's scaling query (strong and weak scaling, real row counts) and the
old/new curation strategies. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabqual.plans import catalog  # noqa: E402
from tabqual.plans import scaling  # noqa: E402
from tabqual.plans.fixtures import FX2_SOURCE_COLUMNS, fx2  # noqa: E402
from tabqual.operators import curate as cu  # noqa: E402
from tabqual.session import get_session, shared_path  # noqa: E402

# queries whose cost is model training: timed by model below, as the reference publishes it
SKIP = {"model_comparison", "feature_importance", "balanced_lr"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", app_name="tabqual-bench", shuffle_partitions=cpus,
                        conf={"spark.driver.memory": "16g"})

    def run(fn):
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    t_all = time.perf_counter()
    for name, fn in catalog.queries().items():
        if name in SKIP or (only and name not in only):
            continue
        times[name] = round(scaling.timed(lambda: run(fn), repeats), 4)

    if not only:
        curated = cu.curate(fx2(spark, sf_dir), columns=FX2_SOURCE_COLUMNS, time_col="event_ts",
                            with_name_length=False)
        for mode, rows, parts, secs in scaling.strong_scaling(curated, [2, 4, 8], repeats):
            times[f"strong_p{parts}"] = round(secs, 4)
        for mode, rows, parts, secs in scaling.weak_scaling(curated, [2, 4, 8], repeats=repeats):
            times[f"weak_p{parts}"] = round(secs, 4)
        out_dir = shared_path(spark, "bench-strategies")
        table, equal = scaling.compare_strategies(fx2(spark, sf_dir).select(*FX2_SOURCE_COLUMNS), out_dir,
                                                  catalog.RUN_TS, repeats=repeats)
        for r in table.collect():
            for k in ("transform_seconds", "cache_materialize_seconds", "summary_seconds", "quality_band_seconds"):
                times[f"{r['mode']}_{k.replace('_seconds', '')}"] = round(r[k], 4)
        if not equal:
            times["strategy_results_differ"] = 1.0

    if os.environ.get("BENCH_MODELS", "1") == "1" and not only:
        # training time per model (one run each, models one after another as in the reference)
        from tabqual.operators import models as mo
        train, val, test = catalog._model_frames(spark, sf_dir)
        trained = mo.train_and_compare(train, val, test, ["lang", "source"], ["n_chars"], id_col="doc_id",
                                       parallelism=2, concurrent_models=1)
        for r in trained.comparison.collect():
            times[f"train_{r['model']}"] = round(r["train_seconds"], 4)

    query_total = sum(v for k, v in times.items() if k in catalog.QUERIES)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(query_total, 4),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "wall_seconds": round(time.perf_counter() - t_all, 2),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
