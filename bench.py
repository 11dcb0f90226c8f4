"""Benchmark: headline registered queries at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma list to override).  Each query is executed fully with the no-op sink (no
driver collect) after one warm-up; prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_top_growth", "jn1_merge_panel", "jn7_nearest_match", "agg15_box_stats", "win1_lag_bucketed",
    "mis3_ffill_bfill", "out2_cap_outliers", "scl1_zscore_by_key", "dq5_iqr_outliers", "sta2_spearman",
    "sta5_ols", "sta7_hc3", "sta12_kruskal", "cau5_did_extended", "clu4_silhouette_given_labels",
    "fc9_linear_extrapolation", "fc11_model_comparison",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    from panelforge.plans.registry import load_all
    from panelforge.session import build_session

    t0 = time.time()
    spark = build_session(f"local[{cpus}]", "panelforge-bench", shuffle_partitions=max(8, 2 * cpus))
    startup = time.time() - t0
    reg = load_all()
    # warm-up: JIT, Python workers, file listing
    reg["flagship_top_growth"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t = time.time()
        reg[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "startup_sec": round(startup, 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
