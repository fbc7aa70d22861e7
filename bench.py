"""Headline timings: one complete refresh, then every mart by itself.

Prints one JSON line. ``refresh`` is everything a scheduled run does, in a cold session and a
fresh folder: raw lines, quality, star schema, all marts, both gates, and the export. The
marts are then computed again one by one from the stored star schema.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from kpiloom.plans import analysis, star
from kpiloom.plans.warehouse import Warehouse, run
from kpiloom.session import build_session
from kpiloom.sources.testdata import PROFILE, raw_lines

MARTS = (
    "mart_product_period", "mart_returns_family", "mart_returns_monthly",
    "mart_cohort_retention", "mart_country_period", "mart_customer_concentration",
    "mart_reconciliation", "dq_report", "mart_driver_decomposition", "chain_substitution",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus},
    )
    spark.range(1).count()
    timings: dict[str, float] = {}

    def timed(name: str, action) -> None:
        started = time.perf_counter()
        action()
        timings[name] = round(time.perf_counter() - started, 3)

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    cfg = PROFILE
    done: list[Warehouse] = []
    # The published tables live in the folder, so it stays until the last query.
    out = tempfile.TemporaryDirectory(prefix="bench-")
    timed("refresh", lambda: done.append(run(raw_lines(spark, sf_dir), cfg, out.name)))
    w = done[0]
    rows = w.checked.count()

    for name in MARTS:
        timed(name, lambda name=name: drain(w.build(name)))
    timed("kpi_monthly", lambda: drain(w.build_kpi_monthly()))
    timed("dim_customer", lambda: drain(star.dim_customer(w.clean, cfg, w.store)))
    timed("dim_product", lambda: drain(star.dim_product(w.clean, cfg, w.store)))
    timed(
        "driver_decomposition_by_market",
        lambda: drain(analysis.decomposition_by_market(w.build("market_factors"), w.periods)),
    )
    timed(
        "driver_decomposition_by_month",
        lambda: drain(analysis.decomposition_by_month(w.kpi_monthly_factors)),
    )
    timed("insight_rules", lambda: drain(w.insight_rules()))

    print(json.dumps({
        "metric": "sum of query times",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "lines": rows,
        "refresh_lines_per_sec": round(rows / timings["refresh"], 1),
    }))
    spark.stop()
    out.cleanup()


if __name__ == "__main__":
    main()
