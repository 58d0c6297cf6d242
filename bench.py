"""Headline timings. Prints one JSON line.

``BENCH_SF_DIR`` names the input folder and ``BENCH_CPUS`` the local cores. Every query is run once to warm
the JVM on the same folder and then timed (the whole audit, last, finds it warm); staging and scoring are timed from the source tables, the rest
from the written staged and flagged tables, as they are used. ``audit_run`` is a whole run from the source
tables to all deliverables.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from tallyguard.operators import aggregates, agreement, benford, detect, forest, measures, outliers, priority, reports
from tallyguard.operators import rolling, rules, staging, star
from tallyguard.operators.features import add_features
from tallyguard.plans.audit_run import run_audit
from tallyguard.plans.workspace import Workspace
from tallyguard.session import build_session
from tallyguard.sources import ledger

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    supplier = ledger.load_tables(spark, FOLDER, ("supplier",))["supplier"]
    raw, master = ledger.load_ledger(spark, FOLDER), ledger.vendor_master_from(supplier)
    ws = Workspace(raw, master)
    flags = agreement.detector_flags(ml=False)

    queries = {
        "stage_ledger": lambda: consume(staging.stage(raw)),
        "score_ledger": lambda: consume(rules.score_ledger(ws.staged)),
        "duplicate_invoices": lambda: consume(detect.duplicate_invoices(ws.staged)),
        "structuring_sequences": lambda: consume(detect.structuring_sequences(ws.staged)),
        "dept_percentile_profile": lambda: consume(detect.extreme_spend(ws.staged)),
        "dept_profile": lambda: consume(aggregates.dept_profile(ws.staged)),
        "vendor_concentration": lambda: consume(aggregates.vendor_concentration(ws.staged)),
        "monthly_velocity": lambda: consume(aggregates.monthly_velocity(ws.staged)),
        "payment_exposure": lambda: consume(aggregates.payment_exposure(ws.staged)),
        "tier_summary": lambda: consume(aggregates.tier_summary(ws.flagged)),
        "kpi_row": lambda: consume(aggregates.kpi_row(ws.flagged)),
        "statistics": lambda: consume(outliers.add_statistics(add_features(ws.flagged))),
        "boxplot_stats": lambda: consume(aggregates.boxplot_stats(ws.staged)),
        "benford": lambda: consume(benford.benford(ws.staged)),
        "detector_corr": lambda: consume(agreement.detector_correlation(ws.statistics, flags)),
        "forest_fit": lambda: forest.fit_forest(add_features(ws.flagged)),
        "forest_score": lambda: consume(forest.score_forest(ws.statistics, ws.forest)),
        "top50": lambda: consume(priority.priority_ledger(ws.enriched)),
        "dim_vendor": lambda: consume(star.dim_vendor(ws.flagged, master)),
        "fact": lambda: consume(star.fact(ws.enriched)),
        "measures_by_month": lambda: consume(
            measures.measure(ws.flagged, measures.RULE_MEASURES, ["transaction_year", "transaction_month"])
        ),
        "rolling_7d_spend": lambda: consume(rolling.rolling_spend(ws.staged)),
        "rpt_monthly_exposure": lambda: consume(
            reports.monthly_exposure(star.fact(ws.enriched), star.dim_date(ws.flagged))
        ),
        "audit_run": lambda: run_audit(raw, master, tempfile.mkdtemp(prefix="bench-")),
    }
    rows = ws.staged.count()
    seconds = {}
    for name, run in queries.items():
        if name != "audit_run":
            run()
        began = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - began, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "sum of warm query times",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "staged_rows": rows,
                "audit_rows_per_sec": round(rows / seconds["audit_run"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
