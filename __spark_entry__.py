
from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType  # noqa: E402

from oracle_queries import ORACLE  # noqa: E402
from tallyguard import schemas  # noqa: E402
from tallyguard.config import DEFAULT  # noqa: E402
from tallyguard.operators import (  # noqa: E402
    aggregates,
    agreement,
    benford,
    detect,
    forest,
    measures,
    outliers,
    priority,
    quality,
    reports,
    rolling,
    rules,
    staging,
    star,
)
from tallyguard.operators.features import add_features  # noqa: E402
from tallyguard.plans import audit_run  # noqa: E402
from tallyguard.plans.scratch import remove_folder, scratch_path, write_once, write_to  # noqa: E402
from tallyguard.plans.workspace import Workspace, workspace_for  # noqa: E402
from tallyguard.session import bound_tasks  # noqa: E402
from tallyguard.sources import files, ledger  # noqa: E402
from tallyguard.streaming import controls, corrections  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]


def _present(name: str) -> bool:
    """Whether a module's file is there; errors inside it are not hidden."""
    spec = importlib.util.find_spec(name)
    return spec is not None and spec.origin is not None


#: queries and SQL of the text operators, when their subpackage is there
TEXT_QUERIES: dict[str, Query] = {}
TEXT_SQL: dict[str, str] = {}
if _present("tallyguard.llm"):
    from tallyguard.llm import entries as text_entries

    TEXT_QUERIES.update(text_entries.QUERIES)
    TEXT_SQL.update(text_entries.SQL)
    if _present("corpus_pipeline"):  # its stages are operators of that subpackage
        import corpus_pipeline

        TEXT_QUERIES["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            TEXT_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL

#: digits of computed columns that are compared
ENRICHED_DIGITS = {"dept_baseline_mean": 6, "log_amount": 6, "threshold_dist": 2, "iqr_upper_bound": 4, "stat_zscore": 4}
SMOKE_FOLDER = "/root/testdata/sf0.001"


def _workspace(spark: SparkSession, folder: str) -> Workspace:
    bound_tasks(spark)

    def build() -> Workspace:
        supplier = ledger.load_tables(spark, folder, ("supplier",))["supplier"]
        return Workspace(ledger.load_ledger(spark, folder), ledger.vendor_master_from(supplier))

    return workspace_for(spark, folder, build)


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text, so that results compare across engines."""
    dated = (DateType, TimestampType, TimestampNTZType)
    return df.select(
        *[
            F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, dated) else F.col(f.name)
            for f in df.schema
        ]
    )


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name, places in digits.items()})


def _on(build: Callable[[Workspace], DataFrame]) -> Query:
    """A query over the ledger tables of an input folder."""
    return lambda spark, folder: _plain(build(_workspace(spark, folder)))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.event_rows(ledger.load_tables(spark, folder, ("events",))["events"], controls.utc_instant("ts"))


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    feed = controls.read_files(spark, folder, schemas.EVENTS, "events.parquet")
    return ledger.event_rows(feed, controls.utc_instant("ts"))


def entry(spark: SparkSession) -> DataFrame:
    """Risk tiers of the whole ledger: ingest, stage, score, summarise."""
    return aggregates.tier_summary(_workspace(spark, SMOKE_FOLDER).flagged)


# ----------------------------------------------------------------------------------------------------
# queries that need more than one call
# ----------------------------------------------------------------------------------------------------


def _feed_union(spark: SparkSession, folder: str) -> DataFrame:
    lines = _workspace(spark, folder).raw.select(F.lit("ledger").alias("feed"), "amount")
    events = _events(spark, folder).select(F.lit("events").alias("feed"), "amount")
    return (
        files.union_feeds(lines, events)
        .groupBy("feed")
        .agg(F.count(F.lit(1)).alias("feed_rows"), F.round(F.sum("amount"), 2).alias("feed_spend"))
    )


def _perturbation_labels(ws: Workspace) -> DataFrame:
    weekend = F.dayofweek(F.to_date("transaction_date")).isin(1, 7)
    return (
        ws.raw.groupBy(F.coalesce("anomaly_type", F.lit("BENIGN_NORMAL")).alias("typology"))
        .agg(
            F.count(F.lit(1)).alias("typology_rows"),
            F.round(F.sum("amount"), 2).alias("typology_spend"),
            F.count("invoice_number").alias("with_invoice"),
            F.count_if(F.trim("approver_id") == "").alias("blank_approver"),
            F.count_if(weekend).alias("on_weekend"),
        )
    )


def _dq_nulls(ws: Workspace) -> DataFrame:
    return quality.null_counts(ws.staged, (*schemas.STAGED_REQUIRED, "invoice_number", "approver_id"))


def _quarantined(ws: Workspace) -> DataFrame:
    return staging.quarantine(ws.raw).agg(F.count(F.lit(1)).alias("quarantined"))


def _standardized(ws: Workspace) -> DataFrame:
    names = [f"{name}_std" for name in DEFAULT.features]
    rows = forest.standardize(add_features(ws.flagged)).select("transaction_id", *names)
    return _rounded(rows, dict.fromkeys(names, 5))


def _features(ws: Workspace) -> DataFrame:
    names = ("log_amount", "threshold_dist", "is_structuring_candidate", "first_digit", "is_clean_round_sum")
    rows = add_features(ws.flagged).select("transaction_id", "amount", *names)
    return _rounded(rows, {"log_amount": 6, "threshold_dist": 2})


def _dept_quantiles(ws: Workspace) -> DataFrame:
    found = outliers.group_quantiles(ws.flagged, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return _rounded(found, {"q25": 4, "median": 4, "q75": 4})


def _iqr(ws: Workspace) -> DataFrame:
    rows = outliers.iqr_outliers(ws.flagged)
    keep = rows.select("transaction_id", "department", "amount", "stat_iqr_flag", "iqr_upper_bound")
    return _rounded(keep, {"iqr_upper_bound": 4})


def _mad(ws: Workspace) -> DataFrame:
    rows = outliers.mad_outliers(ws.flagged)
    keep = rows.select("transaction_id", "department", "amount", "stat_zscore", "stat_zscore_flag")
    return _rounded(keep, {"stat_zscore": 4})


def _no_ml(truth: bool = True) -> dict:
    return agreement.detector_flags(ml=False, truth=truth)


def _rolling(ws: Workspace) -> DataFrame:
    return rolling.rolling_spend(ws.staged).na.fill(0, ["evaded_limit"])


def _measures(ws: Workspace, by: list[str]) -> DataFrame:
    return measures.measure(ws.flagged, measures.RULE_MEASURES, by)


def _measures_sliced(ws: Workspace) -> DataFrame:
    rows = measures.slice_ledger(ws.flagged, years=[1996, 1997], quarters=[1, 4], tiers=["High", "Critical"])
    return measures.measure(rows, measures.RULE_MEASURES, ["department"])


def _overlap_iqr(ws: Workspace) -> DataFrame:
    flags = _no_ml()
    return agreement.detector_overlap(ws.statistics, {name: flags[name] for name in ("rules", "iqr")})


def _saved_forest(ws: Workspace) -> DataFrame:
    return ws.forest.to_frame(ws.raw.sparkSession).select(
        "tree", "depth", "sample_rows", F.size("feature").alias("nodes"), F.round(F.array_max("path") / forest.PATH_UNITS, 6).alias("longest_path")
    )


# ----------------------------------------------------------------------------------------------------
# round trips: written by a sink, read back by its source
# ----------------------------------------------------------------------------------------------------


def _back_from_csv(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    files.write_csv(df, path)
    return files.read_csv(df.sparkSession, path, df.schema)


def _csv_feed(ws: Workspace) -> DataFrame:
    spark, path = ws.raw.sparkSession, scratch_path(ws.raw.sparkSession, "feed")
    files.write_csv(ws.raw.select(*schemas.RAW_LEDGER.names), path)
    return staging.stage(files.read_ledger_csv(spark, path))


def _parquet_feed(ws: Workspace) -> DataFrame:
    """Files in the order of arrival, without the ordinal: file order and row order must stand in for it."""
    spark, path = ws.raw.sparkSession, scratch_path(ws.raw.sparkSession, "feed")
    order, whole = list(staging.ARRIVAL), scratch_path(spark, "whole")
    # written first, so that what the feed's joins shuffled is gone when its rows are sorted
    rows = write_to(ws.raw, whole, files.COMPRESSION).repartitionByRange(*order).sortWithinPartitions(*order)
    files.write_parquet(rows.drop("ingest_seq"), path)
    remove_folder(spark, whole)
    return staging.stage(files.read_ledger_parquet(spark, path))


def _vendor_csv(ws: Workspace) -> DataFrame:
    path = scratch_path(ws.raw.sparkSession, "vendors")
    files.write_csv(ws.master, path)
    return files.read_vendor_master(ws.raw.sparkSession, path)


def _flagged_folder(ws: Workspace) -> DataFrame:
    spark, path = ws.raw.sparkSession, scratch_path(ws.raw.sparkSession, "flagged")
    files.write_parquet(ws.flagged, path, audit_run.MONTHS)
    return _rounded(files.read_flagged(spark, path).select(*ws.flagged.columns), {"dept_baseline_mean": 6})


def _staged_view(ws: Workspace) -> DataFrame:
    files.publish_view(ws.staged, "staged_ledger_view")
    return ws.raw.sparkSession.table("staged_ledger_view")


def _fact_folder(ws: Workspace) -> DataFrame:
    spark, path = ws.raw.sparkSession, scratch_path(ws.raw.sparkSession, "fact")
    fact = star.fact(ws.statistics, ml=False)
    files.write_parquet(audit_run.with_months(fact), path, audit_run.MONTHS)
    return spark.read.parquet(path).select(*fact.columns)


def _enriched_csv(ws: Workspace) -> DataFrame:
    spark, path = ws.raw.sparkSession, scratch_path(ws.raw.sparkSession, "enriched")
    files.write_csv(ws.enriched, path)
    return _rounded(files.read_enriched_csv(spark, path), ENRICHED_DIGITS)


def _appended(ws: Workspace) -> DataFrame:
    """Three batches of the staged ledger, of which one is sent twice."""
    spark, path = ws.raw.sparkSession, scratch_path(ws.raw.sparkSession, "batches")
    third = F.col("transaction_year") % 3
    for number in (0, 1, 1, 2):
        files.append_batch(ws.staged.where(third == number), path, f"b{number}")
    return spark.read.parquet(path).select(*ws.staged.columns)


def _refreshed(ws: Workspace) -> DataFrame:
    """The flagged ledger by month, of which one year was written wrongly and is written again; files by their state."""
    spark, path = ws.raw.sparkSession, scratch_path(ws.raw.sparkSession, "months")
    wrong = F.col("transaction_year") == 1996
    files.write_parquet(ws.flagged.withColumn("amount", F.when(wrong, 0.0).otherwise(F.col("amount"))), path, audit_run.MONTHS)
    before = {row[0] for row in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
    files.refresh_parts(ws.flagged.where(wrong), path, audit_run.MONTHS)
    kept = F.col("_metadata.file_path").isin(*before).cast("int")
    return (
        spark.read.parquet(path)
        .groupBy("transaction_year", "transaction_month")
        .agg(F.round(F.sum("amount"), 2).alias("spend"), F.count(F.lit(1)).alias("transactions"), F.min(kept).alias("kept_files"))
    )


def _faulty_feed(ws: Workspace) -> DataFrame:
    """The raw feed as CSV with dates and amounts that are none and without some departments, read back."""
    spark, path = ws.raw.sparkSession, scratch_path(ws.raw.sparkSession, "faulty")
    at = F.col("ingest_seq")
    faults = {
        "transaction_date": F.when(at % 101 == 0, "31/31/1996").otherwise(F.col("transaction_date")),
        "amount": F.when(at % 107 == 0, "n/a").otherwise(F.col("amount").cast("string")),
        "department": F.when(at % 103 != 0, F.col("department")),
    }
    files.write_csv(ws.raw.withColumns(faults).select(*schemas.RAW_LEDGER.names), path)
    return files.read_ledger_csv(spark, path)


def _faulty_counts(ws: Workspace) -> DataFrame:
    feed = _faulty_feed(ws)
    return staging.row_counts(feed, write_once(staging.arrivals(feed), "arrivals"))


def _run_output(read: Callable[[SparkSession, str, Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    """A table that a whole run left behind, read back; the run is made once for each ledger.

    Columns and types are those of the run's own tables: asking the ledger's workspace for them would stage and score it again.
    """

    def build(ws: Workspace) -> DataFrame:
        if not hasattr(ws, "run_folder"):
            folder = scratch_path(ws.raw.sparkSession, "run")
            ws.run = audit_run.run_audit(ws.raw, ws.master, folder)
            ws.run_folder = folder
        return read(ws.raw.sparkSession, ws.run_folder, ws)

    return build


def _stream_rolling(spark: SparkSession, folder: str) -> DataFrame:
    windows = controls.drain(controls.rolling_spend(_event_stream(spark, folder)), "rolling")
    return _plain(windows.na.fill(0, ["evaded_limit"]))


def _stream_block(spark: SparkSession, folder: str) -> DataFrame:
    decided = controls.release_or_block(_event_stream(spark, folder))
    return decided.select("transaction_id", "vendor_id", "invoice_number", "amount", "decision")


#: deliveries that the events come in, by hour of day, so that later ones bring rows of days that went before
DELIVERIES = 5


def _in_deliveries(spark: SparkSession, folder: str, handle: Callable[[DataFrame], DataFrame], again: bool) -> DataFrame:
    """Run a control after each delivery of events; with ``again`` clicks come a second time, one delivery later."""
    events = ledger.load_tables(spark, folder, ("events",))["events"]
    number = F.floor(F.hour("ts") / 5).cast("int")
    inbox = scratch_path(spark, "deliveries")
    found = None
    for turn in range(DELIVERIES + int(again)):
        sent = events.where(number == turn)
        if again:
            sent = sent.unionByName(events.where((number == turn - 1) & (F.col("event_type") == "click")))
        sent.write.mode("append").parquet(inbox)
        found = handle(ledger.event_rows(controls.read_files(spark, inbox, schemas.EVENTS), controls.utc_instant("ts")))
    return found


def _stream_block_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, "payments")
    decided = _in_deliveries(spark, folder, lambda rows: controls.release_or_block(rows, target, fan=2, buckets=16), again=True)
    return decided.select("transaction_id", "vendor_id", "invoice_number", "amount", "decision")


def _stream_corrected(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, "weeks")
    versions = _in_deliveries(spark, folder, lambda rows: corrections.rolling_versions(rows, target, fan=2), again=False)
    return _plain(corrections.latest(versions).na.fill(0, ["evaded_limit"]))


def _stream_first(spark: SparkSession, folder: str) -> DataFrame:
    kept = controls.drain(controls.first_within(_event_stream(spark, folder), "40 days"), "first")
    return kept.select("vendor_id", "invoice_number", "amount")


def _stream_rules(spark: SparkSession, folder: str) -> DataFrame:
    baseline = rules.department_baseline(_events(spark, folder))
    judged = controls.drain(controls.rules(_event_stream(spark, folder), baseline), "rules")
    return _plain(
        judged.select(
            "transaction_id",
            "transaction_date",
            "department",
            "vendor_id",
            "amount",
            "dept_spend_multiplier",
            "flag_round_amount",
            "flag_threshold_structuring",
            "flag_weekend_posting",
            "flag_missing_governance",
            "flag_spend_spike",
            "blocked_unapproved",
        )
    )


def _stream_forest(spark: SparkSession, folder: str) -> DataFrame:
    ws = _workspace(spark, folder)
    baseline = rules.department_baseline(_events(spark, folder))
    screened = controls.forest_screen(_event_stream(spark, folder), baseline, ws.forest, ws.calibration)
    return _plain(
        controls.drain(screened, "screened").select(
            "transaction_id", "transaction_date", "vendor_id", "amount", "ml_iso_forest_flag", "ml_anomaly_score"
        )
    )


def queries() -> dict[str, Query]:
    """One entry per operator; each reads the whole tables of the folder."""
    ledger_queries: dict[str, Callable[[Workspace], DataFrame]] = {
        # sources
        "raw_ledger": lambda ws: ws.raw,
        "perturbation_labels": _perturbation_labels,
        "vendor_master": lambda ws: ws.master,
        # staging and data quality
        "stage_ledger": lambda ws: staging.stage(ws.raw),
        "stage_dedup_rejects": lambda ws: staging.dedup_rejects(ws.raw),
        "staged_count": lambda ws: staging.staged_count(ws.staged),
        "quarantined_rows": _quarantined,
        "dq_pk": lambda ws: quality.pk_violations(ws.raw),
        "dq_nulls": _dq_nulls,
        "dq_vendor_nulls": lambda ws: quality.null_counts(ws.master, schemas.VENDOR_REQUIRED),
        "dq_approver_gate": lambda ws: quality.unapproved_over(ws.staged).select(
            "transaction_id", "department", "vendor_id", "amount"
        ),
        # forensic reports and summaries of the staged ledger
        "duplicate_invoices": lambda ws: detect.duplicate_invoices(ws.staged),
        "structuring_sequences": lambda ws: detect.structuring_sequences(ws.staged),
        "dept_percentile_profile": lambda ws: detect.extreme_spend(ws.staged),
        "dept_profile": lambda ws: aggregates.dept_profile(ws.staged),
        "dept_range": lambda ws: aggregates.dept_range(ws.staged),
        "vendor_concentration": lambda ws: aggregates.vendor_concentration(ws.staged),
        "monthly_velocity": lambda ws: aggregates.monthly_velocity(ws.staged),
        "payment_exposure": lambda ws: aggregates.payment_exposure(ws.staged),
        "currency_mix": lambda ws: aggregates.currency_mix(ws.staged),
        "ledger_profile": lambda ws: aggregates.ledger_profile(ws.raw),
        "typology_mix": lambda ws: aggregates.typology_mix(ws.raw),
        "boxplot_stats": lambda ws: aggregates.boxplot_stats(ws.staged),
        "benford": lambda ws: benford.benford(ws.staged),
        "benford_notebook": lambda ws: benford.benford(ws.staged, rounding="difference"),
        "rolling_7d_spend": _rolling,
        "split_purchase_alerts": lambda ws: rolling.split_purchase_alerts(ws.staged),
        # rules
        "flagged": lambda ws: _rounded(rules.score_ledger(ws.staged), {"dept_baseline_mean": 6}),
        "tier_summary": lambda ws: aggregates.tier_summary(ws.flagged),
        "flagged_count": lambda ws: aggregates.flagged_count(ws.flagged),
        "kpi_row": lambda ws: aggregates.kpi_row(ws.flagged),
        "monthly_flagged": lambda ws: aggregates.monthly_flagged(ws.flagged),
        "tier_share": lambda ws: aggregates.tier_share(ws.flagged),
        # features, statistics, agreement
        "features": _features,
        "standardized_features": _standardized,
        "dept_quantiles": _dept_quantiles,
        "iqr_outliers": _iqr,
        "mad_outliers": _mad,
        "outlier_counts": lambda ws: outliers.outlier_counts(ws.statistics),
        "detector_corr": lambda ws: agreement.detector_correlation(ws.statistics, _no_ml()),
        "detector_overlap": lambda ws: agreement.detector_overlap(ws.statistics, _no_ml()),
        "detector_backtest": lambda ws: agreement.backtest(ws.statistics, _no_ml(truth=False)),
        "detector_quality": lambda ws: agreement.detector_quality(ws.statistics, _no_ml(truth=False)),
        # priority ledger
        "top50_rules": lambda ws: priority.priority_ledger(ws.statistics, 50, ml=False).drop(
            "audit_investigation_narrative"
        ),
        "top15_rules": lambda ws: priority.priority_ledger(ws.statistics, 15, ml=False).drop(
            "audit_investigation_narrative"
        ),
        "top10_rules": lambda ws: priority.priority_ledger(ws.statistics, 10, ml=False).drop(
            "audit_investigation_narrative"
        ),
        "narrative_rules": lambda ws: priority.priority_ledger(ws.statistics, 50, ml=False),
        "narrative_all_rows": lambda ws: priority.with_narrative(ws.statistics, ml=False).select(
            "transaction_id", "audit_investigation_narrative"
        ),
        # star schema
        "dim_date": lambda ws: star.dim_date(ws.flagged),
        "dim_department": lambda ws: _rounded(
            star.dim_department(ws.flagged), {"Total_Spend": 2, "Avg_Transaction_Size": 4}
        ),
        "dim_vendor": lambda ws: _rounded(
            star.dim_vendor(ws.flagged, ws.master), {"Total_Invoiced": 2, "Avg_Risk_Score": 6}
        ),
        "fact": lambda ws: star.fact(ws.statistics, ml=False),
        # measures and report pages
        "measures_all": lambda ws: _measures(ws, []),
        "measures_by_department": lambda ws: _measures(ws, ["department"]),
        "measures_by_month": lambda ws: _measures(ws, ["transaction_year", "transaction_month"]),
        "measures_sliced": _measures_sliced,
        "measures_by_vendor_slice": lambda ws: measures.measure(
            measures.slice_ledger(ws.flagged, vendors=["VND-3", "VND-5", "VND-8"]), measures.RULE_MEASURES, ["vendor_id"]
        ),
        "measures_by_reason_slice": lambda ws: measures.measure(
            measures.slice_ledger(ws.flagged, reasons=["Suspicious Round-Sum Billing", "Extreme Statistical Spend Outlier"]),
            measures.RULE_MEASURES,
            ["primary_flag_reason"],
        ),
        "measures_by_approver_slice": lambda ws: measures.measure(
            measures.slice_ledger(ws.flagged, approvers=["EMP-MAC-0", "EMP-BUI-1"], departments=["MACHINERY", "BUILDING"]),
            measures.RULE_MEASURES,
            ["approver_id"],
        ),
        "yoy_spend": lambda ws: measures.same_period_last_year(ws.flagged),
        "mom_spend": lambda ws: measures.month_over_month(ws.flagged),
        "yoy_spend_by_year": lambda ws: measures.same_period_last_year(ws.flagged, grain="year"),
        "mom_spend_by_department": lambda ws: measures.month_over_month(ws.flagged, ["department"]),
        "rpt_cards": lambda ws: reports.kpi_cards(ws.flagged),
        "rpt_spend_by_tier": lambda ws: reports.spend_by_tier(ws.flagged),
        "rpt_monthly_exposure": lambda ws: reports.monthly_exposure(
            star.fact(ws.statistics, ml=False), star.dim_date(ws.flagged)
        ),
        "rpt_department_exposure": lambda ws: reports.department_exposure(ws.flagged),
        "rpt_payment_by_tier": lambda ws: reports.payment_by_tier(ws.flagged),
        "rpt_exposure_by_reason": lambda ws: reports.exposure_by_reason(ws.flagged),
        "rpt_amount_score": lambda ws: reports.amount_score_points(ws.flagged),
        "rpt_weekend_by_day": lambda ws: reports.weekend_by_day(
            star.fact(ws.statistics, ml=False), star.dim_date(ws.flagged)
        ),
        "rpt_rules_against_iqr": _overlap_iqr,
        "rpt_vendor_quadrants": lambda ws: reports.vendor_quadrants(ws.vendors),
        "rpt_top_vendors": lambda ws: reports.exposed_vendors(ws.vendors),
        "rpt_approvals": lambda ws: reports.approval_breakdown(ws.flagged),
        "investigation_ledger": lambda ws: reports.investigation_ledger(ws.flagged, ml=False),
        "investigation_critical": lambda ws: reports.investigation_ledger(
            ws.flagged, ml=False, tiers=["Critical"], departments=["MACHINERY", "BUILDING"]
        ),
        # sources and sinks, and what a whole run leaves behind
        "source_ledger_csv": _csv_feed,
        "source_ledger_parquet": _parquet_feed,
        "source_vendor_csv": _vendor_csv,
        "source_flagged": _flagged_folder,
        "source_enriched_csv": _enriched_csv,
        "source_faulty_quarantine": lambda ws: staging.quarantine(_faulty_feed(ws)).select("transaction_id", "missing_columns"),
        "source_faulty_counts": _faulty_counts,
        "sink_append_batches": _appended,
        "sink_refresh_months": _refreshed,
        "sink_view": _staged_view,
        "sink_fact_by_month": _fact_folder,
        "sink_investigation_csv": lambda ws: _back_from_csv(reports.investigation_ledger(ws.flagged, ml=False), "grid"),
        "run_staged": _run_output(lambda s, out, ws: s.read.parquet(f"{out}/ledger/staged").select(*ws.run.tables["staged"].columns)),
        "run_kpis": _run_output(
            lambda s, out, ws: files.read_csv(s, f"{out}/processed/kpis", ws.run.tables["kpis"].schema)
        ),
        "run_tiers": _run_output(
            lambda s, out, ws: files.read_csv(s, f"{out}/processed/tiers", ws.run.tables["tiers"].schema)
        ),
        # model
        "iforest_trees": _saved_forest,
        "iforest_scores": lambda ws: ws.enriched.select("transaction_id", "ml_iso_forest_flag", "ml_anomaly_score"),
        "enriched": lambda ws: _rounded(
            ws.enriched,
            ENRICHED_DIGITS,
        ),
        "fact_with_ml": lambda ws: star.fact(ws.enriched),
        "top50": lambda ws: priority.priority_ledger(ws.enriched, 50),
        "top15_ml": lambda ws: priority.priority_ledger(ws.enriched, 15),
        "top10_ml": lambda ws: priority.priority_ledger(ws.enriched, 10),
        "narrative_with_ml": lambda ws: priority.with_narrative(ws.enriched).select(
            "transaction_id", "audit_investigation_narrative"
        ),
        "outlier_counts_with_ml": lambda ws: outliers.outlier_counts(
            ws.enriched, ("stat_iqr_flag", "stat_zscore_flag", "ml_iso_forest_flag")
        ),
        "correlation_with_ml": lambda ws: agreement.detector_correlation(ws.enriched, agreement.detector_flags()),
        "backtest_with_ml": lambda ws: agreement.backtest(ws.enriched, agreement.detector_flags(truth=False)),
        "measures_with_ml": lambda ws: measures.measure(ws.enriched, list(measures.MEASURES)),
        "rpt_rules_against_model": lambda ws: reports.rules_against_model(ws.enriched),
        "investigation_with_ml": lambda ws: reports.investigation_ledger(ws.enriched, tiers=["Critical", "High"]),
    }
    plain_queries: dict[str, Query] = {
        "feed_union": _feed_union,
        "dq_orphans": lambda spark, folder: quality.orphans(
            _events(spark, folder), _workspace(spark, folder).master, "vendor_id"
        ),
        "dq_known_vendors": lambda spark, folder: quality.known_members(
            _events(spark, folder), _workspace(spark, folder).master, "vendor_id"
        ),
        "stream_rolling_7d": _stream_rolling,
        "stream_duplicate_block": _stream_block,
        "stream_block_deliveries": _stream_block_deliveries,
        "stream_rolling_corrected": _stream_corrected,
        "stream_first_payments": _stream_first,
        "stream_rules": _stream_rules,
        "stream_forest_screen": _stream_forest,
    }
    return {**{name: _on(build) for name, build in ledger_queries.items()}, **plain_queries, **TEXT_QUERIES}


def oracle_sql() -> dict[str, str]:
    """SQL for every query that plain SQL can express."""
    return {**ORACLE, **TEXT_SQL}
