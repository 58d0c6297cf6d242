"""The tables of one ledger, each derived once per session and written to the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard import schemas
from tallyguard.config import DEFAULT, AuditConfig
from tallyguard.operators import forest as iforest
from tallyguard.operators import star
from tallyguard.operators.features import add_features
from tallyguard.operators.outliers import group_constants, with_statistics
from tallyguard.operators.rules import judged, with_group_values
from tallyguard.operators.staging import arrivals, calendar_columns, staged_of
from tallyguard.plans.scratch import remove_folder, remove_scratch, scratch_path, write_once, write_to
from tallyguard.sources import files

#: folders of the written ledgers and of the fact
MONTHS = ("transaction_year", "transaction_month")


class Workspace:
    """Raw feed to enriched ledger. Tables are built when first asked for.

    First arrivals and what the rules take from groups are written, because several passes read them; flags, tiers and
    statistics follow from a row and its department's constants and are not. Model scores are written, because they come
    from Python, beside the columns that cannot be had from others. ``publish`` puts ledgers in the place of written tables.
    """

    def __init__(self, raw: DataFrame, master: DataFrame, config: AuditConfig = DEFAULT):
        self.raw = raw
        self.master = master
        self.config = config

    @cached_property
    def _arrivals_folder(self) -> str:
        return scratch_path(self.raw.sparkSession, "arrivals")

    @cached_property
    def arrivals(self) -> DataFrame:
        """First arrivals, staged or not: the feed is deduplicated once."""
        return write_to(arrivals(self.raw), self._arrivals_folder, files.COMPRESSION)

    @cached_property
    def staged(self) -> DataFrame:
        return staged_of(self.arrivals)

    @cached_property
    def flagged(self) -> DataFrame:
        return self._judged(self._grouped)

    @cached_property
    def _grouped(self) -> DataFrame:
        """Staged ledger with group values, without the columns that follow from the date."""
        rows = with_group_values(self.staged)
        return write_once(rows.drop(*calendar_columns(F.col("transaction_date"))), "grouped", files.COMPRESSION)

    def publish(self, folder: str) -> None:
        """Write the flagged and the staged ledger by month and read them from there from then on, without other copies.

        The flagged ledger has all rows of the staged one, whose departments are never null, and all of its columns. So rows are
        shuffled once, and what is written from the flagged ledger still has the rows of a month together. First arrivals are
        deleted at the end: what else is taken from them must have been written before.
        """
        spark, derived = self.raw.sparkSession, calendar_columns(F.col("transaction_date"))
        rows = with_group_values(self.staged)
        files.write_parquet(rows.drop(*(derived.keys() - set(MONTHS))), f"{folder}/flagged", MONTHS, then=self._judged)
        self.flagged = files.read_table_folder(spark, f"{folder}/flagged", schemas.FLAGGED)
        self._grouped = self.flagged.select(*[name for name in rows.columns if name not in derived])
        files.write_parquet(self.flagged.select(*schemas.STAGED.names), f"{folder}/staged", MONTHS, gathered=True)
        self.staged = files.read_table_folder(spark, f"{folder}/staged", schemas.STAGED)
        remove_folder(spark, self._arrivals_folder)

    def _judged(self, rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
        return judged(rows.withColumns(calendar_columns(F.col("transaction_date"))), self.config, more)

    @cached_property
    def _constants(self) -> DataFrame:
        return group_constants(self.flagged, self.config)

    def _with_statistics(self, flagged: DataFrame) -> DataFrame:
        return with_statistics(add_features(flagged, self.config), self._constants, self.config)

    @cached_property
    def statistics(self) -> DataFrame:
        """Flagged ledger with features and statistical outliers."""
        return self._with_statistics(self.flagged)

    @cached_property
    def forest(self) -> iforest.Forest:
        return iforest.fit_forest(add_features(self.flagged, self.config), config=self.config)

    @cached_property
    def _scored(self) -> DataFrame:
        """Grouped rows with their raw score."""
        rows, name = add_features(self.flagged, self.config), "ml_raw_score"
        kept = iforest.raw_scores(rows, self.forest, name).select(*self._grouped.columns, name)
        return write_once(kept, "scored", files.COMPRESSION)

    @cached_property
    def calibration(self) -> iforest.Calibration:
        return iforest.calibrate(self._scored, self.config)

    @cached_property
    def enriched(self) -> DataFrame:
        """Everything, model verdict included."""
        rows = iforest.with_verdict(self._scored, self.calibration)
        verdict = rows.columns[len(self._scored.columns) :]
        return self._with_statistics(self._judged(rows, verdict)).select(*self.statistics.columns, *verdict)

    @cached_property
    def vendors(self) -> DataFrame:
        return write_once(star.dim_vendor(self.flagged, self.master), "vendors")


_workspaces: dict[tuple[str, str], Workspace] = {}


def close_workspaces(spark: SparkSession) -> None:
    """Forget the session's workspaces and delete their written tables."""
    for key in [k for k in _workspaces if k[0] == spark.sparkContext.applicationId]:
        del _workspaces[key]
    remove_scratch(spark)


def workspace_for(spark: SparkSession, folder: str, build: Callable[[], Workspace]) -> Workspace:
    """The session's workspace for an input folder, until ``close_workspaces``; files added later are not seen."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _workspaces:
        _workspaces[key] = build()
    return _workspaces[key]
