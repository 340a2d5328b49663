"""The five stages over two raw catalogues, each computed once and kept as Parquet."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

import fusework
from fusework.config import DEFAULTS, Settings
from fusework.operators import audit, clean, golden, link, models, outliers, profile, ranking, recommend, reports
from fusework.session import StageStore, input_fingerprint

ALL_LAYERS = ("exact", "pm1", "fuzzy")


class CatalogRun:
    """Lazily built tables of one run. Asking for a table stages everything it needs, once.

    With a store over a given folder a run goes on where an earlier one over the same inputs, settings and layers
    ended: a stage that was published is read, not computed. Other inputs, or other settings, start anew.
    """

    def __init__(
        self,
        raw_a: DataFrame,
        raw_b: DataFrame,
        store: StageStore,
        settings: Settings = DEFAULTS,
        layers: Sequence[str] = ALL_LAYERS,
        isolation: bool = True,
    ):
        self.raw_a, self.raw_b = raw_a, raw_b
        self.store, self.settings = store, settings
        self.layers, self.isolation = tuple(layers), isolation
        self._tables: dict[str, DataFrame] = {}
        self.store.fingerprint = hashlib.sha256(
            f"{input_fingerprint(raw_a, raw_b)}|{settings}|{self.layers}|{isolation}|{fusework.__version__}".encode()
        ).hexdigest()

    def variant(self, name: str, **changes) -> CatalogRun:
        """A run over the same cleaned sources with other layers or settings."""
        other = CatalogRun(
            self.raw_a, self.raw_b, StageStore(self.store.spark, self.store.path(name)),
            changes.get("settings", self.settings), changes.get("layers", self.layers),
            changes.get("isolation", self.isolation),
        )
        self.links
        shared = ["clean_a", "clean_b", "link_a", "link_b"]
        if (other.settings, other.layers) == (self.settings, self.layers):
            self.bounds
            shared += ["matches", "master_plain", "iqr_bounds"]
        for name in shared:
            other._tables[name] = self._tables[name]
        return other

    def _staged(self, name: str, build: Callable[[], DataFrame], **rules) -> DataFrame:
        if name not in self._tables:
            if self.store.published(name):
                self._tables[name] = self.store.load(name)
            else:
                self._tables[name] = self.store.save(build(), name, **rules)
        return self._tables[name]

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        return self._staged(name, lambda: df)

    @property
    def clean_a(self) -> DataFrame:
        return self._staged("clean_a", lambda: clean.clean_catalog_a(self.raw_a, self.settings))

    @property
    def clean_b(self) -> DataFrame:
        return self._staged("clean_b", lambda: clean.clean_catalog_b(self.raw_b, self.settings))

    @property
    def links(self) -> tuple[DataFrame, DataFrame]:
        """The narrow link projections, stored so that every layer reads only them."""
        if "link_b" not in self._tables:
            a, b = link.linkage_inputs(self.clean_a, self.clean_b, self.settings)
            self.stage(a, "link_a")
            self.stage(b, "link_b")
        return self._tables["link_a"], self._tables["link_b"]

    @property
    def matches(self) -> DataFrame:
        if "matches" not in self._tables and self.store.published("matches"):
            self._tables["matches"] = self.store.load("matches")
        if "matches" not in self._tables:
            a, b = self.links
            found = link.linkage_cascade(a, b, self.stage, self.settings, self.layers)
            flagged, checks, helpers = link.one_to_one(found)
            self._staged("matches", lambda: flagged, checks=checks, helpers=helpers)
        return self._tables["matches"]

    @property
    def strong(self) -> DataFrame:
        return link.strong_only(self.matches)

    @property
    def master_plain(self) -> DataFrame:
        if "master_plain" not in self._tables and not self.store.published("master_plain"):
            matches = self.matches
            n_strong = link.strong_only(matches).count()
            checks, counts, verify = golden.golden_checks(self.clean_a.count(), self.clean_b.count(), n_strong, self.settings)
            return self._staged(
                "master_plain",
                lambda: golden.golden_record(self.clean_a, self.clean_b, self.strong, self.stage, self.settings),
                checks=checks, counts=counts, verify=verify,
            )
        return self._staged("master_plain", lambda: None)

    @property
    def bounds(self) -> DataFrame:
        return self._staged(
            "iqr_bounds", lambda: outliers.iqr_bounds(self.master_plain, outliers.IQR_COLUMNS, self.settings)
        )

    @property
    def master(self) -> DataFrame:
        """The master table with all outlier flags."""

        def build() -> DataFrame:
            flagged = outliers.iqr_flags(self.master_plain, outliers.IQR_COLUMNS, self.bounds)
            if self.isolation:
                flagged = outliers.isolation_forest(
                    flagged, "movie_master_id", self.stage, settings=self.settings
                )
            return outliers.any_outlier_flag(flagged)

        return self._staged("master", build)

    @property
    def features(self) -> DataFrame:
        return self._staged(
            "tfidf",
            lambda: recommend.tfidf_features(
                recommend.content_text(self.master), "movie_master_id", "content_text", self.settings
            ),
        )


def stage_profile(run: CatalogRun) -> dict[str, DataFrame]:
    a, b = run.settings.source_a, run.settings.source_b
    diagnosis_a, diagnosis_b = profile.diagnose_catalog_a(run.raw_a), profile.diagnose_catalog_b(run.raw_b)
    return {
        "profile_before": profile.profile_columns(run.raw_a, a).unionByName(profile.profile_columns(run.raw_b, b)),
        "diagnosis_a": diagnosis_a,
        "diagnosis_b": diagnosis_b,
        "initial_issues": profile.initial_issues_comparison(diagnosis_a, diagnosis_b),
    }


def stage_clean(run: CatalogRun) -> dict[str, DataFrame]:
    return {
        "cleaning_summary": clean.cleaning_summary(
            run.raw_a, run.raw_b, run.clean_a, run.clean_b, run.settings
        )
    }


def stage_link(run: CatalogRun) -> dict[str, DataFrame]:
    return {
        "match_audit": run.matches,
        "linkage_histogram": link.linkage_score_histogram(run.matches),
        "record_types": audit.record_type_summary(run.master_plain),
    }


def stage_quality(run: CatalogRun) -> dict[str, DataFrame]:
    master = run.master
    return {
        "profile_after": profile.profile_columns(master, "movie_master"),
        "coverage": audit.coverage_summary(master, run.settings),
        "quality_before_after": audit.quality_before_after(run.raw_a, run.raw_b, run.master_plain),
        "iqr_summary": outliers.iqr_summary(master, run.bounds, outliers.IQR_COLUMNS),
        "outliers_by_type": outliers.outliers_by_type(master),
        "dqs_boxplot": audit.dqs_boxplot_stats(master),
        "quality_dimensions": audit.quality_dims_by_type(master),
        "null_pct": profile.null_pct_columns(master, audit.NULL_REPORT_COLUMNS),
        "log_scatter": audit.log_scatter_points(master),
        "roi_histogram": audit.winsor_histogram(master, "roi"),
        "audit": audit.audit_checks(run.clean_a, run.clean_b, run.strong, master, run.settings),
    }


def stage_analysis(run: CatalogRun) -> dict[str, DataFrame]:
    master = run.master
    out = {name: report(master) for name, report in reports.REPORTS.items()}
    profit = models.profitability_models(master, "movie_master_id", run.stage, settings=run.settings)
    revenue = models.revenue_models(
        models.revenue_input(master), "movie_master_id", run.stage, settings=run.settings
    )
    genres, marketing = ranking.genre_investment_ranking(master), ranking.marketing_priority_ranking(master)
    out |= {"tfidf": run.features, "genre_ranking": genres, "marketing_ranking": marketing}
    out |= {"profit_models": profit, "revenue_models": revenue}
    out["conclusions"] = ranking.conclusions_facts(master, genres, marketing, profit, revenue)
    return out


STAGES: dict[int, Callable[[CatalogRun], dict[str, DataFrame]]] = {
    1: stage_profile,
    2: stage_clean,
    3: stage_link,
    4: stage_quality,
    5: stage_analysis,
}


def run_stages(run: CatalogRun, steps: Sequence[int] = (1, 2, 3, 4, 5)) -> dict[str, DataFrame]:
    """Runs the chosen stages in order and stores every report under ``reports/``.

    A stage is done once its manifest ``done-<step>`` is published, which names its reports; done stages of an earlier run over
    the same inputs are read.
    """
    results: dict[str, DataFrame] = {}
    store = run.store
    for step in sorted(set(steps)):
        if store.published(f"done-{step}"):
            names = [r.name for r in store.load(f"done-{step}").collect()]
            results |= {name: store.load(f"reports/{name}") for name in names}
            continue
        reports_ = {name: store.save(df, f"reports/{name}") for name, df in STAGES[step](run).items()}
        store.save(store.spark.createDataFrame([(name,) for name in reports_], "name string").coalesce(1), f"done-{step}")
        results |= reports_
    return results
