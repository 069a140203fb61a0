"""The registered queries: name -> function of (session, table folder)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from cellpulse.functions import parsing, scores
from cellpulse.operators import (
    asof, classification, clean, dashboard, ensemble, ewma, fairness, features, grid, histograms, history, models,
    neighbors, panel, predictions, profile, regular, report,
    scaling, slots, split, summaries,
)
from cellpulse.plans.incremental import IncrementalPanel
from cellpulse.queries import views
from cellpulse.queries.views import CONFIG
from cellpulse.sources import artefacts, tables
from cellpulse.staging import new_path, written

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

CLASSIFIERS = ["forest", "boosted", "gradient", "logistic"]
ROLLING = ["rolling_mean_1", "rolling_mean_3", "rolling_mean_7", "rolling_mean_14"]
SIX = [*ROLLING, "lag_3", "rolling_max_3"]
CELL_KEY = ["cell_id", "time_window"]
CORRELATED = ["lat", "lon", "district", "resolved", "hour"]
DESKTOP_INPUTS = ["lat", "lon", "district", "hour", "day_of_week", "is_weekend", "is_night", "dist_from_center"]
# Reduced settings so that a trial run ends in seconds; the library's defaults are in `operators.models`.
SMALL_FOREST = models.ForestParams(trees=20, depth=6)
SMALL_BOOST = models.BoostParams(rounds=8, depth=4, step=0.2)
SMALL_LEAFWISE = models.BoostParams(rounds=8, depth=5, step=0.15, min_leaf=20)


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        CATALOG[name] = lambda spark, folder: views.rounded(function(spark, folder))
        return function

    return register


def _incident_query(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, folder: build(views.stages(spark, folder).incidents))


def _cleaned_query(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, folder: build(views.stages(spark, folder).cleaned))


def _gridded_query(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, folder: build(views.stages(spark, folder).gridded))


def _panel_query(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, folder: build(views.stages(spark, folder).panel))


def _feature_query(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, folder: build(views.stages(spark, folder).features))


def _prediction_query(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, folder: build(views.stages(spark, folder).predictions()))


def _dashboard_query(name: str, build: Callable[..., DataFrame], time: str | None = None) -> None:
    """A view of one window, the latest by default, over the files that hold it."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        stored = views.daily_predictions(spark, folder)
        at = time or stored.latest()
        return build(predictions.with_open_risk(stored.at(at), CONFIG), at)

    query(name)(run)


def _stored_query(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    """A view of all windows."""
    query(name)(
        lambda spark, folder: build(predictions.with_open_risk(views.daily_predictions(spark, folder).rows, CONFIG))
    )


def _scored_query(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, folder: build(views.scored(spark, folder)))


# --- sources and sinks -------------------------------------------------------------------------------


@query("scan_csv")
def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "incidents-csv")
    raw = views.stages(spark, folder).incidents
    tables.write_csv(
        raw.select(
            "event_id",
            F.date_format("ts", "MM/dd/yyyy hh:mm:ss a").alias("Date"),
            F.col("category").alias("Primary Type"),
            F.col("lat").alias("Latitude"),
            F.col("lon").alias("Longitude"),
            F.col("district").alias("District"),
        ),
        path,
    )
    schema = "event_id long, Date string, `Primary Type` string, Latitude double, Longitude double, District int"
    return tables.standard_incidents(tables.read_csv(spark, path, schema))


@query("project_optional")
def project_optional(spark: SparkSession, folder: str) -> DataFrame:
    raw = views.stages(spark, folder).incidents.withColumnsRenamed({"district": "District"})
    return clean.keep_columns(raw, ["event_id", "ts", "lat", "lon", "category"])


@query("load_predictions")
def load_predictions(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "predictions")
    tables.write_predictions(views.stages(spark, folder).predictions().drop("ultra_error"), path)
    loaded = tables.load_predictions(spark, [f"{path}-absent", path], CONFIG)
    return loaded.select(*CELL_KEY, "target", "ultra_predicted", "ultra_error", "risk_level")


_prediction_query(
    "recent_rows",
    lambda df: predictions.recent_rows(df.select(*CELL_KEY, "target", "ultra_predicted"), CONFIG.recent_rows),
)
_prediction_query(
    "recent_rows_100", lambda df: predictions.recent_rows(df.select(*CELL_KEY, "target", "ultra_predicted"), 100)
)


@query("sink_roundtrip")
def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "panel-by-month")
    stored = views.stages(spark, folder).panel
    tables.write_panel(stored, path)
    return tables.read_panel(spark, path, stored.schema)


# --- cleaning and profiling --------------------------------------------------------------------------


@query("parse_ts")
def parse_ts(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("k")
    when = (
        F.when(k % 4 == 0, F.date_format("ts", "MM/dd/yyyy hh:mm:ss a"))
        .when(k % 4 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(k % 4 == 2, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise("not a date")
    )
    number = F.when(k % 3 == 0, F.col("value").cast("string")).when(
        k % 3 == 1, F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))
    ).otherwise("n/a")
    return views.events(spark, folder).select(
        "event_id", parsing.parse_timestamp(when).alias("parsed_ts"), parsing.parse_number(number).alias("parsed_number")
    )


_cleaned_query("clean_incidents", lambda df: df)
_incident_query("cleaning_counts", lambda df: clean.cleaning_counts(df, CONFIG))
_incident_query("missing_profile", profile.missing_profile)
_incident_query("column_profile", profile.column_profile)
_incident_query("first_rows", lambda df: profile.first_rows(df, "event_id", 10))
_incident_query(
    "detect_roles",
    lambda df: profile.detect_roles(
        df.select(
            F.col("event_id").alias("ID"),
            F.col("ts").alias("Updated On"),
            F.col("ts").alias("Date"),
            F.col("category").alias("Primary Type"),
            F.col("district").cast("double").alias("Plate Number"),
            F.col("lat").alias("Latitude"),
            F.col("lon").alias("Longitude"),
        )
    ),
)


def _unnamed(df: DataFrame) -> DataFrame:
    """Columns whose names say nothing, and some that say something else."""
    return df.select(
        F.col("event_id").alias("ID"), F.date_format("ts", "MM/dd/yyyy hh:mm:ss a").alias("noted"),
        F.col("category").alias("Date"), F.col("lat").alias("a"), F.col("lon").alias("b"),
        F.col("district").cast("double").alias("Latitude"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("sent"),
    )


_incident_query("role_evidence", lambda df: profile.role_evidence(_unnamed(df)).drop("distinct_share"))
_incident_query("detect_roles_evidence", lambda df: profile.detect_roles_by_evidence(_unnamed(df)).select("role", "column"))
_incident_query("detect_roles_by_name", lambda df: profile.name_roles(_unnamed(df)))
_incident_query("date_coverage", profile.date_coverage)
_incident_query("coord_coverage", profile.coord_coverage)
_incident_query("top_categories", lambda df: profile.top_categories(df, k=3))
_incident_query("category_counts", profile.category_counts)
_incident_query("calendar_hist", profile.calendar_histograms)
_incident_query("calendar_hist_filled", profile.filled_calendar_histograms)
_incident_query("weekend_counts", profile.weekend_counts)
_gridded_query("incident_summary", panel.incident_summary)
_panel_query("panel_summary", panel.panel_summary)

# --- grid and panel ----------------------------------------------------------------------------------

_cleaned_query("grid_meta", lambda df: grid.grid_metadata(df, CONFIG))
_cleaned_query(
    "assign_cells",
    lambda df: grid.assign_cells(df.select("event_id", "lat", "lon"), CONFIG),
)
_cleaned_query("time_windows", lambda df: grid.assign_windows(df.select("event_id", "ts"), CONFIG))
query("grid_time_panel")(lambda spark, folder: views.stages(spark, folder).build_panel())


@query("grid_meta_stored")
def grid_meta_stored(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "grid")
    found = grid.grid_metadata(views.stages(spark, folder).cleaned, CONFIG)
    artefacts.write_grid(found, path)
    return artefacts.read_grid(spark, path, found.schema)


@query("panel_incremental")
def panel_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The panel from three batches that come out of order, one of them twice; two are folded into one."""
    chain = views.stages(spark, folder)
    growing = IncrementalPanel(spark, new_path(spark, "incremental"), chain.anchored)
    for part in (2, 0, 1, 2):
        growing.add(chain.incidents.where(F.col("event_id") % 3 == part), f"part-{part}")
    growing.compact("early", ["part-0", "part-1"])
    return growing.panel()


_panel_query("panel_dense", lambda df: regular.densify(df, CONFIG))
_panel_query(
    "feat_target_dense",
    lambda df: history.target_feature(regular.densify(df, CONFIG)).select(*CELL_KEY, "incident_count", "target", "target_binary"),
)

# --- aggregations ------------------------------------------------------------------------------------

_gridded_query("cell_totals", summaries.cell_totals)
_gridded_query("density_matrix", summaries.density_matrix)
_gridded_query("density_matrix_dense", lambda df: summaries.density_matrix(df, dense=True))
_gridded_query("density_tiers", lambda df: summaries.density_tiers(df))
_gridded_query("top_cells", lambda df: summaries.top_cells(df))
_cleaned_query("daily_counts", summaries.daily_counts)
_gridded_query("peak_hour", summaries.peak_hour)
_panel_query("count_of_counts", summaries.count_of_counts)
_cleaned_query("district_summary", summaries.district_summary)
_incident_query(
    "corr_matrix", lambda df: summaries.corr_matrix(df.withColumn("hour", F.hour("ts")), CORRELATED)
)
_prediction_query("temporal_trends", summaries.temporal_trends)
_feature_query("target_summary", summaries.target_summary)
_prediction_query("cell_risk", summaries.cell_risk)

# --- features ----------------------------------------------------------------------------------------

_panel_query("feat_temporal", lambda df: features.temporal_features(df).select(*CELL_KEY, "hour", "day_of_week", "is_weekend", *features.CALENDAR))
_panel_query("feat_lags", lambda df: history.lag_features(df).select(*CELL_KEY, *history.lag_columns()))
_panel_query(
    "feat_neighbors",
    lambda df: neighbors.neighbor_features(df).select(*CELL_KEY, "neighbor_sum", "neighbor_mean", "neighbor_max"),
)
_panel_query("feat_cell_stats", lambda df: history.cell_statistics(df).select(*CELL_KEY, *history.cell_columns()))
_panel_query(
    "feat_slot_avgs",
    lambda df: slots.slot_features(df).select(
        *CELL_KEY, "dow_avg_incidents", "hour_avg_incidents", "weekend_avg_incidents"
    ),
)
_panel_query("feat_cell_before", lambda df: asof.cell_statistics_before(df).select(*CELL_KEY, *asof.CELL))
_panel_query(
    "feat_slots_before",
    lambda df: asof.slot_features_before(df).select(*CELL_KEY, "dow_avg_before", "hour_avg_before", "weekend_avg_before"),
)
_feature_query(
    "feat_rank_before",
    lambda df: asof.rank_share_before(df.select(*CELL_KEY, "lag_1")).select(*CELL_KEY, "lag1_percentile_before"),
)
_panel_query("feat_trend", lambda df: history.trend_features(df).select(*CELL_KEY, "trend_short", "trend_long", "momentum"))
_panel_query("feat_target", lambda df: history.target_feature(df).select(*CELL_KEY, "target", "target_binary"))
_panel_query("feature_matrix", lambda df: features.feature_matrix(df, CONFIG))
query("feat_advanced")(
    lambda spark, folder: views.stages(spark, folder).build_features().select(*CELL_KEY, *features.ADVANCED)
)
_panel_query("feat_ewma", lambda df: ewma.ewma_features(df).select(*CELL_KEY, "ewma_3", "ewma_7"))
_feature_query(
    "feat_rank_pct",
    lambda df: history.rank_share(df.select(*CELL_KEY, "lag_1")).select(*CELL_KEY, "lag1_percentile"),
)
_cleaned_query("feat_dist_mean", lambda df: features.distance_from_mean(df.select("event_id", "lat", "lon")))
_cleaned_query(
    "feat_desktop",
    lambda df: features.incident_features(df.select("event_id", "ts")),
)
_feature_query(
    "feat_interactions_v1",
    lambda df: features.pairwise_interactions(df).select(
        *CELL_KEY, "cell_avg_x_hour", "recent_to_longterm", "lag1_x_hour", "lag1_to_rolling_mean7",
        "neighbor_mean_x_lag3", "rolling_mean_3_x_dow", "trend_short_x_weekend", "lag1_x_weekend",
        "rolling_mean_3_squared", "lag_1_squared",
    ),
)
_feature_query(
    "align_features",
    lambda df: features.align_features(
        df.select(*CELL_KEY, "momentum", "lag_1", "hour"), ["hour", "absent_feature", "lag_1"]
    ),
)

# --- predictions and splits --------------------------------------------------------------------------

_prediction_query("predictions", lambda df: df)
_prediction_query(
    "risk_levels",
    lambda df: df.select(
        *CELL_KEY, "ultra_predicted", F.col("risk_level").alias("bounded_level"),
        scores.open_risk(F.col("ultra_predicted"), CONFIG.open_risk_edges).alias("open_level"),
    ),
)
_prediction_query("error_by_decile", lambda df: histograms.error_by_prediction(df, "ultra_predicted", "ultra_error"))
_prediction_query("error_hist", lambda df: histograms.equal_width(df, "ultra_error"))
_prediction_query("hex_density", lambda df: histograms.hex_density(df, "target", "ultra_predicted"))


def _assigned(df: DataFrame) -> DataFrame:
    return split.time_split(df, CONFIG.split_shares).assign(df)


_prediction_query("time_split", lambda df: _assigned(df).select(*CELL_KEY, "split"))
_prediction_query("split_summary", lambda df: split.split_summary(_assigned(df)))
_prediction_query(
    "top_test_hotspots",
    lambda df: predictions.top_predictions(split.time_split(df, CONFIG.split_shares).part(df, "test")),
)
_prediction_query(
    "test_metrics",
    lambda df: split.time_split(df, CONFIG.split_shares).part(df, "test").agg(
        F.count("*").alias("n"), *[c.alias(name) for name, c in report.error_metrics().items()]
    ),
)
_incident_query(
    "random_split",
    lambda df: df.select("event_id", split.hashed_split(df, "event_id").alias("split")),
)

# --- dashboard ---------------------------------------------------------------------------------------

_dashboard_query(
    "dash_filter",
    lambda df, time: dashboard.select_rows(df, time, levels=("Medium", "High"), min_prediction=1.2).select(
        *CELL_KEY, "ultra_predicted", "risk_level"
    ),
)
_dashboard_query("dash_metrics", lambda df, time: dashboard.metrics(df, threshold=2.0, time=time))
_dashboard_query("map_layer", lambda df, time: dashboard.map_layer(df, threshold=2.0, time=time))
_dashboard_query("map_points", lambda df, time: dashboard.map_layer(df, sample=CONFIG.map_sample, time=time))
_dashboard_query("map_points_10", lambda df, time: dashboard.map_layer(df, sample=10, time=time))
_dashboard_query("dash_performance", dashboard.performance)
_dashboard_query("dash_risk_counts", dashboard.risk_counts, time="2024-01-15 12:00:00")
_dashboard_query("dash_error_hist", dashboard.error_histogram)
_dashboard_query("hotspots", lambda df, time: dashboard.hotspots(df, time=time))
_stored_query("window_list", dashboard.window_list)
_stored_query("dash_overview", dashboard.overview)
query("stored_extent")(lambda spark, folder: views.daily_predictions(spark, folder).extent().drop("files"))
query("stored_days")(
    lambda spark, folder: views.daily_predictions(spark, folder).manifest.groupBy("window_date").agg(
        F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last")
    )
)
query("windows_between")(
    lambda spark, folder: views.daily_predictions(spark, folder).between("2024-01-09 18:00:00", "2024-01-12 06:00:00")
    .select(*CELL_KEY, "target", "ultra_predicted")
)
_incident_query("heat_points", dashboard.heat_points)
_incident_query("map_center", dashboard.map_center)
_cleaned_query("cluster_points", lambda df: dashboard.cluster_points(df, "event_id", CONFIG.cluster_points))
_cleaned_query("cluster_points_100", lambda df: dashboard.cluster_points(df, "event_id", 100))

# --- report ------------------------------------------------------------------------------------------

_prediction_query("report_dataset", report.dataset)
_prediction_query("report_accuracy", report.accuracy)
_prediction_query("report_tiers", report.tiers)
_prediction_query("report_predictions", report.prediction_figures)
_prediction_query("report_risk", report.risk_distribution)
_prediction_query("report_hours", report.hours)
_prediction_query("report_days", report.days)
_prediction_query("report_weekend", report.weekend)
_prediction_query("report_concentration", report.concentration)
_prediction_query("report_operations", lambda df: report.operations(df, CONFIG))
_prediction_query("report_preventable", lambda df: report.preventable(df, CONFIG))
_prediction_query("report_baseline", report.baseline)


@query("report_tall")
def report_tall(spark: SparkSession, folder: str) -> DataFrame:
    """The full report, written to its sink and read back."""
    path = new_path(spark, "report")
    found = report.full(views.stages(spark, folder).predictions(), CONFIG)
    tables.write_report(found, path)
    return tables.read_report(spark, path)


_prediction_query("error_percentiles", report.error_percentiles)
_prediction_query("residuals", predictions.residuals)
_prediction_query("qq_points", lambda df: report.qq_points(predictions.residuals(df)))
_feature_query("model_ranking", lambda df: report.model_ranking(df, ROLLING))

# --- scaling, encoding, ensembles --------------------------------------------------------------------


@query("robust_scale")
def robust_scale(spark: SparkSession, folder: str) -> DataFrame:
    table = views.stages(spark, folder).features
    inputs = features.feature_columns(table)
    train = split.time_split(table, CONFIG.split_shares).part(table, "train")
    return scaling.fit_robust(train, inputs).apply(table).select(*CELL_KEY, *inputs)


def _desktop(df: DataFrame) -> DataFrame:
    return features.distance_from_mean(features.incident_features(df))


@query("standard_scale")
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    table = _desktop(views.stages(spark, folder).cleaned)
    return scaling.fit_standard(table, DESKTOP_INPUTS).apply(table).select("event_id", *DESKTOP_INPUTS)


@query("label_encode")
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    table = views.stages(spark, folder).gridded.select("event_id", "category", "cell_id")
    coded = scaling.label_encode(table, "category", "cell_id")
    return coded.select("event_id", "category_code", "cell_id_code")


@query("encode_unseen")
def encode_unseen(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of the first half of the windows, applied to all rows: later cells may have none."""
    table = views.stages(spark, folder).gridded.select("event_id", "category", "cell_id", "day_of_month")
    codes = scaling.fit_codes(table.where("day_of_month <= 3"), "category", "cell_id")
    return scaling.encode(table, codes).select("event_id", "category_code", "cell_id_code")


_feature_query("ensemble_weights", lambda df: ensemble.best_weights(df.select("target", *ROLLING), ROLLING))


_feature_query("ensemble_weights_six", lambda df: ensemble.best_weights(df.select("target", *SIX), SIX))


@query("weighted_ensemble")
def weighted_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    table = views.stages(spark, folder).features
    best = ensemble.best_weights(table.select("target", *ROLLING), ROLLING).first()
    mixed = ensemble.mix(table, ROLLING, [best[f"w{i}"] for i in range(len(ROLLING))], "mixed")
    return mixed.select(*CELL_KEY, "target", "mixed")


# --- classification and fairness ---------------------------------------------------------------------

_scored_query("class_metrics", lambda df: classification.class_metrics(df, "y_true", "y_pred"))
_scored_query("confusion", lambda df: classification.confusion(df, "y_true", "y_pred"))
_scored_query("confusion_dense", lambda df: classification.confusion(df, "y_true", "y_pred", dense=True))
_scored_query("roc_curve", lambda df: classification.roc_points(df, "y_true", "score"))
_scored_query("roc_hard_labels", lambda df: classification.roc_points(df, "y_true", "y_pred"))
_scored_query("roc_auc", lambda df: classification.roc_auc(df, "y_true", "score"))
_scored_query(
    "model_comparison", lambda df: classification.model_comparison(df, "y_true", ["y_pred", "y_low", "y_user"])
)
_scored_query("class_distribution", lambda df: classification.prediction_distribution(df, "y_pred"))
_scored_query("disparate_impact", lambda df: fairness.disparate_impact(df, "y_true", "y_pred", "sensitive"))
_scored_query("demographic_parity", lambda df: fairness.demographic_parity(df, "y_true", "y_pred", "sensitive"))
_scored_query("equal_opportunity", lambda df: fairness.equal_opportunity(df, "y_true", "y_pred", "sensitive"))
_scored_query("fairness_groups", lambda df: fairness.group_rates(df, "y_true", "y_pred", "sensitive"))
_scored_query("fairness_report", lambda df: fairness.fairness_report(df, "y_true", "y_pred", "sensitive"))

# --- models ------------------------------------------------------------------------------------------


class _Training:
    """The feature table with scaled inputs beside it, its time split, and the regressors at the reduced
    settings."""

    def __init__(self, spark: SparkSession, folder: str):
        table = views.stages(spark, folder).features
        names = features.feature_columns(table)
        self.split = split.time_split(table, CONFIG.split_shares)
        self.features = table
        self.scaler = scaling.fit_robust(self.split.part(table, "train"), names)
        self.inputs = [f"{name}_scaled" for name in names]
        self.table = self.scaler.apply(table, "_scaled")
        self.parts = {name: self.split.part(self.table, name) for name in self.split.names}
        self.learners = models.regressors(SMALL_FOREST, SMALL_BOOST, SMALL_LEAFWISE)
        self.fitted: dict[str, PipelineModel] = {}

    def fit(self, *names: str) -> dict[str, PipelineModel]:
        """The named regressors, or all; each is fitted once."""
        wanted = names or tuple(self.learners)
        missing = {name: self.learners[name] for name in wanted if name not in self.fitted}
        if missing:
            self.fitted |= models.fit_all(missing, models.with_weight(self.parts["train"]), self.inputs)
        return {name: self.fitted[name] for name in wanted}

    def weights(self) -> dict[str, float]:
        """The best weighting of all regressors on the validation rows."""
        fitted = self.fit()
        best = ensemble.best_weights(models.score(fitted, self.parts["val"]), list(fitted)).first()
        return {name: best[f"w{i}"] for i, name in enumerate(fitted)}

    def scored(self, *names: str) -> DataFrame:
        return models.score(self.fit(*names), self.parts["test"]).select(*CELL_KEY, "target", *names)


_trainings: dict[tuple[str, str], _Training] = {}


def _training(spark: SparkSession, folder: str) -> _Training:
    """One split and scaler fit per session and folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _trainings:
        _trainings[key] = _Training(spark, folder)
    return _trainings[key]


for _name, _learner in {
    "train_rf": "forest", "train_gbt": "boosted", "train_gbt_b": "leafwise", "train_gbt_weighted": "weighted",
}.items():
    query(_name)(lambda spark, folder, learner=_learner: _training(spark, folder).scored(learner))


@query("tune_gbt")
def tune_gbt(spark: SparkSession, folder: str) -> DataFrame:
    training = _training(spark, folder)
    trials = models.draw_trials(models.BoostParams(rounds=3), 2)
    return models.tune(trials, training.parts["train"], training.parts["val"], training.inputs)


@query("stack_models")
def stack_models(spark: SparkSession, folder: str) -> DataFrame:
    training = _training(spark, folder)
    learners = {name: training.learners[name] for name in ("forest", "boosted", "leafwise")}
    stack = models.fit_stack(learners, training.parts["train"], training.inputs)
    return stack.apply(training.parts["test"]).select(*CELL_KEY, "target", *learners, "stacked")


@query("ranked_models")
def ranked_models(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted regressors, their best weighting on the validation rows, all compared on the test rows."""
    training = _training(spark, folder)
    fitted = training.fit()
    names = list(fitted)
    weights = training.weights()
    tested = ensemble.mix(models.score(fitted, training.parts["test"]), names, [weights[n] for n in names], "ensemble")
    return report.model_ranking(tested, [*names, "ensemble"])


@query("feature_importance")
def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Importances of all regressors under their best weighting."""
    training = _training(spark, folder)
    names = [name.removesuffix("_scaled") for name in training.inputs]
    importance = models.importance(training.fit(), names, training.weights())
    return dashboard.top_importance(importance, 20)


@query("model_roundtrip")
def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    training = _training(spark, folder)
    path = new_path(spark, "model")
    models.save_model(training.fit("forest")["forest"], path)
    return models.score({"forest": models.load_model(path)}, training.parts["test"]).select(*CELL_KEY, "target", "forest")


@query("bundle_roundtrip")
def bundle_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows scored by a bundle that was stored and loaded; `same` compares with the fitted models."""
    training = _training(spark, folder)
    path = new_path(spark, "bundle")
    plain = scaling.Scaler(training.scaler.columns, training.scaler.centers, training.scaler.scales)
    artefacts.Bundle(
        training.fit("forest", "boosted"), training.inputs, {"forest": 0.25, "boosted": 0.75}, plain,
        grid=grid.grid_metadata(views.stages(spark, folder).cleaned, CONFIG),
    ).save(spark, path)
    rows = training.split.part(training.features, "test")
    loaded = artefacts.Bundle.load(spark, path).score(rows, "mixed").select(*rows.columns, "mixed")
    again = models.score(training.fit("forest", "boosted"), plain.apply(loaded, "_scaled"))
    wanted = F.col("forest") * 0.25 + F.col("boosted") * 0.75
    return again.select(*CELL_KEY, "target", (F.abs(F.col("mixed") - wanted) < 1e-9).alias("same"))


@query("importance_stored")
def importance_stored(spark: SparkSession, folder: str) -> DataFrame:
    """Importances of a stored file, found among several paths; here how far a feature goes along with the target."""
    path = new_path(spark, "importance")
    table = views.stages(spark, folder).features
    found = table.agg(*[F.abs(F.corr(c, "target")).alias(c) for c in SIX]).select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("importance")) for c in SIX])).alias("r")
    ).select("r.*")
    tables.write_csv(found, path)
    return dashboard.top_importance(artefacts.first_importance(spark, [f"{path}-absent", path]), 4)


@query("score")
def score(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of every row from stored artefacts: scaler, order of the inputs and model are saved, loaded
    and applied; no row moves."""
    training = _training(spark, folder)
    path = new_path(spark, "artefacts")
    models.save_model(training.fit("boosted")["boosted"], f"{path}/model")
    models.save_settings(spark, {**asdict(training.scaler), "inputs": training.inputs}, f"{path}/settings")
    stored = models.load_settings(spark, f"{path}/settings")
    scaler = scaling.Scaler(tuple(stored["columns"]), tuple(stored["centers"]), tuple(stored["scales"]))
    aligned = scaler.apply(training.features, "_scaled").select(*training.features.columns, *stored["inputs"])
    scored = models.score({"boosted": models.load_model(f"{path}/model")}, aligned)
    return predictions.predictions(scored, F.col("boosted"), CONFIG)


_classified_rows: dict[tuple[str, str], DataFrame] = {}


def _classified(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out incidents with the class and confidence of the four classifiers; fitted once per folder."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _classified_rows:
        table = scaling.label_encode(_desktop(views.stages(spark, folder).cleaned), "category")
        inputs = [*DESKTOP_INPUTS, "month", "category_code"]
        labelled = written(table.withColumn("_split", split.hashed_split(table, "event_id")), "labelled")
        train, test = (labelled.where(F.col("_split") == part).drop("_split") for part in ("train", "test"))
        scaler = scaling.fit_standard(train, inputs)
        fitted = models.fit_all(models.classifiers("resolved", trees=8, depth=5), scaler.apply(train), inputs)
        _classified_rows[key] = models.classify(fitted, scaler.apply(test.withColumn("_group", F.col("district"))))
    return _classified_rows[key]


@query("train_classifiers")
def train_classifiers(spark: SparkSession, folder: str) -> DataFrame:
    return _classified(spark, folder).select("event_id", "resolved", *CLASSIFIERS)


@query("classifier_comparison")
def classifier_comparison(spark: SparkSession, folder: str) -> DataFrame:
    tested = _classified(spark, folder).withColumn("resolved", F.col("resolved").cast("double"))
    return classification.model_comparison(tested, "resolved", CLASSIFIERS)


@query("pred_distribution")
def pred_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return classification.prediction_distribution(_classified(spark, folder), "forest", "forest_confidence")


@query("classifier_fairness")
def classifier_fairness(spark: SparkSession, folder: str) -> DataFrame:
    """The audit on a fitted model, the group being the district of each scored row."""
    return fairness.fairness_report(_classified(spark, folder), "resolved", "forest", "_group")
