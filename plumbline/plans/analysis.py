"""The three analyses: weather and energy, air-quality regression, accident severity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.columns import col
from plumbline.functions import calendar as cal
from plumbline.functions.categories import INJURY_REGROUP, MO_CODE_GROUPS, UNKNOWN, code_group_columns, recode
from plumbline.functions.convert import at_clock
from plumbline.operators import stats
from plumbline.operators.clean import drop_token_columns
from plumbline.operators.impute import impute_group_mean
from plumbline.operators.models import Fitted, fit_boosted_trees, fit_forest, hash_split, top_features
from plumbline.operators.selection import chronological_cut
from plumbline.session import cut_lineage

# Regression target per station, and the features of both models.
REGRESSION_TARGETS = {"downtown": "pm25", "reseda": "pm25", "long_beach": "o3"}
REGRESSION_FEATURES = ("TMAX", "TMIN", "PRCP", "cenergy", "co", "no2", "o3", "so2", "pm25")
TIME_FEATURES = ("occ_day", "occ_month", "occ_hour")
NUMERIC_FEATURES = ("vict_age", "is_weekend", "temp_range", "TMAX", "TMIN", "PRCP")
CATEGORY_FEATURES = ("Location_Type", "Collision_Type", "Collision_Factor", "premis_cd")
TARGET = "Injury_Level"

MODELS_AT_ONCE = 4


def scatter(view: DataFrame, station: str) -> DataFrame:
    """Weather against energy for one station: the data of a scatter matrix."""
    return view.filter(col("station") == station).select("datetime_iso", "TMAX", "TMIN", "PRCP", "cenergy")


def air_regression(
    view: DataFrame,
    targets: Mapping[str, str] = REGRESSION_TARGETS,
    features: Sequence[str] = REGRESSION_FEATURES,
    keys: Sequence[str] = ("station", "datetime_iso"),
    missing: str = "mean",
    **params,
) -> dict[str, Fitted]:
    """One boosted regression per station.

    ``missing="mean"`` fills features and target with the station's means; ``"sides"`` fills nothing:
    rows need only a target to train, the trees learn what a missing feature means, and
    every held-out row is predicted.
    """
    filled = impute_group_mean(view, list(features), ["station"]) if missing == "mean" else view
    # Each station is read several times: the joins behind the view run once.
    split = cut_lineage(hash_split(filled, keys))

    def fit(station: str) -> Fitted:
        rows, target = split.filter(col("station") == station), targets[station]
        names = [f for f in features if f != target]
        return fit_boosted_trees(
            rows.filter("is_train"),
            rows.filter(~col("is_train")),
            target,
            names,
            keys,
            missing="drop" if missing == "mean" else missing,
            **params,
        )

    # The models do not depend on each other, and each is a long chain of small jobs.
    with ThreadPool(min(len(targets), MODELS_AT_ONCE)) as pool:
        return dict(zip(targets, pool.map(inheritable_thread_target(split.sparkSession)(fit), targets)))


def error_distribution(predictions: DataFrame, target: str) -> dict[str, DataFrame]:
    """Histogram and density of the residuals; the model scores each row once."""
    errors = cut_lineage(predictions.select((col(target) - col("prediction")).alias("error")))
    return {"histogram": stats.histogram(errors, "error", stats.ERROR_BINS), "density": stats.density(errors, "error")}


def accident_features(view: DataFrame, groups: Mapping[str, Mapping[str, str]] = MO_CODE_GROUPS) -> DataFrame:
    """Calendar, weather, age and code features of complete rows; rare streets are lumped.

    Complete means a value in every column that holds any value at all.
    """
    # Read twice more, for the empty columns and for the streets; the joins behind it run once.
    view = cut_lineage(view)
    # A column that the event plan dropped comes back empty and says nothing about a row.
    counts = view.agg(*[F.count(col(c)).alias(f"n_{i}") for i, c in enumerate(view.columns)]).first()
    held = [c for c, n in zip(view.columns, counts) if n]
    rows = view.withColumn("datetime_occ", at_clock(col("date_occ"), col("time_occ")))
    rows = rows.na.drop(subset=[*held, "datetime_occ"])
    when = col("datetime_occ")
    rows = rows.withColumns(
        {
            **cal.date_parts(when),
            "occ_part_of_day": cal.part_of_day(F.hour(when)),
            "report_delay_days": cal.delay_days(col("date_rptd"), col("date_occ")),
            "is_weekend": cal.is_weekend(when),
            "temp_range": col("TMAX") - col("TMIN"),
            "is_raining": col("PRCP") > 0,
            "vict_age_group": cal.bin_numeric(col("vict_age"), cal.AGE_EDGES, cal.AGE_LABELS),
            **code_group_columns(col("mocodes"), groups),
        }
    )
    return stats.lump_rare_levels(rows, "location")


def informative(features: DataFrame, keep: Sequence[str] = (TARGET,)) -> DataFrame:
    """Without the columns that are 'unknown' in more than half of the rows; ``keep`` stays."""
    found = drop_token_columns(features)
    return features.select([c for c in features.columns if c in found.columns or c in keep])


def injury_rows(features: DataFrame) -> DataFrame:
    """Rows with a known injury level, in the classes the model predicts."""
    known = features.filter(col(TARGET) != UNKNOWN)
    return known.withColumn(TARGET, recode(col(TARGET), INJURY_REGROUP))


def severity_parts(rows: DataFrame, key: str = "dr_no") -> DataFrame:
    """Earlier rows to train on, later ones to validate; written once, as a model reads them often."""
    # The cut reads them in a dozen passes, and its parts are a comparison with literals: the joins and codes behind run once.
    return chronological_cut(cut_lineage(rows), "datetime_occ", [key])


def severity_model(parts: DataFrame, **params) -> Fitted:
    """Forest trained on the training part and scored on the validation part."""
    return fit_forest(
        parts.filter(col("part") == "train"),
        parts.filter(col("part") == "validation"),
        TARGET,
        NUMERIC_FEATURES,
        TIME_FEATURES,
        [c for c in CATEGORY_FEATURES if c in parts.columns],
        ["datetime_occ", "dr_no"],
        **params,
    )


def accident_charts(features: DataFrame) -> dict[str, DataFrame]:
    """The data behind the charts that need no model."""
    return {
        "weekly_counts": stats.weekly_counts(features, "datetime_occ", "area_name"),
        "month_weekday": stats.month_weekday_mean(features, "datetime_occ"),
        "tmax_histogram": stats.histogram(features, "TMAX", stats.TEMPERATURE_BINS),
        "tmin_histogram": stats.histogram(features, "TMIN", stats.TEMPERATURE_BINS),
        "rain_rate": stats.rate_per_day(features, "is_raining", "datetime_occ"),
    }


def accident_results(features: DataFrame, parts: DataFrame, fitted: Fitted) -> dict[str, DataFrame]:
    """The data behind every chart of the accident analysis."""
    train = parts.filter(col("part") == "train")
    return accident_charts(features) | {
        "accuracy": stats.accuracy(fitted.predictions, TARGET, "prediction"),
        "classification_report": stats.classification_report(fitted.predictions, TARGET, "prediction"),
        "confusion_matrix": stats.confusion_matrix(fitted.predictions, TARGET, "prediction"),
        "feature_importance": top_features(fitted.importances),
        "correlations": stats.correlations(train, [*NUMERIC_FEATURES, *TIME_FEATURES]),
    }
