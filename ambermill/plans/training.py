"""Training frames, statistics, metrics and a Spark ML regressor."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambermill.functions.columns import hour_of_day

# Features, label and half-open split windows.
NUMERIC_FEATURES = (
    "passenger_count", "trip_distance", "hour_of_day",
    "pu_pickup_count_1h", "pu_pickup_count_6h", "pu_pickup_count_24h", "pu_mean_fare_1h", "pu_mean_fare_6h", "pu_mean_fare_24h",
    "driver_trip_count_7d", "driver_trip_count_30d", "driver_mean_trip_distance_7d", "driver_mean_trip_distance_30d",
    "driver_mean_tip_ratio_7d", "driver_mean_tip_ratio_30d",
)
CATEGORICAL_FEATURES = ("pu_location_id", "vendor_id")
LABEL = "tip_pct"
SPLITS = {"train": ("2023-01-01", "2023-01-20"), "val": ("2023-01-20", "2023-01-25"), "test": ("2023-01-25", "2023-02-01")}


def split_column(date_col: str, splits: Mapping[str, tuple[str, str]]) -> Column:
    """Name of the half-open date range that a row falls into; NULL outside all."""
    out = None
    for name, (lo, hi) in splits.items():
        inside = (F.col(date_col) >= F.lit(lo).cast("date")) & (F.col(date_col) < F.lit(hi).cast("date"))
        out = F.when(inside, F.lit(name)) if out is None else out.when(inside, F.lit(name))
    return out


def training_frame(
    df: DataFrame, splits: Mapping[str, tuple[str, str]] = SPLITS, label: str = LABEL, date_col: str = "event_date", ts_col: str = "pickup_datetime",
    numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES,
) -> DataFrame:
    """Features, label, date and split: rows in a split with a label and both categories."""
    hour = hour_of_day(ts_col).alias("hour_of_day")
    cols = [hour if c == "hour_of_day" else F.col(c) for c in numeric]
    lows = [lo for lo, _ in splits.values()]
    rows = df.where(F.col(date_col) >= F.lit(min(lows)).cast("date")).dropna(subset=[label, *categorical])
    out = rows.select(*cols, *categorical, label, date_col, split_column(date_col, splits).alias("split"))
    return out.where(F.col("split").isNotNull())


def load_training_data(df: DataFrame, split: str | None = None, **kwargs) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """({split: frame}, {split: rows}); raises where no row is left. One count job for all splits."""
    frame = training_frame(df, **kwargs)
    names = list(kwargs.get("splits", SPLITS))
    counts = dict.fromkeys(names, 0) | {r["split"]: r["n"] for r in frame.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sum(counts.values()):
        raise ValueError("no training rows in any split")
    if split is not None and split not in names:
        raise ValueError(f"unknown split {split!r}; choose one of {names}")
    chosen = [split] if split else names
    return {s: frame.where(F.col("split") == s).drop("split") for s in chosen}, {s: counts[s] for s in chosen}


def verify_identical_row_counts(a: Mapping[str, int], b: Mapping[str, int]) -> None:
    if dict(a) != dict(b):
        raise AssertionError(f"row counts differ: {dict(a)} and {dict(b)}")


def regression_metrics(df: DataFrame, label: str, prediction: Column) -> DataFrame:
    """rmse, mae and r2 in one pass; r2 is NULL for a constant label."""
    err, y = F.col(label) - prediction, F.col(label)
    ssr, sst = F.sum(err * err), F.count(y) * F.var_pop(y)
    return df.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"), (1 - F.try_divide(ssr, sst)).alias("r2"))


def baseline_metrics(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Metrics of predicting the training mean (a one-row table, so joining it moves nothing)."""
    mean = train.agg(F.avg(label).alias("_mean"))
    return regression_metrics(test.crossJoin(F.broadcast(mean)), label, F.col("_mean"))


def impute_stats(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Exact medians, and modes (the least among the most frequent)."""
    aggs = [F.median(c).alias(f"{c}_median") for c in numeric] + [F.mode(c, True).alias(f"{c}_mode") for c in categorical]
    return df.agg(*aggs)


def standardize(train: DataFrame, df: DataFrame, cols: Sequence[str], eps: float = 1e-6) -> DataFrame:
    """(x - mean) / (population std + eps) with NULLs as 0, by the statistics of train."""
    zero = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols]
    stats = train.select(*zero).agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols]).first()
    out = {c: (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - stats[c]["m"]) / (stats[c]["s"] + eps) for c in cols}
    return df.withColumns(out)


def embedding_sizes(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Highest id + 1; ids outside it are read as 0 later."""
    row = df.agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in cols]).first()
    return {c: int(row[c]) + 1 for c in cols}


def gbt_pipeline(numeric: Sequence[str], categorical: Sequence[str], label: str, max_iter: int = 50, step: float = 0.08, depth: int = 5, seed: int = 42) -> Pipeline:
    num, cat = [f"{c}_i" for c in numeric], [f"{c}_i" for c in categorical]
    return Pipeline(
        stages=[
            Imputer(strategy="median", inputCols=list(numeric), outputCols=num),
            Imputer(strategy="mode", inputCols=list(categorical), outputCols=cat),
            VectorAssembler(inputCols=num + cat, outputCol="features", handleInvalid="keep"),
            GBTRegressor(labelCol=label, maxIter=max_iter, stepSize=step, maxDepth=depth, maxBins=512, seed=seed),
        ]
    )


def train_gbt(frames: Mapping[str, DataFrame], numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES, label: str = LABEL, **params) -> tuple[PipelineModel, dict]:
    """Fit on train; metrics on test beside those of the mean baseline."""
    as_double = {c: F.col(c).cast("double") for c in (*numeric, *categorical)}
    data = {k: v.withColumns(as_double) for k, v in frames.items()}
    model = gbt_pipeline(numeric, categorical, label, **params).fit(data["train"])
    got = regression_metrics(model.transform(data["test"]), label, F.col("prediction")).first().asDict()
    base = baseline_metrics(data["train"], data["test"], label).first().asDict()
    return model, {"model": got, "baseline": base}


def predict(model: PipelineModel, df: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """df with the model's prediction; all other columns stay as they are."""
    keep = df.columns
    as_double = {c: F.col(c).cast("double") for c in (*numeric, *categorical)}
    held = [F.col(f"`{c}`").alias(f"_own_{c}") for c in as_double]
    made = model.transform(df.select("*", *held).withColumns(as_double))
    return made.select(*[F.col(f"_own_{c}").alias(c) if c in as_double else F.col(f"`{c}`") for c in keep], "prediction")


def write_json(path: str, value) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, indent=2, default=str) + "\n")


def save_artifact(root: str, framework: str, model: PipelineModel, metrics: dict, metadata: dict, run_id: str | None = None) -> str:
    """<root>/<framework>/<run_id> with the model, metrics.json and metadata.json."""
    if framework != "sparkml":
        raise ValueError(f"unknown framework {framework!r}")
    folder = Path(root) / framework / (run_id or uuid.uuid4().hex)
    model.write().overwrite().save(f"file://{folder.resolve()}/model")
    write_json(str(folder / "metrics.json"), metrics)
    write_json(str(folder / "metadata.json"), metadata)
    return str(folder)
