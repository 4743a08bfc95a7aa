"""One fit / predict / save / load interface over all forecasters, and the runner over them.

A model names itself, says what it needs (``config``), and ``fit`` returns a ``Fitted``: its parameters are tables or
an MLlib model, ``predict`` gives the long table (key, ts, model, y, yhat) of the test rows, ``save`` writes a folder
that ``load_model`` reads back, in another session too. ``run_forecasters`` fits and predicts every model on all
series, writes each prediction once, and logs training and inference seconds apart.

Report order is the order of MODEL_ORDER (baselines first), other models after them by name.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import SeriesSpec
from .baselines import MODEL_ORDER, lag_forecasts
from .css import fit_css, forecast_css
from .laggram import elastic_net, lag_gram, predict_lags

LOG = "key string, model string, train_s double, infer_s double"


@dataclass(frozen=True)
class LagModel:
    """yhat(t) = y(t - lag); nothing to fit."""

    name: str
    lag: int
    kind: str = "lag"

    def fit(self, df: DataFrame, spec: SeriesSpec) -> "Fitted":
        return Fitted(self, None)

    def predict(self, state, df: DataFrame, spec: SeriesSpec) -> DataFrame:
        return lag_forecasts(df, spec, {self.name: self.lag})

    def save(self, state, path: str) -> None:
        pass

    def load(self, spark: SparkSession, path: str):
        return None


@dataclass(frozen=True)
class ArimaModel:
    """Seasonal ARIMA by conditional sum of squares; the state is the table of parameters per key."""

    name: str = "SARIMA"
    order: tuple = (1, 1, 1)
    seasonal: tuple = (1, 1, 1)
    const: bool = True
    kind: str = "arima"

    def fit(self, df: DataFrame, spec: SeriesSpec) -> "Fitted":
        from ..session import cut_lineage
        return Fitted(self, cut_lineage(fit_css(df, spec, tuple(self.order), tuple(self.seasonal), const=self.const), "arima-params"))

    def predict(self, state, df: DataFrame, spec: SeriesSpec) -> DataFrame:
        return forecast_css(df, spec, state, tuple(self.order), tuple(self.seasonal), const=self.const, model=self.name)

    def save(self, state: DataFrame, path: str) -> None:
        state.write.mode("overwrite").parquet(f"{path}/params")

    def load(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.parquet(f"{path}/params")


@dataclass(frozen=True)
class LinearModel:
    """Pooled (elastic-net) regression on scaled lags by the lag Gram matrix; the state is its lags + 1 coefficients."""

    name: str = "LinearWindow"
    lags: int = 24
    regParam: float = 0.0
    elasticNetParam: float = 0.0
    kind: str = "linear"

    def fit(self, df: DataFrame, spec: SeriesSpec) -> "Fitted":
        return Fitted(self, elastic_net(lag_gram(df, spec, self.lags), self.regParam, self.elasticNetParam))

    def predict(self, state: np.ndarray, df: DataFrame, spec: SeriesSpec) -> DataFrame:
        return predict_lags(df, spec, state, model=self.name)

    def save(self, state: np.ndarray, path: str) -> None:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(i, float(v)) for i, v in enumerate(state)], "i int, v double").coalesce(1).write.mode("overwrite").parquet(f"{path}/beta")

    def load(self, spark: SparkSession, path: str) -> np.ndarray:
        return np.array([r.v for r in spark.read.parquet(f"{path}/beta").orderBy("i").collect()])


@dataclass(frozen=True)
class TreesModel:
    """Pooled gradient-boosted trees on scaled windows; the state is the MLlib model."""

    name: str = "GBTWindow"
    lags: int = 24
    params: dict = field(default_factory=lambda: {"maxDepth": 4, "maxIter": 20})
    kind: str = "trees"

    def fit(self, df: DataFrame, spec: SeriesSpec) -> "Fitted":
        from .regressor import fit_window_regressor, scaled_windows
        windows, _ = scaled_windows(df, spec, self.lags)
        return Fitted(self, fit_window_regressor(windows, "gbt", self.params)[0])

    def predict(self, state, df: DataFrame, spec: SeriesSpec) -> DataFrame:
        from .regressor import predict_windows, scaled_windows
        windows, params = scaled_windows(df, spec, self.lags)
        return predict_windows(state, windows, params, spec, self.name)

    def save(self, state, path: str) -> None:
        state.write().overwrite().save(f"{path}/mllib")

    def load(self, spark: SparkSession, path: str):
        from pyspark.ml.regression import GBTRegressionModel
        return GBTRegressionModel.load(f"{path}/mllib")


KINDS = {c.kind: c for c in (LagModel, ArimaModel, LinearModel, TreesModel)}


@dataclass(frozen=True)
class Fitted:
    model: LagModel | ArimaModel | LinearModel | TreesModel
    state: object

    @property
    def name(self) -> str:
        return self.model.name

    def predict(self, df: DataFrame, spec: SeriesSpec) -> DataFrame:
        return self.model.predict(self.state, df, spec)

    def save(self, path: str) -> None:
        """``path``/config (kind and settings as one JSON line) and the state beside it."""
        self.model.save(self.state, path)
        config = json.dumps(asdict(self.model))
        SparkSession.getActiveSession().createDataFrame([(config,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/config")


def load_model(spark: SparkSession, path: str) -> Fitted:
    config = json.loads(spark.read.text(f"{path}/config").first()[0])
    model = KINDS[config["kind"]](**{k: tuple(v) if isinstance(v, list) else v for k, v in config.items()})
    return Fitted(model, model.load(spark, path))


def default_models(spec: SeriesSpec, lags: int | None = None) -> list:
    """The five forecasters, in report order."""
    return [LagModel("Persistence", 1), LagModel("SeasonalNaive", spec.period), ArimaModel(), LinearModel(lags=lags or spec.period), TreesModel(lags=lags or spec.period)]


def model_rank(name: str = "model"):
    """Position of a model in reports, as a column."""
    out = F.lit(len(MODEL_ORDER))
    for i, m in enumerate(MODEL_ORDER):
        out = F.when(F.col(name) == m, i).otherwise(out)
    return out


@dataclass(frozen=True)
class Run:
    """What a run gives: all predictions as one long table, the log (LOG), and the fitted models by name."""

    predictions: DataFrame
    log: DataFrame
    fitted: dict


def run_forecasters(df: DataFrame, spec: SeriesSpec, models: list | None = None) -> Run:
    """M4: fit every model on the train rows and predict the test rows of all series; ``df`` is written once."""
    from ..session import cut_lineage
    spark = df.sparkSession
    models = default_models(spec) if models is None else models
    if len({m.name for m in models}) < len(models):
        raise ValueError("two models of one name")
    df = cut_lineage(df, "run-input")
    log, fitted, parts = [], {}, []
    for m in models:
        t0 = time.perf_counter()
        fitted[m.name] = m.fit(df, spec)
        t1 = time.perf_counter()
        parts.append(cut_lineage(fitted[m.name].predict(df, spec), f"run-{m.kind}"))
        log.append(("pooled", m.name, t1 - t0 if m.kind != "lag" else 0.0, time.perf_counter() - t1))
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    return Run(preds, spark.createDataFrame(log, LOG), fitted)


def save_bundle(run: Run, run_dir: str, spec: SeriesSpec) -> None:
    """Predictions, metrics, log and every model (with its chosen configuration) under one folder."""
    from ..sources.sinks import save_run
    from .errors import evaluate
    save_run(run_dir, {"predictions": run.predictions, "metrics": evaluate(run.predictions, by=[*spec.keys, "model"]), "log": run.log})
    for name, f in run.fitted.items():
        f.save(f"{run_dir}/models/{name}")


def load_bundle(spark: SparkSession, run_dir: str, names: list[str] | None = None) -> Run:
    """The run as it was saved; ``names`` picks models (default: those in the predictions)."""
    from ..sources.sinks import load_run
    t = load_run(spark, run_dir, ["predictions", "log"])
    names = names or [r.model for r in t["log"].select("model").distinct().collect()]
    return Run(t["predictions"], t["log"], {n: load_model(spark, f"{run_dir}/models/{n}") for n in names})
