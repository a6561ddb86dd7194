"""Rate-per-mile tree models.

A candidate is an ``Encoder`` (ordinal codes of categorical features with unknown -> -1, M1;
exact training medians for missing numerics, because spark.ml trees reject NaN - the missing
flags stay features) and a learner fitted on rate per mile = target / distance (P15).
Predictions are ``max(rpm x distance, 1.0)``, NULL when distance is missing (P16).  Training
runs distributed; the driver only holds the fitted trees and their leaves.

Families: A = boosted trees for absolute error (``AbsoluteBoost``), B = a quantile forest whose
prediction is a median (``QuantileForest``).  ``learn_iterations`` (M4) grows A once on the inner
training window and reads the whole error curve off one staged scoring pass over the inner
validation window: the count with the lowest distance-weighted rpm error (proportional to
dollar MAE), with patience, is frozen.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..once import once
from .encoding import Encoder
from .ensembles import LEARNERS, AbsoluteBoost, Blocks
from .features import categorical_columns
from .lookup import stored_table

# Candidate parameters, the engine's only ones: 15 leaves ~ depth 4, min samples per leaf ->
# minInstancesPerNode.  A boosting round is a full pass of Spark jobs over the rows, so few
# rounds with larger steps replace hundreds with small ones (README, Deviations).
PARAMETERS: dict[str, dict] = {
    "gbt_compact": {"family": K.MODEL_FAMILY_A, "loss": "absolute", "maxIter": 20, "stepSize": 0.3,
                    "maxDepth": 4, "minInstancesPerNode": 30},
    "gbt_smoother": {"family": K.MODEL_FAMILY_A, "loss": "absolute", "maxIter": 25, "stepSize": 0.2,
                     "maxDepth": 4, "minInstancesPerNode": 45},
    "gbt_learned": {"family": K.MODEL_FAMILY_A, "loss": "absolute", "maxIter": 40, "stepSize": 0.3,
                    "maxDepth": 5, "minInstancesPerNode": 1, "patience": 8},
    "forest": {"family": K.MODEL_FAMILY_B, "loss": "quantile_forest", "numTrees": 16, "maxDepth": 8, "minInstancesPerNode": 30},
}
LABEL = "__rpm"
#: Numeric features that are never missing, so need no fill.
_WHOLE = {*K.DATE_FEATURES, "weight_missing", "weight_sign_corrected", "market_index_missing",
          *[c for c in K.ROUTE_FEATURES if c.endswith("_frequency") or c.startswith(("rare_", "unseen_"))]}


@dataclass
class RateModel:
    name: str
    family: str
    params: dict
    features: list[str]
    encoder: Encoder
    learner: object
    feature_set: str = ""
    best_iteration: int | None = None
    extra: dict = field(default_factory=dict)

    @property
    def parameters_text(self) -> str:
        return json.dumps({k: v for k, v in self.params.items() if k != "family"}, sort_keys=True)

    def save(self, path: str, spark=None) -> None:
        """The learner, the encoder's state tables and a one-row metadata table."""
        from pyspark.sql import SparkSession
        spark = spark or SparkSession.getActiveSession()
        self.learner.save(f"{path}/learner", spark)
        if self.encoder.codes is not None:
            self.encoder.codes.write.mode("overwrite").parquet(f"{path}/codes")
        meta = [(self.name, self.family, self.parameters_text, json.dumps(self.features), self.feature_set,
                 self.best_iteration, json.dumps(self.encoder.fills))]
        spark.createDataFrame(meta, "name string, family string, parameters string, features string, feature_set string, "
                                    "best_iteration int, fills string").write.mode("overwrite").parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark, path: str) -> "RateModel":
        r = spark.read.parquet(f"{path}/meta").first()
        params, features = json.loads(r["parameters"]), json.loads(r["features"])
        params["family"] = r["family"]
        codes = spark.read.parquet(f"{path}/codes") if categorical_columns(features) else None
        encoder = Encoder(codes, 0 if codes is None else codes.count(), json.loads(r["fills"]))
        return cls(name=r["name"], family=r["family"], params=params, features=features, encoder=encoder,
                   learner=LEARNERS[params["loss"]].load(f"{path}/learner", spark), feature_set=r["feature_set"],
                   best_iteration=r["best_iteration"])

    def predict(self, feats: DataFrame, out: str = "predicted") -> DataFrame:
        return predict(self, feats, out)


def fit_encoder(train_feats: DataFrame, features: Sequence[str]) -> Encoder:
    """Codes and fills of ``features``; one serves all candidates on subsets of them."""
    cats = categorical_columns(features)
    return Encoder.fit(train_feats, cats, [c for c in features if c not in cats and c not in _WHOLE])


def _check_leakage(features: Sequence[str], target: str) -> None:
    """Id, target and prediction are never features."""
    bad = {K.ID, target, K.PREDICTION} & set(features)
    if bad:
        raise ValueError(f"Forbidden features: {sorted(bad)}")
    if "distance" not in features:
        raise ValueError("distance is required: the model predicts rate per mile")


def _check_candidate(features: Sequence[str], params: dict, target: str) -> None:
    _check_leakage(features, target)
    if params["family"] not in (K.MODEL_FAMILY_A, K.MODEL_FAMILY_B):
        raise ValueError(f"Unsupported model family: {params['family']!r}")


def _labelled(feats: DataFrame, target: str) -> DataFrame:
    rpm = F.try_divide(F.col(target).cast("double"), F.col("distance").cast("double"))
    return feats.withColumn(LABEL, rpm).where(F.col(LABEL).isNotNull())


@dataclass
class Prepared:
    """Training rows as vectors of ``features``, written once: candidates on subsets of the features take theirs from them."""

    features: list[str]
    encoder: Encoder
    rows: DataFrame  # __x, LABEL
    target: str
    seed: int

    @once
    def blocks(self) -> Blocks:
        return Blocks.of(self.rows, LABEL, self.seed)

    def places(self, features: Sequence[str]) -> list[int]:
        return [self.features.index(c) for c in features]

    def vectors(self, features: Sequence[str]) -> DataFrame:
        """``(__x, LABEL)`` of some of the features."""
        if list(features) == self.features:
            return self.rows
        slicer = VectorSlicer(inputCol="__all", outputCol="__x", indices=self.places(features))
        return slicer.transform(self.rows.withColumnRenamed("__x", "__all")).select("__x", LABEL)


def prepare(train_feats: DataFrame, features: Sequence[str], target: str = K.TARGET, seed: int = K.RANDOM_SEED,
            encoder: Encoder | None = None) -> Prepared:
    features = list(features)
    _check_leakage(features, target)
    encoder = encoder or fit_encoder(train_feats, features)
    rows = encoder.vectors(_labelled(train_feats, target), features, categorical_columns(features)).select("__x", LABEL)
    return Prepared(features, encoder, stored_table(rows, "model_vectors")[0], target, seed)


def fit(train_feats: DataFrame, features: Sequence[str], params: dict, name: str = "model",
        target: str = K.TARGET, feature_set: str = "", seed: int = K.RANDOM_SEED, encoder: Encoder | None = None) -> RateModel:
    """M5/M6: fit a candidate on rate per mile of the training rows."""
    features = list(features)
    _check_candidate(features, params, target)
    encoder = encoder or fit_encoder(train_feats, features)
    data = encoder.vectors(_labelled(train_feats, target), features, categorical_columns(features)).select("__x", LABEL)
    learner = LEARNERS[params["loss"]].fit(data, LABEL, params, seed)
    return RateModel(name=name, family=params["family"], params=dict(params), features=features, encoder=encoder,
                     learner=learner, feature_set=feature_set)


def fit_prepared(prepared: Prepared, candidates: Sequence[tuple[str, str, Sequence[str], dict]]) -> list[RateModel]:
    """M5/M6: the candidates ``(name, feature set, features, parameters)`` on the same rows; the boosted ones for absolute
    error with the default bins grow side by side."""
    for _, _, features, params in candidates:
        _check_candidate(features, params, prepared.target)
    beside = [i for i, (_, _, _, params) in enumerate(candidates) if params["loss"] == "absolute" and "maxBins" not in params]
    learners = {}
    if beside:
        asked = [(prepared.places(candidates[i][2]), candidates[i][3]) for i in beside]
        learners = dict(zip(beside, AbsoluteBoost.fit_many(prepared.blocks, asked)))
    for i, (_, _, features, params) in enumerate(candidates):
        if i not in learners:
            learners[i] = LEARNERS[params["loss"]].fit(prepared.vectors(features), LABEL, params, prepared.seed)
    return [RateModel(name=name, family=params["family"], params=dict(params), features=list(features), encoder=prepared.encoder,
                      learner=learners[i], feature_set=feature_set) for i, (name, feature_set, features, params) in enumerate(candidates)]


def predict(model: RateModel, feats: DataFrame, out: str = "predicted") -> DataFrame:
    """max(rpm_hat x distance, 1.0); NULL distance -> NULL prediction."""
    scored = model.learner.score(model.encoder.vectors(feats, model.features, categorical_columns(model.features)), "__rpm_hat")
    rate = F.col("__rpm_hat") * F.col("distance")
    return scored.select(*feats.columns, F.when(rate.isNotNull(), F.greatest(rate, F.lit(1.0))).alias(out))


def staged_errors(model: RateModel, valid_feats: DataFrame, target: str = K.TARGET) -> DataFrame:
    """``(iteration, error)``: distance-weighted absolute rpm error after each round, from one scoring pass."""
    rows = model.encoder.vectors(_labelled(valid_feats, target), model.features, categorical_columns(model.features))
    staged = model.learner.staged(rows, "__all").select(LABEL, F.col("distance").cast("double").alias("w"), F.posexplode("__all").alias("at", "hat"))
    error = F.sum(F.abs(F.col("hat") - F.col(LABEL)) * F.col("w")) / F.sum("w")
    return staged.groupBy((F.col("at") + 1).alias("iteration")).agg(error.alias("error"))


def best_of_curve(curve: Sequence[float], patience: int) -> int:
    """Iterations (from 1) with the least error before ``patience`` rounds went by without a lower one."""
    best, best_i = float("inf"), 0
    for i, err in enumerate(curve):
        if err < best:
            best, best_i = err, i
        elif i - best_i >= patience:
            break
    return best_i + 1


def learn_iterations(train_feats: DataFrame, valid_feats: DataFrame, features: Sequence[str], params: dict,
                     target: str = K.TARGET, seed: int = K.RANDOM_SEED, encoder: Encoder | None = None) -> tuple[int, list[float]]:
    """M4: best iteration count of the boosted family on the inner window, and the error curve."""
    _check_learning(train_feats, valid_feats, params)
    m = fit(train_feats, features, params, "iterations", target, seed=seed, encoder=encoder)
    return _best_iteration(m, valid_feats, target, int(params.get("patience", 60)))


def learn_prepared(prepared: Prepared, train_feats: DataFrame, valid_feats: DataFrame,
                   wanted: Sequence[tuple[Sequence[str], dict]]) -> list[int]:
    """M4 for several ``(features, parameters)`` on the prepared rows of ``train_feats``, grown side by side."""
    for _, params in wanted:
        _check_learning(train_feats, valid_feats, params)
    grown = fit_prepared(prepared, [("iterations", "", features, params) for features, params in wanted])
    return [_best_iteration(m, valid_feats, prepared.target, int(params.get("patience", 60)))[0] for m, (_, params) in zip(grown, wanted)]


def _check_learning(train_feats: DataFrame, valid_feats: DataFrame, params: dict) -> None:
    if params["family"] != K.MODEL_FAMILY_A:
        raise ValueError("iteration learning needs the boosted family")
    if train_feats.dtypes != valid_feats.dtypes:                       # C25: names, order and types
        raise ValueError("iteration-learning train and validation schemas differ")


def _best_iteration(m: RateModel, valid_feats: DataFrame, target: str, patience: int) -> tuple[int, list[float]]:
    curve = [r["error"] for r in sorted(staged_errors(m, valid_feats, target).collect(), key=lambda r: r["iteration"])]  # a row a round
    return best_of_curve(curve, patience), curve
