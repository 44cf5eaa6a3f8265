"""Model artefacts.

A trained model is one ``PipelineModel``: the fitted preparation stages followed by the
fitted estimator, written to a shared path and read back with the class-level loaders.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import GaussianMixtureModel, KMeansModel
from pyspark.ml.feature import (
    PCAModel,
    OneHotEncoderModel,
    StandardScalerModel,
    StringIndexerModel,
    VectorAssembler,
)

from rarebird.operators.wide import WideAssemblerModel


def save_model(model, path: str) -> None:
    """Write a model or pipeline, replacing what is at ``path``."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    """S9."""
    return PipelineModel.load(path)


def join_stages(preparation: PipelineModel, *fitted) -> PipelineModel:
    """Fitted preparation stages + fitted estimator (and what comes between) -> one scoring pipeline."""
    return PipelineModel([*preparation.stages, *fitted])


_ROLES = (
    (StringIndexerModel, "indexer"),
    (OneHotEncoderModel, "encoder"),
    (VectorAssembler, "assembler"),
    (WideAssemblerModel, "assembler"),
    (StandardScalerModel, "scaler"),
    (PCAModel, "pca"),
    (GaussianMixtureModel, "model"),
    (KMeansModel, "model"),
)


def stage_models(pipeline: PipelineModel) -> dict[str, object]:
    """The fitted stages of a scoring pipeline by role (indexer, encoder, assembler, scaler,
    pca, model, and the centring after a wide PCA)."""
    out: dict[str, object] = {}
    for stage in pipeline.stages:
        for cls, role in _ROLES:
            if isinstance(stage, cls):
                out["centring" if role == "scaler" and "pca" in out else role] = stage
                break
    return out


def load_models(
    model_path: str,
    scaler_path: str | None = None,
    pca_path: str | None = None,
    family: str = "mixture",
) -> tuple:
    """Load separately saved models with the class-level loaders (nothing is fitted).

    Returns ``(model, scaler[, pca])`` like the separate artefacts were saved.
    """
    model_cls = GaussianMixtureModel if family == "mixture" else KMeansModel
    model = model_cls.load(model_path)
    scaler = StandardScalerModel.load(scaler_path) if scaler_path else None
    if pca_path:
        return model, scaler, PCAModel.load(pca_path)
    return model, scaler
