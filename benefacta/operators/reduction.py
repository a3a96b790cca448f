"""Principal components."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from .clustering import FEATURES, scaling_stages, without_vectors
from .scaling import fit_moments

# Names of the three scores.
SCORE_NAMES = ("DV-Fuga", "Edad-Cuotas", "Canales_Donacion")


def pca_scores(df: DataFrame, columns: list[str], names: tuple[str, ...] = SCORE_NAMES) -> DataFrame:
    """Scores of the leading components of the standardised columns.

    The sign of a component is free; it is chosen so that its largest loading is positive.
    """
    complete = df.dropna(subset=columns)
    stages = scaling_stages(fit_moments(complete, columns))
    vectors = PipelineModel(stages=stages).transform(complete)
    model = PCA(k=len(names), inputCol=FEATURES, outputCol="_pc").fit(vectors)
    loadings = model.pc.toArray()
    signs = [1.0 if column[abs(column).argmax()] >= 0 else -1.0 for column in loadings.T]
    scores = model.transform(vectors).withColumn("_pc", vector_to_array("_pc"))
    scores = scores.withColumns({n: F.col("_pc")[i] * signs[i] for i, n in enumerate(names)})
    return without_vectors(scores, columns).drop("_pc")
