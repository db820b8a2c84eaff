"""The offline feature pipeline: scaled numbers and one-hot categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame


def build(numeric: Sequence[str], categorical: Sequence[str], output: str = "features") -> Pipeline:
    """Standardised numbers, then one-hot categories; unknown categories are all zero."""
    indexed = [f"{c}__index" for c in categorical]
    hot = [f"{c}__hot" for c in categorical]
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(numeric), outputCol="__numbers"),
            StandardScaler(inputCol="__numbers", outputCol="__scaled", withMean=True),
            StringIndexer(
                inputCols=list(categorical), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"
            ),
            # the extra index for unknown values is the one that is dropped
            OneHotEncoder(inputCols=indexed, outputCols=hot),
            VectorAssembler(inputCols=["__scaled", *hot], outputCol=output),
        ]
    )


def feature_names(model: PipelineModel, numeric: Sequence[str]) -> list[str]:
    """Names of the output vector's elements."""
    names = list(numeric)
    indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
    for c, labels in zip(indexer.getInputCols(), indexer.labelsArray):
        names += [f"{c}_{v}" for v in labels]
    return names


def transform(model: PipelineModel, df: DataFrame, output: str = "features") -> DataFrame:
    return model.transform(df).select(*df.columns, output)
