"""Champion artefacts (K5, Q1): an encoder, a classifier and a threshold, stored in a folder that all machines read.

Parameters that are numbers and arrays go to one JSON row, MLlib models to folders of their own.
"""

from __future__ import annotations

import dataclasses
import json

import numpy as np
from pyspark.ml.util import DefaultParamsReader, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators import latent, models, training

# Parts that a champion may be made of, by the name they are stored under.
PARTS = {c.__name__: c for c in (latent.Encoder, latent.Layer, models.OvrTrees, training.Network, training.FocalLogistic,
                                 models.LrModel, models.GmmClassifier, models.SubspaceClassifier, models.Champion)}


def save_champion(spark: SparkSession, champion: models.Champion, path: str) -> None:
    """Write the champion to a new folder."""
    stored = 0

    def plain(x):
        nonlocal stored
        if isinstance(x, MLWritable):
            x.write().save(f"{path}/model-{stored}")
            stored += 1
            return {"mllib": stored - 1}
        if dataclasses.is_dataclass(x):
            return {"part": type(x).__name__, "fields": {f.name: plain(getattr(x, f.name)) for f in dataclasses.fields(x)}}
        if isinstance(x, np.ndarray):
            return {"array": x.tolist()}
        if isinstance(x, dict):
            return {"pairs": [[plain(k), plain(v)] for k, v in x.items()]}
        if isinstance(x, (list, tuple)):
            return [plain(v) for v in x]
        return x.item() if isinstance(x, np.generic) else x

    text = json.dumps(plain(champion))
    spark.createDataFrame([(text,)], "value string").write.text(f"{path}/parts")


def load_champion(spark: SparkSession, path: str) -> models.Champion:
    def made(x):
        if isinstance(x, list):
            return [made(v) for v in x]
        if not isinstance(x, dict):
            return x
        if "mllib" in x:
            return DefaultParamsReader.loadParamsInstance(f"{path}/model-{x['mllib']}", spark.sparkContext)
        if "array" in x:
            return np.array(x["array"])
        if "pairs" in x:
            return {made(k): made(v) for k, v in x["pairs"]}
        return PARTS[x["part"]](**{k: made(v) for k, v in x["fields"].items()})

    return made(json.loads(spark.read.text(f"{path}/parts").first()[0]))


def champion_of(registry: DataFrame, name: str, alias: str = "champion") -> models.Champion:
    """Load what the registry names by ``name@alias``."""
    from strataflow.operators.registry import resolve_champion
    row = resolve_champion(registry, name, alias).select(F.col("path")).first()
    if row is None:
        raise LookupError(f"no version of {name} has the alias {alias}")
    return load_champion(registry.sparkSession, row["path"])
