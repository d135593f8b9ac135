"""Fitted models kept by name and version, with the features they were fitted on.

A version is a folder: the model, and a card (features in their order, span of the training rows, kind) that is put in
place last, so a version without a card doesn't count. Scoring loads the newest version or a named one, and refuses rows
whose features aren't those of the card, in the same order: a swapped column would score without any error.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files
from .boosting import Boosted


@dataclass(frozen=True)
class Card:
    name: str
    version: int
    kind: str
    features: list[str]
    trained_from: str | None
    trained_to: str | None
    rows: int


def _folder(path: str, name: str, version: int) -> str:
    return f"{path.rstrip('/')}/{name}/version={version:05d}"


def cards(spark: SparkSession, path: str, name: str) -> list[Card]:
    """Cards of the versions of a model that are whole, oldest first."""
    found = sorted(files.matching(spark, f"{path.rstrip('/')}/{name}/version=*/card.json"))
    return [Card(**json.loads(files.get_text(spark, f) or "{}")) for f in found]


def save(path: str, name: str, model: PipelineModel | Boosted, features: list[str], training: DataFrame, day: str = "date") -> Card:
    """Keep a model as the next version; ``training`` are the rows it was fitted on."""
    spark = training.sparkSession
    # A folder without a card is a save that stopped; its number isn't given again.
    taken = [int(f.rpartition("=")[2]) for f in files.matching(spark, f"{path.rstrip('/')}/{name}/version=*")]
    version = max(taken, default=0) + 1
    where = _folder(path, name, version)
    if isinstance(model, Boosted):
        files.put_text(spark, f"{where}/model.json", model.to_json())
    else:
        model.write().save(f"{where}/model")
    span = training.agg(F.min(day).cast("string"), F.max(day).cast("string"), F.count("*")).first()
    card = Card(name, version, "boosted" if isinstance(model, Boosted) else "pipeline", list(features), *span)
    files.put_text(spark, f"{where}/card.json", json.dumps(card.__dict__))
    return card


def load(spark: SparkSession, path: str, name: str, features: list[str], version: int | None = None) -> tuple[PipelineModel | Boosted, Card]:
    """The newest version, or the one asked for, if it was fitted on exactly these features."""
    known = [c for c in cards(spark, path, name) if version in (None, c.version)]
    if not known:
        raise LookupError(f"no version of {name} in {path}" if version is None else f"no version {version} of {name} in {path}")
    card = known[-1]
    if card.features != list(features):
        wrong = next(((a, b) for a, b in zip(card.features, features) if a != b), (len(card.features), len(features)))
        raise ValueError(f"{name} {card.version} was fitted on other features: {wrong[0]} where {wrong[1]} is given")
    where = _folder(path, name, card.version)
    if card.kind == "boosted":
        return Boosted.from_json(files.get_text(spark, f"{where}/model.json") or ""), card
    return PipelineModel.load(f"{where}/model"), card
