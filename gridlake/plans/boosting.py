"""Multiclass boosting on DataFrames: softmax gradients, binned features, one symmetric tree a round.

A tree has one split (feature, bin) for each level, shared by all nodes of it, and a value for each class in each leaf.
To choose a level's split, rows add up their gradients by (node, feature, bin) in one aggregate that is combined before it
is shuffled; at most ``2 ** depth * features * bins`` sums reach the driver, never a row. A round's trees aren't written
into the plan as code but as one array that rows fold over, so every round runs the same compiled plan.

Rows of a validation block take no part in sums; the model ends at the round after which their log loss stays worse for
``patience`` rounds.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written

TREES = "array<struct<feature: array<int>, bin: array<int>, value: array<array<double>>>>"
C = F.col


@dataclass
class Boosted:
    """``edges[f]`` are the bin edges of a feature; a row's bin is the number of edges below its value."""

    features: list[str]
    classes: list[str]
    edges: list[list[float]]
    start: list[float]
    trees: list[dict] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Boosted:
        return cls(**json.loads(text))


def bin_edges(rows: DataFrame, features: list[str], bins: int = 32, accuracy: int = 10_000) -> list[list[float]]:
    """Quantiles of each feature, without those that repeat; one pass for all features."""
    at = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(f, at, accuracy).alias(f"q{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(q)) if q else [] for q in found]


def binned(model: Boosted) -> Column:
    """The bins of a row's features, in their order."""
    edges = F.from_json(F.lit(json.dumps(model.edges)), "array<array<double>>")
    values = F.array(*[C(f).cast("double") for f in model.features])
    return F.zip_with(values, edges, lambda v, own: F.size(F.filter(own, lambda e: e < v)))


def _leaf(bins: Column, feature: Column, bin_: Column, depth: int) -> Column:
    out = F.lit(0)
    for level in range(depth):
        here = F.get(bins, F.get(feature, F.lit(level))) > F.get(bin_, F.lit(level))
        out = out + F.when(here, F.lit(1 << level)).otherwise(0)
    return out


def scores(bins: Column, model: Boosted, depth: int) -> Column:
    """The sum of all trees' values, one for each class."""
    start = F.from_json(F.lit(json.dumps(model.start)), "array<double>")
    trees = F.from_json(F.lit(json.dumps(model.trees)), TREES)
    return F.aggregate(trees, start, lambda acc, t: F.zip_with(acc, F.get(t["value"], _leaf(bins, t["feature"], t["bin"], depth)), lambda a, b: a + b))


def softmax(raw: Column) -> Column:
    lifted = F.transform(raw, lambda x: F.exp(x - F.array_max(raw)))
    return F.transform(lifted, lambda x: x / F.aggregate(lifted, F.lit(0.0), lambda a, b: a + b))


def _split(sums: dict, nodes: int, sizes: list[int], k: int, smooth: float) -> tuple[float, int, int] | None:
    """The (feature, bin) with the greatest gain over all nodes and classes; ties go to the first."""
    best = None
    for f, size in enumerate(sizes):
        left = [[0.0] * (2 * k) for _ in range(nodes)]
        whole = [[sum(sums.get((n, f, b), [0.0] * (2 * k))[i] for b in range(size)) for i in range(2 * k)] for n in range(nodes)]
        for b in range(size - 1):
            gain = 0.0
            for n in range(nodes):
                for i, x in enumerate(sums.get((n, f, b), ())):
                    left[n][i] += x
                for c in range(k):
                    g, h, every_g, every_h = left[n][c], left[n][k + c], whole[n][c], whole[n][k + c]
                    gain += g * g / (h + smooth) + (every_g - g) ** 2 / (every_h - h + smooth) - every_g * every_g / (every_h + smooth)
            if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                best = (gain, f, b)
    return best


def fit(rows: DataFrame, features: list[str], classes: list[str], label: str, weight: str | None = None, valid: Column | None = None, rounds: int = 30, depth: int = 3, rate: float = 0.3, smooth: float = 1.0, bins: int = 32, patience: int = 5) -> Boosted:
    """Boost on the rows that aren't ``valid``; rows of other labels than ``classes`` are left out."""
    k, held = len(classes), F.lit(False) if valid is None else F.coalesce(valid, F.lit(False))
    known = rows.where(C(label).isin(classes)).withColumn("_valid", held)
    learned = known.where(~C("_valid"))
    model = Boosted(features, classes, bin_edges(learned, features, bins), [0.0] * k)
    own = F.coalesce(C(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    number = F.array_position(F.array(*map(F.lit, classes)), C(label)).cast("int") - 1
    table = written(known.select(binned(model).alias("bins"), number.alias("y"), own.alias("w"), "_valid"))
    share = {r["y"]: r["w"] for r in table.where(~C("_valid")).groupBy("y").agg(F.sum("w").alias("w")).collect()}
    total = sum(share.values())
    model.start = [math.log(max(share.get(c, 0.0) / total, 1e-6)) if total else 0.0 for c in range(k)]
    sizes = [len(e) + 1 for e in model.edges]
    for _ in range(rounds):
        p = table.withColumn("p", softmax(scores(C("bins"), model, depth)))
        slope = p.where(~C("_valid")).select("bins", *[(C("w") * (F.get("p", F.lit(c)) - (C("y") == c).cast("double"))).alias(f"s{c}") for c in range(k)], *[(C("w") * F.get("p", F.lit(c)) * (1 - F.get("p", F.lit(c)))).alias(f"s{k + c}") for c in range(k)])
        tree: dict = {"feature": [], "bin": [], "value": []}
        for level in range(depth):
            placed = slope.withColumn("node", _leaf(C("bins"), *[F.array(*map(F.lit, tree[x])).cast("array<int>") for x in ("feature", "bin")], level))
            each = placed.select("node", F.posexplode("bins").alias("f", "b"), *[f"s{i}" for i in range(2 * k)])
            sums = {(r[0], r[1], r[2]): list(r[3:]) for r in each.groupBy("node", "f", "b").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(2 * k)]).collect()}
            best = _split(sums, 1 << level, sizes, k, smooth)
            if best is None:
                break
            tree["feature"].append(best[1])
            tree["bin"].append(best[2])
        found = len(tree["feature"])
        if not found:
            break
        # The last sums by any feature add up to nodes; where the last level was split, to both sides of it.
        leaves = [[0.0] * (2 * k) for _ in range(1 << found)]
        for (node, f, b), values in sums.items():
            if f == tree["feature"][-1]:
                slot = node if best is None else node | (b > tree["bin"][-1]) << (found - 1)
                leaves[slot] = [x + y for x, y in zip(leaves[slot], values, strict=True)]
        tree["value"] = [[-rate * v[c] / (v[k + c] + smooth) for c in range(k)] for v in leaves]
        # Levels that weren't needed never turn right: no bin is beyond the last.
        tree["feature"] += [0] * (depth - found)
        tree["bin"] += [1 << 30] * (depth - found)
        model.trees.append(tree)
        if valid is not None:
            after = softmax(scores(C("bins"), model, depth))
            loss = table.where("_valid").agg(F.avg(-F.log(F.greatest(F.get(after, C("y")), F.lit(1e-12)))).alias("loss")).first()[0]
            model.losses.append(loss if loss is not None else 0.0)
            best_round = model.losses.index(min(model.losses))
            if len(model.losses) - 1 - best_round >= patience:
                break
    if model.losses:
        model.trees = model.trees[: model.losses.index(min(model.losses)) + 1]
    return model


def score(rows: DataFrame, model: Boosted, probabilities: list[str], predicted: str) -> DataFrame:
    """Rows with a probability for each class and the likeliest one (the first of those that tie)."""
    depth = len(model.trees[0]["feature"]) if model.trees else 0
    told = rows.withColumn("_p", softmax(scores(binned(model), model, depth)))
    named = F.get(F.array(*map(F.lit, model.classes)), (F.array_position("_p", F.array_max("_p")) - 1).cast("int"))
    return told.withColumns({**{n: F.get("_p", F.lit(i)) for i, n in enumerate(probabilities)}, predicted: named}).drop("_p")
