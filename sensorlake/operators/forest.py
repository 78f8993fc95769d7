"""Scores of fitted forests as one Spark expression (M4).

A forest is an array of trees, a tree a struct of arrays over its nodes in
pre-order: the left child of a node is the next one, ``right`` names the other.
Higher-order functions walk every tree from its root, at most ``depth`` steps:
no Python worker, and one expression whatever the number of trees.  The forest
enters it as JSON, which the optimizer folds into one constant.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from .boosting import Forest

TREE = (
    "struct<feature: array<int>, cut: array<double>, missing_left: array<boolean>, "
    "left_set: array<array<bigint>>, right: array<int>, value: array<double>, depth: int>"
)
#: A node's feature: the category, or none (a leaf).
CATEGORY, LEAF = -1, -2


def literal(forest: Forest) -> Column:
    """A forest's trees as a constant."""
    return F.from_json(F.lit(json.dumps(forest.trees, separators=(",", ":"))), f"array<{TREE}>")


def score(trees: Column, init: Column, features: Column, category: Column) -> Column:
    """``init`` plus the values of the leaves that a row reaches.
    ``features``: array of doubles, null where missing; a category that no
    split names goes right."""

    def step(tree: Column, node: Column) -> Column:
        feature = tree["feature"][node]
        value = features[feature]
        left = (
            F.when(feature == CATEGORY, F.coalesce(F.array_contains(tree["left_set"][node], category), F.lit(False)))
            .when(value.isNull(), tree["missing_left"][node])
            .otherwise(value <= tree["cut"][node])
        )
        return F.when(feature == LEAF, node).when(left, node + 1).otherwise(tree["right"][node])

    def leaf(tree: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), tree["depth"]), F.lit(0), lambda node, _: step(tree, node))

    return F.aggregate(trees, init, lambda total, tree: total + tree["value"][leaf(tree)])


def scored(forest: Forest, features: Column, category: Column) -> Column:
    """The score of a row by a fitted forest."""
    return score(literal(forest), F.lit(float(forest.init)), features, category)
