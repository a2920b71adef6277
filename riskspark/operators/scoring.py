"""Tree ensembles compiled to column expressions, and the map from log odds to a score card.

Missing values are filled with FILL before the trees see them, so they take the side that FILL compares to; a tree's own
default direction applies only to columns that were left unfilled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import FILL
from ..sources.model_text import Node, TreeModel

#: Trees for each projection, which bounds the code generated for one.
TREES_PER_SELECT = 50


@dataclass(frozen=True)
class ScoreCard:
    """shift - slope * ln(p / (1 - p)), p as a 32-bit float; invalid where p is not inside (0, 1) or all variables are missing."""

    shift: float = 533.903595
    slope: float = 72.134752
    digits: int = 2
    invalid: float = FILL


def tree_column(node: Node, features: list[str]) -> Column:
    if node.feature is None:
        return F.lit(node.value)
    x = F.col(features[node.feature])
    same = x.isin(*map(float, node.categories)) if node.categorical else x <= F.lit(node.threshold)
    # a null goes left where the default says so; for categories the default is turned round
    left = (x.isNull() | same) if node.default_left != node.categorical else same
    return F.when(left, tree_column(node.left, features)).otherwise(tree_column(node.right, features))


def tree_sql(node: Node, features: list[str]) -> str:
    """The same as SQL text."""
    if node.feature is None:
        return f"CAST('{node.value!r}' AS DOUBLE)"
    name = features[node.feature]
    test = f"{name} IN ({', '.join(map(str, node.categories)) or 'NULL'})" if node.categorical else f"{name} <= CAST('{node.threshold!r}' AS DOUBLE)"
    if node.default_left != node.categorical:
        test = f"({name} IS NULL OR {test})"
    return f"CASE WHEN {test} THEN {tree_sql(node.left, features)} ELSE {tree_sql(node.right, features)} END"


def tree_scores(df: DataFrame, model: TreeModel) -> DataFrame:
    """df with the model's features filled and tree_<i>_score for each tree; a few trees for each projection.

    Names meet without regard to case, as in SQL; a filled feature has the model's spelling.
    """
    used = sorted(model.used(), key=model.features.index)
    there = {c.lower() for c in df.columns}
    absent = [f for f in used if f.lower() not in there]
    if absent:
        raise ValueError(f"features not in the input: {absent}")
    x = df.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(FILL)) for f in used}) if used else df
    for i in range(0, len(model.trees), TREES_PER_SELECT):
        own = enumerate(model.trees[i : i + TREES_PER_SELECT], i)
        x = x.withColumns({f"tree_{k}_score": tree_column(t, model.features) for k, t in own})
    return x


def score_card(probability: Column, all_null: Column, card: ScoreCard = ScoreCard()) -> Column:
    p = probability.cast("float")
    inside = (p > F.lit(0.0).cast("float")) & (p < F.lit(1.0).cast("float")) & (all_null != 1)
    # the odds keep single precision, as the probability does
    odds = p / (F.lit(1).cast("float") - p)
    return F.round(F.when(inside, F.lit(card.shift) - F.lit(card.slope) * F.ln(odds.cast("double"))).otherwise(F.lit(card.invalid)), card.digits)


def score(
    df: DataFrame, model: TreeModel, keep: list[str], card: ScoreCard = ScoreCard(), extra: list[str] | None = None, output_variables: bool = False,
    top: int = 0, by_importance: bool = True,
) -> DataFrame:
    """keep, extra, variables (on request, the `top` most important), score, all_null_flag and score_card of every row.

    Models of several classes, or of another objective than a probability, are refused.
    """
    steep = model.steepness()
    there = {c.lower() for c in df.columns}
    valid = [f for f in model.valid_features() if f.lower() in there] or sorted(model.used(), key=model.features.index)
    shown = []
    if output_variables:
        shown = [f for f, g in model.ranked() if g > 0] if by_importance else list(valid)
        shown = shown[:top] if top > 0 else shown
    x = tree_scores(df, model)
    raw = None
    for i in range(len(model.trees)):
        raw = F.col(f"tree_{i}_score") if raw is None else raw + F.col(f"tree_{i}_score")
    raw = F.lit(0.0) if raw is None else raw
    fills = [F.col(f) for f in valid]
    empty = (F.least(*fills) == FILL) & (F.greatest(*fills) == FILL) if len(fills) > 1 else fills[0] == FILL if fills else F.lit(False)
    columns = list(dict.fromkeys([*keep, *(extra or []), *shown]))
    x = x.withColumns({"score": 1 / (1 + F.exp(-raw if steep == 1 else raw * F.lit(-steep))), "all_null_flag": F.when(empty, 1).otherwise(0)})
    return x.select(*columns, "score", "all_null_flag", score_card(F.col("score"), F.col("all_null_flag"), card).alias("score_card"))


def full_sql(model: TreeModel, table: str, keep: list[str], card: ScoreCard = ScoreCard()) -> str:
    """score() as one SQL text over a table, for other engines and for review."""
    valid = model.valid_features()
    used = sorted(model.used() | set(valid), key=model.features.index)
    filled = ", ".join(f"coalesce(CAST({f} AS DOUBLE), CAST('{FILL!r}' AS DOUBLE)) AS {f}" for f in used)
    steep = model.steepness()
    trees = " + ".join(f"({tree_sql(t, model.features)})" for t in model.trees) or "0"
    trees = trees if steep == 1 else f"({trees}) * CAST('{steep!r}' AS DOUBLE)"
    empty = " AND ".join(f"{f} = CAST('{FILL!r}' AS DOUBLE)" for f in valid) or "FALSE"
    names = ", ".join(keep)
    return (
        f"SELECT {names}, score, all_null_flag, round(CASE WHEN all_null_flag = 1 OR CAST(score AS FLOAT) <= 0 OR CAST(score AS FLOAT) >= 1 THEN {card.invalid!r} "
        f"ELSE {card.shift!r} - {card.slope!r} * ln(CAST(CAST(score AS FLOAT) / (CAST(1 AS FLOAT) - CAST(score AS FLOAT)) AS DOUBLE)) END, {card.digits}) AS score_card FROM ("
        f"SELECT {names}, 1 / (1 + exp(-({trees}))) AS score, CASE WHEN {empty} THEN 1 ELSE 0 END AS all_null_flag FROM ("
        f"SELECT {names}, {filled} FROM {table}) f) s"
    )
