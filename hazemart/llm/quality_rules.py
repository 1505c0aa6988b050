"""Document quality by a sparse ensemble of rules over text statistics.

Shallow trees on the statistics give conjunctive rules (every path from a root to a node). A logistic
model with a lasso penalty weights them and leaves most at zero. What remains is compiled into one
Spark column expression, so scoring is a scan without Python.

Fitting reads at most ``SAMPLE_ROWS`` labelled documents, those with the smallest id hashes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazemart.session import settled

SAMPLE_ROWS = 10_000
TREES = 16
DEPTH = 3
PENALTY = 0.003
ACCEPT = 0.7
SEED = 5

Condition = tuple[str, bool, float]  # statistic, whether above the bound, bound


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]  # conjunctions and their weights


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of one text; an empty text has zeros."""
    text = F.coalesce(text, F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1))
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1))
    lines = F.split(text, "\n")
    share = lambda pattern: F.length(F.regexp_replace(text, pattern, "")) / chars  # noqa: E731  of what is not in the pattern
    return {
        "log_words": F.log1p(F.size(words).cast("double")),
        "word_length": F.length(text) / n_words,
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "upper": share(r"[^\p{Lu}]+"),
        "symbols": share(r"[\p{L}\p{N}\s.,;:'\"()-]+"),
        "digits": share(r"[^\p{N}]+"),
        "points": share(r"[^.!?]+"),
        "line_words": F.log1p(F.size(words) / F.greatest(F.size(lines), F.lit(1))),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
    }


def with_statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    return docs.select(*keep, *[c.cast("double").alias(f"_{name}") for name, c in statistics(F.col(text_col)).items()])


def _paths(node, names: list[str], path: tuple[Condition, ...] = ()) -> list[tuple[Condition, ...]]:
    """The conjunctions of all nodes below the root; Java tree nodes of the fitted forest."""
    found = [path] if path else []
    if node.numDescendants() > 0:
        split = node.split()
        name, bound = names[split.featureIndex()], float(split.threshold())
        found += _paths(node.leftChild(), names, (*path, (name, False, bound)))
        found += _paths(node.rightChild(), names, (*path, (name, True, bound)))
    return found


def _tidy(path: tuple[Condition, ...]) -> tuple[Condition, ...]:
    """One bound per statistic and side, in a fixed order."""
    tight: dict[tuple[str, bool], float] = {}
    for name, above, bound in path:
        best = max if above else min
        tight[name, above] = best(tight.get((name, above), bound), bound)
    return tuple((name, above, bound) for (name, above), bound in sorted(tight.items()))


def _holds(rule: tuple[Condition, ...]) -> Column:
    out = None
    for name, above, bound in rule:
        test = F.col(f"_{name}") > bound if above else F.col(f"_{name}") <= bound
        out = test if out is None else out & test
    return F.when(out, 1.0).otherwise(0.0)


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> RuleModel:
    """Rules and weights from the labelled rows that ``keep`` (over the id) admits.

    Without both classes among them there are no rules and the score is the share of label 1, or one half.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (F.lit(True) if keep is None else keep))
    chosen = known.groupBy(id_col).agg(F.max(label_col).cast("double").alias("_label"))
    chosen = chosen.orderBy(F.xxhash64(id_col), id_col).limit(SAMPLE_ROWS)
    # the sample has SAMPLE_ROWS rows at most, so sending it to every task is bounded
    rows = docs.select(id_col, F.col(text_col).alias("_text")).join(F.broadcast(chosen), id_col)
    sample = settled(with_statistics(rows, "_text", (id_col, "_label")), "quality-sample")
    counts = {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()}
    if len(counts) < 2:
        share = next(iter(counts), 0.5)
        return RuleModel(math.log((share + 1e-3) / (1 - share + 1e-3)), ())
    names = list(statistics(F.col(text_col)))
    columns = [f"_{n}" for n in names]
    ordered = VectorAssembler(inputCols=columns, outputCol="_x").transform(sample).select("_x", "_label", id_col)
    forest = RandomForestClassifier(
        featuresCol="_x", labelCol="_label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=5,
        featureSubsetStrategy="onethird",
    ).fit(ordered)
    paths = sorted({_tidy(p) for tree in forest.trees for p in _paths(tree._call_java("rootNode"), names)})
    held = sample.select("_label", *[_holds(p).alias(f"r{k}") for k, p in enumerate(paths)])
    held = VectorAssembler(inputCols=[f"r{k}" for k in range(len(paths))], outputCol="_r").transform(held).select("_r", "_label")
    lasso = LogisticRegression(
        featuresCol="_r", labelCol="_label", elasticNetParam=1.0, regParam=PENALTY, standardization=False, maxIter=60,
    ).fit(settled(held, "quality-rules"))
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), tuple((p, float(w)) for p, w in zip(paths, weights, strict=True) if abs(w) > 1e-6))


def score_column(model: RuleModel) -> Column:
    """The compiled rules: a column over the statistics of ``with_statistics``."""
    total = F.lit(model.intercept)
    for rule, weight in model.rules:
        total = total + _holds(rule) * weight
    return 1.0 / (1.0 + F.exp(-total))


def scored(docs: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score (0 to 1, higher is better) and predicted (1 from ``ACCEPT`` on).

    Null counts as empty text; both are scored by the rules that hold for zeros. Only id and text are
    read, rows are independent, null ids are carried along, an empty table gives no rows. Nothing is
    shuffled and no Python runs.
    """
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = with_statistics(source, "_text", ("_id",)).withColumn("score", score_column(model))
    return found.select(F.col("_id").alias(id_col), "score", F.when(F.col("score") >= ACCEPT, 1).otherwise(0).alias("predicted"))
