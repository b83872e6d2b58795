"""Text quality by a sparse rule ensemble.

Statistics of a text are column expressions.  A forest of shallow trees is
fitted to labelled rows; every path from a root to a node becomes a rule, a
conjunction of conditions on statistics.  A logistic regression with lasso
penalty over the rules keeps few of them, and the score is compiled into one
column expression over the statistics.

Defined results: null is scored like the empty text, whose shares are all 0;
without labels of both classes no rule exists and the score is the share of
label 1 (0.5 without labels); repeated rows are scored alike; extra columns are
passed through, columns named like a result are replaced.

Scale: fitting reads at most ``max_labelled`` labelled rows (those with the
smallest hash of their id); scoring is one pass of built-in expressions.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import common

Condition = tuple[str, bool, float]  # statistic, True for "at most", bound


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; the first ones are counts that the others divide."""
    t = F.coalesce(text, F.lit(""))
    return {"n_chars": F.length(t).cast("double"),
            "n_letters": F.length(F.regexp_replace(t, r"[^\p{L}]+", "")).cast("double"),
            "n_upper": F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("double"),
            "n_symbols": F.length(F.regexp_replace(t, r"[\p{L}\p{N}\s.,;:'\"?-]+", "")).cast("double"),
            "n_digits": F.length(F.regexp_replace(t, r"[^0-9]+", "")).cast("double"),
            "words": F.filter(F.split(t, r"\s+"), lambda w: w != ""),
            "lines": F.filter(F.split(t, "\n"), lambda x: x != "")}


def _share(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def features(s: dict[str, Column]) -> dict[str, Column]:
    """What the rules test, from the columns of ``statistics``."""
    n_words = F.size(s["words"]).cast("double")
    n_lines = F.size(s["lines"]).cast("double")
    same = F.size(F.filter(F.zip_with(s["words"], F.slice(s["words"], 2, F.greatest(F.size(s["words"]), F.lit(1))), lambda a, b: a == b), lambda x: x))
    return {"log_chars": F.log1p(s["n_chars"]),
            "letter_share": _share(s["n_letters"], s["n_chars"]),
            "upper_share": _share(s["n_upper"], s["n_letters"]),
            "symbol_share": _share(s["n_symbols"], s["n_chars"]),
            "digit_share": _share(s["n_digits"], s["n_chars"]),
            "word_length": _share(s["n_letters"], n_words),
            "distinct_words": _share(F.size(F.array_distinct(s["words"])).cast("double"), F.sqrt(n_words)),
            "distinct_lines": _share(F.size(F.array_distinct(s["lines"])).cast("double"), n_lines),
            "line_length": F.log1p(_share(s["n_chars"], n_lines)),
            "repeated_next": _share(same.cast("double"), n_words),
            "short_words": _share(F.size(F.filter(s["words"], lambda w: F.length(w) <= 2)).cast("double"), n_words)}


FEATURES = ("log_chars", "letter_share", "upper_share", "symbol_share", "digit_share", "word_length", "distinct_words",
            "distinct_lines", "line_length", "repeated_next", "short_words")


def with_features(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with the struct ``__quality`` of all features; each statistic is evaluated once."""
    step = docs.withColumn("__stats", F.struct(*[c.alias(n) for n, c in statistics(common.quoted(text_col)).items()]))
    parts = features({n: F.col(f"__stats.{n}") for n in ("n_chars", "n_letters", "n_upper", "n_symbols", "n_digits", "words", "lines")})
    return step.withColumn("__quality", F.struct(*[parts[n].alias(n) for n in FEATURES])).drop("__stats")


@dataclass
class Model:
    """Rules with their weights."""

    intercept: float = 0.0
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def score(self, values: Column) -> Column:
        total = reduce(lambda a, r: a + F.when(holds(r[0], values), r[1]).otherwise(0.0), self.rules, F.lit(self.intercept))
        return 1.0 / (1.0 + F.exp(-total))


def holds(rule: tuple[Condition, ...], values: Column) -> Column:
    """A rule as a boolean expression."""
    return reduce(lambda a, b: a & b, [values[n] <= bound if at_most else values[n] > bound for n, at_most, bound in rule])


def paths(debug: str) -> list[tuple[Condition, ...]]:
    """All rules of a forest, from its printed form: the conditions from a root to each node below it, simplified."""
    out: dict[tuple[Condition, ...], None] = {}
    stack: list[tuple[int, Condition]] = []
    for line in debug.splitlines():
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+.0-9Ee]+)\)", line)
        if not m:
            if line.strip().startswith("Tree"):
                stack = []
            continue
        depth = len(m[1])
        stack = [s for s in stack if s[0] < depth] + [(depth, (FEATURES[int(m[2])], m[3] == "<=", float(m[4])))]
        tight: dict[tuple[str, bool], float] = {}
        for _, (name, at_most, bound) in stack:
            known = tight.get((name, at_most), bound)
            tight[name, at_most] = min(known, bound) if at_most else max(known, bound)
        out[tuple(sorted((n, a, b) for (n, a), b in tight.items()))] = None
    return list(out)


def learnable(labels: DataFrame, id_col: str, label_col: str, max_labelled: int) -> DataFrame:
    """At most ``max_labelled`` labelled ids outside the held-out fold, the same on any cluster."""
    rows = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
            .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~common.held_out("id"))
            .groupBy("id").agg(F.max("y").alias("y")))
    return rows.orderBy(F.xxhash64("id"), "id").limit(max_labelled)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_labelled: int = 20_000, trees: int = 20, depth: int = 3, penalty: float = 0.001) -> Model:
    """Fit the rules to at most ``max_labelled`` labelled documents outside the held-out fold."""
    ids = F.broadcast(learnable(labels, id_col, label_col, max_labelled))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(ids, "id")
    rows = common.shared(with_features(sample, "text").select(
        F.col("y").cast("double").alias("label"), F.array(*[F.col(f"__quality.{n}") for n in FEATURES]).alias("x"), "__quality"))
    size = {int(r["label"]): r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    if not n0 or not n1:
        share = n1 / (n0 + n1) if n0 + n1 else 0.5
        return Model(math.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    rows = rows.withColumn("weight", F.when(F.col("label") == 0, (n0 + n1) / (2.0 * n0)).otherwise((n0 + n1) / (2.0 * n1)))
    forest = RandomForestClassifier(featuresCol="v", weightCol="weight", numTrees=trees, maxDepth=depth, maxBins=32,
                                    featureSubsetStrategy="onethird", subsamplingRate=0.8, seed=7).fit(
        rows.select("label", "weight", array_to_vector("x").alias("v")))
    rules = paths(forest.toDebugString)
    if not rules:
        return Model(math.log(n1 / n0))
    tested = rows.select("label", array_to_vector(F.array(*[holds(r, F.col("__quality")).cast("double") for r in rules])).alias("v"))
    fit = LogisticRegression(featuresCol="v", regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=60, tol=1e-5).fit(
        common.shared(tested))
    weights = [float(w) for w in fit.coefficients.toArray()]
    return Model(float(fit.intercept), [(r, w) for r, w in zip(rules, weights) if abs(w) > 1e-6])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``quality_score``, the probability of label 1."""
    docs = common.without(docs, "quality_score", "__quality", "__stats")
    return with_features(docs, text_col).withColumn("quality_score", model.score(F.col("__quality"))).drop("__quality")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document of ``documents``."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, common.table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", common.held_out().alias("held_out"), F.col("quality_score").alias("score"),
                                     (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
