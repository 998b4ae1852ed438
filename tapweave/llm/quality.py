"""Quality scores from a sparse rule ensemble.

Numeric statistics of a text are Spark column expressions. A forest of shallow
trees is grown on them, every path from a root to a node is a conjunctive rule,
a logistic regression with a lasso penalty weighs the rules and keeps few of
them (rule ensembles: Friedman and Popescu, 2008), and the kept rules are
compiled into one column expression. Scoring therefore runs no Python and needs
no model object on the executors.

Defined results: a null text counts as empty, an empty text has statistics of 0
and gets a score like any other; very long texts are read whole; repeated rows
get equal scores; an empty table gives no rows. Null labels and labels without
a document are not used; of several labels of one document the largest counts.
If the labels hold one class only, or none, the score is the smoothed share of
label 1.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapweave.llm.common import text_or_empty


@dataclass(frozen=True)
class RuleParams:
    """``max_rows`` bounds the sample of labelled rows that trees and weights are fitted on."""

    max_rows: int = 20_000
    trees: int = 24
    depth: int = 3
    lasso: float = 0.0015
    seed: int = 7


@dataclass(frozen=True)
class Rule:
    """All conditions (statistic, above?, threshold) hold; then ``weight`` is added to the logit."""

    conditions: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self) -> Column:
        met = F.lit(True)
        for name, above, threshold in self.conditions:
            met = met & ((F.col(name) > threshold) if above else (F.col(name) <= threshold))
        return met


@dataclass(frozen=True)
class QualityModel:
    rules: tuple[Rule, ...]
    bias: float
    constant: float | None = None  # the score where there was nothing to learn from

    def column(self) -> Column:
        """The score as an expression over the statistics."""
        if self.constant is not None:
            return F.lit(self.constant)
        logit = F.lit(self.bias)
        for rule in self.rules:
            logit = logit + F.when(rule.column(), rule.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-logit))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))


def statistics() -> dict[str, Column]:
    """Expressions over the columns ``__text``, ``__words`` and ``__lines``; all are finite."""
    text, words, lines = F.col("__text"), F.col("__words"), F.col("__lines")
    chars, n_words, n_lines = F.length(text), F.size(words), F.size(lines)

    def of_class(chars_in: str) -> Column:
        return chars - F.length(F.regexp_replace(text, f"[{chars_in}]+", ""))

    return {
        "log_chars": F.log1p(chars.cast("double")),
        "log_words": F.log1p(n_words.cast("double")),
        "word_length": _share(chars, n_words),
        "distinct_words": _share(F.size(F.array_distinct(words)), n_words),
        "capitals": _share(of_class("\\p{Lu}"), chars),
        "digits": _share(of_class("0-9"), chars),
        "stops": _share(of_class(".,;:?"), chars),
        "shouts": _share(of_class("!"), chars),
        "bars": _share(of_class("|"), chars),
        "symbols": _share(of_class("#$%&*<>=@^~{}\\[\\]\\\\_/+"), chars),
        "log_lines": F.log1p(n_lines.cast("double")),
        "line_length": _share(chars, n_lines),
        "distinct_lines": _share(F.size(F.array_distinct(lines)), n_lines),
        "short_words": _share(F.size(F.filter(words, lambda w: F.length(w) <= 3)), n_words),
        "long_words": _share(F.size(F.filter(words, lambda w: F.length(w) >= 16)), n_words),
    }


STATISTICS = tuple(
    "log_chars log_words word_length distinct_words capitals digits stops shouts bars symbols log_lines line_length "
    "distinct_lines short_words long_words".split()
)


def with_statistics(docs: DataFrame) -> DataFrame:
    """Add the statistics of the whole text."""
    cut = docs.withColumn("__text", text_or_empty())
    cut = cut.withColumns(
        {
            "__words": F.filter(F.split("__text", "[ \t\n\r]+"), lambda w: w != ""),
            "__lines": F.filter(F.split("__text", "\n"), lambda w: w != ""),
        }
    )
    return cut.withColumns(statistics()).drop("__text", "__words", "__lines")


def tree_paths(printed: str, names: tuple[str, ...]) -> list[Rule]:
    """Rules of a forest from the library's printed form: one for each node below a root."""
    line_of = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")
    found: dict[tuple, None] = {}
    path: list[tuple[int, tuple[str, bool, float]]] = []
    for line in printed.splitlines():
        m = line_of.match(line)
        if not m:
            if "Tree" in line:
                path = []
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, (names[int(m[3])], m[4] == ">", float(m[5]))))
        found[tuple(sorted(c for _, c in path))] = None
    return [Rule(conditions) for conditions in found]


def fit(stats: DataFrame, labels: DataFrame, learn: Column, params: RuleParams = RuleParams(), label: str = "quality"):
    """Fit on at most ``max_rows`` labelled documents, in the order of a hash of their ids.

    ``stats`` has doc_id and the statistics; it is read several times, so pass
    a written table.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("double")).alias("label"))
    rows = stats.select("doc_id", *STATISTICS).join(known, "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), *STATISTICS).limit(params.max_rows).drop("doc_id").cache()
    try:
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("ones")).first()
        if not 0 < seen["ones"] < seen["n"]:
            return QualityModel((), 0.0, (seen["ones"] + 1) / (seen["n"] + 2))
        put = VectorAssembler(inputCols=list(STATISTICS), outputCol="features")
        forest = RandomForestClassifier(
            numTrees=params.trees, maxDepth=params.depth, subsamplingRate=0.5, featureSubsetStrategy="onethird",
            seed=params.seed, labelCol="label",
        ).fit(put.transform(rows).select("features", "label"))
        rules = tree_paths(forest.toDebugString, STATISTICS)
        marks = [r.column().cast("double").alias(f"r{i}") for i, r in enumerate(rules)]
        marked = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(
            rows.select("label", *marks)
        )
        lasso = LogisticRegression(
            labelCol="label", regParam=params.lasso, elasticNetParam=1.0, maxIter=60, standardization=False
        ).fit(marked.select("features", "label"))
        weights = lasso.coefficients.toArray()
        kept = tuple(Rule(r.conditions, float(w)) for r, w in zip(rules, weights) if w != 0)
        return QualityModel(kept, float(lasso.intercept))
    finally:
        rows.unpersist()


def with_score(stats: DataFrame, model: QualityModel) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (score >= 0.5) to rows that have the statistics."""
    scored = stats.withColumn("score", model.column())
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
