"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Paths of small trees become rules, a lasso logistic fit weights them, and the rules with a weight
become one Spark column expression. Training reads a bounded sample of labelled rows; scoring is a
single pass without shuffle or Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitview.llm.common import WHITESPACE, materialise

#: Labelled rows that the classifier is fitted on at most (about; drawn by the hash of their id).
TRAIN_ROWS = 20_000
TREES, TREE_DEPTH, SEED = 16, 3, 7
#: Lasso strength, and the least share of training rows on either side of a rule.
LASSO, MIN_SUPPORT = 0.0005, 0.002


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` with statistics of each whole text (null counts as empty), and their names."""
    taken = {c.lower() for c in docs.columns}
    name = lambda x: x if x not in taken else name(f"{x}_")
    text, words, lines = name("__text"), name("__words"), name("__lines")
    out = (
        docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit("")))
        .withColumn(words, F.filter(F.split(text, WHITESPACE), lambda x: x != ""))
        .withColumn(lines, F.filter(F.split(text, "\n"), lambda x: x != ""))
    )
    chars, n, m = F.length(text), F.size(words), F.size(lines)
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0).cast("double")
    without = lambda pattern: chars - F.length(F.regexp_replace(text, pattern, ""))
    stats = {
        "n_words": F.log1p(n),
        "word_length": share(F.length(F.regexp_replace(text, WHITESPACE, "")), n),
        "letters": share(without(r"\p{L}+"), chars),
        "capitals": share(without(r"\p{Lu}+"), chars),
        "digits": share(without(r"\p{N}+"), chars),
        "symbols": share(without(r"[#*$%&|<>{}\[\]=_~^\\@/+]+"), chars),
        "stops": share(without(r"[.!?]+"), chars),
        "commas": share(without(r"[,;:]+"), chars),
        "distinct_words": share(F.size(F.array_distinct(words)), n),
        "root_words": share(F.size(F.array_distinct(words)), F.sqrt(n)),
        "distinct_lines": share(F.size(F.array_distinct(lines)), m),
        "line_words": F.log1p(share(n, m)),
    }
    names = {k: name(f"__stat_{k}") for k in stats}
    return out.withColumns({names[k]: v for k, v in stats.items()}).drop(text, words, lines), list(names.values())


@dataclass(frozen=True)
class RuleEnsemble:
    """``bias`` plus the weight of every rule that holds is the logit of label 1. A rule is a tuple
    of (statistic's index, threshold, above); it holds if every statistic is above its threshold
    (or, where above is false, at or below it)."""

    bias: float
    rules: tuple[tuple[float, tuple[tuple[int, float, bool], ...]], ...]

    def score(self, stats: list[str]) -> Column:
        logit = F.lit(float(self.bias))
        for weight, rule in self.rules:
            logit = logit + F.when(condition(rule, stats), float(weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def condition(rule: tuple[tuple[int, float, bool], ...], stats: list[str]) -> Column:
    parts = [F.col(stats[i]) > t if above else F.col(stats[i]) <= t for i, t, above in rule]
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def tree_rules(tree) -> set[tuple[tuple[int, float, bool], ...]]:
    """The path from the root to every other node of a fitted tree, without bounds that a later one on the path tightens."""
    found, stack = set(), [(tree._java_obj.rootNode(), ())]
    while stack:
        node, path = stack.pop()
        if path:
            tight = {}
            for i, t, above in path:
                old = tight.get((i, above))
                tight[(i, above)] = t if old is None else (max if above else min)(old, t)
            found.add(tuple(sorted((i, t, above) for (i, above), t in tight.items())))
        if node.getClass().getSimpleName() == "InternalNode":
            i, t = node.split().featureIndex(), node.split().threshold()
            stack += [(node.leftChild(), (*path, (i, t, False))), (node.rightChild(), (*path, (i, t, True)))]
    return found


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", rows: int = TRAIN_ROWS) -> RuleEnsemble:
    """Fit on the rows of ``docs`` that ``labels`` marks 0 or 1.

    All labelled rows are counted; if there are over ``rows``, a share is drawn by the hash of the
    id. Ids that are null, unlabelled or labelled both ways don't teach; every row of a labelled id
    does, repeated rows too. With labels of one class, or none (an empty table, say), the ensemble has
    no rules and scores the (smoothed) share of label 1. The same rows give the same ensemble in any
    partitioning.
    """
    own = labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("__label")).where("__id is not null and __label in (0, 1)")
    own = own.groupBy("__id").agg(F.min("__label").alias("__label"), F.max("__label").alias("__other")).where("__label = __other").drop("__other")
    n, ones = own.agg(F.count("*"), F.coalesce(F.sum("__label"), F.lit(0))).first()
    prior = (ones + 1) / (n + 2)
    plain = RuleEnsemble(math.log(prior / (1 - prior)), ())
    if not n or ones in (0, n):
        return plain
    own = own.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, rows / n)))
    # the drawn labels are bounded by ``rows``, so they may be broadcast
    train = docs.select(F.col(id_col).cast("long").alias("__id"), "text").join(F.broadcast(own), "__id")
    stats_rows, stats = statistics(train)
    table = materialise(stats_rows.select("__id", F.col("__label").cast("double").alias("label"), *stats), "quality-train")
    # bagging and sums follow the order of rows: at most about ``rows`` of them, in one partition and in
    # one order, give one model however the table is laid out
    table = table.repartition(1).sortWithinPartitions("__id", *stats).withColumn("features", array_to_vector(F.array(*stats))).cache()
    try:
        if table.select("label").distinct().count() < 2:
            return plain
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=TREE_DEPTH, seed=SEED, subsamplingRate=0.7, featureSubsetStrategy="onethird", minInstancesPerNode=5)
        rules = sorted(set().union(*map(tree_rules, forest.fit(table).trees)))
        held = [condition(r, stats).cast("double") for r in rules]
        support = table.select(*(F.avg(h).alias(f"r{i}") for i, h in enumerate(held))).first()
        kept = [i for i in range(len(rules)) if MIN_SUPPORT <= support[i] <= 1 - MIN_SUPPORT]
        if not kept:
            return plain
        design = table.select("label", array_to_vector(F.array(*(held[i] for i in kept))).alias("features")).cache()
        model = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=60, standardization=False).fit(design)
        design.unpersist()
        weights = [(float(w), rules[i]) for w, i in zip(model.coefficients.toArray(), kept, strict=True) if w]
        return RuleEnsemble(float(model.intercept), tuple(weights))
    finally:
        table.unpersist()


def score(docs: DataFrame, model: RuleEnsemble, into: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the ensemble's probability of label 1 in column ``into``. Every row gets one:
    null and empty texts by the statistics of an empty text, repeated rows the same score. An empty
    table gives an empty result."""
    rows, stats = statistics(docs, text_col)
    return rows.withColumn(into, model.score(stats)).drop(*stats)
