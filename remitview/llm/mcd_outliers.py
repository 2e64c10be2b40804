"""Robust multivariate outliers: minimum-covariance-determinant estimates of transformed text
statistics for each language and source, and a cut by Mahalanobis distance.

Built-in expressions, grouped aggregates and joins only. The estimates come from concentration
steps, each one grouped aggregate over a narrow table of statistics; the step's quantile is exact
over distances rounded to a fixed grid, so an aggregation buffer holds at most one entry for each
grid value, however many rows a group has.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitview.llm.common import WHITESPACE, let, materialise

SYMBOLS = "#*$%&|<>"
#: Share of a group that an estimate is concentrated on, concentration steps at most, and the change of
#: log determinant at which an estimate has settled.
SUBSET, STEPS, SETTLED = 0.75, 10, 1e-3
#: Rows that the wider group's estimate counts for beside a group's own: of ``n`` rows, a group takes
#: ``n / (n + PRIOR)`` of its own estimate, the rest from its language's, which is drawn to that of all
#: documents in the same way, and that one to the spread ``BROAD``.
PRIOR = 50
#: Parts that each group's rows are dealt to where they meet their estimate: a hot group is no one task's.
SALTS = 32
#: Files that the estimates of a step are written to: so many, and one more for so many groups.
LEAST_FILES, GROUPS_PER_FILE = 4, 4096
#: Tail probability of a normal document beyond the cut, which is at a distance of 7.1. Of 10,000
#: documents with 5,000 quality labels the farthest good one is at 7.0, and all labelled ones beyond 7.1 are bad.
TAIL = 1e-9
#: The transformed statistics, with the least standard deviation that an estimate takes for each
#: (most documents have no symbol and no repeat at all, which would make any estimate singular).
DIMENSIONS = {"size": 0.5, "word_length": 0.25, "symbols": 0.25, "dup_lines": 0.1, "repeats": 0.1}
#: Standard deviations taken of documents in general.
BROAD = {"size": 2.0, "word_length": 0.5, "symbols": 0.5, "dup_lines": 0.25, "repeats": 0.25}
_D = len(DIMENSIONS)
_X = [f"x{i}" for i in range(_D)]
_PAIRS = [(i, j) for i in range(_D) for j in range(i + 1)]


def words(text: Column) -> Column:
    return F.filter(F.split(text, WHITESPACE), lambda x: x != "")


def _covered(hashes: Column, window: int) -> Column:
    """Positions covered by windows whose hash stands twice or more in ``hashes``, one per start."""
    at = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def marked(p: Column) -> Column:
        n = F.size(p)
        same = F.zip_with(F.slice(p, 1, n - 1), F.slice(p, 2, n - 1), lambda a, b: a["h"] == b["h"])
        either = F.zip_with(F.concat(same, F.array(F.lit(False))), F.concat(F.array(F.lit(False)), same), lambda a, b: a | b)
        starts = F.sort_array(F.transform(F.filter(F.arrays_zip(p.alias("p"), either.alias("e")), lambda x: x["e"]), lambda x: x["p"]["i"]))
        return let(starts, lambda s: F.aggregate(F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.least(F.lit(window), F.coalesce(b - a, F.lit(window)))), F.lit(0), lambda t, x: t + x))

    return let(at, marked)


def repeated_words(w: Column, window: int = 5) -> Column:
    """Words of ``w`` in windows of ``window`` words that are found twice or more in it. Windows are
    compared by 64-bit hashes of their words."""

    def of_words(v: Column) -> Column:
        n = F.size(v)
        hashes = F.transform(F.sequence(F.lit(1), n - (window - 1)), lambda i: F.xxhash64(F.slice(v, i, window)))
        repeats = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h, window)))
        return F.when(n < window, F.lit(0)).otherwise(repeats)

    return let(w, of_words)


def base_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``id``, the group columns as ``g0..`` and the counts of every whole text; null counts as empty."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        *(F.col(c).cast("string").alias(f"g{i}") for i, c in enumerate(group_cols)),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(
        "id",
        *(f"g{i}" for i in range(len(group_cols))),
        F.length("text").alias("n_chars"),
        let(words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        F.length(F.regexp_replace("text", WHITESPACE, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.size(lines).alias("n_lines"),
    ).select("id", *(f"g{i}" for i in range(len(group_cols))), "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words", "n_chars", "n_lines")


def transformed() -> list[Column]:
    """The vector of a document, from its counts."""
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return [
        F.log1p("n_words").alias("x0"),
        F.log1p(share("word_chars", "n_words")).alias("x1"),
        F.log1p(100 * share("n_symbols", "n_chars")).alias("x2"),
        F.sqrt(share("n_dup_lines", "n_lines")).alias("x3"),
        F.sqrt(share("n_repeat_words", "n_words")).alias("x4"),
    ]


def chi2_cdf(x: float, k: int) -> float:
    """Distribution function of chi-squared with ``k`` degrees, by its series."""
    if x <= 0:
        return 0.0
    a, h = k / 2, x / 2
    term = total = 1 / a
    for n in range(1, 2000):
        term *= h / (a + n)
        total += term
        if term < total * 1e-16:
            break
    return min(1.0, total * math.exp(a * math.log(h) - h - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    lo, hi = 0.0, 1.0
    while chi2_cdf(hi, k) < p and hi < 1e4:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < p else (lo, mid)
    return hi


def _distance(prefix: str = "") -> Column:
    """Squared Mahalanobis distance from a parameter row: centre ``m*`` and inverse Cholesky factor ``w*_*``."""
    parts = [sum((F.col(f"w{i}_{j}") * (F.col(_X[j]) - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0)) for i in range(_D)]
    return sum((p * p for p in parts), F.lit(0.0))


def _grid(d2: Column) -> Column:
    return F.round(F.log1p(d2), 3)


def _meet(rows: DataFrame, params: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """``rows`` (with ``salt``) joined with the parameters of their keys, each group in ``SALTS`` parts."""
    return rows.join(params.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*keys, "salt"], how)


_M, _C, _W = [f"m{i}" for i in range(_D)], [f"c{i}_{j}" for i, j in _PAIRS], [f"w{i}_{j}" for i, j in _PAIRS]


def _moments(rows: DataFrame, scale: float) -> DataFrame:
    """Centre ``m*`` and covariance ``c*_*`` of each (key, start) of ``rows``; ``scale`` makes up for the
    covariance of a central subset being too small."""
    sums = [F.avg(x).alias(m) for x, m in zip(_X, _M, strict=True)]
    return rows.groupBy("key", "start").agg(*sums, *((F.covar_pop(_X[i], _X[j]) * scale).alias(f"c{i}_{j}") for i, j in _PAIRS))


def _factored(moments: DataFrame) -> DataFrame:
    """``moments`` with the inverse Cholesky factor ``w*_*`` and log determinant of the covariance,
    the floors of ``DIMENSIONS`` added to its diagonal."""
    floors, n = list(DIMENSIONS.values()), moments
    for i in range(_D):  # Cholesky: c = l l'
        for j in range(i + 1):
            rest = F.col(f"c{i}_{j}") + (floors[i] ** 2 if i == j else 0.0) - sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
            n = n.withColumn(f"l{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}_{j}"))
    for j in range(_D):  # w l = 1
        for i in range(j, _D):
            rest = sum((F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)), F.lit(0.0))
            n = n.withColumn(f"w{i}_{j}", (F.lit(1.0) if i == j else -rest) / F.col(f"l{i}_{i}"))
    logdet = sum((2 * F.log(f"l{i}_{i}") for i in range(_D)), F.lit(0.0))
    return n.select(*moments.columns, *_W, logdet.alias("logdet"))


def _few_files(params: DataFrame, groups: int, name: str) -> DataFrame:
    """``params``, one row or two for each of so many groups, written to a few files: one for each shuffle
    partition would be mostly footers, and by their size Spark would shuffle all documents to join them."""
    return materialise(params.coalesce(LEAST_FILES + groups // GROUPS_PER_FILE), name)


def estimates(vectors: DataFrame, groups: int | None = None) -> DataFrame:
    """MCD estimate (``m*``, ``c*_*``) of each ``key`` of ``vectors(key, salt, x0..)``.

    Two starts are concentrated: medians with median deviations, and plain moments. Every step keeps
    the ``SUBSET`` of each key that is nearest by the last estimate and estimates anew, until no log
    determinant changes by more than ``SETTLED`` or ``STEPS`` are done; the start whose covariance has
    the smaller determinant wins (a tie: the medians). ``groups`` is the number of keys, if known.
    """
    groups = vectors.select("key").distinct().count() if groups is None else groups
    cut = chi2_quantile(SUBSET, _D)
    scale = SUBSET / chi2_cdf(cut, _D + 2)
    centre = vectors.groupBy("key").agg(*(F.percentile(F.round(x, 3), 0.5).alias(m) for x, m in zip(_X, _M, strict=True)))
    spread = _meet(vectors, centre, "key").groupBy("key").agg(*(F.percentile(F.round(F.abs(F.col(x) - F.col(f"m{i}")), 3), 0.5).alias(f"s{i}") for i, x in enumerate(_X)))
    medians = centre.join(spread, "key").select("key", F.lit(0).alias("start"), *_M, *(((F.col(f"s{i}") * 1.4826) ** 2 if i == j else F.lit(0.0)).alias(f"c{i}_{j}") for i, j in _PAIRS))
    params = _few_files(_factored(medians.unionByName(_moments(vectors.withColumn("start", F.lit(1)), 1.0))), groups, "mcd-start")
    for _ in range(STEPS):
        near = _meet(vectors, params, "key").select("key", "start", "salt", *_X, _grid(_distance()).alias("d"))
        limit = near.groupBy("key", "start").agg(F.percentile("d", SUBSET).alias("limit"))
        last, params = params, _few_files(_factored(_moments(_meet(near, limit, "key", "start").where("d <= limit"), scale)), groups, "mcd-step")
        moved = params.join(last.select("key", "start", F.col("logdet").alias("last")), ["key", "start"])
        if moved.where(F.abs(F.col("logdet") - F.col("last")) > SETTLED).isEmpty():
            break
    best = params.groupBy("key").agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    return params.join(best, ["key", "start"]).select("key", *_M, *_C)


def _drawn(own: DataFrame, wider: DataFrame | None) -> DataFrame:
    """Estimates ``own(key, parent, n, m*, c*_*)`` drawn to ``wider(key, m*, c*_*)`` of their parents, or to
    ``BROAD`` around their own centres: the moments of a mixture by weight."""
    w = F.col("n") / (F.col("n") + PRIOR)
    if wider is None:
        broad = list(BROAD.values())
        both = own.select("*", *(F.col(m).alias(f"p{m}") for m in _M), *(F.lit(broad[i] ** 2 if i == j else 0.0).alias(f"pc{i}_{j}") for i, j in _PAIRS))
    else:
        both = own.join(wider.select(F.col("key").alias("parent"), *(F.col(x).alias(f"p{x}") for x in [*_M, *_C])), "parent")
    gap = [F.col(m) - F.col(f"p{m}") for m in _M]
    return both.select(
        "key",
        *((w * F.col(m) + (1 - w) * F.col(f"p{m}")).alias(m) for m in _M),
        *((w * F.col(f"c{i}_{j}") + (1 - w) * F.col(f"pc{i}_{j}") + w * (1 - w) * gap[i] * gap[j]).alias(f"c{i}_{j}") for i, j in _PAIRS),
    )


def base_failed() -> Column:
    return F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")


def outliers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source"), tail: float = TAIL) -> DataFrame:
    """Every row's counts, ``base_failed``, ``distance`` (squared Mahalanobis) and ``kept``.

    ``base_failed`` rows (under 10 words, or over 20 % of the words in repeats) don't enter the
    estimates, get no distance and are not kept. Another row is rejected if its distance from its
    group's estimate is beyond the chi-squared quantile of ``1 - tail``. Null group values form
    groups of their own. Every group, however small, has its own estimate, which takes a weight that
    grows with its rows beside its first group column's (language) and that of all rows; no number of
    rows switches the rule. Null texts count as empty. Repeated rows and null ids come back as they
    came; an empty table gives an empty result.
    """
    keys = [f"g{i}" for i in range(len(group_cols))]
    counts = base_statistics(docs, id_col, text_col, group_cols).withColumn("base_failed", base_failed())
    counts = materialise(counts, "mcd-counts")
    named = [F.coalesce(F.concat(F.lit("="), k), F.lit("-")) for k in keys]
    key = [F.concat_ws("\x1f", F.lit(str(n)), *named[:n]) for n in range(len(keys) + 1)]
    rows = counts.select("*", key[-1].alias("key"), F.pmod(F.xxhash64("id", "n_words", "word_chars"), F.lit(SALTS)).cast("int").alias("salt"), *transformed())
    fit = rows.where("not base_failed").select("salt", *_X, *(k.alias(f"key{n}") for n, k in enumerate(key)))
    each = [fit.select(F.col(f"key{n}").alias("key"), F.col(f"key{max(n - 1, 0)}").alias("parent"), F.lit(n).alias("level"), "salt", *_X) for n in range(len(key))]
    vectors = materialise(functools.reduce(DataFrame.unionByName, each), "mcd-vectors")
    sizes = vectors.groupBy("key", "parent", "level").agg(F.count("*").alias("n"))
    groups = sizes.count()
    found = _few_files(estimates(vectors, groups).join(sizes, "key"), groups, "mcd-estimates")
    drawn = None
    for n in range(len(key)):
        drawn = _drawn(found.where(F.col("level") == n), drawn)
    params = _few_files(_factored(drawn.withColumn("start", F.lit(0))).drop("start", *_C), groups, "mcd-drawn")
    judged = _meet(rows, params, "key", how="left").withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    limit = chi2_quantile(1 - tail, _D)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))
    return judged.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance")


def base_sql() -> str:
    """The counts and ``base_failed`` of ``documents`` in DuckDB."""
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
    WITH split AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}') AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines
        FROM documents),
    windows AS (SELECT r, p, words[p : p + 4] AS w FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS p FROM split)),
    repeated AS (SELECT r, unnest(list(p)) AS p FROM windows GROUP BY r, w HAVING count(*) > 1),
    covered AS (SELECT r, count(DISTINCT p + i) AS n FROM repeated, range(5) AS five(i) GROUP BY r),
    counts AS (
        SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
               (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
        FROM split LEFT JOIN covered USING (r))
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
    """
