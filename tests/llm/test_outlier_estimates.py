"""Robust estimates against a plain numpy MCD, and their weights against group sizes."""

import os
import random
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from remitview.llm import mcd_outliers as mcd
from remitview.llm.common import table

D = len(mcd.DIMENSIONS)
FLOORS = np.diag([f**2 for f in mcd.DIMENSIONS.values()])
BROAD = np.diag([f**2 for f in mcd.BROAD.values()])


def plain_mcd(x, steps=200):
    """Concentration from two starts until nothing changes, over whole matrices."""
    cut = mcd.chi2_quantile(mcd.SUBSET, D)
    scale = mcd.SUBSET / mcd.chi2_cdf(cut, D + 2)
    centre = np.median(x, axis=0)
    spread = 1.4826 * np.median(np.abs(x - centre), axis=0)
    best = None
    for m, c in ((centre, np.diag(spread**2)), (x.mean(0), np.cov(x.T, bias=True))):
        for _ in range(steps):
            d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c + FLOORS), x - m)
            near = x[d2 <= np.quantile(d2, mcd.SUBSET)]
            new = near.mean(0), scale * np.cov(near.T, bias=True)
            done = np.allclose(new[0], m) and np.allclose(new[1], c)
            m, c = new
            if done:
                break
        det = np.linalg.slogdet(c + FLOORS)[1]
        if best is None or det < best[0] - 1e-9:
            best = det, m, c
    return best


def matrix(row):
    c = np.zeros((D, D))
    for i in range(D):
        for j in range(i + 1):
            c[i, j] = c[j, i] = row[f"c{i}_{j}"]
    return np.array([row[f"m{i}"] for i in range(D)]), c


def test_estimates_are_the_numpy_mcd(spark):
    r = np.random.default_rng(1)
    groups = {}
    for k, n in (("a", 4000), ("b", 900)):  # a tenth of each lies far off
        shape = r.normal(0, 1, (D, D))
        x = r.normal(0, 1, (n, D)) @ shape + r.normal(0, 3, D)
        x[: n // 10] += 15
        groups[k] = x
    rows = [(k, int(i % mcd.SALTS), *map(float, v)) for k, x in groups.items() for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "key string, salt int, " + ", ".join(f"x{i} double" for i in range(D)))
    for row in mcd.estimates(vectors).collect():
        m, c = matrix(row)
        det, plain_m, plain_c = plain_mcd(groups[row["key"]])
        assert np.allclose(m, plain_m, atol=0.03 * np.sqrt(np.diag(plain_c)).max())
        assert np.allclose(c, plain_c, atol=0.03 * np.abs(plain_c).max())
        assert abs(np.linalg.slogdet(c + FLOORS)[1] - det) < 0.02
        clean = groups[row["key"]][len(groups[row["key"]]) // 10 :]
        assert np.abs(m - clean.mean(0)).max() < 1  # the far tenth doesn't move it


def test_groups_weigh_by_their_rows_without_a_switch(spark):
    """A group's centre goes from its language's to its own as it grows, by n / (n + PRIOR)."""
    schema = "key string, parent string, n long, " + ", ".join([*(f"m{i} double" for i in range(D)), *(f"c{i}_{j} double" for i in range(D) for j in range(i + 1))])
    r = np.random.default_rng(2)

    def estimate(key, parent, n):
        half = r.normal(0, 1, (D, D))
        m, c = r.normal(0, 1, D), half @ half.T
        return (key, parent, n, *map(float, m), *(float(c[i, j]) for i in range(D) for j in range(i + 1))), m, c

    root, root_m, root_c = estimate("all", "all", 10_000)
    w = 10_000 / (10_000 + mcd.PRIOR)
    wide = mcd._drawn(spark.createDataFrame([root], schema), None)
    wide_m, wide_c = matrix(wide.first())
    assert np.allclose(wide_m, root_m) and np.allclose(wide_c, w * root_c + (1 - w) * BROAD)
    made = [estimate(f"g{n}", "all", n) for n in (1, 2, 50, 99, 100, 101, 5000)]
    found = {x["key"]: matrix(x) for x in mcd._drawn(spark.createDataFrame([x[0] for x in made], schema), wide).collect()}
    for (key, _, n, *_), m, c in made:
        w, gap = n / (n + mcd.PRIOR), m - wide_m
        assert np.allclose(found[key][0], w * m + (1 - w) * wide_m)
        assert np.allclose(found[key][1], w * c + (1 - w) * wide_c + w * (1 - w) * np.outer(gap, gap))


def prose(r, n):
    return " ".join(r.choice("the of and tion er ing house river stone letter green seven north wander quickly".split()) + str(r.randrange(40)) for _ in range(n))


def test_verdicts_by_group_with_awkward_rows(spark):
    r = random.Random(8)
    rows = [(i, prose(r, r.randrange(50, 200)), "en", "s") for i in range(300)]
    long_words = lambda n: " ".join("".join(r.choices("abcdefgh", k=150)) for _ in range(n))
    rows += [(1000 + i, long_words(r.randrange(50, 200)), "fi", "s") for i in range(300)]  # usual there
    rows += [(2000, long_words(100), "en", "s"), (2001, "### $$$ " * 3 + "# ".join(prose(r, 60).split()), "en", "s")]  # not here
    rows += [(3000 + i, prose(r, 80), None, None) for i in range(150)] + [(3500, prose(r, 90), "en", None), (3501, prose(r, 90), "de", "t")]
    rows += [rows[0]] * 40 + [(None, rows[1][1], "en", "s"), (4000, None, "en", "s"), (4001, "", None, "s")]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, lang string, source string, key int, salt int")
    found = mcd.outliers(df).collect()
    assert len(found) == len(rows)
    gone = {x.id for x in found if not x.kept}
    assert gone == {2000, 2001, 4000, 4001}
    assert all((x.distance is None) == x.base_failed for x in found)
    assert mcd.outliers(df.limit(0)).count() == 0


def test_no_good_labelled_document_is_beyond_the_cut(spark):
    sf = "/root/testdata/sf0.1"
    found = mcd.outliers(table(spark, sf, "documents")).where("not base_failed").join(table(spark, sf, "labels").withColumnRenamed("doc_id", "id"), "id")
    by = {(x.quality, x.kept): x["count"] for x in found.groupBy("quality", "kept").count().collect()}
    assert by.get((1, False), 0) <= 0.001 * by[1, True] and by[0, False] > 200


def test_estimates_are_few_files_at_any_number_of_partitions(spark, monkeypatch):
    """Estimates that fill a file for each shuffle partition are too large, by their footers, to be sent to the
    documents, which are then shuffled in every step instead."""
    written, kept = [], mcd.materialise

    def noted(df, name):
        out = kept(df, name)
        written.append((name, len(out.inputFiles())))
        return out

    monkeypatch.setattr(mcd, "materialise", noted)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {x: spark.conf.get(x) for x in names}
    rows = [(i, " ".join(f"w{i * j % 97}" for j in range(20 + i % 9)), "en", f"s{i % 30}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    try:
        for x, value in zip(names, ("40", "false"), strict=True):
            spark.conf.set(x, value)
        assert mcd.outliers(docs).count() == 300
    finally:
        for x, value in before.items():
            spark.conf.set(x, value)
    files = {name: n for name, n in written if name not in ("mcd-counts", "mcd-vectors")}
    assert {"mcd-start", "mcd-step", "mcd-estimates", "mcd-drawn"} == set(files) and max(files.values()) <= mcd.LEAST_FILES, files
