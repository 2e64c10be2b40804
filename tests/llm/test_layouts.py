"""Results that must not follow the tables' layout, and stages that must not repeat work."""

import os
import random
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from remitview.llm import packing, quality_rules
from remitview.llm import queries as q
from remitview.llm.common import table
from tests.test_plans import formatted

SF = "/root/testdata/sf0.01"


def test_classifier_is_the_same_on_any_layout(spark):
    docs, labels = table(spark, SF, "documents"), q.training_labels(table(spark, SF, "labels"))
    first = quality_rules.fit(docs, labels)
    again = quality_rules.fit(docs.repartition(13, F.rand(3)), labels.repartition(5, F.rand(4)))
    assert first == again and len(first.rules) > 3


def test_statistics_and_rules_against_plain_python(spark):
    r = random.Random(2)
    texts = [None, "", " \n", "A b, c. D!\nA b, c. D!\n", "x" * 40_000, *(" ".join(r.choices(["Word", "and", "12", "#", "és,", "end."], k=r.randrange(1, 60))) for _ in range(40))]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    rows, names = quality_rules.statistics(docs)
    found = {x.doc_id: [x[n] for n in names] for x in rows.collect()}
    for i, t in enumerate(texts):
        t = t or ""
        words, lines = re.findall(r"[^\x20\x09-\x0D]+", t), [x for x in t.split("\n") if x]
        share = lambda a, b: a / b if b else 0.0
        count = lambda f: sum(map(f, t))
        expected = [
            np.log1p(len(words)), share(sum(map(len, words)), len(words)), share(count(str.isalpha), len(t)), share(count(str.isupper), len(t)),
            share(count(str.isdigit), len(t)), share(count(lambda c: c in "#*$%&|<>{}[]=_~^\\@/+"), len(t)), share(count(lambda c: c in ".!?"), len(t)),
            share(count(lambda c: c in ",;:"), len(t)), share(len(set(words)), len(words)), share(len(set(words)), len(words) ** 0.5),
            share(len(set(lines)), len(lines)), np.log1p(share(len(words), len(lines))),
        ]
        assert np.allclose(found[i], expected), (t[:40], found[i], expected)
    rules = ((0.7, ((0, 1.0, True), (4, 0.1, False))), (-1.1, ((5, 0.05, True),)))
    model = quality_rules.RuleEnsemble(0.2, rules)
    for x in quality_rules.score(docs, model, "p").collect():
        s = found[x.doc_id]
        logit = 0.2 + sum(w for w, rule in rules if all((s[k] > t) == above for k, t, above in rule))
        assert abs(x.p - 1 / (1 + np.exp(-logit))) < 1e-9 and x.score == "clash"


def test_quality_stage_keeps_what_the_score_keeps_and_computes_it_once(spark):
    docs = table(spark, SF, "documents")
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns and "split(" not in formatted(kept)
    scores = q.op1_quality_rules(spark, SF)
    expected = {x.doc_id for x in scores.where("predicted = 1").select("doc_id").collect()}
    assert {x.doc_id for x in kept.select("doc_id").collect()} == expected and 0 < len(expected) < docs.count()


@pytest.mark.parametrize("parts", [1, 8, 32])
def test_few_tokens_leave_their_window(parts):
    """Nearly every window is as the sum of squares built it, however the rows are dealt."""
    r, total, moved = random.Random(1), 0, 0
    for _ in range(parts):
        packer, sizes = packing.Packer(), [r.choice([3, 40, 300, 700, 2500]) + r.randrange(300) for _ in range(6400 // parts)]
        for i, n in enumerate(sizes):
            packer.add(i, np.arange(n, dtype="<u4"))
        packer.flush()
        rows = packer.rows()
        fills = {}
        for x in rows:
            fills[x[5]] = fills.get(x[5], 0) + x[2]
        assert sum(fills.values()) == sum(sizes) and all(n == 1024 or n & (n - 1) == 0 for n in fills.values())
        pieces = {}
        for doc, start, length, *_ in rows:
            pieces.setdefault(doc, []).append((start, length))
        for i, n in enumerate(sizes):
            at = 0
            for start, length in sorted(pieces[i]):
                assert start == at
                at += length
            assert at == n
        total, moved = total + sum(sizes), moved + packer.moved
    assert moved < 0.06 * total
