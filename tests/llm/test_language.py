"""Language by compression: whole texts teach, every language is learned, sizes against plain zstandard."""

import os
import random
import sys

import zstandard
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from remitview.llm import zstd_language as language
from remitview.llm.common import table
from remitview.llm.queries import op10_zstd_language

SCHEMA = "doc_id long, text string, lang string"


def plain_sizes(text, dictionaries, level):
    """Sizes by one-shot compressors that share nothing with the operator but the cut into blocks."""
    out = {}
    for name, raw in dictionaries.items():
        kept = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        tool = zstandard.ZstdCompressor(level=level, dict_data=kept, write_content_size=False, write_checksum=False, write_dict_id=False)
        out[name] = sum(len(tool.compress(x)) for x in language.blocks(language.normal(text)))
    return out


def test_blocks_cover_whole_texts():
    r = random.Random(1)
    words = ["ab", "cde", "fghij", "é", "x" * 9000]
    for n in (1, 2, 3, 50, 400, 9000):
        text = " ".join(r.choices(words[:4] if n < 9000 else words, k=n))
        parts = language.blocks(text)
        if len(text.encode()) < language.MEASURED and n > 1:
            assert sum(map(len, parts)) >= min(language.MEASURED, n * len(text.encode()))
            assert {tuple(sorted(x.split())) for x in parts} == {tuple(sorted(text.encode().split()))}
        else:
            assert b"".join(parts) == text.encode() and max(map(len, parts)) <= language.BLOCK


def test_predictions_are_the_least_size(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    known = language.learn(docs)
    for x in language.predict(docs, known).join(docs.withColumnRenamed("doc_id", "id"), "id").collect():
        if x.lang_pred == "und":
            assert not language._LETTER.search(x.text or "")
            continue
        by_size = plain_sizes(x.text, known, language.LEVEL)
        least = [k for k, v in by_size.items() if v == min(by_size.values())]
        if len(least) > 1:
            ties = plain_sizes(x.text, known, language.TIE_LEVEL)
            least = [min(least, key=lambda k: (ties[k], k))]
        assert x.lang_pred == least[0]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    found = op10_zstd_language(spark, sf).where("held_out").join(table(spark, sf, "documents"), "doc_id").where(F.col("text").rlike(r"\p{L}"))
    n, right = found.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 2000 and right >= 0.989 * n


def test_tails_teach_and_repeats_count_once(spark):
    """Heads alike in both languages: only what follows them tells the two apart."""
    r = random.Random(2)
    head = "lorem ipsum dolor sit amet " * 60
    tails = {"xx": ["bana", "doko", "fulu", "gana"], "yy": ["streim", "plist", "strung", "pleim"]}
    tail = lambda x, n: " ".join(r.choices(tails[x], k=n))
    rows = [(i, head + tail(x, 3000), x) for i, x in enumerate(["xx", "yy"] * 15)] + [(1000, head, "xx")] * 300
    known = language.learn(spark.createDataFrame(rows, SCHEMA))
    assert known["xx"].count(b"lorem") < len(known["xx"]) / 60 and b"doko" in known["xx"] and b"plist" in known["yy"]
    tests = [(1, tail("xx", 20)), (2, tail("yy", 20)), (3, tail("xx", 4000)), (4, tail("yy", 3))]
    found = language.predict(spark.createDataFrame(tests, "doc_id long, text string"), known).collect()
    assert [x.lang_pred for x in sorted(found, key=lambda x: x.id)] == ["xx", "yy", "xx", "yy"]


def test_every_language_is_learned_within_one_budget(spark, monkeypatch):
    monkeypatch.setattr(language, "ALL_DICTIONARIES", 6000)
    monkeypatch.setattr(language, "DICTIONARY", 1500)
    rows = [(i, f"word{chr(97 + i % 20)} " * 100, f"l{i % 20:02}") for i in range(200)]
    known = language.learn(spark.createDataFrame(rows, SCHEMA).repartition(9))
    assert list(known) == [f"l{i:02}" for i in range(20)] and all(0 < len(x) <= 300 for x in known.values())
    again = language.learn(spark.createDataFrame(rows[::-1], SCHEMA).repartition(2))
    assert known == again


def test_ties_and_awkward_rows(spark):
    known = {"aa": b"same words here", "bb": b"same words here"}
    rows = [(1, "same words", 5), (None, "same words", 6), (2, None, 7), (3, "12 !", 8), (1, "same words", 5)]
    found = language.predict(spark.createDataFrame(rows, "doc_id long, text string, score int"), known).collect()
    assert sorted((x.id or 0, x.lang_pred, x.margin, x.accepted) for x in found) == [(0, "aa", 0.0, False), (1, "aa", 0.0, False), (1, "aa", 0.0, False), (2, "und", 0.0, False), (3, "und", 0.0, False)]
    assert all(x.score == 0.5 for x in found if x.lang_pred == "aa")
    nothing = spark.createDataFrame([], SCHEMA)
    assert language.learn(nothing) == {} and language.predict(nothing, known).count() == 0
