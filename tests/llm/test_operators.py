"""The training-data operators against brute force, on small tables with awkward rows."""

import os
import random
import sys
import zlib
from itertools import combinations

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from remitview.llm import (
    license_digests,
    line_dedup,
    mcd_outliers,
    packing,
    quality_rules,
    sentencepiece_viterbi,
    simhash_trie,
    suffix_dedup,
    voronoi_topk,
    zstd_language,
)
from remitview.llm.common import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, id string, fp string, score string, `key` int"


def sentence(r, n):
    return " ".join(r.choice("the of and tion er ing house river stone letter green seven north wander quickly".split()) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    base, passage = [sentence(r, 80) for _ in range(12)], sentence(r, 60)
    out = [*base, *base[:4], base[0], *(x + " tail" for x in base[4:7]), *(sentence(r, 20) + " " + passage + " " + sentence(r, 20) for _ in range(4))]
    out += [None, "", "   \n\t ", "short", "a b c d e f", "De " * 400, "De " * 700, sentence(r, 6000), "x" * 5000, "\n".join([base[2], "", base[3], sentence(r, 12)])]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 3 else None, "s", None, "clash", "clash", "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[3], (None, texts[0], None, None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def groups(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(n), 2):
        if linked(i, j):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(500, i) for i in range(501, 560)] + [(i, i + 1) for i in range(700, 740)] + [(3, 3), (None, 4)]
    found = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    links = {frozenset(e) for e in edges if None not in e}
    expected = groups(800, lambda i, j: frozenset((i, j)) in links)
    assert {i: c for i, c in enumerate(expected) if c != i} == found


def test_simhash(spark, docs, empty, texts):
    fps = [simhash_trie.fingerprint(t) for t in texts]
    expected = groups(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    found = simhash_trie.near_duplicates(docs).collect()
    assert len(found) == len(texts) + 2
    assert {x.id: x.component_id for x in found if x.id is not None} == dict(enumerate(expected))
    assert [x.component_id for x in found if x.id is None] == [0]
    assert fps[texts.index("")] == 0
    assert simhash_trie.near_duplicates(empty).count() == 0


def test_trie_walk_with_parts(spark, monkeypatch):
    monkeypatch.setattr(simhash_trie, "SUBTREE", 16)
    r = random.Random(3)
    centre = [r.getrandbits(64) for _ in range(10)]
    values = sorted({c ^ sum(1 << b for b in r.sample(range(64), r.randrange(4))) for c in centre for _ in range(30)} | {r.getrandbits(64) for _ in range(50)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {x.node: x.root for x in connected_components(simhash_trie.links(fps, 2), "t").collect()}
    expected = groups(len(values), lambda i, j: (values[i] ^ values[j]).bit_count() <= 2)
    mine = [roots.get(x, x) for x in signed]
    assert {frozenset(i for i, y in enumerate(mine) if y == x) for x in mine} == {frozenset(i for i, y in enumerate(expected) if y == x) for x in expected}


def test_suffixes(docs, empty, texts):
    length, occurrences = suffix_dedup.LENGTH, {}
    for i, t in enumerate(texts):
        words = (t or "").encode().split()
        for at in range(len(words) - length + 1):
            occurrences.setdefault(tuple(words[at : at + length]), []).append((i, at))
    later, first = {}, {}
    for places in occurrences.values():
        if len(places) > 1:
            first.setdefault(places[0][0], []).append(places[0][1])
            for i, at in places[1:]:
                later.setdefault(i, []).append(at)
    spans = lambda x: suffix_dedup.spans(np.array(sorted(x)))
    expected = {i: (spans(later.get(i, [])), spans(first.get(i, []))) for i in {*later, *first}}
    assert {x.id: (x.later, x.first) for x in suffix_dedup.repeats(docs).collect()} == expected
    cut = {x.doc_id: x.text for x in suffix_dedup.without_repeats(docs).collect()}
    assert cut[12] == "" and cut[0] == texts[0] and cut[texts.index("short")] == "short" and len(cut) == len(texts) + 1
    assert suffix_dedup.repeats(empty).count() == 0


def test_cut_keeps_white_space():
    assert suffix_dedup.cut(" a  b\nc d ", [1, 3]) == " a  d "


def test_edit_distance():
    r = random.Random(1)
    for _ in range(300):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(12))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        assert line_dedup.edit_distance(a, b, 99) == row[-1]
        assert (line_dedup.edit_distance(a, b, 3) <= 3) == (row[-1] <= 3)
        assert all(line_dedup.few_edits(a, b, n) == (row[-1] <= n) for n in range(13))


def test_lines(docs, empty, texts):
    lines = [(i, n, line_dedup.normal(x)) for i, t in enumerate(texts) for n, x in enumerate((t or "").encode().split(b"\n"))]
    lines = [x for x in lines if x[2]]
    laid = line_dedup.Lines([x[2] for x in lines])
    fp, blocks = laid.fingerprints(), [set(x.tolist()) for x in laid.windows()]
    text = [b" ".join(x[2]).decode() for x in lines]
    near = lambda i, j: int(fp[i] ^ fp[j]).bit_count() <= line_dedup.budget(np.array(max(len(text[i].encode()), len(text[j].encode()))))
    like = lambda i, j: min(len(text[i].encode()), len(text[j].encode())) >= line_dedup.RATIO * max(len(text[i].encode()), len(text[j].encode()))
    same = lambda i, j: text[i] == text[j] or bool(blocks[i] & blocks[j]) and near(i, j) and like(i, j) and line_dedup.similar(text[i], text[j])
    expected = {}
    for (i, n, _), (at, root) in zip(lines, enumerate(groups(len(lines), same)), strict=True):
        if at != root:
            expected.setdefault(i, []).append(n)
    assert {x.id: x.lines for x in line_dedup.duplicate_lines(docs).collect()} == expected
    out = {x.doc_id: x.text for x in line_dedup.without_duplicate_lines(docs).collect()}
    assert out[12] == "" and out[0] == texts[0] and out[texts.index("short")] == "short"
    assert line_dedup.duplicate_lines(empty).count() == 0


def test_short_and_unspaced_lines_are_judged(spark):
    r = random.Random(4)
    han = "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(400))
    clauses = " ".join("".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(40)) for _ in range(10))
    near = [han[:200] + chr(0x4E00 + i) + han[201:] for i in range(6)]
    rows = [(1, "Read more\n" + han), (2, "read more!\n\n--\n" + han + "\nother"), (3, clauses), (4, clauses + "\nRead  more"), *((5 + i, x) for i, x in enumerate(near))]
    found = {x.id: x.lines for x in line_dedup.duplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[2] == [0, 3] and found[4] == [0, 1] and 1 not in found and 3 not in found
    fp = line_dedup.line_fingerprints([line_dedup.normal(x.encode()) for x in (han, *near)])
    close = [5 + i for i in range(6) if int(fp[0] ^ fp[1 + i]).bit_count() <= line_dedup.BUDGET]
    assert close and all(found[i] == [0] for i in close)


def test_top_k(spark):
    r = np.random.default_rng(4)
    x = np.concatenate([r.normal(c, 0.05, (60, 8)) for c in r.normal(0, 1, (6, 8))])
    x[10] = x[11]
    rows = [(int(i), [float(v) for v in row], "clash") for i, row in enumerate(x)]
    bad = [(1000, None, ""), (1100, [float("nan")] * 8, ""), (1200, [None] * 8, ""), (None, [1.0] * 8, "")]
    found = voronoi_topk.top_k(spark.createDataFrame([*rows, rows[5], *bad], "vec_id long, embedding array<double>, score string"), lambda i: i % 20 == 0, k=7, pivots=9, group_queries=5, slice_rows=50)
    ints, expected = np.floor(1024 * x).astype(np.int64), []
    for q in range(0, len(x), 20):
        scores = ints @ ints[q]
        order = [i for i in np.lexsort((np.arange(len(x)), -scores)) if i != q][:7]
        expected += [(q, n + 1, int(i), int(scores[i])) for n, i in enumerate(order)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
    assert voronoi_topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>"), lambda i: i % 100 == 0).count() == 0


def test_top_k_of_large_numbers():
    q, x = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 3.0], [0.0, 0.0]])
    assert voronoi_topk.products(q, x).tolist() == [[2**60 + 3, 0]]


def test_packing(docs, empty, texts):
    rows = packing.pack(docs).collect()
    pieces, windows = {}, {}
    for x in rows:
        pieces.setdefault(x.doc_id, []).append(x)
        windows.setdefault(x.sequence_id, []).append(x)
    exact, _ = packing._encoders(packing.VOCABULARY)
    for i, t in enumerate(texts):
        if i == 3:  # stands twice in the table
            continue
        ids, at = np.array([*exact.encode(t or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for x in sorted(pieces[i], key=lambda x: x.start):
            assert (x.start, x.doc_tokens, x.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + x.length].tobytes()))
            at += x.length
        assert at == len(ids)
    for window in windows.values():
        at = 0
        for x in sorted(window, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)
    assert packing.pack(empty).count() == 0


def test_packer_bounds_open_windows():
    packer, r = packing.Packer(64, max_open=5), random.Random(1)
    for i in range(500):
        packer.add(i, np.arange(r.randrange(1, 200), dtype="<u4"))
        assert packer.levels.sum() <= 6
    packer.flush()
    fills = {}
    for x in packer.rows():
        fills[x[5]] = fills.get(x[5], 0) + x[2]
    assert sum(f != 64 for f in fills.values()) <= 6


def test_fast_tokens_are_the_tokenizers():
    exact, _ = packing._encoders(packing.VOCABULARY)
    chars = [chr(c) for c in range(1, 0x250)]
    r = random.Random(0)
    for t in [*chars, *("".join(r.choices(chars, k=30)) for _ in range(300)), "a<|endoftext|>b", "漢字 हिन्दी"]:
        assert packing.token_ids(t).tolist() == exact.encode(t, add_special_tokens=False).ids


def test_packing_takes_endless_white_space(spark):
    text = "a" + " " * 1_000_100 + "b" + "\n" * 1_000_100 + "c"
    exact, _ = packing._encoders(packing.VOCABULARY)
    expected = [*exact.encode(text, add_special_tokens=False).ids, 0]
    rows = packing.pack(spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")).collect()
    assert sum(x.length for x in rows if x.doc_id == 1) == len(expected) and any(x.doc_id == 2 for x in rows)
    for x in rows:
        if x.doc_id == 1:
            assert x.ids_crc32 == zlib.crc32(np.array(expected[x.start : x.start + x.length], "<u4").tobytes())


def test_viterbi(docs, empty, texts):
    import public_tokenizers

    model = sentencepiece_viterbi.pieces(public_tokenizers.path(sentencepiece_viterbi.VOCABULARY))
    memory, r = sentencepiece_viterbi.Memory(model), random.Random(6)
    for t in ["the of", "Ă中😀  x", *("".join(r.choice("thexin  \n中é.") for _ in range(20)) for _ in range(40))]:
        ids = sentencepiece_viterbi.encode(t, memory)
        assert sentencepiece_viterbi.decode(ids, model) == t
        escaped = "▁" + t.replace(" ", "▁")
        best = [0.0] + [-np.inf] * len(escaped)  # every segmentation, by its last piece
        for j in range(1, len(escaped) + 1):
            for i in range(j):
                score = model.score.get(escaped[i:j], (model.unknown_score if j - i == 1 else -np.inf,))[0]
                best[j] = max(best[j], best[i] + score)
        stream = sentencepiece_viterbi.StreamingViterbi(model)
        out = [i for at in range(0, len(escaped), 3) for i in stream.feed(escaped[at : at + 3])] + list(stream.finish())
        assert out == ids
        by_id = {i: s for s, i in model.score.values()}
        unknown = sum(c not in model.score for c in escaped)
        assert abs(sum(by_id.get(i, 0.0) for i in ids) + unknown * model.unknown_score - best[-1]) < 1e-6 * abs(best[-1])
    stream = sentencepiece_viterbi.StreamingViterbi(model)
    assert sentencepiece_viterbi.decode([*stream.feed("the" * 20000), *stream.finish()], model) == "the" * 20000
    assert stream.widest <= 6 * model.longest
    assert all(x.same for x in sentencepiece_viterbi.round_trip(docs).collect())
    back = sentencepiece_viterbi.decoded(sentencepiece_viterbi.encoded(docs)).collect()
    assert {x.id: x.text for x in back if x.id is not None} == {i: t or "" for i, t in enumerate(texts)}
    assert sentencepiece_viterbi.round_trip(empty).count() == 0


def test_outliers(spark, docs, empty, texts):
    for x in mcd_outliers.outliers(docs).collect():
        if x.id is None:
            continue
        words = (texts[x.id] or "").encode().split()
        windows, covered = {}, set()
        for i in range(len(words) - 4):
            windows.setdefault(tuple(words[i : i + 5]), []).append(i)
        for at in windows.values():
            covered |= {i + j for i in at for j in range(5)} if len(at) > 1 else set()
        assert (x.n_words, x.n_repeat_words) == (len(words), len(covered))
        assert x.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert x.kept == (not x.base_failed)  # few rows: the spread is mostly that of documents in general
    assert mcd_outliers.outliers(empty).count() == 0
    r = random.Random(8)
    rows = [(i, sentence(r, r.randrange(50, 200)), "en", "s") for i in range(300)] + [(1000, "### $$$ " * 3 + "# ".join(sentence(r, 60).split()), "en", "s"), (1001, sentence(r, 90), None, None)]
    kept = {x.id: x.kept for x in mcd_outliers.outliers(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept.pop(1000) and all(kept.values())


def test_chi2():
    assert abs(mcd_outliers.chi2_quantile(0.95, 5) - 11.0705) < 1e-3


def test_licenses(spark, empty):
    mit = dict((i, t) for i, t in reversed(license_digests.KNOWN))["MIT"]
    long_mit = next(t for i, t in license_digests.KNOWN if i == "MIT")
    rows = [(1, long_mit.upper().replace("<YEAR> <HOLDER>", "1999 Somebody").replace(",", " ;")), (2, "text\n" + mit + "\nReleased under the MIT Licence!"), (3, None), (4, " .. "), (5, long_mit + " more"), (2, None)]
    rows = [(i, t) for i, t in rows]
    found = license_digests.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 6
    by_id = {x.id: x for x in found if x.digest is not None}
    assert by_id[1].license_id == "MIT" and by_id[5].license_id is None
    assert by_id[2].license_id is None and by_id[2].notices == ["MIT"]
    assert {x.id for x in found if x.digest is None} == {2, 3, 4}
    assert license_digests.scan(empty).count() == 0


def test_licenses_wrapped_titled_and_named(spark):
    import textwrap

    whole = {}
    for i, t in license_digests.KNOWN:
        if len(t) > 400 and i not in whole:
            whole[i] = t
    wrapped = lambda t, n: "\n".join(x for p in t.split("\n") for x in (textwrap.wrap(p, n, break_on_hyphens=False) or [""]))
    rows, expected = [], {}
    for i in ("MIT", "ISC", "0BSD", "Zlib", "BSD-2-Clause", "BSD-3-Clause", "Unlicense", "Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "MPL-2.0", "CC0-1.0"):
        for n in (50, 72, 80, 10**6) if len(whole[i]) < 3000 else (10**6,):
            rows.append((len(rows), wrapped(whole[i], n)))
            expected[len(rows) - 1] = i
    isc = wrapped(whole["ISC"].replace(" copyright notice and", "\ncopyright notice and"), 80)
    rows.append((len(rows), "Copyright 2020 Some Body\nAll rights reserved.\n" + isc.partition("\n\n")[2].partition("\n\n")[2]))
    expected[len(rows) - 1] = "ISC"
    notices = {"Licensed under CC BY 4.0.": "CC-BY-4.0", "Licensed under the GNU General Public License, version 2.": "GPL-2.0-only", "This project is licensed under the BSD 3-Clause License.": "BSD-3-Clause", "SPDX-License-Identifier: MPL-2.0": "MPL-2.0"}
    for text, i in notices.items():
        rows.append((len(rows), text))
        expected[len(rows) - 1] = i
    found = license_digests.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.id: x.license_id for x in found} == expected


def test_language(spark, empty):
    r = random.Random(1)
    words = {"xx": [f"{a}{b}" for a in "bdfg" for b in ("ana", "oko", "ulu")], "yy": [f"{a}{b}" for a in ("str", "pl") for b in ("eim", "ist", "ung")]}
    text = lambda x, n: " ".join(r.choices(words[x], k=n))
    train = spark.createDataFrame([(i, text(x, 40), x) for i in range(40) for x in words] + [(99, "text", None), (98, None, "zz"), (97, "1 2", "zz")], "doc_id long, text string, lang string")
    known = zstd_language.learn(train)
    assert list(known) == ["xx", "yy"]
    rows = [(1, text("xx", 30)), (2, text("yy", 5000)), (3, None), (4, "12 34"), (5, ""), (1, text("xx", 30))]
    found = zstd_language.predict(spark.createDataFrame(rows, "doc_id long, text string"), known).collect()
    assert sorted((x.id, x.lang_pred) for x in found) == [(1, "xx"), (1, "xx"), (2, "yy"), (3, "und"), (4, "und"), (5, "und")]
    assert all(0 <= x.score <= 1 for x in found)
    assert zstd_language.learn(empty) == {} and zstd_language.predict(empty, {}).count() == 0


def test_quality(spark, docs, empty):
    r = random.Random(3)
    rows = [(i, sentence(r, 40) if i % 2 else "!!! $$ " * r.randrange(5, 40)) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 120)] + [(1, 0), (None, 1)], "doc_id long, quality int")
    model = quality_rules.fit(table, labels)
    assert model.rules
    found = {x.doc_id: x.score for x in quality_rules.score(table, model).collect()}
    assert all((s >= 0.5) == bool(i % 2) for i, s in found.items())
    scored = quality_rules.score(docs, model, "result")
    assert scored.columns == [*docs.columns, "result"] and all(0 <= x.result <= 1 for x in scored.collect())
    assert not quality_rules.fit(table, labels.limit(0)).rules and quality_rules.score(empty, model, "result").count() == 0


def test_pipeline_stages_keep_columns(spark, docs, tmp_path):
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        # the row without an id is a copy of document 0: one of a component stays, the one with an id
        assert out.where("doc_id is null").count() == (name != "simhash_near_dedup") and out.where("doc_id = 0").count() == 1


def test_near_duplicates_keeps_one_row_of_each_component(spark, tmp_path):
    a, b, c = (sentence(random.Random(x), 40) for x in (1, 2, 3))
    rows = [(3, a), (7, a), (7, b), (9, b), (5, c), (5, c), (5, c), (None, c), (None, c), (None, "only " + b[::-1]), (None, "only " + b[::-1]), (20, None), (21, " ")]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path))
    expected = [(3, a), (7, b), (5, c), (None, "only " + b[::-1]), (20, None)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(expected, key=str)
