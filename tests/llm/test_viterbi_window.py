"""All text goes through the streaming window; words seen before are remembered between its commits."""

import os
import random
import sys

import public_tokenizers

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from remitview.llm import sentencepiece_viterbi as viterbi
from remitview.llm.common import table

MODEL = viterbi.pieces(public_tokenizers.path(viterbi.VOCABULARY))


def test_the_window_commits_on_ordinary_text(spark):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").select("text").collect() if r.text]
    memory = viterbi.Memory(MODEL)
    ids = [viterbi.encode(t, memory) for t in texts]
    stretches = {x for t in texts for x in viterbi._STRETCH.findall(viterbi.SPACE + t.replace(" ", viterbi.SPACE))}
    assert memory.window.commits >= len(stretches) > 1000  # every different word went through it, once
    assert memory.window.done == sum(map(len, stretches))
    # and without any memory or cut, fed in odd portions, the window gives the same ids
    for t, expected in list(zip(texts, ids, strict=True))[:25]:
        window, escaped = viterbi.StreamingViterbi(MODEL), viterbi.SPACE + t.replace(" ", viterbi.SPACE)
        out = [i for at in range(0, len(escaped), 7) for i in window.feed(escaped[at : at + 7])] + window.finish()
        assert out == expected and window.widest <= 6 * MODEL.longest
        if len(t) > 1000:
            assert window.commits > 3


def test_length_selects_no_other_way(monkeypatch):
    r = random.Random(3)
    words = ["".join(r.choices("thexingoa", k=r.choice([3, 47, 48, 49, 50, 400]))) for _ in range(60)]
    text = " ".join(words)
    first = viterbi.encode(text, viterbi.Memory(MODEL))
    for longest, kept in ((0, 5), (5, 3), (1000, 2)):
        monkeypatch.setattr(viterbi, "REMEMBERED_LENGTH", longest)
        monkeypatch.setattr(viterbi, "REMEMBERED", kept)
        memory = viterbi.Memory(MODEL)
        assert viterbi.encode(text, memory) == first == viterbi.encode(text, memory)
        assert len(memory) <= kept
    assert viterbi.decode(first, MODEL) == text
