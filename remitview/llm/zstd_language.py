"""Language identification by compression: the language whose dictionary makes a text smallest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitview.llm.common import map_arrow

#: Bytes of dictionary for a language, and for all languages together: more than
#: ``ALL_DICTIONARIES / DICTIONARY`` languages share the whole evenly, however many they are.
DICTIONARY = 128 * 1024
ALL_DICTIONARIES = 8 * 1024 * 1024
#: Bounds on labelled rows: characters of the slice that a training text gives, at a place chosen by
#: its hash, and characters drawn for each byte of dictionary.
SLICE, DRAWN = 1000, 4
#: Whole texts are compressed in blocks of this many bytes, so that the dictionary serves every block.
BLOCK = 8 * 1024
#: Compression levels: one for the sizes, one to part languages of equal size.
LEVEL, TIE_LEVEL = 6, 12
#: Sizes are whole bytes: a text is turned round by words until at least this many bytes are measured.
MEASURED = 1024
#: A verdict is accepted if the second language needs this share more bytes.
MIN_MARGIN = 0.01
UNKNOWN = "und"
SCHEMA = "id long, lang_pred string, score double, margin double, accepted boolean"

_LETTER, _OTHER = regex.compile(r"\p{L}"), regex.compile(r"[^\p{L}\p{M}]+")


def normal(text: str) -> str:
    """Lower case, a space for every run of other characters than letters."""
    return _OTHER.sub(" ", text.lower()).strip()


def learn(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Raw-content dictionaries from the rows of ``train`` that have a language and a letter.

    Every language is learned. Counts by language come from all rows; a share of a language's rows is
    drawn by the hash of their id and text (equal rows count once), and a row gives a slice whose
    place in the text follows from that hash, so all parts of texts teach alike. The slices drawn hold
    about ``DRAWN`` characters for each byte of dictionary: the driver gets 32 MB or so, one row a
    language at least. Without rows (an empty table) nothing is learned.
    """
    rows = train.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("id"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("hash", F.xxhash64("id", "text"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("hash").alias("least"))
    languages = counts.count()
    each = min(DICTIONARY, max(1, ALL_DICTIONARIES // max(1, languages)))
    slice_ = min(SLICE, each)
    share = F.lit(DRAWN * each / slice_) / F.col("n")
    draw = F.pmod(F.col("hash"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = rows.select("lang", "hash").join(counts, "lang").where((draw < share) | (F.col("hash") == F.col("least"))).select("lang", "hash").distinct()
    # about DRAWN * ALL_DICTIONARIES / SLICE rows and one a language
    start = F.pmod(F.xxhash64("hash"), F.greatest(F.length("text") - F.lit(slice_ - 1), F.lit(1))).cast("int") + 1
    sample = rows.join(F.broadcast(drawn), ["lang", "hash"]).select("lang", "hash", F.substr("text", start, F.lit(slice_)).alias("text")).dropDuplicates(["lang", "hash"])
    found: dict[str, list[tuple[int, str]]] = {}
    for lang, at, text in sample.collect():
        found.setdefault(lang, []).append((at, text))
    return {lang: " ".join(normal(t) for _, t in sorted(found[lang])).encode()[:each] for lang in sorted(found)}


_ready: dict[bytes, dict[int, list]] = {}


def _compressors(dictionaries: tuple[bytes, ...]) -> dict[int, list]:
    """Compressors by level, built once in a worker for a set of dictionaries."""
    key = hashlib.sha1(b"\0".join(dictionaries)).digest()
    if key not in _ready:
        _ready.clear()
        for level in (LEVEL, TIE_LEVEL):
            tools = _ready.setdefault(key, {}).setdefault(level, [])
            for x in dictionaries:
                d = zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=level)
                tools.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
    return _ready[key]


def blocks(text: str) -> list[bytes]:
    """What is compressed for a normalised text: its blocks; of a text under ``MEASURED`` bytes so many
    turns, each beginning with a later word, that they come to ``MEASURED`` (or one for each word)."""
    data, words = text.encode(), text.split(" ")
    turns = min(len(words), -(-MEASURED // max(1, len(data))))
    if turns > 1:
        firsts = [len(words) * i // turns for i in range(turns)]
        return [" ".join(words[i:] + words[:i]).encode() for i in firsts]
    return [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)]


def sizes(text: str, tools: list) -> np.ndarray:
    """Bytes that the whole text takes with each dictionary, over its blocks or turns."""
    parts = blocks(normal(text))
    return np.array([sum(len(tool.compress(x)) for x in parts) for tool in tools])


def classify(text: str | None, languages: tuple[str, ...], by_level: dict[int, list]) -> tuple[str, float, float, bool]:
    """(language, score, margin, accepted). Of equally small languages the whole text's sizes at the
    other level decide, and of those equal there the first name in order."""
    if not text or not languages or not _LETTER.search(text):
        return UNKNOWN, 0.0, 0.0, False
    size = sizes(text, by_level[LEVEL]).astype(float)
    tied = size == size.min()
    if tied.sum() > 1:
        other = sizes(text, by_level[TIE_LEVEL])
        size[tied] += other[tied] / (other[tied].max() + 1.0) / 2
    order = np.argsort(size, kind="stable")
    best = size[order[0]]
    margin = float(size[order[1]] / best - 1) if len(order) > 1 else 1.0
    weight = np.exp(-(size - best) / (0.01 * best + 1))
    return languages[order[0]], float(1 / weight.sum()), margin, margin >= MIN_MARGIN


def predict(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``SCHEMA`` for every row of ``docs``.

    ``lang_pred`` is the language that compresses the whole text best; a text that is null or has no
    letter, and any text where nothing was learned, is ``und`` with score 0. ``accepted`` is false
    where the margin is narrow: rejected verdicts keep their language and low score for the caller
    to drop. Repeated rows and null ids come back as they came, and an empty table gives none; ties
    are as in ``classify``.
    """
    languages, raw = tuple(dictionaries), docs.sparkSession.sparkContext.broadcast(tuple(dictionaries.values()))

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_level = _compressors(raw.value)
        for part in parts:
            rows = [classify(x, languages, by_level) for x in part.column(1).to_pylist()]
            cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
            types = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["id", "lang_pred", "score", "margin", "accepted"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, task, SCHEMA)
