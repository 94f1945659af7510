"""Language identification by compression.

``fit`` takes, for each language, the labelled texts that come first in hash
order (at most ``sample_rows`` rows and ``dictionary_bytes`` of text; the
documented bound of the training sample) as a zstandard raw-content
dictionary.  ``classify`` encodes every whole text, in pieces, with each
dictionary; the language of the smallest total wins.  Equal totals, as short
texts give, are told apart by encoding again at the higher ``TIE_LEVELS``, then
word by word.  The score is the margin over the runner-up as a share of its
size, scaled to 0..1, and a margin under ``min_margin`` rejects the decision.

Defined cases: null text or text without a letter is ``und`` with score 0; no
labelled text at all makes everything ``und``; what no encoding tells apart goes
to the first language by name with score 0; repeated rows count each, but once
in a dictionary; other columns of the input are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from itertools import groupby

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kymo.llm.common import arrow_map
from kymo.session import cut

UNKNOWN = "und"
#: Bounds of the training sample, per language.
SAMPLE_ROWS, DICTIONARY_BYTES = 200, 256 * 1024
#: Texts are encoded in pieces, so that the dictionary, not the text itself, predicts them.
PIECE_BYTES = 1024
LEVEL = 3


TIE_LEVELS = (9, 19)
_OTHER = regex.compile(r"[^\p{L}]+")


def normalise(text: str) -> str:
    """Lower-case letters, with one space for anything else, a word that follows itself once: marks, digits and runs say nothing."""
    return " ".join(word for word, _ in groupby(_OTHER.sub(" ", text.lower()).split()))


def fit(df: DataFrame, train: Column, sample_rows: int = SAMPLE_ROWS, dictionary_bytes: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """Language -> dictionary content, from rows where ``train`` holds and language and text are there.

    Only hashes of ids are ranked; the texts of the chosen ones, at most
    ``sample_rows`` a language, are fetched by a second read.
    """
    rows = df.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0)).select("lang", F.xxhash64("doc_id").alias("h"), "text")
    # ranges of hashes are counted first, so that only those of the first ones are ranked, not every task's first ones
    hashes = cut(rows.select("lang", "h").distinct().withColumn("range", F.shiftright("h", 48)), "hashes")
    before = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = hashes.groupBy("lang", "range").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    first = counts.where(F.col("before") < sample_rows).select("lang", "range")  # sample_rows ranges a language at most
    ranked = hashes.join(F.broadcast(first), ["lang", "range"]).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    chosen = cut(ranked.where(F.col("rank") <= sample_rows).select("lang", "h", "rank"), "chosen")
    fetched = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "rank").agg(F.min(F.substring("text", 1, dictionary_bytes)).alias("text"))
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in fetched.toLocalIterator():  # sample_rows rows a language
        texts.setdefault(r["lang"], []).append((r["rank"], r["text"]))
    found = {}
    for lang, sample in sorted(texts.items()):
        content = b"\n".join(normalise(t).encode() for _, t in sorted(sample))
        found[lang] = content[:dictionary_bytes]
    return found


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes]):
        self.langs = sorted(dictionaries)
        self.dictionaries = dictionaries
        self.encoders = {LEVEL: [self._encoder(x, LEVEL) for x in self.langs]}

    def _encoder(self, lang: str, level: int) -> zstandard.ZstdCompressor:
        content = zstandard.ZstdCompressionDict(self.dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False)

    def sizes(self, pieces: list[bytes], level: int, which: list[int]) -> list[int]:
        if level not in self.encoders:
            self.encoders[level] = [self._encoder(x, level) for x in self.langs]
        return [sum(len(self.encoders[level][k].compress(p)) for p in pieces) for k in which]

    def __call__(self, text: str | None) -> tuple[str, float]:
        raw = b"" if text is None else normalise(text).encode()
        if not raw or not self.langs:
            return UNKNOWN, 0.0
        pieces = [raw[i : i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES)]
        every = list(range(len(self.langs)))
        sizes = self.sizes(pieces, LEVEL, every)
        best = min(sizes)
        tied = [k for k in every if sizes[k] == best]
        for level, parts in [*((x, pieces) for x in TIE_LEVELS), (TIE_LEVELS[-1], raw.split())]:
            if len(tied) > 1:
                again = self.sizes(parts, level, tied)
                tied = [k for k, s in zip(tied, again, strict=True) if s == min(again)]
        rest = [s for k, s in enumerate(sizes) if k != tied[0]]
        margin = (min(rest) - best) / min(rest) if rest else 1.0
        return self.langs[tied[0]], min(1.0, margin * 4)


def classify(df: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.01, id_column: str = "doc_id") -> DataFrame:
    """``id, lang_pred, score, rejected`` for every row; only the text is looked at.

    The dictionaries are bounded by ``DICTIONARY_BYTES`` a language.
    """
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)
    kind = df.schema[id_column].dataType.simpleString()

    def make():
        model = Classifier(shared.value)

        def apply(batch: pa.RecordBatch) -> dict:
            found = [model(t) for t in batch.column("text").to_pylist()]
            return {"id": batch.column("id"), "lang_pred": [x[0] for x in found], "score": [x[1] for x in found], "rejected": [x[1] < 4 * min_margin for x in found]}

        return apply

    out = arrow_map(df.select(F.col(id_column).alias("id"), "text"), f"id {kind}, lang_pred string, score double, rejected boolean", make)
    return out.withColumnRenamed("id", id_column)
