r"""Quality rules per document and per host.

``document_rules`` counts, for every whole text, words ``[^\x20\x09-\x0D]+``,
their code points, symbols, repeated lines and words in repeated three-word
windows, and applies the base rules.  ``host_verdicts`` aggregates failures by
host and shrinks each rate towards the corpus with a beta prior fitted to all
hosts by moments: ``(failures + a) / (documents + a + b)``.  A host is refused
when its shrunk rate lies beyond what the prior allows: ``DEVIATIONS`` standard
deviations of the fitted prior above its mean, but never under ``LEAST_RATE``
nor over ``MOST_RATE``; the verdicts are joined back.

Defined cases: null text has no words and fails; a null host is a host of its
own; no hosts or hosts without spread give the prior ``(rate, 1 - rate)`` times
``flat_strength``; repeated rows count each; very long texts are read whole;
columns that the results are named like are replaced (``judge`` returns the id
and its results only); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import SPACE, arrow_map, fresh, utf8
from kymo.session import cut, gathered

#: Fixed value: the symbols that are counted.
SYMBOLS = b"#*$%&|<>"
_SPACE_TABLE = bytes(1 if b in SPACE else 0 for b in range(256))
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A host's limit: deviations above the prior's mean, and the rates between which it stays.
DEVIATIONS, LEAST_RATE, MOST_RATE = 3.0, 0.25, 0.5


class _Numbers(dict):
    """Word -> number, given out in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words covered by windows of ``size`` words that occur twice or more, the first included."""
    n = len(words)
    if n <= size:
        return 0
    numbers = _Numbers()
    w = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=n)
    base = len(numbers)
    key = w[: n - size + 1].copy()
    for k in range(1, size):
        if base ** (k + 1) >= 2**62:  # keep the keys exact in 64 bits
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * base + w[k : n - size + 1 + k]
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    twice = np.zeros(len(k), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = order[twice]
    if not len(hit):
        return 0
    marks = np.zeros(n + 1, dtype=np.int64)
    np.add.at(marks, hit, 1)
    np.add.at(marks, hit + size, -1)
    return int((np.cumsum(marks[:n]) > 0).sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def document_rules(df: DataFrame, id_column: str = "doc_id", host_column: str = "source") -> DataFrame:
    """``id, host`` and the counts and the base verdict of every row."""
    kinds = [df.schema[c].dataType.simpleString() for c in (id_column, host_column)]

    def make():
        def apply(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")}
            for text in utf8(batch):
                words = text.split()
                n, repeats = len(words), repeated_words(words)
                solid = text.translate(None, SPACE)
                out["n_words"].append(n)
                out["word_chars"].append(len(solid) if solid.isascii() else len(solid.decode()))
                out["n_symbols"].append(len(solid) - len(solid.translate(None, SYMBOLS)))
                out["n_dup_lines"].append(duplicate_lines(text))
                out["n_repeat_words"].append(repeats)
                out["base_failed"].append(n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n)
            return out | {"id": batch.column("id"), "host": batch.column("host")}

        return apply

    source = df.select(F.col(id_column).alias("id"), F.col(host_column).alias("host"), "text")
    schema = f"id {kinds[0]}, host {kinds[1]}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
    return arrow_map(source, schema, make)


def host_verdicts(rules: DataFrame, max_rate: float | None = None, flat_strength: float = 2.0) -> DataFrame:
    """``host, n_docs, n_failed, shrunk_rate, host_failed``; one row per host.  ``max_rate`` replaces the limit drawn from the prior."""
    hosts = rules.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(
        F.try_divide(F.sum("n_failed"), F.sum("n_docs")).alias("mean"),
        F.count(F.lit(1)).alias("hosts"),
        F.var_pop(rate).alias("spread"),
        F.avg(1.0 / F.col("n_docs")).alias("noise"),
    )
    row = prior.first()  # one row of corpus totals
    mean, strength = row["mean"] or 0.0, flat_strength
    if row["hosts"] and 0 < mean < 1:
        # variance of rates = m(1-m) * (1/n + (1 - 1/n) / (s + 1)) for a beta-binomial of strength s
        over = row["spread"] / (mean * (1 - mean)) - row["noise"]
        if over > 1e-9:
            strength = min(max((1 - row["noise"]) / over - 1, 1e-3), 1e6)
    if max_rate is None:
        max_rate = rate_limit(mean, strength)
    shrunk = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.select("host", "n_docs", "n_failed", F.round(shrunk, 9).alias("shrunk_rate"), (shrunk > max_rate).alias("host_failed"))


def rate_limit(mean: float, strength: float) -> float:
    """The highest rate that a host may have under a beta prior of this mean and strength."""
    deviation = (mean * (1 - mean) / (strength + 1)) ** 0.5
    return min(max(mean + DEVIATIONS * deviation, LEAST_RATE), MOST_RATE)


def judge(df: DataFrame, id_column: str = "doc_id", host_column: str = "source", max_rate: float | None = None) -> DataFrame:
    """Counts, base verdict, host verdict and ``kept`` for every row."""
    rules = cut(document_rules(df, id_column, host_column), "quality")
    hosts = host_verdicts(rules, max_rate)
    joined = rules.join(hosts.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")), "left")
    return joined.select(
        F.col("id").alias(id_column),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
        "host_failed", "shrunk_rate",
    )


def passing(df: DataFrame, host_column: str = "source", max_rate: float | None = None) -> DataFrame:
    """The rows of ``df`` that pass the base rules and whose host passes; the verdict is written beside each row once."""
    names, failed = df.columns, fresh(df, "_failed")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{failed}` boolean"

    def make():
        def apply(batch: pa.RecordBatch) -> dict:
            verdicts = []
            for text in utf8(batch):
                words = text.split()
                verdicts.append(len(words) < MIN_WORDS or 100 * repeated_words(words) > MAX_REPEAT_PERCENT * len(words))
            return {n: batch.column(n) for n in names} | {failed: verdicts}

        return apply

    judged = cut(arrow_map(df, schema, make), "judged")
    hosts = host_verdicts(judged.select(F.col(host_column).alias("host"), F.col(failed).alias("base_failed")), max_rate)
    h = fresh(judged, "_host")
    refused = cut(gathered(hosts.where("host_failed").select(F.col("host").alias(h)), judged.count()), "refused")
    return judged.where(~F.col(failed)).join(refused, F.col(host_column).eqNullSafe(F.col(h)), "left_anti").select(*names)
