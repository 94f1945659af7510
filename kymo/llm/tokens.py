"""Token counts by a two-tier lookup, all on the map side.

Tier one is a broadcast table of the lengths of frequent pre-tokens (at most
``table_size`` entries; it only decides how fast a count is, never what it is).
Its entries are counted over all texts, whole: each task splits its texts into
runs of letters with the space before them, which are most pre-tokens and cost
little, and keeps a bounded summary of the pieces (at most ``table_size`` reach the shuffle; a count
is too low by the cuts that its task made, as in Misra and Gries); the summaries
are added up.  Tier two is a bounded cache in each Python worker, filled by the
tokenizer itself.  The vocabulary file is read on the driver and broadcast.

Texts with characters outside ``_SAFE`` (where two Unicode versions of the
pre-token pattern could differ) and texts holding an added token's string go
to the tokenizer whole.

Defined cases: null text counts as empty (0 bytes, 0 tokens); very long texts
are counted whole; extra columns are ignored; repeated rows are counted each;
equally frequent pieces enter the table by code point; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import arrow_map, strings, utf8
from kymo.session import ship

#: Fixed value: the pre-token pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: ASCII but for FS, GS, RS, US and DEL; Latin-1 and Latin Extended-A, Greek and Cyrillic letters, marks of general
#: punctuation, currencies, CJK ideographs and kana.  Their classes have not changed since they were encoded.
_SAFE = r"\x00-\x1b\x20-\x7e\xa0-\xff\u0100-\u017f\u0391-\u03a1\u03a3-\u03a9\u03b1-\u03c9\u0410-\u044f\u0401\u0451\u2010-\u2027\u2030-\u205e\u20a0-\u20ac\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5"
_UNSAFE = f"[^{_SAFE}]"
#: Everything in ASCII but letters and the space becomes a line feed.
_MARKS = bytes(b if b > 127 or chr(b).isalpha() or b == 32 else 10 for b in range(256))
#: Longest pre-token that is cached, and entries of a worker's cache.
MAX_CACHED_CHARS, CACHE_ENTRIES = 64, 200_000

#: By digest of the vocabulary.
_WORKER: dict[str, tuple] = {}


def _tools(vocabulary: str) -> tuple:
    """The tokenizer, the pre-token pattern and the cache of this worker process."""
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    if key not in _WORKER:
        import regex
        from tokenizers import Tokenizer

        added = [x["content"] for x in json.loads(vocabulary)["added_tokens"]]
        _WORKER[key] = (Tokenizer.from_str(vocabulary), regex.compile(PATTERN), regex.compile(_UNSAFE), added, {})
    return _WORKER[key]


def summary(texts: Iterable[list], size: int) -> Counter:
    """The at most ``size`` heaviest of the listed pieces; memory is bounded by ``4 * size`` and one text."""
    seen: Counter = Counter()

    def shrink() -> None:
        cut = sorted(seen.values(), reverse=True)[size]
        for p in [p for p, n in seen.items() if n <= cut]:
            del seen[p]
        for p in seen:
            seen[p] -= cut

    for pieces in texts:
        seen.update(p for p in pieces if len(p) <= MAX_CACHED_CHARS)
        if len(seen) > 4 * size:
            shrink()
    return Counter(dict(seen.most_common(size)))


def letter_runs(text: bytes) -> list[bytes]:
    """The runs of letters of a text, with a space before them where there is one."""
    return text.translate(_MARKS).replace(b" ", b"\n ").split(b"\n")


def frequent_lengths(df: DataFrame, tokenizer_path: str, table_size: int = 65_536) -> dict[str, int]:
    """Lengths in tokens of the most frequent pre-tokens of all texts that consist of letters."""
    ship(df.sparkSession)

    def heavy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = summary((letter_runs(t) for batch in batches for t in utf8(batch)), table_size)
        pieces = [(p.decode(errors="ignore"), n) for p, n in found.items() if p.strip()]
        for at in range(0, len(pieces), 8192):
            part = pieces[at : at + 8192]
            yield pa.RecordBatch.from_pydict({"piece": [p for p, _ in part], "n": [n for _, n in part]}, schema=pa.schema([("piece", pa.string()), ("n", pa.int64())]))

    counts = df.select("text").mapInArrow(heavy, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    found = [r["piece"] for r in counts.orderBy(F.desc("n"), "piece").limit(table_size).select("piece").collect()]
    tokenizer, pattern, _, _, _ = _tools(Path(tokenizer_path).read_text(encoding="utf-8"))
    pieces = [p for p in found if pattern.fullmatch(p)]
    if not pieces:
        return {}
    return dict(zip(pieces, (len(e.ids) for e in tokenizer.encode_batch(pieces, add_special_tokens=False)), strict=True))


def count_tokens(df: DataFrame, tokenizer_path: str, limit: int = 1024, id_column: str = "doc_id", table_size: int = 65_536) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` for every row."""
    context = df.sparkSession.sparkContext
    shared = context.broadcast(frequent_lengths(df, tokenizer_path, table_size))
    vocabulary = context.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))
    kind = df.schema[id_column].dataType.simpleString()

    def make():
        tokenizer, pattern, unsafe, added, cache = _tools(vocabulary.value)
        common = shared.value

        def apply(batch: pa.RecordBatch) -> dict:
            texts = strings(batch)
            counts = [0] * len(texts)
            whole: list[int] = []
            missing: list[tuple[int, list[str]]] = []
            for i, text in enumerate(texts):
                if unsafe.search(text) or any(a in text for a in added):
                    whole.append(i)
                    continue
                pieces = pattern.findall(text)
                found = [common.get(p) for p in pieces]
                if None in found:
                    rest = [p for p, n in zip(pieces, found, strict=True) if n is None]
                    found = [n for n in found if n is not None]
                    missing.append((i, rest))
                counts[i] = sum(found)
            unknown = list({p for _, rest in missing for p in rest if p not in cache})
            fresh = dict(zip(unknown, (len(e.ids) for e in tokenizer.encode_batch(unknown, add_special_tokens=False)), strict=True)) if unknown else {}
            for i, rest in missing:
                counts[i] += sum(fresh[p] if p in fresh else cache[p] for p in rest)
            if len(cache) + len(fresh) > CACHE_ENTRIES:
                cache.clear()
            cache.update((p, n) for p, n in fresh.items() if len(p) <= MAX_CACHED_CHARS)
            for i in whole:
                counts[i] = len(tokenizer.encode(texts[i], add_special_tokens=False).ids)
            return {"id": batch.column("id"), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts, "over_limit": [n > limit for n in counts]}

        return apply

    out = arrow_map(df.select(F.col(id_column).alias("id"), "text"), f"id {kind}, n_bytes long, n_tokens long, over_limit boolean", make)
    return out.withColumnRenamed("id", id_column)
