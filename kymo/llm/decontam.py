r"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds the word sequences of benchmark items.  A document's words
are streamed through it; the state tells the longest stretch of items that ends
at each word.  A stretch of ``window`` words or more (or a whole shorter item)
marks its words as hit, and the states on the suffix path name the items.

Words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased.  Items
are dealt to blocks of about ``block_words`` words (an item is never split).
One block, the usual case, is sent out and every document streamed through its
automaton where it is.  Of more blocks, one at a time is fetched, sent out and
streamed; only texts with hits are written, and only rows with such texts are
joined to them, so that neither the driver nor a worker holds two blocks.  A
worker builds a block's automaton once, not once a task.

Defined cases: null text has no words; items without words match nothing;
equal items are all named, equal ids once, a null item id as ``''``; very long
texts are streamed whole; repeated rows count each; columns named like a result
are replaced; an empty benchmark hits nothing; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import arrow_map, fresh, maybe_wanted, strings, without
from kymo.session import cut

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: The same words in a text whose letters are as written.
RAW_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def fold(text: str) -> str:
    """A-Z lower-cased, nothing else."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the items of every state's strings."""

    def __init__(self, items: Iterable[tuple[str, list[str]]], window: int):
        self.window = window
        self.words: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[int]] = [[]]
        self.names: list[str] = []
        shorts: list[tuple[int, int]] = []
        for name, words in items:
            if not words:
                continue
            item, state = len(self.names), 0
            self.names.append(name)
            for w in words:
                state = self._extend(state, self.words.setdefault(w, len(self.words)))
                while len(ends) < len(self.next):
                    ends.append([])
                ends[state].append(item)
            if len(words) < window:
                shorts.append((state, item))
        while len(ends) < len(self.next):
            ends.append([])
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        # only states that hold a window itself are asked for items: nothing is gathered below them
        found: list[set[int]] = [set(x) for x in ends]
        for v in reversed(order):
            if self.length[self.link[v]] >= window:
                found[self.link[v]] |= found[v]
        #: For a state with strings of ``window`` words or more: the state on its suffix path that holds the window itself.
        self.at_window = [-1] * len(self.next)
        #: Shorter items that end where a string of the state ends: (words, item).
        self.short: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for v in order:
            up = self.link[v]
            if self.length[v] >= window:
                self.at_window[v] = self.at_window[up] if self.length[up] >= window else v
        for state, item in shorts:
            self.short[state].append((self.length[state], item))
        for v in order:
            self.short[v] = self.short[v] + self.short[self.link[v]]
        self.items = {v: frozenset(found[v]) for v in order if self.at_window[v] == v}

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, q, c)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return cur

    def _clone(self, p: int, q: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def stream(self, words: list[str]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit stretches ``(first word, end)`` and the items whose windows occur."""
        nxt, link, length, window, at_window, short = self.next, self.link, self.length, self.window, self.at_window, self.short
        number = self.words.get
        hits: list[tuple[int, int]] = []
        items: set[int] = set()
        state = matched = 0
        for i, w in enumerate(words, 1):
            c = number(w)
            if c is None:
                state = matched = 0
                continue
            step = nxt[state].get(c)
            while step is None and state:
                state = link[state]
                matched = length[state]
                step = nxt[state].get(c)
            if step is None:
                continue
            state = step
            matched += 1
            if matched >= window:
                hits.append((i - window, i))
                items |= self.items[at_window[state]]
            if short[state]:
                for n, item in short[state]:
                    if n <= matched:
                        hits.append((i - n, i))
                        items.add(item)
        return hits, items


#: The automaton of the last block that this worker process met.
_LATEST: dict[tuple[str, int], SuffixAutomaton] = {}


def _automaton(name: str, shared, window: int) -> SuffixAutomaton:
    if (name, window) not in _LATEST:
        _LATEST.clear()
        _LATEST[name, window] = SuffixAutomaton(shared.value, window)
    return _LATEST[name, window]


def _items(benchmark: DataFrame, block_words: int, id_column: str) -> tuple[DataFrame, int]:
    """``block, name, text`` of the distinct items, and the number of blocks."""
    rows = benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("name"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    n_words = F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    total = rows.agg(F.coalesce(F.sum(n_words), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_words))
    placed = rows.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks)))
    return (cut(placed, "items") if blocks > 1 else placed), blocks


def _fetch(items: DataFrame) -> list[tuple[str, list[str]]]:
    """The items of one block as word lists, in a fixed order."""
    rows = items.select("name", "text").collect()  # about block_words words
    return sorted((r["name"], WORD.findall(fold(r["text"]))) for r in rows)


def _hits(df: DataFrame, names: list[str], key: str, found: tuple[str, str, str], shared, window: int) -> DataFrame:
    """The columns ``names`` of ``df`` with the words, items and hit stretches of each text."""
    n_words, items, hits = found
    block = uuid.uuid4().hex
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in names)
    schema = ", ".join(x for x in (schema, f"`{n_words}` long, `{items}` array<string>, `{hits}` array<int>") if x)

    def make():
        automaton = _automaton(block, shared, window)

        def apply(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {n_words: [], items: [], hits: []}
            for text in strings(batch, key):
                words = WORD.findall(fold(text))
                spans, named = automaton.stream(words)
                out[n_words].append(len(words))
                out[items].append(sorted({automaton.names[k] for k in named}))
                out[hits].append(_joined(spans))
            return {n: batch.column(n) for n in names} | out

        return apply

    return arrow_map(df, schema, make)


def _hits_by_block(df: DataFrame, names: list[str], found: tuple[str, str, str], items: DataFrame, blocks: int, window: int) -> DataFrame:
    """What ``_hits`` gives, from one pass a block."""
    spark = df.sparkSession
    texts = df.select(F.xxhash64("text").alias("h"), F.md5(F.col("text").cast("binary")).alias("m"), "text")
    parts = None
    for block in range(blocks):
        shared = spark.sparkContext.broadcast(_fetch(items.where(F.col("block") == block)))
        part = _hits(texts, ["h", "m"], "text", ("n", "i", "s"), shared, window).where(F.size("s") > 0).select("h", "m", "i", "s").distinct()
        part = cut(part, f"block{block}")
        shared.unpersist()
        parts = part if parts is None else parts.unionByName(part)
    n_words, named, hits = found
    each = parts.groupBy("h", "m").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("i")))).alias(named), F.flatten(F.collect_list("s")).alias(hits))
    each = cut(each, "hits")
    h, m, near = (fresh(df, x) for x in ("_h", "_m", "_near"))
    keyed = maybe_wanted(df.withColumn(h, F.xxhash64("text")).withColumn(m, F.md5(F.col("text").cast("binary"))), F.col(h), each.select("h"), near)
    joined = keyed.where(near).join(each, (F.col(h) == each["h"]) & (F.col(m) == each["m"]), "left").select(*names, named, hits)
    rest = keyed.where(~F.col(near)).select(*names, F.lit(None).cast("array<string>").alias(named), F.lit(None).cast("array<int>").alias(hits))
    every = joined.unionByName(rest)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in every.schema) + f", `{n_words}` long"

    def unite():
        def apply(batch: pa.RecordBatch) -> dict:
            spans = [_joined([*zip(*[iter(s or ())] * 2, strict=True)]) for s in batch.column(hits).to_pylist()]
            kept = {n: batch.column(n) for n in names} | {named: [x or [] for x in batch.column(named).to_pylist()]}
            return kept | {hits: spans, n_words: [len(WORD.findall(fold(t))) for t in strings(batch)]}

        return apply

    return arrow_map(every, schema, unite)


def scan(df: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = 2_000_000, coverage_limit: float = 0.0, cut_text: bool = False, id_column: str = "item_id") -> DataFrame:
    """``df`` with ``n_words, n_hit, items, contaminated, over_limit``.

    ``over_limit``: more than ``coverage_limit`` of the words are hit.  With
    ``cut_text`` the hit stretches leave the text.
    """
    df = without(df, "n_words", "n_hit", "items", "contaminated", "over_limit")
    names = list(df.columns)
    found = ("n_words", "items", fresh(df, "_hits"))
    items, blocks = _items(benchmark, block_words, id_column)
    if blocks == 1:
        shared = df.sparkSession.sparkContext.broadcast(_fetch(items))
        out = _hits(df, names, "text", found, shared, window)
    else:
        out = _hits_by_block(df, names, found, items, blocks, window)
    hits = found[2]
    if cut_text:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)

        def cutter():
            def apply(batch: pa.RecordBatch) -> dict:
                pairs = zip(batch.column("text").to_pylist(), batch.column(hits).to_pylist(), strict=True)
                return {n: batch.column(n) for n in batch.schema.names} | {"text": [cut_out(t, h) if h else t for t, h in pairs]}

            return apply

        out = arrow_map(out, schema, cutter)
    hit = F.aggregate(hits, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).alias("sign")), lambda a, x: F.struct((a["sum"] + a["sign"] * x).alias("sum"), (-a["sign"]).alias("sign")))["sum"]
    return out.select(*names, "n_words", hit.alias("n_hit"), "items").select(
        "*", (F.col("n_hit") > 0).alias("contaminated"), (F.col("n_hit") > coverage_limit * F.greatest("n_words", F.lit(1))).alias("over_limit")
    )


def _joined(spans: list[tuple[int, int]]) -> list[int]:
    """Spans united and flattened."""
    flat: list[int] = []
    for a, b in sorted(spans):
        if flat and a <= flat[-1]:
            flat[-1] = max(flat[-1], b)
        else:
            flat += [a, b]
    return flat


def cut_out(text: str, hits: list[int]) -> str:
    """The text without the characters from the first to the last word of each hit stretch."""
    at = [m.span() for m in RAW_WORD.finditer(text)]
    out, last = [], 0
    for a, b in zip(*[iter(hits)] * 2, strict=True):
        out.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return "".join([*out, text[last:]])


def digest(scanned: DataFrame, id_column: str = "doc_id") -> DataFrame:
    items = F.array_join("items", ",")
    return scanned.select(id_column, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(items.cast("binary"), 256).alias("items_sha256"), "contaminated")
