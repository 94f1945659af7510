"""Secret scan with a trigram inverted index.

``trigram_query`` derives from each rule's regular expression a Boolean query
over trigrams that every match must satisfy.  Texts are indexed in blocks: the
postings of the trigrams that any rule asks for, over ASCII-lower-cased text.
Intersecting and uniting postings gives the candidates of a rule, and only
those are verified with the expression itself; a rule without mandatory
trigrams scans every text.  Blocks live in the worker, so nothing shuffles.

Defined cases: null text counts as empty; an empty table gives no rows;
repeated rows count each; texts are scanned whole, whatever their length.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import arrow_map, strings

ALL = ("all",)
#: Sets of strings larger than this are not enumerated in a query.
MAX_STRINGS = 32


@dataclass(frozen=True)
class Rule:
    """A kind of secret; a match counts if ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: Fixed values. In ``hex``, runs shorter than 24 would be dropped anyway; the expression leaves them out.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, base=True),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24, base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{24,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


def _both(a: tuple, b: tuple) -> tuple:
    return b if a == ALL else a if b == ALL else ("and", a, b)


def _strings_query(found: set[str]) -> tuple:
    """What a text must hold if it holds one of these strings."""
    if not found or min(map(len, found)) < 3:
        return ALL
    options = []
    for s in sorted(found):
        grams = sorted({s[i : i + 3] for i in range(len(s) - 2)})
        options.append(("and", *[("gram", g) for g in grams]) if len(grams) > 1 else ("gram", grams[0]))
    return ("or", *options) if len(options) > 1 else options[0]


def _exact(op, arg) -> set[str] | None:
    """All strings that a node matches, lower-cased, if they are few."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()} if arg < 128 else None
    if name == "IN":
        found: set[str] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL" and value < 128:
                found.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] < 128 and value[1] - value[0] < MAX_STRINGS:
                found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return found if len(found) <= MAX_STRINGS // 4 else None
    if name == "SUBPATTERN":
        return _exact_sequence(arg[3])
    if name == "BRANCH":
        parts = [_exact_sequence(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if name == "MAX_REPEAT" and arg[1] != re._constants.MAXREPEAT and arg[1] <= 4:
        one = _exact_sequence(arg[2])
        if one is None:
            return None
        found, power = ({""} if arg[0] == 0 else set()), {""}
        for k in range(1, arg[1] + 1):
            power = {a + b for a in power for b in one}
            if len(power) > MAX_STRINGS:
                return None
            found |= power if k >= arg[0] else set()
        return found
    if name in ("AT", "ASSERT", "ASSERT_NOT"):
        return {""}
    return None


def _exact_sequence(nodes) -> set[str] | None:
    found = {""}
    for op, arg in nodes:
        one = _exact(op, arg)
        if one is None:
            return None
        found = {a + b for a in found for b in one}
        if len(found) > MAX_STRINGS:
            return None
    return found


def _sequence_query(nodes) -> tuple:
    query, run = ALL, {""}
    for op, arg in nodes:
        one = _exact(op, arg)
        joined = None if one is None else {a + b for a in run for b in one}
        if joined is not None and len(joined) <= MAX_STRINGS:
            run = joined
            continue
        query, run = _both(query, _strings_query(run)), one or {""}
        if one is None:
            query = _both(query, _node_query(op, arg))
    return _both(query, _strings_query(run))


def _node_query(op, arg) -> tuple:
    name = str(op)
    if name == "SUBPATTERN":
        return _sequence_query(arg[3])
    if name == "BRANCH":
        parts = [_sequence_query(x) for x in arg[1]]
        return ALL if ALL in parts else ("or", *parts)
    if name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] >= 1:
        return _sequence_query(arg[2])
    return ALL


def trigram_query(pattern: str) -> tuple:
    """A Boolean query that every text with a match satisfies; ``ALL`` if no trigram is mandatory."""
    return _sequence_query(re._parser.parse(pattern, re.ASCII))


def grams_of(query: tuple) -> set[str]:
    return {query[1]} if query[0] == "gram" else set().union(*(grams_of(q) for q in query[1:])) if query[0] in ("and", "or") else set()


class BlockIndex:
    """Postings of the wanted trigrams over a block of texts."""

    def __init__(self, wanted: list[str]):
        self.wanted = wanted
        self.table = np.zeros(1 << 24, dtype=np.uint16)
        for k, g in enumerate(wanted, 1):
            a, b, c = g.encode()
            self.table[a << 16 | b << 8 | c] = k

    def postings(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        n = len(texts)
        found = np.zeros((len(self.wanted) + 1, n), dtype=bool)
        ends = np.cumsum([len(t) + 1 for t in texts])
        raw = np.frombuffer(b"\0".join(texts).lower(), dtype=np.uint8)
        for lo in range(0, max(len(raw) - 2, 0), 1 << 22):  # bounded scratch, two bytes of overlap
            part = raw[lo : lo + (1 << 22) + 2].astype(np.uint32)
            hit = self.table[part[:-2] << 16 | part[1:-1] << 8 | part[2:]]
            at = np.flatnonzero(hit)
            found[hit[at], np.searchsorted(ends, at + lo, side="right")] = True
        return {g: found[k] for k, g in enumerate(self.wanted, 1)}


def candidates(query: tuple, postings: dict[str, np.ndarray], n: int) -> np.ndarray:
    if query == ALL:
        return np.ones(n, dtype=bool)
    if query[0] == "gram":
        return postings[query[1]]
    parts = [candidates(q, postings, n) for q in query[1:]]
    return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)


def scan(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id") -> DataFrame:
    """``id, spans array<struct<kind, start, end>>`` (code points, end exclusive) ordered by start, then rule."""
    return _scan(df, rules, id_column, f"id {df.schema[id_column].dataType.simpleString()}, spans array<struct<kind:string,start:long,end:long>>", lambda spans: {"spans": [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in spans]})


def digest(df: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a hash of the base spans, and all spans as a string."""
    base = [r.kind for r in rules if r.base]

    def columns(spans: list[list[tuple[str, int, int]]]) -> dict:
        joined = [[",".join(f"{k}:{a}:{b}" for k, a, b in x if every or k in base) for x in spans] for every in (False, True)]
        out = {f"n_{kind}": [sum(k == kind for k, _, _ in x) for x in spans] for kind in base}
        return out | {"base_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in joined[0]], "spans": joined[1]}

    counts = "".join(f", n_{kind} long" for kind in base)
    return _scan(df, rules, id_column, f"id {df.schema[id_column].dataType.simpleString()}{counts}, base_sha256 string, spans string", columns).withColumnRenamed("id", id_column)


def _scan(df: DataFrame, rules: tuple[Rule, ...], id_column: str, schema: str, columns) -> DataFrame:
    def make():
        queries = [trigram_query(r.pattern) for r in rules]
        compiled = [re.compile(r.pattern, re.ASCII) for r in rules]
        index = BlockIndex(sorted(set().union(*map(grams_of, queries))))

        def apply(batch: pa.RecordBatch) -> dict:
            texts = strings(batch)
            postings = index.postings([t.encode() for t in texts])
            spans: list[list] = [[] for _ in texts]
            for k, rule in enumerate(rules):
                for i in np.flatnonzero(candidates(queries[k], postings, len(texts))):
                    for m in compiled[k].finditer(texts[i]):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            spans[i].append((m.start(), k, m.end()))
            ordered = [[(rules[k].kind, a, b) for a, k, b in sorted(x)] for x in spans]
            return {"id": batch.column("id")} | columns(ordered)

        return apply

    return arrow_map(df.select(F.col(id_column).alias("id"), "text"), schema, make)
