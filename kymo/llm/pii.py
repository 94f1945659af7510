r"""Personal data: patterns, and terms that give them away, with DataFrame functions only.

``detect`` finds emails, IP addresses, card and phone numbers.  A match is
marked in the text by U+0001 and the text split there, so one fold over the
parts yields code-point positions.  Expressions use possessive repeats and
look-behinds, so that no text is scanned more than once a kind.

``disclosing_terms`` then follows information-theoretic sanitisation.  Each
distinct value found is a protected entity e, each word of four letters or more
in a document that holds e, at any distance, a term t.  Over the whole corpus,
with documents as events, ``PMI(t, e) = log2(n(t, e) N / (n(t) n(e)))`` measures
how strongly t reveals e, and its share of ``-log2(n(e) / N)`` how much of e.  A
term whose share reaches ``threshold`` becomes a span of kind ``term`` wherever
it stands in a document that holds e, outside the values themselves.  No number
of documents is asked for: most values stand in one, and there a share of 0.9
means that the term is in at most ``N ** 0.1`` documents.
``sanitise`` and ``redact`` generalise such terms to ``[TERM]`` and remove the
values themselves.

Values that stand in the same documents are counted as one class, and so are
words: their figures are equal, so that a list of many values costs no pair of
each value and each word.  As ``n(t, e) <= n(e)``, only words in at most
``n(e) ** threshold * N ** (1 - threshold)`` documents can reach the threshold;
others are told by a bitmap and leave before they are paired.

Defined cases: null text counts as empty; documents without personal data get
no spans; spans that start together stand in the order of the kinds; rows are
told apart by id and text, repeated rows get equal spans and count each as a
document, for n(t), n(e) and n(t, e); words are compared by 64-bit hashes; a U+0001 in a text counts as any other control character; very long
texts are read whole; other columns are ignored (``redact`` keeps them); an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import fresh, heavy_join, maybe_wanted
from kymo.session import cut

MARK = "\x01"
#: Code points around a value that ``detect`` gives beside it; terms are looked for in the whole text.
CONTEXT = 64
#: Kind, expression (a run of its first class is entered at its start or right after a match), prefilter.
KINDS = (
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@"),
    ("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    ("card", r"(?:(?<![0-9])|\G)[0-9](?:[ -]?[0-9])++", r"[0-9]{2}|[0-9][ -][0-9]"),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]"),
)
TERM = r"\p{L}{4,}+"
_HIT = "array<struct<start:bigint,end:bigint,value:string>>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(acc: Column, c: Column) -> Column:
        v = c.cast("int") * F.when(acc["double"], 2).otherwise(1)
        return F.struct((acc["sum"] + F.when(v > 9, v - 9).otherwise(v)).alias("sum"), (~acc["double"]).alias("double"))

    seed = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("double"))
    return F.aggregate(F.split(F.reverse(digits), "(?!^)(?!$)"), seed, add)["sum"] % 10 == 0


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(x, r"\."), lambda p: F.coalesce(p.try_cast("bigint"), F.lit(999)) <= 255)
    if kind == "card":
        n = F.length(_digits(x))
        return F.when((n >= 12) & (n <= 19), _luhn(_digits(x))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return F.lit(True)


def find(text: Column, pattern: str, valid=None) -> Column:
    """``array<struct<start, end, value>>``: matches of ``pattern``."""
    return _marked(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), valid)


def _marked(text: Column, valid=None) -> Column:
    """``array<struct<start, end, value>>``: what stands between pairs of marks."""
    parts = F.split(text, MARK, -1)
    seed = F.struct(F.lit(0).cast("bigint").alias("pos"), F.lit(False).alias("hit"), F.array().cast(_HIT).alias("hits"))

    def step(acc: Column, part: Column) -> Column:
        end = acc["pos"] + F.char_length(part)
        keep = acc["hit"] & (valid(part) if valid else F.lit(True))
        match = F.struct(acc["pos"].alias("start"), end.alias("end"), part.alias("value"))
        return F.struct(end.alias("pos"), (~acc["hit"]).alias("hit"), F.when(keep, F.array_append(acc["hits"], match)).otherwise(acc["hits"]).alias("hits"))

    return F.aggregate(parts, seed, step, lambda acc: acc["hits"])


def _span(rank: int, kind: str, text: Column):
    def make(h: Column) -> Column:
        start, end = h["start"].cast("int"), h["end"].cast("int")
        before = F.substring(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT)))
        after = F.substring(text, end + 1, F.lit(CONTEXT))
        return F.struct(h["start"].alias("start"), F.lit(rank).alias("rank"), h["end"].alias("end"), F.lit(kind).alias("kind"), h["value"].alias("value"), before.alias("before"), after.alias("after"))

    return make


def detect(df: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id, text_key, n_*``, ``spans`` (start, rank, end, kind, value, before, after) by start, then kind, and, where there are any, the ``text`` of every row."""
    text = F.translate(F.coalesce("text", F.lit("")), MARK, "\x03")
    rows = df.select(F.col(id_column).alias("id"), F.xxhash64("text").alias("text_key"), text.alias("t"), F.col("text").alias("raw"))
    for kind, pattern, first in KINDS:
        found = find(F.col("t"), pattern, lambda x, kind=kind: _valid(kind, x))
        rows = rows.withColumn(kind, F.when(F.col("t").rlike(first), found))
    spans = []
    for rank, (kind, _, _) in enumerate(KINDS):
        made = F.transform(kind, _span(rank, kind, F.col("t")))
        spans.append(F.coalesce(made, F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string,before:string,after:string>>")))
    counts = [F.when(F.col(kind).isNull(), 0).otherwise(F.size(kind)).cast("long").alias(f"n_{kind}") for kind, _, _ in KINDS]
    found = rows.select("id", "text_key", *counts, F.array_sort(F.concat(*spans)).alias("spans"), "raw")
    return found.withColumn("text", F.when(F.size("spans") > 0, F.col("raw"))).drop("raw")


def _term(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def _terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TERM), F.lit(0)), _term))


def _places(text: Column, terms: Column) -> Column:
    """``array<struct<start, end, value>>``: where words of a text are among ``terms``."""
    parts = F.split(F.regexp_replace(F.translate(text, MARK, "\x03"), TERM, f"{MARK}$0{MARK}"), MARK, -1)
    marked = F.transform(parts, lambda p, k: F.when((k % 2 == 1) & F.array_contains(terms, _term(p)), F.concat(F.lit(MARK), p, F.lit(MARK))).otherwise(p))
    return _marked(F.array_join(marked, ""))


def disclosing_terms(df: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """``id, text_key, terms`` of the documents with values: the terms that reveal one of theirs beyond the threshold."""
    n_docs = float(max(df.count(), 1))
    doc, count = ["id", "text_key"], F.count(F.lit(1))
    #: Equal for what stands in the same documents.
    spread = F.struct(F.bit_xor(F.xxhash64(*doc)).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), *doc)).alias("b"))
    holders = found.where(F.size("spans") > 0)

    entity = F.explode(F.array_distinct(F.transform("spans", lambda s: F.xxhash64(s["kind"], F.lower(s["value"])))))
    held = cut(holders.select(*doc, entity.alias("entity")).groupBy(*doc, "entity").agg(count.alias("rows")), "held")
    entities = cut(held.groupBy("entity").agg(spread.alias("e"), F.sum("rows").alias("n_e"), count.alias("n")).where(F.col("n_e") < n_docs), "entities")
    most = F.col("n_e") * F.pow(F.lit(n_docs) / F.col("n_e"), F.lit(1 - threshold)) * (1 + 1e-6)  # n_t that a share of the threshold allows
    values = cut(heavy_join(held, entities, ["entity"], "n", held.count()).select(*doc, "rows", "e", "n_e", most.alias("most")).distinct(), "values")
    limit = values.agg(F.max("most")).first()[0] or 0.0

    own = holders.select(*doc, F.explode(_terms(F.col("text"))).alias("term"))
    words = df.select(F.explode(_terms(F.col("text"))).alias("term"))
    corpus = maybe_wanted(words, F.col("term"), own.select("term").distinct(), "near").where("near").groupBy("term").agg(count.alias("n_t"))
    rare = cut(corpus.where(F.col("n_t") <= limit), "rare")
    own = cut(maybe_wanted(own, F.col("term"), rare.select("term"), "near").where("near").drop("near").distinct(), "own")
    terms = cut(own.groupBy("term").agg(spread.alias("t"), count.alias("n")).join(rare, "term"), "terms")
    placed = cut(heavy_join(own, terms, ["term"], "n", own.count()).drop("n"), "placed")

    def same(a: DataFrame, b: DataFrame) -> Column:
        return (a["text_key"] == b["text_key"]) & a["id"].eqNullSafe(b["id"])

    classes = placed.select(*doc, "t", "n_t").distinct()
    pairs = cut(classes.join(values, same(classes, values) & (classes["n_t"] <= values["most"])).select(*[classes[c] for c in (*doc, "t", "n_t")], "rows", "e", "n_e"), "pairs")
    both = ["e", "n_e", "t", "n_t"]
    known = -F.log2(F.col("n_e") / F.lit(n_docs))
    pmi = F.log2(F.col("n_te") * F.lit(n_docs) / (F.col("n_t") * F.col("n_e")))
    strong = cut(pairs.groupBy(*both).agg(F.sum("rows").alias("n_te"), count.alias("n")).where(pmi / known >= threshold).select(*both, "n"), "strong")
    told = heavy_join(pairs, strong, both, "n", pairs.count()).select(*doc, "t", "n_t").distinct()
    hits = placed.join(told, same(placed, told) & (placed["t"] == told["t"]) & (placed["n_t"] == told["n_t"]), "left_semi")
    return hits.groupBy(*doc).agg(F.collect_list("term").alias("terms"))


def sanitise(df: DataFrame, threshold: float = 0.9, id_column: str = "doc_id") -> DataFrame:
    """``id, text_key, n_*, base``, ``spans`` with the disclosing terms, and ``clean`` of every row.

    ``clean`` is the text without its values and terms, null where there are none.
    """
    found = detect(df, id_column)
    found = cut(found.withColumn("spans", F.transform("spans", lambda s: s.dropFields("before", "after"))), "found")
    told = cut(disclosing_terms(df, found, threshold).select(F.col("id").alias("i"), F.col("text_key").alias("k"), "terms"), "told")
    joined = found.join(told, F.col("id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")), "left")
    joined = joined.withColumn("extra", F.when(F.col("terms").isNotNull(), _places(F.col("text"), F.col("terms"))))
    plain = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    joined = joined.select("id", "text_key", *[f"n_{k}" for k, _, _ in KINDS], "text", plain.alias("base"), F.coalesce("extra", F.array().cast(_HIT)).alias("extra"))
    free = F.filter("extra", lambda x: ~F.exists("base", lambda b: (x["start"] < b["end"]) & (x["end"] > b["start"])))
    added = F.transform(free, lambda x: F.struct(x["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), x["end"].alias("end"), F.lit("term").alias("kind")))
    done = joined.select("id", "text_key", *[f"n_{k}" for k, _, _ in KINDS], "text", "base", F.array_sort(F.concat("base", added)).alias("spans"))
    return done.withColumn("clean", F.when(F.size("spans") > 0, removed(F.col("text"), F.col("spans")))).drop("text").withColumnRenamed("id", id_column)


def removed(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind; spans inside earlier ones go with them."""
    seed = F.struct(F.lit("").alias("out"), text.alias("rest"), F.lit(0).cast("bigint").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = (s["start"] - acc["at"]).cast("int")
        inside = s["start"] < acc["at"]
        beyond = (s["end"] - acc["at"]).cast("int")
        return F.struct(
            F.when(inside, acc["out"]).otherwise(F.concat(acc["out"], F.left(acc["rest"], gap), F.lit("["), F.upper(s["kind"]), F.lit("]"))).alias("out"),
            F.when(beyond <= 0, acc["rest"]).otherwise(F.substring(acc["rest"], beyond + 1, F.lit(2**31 - 1))).alias("rest"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        )

    return F.aggregate(spans, seed, step, lambda a: F.concat(a["out"], a["rest"]))


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(done: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts, hashes and spans; ``n_terms`` are generalised, ``clean_sha256`` is that of the cleaned text, null where it is as it was."""
    n_terms = F.size(F.filter("spans", lambda s: s["kind"] == "term")).cast("long")
    return done.select(id_column, *[f"n_{k}" for k, _, _ in KINDS], F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"), n_terms.alias("n_terms"), F.sha2(F.col("clean").cast("binary"), 256).alias("clean_sha256"))


def redact(df: DataFrame, done: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``df`` with the ``clean`` text where there is one; rows without spans are not moved."""
    key, near, i, k, clean = (fresh(df, x) for x in ("_key", "_near", "_i", "_k", "_clean"))
    found = done.where(F.size("spans") > 0).groupBy(F.col(id_column).alias(i), F.col("text_key").alias(k)).agg(F.min("clean").alias(clean))
    rows = maybe_wanted(df.withColumn(key, F.xxhash64("text")), F.col(key), found.select(k), near)
    joined = rows.where(near).join(found, F.col(id_column).eqNullSafe(F.col(i)) & (F.col(key) == F.col(k)), "left")
    changed = joined.withColumn("text", F.coalesce(clean, "text")).select(*df.columns)
    return changed.unionByName(rows.where(~F.col(near)).select(*df.columns))
