r"""Removal of lines that many documents share, by way of two Bloom filters.

Pass one hashes each document's distinct line keys; the bits of the filters
"seen" and "seen twice" are dealt to tasks by slice and merged there.  The
filters have eight bits for every line of the input, in as many slices as that
takes.  What leaves the slices is the second filter alone, folded to the size
that its set bits need (``max_bits`` at most) and sent to all workers.  Pass two
shuffles only keys whose bits are all set in it: exact counts of documents and
the first occurrence come from those.  Pass three drops the lines.  A filter
folded too far lets more keys through to the exact count, no fewer.

Dropped keys, if they are few (``broadcast_keys``, checked), go to all workers
and lines are tested where they are; if not, rows with such lines, told by a
bitmap, are joined to them and all others stay where they are.

With ``long_words``, lines of more words than that are repeats from two
documents on.  Near copies of each other are not told apart there: a long line
counts by groups of near copies among the documents that share one, and stays
in the first group, for near-duplicate removal to reduce whole.  A near copy
that loses a long line goes at once, as it might be found alike no more.

A line's key is the line without white space ``[\x20\x09-\x0D]`` at its ends,
A-Z lower-cased; keys are compared by 128-bit hashes.

Defined cases: null or empty text is one empty line; an empty key is never
dropped; each row counts as one document (repeated rows each, a null id too);
the first document of a line is the one of smallest id, nulls last, and among
rows of one id the one of smallest hash, so that a line stays in one row only,
but for rows equal in id and text, which stay alike; very long texts are split
whole; columns named ``n_lines`` or ``n_dropped`` are replaced by the results;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm import neardup
from kymo.llm.common import SPACE, arrow_map, fresh, heavy_join, maybe_wanted, small, utf8, without
from kymo.session import cut, gathered, ship

#: Fewest slices in which the filters are merged, most bits of a slice, and bits set per key.
SLICES, SLICE_BITS = 64, 1 << 27
HASHES = 2
#: Bits of the filters for each line, and most bits of the second one when it is sent out (64 MB).
LINE_BITS, MAX_BITS = 8, 1 << 29
#: Most dropped keys that are sent to all workers (24 bytes each).
BROADCAST_KEYS = 1 << 18


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def _keys(text: bytes, least: int) -> list[bytes]:
    """Distinct keys of a text, of ``least`` code points or more."""
    keys = {line_key(x) for x in text.split(b"\n")}
    return [k for k in keys if len(k) >= least and (least <= 1 or len(k.decode()) >= least)]


def _key_hashes(text: bytes, least: int) -> list[bytes]:
    """128-bit hashes of the keys of a text."""
    return [xxhash.xxh3_128_digest(k) for k in _keys(text, least)]


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Filter bits of 128-bit hashes given as rows of two uint64."""
    return np.stack([(hashes[:, k] >> np.uint64(7)) % np.uint64(bits) for k in range(HASHES)], axis=1).astype(np.int64)


def _as_rows(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)


def _power(n: int, least: int) -> int:
    return max(least, 1 << max(n - 1, 1).bit_length())


def seen_twice(df: DataFrame, least: int, filter_bits: int | None = None, max_bits: int = MAX_BITS) -> tuple[np.ndarray, int]:
    """The second filter as packed bits and its size, folded to what its set bits need; ``max_bits / 8`` bytes at most reach the driver."""
    ship(df.sparkSession)
    if filter_bits is None:
        lines = df.agg(F.coalesce(F.sum(F.regexp_count("text", F.lit("\n")) + 1), F.lit(0))).first()[0]
        filter_bits = _power(LINE_BITS * lines, 1 << 20)
    slices = max(min(SLICES, filter_bits // 8), filter_bits // SLICE_BITS)
    width = filter_bits // slices

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = np.empty(0, dtype=np.int64)
        twice: list[np.ndarray] = []
        found: list[bytes] = []

        def fold(once: np.ndarray) -> np.ndarray:
            if not found:
                return once
            rows, counts = _distinct(_as_rows(found))
            at = np.unique(_positions(rows, filter_bits))
            twice.append(np.unique(_positions(rows[counts > 1], filter_bits)))
            twice.append(np.intersect1d(once, at, assume_unique=True))
            found.clear()
            return np.union1d(once, at)

        for batch in batches:
            for text in utf8(batch):
                found.extend(_key_hashes(text, least))
                if len(found) > 1 << 19:
                    once = fold(once)
        once = fold(once)
        again = np.unique(np.concatenate(twice)) if twice else once
        for k in np.unique(once // width).tolist():
            parts = [x[np.searchsorted(x, k * width) : np.searchsorted(x, (k + 1) * width)] - k * width for x in (once, again)]
            yield pa.RecordBatch.from_pydict({"slice": [k], "once": [parts[0].astype("<u4").tobytes()], "twice": [parts[1].astype("<u4").tobytes()]}, schema=schema)

    schema = pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices come one after the other, so that one pair of filters is held at a time."""
        k, first, second = None, np.zeros(width, dtype=bool), np.zeros(width, dtype=bool)

        def done() -> Iterator[pa.RecordBatch]:
            at = np.flatnonzero(second) + (k or 0) * width
            for start in range(0, len(at), 1 << 16):
                yield pa.RecordBatch.from_pydict({"at": at[start : start + (1 << 16)]}, schema=pa.schema([("at", pa.int64())]))

        for batch in batches:
            for slice_, once, twice in zip(*(batch.column(c).to_pylist() for c in ("slice", "once", "twice")), strict=True):
                if slice_ != k:
                    yield from done()
                    k, first[:], second[:] = slice_, False, False
                at = np.frombuffer(once, dtype="<u4")
                second[at[first[at]]] = True
                first[at] = True
                second[np.frombuffer(twice, dtype="<u4")] = True
        yield from done()

    parts = df.select("text").mapInArrow(local, "slice int, once binary, twice binary")
    merged = parts.repartition(slices, "slice").sortWithinPartitions("slice").mapInArrow(merge, "at long")
    merged = cut(gathered(merged, HASHES * filter_bits // LINE_BITS, 8), "twice")
    size = min(filter_bits, max_bits, _power(LINE_BITS * merged.count(), 1 << 16))
    folded = F.pmod("at", F.lit(size)) + 1  # the functions below number from one
    maps = merged.select(F.bitmap_bucket_number(folded).alias("bucket"), F.bitmap_bit_position(folded).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    packed = np.zeros(max(size, 1 << 15) // 8, dtype=np.uint8)
    for row in maps.toLocalIterator():  # buckets of 2**15 bits, numbered from one; size / 8 bytes in all
        at = (row["bucket"] - 1) * 4096
        packed[at : at + 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    return packed, size


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of two uint64 and their counts."""
    order = np.lexsort((rows[:, 1], rows[:, 0]))
    rows = rows[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    return rows[at], np.diff(np.append(at, len(rows)))


def _keyed(df: DataFrame, id_column: str) -> DataFrame:
    """``id, row, text``: ``row`` orders the rows, by id with null last, then by a hash of id and text."""
    own = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.xxhash64(F.col(id_column), F.col("text")).alias("hash"))
    return df.select(own.alias("row"), "text")


def suspected(df: DataFrame, least: int, id_column: str = "doc_id", long_words: int | None = None, filter_bits: int | None = None, max_bits: int = MAX_BITS) -> DataFrame:
    """``row, k1, k2, long``: the occurrences of keys that the second filter knows; keys of more than ``long_words`` words are ``long``."""
    packed, bits = seen_twice(df, least, filter_bits, max_bits)
    shared = df.sparkSession.sparkContext.broadcast(packed)
    rows = _keyed(df, id_column)
    kind = rows.schema["row"].dataType.simpleString()

    def make():
        known_bits = shared.value

        def apply(batch: pa.RecordBatch) -> dict:
            digests, owner, wide = [], [], []
            for i, text in enumerate(utf8(batch)):
                found = _keys(text, least)
                digests += [xxhash.xxh3_128_digest(k) for k in found]
                owner += [i] * len(found)
                wide += [long_words is not None and len(k.split()) > long_words for k in found]
            if not digests:
                return {"row": pa.array([], type=batch.column("row").type), "k1": [], "k2": [], "long": []}
            hashes = _as_rows(digests)
            at = _positions(hashes, bits)
            known = ((known_bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)
            hashes = hashes[known].view(np.int64)
            return {"row": batch.column("row").take(pa.array(np.asarray(owner)[known])), "k1": pa.array(hashes[:, 0]), "k2": pa.array(hashes[:, 1]), "long": pa.array(np.asarray(wide)[known])}

        return apply

    return arrow_map(rows, f"row {kind}, k1 long, k2 long, long boolean", make)


def long_repeats(df: DataFrame, suspects: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``row, k1, k2, first, copy`` of the long keys found in two groups of near copies or more.

    ``first`` says that the row is of the first group, ``copy`` that it is of
    another one and not the row its group is reduced to.
    """
    long = suspects.where("long").select("row", "k1", "k2")
    counts = long.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    n_suspects = suspects.count()
    shared = cut(gathered(heavy_join(long, counts, ["k1", "k2"], "n", n_suspects).drop("n"), n_suspects), "long")
    n_shared = shared.count()
    owners = cut(gathered(shared.select(F.col("row.hash").alias("h")).distinct(), n_shared), "owners")
    texts = maybe_wanted(_keyed(df, id_column), F.col("row.hash"), owners, "near").where("near").join(small(owners), F.col("row.hash") == F.col("h"), "left_semi").select("row", "text")
    alike = neardup.link(texts, id_column="row").groupBy("row").agg(F.min("component_id").alias("group"), F.max("kept").alias("kept"))
    placed = cut(gathered(shared.join(alike, "row").select("row", "k1", "k2", "group", "kept"), n_shared), "placed")
    spread = placed.groupBy("k1", "k2").agg(F.min("group").alias("first_group"), F.max("group").alias("last_group"), F.count(F.lit(1)).alias("n")).where("first_group < last_group").drop("last_group")
    first = F.col("group") == F.col("first_group")
    return heavy_join(placed, spread, ["k1", "k2"], "n", n_shared).select("row", "k1", "k2", first.alias("first"), (~first & ~F.col("kept")).alias("copy"))


def drop_lines(df: DataFrame, min_docs: int = 10, least: int = 1, filter_bits: int | None = None, keep_first: bool = False, id_column: str = "doc_id", long_words: int | None = None, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """``df`` with ``text`` freed of repeated lines, and ``n_lines, n_dropped``.

    ``keep_first`` spares the first line with a key in the first document (by id) that has it.
    ``long_words`` makes lines of more words repeats from two documents on; they stay where they come first.
    ``filter_bits`` (a power of two) fixes the size of the filters.
    """
    df = without(df, "n_lines", "n_dropped")
    suspects = cut(suspected(df, least, id_column, long_words, filter_bits), "suspects")
    n_suspects = suspects.count()
    exact = suspects.where("NOT long").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs"), F.min("row").alias("first_row")).where(F.col("n_docs") >= min_docs)
    exact = exact.withColumn("first_hash", F.col("first_row.hash") if keep_first else F.lit(None).cast("long")).drop("first_row")
    exact = cut(gathered(exact, n_suspects // max(min_docs, 1)), "exact")
    names = [f.name for f in df.schema]
    key, drop = fresh(df, "_row"), fresh(df, "_drop")
    rows = df.withColumn(key, F.xxhash64(F.col(id_column), F.col("text")))
    few = exact.limit(broadcast_keys + 1).count() <= broadcast_keys
    marks = None
    if long_words is not None:
        marks = long_repeats(df, suspects, id_column)
    if not few:
        found = heavy_join(suspects.where("NOT long").select("row", "k1", "k2"), exact, ["k1", "k2"], "n_docs", n_suspects)
        found = found.select("row", "k1", "k2", F.col("first_hash").eqNullSafe(F.col("row.hash")).alias("first"), F.lit(False).alias("copy"))
        marks = found if marks is None else marks.unionByName(found)
    kind = "array<struct<k1:bigint,k2:bigint,first:boolean>>"
    if marks is None:
        rows = rows.withColumn(drop, F.lit(None).cast(kind))
    else:
        h, i, copy, near = (fresh(rows, x) for x in ("_h", "_i", "_copy", "_near"))
        each = marks.groupBy(F.col("row.hash").alias(h), F.col("row.id").alias(i)).agg(F.collect_set(F.struct("k1", "k2", "first")).alias(drop), F.max("copy").alias(copy))
        each = cut(gathered(each, n_suspects), "marks")
        marked = maybe_wanted(rows, F.col(key), each.select(h), near)
        joined = marked.where(near).join(small(each), (F.col(key) == F.col(h)) & F.col(id_column).eqNullSafe(F.col(i)), "left").where(~F.coalesce(F.col(copy), F.lit(False)))
        rows = joined.select(*rows.columns, drop).unionByName(marked.where(~F.col(near)).select(*rows.columns, F.lit(None).cast(kind).alias(drop)))
    shared = None
    if few:
        # broadcast_keys rows at most, as columns: rows would take the driver several times that
        table = exact.select("k1", "k2", F.coalesce("first_hash", F.lit(0).cast("long")).alias("first")).toArrow()
        shared = df.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("k1", "k2", "first")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", n_lines long, n_dropped long"

    def make():
        dropped = {} if shared is None else dict(zip(zip(*(x.tolist() for x in shared.value[:2]), strict=True), shared.value[2].tolist(), strict=True))

        def apply(batch: pa.RecordBatch) -> dict:
            texts, total, gone = [], [], []
            for text, own, own_drop in zip(utf8(batch), batch.column(key).to_pylist(), batch.column(drop).to_pylist(), strict=True):
                lines = text.split(b"\n")
                spared = {(d["k1"], d["k2"]): d["first"] for d in own_drop or ()}
                total.append(len(lines))
                if spared or dropped:
                    kept = []
                    for line, k in zip(lines, _line_hashes(lines), strict=True):
                        if k in spared or k in dropped:
                            stays = spared[k] if k in spared else keep_first and dropped[k] == own
                            spared[k] = False
                            if not stays:
                                continue
                        kept.append(line)
                    lines = kept
                gone.append(total[-1] - len(lines))
                texts.append(b"\n".join(lines).decode())
            return {n: batch.column(n) for n in names} | {"text": texts, "n_lines": total, "n_dropped": gone}

        return apply

    return arrow_map(rows, schema, make)


def _line_hashes(lines: list[bytes]) -> list[tuple[int, int]]:
    """Key hashes of lines as two signed numbers."""
    return list(map(tuple, _as_rows([xxhash.xxh3_128_digest(line_key(x)) for x in lines]).view(np.int64).tolist()))


def digest(df: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id, n_lines, n_dropped, kept_sha256`` of what ``drop_lines`` returns."""
    return df.select(id_column, "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
