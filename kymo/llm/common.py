"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kymo.session import ship

#: ASCII white space of the contracts, ``[\x20\x09-\x0D]``; ``bytes.split()`` splits on exactly these.
SPACE = b" \t\n\r\x0b\x0c"

#: Rows and bytes handed to one Python call, so that very long texts do not pile up in a worker.
CHUNK_ROWS, CHUNK_BYTES = 512, 8 << 20
#: Bits of the filter that tells rows whose key may be wanted; 8 MB as a broadcast.
FILTER_BITS = 1 << 26
#: Most keys that ``heavy_join`` broadcasts.
HEAVY_KEYS = 8192


def arrow_map(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], dict]]) -> DataFrame:
    """``mapInArrow`` in chunks; ``make`` builds the per-task function from a batch to columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship(df.sparkSession)
    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for start, rows in chunks(batch):
                columns = apply(batch.slice(start, rows))
                arrays = [as_array(columns[f.name], f.type) for f in target]
                if arrays and len(arrays[0]):
                    yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """``(start, rows)`` of slices with ``CHUNK_ROWS`` rows and ``CHUNK_BYTES`` of strings at most; a longer row stands alone."""
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = int(np.searchsorted(ends, before + CHUNK_BYTES, side="right"))
        rows = min(max(stop - start, 1), CHUNK_ROWS)
        yield start, rows
        start += rows


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column as UTF-8 bytes, null as empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return ["" if x is None else x for x in batch.column(column).to_pylist()]


def row_numbers(df: DataFrame, groups: list[str], order: list[Column], bucket: Column, measure: Column, out: str) -> DataFrame:
    """Exclusive running sum of ``measure`` per group without putting a group into one task.

    Rows of a group are first ordered by ``bucket`` (many per group), then by
    ``order`` inside it: bucket sums are summed over a small table, rows only
    within their bucket.
    """
    from pyspark.sql import Window

    keyed = df.withColumn("_bucket", bucket).withColumn("_measure", measure)
    sums = keyed.groupBy(*groups, "_bucket").agg(F.sum("_measure").alias("_sum"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*groups, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = keyed.withColumn("_inside", F.coalesce(F.sum("_measure").over(inside), F.lit(0)))
    match = [ranked[c].eqNullSafe(starts[c]) for c in [*groups, "_bucket"]]
    cond = match[0]
    for m in match[1:]:
        cond = cond & m
    joined = ranked.join(starts, cond, "left")
    keep = [ranked[c] for c in ranked.columns if c not in ("_bucket", "_measure", "_inside")]
    return joined.select(*keep, (ranked["_inside"] + starts["_start"]).cast("long").alias(out))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that an operator's own results replace."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def maybe_wanted(df: DataFrame, key: Column, wanted: DataFrame, out: str) -> DataFrame:
    """``df`` with a boolean ``out``: false where ``key`` (a long) is surely not among the rows of ``wanted``, of one column.

    A bitmap of hashed keys, of ``FILTER_BITS / 8`` bytes at most, in place of a
    shuffle of ``df``; keys that share a bit with a wanted one are true as well.
    """
    at, bucket, bit, bits = (fresh(df, x) for x in ("_at", "_bucket", "_bit", "_bits"))
    place = F.pmod(F.xxhash64(F.col(wanted.columns[0]).cast("long")), F.lit(FILTER_BITS))
    maps = wanted.select(F.bitmap_bucket_number(place).alias(bucket), F.bitmap_bit_position(place).alias(bit)).groupBy(bucket).agg(F.bitmap_construct_agg(bit).alias(bits))
    keyed = df.withColumn(at, F.pmod(F.xxhash64(key.cast("long")), F.lit(FILTER_BITS))).withColumn(bucket, F.bitmap_bucket_number(at)).withColumn(bit, F.bitmap_bit_position(at))
    joined = keyed.join(F.broadcast(maps), bucket, "left")
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(F.col(bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    hit = F.coalesce(F.getbit(byte, (F.col(bit) % 8).cast("int")) == 1, F.lit(False))
    return joined.withColumn(out, hit).select(*[keyed[c] for c in df.columns], out)


def heavy_join(big: DataFrame, small: DataFrame, keys: list[str], rows: str, total: int) -> DataFrame:
    """``big`` joined to ``small``, which has one row a key and counts the key's rows in ``big`` in ``rows``.

    Keys with more than ``total / HEAVY_KEYS`` of the ``total`` rows, which are at
    most ``HEAVY_KEYS``, are broadcast, so that their rows stay where they are;
    only the others shuffle.
    """
    limit = max(1024, total // HEAVY_KEYS)
    heavy = small.where(F.col(rows) > limit)
    marked = big.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return big.join(F.broadcast(heavy), keys).unionByName(marked.join(small.where(F.col(rows) <= limit), keys))


def small(df: DataFrame, rows: int = 1 << 17) -> DataFrame:
    """``df``, to be broadcast if it has at most ``rows`` rows (of some 100 bytes at most); the other side then stays where it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift-multiply), so that sums of hashes spread well."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
