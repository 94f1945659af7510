r"""Near-duplicate detection: MinHash bands, odd sketches, exact confirmation.

1.  Each document's distinct shingles become 64-bit hashes; their set gives a
    128-bit signature, ``bands`` MinHash band keys and an odd sketch.  Rows of
    equal signature are one class, whatever their ids.
2.  Classes meet in band buckets.  The sketch is the parity bitmap of a MinHash
    sample, the ``SAMPLE`` smallest hashes of the set (all of them for most
    texts).  The population count of two sketches' XOR estimates the symmetric
    difference.  Where the sketches hold both sets whole, it never exceeds the
    difference, so a pair beyond the threshold's difference is out for certain;
    pairs of larger sets are out beyond ``SIGMAS`` deviations.  Within a bucket,
    a member surely alike to a class already in hand is not compared again, so a
    bucket of copies yields a tree, not all pairs; undecided pairs are all kept.
3.  Remaining pairs are confirmed on the full sets.  Should a tree's link fail
    there, the buckets of its two classes are compared once more, without trees
    and between classes not yet connected; components follow.

A bucket larger than ``BLOCK`` members is dealt to pairs of blocks, so no task
holds an unbounded group.  With 32 bands of 4, a pair at similarity 0.8 shares
no bucket with probability 5e-8.

Words are ``[^\x20\x09-\x0D]+`` after A-Z are lower-cased.  Defined cases: null
or empty text has no shingles and is linked with nothing; fewer words than a
shingle make one shingle; every row counts, so that repeated rows are one class
and one id with two texts is in two classes; a null id is a class member but
names no component, unless all its members are null; an empty table gives no
rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymo.llm.common import arrow_map, heavy_join, maybe_wanted, mix64, utf8
from kymo.llm.components import components
from kymo.session import cut, gathered, ship

BANDS, ROWS = 32, 4
#: Bits of a sketch and size of the MinHash sample folded into it.
SKETCH_BITS, SAMPLE = 2048, 2048
SIGMAS = 6.0
BLOCK = 4096
#: Odd multipliers and offsets of the MinHash functions, from a seeded generator.
_RNG = np.random.default_rng(20240229)
_MULTIPLY = _RNG.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
#: Bytes of a class's row, most of them band keys and sketch.
CLASS_BYTES = 8 * BANDS + SKETCH_BITS // 8 + 64
#: Bound of a worker's cache of word hashes.
CACHE_WORDS = 1_000_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_hashes(text: bytes, size: int, cache: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(len(h) - size + 1, 1)
    acc = np.full(n, len(h) if len(h) < size else size, dtype=np.uint64)
    for k in range(min(size, len(h))):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(acc)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), 4096):
        part = shingles[start : start + 4096, None] * _MULTIPLY[None, :] + _ADD[None, :]
        low = np.minimum(low, part.min(axis=0))
    low = low.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + low[:, k])
    return key.view(np.int64)


def odd_sketch(shingles: np.ndarray) -> bytes:
    """Parity bitmap of the ``SAMPLE`` smallest hashes."""
    sample = mix64(shingles[:SAMPLE])
    odd = np.bincount((sample % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def sketch_verdicts(size_a: np.ndarray, size_b: np.ndarray, apart: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """From set sizes and XOR population counts: pairs that may reach ``similarity``, and pairs that surely do."""
    a, b = size_a.astype(float), size_b.astype(float)
    small, large = np.minimum(a, b), np.maximum(a, b)
    rate = np.minimum(1.0, SAMPLE / large)
    inter = similarity / (1 + similarity) * (a + b)  # intersection of a pair just at the threshold
    # elements of the two samples, and of the threshold pair's samples that only one of them has
    sampled = np.minimum(small, SAMPLE) + np.minimum(large, SAMPLE)
    only = np.maximum(sampled - 2 * inter * rate, 0.0)
    n = float(SKETCH_BITS)
    p = (1 - np.exp(-2 * only / n)) / 2
    expect = n * p
    slope = np.exp(-2 * only / n)
    # deviations: of parity collisions, and of how many common elements the samples hold
    collisions = np.maximum(n * p * (1 - p) - only * slope**2, 0.0)
    sampling = np.where(rate < 1, 4 * inter * rate * (1 - rate), 0.0) * slope**2
    spread = SIGMAS * np.sqrt(collisions + sampling) + 1.5
    # collisions only lower a count: with whole sets in the sketches it never exceeds their difference
    most = np.where(rate < 1, expect + spread, only + 1e-6)
    fits = small >= similarity * large - 1e-9
    return fits & (apart <= most), fits & (apart < expect - spread)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def met_before(x: np.ndarray, ys: np.ndarray, band: int) -> np.ndarray:
    """Whether pairs share a band key before ``band``, and so were compared there."""
    return (x[..., :band] == ys[..., :band]).any(axis=-1)


def bucket_pairs(ids: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, keys: np.ndarray, band: int, left: np.ndarray | None, similarity: float) -> list[tuple[int, int, bool]]:
    """Pairs of a bucket to confirm, and whether a tree stands on them: trees over surely alike members, every undecided pair between trees.

    ``left`` marks the members of the first of two blocks; then only pairs
    across count.  A pair that met in an earlier band is left to that bucket:
    there it is undecided and kept, or surely alike and joined by a tree.
    """
    n = len(ids)
    tree = np.full(n, -1, dtype=np.int64)
    pairs: dict[tuple[int, int], bool] = {}
    undecided: list[tuple[np.ndarray, np.ndarray]] = []

    def add(xs, ys, sure: bool) -> None:
        for x, y in zip(xs, ys, strict=True):
            a, b = int(ids[x]), int(ids[y])
            if a != b:
                pairs.setdefault((min(a, b), max(a, b)), sure)

    for root in range(n):
        if tree[root] >= 0:
            continue
        tree[root] = root
        todo = [root]
        while todo:
            x = todo.pop()
            rest = np.flatnonzero(tree != root)
            if left is not None:
                rest = rest[left[rest] != left[x]]
            if not len(rest):
                continue
            may, sure = sketch_verdicts(np.full(len(rest), sizes[x]), sizes[rest], _popcount(sketches[rest] ^ sketches[x]), similarity)
            joined = rest[sure & (tree[rest] < 0)]
            tree[joined] = root
            todo += joined.tolist()
            joined = joined[~met_before(keys[x], keys[joined], band)]
            add([x] * len(joined), joined.tolist(), True)
            open_ = rest[may & (tree[rest] != root)]
            open_ = open_[~met_before(keys[x], keys[open_], band)]
            if len(open_):
                undecided.append((np.full(len(open_), x), open_))
    for xs, ys in undecided:
        apart = tree[xs] != tree[ys]
        add(xs[apart].tolist(), ys[apart].tolist(), False)
    return [(a, b, sure) for (a, b), sure in pairs.items()]


def open_pairs(ids: np.ndarray, sizes: np.ndarray, sketches: np.ndarray, labels: np.ndarray, left: np.ndarray | None, similarity: float) -> list[tuple[int, int, bool]]:
    """Pairs of a bucket that may be alike and whose labels differ."""
    found = []
    for x in range(len(ids)):
        rest = np.arange(x + 1, len(ids))
        rest = rest[labels[rest] != labels[x]]
        if left is not None:
            rest = rest[left[rest] != left[x]]
        if len(rest):
            may, _ = sketch_verdicts(np.full(len(rest), sizes[x]), sizes[rest], _popcount(sketches[rest] ^ sketches[x]), similarity)
            found += [(int(min(ids[x], ids[y])), int(max(ids[x], ids[y])), False) for y in rest[may].tolist()]
    return found


def signatures(df: DataFrame, shingle: int, id_column: str = "doc_id") -> DataFrame:
    """``id, row_key, n_shingles, sig, bands, sketch`` of every row; rows equal in id and text share the key."""
    kind = df.schema[id_column].dataType.simpleString()

    def make():
        cache = _WordHashes()

        def apply(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {k: [] for k in ("n_shingles", "sig", "bands", "sketch")}
            for text in utf8(batch):
                s = shingle_hashes(text, shingle, cache)
                out["n_shingles"].append(len(s))
                out["sig"].append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                out["bands"].append(band_keys(s) if len(s) else None)
                out["sketch"].append(odd_sketch(s) if len(s) else None)
            return out | {"id": batch.column("id"), "row_key": batch.column("row_key")}

        return apply

    return arrow_map(_keyed(df, id_column), f"id {kind}, row_key long, n_shingles long, sig binary, bands array<long>, sketch binary", make)


def _keyed(df: DataFrame, id_column: str) -> DataFrame:
    return df.select(F.col(id_column).alias("id"), F.xxhash64(F.col(id_column), F.col("text")).alias("row_key"), "text")


def _placed(classes: DataFrame, n_classes: int) -> DataFrame:
    """``place, rep, band, side``: every class once for each place where it meets others."""
    dealt = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = heavy_join(dealt, shared, ["key"], "n", BANDS * n_classes)
    # blocks of a bucket by a hash of the member; every pair of blocks meets in one place
    blocks = F.ceil(F.col("n") / BLOCK)
    members = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64(F.lit(3), "rep"), F.col("blocks")))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    place = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    return members.select(place.alias("place"), "rep", "band", side.alias("side"))


def _compare(rows: DataFrame, similarity: float, again: bool) -> DataFrame:
    """``a, b, sure`` of the pairs that a place leaves to confirm; ``again`` compares all members of different ``label``, without trees."""
    ship(rows.sparkSession)
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sure", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None

        def done(place, ids, sizes, sketches, side, bands, keys, labels) -> Iterator[pa.RecordBatch]:
            cuts = np.flatnonzero(np.diff(place)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(place)]])
            found: list[tuple[int, int, bool]] = []
            two = starts[ends - starts == 2]
            if len(two):  # most buckets: one comparison each, all at once
                may, _ = sketch_verdicts(sizes[two], sizes[two + 1], _popcount(sketches[two] ^ sketches[two + 1]), similarity)
                may &= (side[two] == 0) | (side[two] != side[two + 1])
                if again:
                    may &= labels[two] != labels[two + 1]
                else:
                    may &= ~((keys[two] == keys[two + 1]) & (np.arange(BANDS)[None, :] < bands[two][:, None])).any(axis=1)
                found += [(min(x, y), max(x, y), False) for x, y in zip(ids[two][may].tolist(), ids[two + 1][may].tolist(), strict=True)]
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                if e - s > 2:
                    left = side[s:e] == 1 if side[s] else None
                    if again:
                        found += open_pairs(ids[s:e], sizes[s:e], sketches[s:e], labels[s:e], left, similarity)
                    else:
                        found += bucket_pairs(ids[s:e], sizes[s:e], sketches[s:e], keys[s:e], int(bands[s]), left, similarity)
            if found:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*found, strict=True)), strict=True)), schema=schema)

        for batch in batches:
            part = (
                batch.column("place").to_numpy(zero_copy_only=False),
                batch.column("rep").to_numpy(zero_copy_only=False),
                batch.column("n_shingles").to_numpy(zero_copy_only=False),
                np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint64).reshape(-1, SKETCH_BITS // 64),
                batch.column("side").to_numpy(zero_copy_only=False),
                batch.column("band").to_numpy(zero_copy_only=False),
                batch.column("bands").flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS),
                batch.column("label").to_numpy(zero_copy_only=False),
            )
            if carry is not None:
                part = tuple(np.concatenate([x, y]) for x, y in zip(carry, part, strict=True))
            if not len(part[0]):
                continue
            last = int(np.flatnonzero(part[0] != part[0][-1])[-1]) + 1 if (part[0] != part[0][-1]).any() else 0
            carry = tuple(x[last:].copy() for x in part)
            if last:
                yield from done(*(x[:last] for x in part))
        if carry is not None and len(carry[0]):
            yield from done(*carry)

    ordered = rows.select("place", "rep", "n_shingles", "sketch", "side", "band", "bands", "label").repartition("place").sortWithinPartitions("place", "rep")
    return ordered.mapInArrow(run, "a long, b long, sure boolean")


def candidate_pairs(classes: DataFrame, n_classes: int, similarity: float) -> DataFrame:
    """``a, b, sure``: pairs of classes that the sketches leave to confirm; ``sure`` where a tree stands on the pair."""
    rows = _placed(classes, n_classes).join(classes.select("rep", "n_shingles", "sketch", "bands"), "rep").withColumn("label", F.col("rep"))
    return _compare(rows, similarity, again=False).groupBy("a", "b").agg(F.max("sure").alias("sure"))


def _second_look(classes: DataFrame, n_classes: int, failed: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """Pairs to confirm in the buckets of classes with a failed tree link, between classes that ``links`` do not connect."""
    nodes = failed.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    placed = cut(_placed(classes, n_classes), "placed")
    places = placed.join(nodes, "rep", "left_semi").select("place").distinct()
    found = components(links)
    rows = placed.join(places, "place", "left_semi").join(classes.select("rep", "n_shingles", "sketch", "bands"), "rep").join(found, F.col("rep") == F.col("node"), "left")
    return _compare(rows.withColumn("label", F.coalesce("component", "rep")), similarity, again=True).distinct()


def _shingle_sets(df: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int, id_column: str) -> DataFrame:
    """``rep, shingles`` of the classes in ``pairs``, made again from one row of each."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    wanted = cut(gathered(classes.join(ends, "rep", "left_semi").select("row_key", "rep", "n_shingles"), 2 * pairs.count()), "wanted")
    hashes = wanted.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    texts = maybe_wanted(_keyed(df, id_column), F.col("row_key"), wanted.select("row_key"), "near").where("near").select("row_key", "text")

    def hashed():
        cache = _WordHashes()

        def apply(batch: pa.RecordBatch) -> dict:
            sets = [shingle_hashes(t, shingle, cache) for t in utf8(batch)]
            return {"row_key": batch.column("row_key"), "shingles": [s.tobytes() for s in sets]}

        return apply

    made = arrow_map(texts, "row_key long, shingles binary", hashed).groupBy("row_key").agg(F.min("shingles").alias("shingles"))
    return cut(gathered(wanted.join(made, "row_key").select("rep", "shingles"), hashes, 8), "sets")


def confirmed(sets: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """``a, b, sure, alike``: whether the full sets of a pair reach ``similarity``."""
    least = Fraction(str(similarity))

    def verify():
        def apply(batch: pa.RecordBatch) -> dict:
            alike = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                u, v = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(u, v, assume_unique=True))
                alike.append(least.denominator * both >= least.numerator * (len(u) + len(v) - both))
            return {c: batch.column(c) for c in ("a", "b", "sure")} | {"alike": alike}

        return apply

    both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), "b")
    return arrow_map(both.select("a", "b", "sure", "x", "y"), "a long, b long, sure boolean, alike boolean", verify)


def class_links(df: DataFrame, classes: DataFrame, n_classes: int, shingle: int, similarity: float, id_column: str) -> DataFrame:
    """``a, b``: confirmed links of classes, enough to connect every two that are alike."""
    pairs = cut(candidate_pairs(classes, n_classes, similarity), "pairs")
    judged = cut(gathered(confirmed(_shingle_sets(df, classes, pairs, shingle, id_column), pairs, similarity), pairs.count()), "judged")
    links = judged.where("alike").select("a", "b")
    failed = judged.where("sure AND NOT alike")
    if failed.isEmpty():
        return links
    more = cut(_second_look(classes, n_classes, failed, links, similarity), "more")
    found = confirmed(_shingle_sets(df, classes, more, shingle, id_column), more, similarity)
    return cut(links.unionByName(found.where("alike").select("a", "b")).distinct(), "links")


def link(df: DataFrame, shingle: int = 5, similarity: float = 0.8, id_column: str = "doc_id") -> DataFrame:
    """``id, n_shingles, component_id, kept, n_links`` of every row, for ids of any type with an order.

    ``n_links`` counts the confirmed links of the row's class that were needed
    to connect it.
    """
    signed = cut(signatures(df, shingle, id_column), "signatures")
    grouped = signed.where("sig IS NOT NULL").groupBy("sig").agg(F.min("id").alias("first_id"), F.min("row_key").alias("row_key"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("n_rows"))
    # a class's number is settled once its table is written
    classes = cut(gathered(grouped, signed.count(), CLASS_BYTES).withColumn("rep", F.monotonically_increasing_id()), "classes")
    n_classes, n_rows = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_rows"), F.lit(0))).first()
    links = class_links(df, classes, n_classes, shingle, similarity, id_column)
    n_links = links.count()
    found = components(links, rows=n_links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    linked = classes.select("sig", "rep", "first_id", "n_rows").join(found, F.col("rep") == F.col("node")).drop("node").join(degree, F.col("rep") == F.col("node")).drop("node")
    linked = cut(gathered(linked, 2 * n_links), "linked")
    smallest = linked.groupBy("component").agg(F.min("first_id").alias("smallest"), F.count(F.lit(1)).alias("n"))
    named = heavy_join(linked, smallest, ["component"], "n", n_classes).select("sig", "smallest", "n_links", "n_rows")
    alone = classes.join(linked.select(F.col("rep").alias("r")), F.col("rep") == F.col("r"), "left_anti").select("sig", F.col("first_id").alias("smallest"), F.lit(0).cast("long").alias("n_links"), "n_rows")
    rows = signed.select("id", "n_shingles", "sig")
    out = heavy_join(rows.where("sig IS NOT NULL"), named.unionByName(alone), ["sig"], "n_rows", n_rows).select("id", "n_shingles", "smallest", "n_links")
    out = out.unionByName(rows.where("sig IS NULL").select("id", "n_shingles"), allowMissingColumns=True)
    component = F.coalesce("smallest", "id")
    return out.select(F.col("id").alias(id_column), "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
