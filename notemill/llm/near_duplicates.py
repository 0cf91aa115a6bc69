"""Near duplicates by b-bit MinHash, with every link confirmed on the full shingle sets.

One pass gives each text its minima, of which the low ``LOW_BITS`` bits are packed into a signature, and bands of
whole minima that make candidates. Texts with equal sets are one class and take part once. In a bucket every
class is first compared with the bucket's smallest id; that joins most of a group into one component. What still stands
in several components of a bucket is compared in tiles of bounded size: signatures by counting equal low bits
(corrected for chance), then sets. A tile gives links between components only, never all pairs of a group.

The threshold is given in percent. Bands have the most rows with which a pair at the threshold is missed by all of
them with probability below ``MISSED``: 36 bands of 7 at 85 % (one in a million), 42 of 6 at 80 % (three in a million).
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notemill.llm import filters
from notemill.llm.blocks import NOT_SPACE, mixed, pieces, text_bytes, window_hashes, word_hashes, word_spans
from notemill.llm.graphs import components
from notemill.session import materialise

SHINGLE = 5
#: Percent, where nothing else is asked for.
PERCENT = 85
LOW_BITS = 2
MINIMA = 256
MISSED = 1e-5
#: How many of its standard deviations an estimate may lie below the threshold.
DEVIATIONS = 5
TILE = 256

_FACTORS = np.random.default_rng(77).integers(1, 2**63, MINIMA, dtype=np.uint64)
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def band_rows(percent: int) -> int:
    """Rows of a band; there are ``MINIMA // rows`` bands."""
    fitting = [rows for rows in range(1, MINIMA + 1) if (1 - (percent / 100) ** rows) ** (MINIMA // rows) < MISSED]
    return max(fitting, default=1)


def margin(percent: int) -> float:
    """How far below the threshold an estimate may lie."""
    chance = 1.0 / (1 << LOW_BITS)
    equal = chance + (1 - chance) * percent / 100
    return DEVIATIONS * math.sqrt(equal * (1 - equal) / MINIMA) / (1 - chance)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: runs of five words, or all words of a shorter text."""
    raw, offsets = text_bytes(texts, lower=True)
    starts, ends, first = word_spans(raw, offsets, NOT_SPACE)
    hashes = word_hashes(raw, starts, ends)
    runs = window_hashes(hashes, SHINGLE)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(runs[a:b - SHINGLE + 1]))
        else:
            out.append(window_hashes(hashes[a:b], b - a, seed=b - a + 1) if b > a else hashes[:0])
    return out


def minima(shingles: np.ndarray) -> np.ndarray:
    best = np.full(MINIMA, 2**32 - 1, dtype=np.uint32)
    for start in range(0, len(shingles), 1024):
        values = (shingles[start:start + 1024, None] ^ _FACTORS) * _FIRST
        values ^= values >> np.uint64(32)
        values *= _SECOND
        values >>= np.uint64(32)
        np.minimum(best, values.min(axis=0).astype(np.uint32), out=best)
    return best


def packed_low_bits(values: np.ndarray) -> bytes:
    low = values & np.uint32((1 << LOW_BITS) - 1)
    bits = ((low[:, None] >> np.arange(LOW_BITS, dtype=np.uint32)) & 1).astype(np.uint8)
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    count = MINIMA // rows
    bands = values[:rows * count].astype(np.uint64).reshape(count, rows)
    key = np.arange(count, dtype=np.uint64) + np.uint64(1)
    for i in range(rows):
        key = mixed(key ^ bands[:, i])
    return key


SIGNATURE = "doc_id long, n_shingles long, f1 long, f2 long, signature binary, keys array<long>"


def _signatures(rows: int):
    def read(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = shingle_sets(piece.column("text"))
                low, keys = [], []
                for found in sets:
                    values = minima(found) if len(found) else None
                    low.append(packed_low_bits(values) if len(found) else b"")
                    keys.append(band_keys(values, rows).view(np.int64) if len(found) else np.zeros(0, np.int64))
                with np.errstate(over="ignore"):
                    f1 = np.array([mixed(s).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
                    f2 = np.array([np.bitwise_xor.reduce(mixed(s + np.uint64(7))) if len(s) else 0 for s in sets], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(f1), pa.array(f2),
                     pa.array(low, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "f1", "f2", "signature", "keys"])
    return read


def _sets_of(wanted):
    def read(batches):
        for batch in batches:
            held = wanted.value.holds(batch.column("_hash").to_numpy().view(np.uint64))
            batch = batch.filter(pa.array(held))
            for piece in pieces(batch, "text"):
                sets = shingle_sets(piece.column("text"))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "set"])
    return read


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets are at least ``percent`` % alike."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    both = np.concatenate((a, b))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _confirm(percent: int):
    def read(batches):
        for batch in batches:
            left, right = batch.column("set_a"), batch.column("set_b")
            kept = [linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent) for x, y in zip(left, right)]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))
    return read


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    left = pairs.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("set_a")), "a")
    both = left.join(sets.select(F.col("rep").alias("b"), F.col("set").alias("set_b")), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(_confirm(percent), "a long, b long")


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity from equal low bits; two bits agree by chance once in four times, which is taken out."""
    differ = one ^ many
    differ = (differ | (differ >> np.uint64(1))) & np.uint64(0x5555555555555555)
    equal = 1.0 - np.bitwise_count(differ).sum(axis=1) / MINIMA
    chance = 1.0 / (1 << LOW_BITS)
    return (equal - chance) / (1 - chance)


def _tile_links(rows: list[dict], percent: int):
    """Links between the components of one tile (rows of one bucket, chunks x and y)."""
    key, x, y = rows[0]["key"], rows[0]["x"], rows[0]["y"]
    left = [r for r in rows if r["chunk"] == x]
    right = left if x == y else [r for r in rows if r["chunk"] == y]
    if not left or not right:
        return
    parent = {}

    def root(c):
        while parent.setdefault(c, c) != c:
            c = parent[c]
        return c

    signatures = np.array([np.frombuffer(r["signature"], np.uint64) for r in right])
    keys = np.array([r["keys"] for r in right])
    sizes = np.array([r["n_shingles"] for r in right])
    sets = [np.frombuffer(r["set"], np.uint64) for r in right]
    for i, row in enumerate(left):
        start = i + 1 if x == y else 0
        if start >= len(right):
            break
        near = estimates(np.frombuffer(row["signature"], np.uint64), signatures[start:]) >= percent / 100 - margin(percent)
        n = row["n_shingles"]
        near &= (100 * np.minimum(n, sizes[start:]) >= percent * np.maximum(n, sizes[start:]))
        at = np.flatnonzero(near) + start
        if not len(at):
            continue
        own = np.array(row["keys"])
        first = (keys[at] == own).argmax(axis=1)
        mine = np.frombuffer(row["set"], np.uint64)
        for j in at[own[first] == key].tolist():
            a, b = root(row["component"]), root(right[j]["component"])
            if a != b and linked(mine, sets[j], percent):
                parent[max(a, b)] = min(a, b)
                yield row["rep"], right[j]["rep"]


def _tiles(percent: int):
    def read(batches):
        """Rows come ordered by tile; a tile has two chunks of bounded size."""
        held, current = [], None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                tile = (row["key"], row["x"], row["y"])
                if tile != current:
                    if held:
                        found += _tile_links(held, percent)
                    held, current = [], tile
                held.append(row)
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], schema=_LINK)
        if held:
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in _tile_links(held, percent)], schema=_LINK)
    return read


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def groups(docs: DataFrame, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text); linked are sets at least ``percent`` % alike.

    Null and empty texts and texts of white space have no shingles and are linked with nothing. Rows that share a
    doc_id are one document, so their groups join. Rows without a doc_id are never linked: their component is null
    and they are kept.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialise(texts.mapInArrow(_signatures(band_rows(percent)), SIGNATURE), "signatures")
    same = ["n_shingles", "f1", "f2"]
    classes = materialise(signed.filter("n_shingles > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes")
    reps = signed.withColumnRenamed("doc_id", "rep").join(classes, [*same, "rep"], "left_semi").dropDuplicates([*same, "rep"])

    bands = reps.select("rep", F.explode("keys").alias("key"))
    buckets = bands.groupBy("key").agg(F.min("rep").alias("center"), F.max("rep").alias("last")).filter("center < last")
    shared = materialise(bands.join(buckets.select("key", "center"), "key"), "buckets")
    members = shared.select("rep").distinct()
    wanted = spark.sparkContext.broadcast(filters.hash_set(members.select(filters.id_hash(F.col("rep")).alias("h")), "h"))
    read = texts.filter("doc_id is not null").withColumn("_hash", filters.id_hash(F.col("doc_id")))
    sets = materialise(read.mapInArrow(_sets_of(wanted), "rep long, set binary").filter(F.length("set") > 0)
                       .join(members, "rep", "left_semi").dropDuplicates(), "sets")

    near = shared.filter("rep <> center").select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
    links = materialise(confirmed(near, sets, percent), "stars")
    found = components(links)

    placed = shared.select("key", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component"))
    open_keys = placed.groupBy("key").agg(F.min("component").alias("_least"), F.max("component").alias("_most"), F.count("*").alias("_n")).filter(
        "_least < _most").select("key", F.ceil(F.col("_n") / tile).cast("int").alias("_chunks"))
    rows = placed.join(open_keys, "key").withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("_chunks")).cast("int"))
    dealt = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).select(
        "key", "rep", "component", "chunk", F.least("chunk", "_other").alias("x"), F.greatest("chunk", "_other").alias("y"))
    full = (dealt.join(reps.select("rep", "n_shingles", "signature", "keys"), "rep").join(sets, "rep")
            .filter(F.length("set") == 8 * F.col("n_shingles")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = full.repartition(parts, "key", "x", "y").sortWithinPartitions("key", "x", "y")
    more = materialise(tiles.mapInArrow(_tiles(percent), "a long, b long"), "links")

    of_class = components(links.unionByName(more))
    joined = signed.select("doc_id", *same).join(classes, same, "left")
    named = joined.join(of_class.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id"),
                        (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))


