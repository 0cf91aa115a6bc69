"""Benchmark passages in training texts, found by spaced seeds.

A seed is a run of at most ``SPAN`` tokens hashed at the places that a fixed mask keeps; tokens at the places it ignores may
differ. Seeds of test items meet seeds of documents in a join. Around a hit the two texts are laid side by side: a
document is contaminated where ``WINDOW`` neighbouring tokens agree with an item in at least ``AGREE`` places. Items shorter than a
window are compared whole, and a quarter of their tokens may differ. Every length of item has masks that leave a seed
whichever tokens differ, as long as the comparison would accept them. Items of fewer than ``LEAST`` tokens are phrases: all
their tokens must agree. All ways in which a stretch of text and an item can lie side by side are compared in one call.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notemill.llm import filters
from notemill.llm.blocks import ALNUM, list_column, mixed, pieces, text_bytes, word_hashes, word_spans
from notemill.session import materialise

SPAN = 12
#: Masks of six kept places. Whichever four of sixteen neighbouring tokens differ, or three of fourteen, one of them fits.
MASKS = ("111010110000", "110100001110", "100110111000", "111000101001", "111000100110", "110011001001")
#: From which number of tokens an item has which masks: three of twelve, two of eight, one of five may differ.
SHORTER = {
    12: ("1110111", "110010111", "111101001", "101001111", "11011010001", "11010001101", "11100000111", "1011111", "10110111"),
    8: ("111011", "11111", "101111", "11001011", "1110011", "11010101", "10100111"),
    5: ("1111", "11101", "10111", "11011"),
}
WINDOW, AGREE, LEAST = 16, 12, 5
CONTEXT = WINDOW


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased runs of letters and digits, and the index of each text's first."""
    raw, offsets = text_bytes(texts, lower=True)
    starts, ends, first = word_spans(raw, offsets, ALNUM)
    return word_hashes(raw, starts, ends), first


def _places(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of that width within one text, and their texts."""
    many = np.maximum(np.diff(first) - width + 1, 0)
    owner = np.repeat(np.arange(len(many)), many)
    return np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + first[:-1][owner], owner


def seeds(hashes: np.ndarray, place: np.ndarray, mask: str) -> np.ndarray:
    """The seed that starts at each place."""
    out = np.full(len(place), int(mask, 2), dtype=np.uint64)
    for i, kept in enumerate(mask):
        if kept == "1":
            out = mixed(out ^ hashes[place + i])
    return out


def masks_of(count: int) -> tuple[str, ...]:
    """The masks for an item of so many tokens; ignored places at the end are no part of the span."""
    if count < LEAST:
        return ("1" * count,) if count else ()
    if count >= 14:
        return tuple(mask.rstrip("0") for mask in MASKS)
    return SHORTER[max(least for least in SHORTER if least <= count)]


def _item_seeds(batches):
    for batch in batches:
        for piece in pieces(batch, "text"):
            hashes, first = tokens(piece.column("text"))
            ids = piece.column("item").to_numpy()
            counts = np.diff(first)
            found = []
            masks = [masks_of(count) for count in counts.tolist()]
            for mask in sorted(set().union(*masks)):
                place, owner = _places(first, len(mask))
                own = np.array([mask in m for m in masks], dtype=bool)[owner]
                found.append((seeds(hashes, place[own], mask), place[own], owner[own]))
            for seed, at, of in found:
                yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(ids[of], pa.int64()),
                                                  pa.array((at - first[:-1][of]).astype(np.int32))], ["seed", "item", "item_at"])


def _item_tokens(batches):
    for batch in batches:
        for piece in pieces(batch, "text"):
            hashes, first = tokens(piece.column("text"))
            yield pa.RecordBatch.from_arrays([piece.column("item"), list_column(hashes.view(np.int64), np.diff(first), pa.int64())], ["item", "tokens"])


_HITS = "doc_id long, part int, part_at int, tokens array<long>, hits array<struct<seed: long, at: int>>"
_HIT = pa.struct([("seed", pa.int64()), ("at", pa.int32())])


def _hits(wanted, masks):
    """Per document, the stretches of tokens around seeds that some item may have."""
    def read(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                hashes, first = tokens(piece.column("text"))
                found = []
                for mask in masks:
                    place, owner = _places(first, len(mask))
                    seed = seeds(hashes, place, mask)
                    held = np.flatnonzero(wanted.value.holds(seed))
                    found.append((owner[held], place[held], seed[held]))
                owner, place, seed = (np.concatenate(parts) for parts in zip(*found))
                order = np.lexsort((place, owner))
                owner, place, seed = owner[order], place[order], seed[order].view(np.int64)
                new = np.ones(len(owner), dtype=bool)
                new[1:] = (owner[1:] != owner[:-1]) | (place[1:] - place[:-1] > 2 * CONTEXT + SPAN)
                cuts = [*np.flatnonzero(new).tolist(), len(owner)]
                ids = piece.column("doc_id").to_numpy(zero_copy_only=False)
                rows = []
                for part, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    text = owner[a]
                    start = max(int(place[a]) - CONTEXT, int(first[text]))
                    end = min(int(place[b - 1]) + SPAN + CONTEXT, int(first[text + 1]))
                    rows.append({"doc_id": ids[text], "part": part, "part_at": start - int(first[text]),
                                 "tokens": hashes[start:end].view(np.int64).tolist(),
                                 "hits": [{"seed": s, "at": p - start} for s, p in zip(seed[a:b].tolist(), place[a:b].tolist())]})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("doc_id", pa.int64()), ("part", pa.int32()), ("part_at", pa.int32()), ("tokens", pa.list_(pa.int64())), ("hits", pa.list_(_HIT))]))
    return read


def best_window(item: np.ndarray, text: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """Of item and text laid side by side (item token i beside text token i + shift): the agreeing places of the best
    window, its start in the text, and the window's length. None if no window agrees enough."""
    low, high = max(0, -shift), min(len(item), len(text) - shift)
    width = min(WINDOW, len(item))
    if not width or high - low < width:
        return None
    same = np.concatenate(([0], np.cumsum(item[low:high] == text[low + shift:high + shift])))
    sums = same[width:] - same[:-width]
    at = int(sums.argmax())
    needed = AGREE if width == WINDOW else width - width // 4 if width >= LEAST else width
    return (int(sums[at]), low + shift + at, width) if sums[at] >= needed else None


_FOUND = "doc_id long, item long, start long, width long, agreeing long"


def _verify(batches):
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            item, text = np.array(row["item_tokens"], dtype=np.int64), np.array(row["tokens"], dtype=np.int64)
            found = [w for w in (best_window(item, text, shift) for shift in row["shifts"]) if w]
            if found:
                agreeing, start, width = max(found, key=lambda w: (w[0], -w[1], w[2]))
                rows.append({"doc_id": row["doc_id"], "item": row["item"], "start": row["part_at"] + start, "width": width, "agreeing": agreeing})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, pa.int64()) for n in ("doc_id", "item", "start", "width", "agreeing")]))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, width, agreeing): one row for every document and item that overlap, with the best window.

    ``start`` is the window's first token in the document. Null texts and null ids on either side take no part;
    rows that share an id are one document or item. Equal item texts are compared once and reported for each of their ids.
    Empty tables give no rows, texts without tokens hold nothing, and very long texts are read whole; a stretch of a
    text is sent once per item, however often its words repeat. Other columns are not read.
    """
    spark = docs.sparkSession
    items = materialise(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna()
                        .withColumn("item", F.xxhash64("text")).distinct(), "items")
    distinct = items.select("item", "text").distinct()
    seeded = materialise(distinct.mapInArrow(_item_seeds, "seed long, item long, item_at int"), "seeds")
    spread = distinct.mapInArrow(_item_tokens, "item long, tokens array<long>").select("item", F.col("tokens").alias("item_tokens"))
    sizes = spread.select(F.least(F.size("item_tokens"), F.lit(WINDOW)).alias("n")).distinct()
    masks = sorted(set(masks_of(WINDOW)).union(*[masks_of(r["n"]) for r in sizes.collect()]))          # 17 sizes at most
    wanted = spark.sparkContext.broadcast(filters.hash_set(seeded, "seed"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").dropna()
    parts = materialise(texts.mapInArrow(_hits(wanted, masks), _HITS).withColumn("part", F.xxhash64("tokens", "part_at")), "hits")
    hits = parts.select("doc_id", "part", "part_at", F.inline("hits").alias("seed", "at"))
    sides = (hits.join(seeded, "seed").groupBy("doc_id", "part", "part_at", "item")
             .agg(F.collect_set(F.col("at") - F.col("item_at")).alias("shifts")))
    beside = (sides.join(parts.select("doc_id", "part", "part_at", "tokens").dropDuplicates(["doc_id", "part", "part_at"]), ["doc_id", "part", "part_at"])
              .join(spread, "item"))
    found = beside.select("doc_id", "item", "part_at", "shifts", "tokens", "item_tokens").mapInArrow(_verify, _FOUND)
    best = found.groupBy("doc_id", "item").agg(F.max(F.struct("agreeing", -F.col("start"), "width")).alias("_best"))
    return best.join(items.select("item", "item_id").distinct(), "item").select(
        "doc_id", "item_id", (-F.col("_best.col2")).alias("start"), F.col("_best.width").alias("width"), F.col("_best.agreeing").alias("agreeing"))
