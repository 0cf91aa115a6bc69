"""How far the term shares of sources are apart, by cube partitioning.

Of each lang the cube has the axes group, group and term. Groups and kept terms are dealt into blocks by hash; a cell
is (group block, group block, term block). The shares of one group in one term block are a slice; a slice is copied to
the cells of its group block, one for each block it may meet, and no cell holds more than two group blocks of slices.
A cell works out the partial divergences of its pairs of groups, both ways, and the partial sums are added up along the
term axis. Terms that no group of a cell has are not walked: they all give one value per pair, taken times their number.

Shares are whole numbers of a billionth and every division is floored, so that results do not depend on the order.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notemill.llm.blocks import given_back
from notemill.operators.joins import lookup_join
from notemill.session import materialise

UNIT = 1_000_000_000
LEAST_DOCUMENTS = 3
MOST_TERMS = 200
#: Terms and groups of a block on average, and terms that a task counts before it hands them on.
TERM_BLOCK, GROUP_BLOCK, COUNTED = 4096, 16, 200_000
LONG_TEXT = 1 << 20

#: A term is a run of ASCII letters and of characters beyond ASCII; A-Z count as a-z.
_TERMS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))

_COUNTS = "lang string, source string, term string, n long, docs long"


def _term_lists(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a megabyte at a time."""
    data, start = data.translate(_TERMS), 0
    while len(data) - start > LONG_TEXT:
        cut = data.find(b" ", start + LONG_TEXT)
        if cut < 0:
            break
        yield data[start:cut].split()
        start = cut
    yield data[start:].split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term), added up before they leave the task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(terms)), pa.repeat(source, len(terms)), pa.array(terms, type=pa.binary()).cast(pa.string()),
                 pa.array(list(n.values()), type=pa.int64()), pa.array([docs[t] for t in terms], type=pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        held.clear()
        given_back()

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text").cast(pa.large_binary())):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            distinct: set[bytes] = set()
            for terms in _term_lists(text.as_py()):
                n.update(terms)
                distinct.update(terms)
            docs.update(distinct)
        if sum(len(n) for n, _ in held.values()) > COUNTED:
            yield from handed_on()
    yield from handed_on()


def share(n: Column, size: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / (size + terms)), without overflow."""
    wide = [c.cast("decimal(19,0)") for c in (n, size, terms)]
    return (F.lit(1) + F.call_function("div", F.lit(UNIT).cast("decimal(12,0)") * (wide[0] + 1).cast("decimal(20,0)"), wide[1] + wide[2])).cast("long")


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _cell(batch: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of groups in one cell, both ways."""
    side, first, second = batch.column("side").to_numpy(), batch.column("first")[0].as_py(), batch.column("second")[0].as_py()
    sources, none = batch.column("source").to_pylist(), batch.column("none").to_numpy()
    places, shares = batch.column("places").to_pylist(), batch.column("shares").to_pylist()
    number, lang = batch.column("terms")[0].as_py(), batch.column("lang")[0].as_py()
    known = np.unique(np.array([p for row in places for p in row], dtype=np.int64))
    dense = np.repeat(none[:, None], len(known), axis=1)
    for row, (at, values) in enumerate(zip(places, shares)):
        dense[row, np.searchsorted(known, np.array(at, dtype=np.int64))] = values
    rest = number - len(known)

    def sums(i: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        square, plain = (dense[i] - dense[others]) ** 2, (none[i] - none[others]) ** 2
        return ((square // dense[others]).sum(axis=1) + plain // none[others] * rest,
                (square // dense[i]).sum(axis=1) + plain // none[i] * rest)

    out: list[tuple] = []
    for i in np.flatnonzero(side == first):
        others = np.flatnonzero((side == second) & (np.arange(len(side)) > i if first == second else True))
        if len(others):
            there, back = sums(i, others)
            for j, a, b in zip(others.tolist(), there.tolist(), back.tolist()):
                out += [(sources[i], sources[j], a), (sources[j], sources[i], b)]
    columns = list(zip(*out)) if out else [(), (), ()]
    return pa.table({"lang": pa.array([lang] * len(out), type=pa.string()), "source": pa.array(columns[0], type=pa.string()),
                     "item": pa.array(columns[1], type=pa.string()), "value": pa.array(columns[2], type=pa.int64())})


def _blocks(value: Column, number: Column) -> Column:
    return F.pmod(F.xxhash64(value), number).cast("int")


def _in_cells(slices: DataFrame) -> DataFrame:
    """Every slice in the cells of its group block with each block of its lang, itself included."""
    other = slices.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1)))
    return other.withColumns({"first": F.least("side", "other"), "second": F.greatest("side", "other")}).drop("other", "group_blocks")


def audit(docs: DataFrame, term_block: int = TERM_BLOCK, group_block: int = GROUP_BLOCK) -> DataFrame:
    """lang, source, part, item, value and rank: ``pair`` rows hold the divergence of each group from every other source of
    its lang, ``term`` rows the 200 terms in which it lies furthest above its lang.

    ``docs`` has lang, source and text, nulls counting as empty; other columns are not read, and every row is a document,
    repeated ids and texts too. Texts without terms make a group all the same; a lang with no term in three documents
    has pairs of value 0. Texts of any length are counted whole. Ties are in the order of the item's bytes. Without
    documents there are no rows. The pairs number groups times groups of a lang, as they are the result.
    """
    given = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    groups = given.select("lang", "source").distinct()
    counts = given.mapInArrow(_counted, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = materialise(counts, "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).filter(F.col("docs") >= LEAST_DOCUMENTS)
    kept = materialise(kept.select("lang", "term", "total"), "kept")

    per_lang = (groups.groupBy("lang").agg(F.count("*").alias("groups"))
                .join(kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("size")), "lang", "left")
                .select("lang", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("size", F.lit(0)).alias("size"),
                        F.ceil(F.col("kept") / term_block).alias("term_blocks"), F.ceil(F.col("groups") / group_block).alias("group_blocks")))
    per_lang = materialise(per_lang, "langs")

    # kept terms: the lang's share, a block, and a place in that block
    found = lookup_join(kept, per_lang.select("lang", "kept", "size", "term_blocks"), "lang", F.col("term"))
    dealt = found.withColumns({"whole": share(F.col("total"), F.col("size"), F.col("kept")), "block": _blocks(F.col("term"), F.col("term_blocks"))})
    place = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term"))
    terms = materialise(dealt.select("lang", "term", "whole", "block", place.alias("place")), "terms")
    sizes = terms.groupBy("lang", "block").agg(F.count("*").alias("terms"))

    inside = materialise(counts.select("lang", "source", "term", "n").join(terms, ["lang", "term"]), "inside")
    held = groups.join(inside.groupBy("lang", "source").agg(F.sum("n").alias("held")), ["lang", "source"], "left")
    held = lookup_join(held, per_lang.select("lang", "kept", "term_blocks", "group_blocks"), "lang", F.col("source"))
    held = materialise(held.select(
        F.struct("lang", "source").alias("group"), F.coalesce("held", F.lit(0)).alias("held"), "kept",
        F.when(F.col("kept") > 0, share(F.lit(0), F.coalesce("held", F.lit(0)), F.col("kept"))).alias("none"),
        _blocks(F.col("source"), F.col("group_blocks")).alias("side"), "term_blocks", "group_blocks"), "groups")

    shares = lookup_join(inside.withColumn("group", F.struct("lang", "source")), held.select("group", "held", "kept"), "group", F.col("term"))
    shares = materialise(shares.withColumn("p", share(F.col("n"), F.col("held"), F.col("kept")))
                         .select("lang", "source", "term", "block", "place", "p", "whole"), "shares")

    of_group = held.select("group.*", "none", "side", "term_blocks", F.col("group_blocks").cast("int").alias("group_blocks"))
    slices = shares.groupBy("lang", "source", "block").agg(F.collect_list("place").alias("places"), F.collect_list("p").alias("shares"))
    every = (of_group.filter(F.col("none").isNotNull())
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("term_blocks").cast("int") - 1)))
             .drop("term_blocks").join(sizes, ["lang", "block"]))
    nothing = [F.coalesce(c, F.array().cast(f"array<{kind}>")).alias(c) for c, kind in (("places", "int"), ("shares", "long"))]
    cells = _in_cells(every.join(slices, ["lang", "source", "block"], "left").select(*every.columns, *nothing))
    partial = cells.groupBy("lang", "block", "first", "second").applyInArrow(_cell, "lang string, source string, item string, value long")
    pairs = partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    other = F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1))
    empty = of_group.filter(F.col("none").isNull()).select("lang", "source", "side", other.alias("other"))
    facing = empty.select("lang", F.col("source").alias("item"), F.col("other").alias("side"), F.col("side").alias("other"))
    nowhere = empty.join(facing, ["lang", "side", "other"]).filter(F.col("source") != F.col("item")).select("lang", "source", "item")
    pairs = pairs.unionByName(nowhere.withColumn("value", F.lit(0).cast("long")))

    above = shares.filter(F.col("p") > F.col("whole")).select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("whole")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = [rows.withColumn("rank", rank) for rows in (pairs, above)]
    out = (ranked[0].withColumn("part", F.lit("pair"))
           .unionByName(ranked[1].filter(F.col("rank") <= MOST_TERMS).withColumn("part", F.lit("term"))))
    return out.select("lang", "source", "part", "item", "value", "rank")
