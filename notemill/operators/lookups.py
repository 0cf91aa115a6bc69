"""Looking up the tokens of texts in a table, in place or by a dictionary per text.

A table of measured, small size goes to every Python worker and texts stay where they are: nothing is shuffled. A larger
one is met by the distinct tokens of each text, each of which carries the places where it stands: one row per text and
distinct token, not one per occurrence. It is broadcast to the executors or joined by token, hot tokens apart, as its
measured size says (``joins.lookup_join``). The places put the answers in order again, so that no text is moved.
"""

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.operators import joins
from notemill.operators.once import evaluate_once
from notemill.session import bounded_batches, materialise

#: Rows and bytes of a table that every Python worker may hold.
IN_PLACE_ROWS, IN_PLACE_BYTES = 50_000, 4 << 20
#: Items that a worker holds as Python objects at a time, and then as one Arrow piece.
PIECE_ITEMS = 50_000


def measured(table: DataFrame, small: bool | None) -> tuple[DataFrame, bool, bool | None]:
    """The table, written if it has to be measured; whether it may go to every Python worker, or at least be broadcast."""
    if small is not None:
        return table, small, small
    table = materialise(table, "lookup")
    if joins.small_enough(table, IN_PLACE_ROWS, IN_PLACE_BYTES):
        return table, True, True
    return table, False, joins.small_enough(table)


def pieces(rows: pa.Array, items: int = PIECE_ITEMS) -> Iterator[pa.Array]:
    """Slices of an array of lists that hold ``items`` items at most; a longer list is a slice of its own."""
    start, held = 0, 0
    for i, size in enumerate(pc.fill_null(pc.list_value_length(rows), 0).to_pylist()):
        if i > start and held + size > items:
            yield rows.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(rows):
        yield rows.slice(start)


def in_place(table: DataFrame, make: Callable[[pa.Table], object], answer: Callable[[object, list], list], kind: str) -> Callable:
    """A function from an array column to an array of ``kind``: ``answer(made, items)`` per row, null for null.

    ``made`` is what ``make`` builds out of the whole (small) table, once per Python worker and broadcast. A worker's memory
    does not grow with the rows of its task: batches are short, and of a batch only a piece is Python objects at a time.
    """
    bounded_batches(table.sparkSession)
    shared = table.sparkSession.sparkContext.broadcast(make(table.toArrow()))
    value_type = pa.list_({"int": pa.int32(), "string": pa.string()}[kind])

    @F.arrow_udf(f"array<{kind}>")
    def apply(rows: pa.Array) -> pa.Array:
        made = shared.value
        answers = [pa.array([None if row is None else answer(made, row) for row in piece.to_pylist()], type=value_type)
                   for piece in pieces(rows)]
        return pa.concat_arrays(answers) if answers else pa.array([], type=value_type)

    return apply


def distinct_tokens(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """key, token, places (from 0) of every distinct token of a row; a row without tokens gives one with nulls."""
    rows = evaluate_once(df.select(key, tokens.alias("_tokens")), {
        "_order": F.array_sort(F.transform("_tokens", lambda t, i: F.struct(t.alias("t"), i.alias("i"))))}).drop("_tokens")
    is_first = lambda x, i: (i == 0) | (x["t"] != F.get("_order", i - 1)["t"])
    first = F.filter(F.transform("_order", lambda x, i: F.when(is_first(x, i), i)), lambda i: i.isNotNull())
    rows = evaluate_once(rows, {"_first": first})
    last = F.concat(F.slice("_first", F.lit(2), F.size("_first")), F.array(F.size("_order")))
    runs = F.zip_with("_first", F.slice(last, F.lit(1), F.size("_first")), lambda a, b: F.struct(
        F.get("_order", a)["t"].alias("token"), F.transform(F.slice("_order", a + 1, b - a), lambda x: x["i"]).alias("places")))
    return rows.select(key, F.inline_outer(runs))


def in_order(found: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """key, values of all places in their order; null values are left out. Inverse of ``distinct_tokens``."""
    kept = F.when(value.isNotNull() & F.col("places").isNotNull(), F.struct(value.alias("v"), "places"))
    grouped = found.groupBy(key).agg(F.collect_list(kept).alias("_all"))
    flat = F.flatten(F.transform("_all", lambda e: F.transform(e["places"], lambda p: F.struct(p.alias("p"), e["v"].alias("v")))))
    return grouped.select(key, F.transform(F.array_sort(flat), lambda x: x["v"]).alias(name))


def by_dictionary(df: DataFrame, key: str, tokens: Column, table: DataFrame, broadcast: bool | None = None) -> DataFrame:
    """key, token, places and the columns of ``table`` (unique by ``token``; nulls where it lacks the token)."""
    return joins.lookup_join(distinct_tokens(df, key, tokens), table, "token", F.struct(key, "token"), small=broadcast)
