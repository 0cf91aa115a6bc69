"""Note and sentence tables, and reports on them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.functions import sentences as sf, text as tx
from notemill.operators import joins, ranks
from notemill.operators.once import evaluate_once
from notemill.session import materialise


def distinct_notes(rows: DataFrame, columns=("notes", "original_notes"), order: str = "row_order") -> DataFrame:
    """Distinct values of the columns with the place where each is first seen.

    Rows equal in all but their file are merged on the way; taking the smallest place over the equal
    rows does both at once, in one aggregate.
    """
    return rows.groupBy(F.xxhash64(*columns).alias("_hash"), *columns).agg(F.min(order).alias(order)).drop("_hash")


def note_sentences(notes: DataFrame, filtered: bool = False) -> DataFrame:
    """Sentence list and size per note; ``filtered`` drops poor sentences, then notes without any."""
    split = sf.kept_sentences if filtered else sf.split_sentences
    table = evaluate_once(notes, {"sentences": split(F.col("notes"))})
    table = table.withColumn("num_sentences", F.size("sentences").cast("long"))
    return table.filter("num_sentences > 0") if filtered else table


_NOTE, _MARK = "_note", "_mark"


def _fingerprint(sentence) -> Column:
    return F.unhex(F.md5(sentence))


def _dense(found: str, size: Column) -> Column:
    """Counts of all places in order: those of the (place, count) list, sorted by place, and 1 everywhere else."""
    one, none = F.lit(1).cast("long"), F.array().cast("array<struct<place:int,count:bigint>>")
    listed = F.coalesce(F.col(found), none)
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(listed, i - 1)["place"])
    parts = F.transform(listed, lambda x, i: F.concat(F.array_repeat(one, x["place"] - before(i) - 1), F.array(x["count"])))
    last = F.coalesce(F.get(listed, F.size(listed) - 1)["place"], F.lit(-1))
    return F.concat(F.flatten(parts), F.array_repeat(one, size - last - 1))


def _with_counts(notes: DataFrame, order: str, shown: dict[str, Column], keep=None) -> DataFrame:
    """One row per sentence of the notes: note_index (by ``order``), ``shown``, num_sentences, sentence and its occurrences.

    The notes are written once, with what is shown of them, and numbered by their place alone. Only fingerprints of sentences are
    counted, and only those that occur again are looked up: a sentence that is not found occurs once. Where they are few they
    are broadcast. Beyond that (note, place, fingerprint) meets them and what is found returns to the note as one list.
    Numbers and lists meet the notes before the sentences are taken apart, so that a text is shuffled once at most.
    """
    notes = notes.select(order, *[value.alias(name) for name, value in shown.items()], "sentences", "num_sentences")
    notes = materialise(notes.withColumn(_NOTE, F.monotonically_increasing_id()), "note_sentences")
    numbers = ranks.dense_index(notes.select(order, _NOTE), [order, _NOTE], "note_index").drop(order)
    rows = notes.drop(order).join(F.broadcast(numbers) if joins.small_enough(numbers) else numbers, _NOTE)

    placed = notes.select(_NOTE, F.posexplode("sentences").alias("place", "sentence"))
    if keep is not None:
        placed = placed.filter(keep)
    placed = placed.select(_NOTE, "place", _fingerprint("sentence").alias(_MARK))
    again = placed.groupBy(_MARK).agg(F.count("*").alias("count")).filter("count > 1")
    again = materialise(again, "sentences_again")
    out = ["note_index", *shown, "num_sentences", "sentence", "count"]
    if joins.small_enough(again):
        each = rows.withColumn("sentence", F.explode_outer("sentences"))
        each = (each if keep is None else each.filter(keep)).withColumn(_MARK, _fingerprint("sentence"))
        once = F.when(F.col("sentence").isNotNull(), F.lit(1).cast("long"))
        return each.join(F.broadcast(again), _MARK, "left").withColumn("count", F.coalesce("count", once)).select(*out)
    found = joins.attach(placed, again.withColumn("_n", F.col("count")), _MARK, "_n", F.struct(_NOTE, "place"))
    lists = found.filter(F.col("count").isNotNull()).groupBy(_NOTE).agg(
        F.array_sort(F.collect_list(F.struct("place", "count"))).alias("_found"))
    both = rows.join(lists, _NOTE, "left").withColumn("_all", F.arrays_zip(
        F.col("sentences").alias("sentence"), _dense("_found", F.size("sentences")).alias("count")))
    each = both.select("note_index", *shown, "num_sentences", F.explode_outer("_all").alias("_one")).select(
        "note_index", *shown, "num_sentences", "_one.sentence", "_one.count")
    return each if keep is None else each.filter(keep)


def sentence_table(rows: DataFrame, order: str = "row_order", shown: dict[str, Column] | None = None) -> DataFrame:
    """One row per sentence of every distinct note, with how often the sentence occurs.

    Notes without a sentence keep one row with a null sentence and a null count. Sentences are split once. ``shown`` are the
    note's columns in every row, computed once per note: ``notes`` and ``original_notes`` unless others are asked for.
    """
    shown = shown or {name: F.col(name) for name in ("notes", "original_notes")}
    return _with_counts(note_sentences(distinct_notes(rows, order=order)), order, shown)


def filtered_sentence_table(rows: DataFrame, order: str = "row_order", shown: dict[str, Column] | None = None) -> DataFrame:
    """The sentence table of kept sentences only, numbered over the notes that have any. ``shown`` is ``notes`` unless told."""
    notes = note_sentences(distinct_notes(rows, ("notes",), order), filtered=True)
    return _with_counts(notes, order, shown or {"notes": F.col("notes")}, (F.length("sentence") >= 5) & tx.has_ascii_letter(F.col("sentence")))


def sentence_counts(sentences: DataFrame) -> DataFrame:
    return sentences.filter("sentence is not null").groupBy("sentence").agg(F.count("*").alias("count"))


def top_sentences(sentences: DataFrame, top: int = 10) -> DataFrame:
    ranked = sentence_counts(sentences).orderBy(F.desc("count"), "sentence").limit(top)
    return ranked.select("count", "sentence", tx.preview(F.col("sentence")).alias("preview"))


def short_sentences(sentences: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent sentences of at most three characters, with the totals over all of them."""
    counts = sentence_counts(sentences).filter(F.length("sentence") <= 3)
    totals = counts.agg(F.struct(F.count("*").alias("kinds"), F.sum("count").alias("rows")).alias("t")).scalar()
    return counts.orderBy(F.desc("count"), "sentence").limit(top).select(
        "sentence", "count", totals["kinds"].alias("distinct_short"), totals["rows"].alias("short_rows"))


def notes_behind(sentences: DataFrame, sentence: str, top: int = 5) -> DataFrame:
    """The first distinct notes that produce a sentence, with their first original and both lengths."""
    hits = sentences.filter(F.col("sentence") == sentence)
    firsts = hits.groupBy("notes").agg(F.min("note_index").alias("note_index"),
                                       F.min_by("original_notes", "note_index").alias("original_notes"))
    return firsts.orderBy("note_index").limit(top).select(
        "note_index", "notes", "original_notes", F.length("notes").cast("long").alias("notes_length"),
        F.length("original_notes").cast("long").alias("original_length"))


def note_diagnosis(notes: DataFrame) -> DataFrame:
    """Counts of short, punctuation-only and empty notes among distinct notes, in one pass."""
    note = F.col("notes")
    return notes.select("notes").distinct().agg(
        F.count("*").alias("notes"), F.count_if(F.length(note) <= 10).alias("short_notes"),
        F.count_if(tx.only_punctuation(note)).alias("punctuation_notes"),
        F.count_if(tx.is_blank(note)).alias("empty_notes"))


def short_notes(notes: DataFrame, top: int = 10, order: str = "row_order") -> DataFrame:
    """The first distinct notes of at most ten characters."""
    short = notes.filter(F.length("notes") <= 10)
    return (distinct_notes(short, ("notes",), order).orderBy(order).limit(top)
            .select("notes", F.length("notes").cast("long").alias("length")))


def punctuation_notes(notes: DataFrame, top: int = 5, order: str = "row_order") -> DataFrame:
    """The first distinct notes that are only punctuation."""
    hits = notes.filter(tx.only_punctuation(F.col("notes")))
    return distinct_notes(hits, ("notes",), order).orderBy(order).limit(top).select("notes")
