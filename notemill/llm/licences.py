"""Licences in texts: fixed phrases, and an exact set-similarity join of text blocks with notice templates.

A block is a run of words as long as a template and a quarter more, wherever it begins and across line breaks. It
holds the template when it has at least ``CONTAINMENT`` of the template's distinct words, all of its telling words
(such as a version number) and none of those that tell another licence.

Only words of some template can be shared, so texts are cut down to these words in one pass, and what is left is
written. Words are ordered by the number of texts that have them, rare ones first. Of a text and a template that share c
words, one shared word stands among the first |B|-c+1 words of the text's set and among the first |T|-c+1 of the
template (prefix filter); the set needs c words (length filter); from the first shared word on both must still have c
words (positional filter). In the pairs that are left every block that begins with a word of the template is
compared whole.
"""

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.llm.native import ascii_lower
from notemill.operators.once import evaluate_once
from notemill.session import materialise

#: What separates words, before and after lower-casing, and the phrases with their labels.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

CONTAINMENT = 0.8

#: Longest block in words for each word of a template.
ROOM = 1.25


@dataclass(frozen=True)
class Template:
    """A notice in lower case, as its licence words it; words a block must have, and words it must not have."""
    label: str
    text: str
    must: tuple[str, ...] = ()
    never: tuple[str, ...] = ()

    @property
    def words(self) -> list[str]:
        return sorted(set(self.text.split()))

    @property
    def marks(self) -> set[str]:
        """All words that matter to a block."""
        return {*self.words, *self.must, *self.never}

    @property
    def block(self) -> int:
        return math.ceil(len(self.text.split()) * ROOM)


_OTHER_CC = ("nc", "noncommercial", "nd", "noderivatives", "noderivs", "sa", "sharealike")
_GPL = ("lesser", "library", "affero")

TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
             "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
             "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
             "the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial "
             "portions of the software"),
    Template("apache-2", "licensed under the apache license version 2 0", ("apache", "2")),
    Template("apache-2", "you may not use this file except in compliance with the license", ("compliance",)),
    Template("gpl-2", "this work is licensed under the gnu general public license version 2", ("gnu", "general", "2"), (*_GPL, "3")),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu", "general", "3"), (*_GPL, "2")),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu", "general", "2"), (*_GPL, "3")),
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu", "general", "3"), (*_GPL, "2")),
    Template("gpl-2", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
             "foundation either version 2", ("gnu", "general", "2"), (*_GPL, "3")),
    Template("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
             "foundation either version 3", ("gnu", "general", "3"), (*_GPL, "2")),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc", "nc"), ("nd", "sa")),
    Template("cc-by-nc", "creative commons attribution noncommercial 4 0", ("creative", "attribution", "noncommercial"), _OTHER_CC[2:]),
    Template("cc-by", "licensed under cc by 4 0", ("cc", "by"), _OTHER_CC),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative", "attribution"), _OTHER_CC),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla",)),
)


def phrase_places(words: Column) -> Column:
    """Of each phrase that stands in the words (label, places, first, last): how often, and the first and last word index."""
    row = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    found = []
    for phrase, label in PHRASES:
        parts = F.split(row, f" {phrase}(?= )", -1)
        places = F.size(parts) - 1
        size = len(phrase.split())
        first = _words(F.element_at(parts, 1))
        last = F.size(words) - (_words(F.element_at(parts, -1)) - 1) - size
        found.append(F.struct(F.lit(label).alias("label"), places.alias("places"), first.alias("first"), last.alias("last")))
    return F.filter(F.array(*found), lambda s: s["places"] > 0)


def _words(piece: Column) -> Column:
    """Words of a piece in which one space stands before each."""
    return F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))


def needed(words: int, containment: float) -> int:
    return max(1, math.ceil(round(words * containment, 9)))


def _list(words) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def extracted(docs: DataFrame, templates, containment: float, key: str, text: str) -> DataFrame:
    """Of every row, written once: its key, n_words, the phrases' places, the distinct template words it has, and, where those
    are enough for some template, every template or telling word with its place (else null)."""
    universe = _list(sorted({w for t in templates for w in t.words}))
    marks = _list(sorted({w for t in templates for w in t.marks}))
    least = min(needed(len(t.words), containment) for t in templates)
    lowered = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    rows = evaluate_once(docs.select(F.col(key).alias("_key"), lowered.alias("_text")), {
        "_words": F.regexp_extract_all("_text", F.lit(f"{WORD}+"), F.lit(0))})
    pattern = "|".join(f"{BREAK}++".join(phrase.split()) for phrase, _ in PHRASES)
    nothing = F.array().cast("array<struct<label string, places int, first int, last int>>")
    phrases = F.when(F.col("_text").rlike(pattern), phrase_places(F.col("_words"))).otherwise(nothing)
    rows = evaluate_once(rows, {"n_words": F.size("_words").cast("long"), "_phrases": phrases, "_held": F.array_intersect("_words", universe)})
    enough = reduce(lambda a, b: a | b, [F.size(F.array_intersect("_held", _list(t.words))) >= needed(len(t.words), containment) for t in templates])
    places = F.filter(F.transform("_words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))), lambda x: F.array_contains(marks, x["word"]))
    rows = rows.select("_key", "n_words", "_phrases", "_held", F.when((F.size("_held") >= least) & enough, places).alias("_places"))
    return materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "words")


def _best_block(places: str, words: str, must: str, never: str, need: str, block: str) -> Column:
    """The most distinct template words of a block that holds the template; null when none does."""
    def counted(h: Column, i: Column) -> Column:
        near = F.filter(F.slice(places, i + 1, F.col(block)), lambda x: x["at"] < h["at"] + F.col(block))
        window = F.array(F.transform(near, lambda x: x["word"]))
        held = F.element_at(F.transform(window, lambda w: F.when(
            (F.size(F.array_intersect(w, F.col(must))) == F.size(must)) & ~F.arrays_overlap(w, F.col(never)),
            F.size(F.array_intersect(w, F.col(words))))), 1)
        return F.when(F.array_contains(F.col(words), h["word"]), held)

    best = F.array_max(F.transform(places, counted))
    return F.when(best >= F.col(need), best)


def joined_templates(rows: DataFrame, templates, containment: float) -> DataFrame:
    """(_row, label, containment) of every row of ``extracted`` with a block that holds a template; of equal labels the best."""
    spark = rows.sparkSession
    universe = sorted({w for t in templates for w in t.words})
    counted = rows.select(F.explode("_held").alias("word")).groupBy("word").count().collect()
    counts = {row["word"]: row["count"] for row in counted}
    rank = {word: i for i, word in enumerate(sorted(universe, key=lambda w: (counts.get(w, 0), w)))}
    ranked = F.create_map(*[F.lit(v) for word in universe for v in (word, rank[word])])

    prefixes, full = [], []
    for number, t in enumerate(templates):
        places = sorted(rank[w] for w in t.words)
        c = needed(len(places), containment)
        full.append((number, t.label, c, len(places), t.block, t.words, list(t.must), list(t.never)))
        prefixes += [(place, number, i, len(places), c) for i, place in enumerate(places[:len(places) - c + 1])]
    index = F.broadcast(spark.createDataFrame(prefixes, "_rank int, _template int, _i int, _size int, _c int"))
    template = F.broadcast(spark.createDataFrame(
        full, "_template int, label string, _need int, _full int, _block int, _words array<string>, _must array<string>, _never array<string>"))
    rare = F.array(*[F.lit(place) for place in sorted({p[0] for p in prefixes})])

    able = rows.filter(F.col("_places").isNotNull())
    sets = able.select("_row", F.array_sort(F.transform("_held", lambda w: ranked[w])).alias("_set"))
    tokens = sets.select("_row", F.size("_set").alias("_of"), F.posexplode("_set").alias("_j", "_rank")).filter(F.array_contains(rare, F.col("_rank")))
    shared = F.least(F.col("_size") - F.col("_i"), F.col("_of") - F.col("_j"))
    pairs = (tokens.join(index, "_rank")
             .filter((F.col("_of") >= F.col("_c")) & (F.col("_j") <= F.col("_of") - F.col("_c")) & (shared >= F.col("_c"))))
    pairs = pairs.select("_row", "_template").distinct()
    found = pairs.join(able.select("_row", "_places"), "_row").join(template, "_template")
    best = found.select("_row", "label", "_full", _best_block("_places", "_words", "_must", "_never", "_need", "_block").alias("_best"))
    return best.filter(F.col("_best").isNotNull()).groupBy("_row", "label").agg(F.max(F.col("_best") / F.col("_full")).alias("containment"))


def template_join(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, label, containment) of every text with a block that holds a template; of equal labels the best.

    Rows with the same key count as one document. Null and empty texts hold nothing, an empty table gives no rows; texts
    are read whole, whatever their length, and other columns are not read. The templates are a fixed list; what is
    broadcast are their words and prefixes, and what comes to the driver is one count per template word.
    """
    rows = extracted(docs, templates, containment, key, text)
    found = joined_templates(rows, templates, containment).join(rows.select("_row", "_key"), "_row")
    return found.groupBy(F.col("_key").alias(key), "label").agg(F.max("containment").alias("containment"))


def scan(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, n_words, places of the phrases, their labels, the labels of both ways, and a score.

    The score is 1 where a phrase stands, else the best containment, else 0. Null texts count as empty; every row gives
    one row, repeated ids and texts too, and an empty table none. Texts of any length are read whole; columns other than
    doc_id and text are not read.
    """
    rows = extracted(docs, templates, containment, "doc_id", "text")
    hits = joined_templates(rows, templates, containment).groupBy("_row").agg(
        F.collect_set("label").alias("_more"), F.max("containment").alias("_best"))
    both = rows.drop("_held", "_places").join(hits, "_row", "left")
    n = F.aggregate("_phrases", F.lit(0), lambda a, s: a + s["places"]).cast("long")
    base = F.array_sort(F.array_distinct(F.transform("_phrases", lambda s: s["label"])))
    more = F.coalesce("_more", F.array().cast("array<string>"))
    return both.select(
        F.col("_key").alias("doc_id"), "n_words", n.alias("n_base"),
        F.array_min(F.transform("_phrases", lambda s: s["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform("_phrases", lambda s: s["last"])).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.greatest(F.when(n > 0, 1.0).otherwise(0.0), F.coalesce("_best", F.lit(0.0))).alias("score"))
