import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from notemill import session
from notemill.functions import sentences as sf, text as tx, tokens as tk
from notemill.operators import joins, ranks, sentences as st


def column(texts, values, expression):
    return [r[0] for r in texts(values).orderBy("id").select(expression).collect()]


def test_strip_and_words_follow_unicode(texts):
    values = [" a b ", " x ", "", None, "\x1cone\x1f two　", "\n\t"]
    assert column(texts, values, tx.strip(F.col("text"))) == [v if v is None else v.strip() for v in values]
    assert column(texts, values, tx.word_count(F.col("text"))) == [0 if v is None else len(v.split()) for v in values]
    assert column(texts, values, tx.word_count(F.col("text"), null_as_word=True))[3] == 1


def test_reference_lists(texts):
    got = column(texts, [" (A 2001); ; (B)", None, "((A))", ";", "x"], tx.reference_list(F.col("text")))
    assert got == [["A 2001", "B"], [], ["A"], [], ["x"]]


def test_lines_and_preview(texts):
    assert column(texts, [" a \n\n b\r\n c d \n"], tx.normalise_lines(F.col("text"))) == ["a\nb\nc\nd"]
    assert column(texts, ["x" * 80, "y" * 81], tx.preview(F.col("text"))) == ["x" * 80, "y" * 80 + "..."]


def test_response_and_stop_tokens(texts):
    values = ["p ### Response:\n out", "no marker in this text", "### Response: a ### Response: b"]
    python = [v[v.find("### Response:") + 13:].strip() for v in values]
    assert column(texts, values, tx.response(F.col("text"))) == python
    both = ["x<|end|>y<|EOT|>z", "x<|EOT|>y<|end|>z", "clean"]
    assert column(texts, both, tx.cut_at_first_listed_stop(F.col("text"))) == ["x<|end|>y", "x", "clean"]
    assert column(texts, both, tx.cut_at_each_stop(F.col("text"))) == ["x", "x", "clean"]


def test_entity_names(texts):
    values = ["TP53 [cytosol]", "A1 [x]", "12345", "BRCA1 gene", "X activated", "NF-kB [a] [b]"]
    names = texts(values).select("id", tx.entity_name(F.col("text")).alias("n")).filter(tx.is_entity_name(F.col("n")))
    assert [r["n"] for r in names.orderBy("id").collect()] == ["TP53", "NF-kB"]


def test_lookup_default(texts):
    got = column(texts, ["a", "b", None], tx.lookup(F.col("text"), {"a": "1"}, "none"))
    assert got == ["1", "none", "none"]


def test_sentence_rule(texts):
    values = ["One two. Three four! (Five) six? Seven", "Dr. Smith et al. Found it. See Fig. Two, e.g. This.", "", None, "a. b. C"]
    got = column(texts, values, sf.split_sentences(F.col("text")))
    assert got == [["One two.", "Three four!", "(Five) six?", "Seven"], ["Dr. Smith et al. Found it.", "See Fig. Two, e.g. This."],
                   [], [], ["a. b.", "C"]]


def test_sentences_keep_all_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "text", sf.split_sentences(F.col("text")).alias("s")).collect()
    for row in docs:
        assert re.sub(r"\s|[\x1c-\x1f]", "", "".join(row["s"])) == re.sub(r"\s|[\x1c-\x1f]", "", row["text"])


def test_sentence_filter(texts):
    values = [".", "ok", "123 45.", "word", "a longword", "two words", "longsingleword", "   "]
    kept = texts(values).filter(sf.is_sentence(F.col("text"))).orderBy("id").collect()
    assert [r["text"] for r in kept] == ["a longword", "two words", "longsingleword"]


NOTES = [("F1", 0, "One two three. Again here.", "o1"), ("F2", 1, "One two three. Again here.", "o1"), ("F1", 2, "", "o2"),
         ("F1", 3, "Again here. Hm.", "o3"), ("F1", 4, None, None)]


def rows(spark):
    return spark.createDataFrame(NOTES, "file_id string, row_order long, notes string, original_notes string")


def test_sentence_table_keeps_empty_notes(spark):
    got = sorted(tuple(r) for r in st.sentence_table(rows(spark)).select("note_index", "sentence", "num_sentences", "count").collect()
                 if r["sentence"])
    assert got == [(0, "Again here.", 2, 2), (0, "One two three.", 2, 1), (2, "Again here.", 2, 2), (2, "Hm.", 2, 1)]
    empty = [tuple(r) for r in st.sentence_table(rows(spark)).filter("sentence is null").select("note_index", "num_sentences", "count").collect()]
    assert sorted(empty) == [(1, 0, None), (3, 0, None)]


def test_filtered_sentence_table(spark):
    got = sorted(tuple(r) for r in st.filtered_sentence_table(rows(spark)).select("note_index", "sentence", "count").collect())
    assert got == [(0, "Again here.", 2), (0, "One two three.", 1), (1, "Again here.", 2)]


def test_note_diagnosis(spark):
    assert tuple(st.note_diagnosis(rows(spark)).first()) == (4, 1, 0, 2)


def test_word_tokens(texts):
    got = column(texts, ["Hi, é1!", None, "<|EOT|>x"], tk.words(F.col("text"), ("<|EOT|>",)))
    assert got == [["Hi", ",", "é1", "!"], [], ["<|EOT|>", "x"]]
    assert column(texts, ["abcdefgh"], tk.pieces(F.col("text"))) == [["abc", "def", "gh"]]


@pytest.mark.parametrize("filtered", [False, True])
@pytest.mark.parametrize("small", [True, False])
def test_sentence_counts_equal_plain_python(spark, monkeypatch, small, filtered):
    """Whether the repeated sentences are broadcast or joined; hot, repeated and single ones, notes without any, copies, null places."""
    monkeypatch.setattr(joins, "small_enough", lambda *a, **b: small)
    rng = random.Random(4)
    pool = ["Everyone says this one.", "No.", "A."] + [f"Shared sentence number {i}." for i in range(20)]
    texts = [" ".join(rng.choice(pool) if rng.random() < 0.6 else f"Only sentence {n} of {k} here." for k in range(rng.randint(0, 12))) for n in range(150)]
    texts += texts[:30] + ["", "Everyone says this one. " * 40, None]
    given = [(t, "o", n) for n, t in enumerate(texts)] + [(texts[5], "other", None)]
    df = spark.createDataFrame(given, "notes string, original_notes string, row_order long").repartition(5)
    got = (st.filtered_sentence_table if filtered else st.sentence_table)(df, shown={"size": F.length("notes")})
    split = {r["notes"]: (r["s"], r["k"]) for r in df.select("notes", sf.split_sentences(F.col("notes")).alias("s"), sf.kept_sentences(F.col("notes")).alias("k")).collect()}
    first = {}
    for t, o, n in given:
        first.setdefault(t if filtered else (t, o), []).append(n)
    notes = sorted(((min([n for n in ns if n is not None], default=-1), k if filtered else k[0]) for k, ns in first.items()), key=lambda x: x[0])
    lists = [(t, split[t][filtered]) for _, t in notes if split[t][1] or not filtered]
    counts = Counter(x for _, s in lists for x in s if not filtered or len(x) >= 5)
    want = [(i, None if t is None else len(t), len(s), x, counts[x] if x is not None else None)
            for i, (t, s) in enumerate(lists) for x in (s or [None]) if not filtered or len(x) >= 5]
    key = lambda r: tuple((v is None, v) for v in r)
    assert sorted((tuple(r) for r in got.select("note_index", "size", "num_sentences", "sentence", "count").collect()), key=key) == sorted(want, key=key)


def test_note_texts_are_moved_once(spark, monkeypatch):
    """Notes are written once, with what is shown of them; they are numbered without their texts."""
    seen = []
    for module in (st, ranks, joins):
        monkeypatch.setattr(module, "materialise", lambda df, label="table", write=session.materialise: seen.append(df.columns) or write(df, label))
    df = spark.createDataFrame([("One thing. Two things.", "o", 1), ("One thing. ", "p", 2)], "notes string, original_notes string, row_order long")
    assert st.sentence_table(df, shown={"size": F.length("notes")}).count() == 3
    assert not any("notes" in columns or "original_notes" in columns for columns in seen)
    assert sum("sentences" in columns for columns in seen) == 1
