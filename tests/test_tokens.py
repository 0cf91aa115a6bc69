import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import tokens as tk
from notemill.operators import lookups, training_rows as tr, vocabulary as vb


def brute_terms(words, terms):
    """Leftmost, then longest."""
    out, i = [], 0
    while i < len(words):
        n = max((n for n in (4, 3, 2) if tuple(words[i:i + n]) in terms), default=1)
        out.append(" ".join(words[i:i + n]))
        i += n
    return out


@pytest.mark.parametrize("partitions, small", [(1, True), (5, False), (2, None)])
def test_terms_equal_brute_force(spark, partitions, small):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("abcd", k=rng.randint(0, 40)))) for i in range(60)] + [(60, None), (61, "a")]
    terms = ["a b", "b c d", "a b c d", "d d", "c", "a b"]
    table = vb.term_keys(spark.createDataFrame([(t,) for t in terms], "term string"))
    df = spark.createDataFrame(rows, "id long, text string").repartition(partitions)
    got = {r["id"]: r["tokens"] for r in vb.term_tokens(df, "id", "text", table, small).collect()}
    known = {tuple(t.split()) for t in terms}
    assert got == {i: brute_terms((text or "").split(), known) for i, text in rows}


@pytest.mark.parametrize("small", [True, False])
def test_long_terms_and_those_cut_off_by_the_end(spark, small):
    terms = ["a b c d e f g", "a b", "b c d", "g a", "x x x x x x"]
    texts = ["a b c d e f g a b", "a b c d e f", "x x x x x x x x x x x x x", "g a b c", "b c", "a", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    table = vb.term_keys(spark.createDataFrame([(t,) for t in terms], "term string"))
    got = [r["tokens"] for r in vb.term_tokens(df, "id", "text", table, small).orderBy("id").collect()]
    assert got == [["a b c d e f g", "a b"], ["a b", "c", "d", "e", "f"], ["x x x x x x"] * 2 + ["x"], ["g a", "b", "c"], ["b", "c"], ["a"], []]


def test_one_row_per_distinct_token(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice(["a", "b", "é", "", "longer"]) for _ in range(rng.randint(0, 30))]) for i in range(40)] + [(40, None), (41, ["z"] * 5000)]
    df = spark.createDataFrame(rows, "id long, t array<string>")
    placed = lookups.distinct_tokens(df, "id", F.col("t"))
    assert placed.filter("places is not null").count() == sum(len(set(t or [])) for _, t in rows)
    back = lookups.in_order(placed, "id", F.col("token"), "t")
    assert {r["id"]: r["t"] for r in back.collect()} == {i: t or [] for i, t in rows}


@pytest.mark.parametrize("small", [True, False])
def test_encoding_in_place_and_by_dictionary(spark, small):
    df = spark.createDataFrame([(1, ["b", "a", "b", "zz"]), (2, []), (3, ["a"])], "id long, t array<string>")
    vocabulary = spark.createDataFrame([("a", 7), ("b", 9)], "token string, id long")
    got = {r["id"]: r["ids"] for r in vb.encode(df, "id", F.col("t"), vocabulary, 0, "ids", small).collect()}
    assert got == {1: [9, 7, 9, 0], 2: [], 3: [7]}


@pytest.mark.parametrize("small", [True, False])
def test_subwords(spark, small):
    df = spark.createDataFrame([(1, "whole broken whole"), (2, None), (3, "")], "id long, text string")
    table = spark.createDataFrame([("whole",)], "token string")
    got = {r["id"]: r["tokens"] for r in vb.subword_tokens(df, "id", "text", table, small=small).collect()}
    assert got == {1: ["whole", "bro", "ken", "whole"], 2: [], 3: []}


def test_word_count_columns(spark):
    df = spark.createDataFrame([("a b",), (None,)], "notes string")
    got = vb.add_word_counts(df, "notes", tk.words(F.col("notes")), "w").collect()
    assert [tuple(r) for r in got] == [("a b", ["a", "b"], 2), (None, [], 0)]
    assert vb.add_word_counts(df, "absent", F.lit(None), "w").columns == ["notes"]


def test_vocabulary_grows_after_the_highest_id(spark):
    vocabulary = spark.createDataFrame([("a", 0), ("b", 9)], "token string, id long")
    new = spark.createDataFrame([("z",), ("c",), ("a",), ("c",)], "token string")
    extended = vb.extend_vocabulary(vocabulary, new)
    assert {r["token"]: r["id"] for r in extended.collect()} == {"a": 0, "b": 9, "c": 10, "z": 11}
    assert tuple(vb.extension_report(vocabulary, extended).first()) == (2, 4, 2)
    assert vb.extend_vocabulary(vocabulary, vocabulary.select("token")).count() == 2


def test_special_tokens(spark):
    plain = spark.createDataFrame([("a", 4)], "token string, id long")
    table, pad = vb.with_special_tokens(plain)
    assert pad == fv.PAD_TOKEN and {r["token"]: r["id"] for r in table.collect()} == {"a": 4, "[PAD]": 5, "<|EOT|>": 6}
    with_eos = spark.createDataFrame([(fv.EOS_TOKEN, 3)], "token string, id long")
    table, pad = vb.with_special_tokens(with_eos)
    assert pad == fv.EOS_TOKEN and {r["token"]: r["id"] for r in table.collect()} == {fv.EOS_TOKEN: 3, "<|EOT|>": 4}


def training(spark, max_length, small=None):
    pairs = spark.createDataFrame([("a", "hi hi", "yes"), ("b", "hi", "no " + fv.EOS_TOKEN), ("c", "x " * 50, "y")],
                                  "pair_id string, instruction string, output string")
    words = ["#", "Instruction", ":", "Response", "hi", "yes", fv.END_OF_TURN, fv.EOS_TOKEN]
    vocabulary = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "token string, id long")
    return tr.training_rows(pairs, "pair_id", vocabulary, 0, 8, max_length, small)


@pytest.mark.parametrize("small", [True, False, None])
def test_training_rows_mask_the_prompt(spark, small):
    rows = {r["pair_id"]: r for r in training(spark, 30, small).collect()}
    prompt = [1, 1, 1, 2, 3, 5, 5, 1, 1, 1, 4, 3]
    assert rows["a"]["input_ids"] == prompt + [6, 7] and rows["a"]["labels"] == [-100] * 12 + [6, 7]
    assert rows["b"]["input_ids"][-3:] == [0, 8, 7] and not rows["b"]["fully_masked"]
    assert rows["c"]["fully_masked"] and set(rows["c"]["labels"]) == {-100} and len(rows["c"]["input_ids"]) == 30
    assert all(len(r["input_ids"]) == len(r["labels"]) for r in rows.values())


def test_batches_are_padded_to_their_longest(spark):
    rows = {r["pair_id"]: r for r in tr.pad_batches(training(spark, 30), "pair_id", 8, 2).collect()}
    a, b, c = rows["a"], rows["b"], rows["c"]
    assert (a["batch"], b["batch"], c["batch"]) == (0, 0, 1)
    assert len(a["input_ids"]) == len(b["input_ids"]) == 14 and len(c["input_ids"]) == 30
    assert b["attention_mask"][-2] is False and a["attention_mask"] == [True] * 14   # a real pad id in the text is masked too


def test_mask_and_length(spark):
    row = spark.sql("select array(5, 6, 7, 8) ids").select(
        tr.mask_labels(F.col("ids"), F.lit(2)).alias("l"), tr.non_pad_length(F.col("ids"), F.lit(6)).alias("n")).first()
    assert row["l"] == [-100, -100, 7, 8] and row["n"] == 3


TURNS = [(1, 2, "assistant", "A"), (1, 0, "system", "S"), (1, 1, "user", "U"), (1, 3, "tool", "T"), (2, 0, "user", "V")]


def test_chats(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    got = {}
    for r in tr.render_chats(turns, generation_prompt=True).orderBy("place").collect():
        got[r["conv_id"]] = got.get(r["conv_id"], "") + r["piece"]
    whole = fv.BOS_TOKEN + "S\n\nUser: U\n\nAssistant: A" + fv.EOS_TOKEN + "Assistant:"
    assert got == {1: whole, 2: fv.BOS_TOKEN + "User: V\n\nAssistant:"}
    assert tr.render_chats(turns).count() == len(TURNS) + 2
    lists = spark.createDataFrame([([("system", "S"), ("user", "U"), ("assistant", "A"), ("tool", "T")],)], "m array<struct<role:string,text:string>>")
    assert lists.select(tr.chat_text(F.col("m"), True)).first()[0] == whole


def test_whole_chats(spark):
    """Turns out of order, a hot conversation over many partitions, null texts and conversations."""
    turns = [*TURNS, (None, 1, "user", "n"), (3, 1, "user", None), (3, 0, "system", "S")] + [(9, i, "user", f"t{i}") for i in range(400)]
    random.Random(1).shuffle(turns)
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(7)
    got = {r["conv_id"]: r["chat"] for r in tr.chats(frame, generation_prompt=True).collect()}
    assert got == {1: fv.BOS_TOKEN + "S\n\nUser: U\n\nAssistant: A" + fv.EOS_TOKEN + "Assistant:", 2: fv.BOS_TOKEN + "User: V\n\nAssistant:",
                   3: fv.BOS_TOKEN + "S\n\nAssistant:", None: fv.BOS_TOKEN + "User: n\n\nAssistant:",
                   9: fv.BOS_TOKEN + "".join(f"User: t{i}\n\n" for i in range(400)) + "Assistant:"}
    assert tr.chats(frame.limit(0)).collect() == []


def test_long_batches_are_looked_up_in_pieces(spark):
    """Neither the rows that go to a worker at once nor the items it holds as objects grow with the input."""
    lists = pa.array([["a"] * 30, None, [], ["b"] * 70, ["c"] * 200, ["d"], ["e"] * 99, ["f"]])
    cut = list(lookups.pieces(lists, 100))
    assert [len(p) for p in cut] == [4, 1, 2, 1] and pa.concat_arrays(cut).equals(lists) and list(lookups.pieces(lists.slice(0, 0))) == []
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        df = spark.range(1000).select("id", F.concat(F.lit("known word "), F.repeat(F.lit("x y "), (F.col("id") % 300).cast("int"))).alias("text"))
        table = spark.createDataFrame([("known",)], "token string")
        got = {r["id"]: r["tokens"] for r in vb.subword_tokens(df, "id", "text", table, small=True).collect()}
        assert int(spark.conf.get(name)) <= 250
        assert all(got[i] == ["known", "wor", "d"] + ["x", "y"] * (i % 300) for i in range(1000))
    finally:
        spark.conf.set(name, before)
