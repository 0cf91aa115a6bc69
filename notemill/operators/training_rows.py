"""Chat text, and masked and padded id rows for instruction tuning."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import text as tx, tokens as tk
from notemill.operators import ranks, vocabulary as vb
from notemill.session import materialise


def message_text(role: Column, text: Column) -> Column:
    """One message as the chat format writes it; other roles give nothing."""
    return (F.when(role == "user", F.concat(F.lit("User: "), text, F.lit("\n\n")))
            .when(role == "assistant", F.concat(F.lit("Assistant: "), text, F.lit(fv.EOS_TOKEN)))
            .when(role == "system", F.concat(text, F.lit("\n\n"))).otherwise(""))


def chat_text(messages: Column, generation_prompt: bool = False) -> Column:
    """The chat of a list of (role, text) held in one row, begin token first."""
    body = F.array_join(F.transform(messages, lambda m: message_text(m["role"], m["text"])), "")
    return F.concat(F.lit(fv.BOS_TOKEN), body, F.lit("Assistant:" if generation_prompt else ""))


def _folded(conversation: str, head: str, tail: str):
    """Pieces that come in the order of their conversations to one text each; one conversation is held at a time."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, some, names = None, [], False, [conversation, "chat"]

        def chat() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([now, pa.array(["".join([head, *parts, tail])])], names=names)

        for batch in batches:
            keys, pieces = batch.column(0), batch.column(1).to_pylist()
            for i, piece in enumerate(pieces):
                if not some or keys[i].as_py() != now[0].as_py():
                    if some:
                        yield chat()
                    now, parts, some = keys.slice(i, 1), [], True
                parts.append(piece)
        if some:
            yield chat()

    return fold


def chats(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", generation_prompt: bool = False) -> DataFrame:
    """conversation, chat: the whole text of each conversation, its turns in order (equal ones by their text).

    Turns are dealt out by conversation and sorted within the tasks, which then write one text after the other. A null
    text is empty, a null conversation is one like the others. A task holds one conversation at a time, as it is one
    row of the result; for chats too long for a row there is ``render_chats``.
    """
    pieces = turns.select(conversation, turn, F.coalesce(message_text(F.col("role"), F.col("text")), F.lit("")).alias("_piece"))
    dealt = pieces.repartition(conversation).sortWithinPartitions(conversation, turn, "_piece").select(conversation, "_piece")
    kind = dealt.schema[0].dataType.simpleString()
    return dealt.mapInArrow(_folded(conversation, fv.BOS_TOKEN, "Assistant:" if generation_prompt else ""), f"`{conversation}` {kind}, chat string")


def render_chats(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                 generation_prompt: bool = False) -> DataFrame:
    """conversation, place, piece: the pieces that make up each chat when put together by place.

    A piece per message at its turn's place, the begin token one place before the first, the generation
    prompt one place after the last. Conversations are never collected, so their length does not matter.
    """
    pieces = turns.select(conversation, F.col(turn).cast("long").alias("place"), message_text(F.col("role"), F.col("text")).alias("piece"))
    ends = turns.groupBy(conversation).agg((F.min(turn) - 1).cast("long").alias("_head"), (F.max(turn) + 1).cast("long").alias("_tail"))
    marks = [F.struct(F.col("_head").alias("place"), F.lit(fv.BOS_TOKEN).alias("piece"))]
    if generation_prompt:
        marks.append(F.struct(F.col("_tail").alias("place"), F.lit("Assistant:").alias("piece")))
    return pieces.unionByName(ends.select(conversation, F.inline(F.array(*marks))))


def mask_labels(ids: Column, prompt_length: Column) -> Column:
    """Ids with the first ``prompt_length`` replaced by the ignore index."""
    return F.transform(ids, lambda x, i: F.when(i < prompt_length, F.lit(fv.IGNORE_INDEX)).otherwise(x))


def non_pad_length(ids: Column, pad_id: int) -> Column:
    return F.size(F.filter(ids, lambda x: x != pad_id))


def attention_mask(ids: Column, pad_id: int) -> Column:
    return F.transform(ids, lambda x: x != pad_id)


def training_rows(pairs: DataFrame, key: str, vocabulary: DataFrame, unknown_id: int, pad_id: int,
                  max_length: int = fv.MODEL_MAX_LENGTH, small: bool | None = None) -> DataFrame:
    """key, input_ids, labels, fully_masked from instruction and output.

    Prompt and answer are encoded as one text, cut to ``max_length``; the labels of the prompt are
    masked. A prompt that fills the whole row leaves every label masked, which the last column shows.
    """
    specials = (fv.EOS_TOKEN, fv.END_OF_TURN)
    source = tk.words(tx.prompt(F.col("instruction")), specials)
    texts = pairs.select(key, source.alias("_source"), tk.words(tx.target(F.col("output")), specials).alias("_target"))
    tokens = texts.select(key, F.size("_source").alias("_prompt"),
                          F.slice(F.concat("_source", "_target"), 1, max_length).alias("_tokens"))
    # the prompt length rides in the key column, so that collecting needs no second join
    packed = tokens.select(F.struct(F.col(key).alias("key"), "_prompt").alias("_pair"), "_tokens")
    encoded = vb.encode(packed, "_pair", F.col("_tokens"), vocabulary, unknown_id, "input_ids", small)
    prompt_ids = F.slice("input_ids", F.lit(1), F.col("_pair._prompt"))
    rows = encoded.withColumn("_masked", non_pad_length(prompt_ids, pad_id))
    return rows.select(F.col("_pair.key").alias(key), "input_ids",
                       mask_labels(F.col("input_ids"), F.col("_masked")).alias("labels"),
                       (F.col("_masked") >= F.size("input_ids")).alias("fully_masked"))


def pad_batches(rows: DataFrame, key: str, pad_id: int, batch_rows: int) -> DataFrame:
    """Rows in batches by key order, padded on the right to the longest of their batch, with a mask."""
    batched = ranks.dense_index(materialise(rows, "rows"), [key], "_index").withColumn(
        "batch", F.floor(F.col("_index") / batch_rows).cast("long"))
    width = F.max(F.size("input_ids")).over(Window.partitionBy("batch"))
    gap = F.col("_width") - F.size("input_ids")
    padded = batched.withColumn("_width", width).withColumns({
        "input_ids": F.concat("input_ids", F.array_repeat(F.lit(pad_id), gap)),
        "labels": F.concat("labels", F.array_repeat(F.lit(fv.IGNORE_INDEX), gap))})
    return padded.withColumn("attention_mask", attention_mask(F.col("input_ids"), pad_id)).drop("_index", "_width")
