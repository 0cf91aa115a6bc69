"""Generated answers: cleaning, evaluation tables and summaries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import text as tx
from notemill.operators import ranks
from notemill.operators.once import evaluate_once


def cleaned_response(generated: Column) -> Column:
    """Text after the response marker, cut at the first listed stop token that occurs."""
    return tx.cut_at_first_listed_stop(tx.response(generated))


def cleaned_completion(generated: Column) -> Column:
    """A completion without its prompt: cut at a new instruction, then at each stop token in turn."""
    stopped = F.substring_index(generated, fv.INSTRUCTION_MARKER, 1)
    return tx.cut_at_each_stop(tx.strip(stopped))


def numbered_examples(rows: DataFrame, order, examples: int | None = None) -> DataFrame:
    """Instruction and output with ``example_id`` from 1 by order; ``examples`` keeps the first so many.

    Numbering comes before answering: a sort by range looks at its input twice, and a model must not
    answer twice.
    """
    if examples:
        rows = rows.orderBy(*order).limit(examples)
    return ranks.dense_index(rows, list(order), "example_id", start=1)


def evaluation_table(numbered: DataFrame, generated: Column, error: Column | None = None) -> DataFrame:
    """example_id, instruction, expected and generated output, word lengths and status.

    A row with an error gets the message and length 0; the others are not affected.
    """
    error = F.lit(None).cast("string") if error is None else error
    answered = evaluate_once(numbered, {"_generated": generated, "_error": error})
    failed = F.col("_error").isNotNull()
    return answered.select(
        "example_id", "instruction", F.col("output").alias("expected_output"),
        F.when(failed, F.concat(F.lit("ERROR: "), F.col("_error"))).otherwise(F.col("_generated")).alias("generated_output"),
        tx.word_count(F.col("output")).alias("expected_length"),
        F.when(failed, 0).otherwise(tx.word_count(F.col("_generated"))).cast("long").alias("generated_length"),
        F.when(failed, "error").otherwise("success").alias("status"))


def status_summary(evaluated: DataFrame) -> DataFrame:
    return evaluated.agg(F.count_if(F.col("status") == "success").alias("successful"), F.count("*").alias("examples"))
