"""Generated answers and user functions over the conversations."""

from pyspark.sql import functions as F

from notemill.functions import text as tx
from notemill.operators import evaluation as ev, python_functions as pf
from notemill.plans import sql
from notemill.plans.registering import register
from notemill.plans.standins import documents, instruction_pairs
from notemill.plans.queries_tokens import _PAIRS
from notemill.session import spread
from notemill.sources.tables import table

QUERIES, SQL, query = register()


def _answered(spark, folder):
    """Instruction pairs with a canned model answer: full text, two stop tokens, or no marker at all."""
    kind, output = F.col("conv_id") % 4, F.col("output")
    body = (F.when(kind == 0, F.concat(output, F.lit("<|EOT|> rest")))
            .when(kind == 1, F.concat(output, F.lit(" <|end|> more <|EOT|> rest"))).otherwise(output))
    generated = F.when(kind == 2, body).otherwise(F.concat(tx.prompt(F.col("instruction")), body))
    return instruction_pairs(spark, folder).withColumn("generated", generated)


_ANSWERED = f"""{_PAIRS},
answered AS (SELECT *, CASE WHEN conv_id % 4 = 2 THEN body ELSE prompt || body END AS generated FROM (
  SELECT *, CASE conv_id % 4 WHEN 0 THEN output || '<|EOT|> rest' WHEN 1 THEN output || ' <|end|> more <|EOT|> rest' ELSE output END AS body FROM asked))"""
_RESPONSE = sql.strip("substr(generated, instr(generated, '### Response:') + 13)")


def _cut(x: str, stop: str) -> str:
    return sql.strip(f"string_split({x}, '{stop}')[1]")


_FIRST_STOP = f"""responses AS (SELECT *, {_RESPONSE} AS r FROM answered),
cleaned AS (SELECT *, CASE WHEN contains(r, '<|EOT|>') THEN {_cut('r', '<|EOT|>')} WHEN contains(r, '<|end|>') THEN {_cut('r', '<|end|>')}
  WHEN contains(r, '<|endoftext|>') THEN {_cut('r', '<|endoftext|>')} ELSE r END AS answer FROM responses)"""
_EACH_STOP = _cut(_cut(_cut(sql.strip("string_split(generated, '### Instruction:')[1]"), "<|EOT|>"), "<|end|>"), "<|endoftext|>")
_EVALUATED = f"""{_ANSWERED}, {_FIRST_STOP},
evaluated AS (SELECT row_number() OVER (ORDER BY pair_id) AS example_id, instruction, output AS expected_output, answer AS generated_output,
  {sql.word_count('output')} AS expected_length, {sql.word_count('answer')} AS generated_length, 'success' AS status FROM cleaned)"""


@query(f"WITH {_ANSWERED}, {_FIRST_STOP} SELECT pair_id, r AS response, answer FROM cleaned")
def responses(spark, folder):
    return _answered(spark, folder).select(
        "pair_id", tx.response(F.col("generated")).alias("response"),
        ev.cleaned_response(F.col("generated")).alias("answer"))


@query(f"WITH {_ANSWERED} SELECT pair_id, {_EACH_STOP.replace('generated', 'body')} AS answer FROM answered")
def completions(spark, folder):
    kind = F.col("conv_id") % 4
    body = (F.when(kind == 0, F.concat("output", F.lit("<|EOT|> rest")))
            .when(kind == 1, F.concat("output", F.lit(" <|end|> more <|EOT|> rest"))).otherwise(F.col("output")))
    return instruction_pairs(spark, folder).select("pair_id", ev.cleaned_completion(body).alias("answer"))


def _evaluated(spark, folder, examples=None):
    numbered = ev.numbered_examples(_answered(spark, folder), ["pair_id"], examples)
    return ev.evaluation_table(numbered, ev.cleaned_response(F.col("generated")))


@query(f"WITH {_EVALUATED} SELECT * FROM evaluated")
def evaluation_table(spark, folder):
    return _evaluated(spark, folder)


@query(f"WITH {_EVALUATED} SELECT * FROM evaluated WHERE example_id <= 20")
def evaluation_first_twenty(spark, folder):
    return _evaluated(spark, folder, 20)


@query(f"WITH {_EVALUATED} SELECT count(*) FILTER (status = 'success') AS successful, count(*) AS examples FROM evaluated")
def evaluation_summary(spark, folder):
    return ev.status_summary(_evaluated(spark, folder))


def _echo_model():
    """Stand-in model: sampling fails for a batch holding a long prompt, greedy for every fifth length."""
    def sample(prompts):
        if any(len(p) > 400 for p in prompts):
            raise RuntimeError("batch too long")
        return [greedy(p) for p in prompts]

    def greedy(prompt):
        if len(prompt) % 5 == 0:
            raise ValueError(f"cannot answer {len(prompt)} characters")
        return prompt + "echo " + prompt[16:26]
    return sample, greedy


_ECHO = f"""{_PAIRS}, echoed AS (SELECT pair_id, instruction, output, length(prompt) % 5 = 0 AS failed,
  length(prompt) AS n, {sql.strip("'echo ' || substr(prompt, 17, 10)")} AS echo FROM asked)"""


@query(f"""WITH {_ECHO} SELECT row_number() OVER (ORDER BY pair_id) AS example_id, instruction, output AS expected_output,
  CASE WHEN failed THEN 'ERROR: cannot answer ' || n || ' characters' ELSE echo END AS generated_output,
  {sql.word_count('output')} AS expected_length, CASE WHEN failed THEN 0 ELSE {sql.word_count('echo')} END AS generated_length,
  CASE WHEN failed THEN 'error' ELSE 'success' END AS status FROM echoed""")
def model_evaluation(spark, folder):
    """Prompts go through a user model in batches; failing rows are reported, the others go on."""
    numbered = spread(ev.numbered_examples(instruction_pairs(spark, folder), ["pair_id"]), "pair_id")
    answers = numbered.withColumn("p", pf.predictions(tx.prompt(F.col("instruction")), _echo_model))
    return ev.evaluation_table(answers, ev.cleaned_response(F.col("p.text")), F.col("p.error"))


@query(f"SELECT doc_id, {sql.word_count('text')} AS words FROM documents")
def value_function(spark, folder):
    count = pf.per_value(lambda text: len(text.split()), "long")
    return documents(spark, folder).select(
        "doc_id", count("text").alias("words"))


@query(f"""WITH {_PAIRS} SELECT pair_id, length(prompt) AS prompt_length, length(target) AS target_length FROM asked""")
def batch_function(spark, folder):
    def lengths(frame):
        return frame.assign(prompt_length=frame["prompt"].str.len(), target_length=frame["target"].str.len())[
            ["pair_id", "prompt_length", "target_length"]]
    rows = instruction_pairs(spark, folder).select(
        "pair_id", tx.prompt(F.col("instruction")).alias("prompt"), tx.target(F.col("output")).alias("target"))
    return pf.per_batch(rows, lengths, "pair_id string, prompt_length long, target_length long")
