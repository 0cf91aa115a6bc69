"""Tokens, vocabularies, chats and training rows."""

from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import text as tx, tokens as tk
from notemill.operators import training_rows as tr, vocabulary as vb
from notemill.plans import sql
from notemill.plans.registering import joined, register, rounded
from notemill.plans.standins import documents, instruction_pairs, page_pairs, word_set
from notemill.plans.queries_splits import PAIRS
from notemill.session import materialise, spread
from notemill.sources.tables import table

QUERIES, SQL, query = register()

TOP_WORDS = 1000
FIRST_IDS = ((vb.UNKNOWN, 0), (fv.BOS_TOKEN, 1), (fv.EOS_TOKEN, 2))
MAX_LENGTH = fv.MODEL_MAX_LENGTH
BATCH_ROWS = 8


# --- tokenizers -----------------------------------------------------------------------------------

@query(f"""SELECT doc_id, len(t) AS token_count, array_to_string(t, '|') AS tokens
FROM (SELECT doc_id, {sql.words('text')} AS t FROM documents)""")
def word_tokens(spark, folder):
    out = vb.add_word_counts(documents(spark, folder), "text", tk.words(F.col("text")), "words")
    return out.select("doc_id", F.col("text_token_count_words").cast("long").alias("token_count"),
                      joined("text_tokens_words").alias("tokens"))


_UNNESTED = f"""lists AS (SELECT doc_id, {sql.words('text')} AS t FROM documents),
placed AS MATERIALIZED (SELECT doc_id, unnest(range(len(t))) AS place, unnest(t) AS token FROM lists)"""
_TOP = f"top AS (SELECT token FROM placed GROUP BY token ORDER BY count(*) DESC, token LIMIT {TOP_WORDS})"
_PIECES = f"""parts AS (SELECT doc_id, place, CASE WHEN top.token IS NOT NULL THEN [placed.token]
    ELSE regexp_extract_all(placed.token, '(?s).{{1,3}}', 0) END AS p FROM placed LEFT JOIN top USING (token)),
collected AS (SELECT doc_id, sum(len(p))::BIGINT AS token_count, string_agg(array_to_string(p, '|'), '|' ORDER BY place) AS tokens FROM parts GROUP BY doc_id)"""


@query(f"""WITH {_UNNESTED}, {_TOP}, {_PIECES}
SELECT doc_id, coalesce(token_count, 0) AS token_count, coalesce(tokens, '') AS tokens FROM documents LEFT JOIN collected USING (doc_id)""")
def subword_tokens(spark, folder):
    docs = documents(spark, folder)
    top = vb.top_tokens(docs, tk.words(F.col("text")), TOP_WORDS)
    out = vb.subword_tokens(docs, "doc_id", "text", top, small=True)   # limited to TOP_WORDS rows
    return out.select("doc_id", F.size("tokens").cast("long").alias("token_count"), joined("tokens").alias("tokens"))


_TERMS = f"""item_words AS (SELECT {sql.words('text')} AS w FROM benchmark),
grams AS (SELECT DISTINCT w[i] || ' ' || w[i + 1] AS gram FROM (SELECT w, unnest(range(1, len(w))) AS i FROM item_words)
  WHERE regexp_matches(w[i], '^[\\p{{L}}\\p{{N}}]+$') AND regexp_matches(w[i + 1], '^[\\p{{L}}\\p{{N}}]+$'))"""
_CHOSEN = """pairs2 AS (SELECT doc_id, place, token, lead(token) OVER w AS following FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
hits AS (SELECT doc_id, place, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM pairs2
  WHERE following IS NOT NULL AND token || ' ' || following IN (SELECT gram FROM grams)),
chosen AS (SELECT doc_id, place FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY place) AS k FROM hits) WHERE k % 2 = 1),
folded AS (SELECT p.doc_id, p.place, CASE WHEN c.place IS NOT NULL THEN token || ' ' || following ELSE token END AS token
  FROM pairs2 p LEFT JOIN chosen c ON c.doc_id = p.doc_id AND c.place = p.place
  WHERE NOT EXISTS (SELECT 1 FROM chosen b WHERE b.doc_id = p.doc_id AND b.place = p.place - 1))"""


def _benchmark_terms(spark, folder):
    """Neighbouring words of the benchmark texts, as two-word terms."""
    words = table(spark, folder, "benchmark").select(tk.words(F.col("text")).alias("w")).filter(F.size("w") > 1)
    pairs = words.select("w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("i"))
    terms = pairs.select(F.array_join(F.slice("w", F.col("i"), F.lit(2)), " ").alias("term"))
    return terms.filter(F.col("term").rlike(r"^[\p{L}\p{N}]+ [\p{L}\p{N}]+\z")).distinct()


@query(f"""WITH {_UNNESTED}, {_TERMS}, {_CHOSEN}, collected AS (SELECT doc_id, count(*) AS token_count, string_agg(token, '|' ORDER BY place) AS tokens FROM folded GROUP BY doc_id)
SELECT doc_id, coalesce(token_count, 0) AS token_count, coalesce(tokens, '') AS tokens FROM documents LEFT JOIN collected USING (doc_id)""")
def term_tokens(spark, folder):
    terms = vb.term_keys(_benchmark_terms(spark, folder))
    out = vb.term_tokens(documents(spark, folder), "doc_id", "text", terms)
    return out.select("doc_id", F.size("tokens").cast("long").alias("token_count"), joined("tokens").alias("tokens"))


def _token_count_table(spark, folder):
    docs = documents(spark, folder)
    top = vb.top_tokens(docs, tk.words(F.col("text")), TOP_WORDS)
    terms = vb.term_keys(_benchmark_terms(spark, folder))
    words = docs.select("doc_id", F.size(tk.words(F.col("text"))).cast("long").alias("words"))
    pieces = vb.subword_tokens(docs, "doc_id", "text", top, small=True)
    folded = vb.term_tokens(docs, "doc_id", "text", terms)
    return (words.join(pieces.select("doc_id", F.size("tokens").cast("long").alias("pieces")), "doc_id")
            .join(folded.select("doc_id", F.size("tokens").cast("long").alias("terms")), "doc_id"))


@query(f"""WITH {_UNNESTED}, {_TOP}, {_PIECES}, {_TERMS}, {_CHOSEN},
folded_counts AS (SELECT doc_id, count(*) AS n FROM folded GROUP BY doc_id),
word_counts AS (SELECT doc_id, len(t) AS n FROM lists),
long AS (SELECT 'words' AS tokenizer, n FROM word_counts
  UNION ALL SELECT 'pieces', coalesce(token_count, 0) FROM documents LEFT JOIN collected USING (doc_id)
  UNION ALL SELECT 'terms', coalesce(n, 0) FROM documents LEFT JOIN folded_counts USING (doc_id))
{sql.describe('long', 'n', 'tokenizer')}""")
def tokenizer_comparison(spark, folder):
    counts = _token_count_table(spark, folder)
    long = counts.unpivot(["doc_id"], ["words", "pieces", "terms"], "tokenizer", "n")
    return rounded(vb.describe(long, "n", "tokenizer").drop("total"))


@query(f"WITH {_UNNESTED} SELECT token, count(*) AS n FROM placed GROUP BY token ORDER BY n DESC, token LIMIT 20")
def top_tokens(spark, folder):
    return vb.top_tokens(documents(spark, folder), tk.words(F.col("text")), 20)


_COLUMN_TOKENS = f"""{PAIRS}, lists AS (SELECT 'snippet' AS "column", {sql.words('snippet')} AS t FROM pairs
  UNION ALL SELECT 'notes', {sql.words('notes')} FROM pairs), sizes AS (SELECT "column", len(t) AS n FROM lists)"""


@query(f"""WITH {_COLUMN_TOKENS}, d AS ({sql.describe('sizes', 'n', '"column"', population=True)}) SELECT * FROM d""")
def tokenisation_statistics(spark, folder):
    return rounded(vb.tokenisation_statistics(page_pairs(spark, folder), ("snippet", "notes")).drop("total"))


@query(f"""WITH {_COLUMN_TOKENS}, c AS (SELECT "column", unnest(t) AS token FROM lists),
g AS (SELECT "column", token, count(*) AS n FROM c GROUP BY ALL)
SELECT "column", token, n FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, token) AS k FROM g) WHERE k <= 20""")
def top_tokens_per_column(spark, folder):
    return vb.top_tokens_per_column(page_pairs(spark, folder), ("snippet", "notes"))


@query(f"""SELECT doc_id, text, array_to_string({sql.words('text')}, '|') AS tokens FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 3""")
def sample_tokenisations(spark, folder):
    out = vb.sample_tokenisations(table(spark, folder, "documents"), "doc_id", "text")
    return out.withColumn("tokens", joined("tokens"))


# --- vocabulary -----------------------------------------------------------------------------------

_WORD_SETS = f"""old_words AS (SELECT DISTINCT unnest({sql.words('text')}) AS token FROM benchmark),
doc_words AS (SELECT DISTINCT unnest({sql.words('text')}) AS token FROM documents)"""
_VOCABULARY = f"""{_WORD_SETS},
base AS (SELECT token, row_number() OVER (ORDER BY token) + {len(FIRST_IDS) - 1} AS id FROM old_words
  UNION ALL SELECT * FROM (VALUES {', '.join(f"({sql.quoted(t)}, {i})" for t, i in FIRST_IDS)})),
extended AS (SELECT token, id FROM base UNION ALL
  SELECT token, row_number() OVER (ORDER BY token) + (SELECT max(id) FROM base) AS id FROM doc_words WHERE token NOT IN (SELECT token FROM base))"""


def _base_vocabulary(spark, folder):
    words = vb.numbered(word_set(table(spark, folder, "benchmark"), "text"), start=len(FIRST_IDS))
    first = spark.createDataFrame(FIRST_IDS, "token string, id long")
    return first.unionByName(words)


@query(f"WITH {_WORD_SETS} SELECT token FROM doc_words WHERE token NOT IN (SELECT token FROM old_words)")
def new_tokens(spark, folder):
    return vb.new_tokens(word_set(documents(spark, folder), "text"), word_set(table(spark, folder, "benchmark"), "text"))


@query(f"WITH {_VOCABULARY} SELECT token, id FROM extended")
def extended_vocabulary(spark, folder):
    return vb.extend_vocabulary(_base_vocabulary(spark, folder), word_set(documents(spark, folder), "text"))


@query(f"""WITH {_VOCABULARY} SELECT (SELECT count(*) FROM base) AS size_before, (SELECT count(*) FROM extended) AS size_after,
  (SELECT count(*) FROM extended) - (SELECT count(*) FROM base) AS added""")
def vocabulary_extension(spark, folder):
    base = _base_vocabulary(spark, folder)
    return vb.extension_report(base, vb.extend_vocabulary(base, word_set(documents(spark, folder), "text")))


_SPECIAL = f"""{_VOCABULARY}, vocab AS (SELECT * FROM extended UNION ALL SELECT '<|EOT|>', max(id) + 1 FROM extended)"""


def _training_vocabulary(spark, folder):
    extended = materialise(vb.extend_vocabulary(_base_vocabulary(spark, folder), word_set(documents(spark, folder), "text")), "extended")
    full, pad = vb.with_special_tokens(extended)
    return materialise(full, "vocabulary"), pad


@query(f"""WITH {_WORD_SETS}, base AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS id FROM old_words)
SELECT token, id FROM base UNION ALL SELECT '[PAD]', max(id) + 1 FROM base UNION ALL SELECT '<|EOT|>', max(id) + 2 FROM base""")
def padded_vocabulary(spark, folder):
    """A vocabulary without an end token gets a pad token of its own before the end-of-turn token."""
    words = vb.numbered(word_set(table(spark, folder, "benchmark"), "text"))
    full, pad = vb.with_special_tokens(words)
    return full.filter(F.lit(pad == fv.PAD_TOKEN))


@query(f"WITH {_SPECIAL} SELECT token, id FROM vocab WHERE id < 3 OR token = '<|EOT|>'")
def special_tokens(spark, folder):
    vocabulary, _ = _training_vocabulary(spark, folder)
    return vocabulary.filter((F.col("id") < len(FIRST_IDS)) | (F.col("token") == fv.END_OF_TURN))


# --- chats and training rows ------------------------------------------------------------------------

_MESSAGE = """CASE role WHEN 'user' THEN 'User: ' || text || chr(10) || chr(10) WHEN 'assistant' THEN 'Assistant: ' || text || '<｜end▁of▁sentence｜>'
  WHEN 'system' THEN text || chr(10) || chr(10) ELSE '' END"""


@query(f"""SELECT conv_id, turn::BIGINT AS place, {_MESSAGE} AS piece FROM conversations
UNION ALL SELECT conv_id, min(turn)::BIGINT - 1, '<｜begin▁of▁sentence｜>' FROM conversations GROUP BY conv_id
UNION ALL SELECT conv_id, max(turn)::BIGINT + 1, 'Assistant:' FROM conversations GROUP BY conv_id""")
def rendered_chats(spark, folder):
    return tr.render_chats(table(spark, folder, "conversations"), generation_prompt=True)


@query(f"""SELECT conv_id, '<｜begin▁of▁sentence｜>' || string_agg({_MESSAGE}, '' ORDER BY turn) || 'Assistant:' AS chat FROM conversations GROUP BY conv_id""")
def chat_texts(spark, folder):
    """One text per conversation."""
    return tr.chats(table(spark, folder, "conversations"), generation_prompt=True)


_PAIRS = f"""asked AS (SELECT u.conv_id, u.turn, lpad(u.conv_id::VARCHAR, 12, '0') || ':' || lpad(u.turn::VARCHAR, 6, '0') AS pair_id,
  '### Instruction:' || chr(10) || {sql.strip('u.text')} || chr(10) || '### Response:' || chr(10) AS prompt,
  a.text || chr(10) || '<|EOT|>' AS target, u.text AS instruction, a.text AS output
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant')"""


@query(f"WITH {_PAIRS} SELECT pair_id, prompt, target FROM asked")
def prompts(spark, folder):
    return instruction_pairs(spark, folder).select(
        "pair_id", tx.prompt(F.col("instruction")).alias("prompt"), tx.target(F.col("output")).alias("target"))


_SPECIAL_WORDS = sql.quoted(r"<｜end▁of▁sentence｜>|<\|EOT\|>|" + tk.WORD_OR_SIGN)
_ENCODED = f"""{_SPECIAL}, {_PAIRS},
lists AS (SELECT pair_id, regexp_extract_all(prompt, {_SPECIAL_WORDS}, 0) AS s, regexp_extract_all(target, {_SPECIAL_WORDS}, 0) AS t FROM asked),
cut AS (SELECT pair_id, len(s) AS prompt_length, list_concat(s, t)[1:{MAX_LENGTH}] AS tokens FROM lists),
placed AS (SELECT pair_id, prompt_length, unnest(range(len(tokens))) AS place, unnest(tokens) AS token FROM cut),
ids AS (SELECT pair_id, prompt_length, place, coalesce(id, 0) AS id FROM placed LEFT JOIN vocab USING (token)),
encoded AS MATERIALIZED (SELECT pair_id, any_value(prompt_length) AS prompt_length, list(id ORDER BY place) AS input_ids,
  list(CASE WHEN place < prompt_length THEN -100 ELSE id END ORDER BY place) AS labels FROM ids GROUP BY pair_id)"""


def _ids_text(column):
    return F.array_join(F.col(column).cast("array<string>"), " ")


def _training_rows(spark, folder):
    vocabulary, pad = _training_vocabulary(spark, folder)
    pad_id = vb.id_of(vocabulary, pad)
    return tr.training_rows(instruction_pairs(spark, folder), "pair_id", vocabulary, 0, pad_id, MAX_LENGTH), pad_id


@query(f"""WITH {_ENCODED}
SELECT pair_id, array_to_string(input_ids, ' ') AS input_ids, array_to_string(labels, ' ') AS labels,
  prompt_length >= len(input_ids) AS fully_masked FROM encoded""")
def training_rows(spark, folder):
    rows, _ = _training_rows(spark, folder)
    return rows.select("pair_id", _ids_text("input_ids").alias("input_ids"), _ids_text("labels").alias("labels"), "fully_masked")


@query(f"""WITH {_ENCODED},
batched AS (SELECT *, (row_number() OVER (ORDER BY pair_id) - 1) // {BATCH_ROWS} AS batch FROM encoded),
wide AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY batch) - len(input_ids) AS gap FROM batched),
padded AS (SELECT pair_id, batch, list_concat(input_ids, list_transform(range(gap), lambda x: 2)) AS ids,
  list_concat(labels, list_transform(range(gap), lambda x: -100)) AS labels FROM wide)
SELECT pair_id, batch, array_to_string(ids, ' ') AS input_ids, array_to_string(labels, ' ') AS labels,
  array_to_string(list_transform(ids, lambda x: CASE WHEN x <> 2 THEN 'true' ELSE 'false' END), ' ') AS attention_mask FROM padded""")
def padded_batches(spark, folder):
    rows, pad_id = _training_rows(spark, folder)
    out = tr.pad_batches(rows.drop("fully_masked"), "pair_id", pad_id, BATCH_ROWS)
    return out.select("pair_id", "batch", *[_ids_text(c).alias(c) for c in ("input_ids", "labels", "attention_mask")])


@query(f"""WITH {_ENCODED} SELECT pair_id, len(list_filter(input_ids, lambda x: x <> 2)) AS non_pad FROM encoded""")
def non_pad_lengths(spark, folder):
    rows, pad_id = _training_rows(spark, folder)
    return rows.select("pair_id", tr.non_pad_length(F.col("input_ids"), pad_id).cast("long").alias("non_pad"))
