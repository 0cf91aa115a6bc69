"""Token tables, vocabularies and tokenizers that look words up (see ``lookups``)."""

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import tokens as tk
from notemill.operators import joins, lookups, ranks
from notemill.operators.statistics import describe
from notemill.session import materialise

UNKNOWN = "<unk>"


def add_word_counts(df: DataFrame, column: str, tokens: Column, name: str) -> DataFrame:
    """Add ``{column}_tokens_{name}`` and ``{column}_token_count_{name}``; absent columns change nothing."""
    if column not in df.columns:
        return df
    listed = f"{column}_tokens_{name}"
    return df.withColumn(listed, tokens).withColumn(
        f"{column}_token_count_{name}", F.coalesce(F.size(listed), F.lit(0)))


def token_frequency(df: DataFrame, tokens: Column) -> DataFrame:
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def top_tokens(df: DataFrame, tokens: Column, top: int) -> DataFrame:
    return token_frequency(df, tokens).orderBy(F.desc("n"), "token").limit(top)


def _cut(known: set[str], words: list[str]) -> list[str]:
    """Known words whole, all others in pieces."""
    size, out = tk.PIECE_LENGTH, []
    for word in words:
        if word in known:
            out.append(word)
        else:
            out += [word[i:i + size] for i in range(0, len(word), size)]
    return out


def subword_tokens(df: DataFrame, key: str, column: str, whole_words: DataFrame, small: bool | None = None) -> DataFrame:
    """key, tokens: words of the table stay whole, all others are cut into short pieces."""
    table, small, broadcast = lookups.measured(whole_words.select("token"), small)
    words = tk.words(F.col(column))
    if small:
        cut = lookups.in_place(table, lambda t: frozenset(t.column("token").to_pylist()), _cut, "string")
        return df.select(key, cut(words).alias("tokens"))
    found = lookups.by_dictionary(df, key, words, table.withColumn("_known", F.lit(True)), broadcast)
    parts = F.when(F.col("_known"), F.array("token")).otherwise(tk.pieces(F.col("token")))
    return lookups.in_order(found, key, parts, "_parts").select(key, F.flatten("_parts").alias("tokens"))


def term_keys(terms: DataFrame, column: str = "term") -> DataFrame:
    """Terms as the blank-joined words they consist of, with their number; single words are dropped
    because the word tokenizer keeps those whole anyway."""
    words = terms.select(tk.words(F.col(column)).alias("_w"))
    return words.filter(F.size("_w") > 1).select(F.array_join("_w", " ").alias("gram"), F.size("_w").alias("_n")).distinct()


def _trie(terms: pa.Table) -> dict:
    """Terms as nested dictionaries by word; a term's end holds the whole term under the empty word."""
    root: dict = {}
    for gram in terms.column("gram").to_pylist():
        node = root
        for word in gram.split(" "):
            node = node.setdefault(word, {})
        node[""] = gram
    return root


def _folded(root: dict, words: list[str]) -> list[str]:
    """One walk: from each place the longest path of the trie that ends a term."""
    out, at, count = [], 0, len(words)
    while at < count:
        node, place, term, after = root.get(words[at]), at + 1, words[at], at + 1
        while node is not None:
            if "" in node:
                term, after = node[""], place
            if place == count:
                break
            node, place = node.get(words[place]), place + 1
        out.append(term)
        at = after
    return out


def term_tokens(df: DataFrame, key: str, column: str, terms: DataFrame, small: bool | None = None) -> DataFrame:
    """key, tokens: words, but the words of a listed term make one token; leftmost first, then longest.

    ``terms`` are those of ``term_keys``, of any number of words. A table that is small enough is a trie which is walked
    along every text in place. Beyond that the neighbouring word pairs of a text, each once with its places, meet
    the pairs that terms begin with; only where one does are the longer terms of that beginning tried, so that no
    word run is moved at places where no term can start.
    """
    terms, small, broadcast = lookups.measured(terms.select("gram", "_n"), small)
    words = df.select(key, tk.words(F.col(column)).alias("_words"))
    if small:
        fold = lookups.in_place(terms.select("gram"), _trie, _folded, "string")
        return words.select(key, fold("_words").alias("tokens"))
    pair = F.array_join(F.slice(F.split("gram", " "), 1, 2), " ")
    begins = terms.groupBy(pair.alias("token")).agg(F.sort_array(F.collect_set("_n")).alias("_lengths"))
    pairs = F.transform(F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 1, F.lit(0))),
                        lambda w, i: F.concat(w, F.lit(" "), F.get("_words", i + 1)))
    starts = lookups.by_dictionary(words, key, pairs, begins, broadcast).filter(F.col("_lengths").isNotNull())
    tried = starts.groupBy(key).agg(F.collect_list(F.struct("places", "_lengths")).alias("_starts"))
    rows = words.join(tried, key)
    rows = (rows.select(key, "_words", F.inline("_starts")).withColumn("_place", F.explode("places"))
            .withColumn("_n", F.explode("_lengths")).filter(F.col("_place") + F.col("_n") <= F.size("_words")))
    grams = rows.select(key, "_n", "_place", F.array_join(F.slice("_words", F.col("_place") + 1, F.col("_n")), " ").alias("gram"))
    found = joins.lookup_join(grams, terms.select("gram"), "gram", F.struct(key, "_place"), how="inner", small=broadcast)
    spans = found.groupBy(key).agg(F.array_sort(F.collect_list(
        F.struct(F.col("_place").alias("at"), (-F.col("_n")).alias("minus_n")))).alias("_spans"))
    return words.join(spans, key, "left").select(key, _fold_spans("_words", "_spans").alias("tokens"))


def _fold_spans(words: str, spans: str) -> Column:
    """Join the words of the chosen spans; ``spans`` is sorted by place, longest first."""
    none = F.array().cast("array<struct<free:int,at:int,n:int>>")
    start = F.struct(F.lit(0).alias("free"), none.alias("chosen"))

    def choose(state, span):
        taken = F.struct((span["at"] - span["minus_n"]).alias("free"), F.concat(state["chosen"], F.array(F.struct(
            state["free"].alias("free"), span["at"].alias("at"), (-span["minus_n"]).alias("n")))).alias("chosen"))
        return F.when(span["at"] >= state["free"], taken).otherwise(state)

    end = F.aggregate(F.coalesce(F.col(spans), F.array().cast("array<struct<at:int,minus_n:int>>")), start, choose)
    pieces = F.transform(end["chosen"], lambda c: F.concat(
        F.slice(words, c["free"] + 1, c["at"] - c["free"]),
        F.array(F.array_join(F.slice(words, c["at"] + 1, c["n"]), " "))))
    tail = F.slice(words, end["free"] + 1, F.greatest(F.size(words) - end["free"], F.lit(0)))
    return F.concat(F.flatten(pieces), tail)


def new_tokens(tokens: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct tokens that the vocabulary does not have."""
    return tokens.select("token").distinct().join(existing.select("token"), "token", "left_anti")


def numbered(tokens: DataFrame, start: int = 0) -> DataFrame:
    """token, id: consecutive ids in the order of the tokens. They are written first, as sorting by range reads them twice."""
    return ranks.dense_index(materialise(tokens, "tokens"), ["token"], "id", start)


def extend_vocabulary(vocabulary: DataFrame, tokens: DataFrame) -> DataFrame:
    """The vocabulary with its new tokens numbered after the highest id."""
    added = numbered(new_tokens(tokens, vocabulary))
    first = vocabulary.agg((F.max("id") + 1).alias("first")).scalar()
    return vocabulary.unionByName(added.withColumn("id", F.col("id") + first))


def extension_report(vocabulary: DataFrame, extended: DataFrame) -> DataFrame:
    """Size before and after, and the number of tokens added."""
    before = vocabulary.agg(F.count("*").alias("n")).scalar()
    return extended.agg(F.count("*").alias("size_after")).select(
        before.alias("size_before"), "size_after", (F.col("size_after") - before).alias("added"))


def with_special_tokens(vocabulary: DataFrame) -> tuple[DataFrame, str]:
    """The vocabulary with an end-of-turn token and a pad token, and the pad token's name.

    The end-of-sequence token pads if there is one.
    """
    has_eos = not vocabulary.filter(F.col("token") == fv.EOS_TOKEN).isEmpty()
    pad = fv.EOS_TOKEN if has_eos else fv.PAD_TOKEN
    wanted = vocabulary.sparkSession.createDataFrame([(pad, 0), (fv.END_OF_TURN, 1)], "token string, _rank int")
    missing = wanted.join(vocabulary.select("token"), "token", "left_anti")
    first = vocabulary.agg((F.max("id") + 1).alias("first")).scalar()
    before = missing.agg(F.min("_rank").alias("r")).scalar()
    added = missing.select("token", (first + F.col("_rank") - before).cast("long").alias("id"))
    return vocabulary.unionByName(added), pad


def id_of(vocabulary: DataFrame, token: str) -> int:
    """The id of one token."""
    return vocabulary.filter(F.col("token") == token).first()["id"]


def encode(df: DataFrame, key: str, tokens: Column, vocabulary: DataFrame, unknown_id: int, name: str,
           small: bool | None = None) -> DataFrame:
    """key, ids of the tokens in order; tokens outside the vocabulary get ``unknown_id``."""
    table, small, broadcast = lookups.measured(vocabulary.select("token", F.col("id").alias("_id")), small)
    if small:
        ids = lookups.in_place(table, lambda t: dict(zip(t.column("token").to_pylist(), t.column("_id").to_pylist())),
                               lambda known, row: [known.get(t, unknown_id) for t in row], "int")
        return df.select(key, ids(tokens).alias(name))
    found = lookups.by_dictionary(df, key, tokens, table, broadcast)
    return lookups.in_order(found, key, F.coalesce("_id", F.lit(unknown_id)).cast("int"), name)


def tokenisation_statistics(df: DataFrame, columns, tokens=tk.words) -> DataFrame:
    """Per text column: number of texts and the distribution of their token counts."""
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.size(tokens(F.col(c))).cast("long").alias("n"),
                                           F.col(c).isNull().alias("absent")) for c in columns]))
    long = df.select(stacked.alias("s")).filter("not s.absent").select("s.column", "s.n")
    return describe(long, "n", "column", population=True)


def top_tokens_per_column(df: DataFrame, columns, top: int = 20, tokens=tk.words) -> DataFrame:
    """The most frequent tokens of each column. One ordered limit per column."""
    tops = [top_tokens(df, tokens(F.col(c)), top).select(F.lit(c).alias("column"), "token", "n") for c in columns]
    result = tops[0]
    for other in tops[1:]:
        result = result.unionByName(other)
    return result


def sample_tokenisations(df: DataFrame, key: str, column: str, n: int = 3, tokens=tk.words) -> DataFrame:
    """A few texts by chance (repeatable) with their tokens."""
    from notemill.operators.sampling import seeded_sample
    present = df.select(key, column).filter(F.col(column).isNotNull())
    return seeded_sample(present, key, n).withColumn("tokens", tokens(F.col(column)))
