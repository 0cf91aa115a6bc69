"""Personal data, and the words that would give it away: information-theoretic sanitisation.

Patterns find the protected values. A word in a document with a value is dangerous when seeing it leaves less than
``LEFT_BITS`` bits of doubt about the value: pointwise mutual information of word and value within that distance of the
value's own information, that is P(value | word) >= 2 ** -LEFT_BITS over the documents of the corpus, whole texts on both sides. Words that
stood with the value in one wording only prove nothing and are left. Documents whose distinct words differ are wordings of their own;
within a document so are places of the value whose words within ``REACH`` characters differ. Letters of values are no words of the
document. Dangerous words are marked wherever they stand in documents with that value.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.llm.native import match_spans
from notemill.operators.once import evaluate_once
from notemill.session import materialise

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
LEFT_BITS = 1
REACH = 60
LEAST_WORDINGS = 2
LETTERS = r"\p{L}{4,}"

#: The base patterns. The look-behinds only spare starts within a run that has failed before.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

_SPANS = "array<struct<kind string, start int, end int, value string>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the check digit fits: every second digit from the right is doubled, less 9 above 9."""
    figures = F.transform(F.split(F.reverse(digits(value)), ""), lambda d: d.cast("int"))
    worth = F.transform(figures, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(F.filter(worth, lambda w: w.isNotNull()), F.lit(0), lambda a, b: a + b) % 10 == 0


def base_spans(text: Column) -> Column:
    """Spans (kind, start, end, value) of the base kinds, by start and then in the order of the kinds."""
    none = F.array().cast(_SPANS)
    ip = match_spans(text, IP, "ip", lambda v: F.forall(F.split(v, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike(
        "^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")))
    email = match_spans(text, EMAIL, "email", lambda v: F.lit(True))
    card = match_spans(text, CARD, "card", lambda v: F.length(digits(v)).between(14, 19) & luhn(v))
    phone = match_spans(text, PHONE, "phone", lambda v: F.length(digits(v)).between(10, 15))
    found = F.concat(F.when(F.contains(text, F.lit("@")), email).otherwise(none),
                     F.when(text.rlike(r"[0-9]\.[0-9]"), ip).otherwise(none),
                     F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), card).otherwise(none),
                     F.when(F.contains(text, F.lit("+")), phone).otherwise(none))
    return ordered(found)


def ordered(spans: Column) -> Column:
    """By start, then in the order of the kinds (terms last)."""
    place = F.create_map(*[F.lit(v) for i, kind in enumerate((*KINDS, TERM)) for v in (kind, i)])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), place[s["kind"]].alias("place"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value"))))
    return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))


def _beside(text: Column, start: Column, end: Column) -> Column:
    """Lower-case words within reach of a span; words that the reach cuts are left out."""
    left = F.regexp_extract_all(F.lower(F.substring(text, F.greatest(start - REACH, F.lit(0)) + 1, F.least(start, F.lit(REACH)))), F.lit(LETTERS), F.lit(0))
    right = F.regexp_extract_all(F.lower(F.substring(text, end + 1, F.lit(REACH))), F.lit(LETTERS), F.lit(0))
    whole_left = F.when((start > REACH) & (F.size(left) > 0), F.slice(left, F.lit(2), F.size(left))).otherwise(left)
    whole_right = F.when((F.length(text) > end + REACH) & (F.size(right) > 0), F.slice(right, F.lit(1), F.size(right) - 1)).otherwise(right)
    return F.array_sort(F.array_distinct(F.concat(whole_left, whole_right)))


def _words_outside(text: Column, spans: Column) -> Column:
    """The distinct lower-case words of a text without its values."""
    def step(done, span):
        gap = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"),
                        F.when(span["start"] > done["at"], F.concat(done["gaps"], F.array(gap))).otherwise(done["gaps"]).alias("gaps"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("gaps"))
    rest = F.aggregate(spans, start, step, lambda done: F.concat(done["gaps"], F.array(F.substring(text, done["at"] + 1, F.length(text)))))
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(F.array_join(rest, " ")), F.lit(LETTERS), F.lit(0))))


def dangerous_words(docs: DataFrame, holders: DataFrame) -> DataFrame:
    """(entity, word): the words that give a value away. ``holders`` are the rows of ``docs`` with spans.

    Documents of one content and their values are one row with a count. Only values in two wordings can have a dangerous word.
    """
    spans = holders.select("doc_id", "text", F.explode("spans").alias("span"))
    beside = spans.select("doc_id", F.concat_ws(":", "span.kind", F.lower("span.value")).alias("entity"),
                          _beside(F.col("text"), F.col("span.start"), F.col("span.end")).alias("words"))
    once = beside.groupBy("entity", "words", "doc_id").count().select(
        "entity", "doc_id", F.xxhash64("words").alias("wording"), F.explode("words").alias("word"))
    wordings = once.groupBy("entity", "word", "wording").agg(F.count("*").alias("_n"))
    several = wordings.groupBy("entity", "word").agg(F.count("*").alias("wordings")).filter(F.col("wordings") >= LEAST_WORDINGS)
    near = materialise(once.select("entity", "word", "doc_id").distinct().groupBy("entity", "word").agg(F.count("*").alias("near"))
                       .join(several, ["entity", "word"]).drop("wordings"), "near")

    values = F.array_sort(F.array_distinct(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"])))))
    contents = holders.select(values.alias("entities"), _words_outside(F.col("text"), F.col("spans")).alias("words"))
    keyed = contents.withColumn("wording", F.xxhash64("words")).withColumn("values", F.xxhash64("entities"))
    whole = materialise(keyed.groupBy("wording", "values").agg(F.count("*").alias("n"), F.first("entities").alias("entities"),
                                                               F.first("words").alias("words")), "contents")
    held = whole.select("wording", "values", F.explode("entities").alias("entity"))
    apart = held.groupBy("entity").agg(F.min("wording").alias("_least"), F.max("wording").alias("_most")).filter("_least < _most").select("entity")
    wanted = apart.union(near.select("entity")).distinct()
    kept = held.join(wanted, "entity").groupBy("wording", "values").agg(F.collect_list("entity").alias("entities"))
    pairs = (whole.drop("entities").join(kept, ["wording", "values"]).select("wording", "n", "entities", F.explode("words").alias("word"))
             .select("wording", "n", "word", F.explode("entities").alias("entity")))
    far = pairs.groupBy("entity", "word").agg(F.sum("n").alias("far"), (F.min("wording") < F.max("wording")).alias("_apart"))
    together = far.join(near, ["entity", "word"], "full").filter(F.col("_apart") | F.col("near").isNotNull()).select(
        "entity", "word", F.greatest("far", "near").alias("together"))
    everywhere = (docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), F.lit(0)))).alias("word"))
                  .groupBy("word").agg(F.count("*").alias("documents")))
    return (together.join(everywhere, "word").filter(F.col("together") * 2 ** LEFT_BITS >= F.col("documents"))
            .select("entity", "word"))


def with_terms(rows: DataFrame) -> DataFrame:
    """``rows`` with the spans of ``_pattern`` in ``text`` as ``_terms``. A document may have hundreds: each step is a column
    of its own, as what a lambda names is evaluated for every element."""
    matched = evaluate_once(rows, {"_matches": F.regexp_extract_all("text", F.col("_pattern"), F.lit(0)),
                                   "_pieces": F.split("text", F.col("_pattern"), -1)})
    stepped = evaluate_once(matched, {"_steps": F.filter(F.zip_with("_matches", "_pieces", lambda m, p: F.struct(
        m.alias("value"), F.length(p).alias("gap"), F.length(m).alias("size"))), lambda s: s["value"].isNotNull())})

    def add(done, step):
        span = F.struct(F.lit(TERM).alias("kind"), (done["at"] + step["gap"]).alias("start"),
                        (done["at"] + step["gap"] + step["size"]).alias("end"), step["value"].alias("value"))
        return F.struct((done["at"] + step["gap"] + step["size"]).alias("at"), F.concat(done["spans"], F.array(span).cast(_SPANS)).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
    terms = F.aggregate("_steps", start, add, lambda done: done["spans"])
    return evaluate_once(stepped, {"_terms": F.coalesce(terms, F.array().cast(_SPANS))})


def find(docs: DataFrame) -> DataFrame:
    """The rows (doc_id, text) with ``spans``: base values and the words that give them away.

    Null texts count as empty and hold nothing. Rows with the same doc_id share their dangerous words, as they
    count as one document.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = texts.withColumn("spans", base_spans(F.col("text")))
    holders = materialise(marked.filter(F.size("spans") > 0), "holders")
    words = materialise(dangerous_words(texts, holders), "dangerous")
    entities = holders.select("doc_id", F.explode("spans").alias("span")).select(
        "doc_id", F.concat_ws(":", "span.kind", F.lower("span.value")).alias("entity")).distinct()
    per_doc = entities.join(words, "entity").groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set("word").alias("_words"))
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.array_sort("_words"), "|"), F.lit(r")(?!\p{L})"))
    joined = holders.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    both = with_terms(joined.withColumn("_pattern", pattern)).select("doc_id", "text", ordered(F.concat("spans", "_terms")).alias("spans"))
    return marked.filter(F.size("spans") == 0).unionByName(both)


def sanitised(text: Column, spans: Column) -> Column:
    """Values become their kind in brackets, dangerous words go; of spans that overlap the first is named."""
    def step(done, span):
        gap = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        name = F.when(span["kind"] == TERM, F.lit("")).otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        return F.struct(F.when(span["start"] >= done["at"], F.concat(done["out"], gap, name)).otherwise(done["out"]).alias("out"),
                        F.greatest(done["at"], span["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    return F.aggregate(spans, start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
