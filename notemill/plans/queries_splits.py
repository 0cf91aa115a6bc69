"""Length categories, stratified splits and markup pairs over the pages."""

from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import text as tx
from notemill.operators import markup, splits
from notemill.plans import sql
from notemill.plans.registering import joined, register
from notemill.plans.standins import page_pairs
from notemill.session import spread
from notemill.sources.tables import table

QUERIES, SQL, query = register()

PAIRS = f"""pairs AS (SELECT page_id, html AS snippet, array_to_string(list_filter(list_transform(
  string_split_regex(html, '<p(?:\\s[^>]*)?>')[2:],
  lambda t: {sql.strip("regexp_replace(regexp_replace(t, '(?s)</p" + chr(92) + "s*>.*', ''), '<[^>]*>', '', 'g')")}), lambda t: t <> ''), chr(10)) AS notes FROM pages)"""
CATEGORIES = f"""{PAIRS},
counted AS (SELECT *, {sql.word_count('snippet')} AS sw, {sql.word_count('notes')} AS nw FROM pairs),
cuts AS (SELECT quantile_cont(sw, [0.25, 0.5, 0.75]) AS s, quantile_cont(nw, [0.25, 0.5, 0.75]) AS n FROM counted),
labelled AS (SELECT page_id, snippet, notes,
  CASE WHEN sw <= s[1] THEN 'short' WHEN sw <= s[2] THEN 'medium' WHEN sw <= s[3] THEN 'long' ELSE 'very_long' END AS snippet_category,
  CASE WHEN nw <= n[1] THEN 'short' WHEN nw <= n[2] THEN 'medium' WHEN nw <= n[3] THEN 'long' ELSE 'very_long' END AS notes_category
  FROM counted, cuts),
categorised AS MATERIALIZED (SELECT *, snippet_category || '_' || notes_category AS combined_category FROM labelled)"""


def split_sql(source: str, stratum: str, key: str) -> str:
    """Two nested largest-remainder steps, then the rank by hash within the stratum."""
    return f"""strata AS (SELECT {stratum} AS st, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS rows FROM {source} GROUP BY 1),
sized AS (SELECT *, ceil((0.15 + 0.05)::DOUBLE * rows)::BIGINT AS held FROM strata),
sized2 AS (SELECT *, held - round_even(0.15::DOUBLE * rows, 0)::BIGINT AS tests, (held * n) // rows AS w1, (held * n) % rows AS r1 FROM sized),
held1 AS (SELECT *, w1 + CASE WHEN row_number() OVER (ORDER BY r1 DESC, st) <= held - sum(w1) OVER () THEN 1 ELSE 0 END AS h FROM sized2),
tests0 AS (SELECT *, (tests * h) // held AS w2, (tests * h) % held AS r2 FROM held1),
sizes AS (SELECT st, n - h AS train, h - (w2 + CASE WHEN row_number() OVER (ORDER BY r2 DESC, st) <= tests - sum(w2) OVER () THEN 1 ELSE 0 END) AS val FROM tests0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY md5('42:' || {key}) || ':' || {key}) AS rank FROM {source}),
parted AS (SELECT ranked.*, CASE WHEN rank <= train THEN 'train' WHEN rank <= train + val THEN 'val' ELSE 'test' END AS split
  FROM ranked JOIN sizes ON st = {stratum})"""


@query(f"""WITH {PAIRS}, counted AS (SELECT {sql.word_count('snippet')} AS sw, {sql.word_count('notes')} AS nw FROM pairs)
SELECT quantile_cont(sw, 0.25) AS snippet_q1, quantile_cont(sw, 0.5) AS snippet_q2, quantile_cont(sw, 0.75) AS snippet_q3,
  quantile_cont(nw, 0.25) AS notes_q1, quantile_cont(nw, 0.5) AS notes_q2, quantile_cont(nw, 0.75) AS notes_q3 FROM counted""")
def length_cut_points(spark, folder):
    cuts = splits.length_cuts(page_pairs(spark, folder))
    return cuts.select(*[F.col(c)[i].alias(f"{c}_q{i + 1}") for c in ("snippet", "notes") for i in range(3)])


@query(f"WITH {CATEGORIES} SELECT page_id, snippet_category, notes_category, combined_category FROM categorised")
def length_categories(spark, folder):
    return splits.categorise(page_pairs(spark, folder)).drop("snippet", "notes")


@query(f"""WITH {CATEGORIES} SELECT snippet_category, count(*) FILTER (notes_category = 'short') AS short,
  count(*) FILTER (notes_category = 'medium') AS medium, count(*) FILTER (notes_category = 'long') AS long,
  count(*) FILTER (notes_category = 'very_long') AS very_long FROM categorised GROUP BY 1""")
def category_cross_table(spark, folder):
    return splits.cross_table(splits.categorise(page_pairs(spark, folder)), "snippet_category", "notes_category")


@query(f"""WITH {CATEGORIES}, c AS (SELECT combined_category AS k, count(*) AS n FROM categorised GROUP BY 1),
a AS (SELECT * FROM c ORDER BY n DESC, k LIMIT 1), b AS (SELECT * FROM c ORDER BY n, k LIMIT 1)
SELECT a.k AS most_common, a.n AS most_count, b.k AS least_common, b.n AS least_count, round(a.n / b.n, 6) AS ratio FROM a, b""")
def category_balance(spark, folder):
    out = splits.balance(splits.categorise(page_pairs(spark, folder)), "combined_category")
    return out.withColumn("ratio", F.round("ratio", 6))


@query(f"WITH {CATEGORIES} SELECT combined_category, count(*) AS n FROM categorised GROUP BY 1 ORDER BY 1")
def category_counts(spark, folder):
    return (splits.categorise(page_pairs(spark, folder)).groupBy("combined_category")
            .agg(F.count("*").alias("n")).orderBy("combined_category"))


def _split_pages(spark, folder):
    return splits.stratified_split(splits.categorise(page_pairs(spark, folder)), "combined_category", "page_id")


@query(f"WITH {CATEGORIES}, {split_sql('categorised', 'combined_category', 'page_id')} SELECT page_id, combined_category, split FROM parted")
def pages_split(spark, folder):
    return _split_pages(spark, folder).select("page_id", "combined_category", "split")


_DOCS = "strat AS (SELECT doc_id, lang || '/' || source AS stratum FROM documents)"


@query(f"WITH {_DOCS}, {split_sql('strat', 'stratum', 'doc_id')} SELECT doc_id, stratum, split FROM parted")
def documents_split(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", F.concat_ws("/", "lang", "source").alias("stratum"))
    return splits.stratified_split(docs, "stratum", "doc_id")


@query(f"""WITH {_DOCS}, {split_sql('strat', 'stratum', 'doc_id')} SELECT stratum, count(*) FILTER (split = 'train') AS train,
  count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test FROM parted GROUP BY stratum""")
def split_verification(spark, folder):
    return splits.split_counts(documents_split(spark, folder), "stratum")


_INSTRUCTION = "'Translate the following SBML code to English:' || chr(10) || chr(10) || snippet"


@query(f"""WITH {CATEGORIES}, {split_sql('categorised', 'combined_category', 'page_id')}
SELECT page_id, split, {_INSTRUCTION} AS instruction, notes AS output FROM parted""")
def instruction_rows(spark, folder):
    return _split_pages(spark, folder).select(
        "page_id", "split", tx.instruction(F.col("snippet")).alias("instruction"), F.col("notes").alias("output"))


# --- markup in string columns ---------------------------------------------------------------------

def _pages(spark, folder):
    return spread(table(spark, folder, "pages"), "page_id")


@query("""SELECT page_id, unnest(range(len(e))) AS position, unnest(e) AS element
FROM (SELECT page_id, regexp_extract_all(html, '(?s)<(?:[\\w.-]+:)?a(?:\\s[^>]*?)?(?:/>|>.*?</(?:[\\w.-]+:)?a>)', 0) AS e FROM pages)""")
def link_elements(spark, folder):
    rows = markup.explode_elements(_pages(spark, folder).select("page_id", "html"), "html", "a")
    return rows.select("page_id", F.col("position").cast("long").alias("position"), "element")


@query(r"""WITH tags AS (SELECT page_id, unnest(range(len(t))) AS place, unnest(t) AS tag, p FROM (
  SELECT page_id, regexp_extract_all(h, '</?div(?:\s[^>]*)?/?>') AS t, regexp_split_to_array(h, '</?div(?:\s[^>]*)?/?>') AS p
  FROM (SELECT page_id, regexp_replace('<div>' || html || '<div/></div>', '(?s)<!--.*?-->', '', 'g') AS h FROM pages))),
depths AS (SELECT *, starts_with(tag, '</') AS ends, sum(CASE WHEN starts_with(tag, '</') THEN -1 WHEN ends_with(tag, '/>') THEN 0 ELSE 1 END)
  OVER (PARTITION BY page_id ORDER BY place) AS running FROM tags),
levels AS (SELECT *, CASE WHEN ends OR ends_with(tag, '/>') THEN running + 1 ELSE running END AS depth FROM depths),
closed AS (SELECT page_id, place, depth, CASE WHEN ends_with(tag, '/>') THEN place ELSE lead(place) OVER (PARTITION BY page_id, depth ORDER BY place) END AS last, ends, p FROM levels),
texts AS (SELECT c.page_id, c.place, c.depth, string_agg(t.tag || CASE WHEN t.place < c.last THEN t.p[t.place + 2] ELSE '' END, '' ORDER BY t.place) AS element
  FROM closed c JOIN tags t ON c.page_id = t.page_id AND t.place BETWEEN c.place AND c.last WHERE NOT ends GROUP BY 1, 2, 3)
SELECT page_id, depth::INTEGER AS depth, element FROM texts""")
def nested_elements(spark, folder):
    """Every ``div`` of the pages, each put into one more, whole: those within others too."""
    whole = F.concat(F.lit("<div>"), F.col("html"), F.lit("<div/></div>"))
    found = _pages(spark, folder).select("page_id", F.explode(markup.nested_elements(whole, "div")).alias("e"))
    return found.select("page_id", "e.depth", "e.element")


@query("SELECT page_id, len(regexp_extract_all(html, '(?s)<(?:[\\w.-]+:)?li(?:\\s[^>]*?)?(?:/>|>.*?</(?:[\\w.-]+:)?li>)', 0)) AS element_count FROM pages")
def element_counts(spark, folder):
    return markup.element_counts(_pages(spark, folder), "page_id", "html", "li")


@query("""SELECT page_id, unnest(range(len(e))) AS position, nullif(regexp_extract(unnest(e), 'href="([^"]*)"', 1), '') AS href
FROM (SELECT page_id, regexp_extract_all(html, '(?s)<(?:[\\w.-]+:)?a(?:\\s[^>]*?)?(?:/>|>.*?</(?:[\\w.-]+:)?a>)', 0) AS e FROM pages)""")
def link_targets(spark, folder):
    rows = markup.explode_elements(_pages(spark, folder).select("page_id", "html"), "html", "a")
    return rows.select("page_id", F.col("position").cast("long").alias("position"),
                       markup.attribute(F.col("element"), "href").alias("href"))


@query(rf"""SELECT page_id, CASE WHEN regexp_matches(html, '<h1[\s>]') THEN
  {sql.strip("regexp_extract(html, '<h1(?:\\s[^>]*)?>([^<]*)', 1)".replace(chr(92) * 2, chr(92)))} END AS heading FROM pages""")
def headings(spark, folder):
    return _pages(spark, folder).select("page_id", markup.first_text(F.col("html"), "h1").alias("heading"))


_DROP = ("script", "style", "nav")
_SUBTREES = " ".join(f"(?s)<{t}(?:\\s[^>]*?)?(?:/>|>.*?</{t}>)" for t in _DROP).split(" (?s)")
_STRIPPED = ("regexp_replace(html, '(?s)" + "|".join(s.replace("(?s)", "") for s in _SUBTREES) + "|<!--.*?-->', '', 'g')")
_VALUE = "(?:\"[^\"]*\"|''[^'']*'')"
_PLAIN = f"""regexp_replace(regexp_replace(regexp_replace({_STRIPPED},
  '\\s(?:xmlns(?::[\\w.-]+)?|(?:[\\w.-]+:)?lang)={_VALUE}', '', 'g'), '(</?)[\\w.-]+:', '\\1', 'g'), '(\\s)[\\w.-]+:([\\w.-]+={_VALUE})', '\\1\\2', 'g')"""


@query(f"""SELECT page_id, array_to_string(list_filter(list_transform(string_split({_PLAIN}, chr(10)), lambda l: {sql.strip('l')}),
  lambda l: l <> ''), chr(10)) AS snippet FROM pages""")
def page_snippets(spark, folder):
    plain = markup.strip_namespaces(markup.strip_elements(F.col("html"), _DROP), "lang")
    return _pages(spark, folder).select("page_id", tx.normalise_lines(plain).alias("snippet"))
