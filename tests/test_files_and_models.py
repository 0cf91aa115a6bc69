import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from notemill.operators import evaluation as ev, markup, parsing, python_functions as pf
from notemill.plans import jobs
from notemill.sources import files, sinks

REACTION = ('<reaction metaid="m" id="{i}" name="n">\n  <notes><p xmlns="http://www.w3.org/1999/xhtml">Text {i} (Smith 2011) &amp; more <b>x</b> tail</p></notes>\n'
            '  <annotation><a/></annotation>\n  <listOfProducts s:x="1"/>\n</reaction>')


@pytest.fixture
def folder(tmp_path):
    """Good, prefixed, empty, broken and cut files."""
    def write(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")
    body = REACTION.format(i="R-1") + REACTION.format(i="R-2")
    write("good.sbml", f'<sbml xmlns="urn:s" xmlns:s="urn:t"><model>{body}</model></sbml>')
    prefixed = REACTION.format(i="R-3").replace("<reaction", "<q:reaction").replace("</reaction", "</q:reaction").replace("notes>", "q:notes>")
    write("prefixed.sbml", f'<q:sbml xmlns:q="urn:s" xmlns:s="urn:t"><q:model>{prefixed}<reaction/></q:model></q:sbml>')
    write("none.sbml", '<sbml xmlns="urn:s"><model/></sbml>')
    write("broken.sbml", f"<sbml>{body}<b></sbml>")
    write("cut.sbml", f"<sbml>{body}")
    write("other.txt", "not markup")
    return str(tmp_path)


def test_corpus_job(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    jobs.build_corpus(spark, folder, out)
    counts = {r["file_id"]: r["reaction_count"] for r in spark.read.parquet(out + "/file_counts").collect()}
    assert counts == {"good.sbml": 2, "prefixed.sbml": 1, "none.sbml": 0, "broken.sbml": 0, "cut.sbml": 0}
    broken = {r["file_id"]: (r["message"], r["line"]) for r in spark.read.parquet(out + "/broken_files").collect()}
    assert broken == {"broken.sbml": ("unbound prefix", 4), "cut.sbml": ("unbound prefix", 4)}
    rows = {r["reaction_id"]: r for r in spark.read.parquet(out + "/reactions").collect()}
    assert set(rows) == {"R-1", "R-2", "R-3"}
    assert rows["R-1"]["original_notes"] == "Text R-1 (Smith 2011) & more" and rows["R-1"]["notes"] == "Text R-1 & more"
    assert rows["R-1"]["only_references"] == "(Smith 2011)"
    assert rows["R-3"]["snippet"] == '<reaction id="R-3" name="n">\n<listOfProducts x="1"/>\n</reaction>'
    jobs.summarise_files(spark, out)
    summary = {r["file_id"]: (r["reaction_count"], r["total_references"]) for r in spark.read.parquet(out + "/file_summary").collect()}
    assert summary == {"good.sbml": (2, 2), "prefixed.sbml": (1, 1)}
    data, categories = jobs.build_splits(spark, out)
    assert spark.read.json(data).count() == spark.read.json(categories).count() == 3


def elements_of(spark, *documents, **options):
    df = spark.createDataFrame(list(enumerate(documents)), "i int, v string").orderBy("i")
    return [r[0] for r in df.select(parsing.parsed(F.col("v"), "reaction", **options)).collect()]


def test_nested_notes_and_elements(spark):
    page = "<p xmlns='http://www.w3.org/1999/xhtml'>%s</p>"
    found = elements_of(
        spark,
        f"<s xmlns='u'><reaction id='1'><notes><div>a<div>b</div>{page % 'inner'}</div>{page % 'own'}</notes></reaction></s>",
        f"<s xmlns='u'><t:reaction xmlns:t='u' t:id='no' id='2'><t:notes>lead{page % ''}</t:notes></t:reaction><reaction xmlns='v' id='3'/></s>",
        f"<s><reaction id='4'><list><reaction id='5'><notes>{page % 'x<b>y</b>z'}</notes></reaction></list></reaction></s>",
        "<s><reaction id='6'><list><x><notes>of x</notes></x></list><notes><p>other address</p></notes><notes>second</notes></reaction></s>",
        "<reaction><reaction id='7'/></reaction>", None)
    notes = [[(e["id"], e["note"]) for e in r["elements"]] for r in found[:-1]]
    assert notes == [[("1", "own")], [("2", "lead")], [("4", None), ("5", "x")], [("6", None)], [("7", None)]]
    assert found[-1] is None and [e["depth"] for e in found[2]["elements"]] == [1, 3]
    assert [e["element"] for e in found[2]["elements"]] == ["<reaction id='4'><list><reaction id='5'></reaction></list></reaction>", "<reaction id='5'></reaction>"]
    whole = elements_of(spark, f"<s><reaction><notes>{page % 'x<b>y<i>!</i></b>z'}</notes></reaction></s>",
                        "<s><reaction><notes><p>any<b>y</b></p></notes></reaction></s>", full_text=True, paragraph=None)
    assert [r["elements"][0]["note"] for r in whole] == ["xy!z", "anyy"]


def test_elements_are_written_plainly(spark):
    found = elements_of(
        spark, "<s xmlns='u' xmlns:z='q'><reaction id='é' z:k=\" a:b='x' > \" z:metaid='9'><!-- <notes> --><z:a xmlns:y='w' y:l='1'/><?go on?>"
        "<![CDATA[<notes>&]]> a:b='c'<annotation><annotation>x</annotation>y</annotation>é</reaction></s>")
    assert found[0]["elements"][0]["element"] == "<reaction id='é' k=\" a:b='x' > \"><a l='1'/>&lt;notes&gt;&amp; a:b='c'é</reaction>"


def test_where_a_document_breaks(spark):
    found = elements_of(spark, "<s><reaction></s>", "", "<s>\n\né<reaction>", "<s>&no;</s>", "<a:s/>", "<s/>x")
    assert [(r["message"], r["line"], r["column"]) for r in found] == [
        ("mismatched tag", 1, 15), ("no element found", 1, 0), ("no element found", 3, 11), ("undefined entity", 1, 3), ("unbound prefix", 1, 0),
        ("junk after document element", 1, 4)]
    assert all(r["elements"] == [] for r in found)


def test_many_elements_cost_no_more_each(spark):
    """Twice the elements, about twice the work: nothing is looked at again for every element."""
    document = "<s>" + "<reaction id='x'><notes>n</notes><l a='1'><m/></l></reaction>" * 30_000 + "</s>"
    began = time.time()
    found = elements_of(spark, document)[0]["elements"]
    assert len(found) == 30_000 and found[-1]["element"] == "<reaction id='x'><l a='1'><m/></l></reaction>" and time.time() - began < 30


def test_xml_source_and_counts(spark, folder):
    records = files.markup_records(spark, folder, "reaction", "_id string")
    good = records.filter(F.col(files.BROKEN).isNull() & F.col("_id").isNotNull())
    assert {r["_id"] for r in good.collect()} >= {"R-1", "R-2", "R-3"}
    assert {r["file_id"]: r["reaction_count"] for r in files.record_counts(spark, folder, good).collect()}["none.sbml"] == 0
    assert files.list_files(spark, folder).count() == 6


def test_elements_of_the_root(spark):
    values = ["<m><!-- <r id='1'/> --><r id='a&amp;b'/><x:r/></m>", "<?xml version='1.0'?><q:m><q:r id='2'>t</q:r><r/></q:m>", None]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").orderBy("i")
    got = df.select(F.transform(markup.root_elements(F.col("v"), "r"), lambda e: markup.attribute(e, "id"))).collect()
    assert [r[0] for r in got] == [["a&b"], ["2"], None]


def test_nested_elements_of_broken_markup(spark):
    values = ["<d>a<d k='1' />b<d>c</d></d><d>", "</d><x:d>1</x:d><!-- <d> --><dd></dd><d\n>2</d>", "no tags", "", None, "<d/><d></d>"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").orderBy("i")
    got = [None if r[0] is None else [tuple(e) for e in r[0]] for r in df.select(markup.nested_elements(F.col("v"), "d")).collect()]
    assert got == [[(1, "<d>a<d k='1' />b<d>c</d></d>"), (2, "<d k='1' />"), (2, "<d>c</d>")], [(1, "<x:d>1</x:d>"), (1, "<d\n>2</d>")], [], [], None,
                   [(1, "<d/>"), (1, "<d></d>")]]


def test_cdata_is_text(spark):
    values = ["<m><r><notes><p><![CDATA[a < b & <!-- c --> <r/>]]> tail</p></notes></r></m>", "<m><r><notes><p>x<![CDATA[]]>y</p></notes></r><r/></m>",
              "<m><r><notes><p>cut <![CDATA[ here</p></notes></r></m>", None]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").orderBy("i")
    got = df.select(F.transform(markup.root_elements(F.col("v"), "r"), lambda e: markup.note_text(e))).collect()
    assert [r[0] for r in got[:2]] == [["a < b & <!-- c --> <r/> tail"], ["xy", None]] and got[3][0] is None


def test_paragraphs_are_whole(spark):
    df = spark.createDataFrame([("<p>a <b>b</b> c</p>x<p>d<p class='k'>\n<i>e</i>\n</p><pre>f</pre><p></p>",), (None,)], "v string")
    assert [r[0] for r in df.select(markup.element_texts(F.col("v"), "p")).collect()] == [["a b c", "d", "e"], None]


def test_note_text_rules(spark):
    values = ["<r><notes>own text<p></p></notes></r>", "<r><notes><p>lead<b>x</b> tail</p></notes></r>", "<r/>",
              "<r><h:notes><h:p a='1'> q </h:p></h:notes></r>", "<r><notes><b/></notes></r>",
              "<r><listOfReactants><s><notes><p>inner</p></notes></s></listOfReactants></r>",
              "<r><notes>own<body><p>deep</p></body></notes></r>", "<r><notes><p>caf&#233; &#x3b1; &amp;lt; &no; &#0; a&b</p></notes></r>"]
    df = spark.createDataFrame(list(enumerate(values)), "i int, e string").orderBy("i")
    assert [r[0] for r in df.select(markup.note_text(F.col("e"))).collect()] == [
        "own text", "lead", None, "q", None, None, "own", "café α &lt; &no; &#0; a&b"]
    assert df.select(markup.note_text(F.col("e"), full_text=True)).collect()[1][0] == "leadx tail"
    attribute = df.select(markup.attribute(F.lit("<a  x='1' y=\"2\">"), "y"), markup.attribute(F.lit("<a><b y='1'/></a>"), "y"))
    assert tuple(attribute.first()) == ("2", None)


def test_json_array_or_lines(spark, tmp_path):
    rows = [{"instruction": f"i{n}", "output": "o\n"} for n in range(5)]
    (tmp_path / "a.json").write_text("\n " + json.dumps(rows, indent=2))
    (tmp_path / "l.json").write_text("\n\n" + "\n\n".join(json.dumps(r) for r in rows) + "\n")
    for name in ("a.json", "l.json"):
        got = files.read_json(spark, str(tmp_path / name), "instruction string, output string")
        assert sorted(r["instruction"] for r in got.collect()) == [r["instruction"] for r in rows]


def test_tsv_terms_and_arrays(spark, tmp_path):
    (tmp_path / "p.tsv").write_text('R-1\t"Quoted\tHomo sapiens\nR-2\tB\tMus\n')
    got = files.read_tsv(spark, str(tmp_path / "p.tsv"), "id string, name string, species string")
    assert [tuple(r) for r in got.filter("species = 'Homo sapiens'").collect()] == [("R-1", '"Quoted', "Homo sapiens")]
    (tmp_path / "t.txt").write_text(" b \n\n\t\na\n")
    terms = files.read_terms(spark, str(tmp_path / "t.txt"))
    assert sorted(r[0] for r in terms.collect()) == ["a", "b"]
    sinks.write_terms(terms, str(tmp_path / "sorted"), "term")
    assert [r[0] for r in spark.read.text(str(tmp_path / "sorted")).collect()] == ["a", "b"]
    sinks.write_json_array(terms, str(tmp_path / "arr"), ["term"], 1)
    assert files.read_json(spark, str(tmp_path / "arr"), "term string").collect()[0][0] == "a"


def test_reuse_notices_what_changed(spark, tmp_path):
    source, path, built = str(tmp_path / "in"), str(tmp_path / "out"), []
    spark.range(3).write.parquet(source)

    def build():
        built.append(1)
        return spark.read.parquet(source).withColumn("v", F.col("id") * 2)

    def load(**options):
        return sorted(r["v"] for r in sinks.load_or_build(spark, path, build, inputs=[source], **options).collect())

    assert load() == load() == [0, 2, 4] and len(built) == 1
    spark.range(3, 4).write.mode("append").parquet(source)                      # a changed input
    assert load() == load() == [0, 2, 4, 6] and len(built) == 2
    other = StructType([StructField("v", StringType())])                        # another type
    assert load(schema=other) == [0, 2, 4, 6] and len(built) == 3
    assert load(schema=StructType([StructField("v", LongType())])) == [0, 2, 4, 6] and len(built) == 3
    (tmp_path / "out" / "manifest").rename(tmp_path / "kept")                   # a write that was killed before its end
    assert sinks.published(spark, path) is None and load() == [0, 2, 4, 6] and len(built) == 4

    failing = spark.range(2).withColumn("v", F.raise_error(F.lit("killed")).cast("long"))
    with pytest.raises(Exception, match="killed"):
        sinks.publish(failing, path)
    assert load() == [0, 2, 4, 6] and len(built) == 4


def test_load_or_build(spark, tmp_path):
    path, built = str(tmp_path / "t"), []

    def build():
        built.append(1)
        return spark.range(3)
    assert sinks.load_or_build(spark, path, lambda: None) is None
    assert sinks.load_or_build(spark, path, build).count() == 3 and sinks.load_or_build(spark, path, build).count() == 3
    assert len(built) == 1 and sinks.load_or_build(spark, path, build, again=True).count() == 3 and len(built) == 2
    other = spark.createDataFrame([], "x string").schema
    sinks.load_or_build(spark, path, build, other)
    assert len(built) == 3


def test_failed_ids(spark, tmp_path):
    df = spark.createDataFrame([("a", "error"), ("b", "success")], "id string, status string")
    assert sinks.write_failed(df, str(tmp_path / "f"), "id") and spark.read.text(str(tmp_path / "f")).first()[0] == "a"
    assert not sinks.write_failed(df.filter("id = 'b'"), str(tmp_path / "g"), "id") and not (tmp_path / "g").exists()


def model():
    def sample(prompts):
        if any("fail" in p for p in prompts):
            raise RuntimeError("sampling")
        return [p + " sampled" for p in prompts]

    def greedy(prompt):
        if "hard" in prompt:
            raise ValueError("too hard")
        return prompt + " greedy"
    return sample, greedy


def test_model_errors_stay_in_their_row(spark):
    df = spark.createDataFrame([(0, "a", "x y"), (1, "fail", "z"), (2, "fail hard", "z")],
                               "k long, instruction string, output string").repartition(1)
    numbered = ev.numbered_examples(df, ["k"]).withColumn("p", pf.predictions(F.col("instruction"), model, batch_size=1))
    rows = {r["example_id"]: r for r in ev.evaluation_table(numbered, F.col("p.text"), F.col("p.error")).collect()}
    assert rows[1]["generated_output"] == "a sampled" and rows[2]["generated_output"] == "fail greedy"
    assert (rows[3]["generated_output"], rows[3]["generated_length"], rows[3]["status"]) == ("ERROR: too hard", 0, "error")
    assert tuple(ev.status_summary(ev.evaluation_table(numbered, F.col("p.text"), F.col("p.error"))).first()) == (2, 3)


def test_value_and_batch_functions(spark):
    df = spark.range(25).select("id")
    assert df.select(F.sum(pf.per_value(lambda v: v * 2, "long")("id"))).first()[0] == 600
    sizes = pf.per_batch(df.repartition(1), lambda f: f.assign(n=len(f))[["n"]], "n long", rows=10)
    assert sorted(r["n"] for r in sizes.collect()) == [5] * 5 + [10] * 20
