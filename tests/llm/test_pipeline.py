"""The stages on small rows, and their order."""

import corpus_pipeline
from notemill.llm import registry
from pyspark.sql import functions as F

from tests.llm.test_operators import prose


def test_stages_take_effect(spark, tmp_path):
    item = prose(20, 40)
    rows = [(1, prose(1, 80), "xx"), (2, prose(1, 80), "xx"), (3, prose(2, 60) + " " + item, "xx"), (4, prose(3, 50) + " password=abcdefgh99", "xx"),
            (5, None, "xx"), (6, "", None), (7, "123 456", "xx"), (8, prose(4, 30), None), (9, prose(5, 3000), "xx")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or ""), "extra") for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, kept string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        left.append({r["doc_id"] for r in now.collect()})
    assert left == [{1, 2, 3, 4, 8, 9}, {1, 3, 4, 8, 9}, {1, 4, 8, 9}, {1, 4, 8, 9}]
    clean = {r["doc_id"]: r for r in now.collect()}
    assert clean[4]["text"].endswith(" [ASSIGN]") and clean[4]["n_chars"] == len(clean[4]["text"]) and clean[1]["text"] == prose(1, 80)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.filter("round_trip").count() == 4 and out.filter(F.size("ids") != F.col("n_tokens")).count() == 0


def test_stages_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_names():
    assert sorted(name.split("_")[0] for name in registry.all_queries()) == sorted(f"op{i}" for i in range(1, 14))
    assert set(registry.all_sql()) <= set(registry.all_queries())


def test_extra_columns_keep_their_values(spark, tmp_path):
    names = ["found", "cleaned", "may", "_may", "_found", "_text", "_spans", "_clean", "_hash", "key", "rep"]
    rows = [(1, prose(1, 80), "xx"), (2, prose(1, 80), "xx"), (3, prose(3, 50) + " password=abcdefgh99", "xx"), (4, None, None)]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or ""), *[f"{n}{i}" for n in names]) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names))
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
    left = now.orderBy("doc_id").collect()
    assert [r["doc_id"] for r in left] == [1, 3] and now.columns == docs.columns
    assert all(r[n] == f"{n}{r['doc_id']}" for r in left for n in names)
    assert left[1]["text"].endswith(" [ASSIGN]")


def test_copies_between_the_thresholds_go(spark):
    """Four changed words among 200: 176 of 216 shingles shared, 81 %."""
    base = prose(1, 200).split()
    near = ["changed" if i in (20, 70, 120, 170) else w for i, w in enumerate(base)]
    far = ["changed" if i in (20, 60, 90, 120, 170) else w for i, w in enumerate(base)]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, prose(2, 200))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()} == {1, 3}
    apart = spark.createDataFrame([rows[0], (2, " ".join(far))], "doc_id long, text string")
    assert corpus_pipeline.one_of_each_group(spark, apart, "").count() == 2
