"""What jobs leave on disk: packed tables, no text twice without need, no shuffle files of writes that have ended."""

import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from notemill.operators import dedup, joins
from notemill.plans import jobs, queries_files
from notemill.session import drop_scratch, scratch_path, settings
from notemill.sources import files, sinks

FILE = '<sbml xmlns="urn:s"><reaction id="%s"><notes><p xmlns="http://www.w3.org/1999/xhtml">n</p></notes></reaction></sbml>'


def scratch(spark):
    return Path(scratch_path(spark, "x").removeprefix("file:")).parent


def size(folder):
    return sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())


def made_documents(spark, path, n=600):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(2000)]
    rows = [(i, " ".join(rng.choices(words, k=400)) + ".", "en", f"s{i % 3}") for i in range(n)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    return sum(len(r[1]) for r in rows)


def test_split_job_fits_its_disk(spark, tmp_path):
    raw, before = made_documents(spark, tmp_path), set(scratch(spark).glob("*"))
    rows = {r["split"]: (r["instructions"], r["categorised"]) for r in queries_files.split_job(spark, str(tmp_path)).collect()}
    assert rows == {"train": (480, 480), "val": (90, 90), "test": (30, 30)}
    left = set(scratch(spark).glob("*")) - before
    assert not [p for p in left if p.name.startswith(("markup-", "files-"))]
    assert sum(map(size, left)) < 4 * raw        # rows, kept rows, two JSON tables: 2.2 * raw, 7.6 before


def test_files_without_rows_are_told_apart(spark, tmp_path):
    """One whole file, an empty one, broken ones; names that addresses spell otherwise."""
    texts = {"a+b.sbml": FILE % 1, "a b.sbml": "<sbml>", "50%.sbml": FILE % 2, "é.sbml": "<sbml><reaction></sbml>", "none.sbml": "<sbml/>"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    out, before = str(tmp_path / "out"), set(scratch(spark).glob("files-*"))
    jobs.build_corpus(spark, str(tmp_path), out)
    table = lambda name: {r["file_id"]: r for r in spark.read.parquet(f"{out}/{name}").collect()}
    assert {k: r["reaction_count"] for k, r in table("file_counts").items()} == {
        "a+b.sbml": 1, "a b.sbml": 0, "50%.sbml": 1, "é.sbml": 0, "none.sbml": 0}
    assert {k: (r["message"], r["line"], r["column"]) for k, r in table("broken_files").items()} == {
        "a b.sbml": ("no element found", 1, 6), "é.sbml": ("mismatched tag", 1, 18)}
    assert set(table("reactions")) == {"a+b.sbml", "50%.sbml"}
    assert set(scratch(spark).glob("files-*")) == before
    types = lambda name: [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(f"{out}/{name}").schema]
    assert types("file_counts") == [("file_id", "string"), ("reaction_count", "bigint")]
    assert types("broken_files") == [("file_id", "string"), ("message", "string"), ("line", "int"), ("column", "int")]


def test_no_file_is_broken(spark, tmp_path):
    (tmp_path / "a.sbml").write_text(FILE % 1)
    jobs.build_corpus(spark, str(tmp_path), str(tmp_path / "out"))
    broken = spark.read.parquet(f"{tmp_path}/out/broken_files")
    assert broken.columns == ["file_id", "message", "line", "column"] and broken.count() == 0
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out/file_counts").collect()] == [("a.sbml", 1)]


@pytest.mark.parametrize("few", [True, False])
def test_first_rows_stay_where_they_are(spark, monkeypatch, few):
    """Nulls are equal, a null place is never first, a place that comes twice keeps both rows, a third are copies of one."""
    rows = [(f"{i:03d}", "hot" if i % 3 == 0 else None if i % 10 == 1 else f"v{i // 2}", i) for i in range(90)]
    rows += [(None, "alone", 90), (None, "hot", 91), ("000", "hot", 92), ("000", "other", 93)]
    first = {}
    for place, value, _ in rows:
        if place is not None:
            first[value] = min(place, first.get(value, place))
    df = spark.createDataFrame(rows, "place string, value string, id int").repartition(5)
    if not few:
        monkeypatch.setattr(joins, "small_enough", lambda *_: False)
    kept = dedup.keep_first(df, ["value"], "place")
    assert sorted(r["id"] for r in kept.collect()) == sorted(i for place, value, i in rows if place is not None and place == first[value])
    assert kept.columns == df.columns
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and ("SortMergeJoin" not in plan if few else "_maybe" in plan or "getbit" in plan)


def test_a_crowded_bitmap_keeps_the_same_rows(spark, monkeypatch):
    """With few bits nearly every row may be a copy; the join decides."""
    df = spark.range(3000).select("id", (F.col("id") % 700).cast("string").alias("value")).repartition(4)
    monkeypatch.setattr(joins, "small_enough", lambda *_: False)
    for bits in (1, 64, 1 << 16, 1 << 27):
        monkeypatch.setattr(dedup, "FILTER_BITS", bits)
        assert sorted(r["id"] for r in dedup.keep_first(df, ["value"], "id").collect()) == list(range(700))
    places = spark.range(0, 3000, 5).select(F.col("id").alias("_place"))
    found = dedup._may_be_in(df.withColumn("_place", F.col("id")), places, "maybe").filter("maybe")
    assert found.filter("id % 5 = 0").count() == 600 and found.count() < 620


def test_tables_are_packed_and_shuffles_go(spark, tmp_path):
    def shuffled():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before, name = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    df = spark.range(2000).select("id", F.repeat(F.lit("word "), 50).alias("snippet"), F.lit("n").alias("notes"),
                                  F.when(F.col("id") % 2 == 0, "train").otherwise("val").alias("split")).repartition(3, "id")
    sinks.write_table(df, f"{tmp_path}/t")
    sinks.publish(df, f"{tmp_path}/p")
    data, categories = sinks.write_splits(df, f"{tmp_path}/s")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(name, None) == was
    assert all(p.name.endswith(".zstd.parquet") for d in "tp" for p in (tmp_path / d).rglob("*.parquet"))
    assert all(p.name.endswith(".json.gz") for p in (tmp_path / "s").rglob("part-*"))
    read = files.read_json_lines(spark, data, "split string, instruction string, output string")
    assert read.groupBy("split").count().orderBy("split").collect() == [("train", 1000), ("val", 1000)]
    assert files.read_json_lines(spark, categories, "id long").agg(F.countDistinct("id")).first()[0] == 2000


def test_settings_are_set_back(spark):
    spark.conf.set("notemill.one", "a")
    with pytest.raises(KeyError), settings(spark, {"notemill.one": "b", "notemill.two": "c"}):
        assert (spark.conf.get("notemill.one"), spark.conf.get("notemill.two")) == ("b", "c")
        raise KeyError
    assert spark.conf.get("notemill.one") == "a" and spark.conf.get("notemill.two", None) is None


def test_only_scratch_is_dropped(spark, tmp_path):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    assert not Path(path.removeprefix("file:")).exists()
    spark.range(3).write.parquet(f"{tmp_path}/kept-{'0' * 32}")
    for other in (f"{tmp_path}/kept-{'0' * 32}", str(scratch(spark)), f"{path}/..", str(tmp_path)):
        with pytest.raises(ValueError):
            drop_scratch(spark, other)
    assert spark.read.parquet(f"{tmp_path}/kept-{'0' * 32}").count() == 3
