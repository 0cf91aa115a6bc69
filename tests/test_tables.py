"""Duplicates, joins, statistics, positions; with hot keys and different numbers of partitions."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from notemill.operators import dedup, joins, ranks, references, sampling, statistics

HOT = [(i, "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{i % 50}")) for i in range(3000)]


def hot(spark, partitions):
    return spark.createDataFrame(HOT, "id long, k string").repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 7])
def test_count_back_with_a_hot_key_and_nulls(spark, partitions):
    counts = pd.Series([k for _, k in HOT]).value_counts().to_dict()
    got = {r["id"]: r["count"] for r in joins.count_back(hot(spark, partitions), "k", F.col("id")).collect()}
    assert got == {i: counts.get(k) for i, k in HOT}


@pytest.mark.parametrize("small", [True, False])
def test_lookup_join_both_ways(spark, small):
    table = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, v int")
    left = joins.lookup_join(hot(spark, 3), table, "k", F.col("id"), small=small)
    assert {r["id"]: r["v"] for r in left.collect()} == {i: {"hot": 1, "k1": 2}.get(k) for i, k in HOT}
    inner = joins.lookup_join(hot(spark, 3), table, "k", F.col("id"), how="inner", small=small)
    assert inner.count() == sum(k in ("hot", "k1") for _, k in HOT)


def test_a_hot_key_the_table_lacks_beyond_the_broadcast(spark):
    table = spark.createDataFrame([(f"k{i}", i) for i in range(40)], "k string, v int")
    left = joins.lookup_join(hot(spark, 5), table, "k", F.col("id"), small=False, parts=4)
    known = {f"k{i}": i for i in range(40)}
    assert {r["id"]: r["v"] for r in left.collect()} == {i: known.get(k) for i, k in HOT}
    assert left.columns == ["id", "k", "v"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_no_keys_of_sorted_aggregates(spark):
    df = hot(spark, 3).withColumn("g", F.col("id") % 5)
    for made in (dedup.keep_first(df, ["k"], "id"), dedup.shared_rows(df, "k", "g"), dedup.duplicate_report(df, ["k"])):
        assert "SortAggregate" not in plan_of(made)


def test_fingerprints_tell_nulls_and_borders_apart(spark):
    rows = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), ("-", "ab"), (None, None), ("1:a", "b")]
    df = spark.createDataFrame(rows, "x string, y string").select(dedup.fingerprint(["x", "y"]).alias("f"))
    assert df.distinct().count() == len(rows)


def test_small_enough_measures_lists(spark):
    df = spark.range(10).select(F.array_repeat(F.lit("abcdefghij"), 1000).alias("l"))
    assert not joins.small_enough(df, size=50_000)
    assert joins.small_enough(df)


def test_small_enough_measures_rows_and_bytes(spark):
    df = spark.range(100).select(F.repeat(F.lit("x"), 100).alias("s"))
    assert joins.small_enough(df) and not joins.small_enough(df, rows=99) and not joins.small_enough(df, size=5000)


@pytest.mark.parametrize("partitions", [1, 7])
def test_dense_index_and_running_total(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"), (F.col("id") % 5).alias("w")).repartition(partitions)
    assert all(r["x"] == r["i"] for r in ranks.dense_index(df, ["x"], "i").collect())
    rows = sorted(ranks.running_total(df, ["x"], "w", "before").collect(), key=lambda r: r["x"])
    assert [r["before"] for r in rows] == [0] + list(np.cumsum([r["w"] for r in rows])[:-1])


@pytest.mark.parametrize("partitions", [1, 7])
def test_keep_first_with_nulls_and_copies(spark, partitions):
    got = dedup.keep_first(hot(spark, partitions).withColumn("z", F.col("id") * 2), ["k"], "id").collect()
    first = {}
    for i, k in HOT:
        first.setdefault(k, i)
    assert {(r["k"], r["id"], r["z"]) for r in got} == {(k, i, 2 * i) for k, i in first.items()}


def test_shared_rows_and_distincts(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (3, "b"), (4, None), (5, None)], "g long, v string")
    assert sorted(r["g"] for r in dedup.shared_rows(df, "v", "g").collect()) == [1, 2]
    assert tuple(dedup.distinct_counts(df).first()) == (5, 2)
    assert tuple(dedup.duplicate_report(df, ["v"]).first()) == (6, 3, 3)


def test_prefix_and_exact_matches(spark):
    ids = spark.createDataFrame([("R-1",), ("R-12",), ("R-2",)], "id string")
    names = spark.createDataFrame([("R-12.sbml",)], "name string")
    assert sorted(r[0] for r in joins.prefix_matches(ids, "id", names, "name").collect()) == ["R-1", "R-12"]
    exact = joins.exact_matches(ids, "id", names, "name")
    assert [r[0] for r in exact.collect()] == ["R-12"]
    assert sorted(r[0] for r in joins.pending(ids, "id", exact).collect()) == ["R-1", "R-2"]
    assert tuple(joins.completeness(ids, exact).first()) == (3, 1, False)


def test_file_summary(spark):
    rows = spark.createDataFrame([("f1", "n", "A; B"), ("f1", None, None), ("f1", "m", "A"), ("f2", "n", None)],
                                 "file_id string, notes string, only_references string")
    counts = spark.createDataFrame([("f1", 3), ("f2", 1), ("f3", 0)], "file_id string, reaction_count long")
    got = sorted(tuple(r) for r in references.file_summary(counts, rows).collect())
    assert got == [("f1", 3, 2, 3, 2), ("f2", 1, 1, 0, 0)]
    assert [tuple(r) for r in references.most_cited(rows, 1).collect()] == [("A", 2)]


def test_describe_small_column(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 10, None)], "v long")
    row = statistics.describe(df, "v").first().asDict()
    assert row["p5"] == pytest.approx(1.2) and row["p95"] == pytest.approx(8.8) and row["median"] == 3
    assert row["std"] == pytest.approx(3.535534, abs=1e-6) and row["iqr"] == 2 and row["count"] == 5
    assert statistics.describe(df, "v", population=True).first()["std"] == pytest.approx(3.162278, abs=1e-6)
    assert statistics.describe(df.filter("v = 1"), "v").first()["std"] is None


def test_spread_quantiles_equal_numpy(spark):
    values = np.random.default_rng(3).normal(size=997).round(2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    q = statistics.exact_quantiles(df, "v", (0, 0.05, 0.5, 0.9, 1)).first()["q"]
    assert q == pytest.approx(list(np.quantile(values, (0, 0.05, 0.5, 0.9, 1))))
    row = statistics.describe_spread(df, "v").first()
    assert row["std"] == pytest.approx(values.std(ddof=1)) and row["p75"] == pytest.approx(np.quantile(values, 0.75))


def test_histogram_edges(spark):
    counts = spark.createDataFrame([(0, 2), (5, 1), (10, 3)], "value long, n long")
    rows = sorted(tuple(r) for r in statistics.histogram(counts, 5).collect())
    assert [r[2] for r in rows] == [2, 0, 1, 0, 3] and sum(r[3] * 2 for r in rows) == pytest.approx(1)
    flat = statistics.histogram(spark.createDataFrame([(4, 7)], "value long, n long")).collect()
    assert [tuple(r) for r in flat] == [(1, 3.5, 7, 1.0)]


def test_log_keeps_positive_values(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (100.0,)], "v double")
    assert [r["l"] for r in statistics.log10_positive(df, "v", "l").collect()] == [2.0]


def test_box_and_outliers(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, 4, 100)], "v long")
    box = statistics.box_summary(statistics.value_counts(df, "v")).first()
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1, 4, 1)
    assert [r["v"] for r in statistics.outliers(df, "v").collect()] == [100]


def test_samples_repeat(spark):
    one = sampling.seeded_sample(hot(spark, 1), "id", 20).collect()
    seven = sampling.seeded_sample(hot(spark, 7), "id", 20).collect()
    assert one == seven and sampling.seeded_sample(hot(spark, 2).limit(5), "id", 20).count() == 5
    assert [r["id"] for r in sampling.row_slice(hot(spark, 3), ["id"], 16, 18).collect()] == [16, 17]


@pytest.mark.parametrize("partitions", [1, 5])
def test_grouped_references(spark, partitions):
    """One file holds most references: its rows, by place, make up the whole list."""
    data = [(i, "hot" if i % 4 else f"f{i % 8}", f"A {i}; (B {i % 3})") for i in range(200)] + [(200, "none", None)]
    rows = spark.createDataFrame(data, "row_order long, file_id string, only_references string").repartition(partitions)
    got = references.grouped_references(rows, "file_id", "row_order").collect()
    whole = {}
    for r in sorted(got, key=lambda r: r["place"]):
        whole.setdefault(r["file_id"], []).append(r["reference"])
    expected = {}
    for i, file, _ in data[:-1]:
        expected.setdefault(file, []).extend([f"A {i}", f"B {i % 3}"])
    assert whole == expected


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from notemill import session

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default
    with pytest.raises(ValueError):
        session.scratch_path(Session(), "x")


def test_filters_reach_the_scan(spark):
    """Only the needed columns are read and the filter is pushed into the Parquet scan."""
    from notemill.plans import registry
    plan = registry.all_queries()["renamed_projection"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "EqualTo(lang,en)" in plan and "ReadSchema: struct<doc_id:bigint,lang:string,n_chars:bigint>" in plan


def test_no_query_uses_a_cross_join_or_python_row_functions(spark):
    from notemill.plans import registry
    for name in ("file_summary", "sentence_table", "length_categories", "word_count_histogram", "subword_tokens"):
        plan = registry.all_queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "BatchEvalPython" not in plan, name


@pytest.mark.parametrize("partitions", [1, 6])
def test_prefixes_of_many_lengths(spark, partitions):
    rng = random.Random(6)
    make = lambda most: "".join(rng.choice("abé漢") for _ in range(rng.randint(0, most)))
    names = [make(60) for _ in range(300)] + ["hot"] * 200 + [None]
    ids = [make(rng.choice([2, 5, 50])) for _ in range(200)] + [n[:rng.randint(0, len(n))] for n in names[:100]] + ["h", "hot", "hotter", "", "", None, "zz"]
    a = spark.createDataFrame([(i, v) for i, v in enumerate(ids)], "n long, id string").repartition(partitions)
    b = spark.createDataFrame([(v,) for v in names], "name string").repartition(partitions)
    found = sorted(r["n"] for r in joins.prefix_matches(a, "id", b, "name").collect())
    assert found == [i for i, v in enumerate(ids) if v is not None and any(n is not None and n.startswith(v) for n in names)]
    assert joins.prefix_matches(a, "id", b.limit(0), "name").collect() == []


def test_sketches_are_put_together(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("g"), (F.col("id") % 6000).cast("string").alias("v")).unionByName(
        spark.createDataFrame([(1, None), (99, None)], "g long, v string"))
    sketches = dedup.distinct_sketches(df, "g", "v")
    whole = dedup.merged_distinct(sketches).first()["distinct_estimate"]
    each = {r["g"]: r["distinct_estimate"] for r in dedup.merged_distinct(sketches, "g").collect()}
    assert abs(whole - 6000) < 300 and each[99] == 0 and all(abs(n - 20_000 / 7) < 200 for g, n in each.items() if g != 99)
    assert tuple(dedup.distinct_counts(df).first()) == (8, 6000)


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    """A file of one row group has many splits of which one has rows; an even table stays as it is."""
    from notemill.session import spread
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/one")
    rows.repartition(8).write.parquet(f"{tmp_path}/eight")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        one, eight = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("one", "eight"))
        assert one.rdd.getNumPartitions() >= 4
        sizes = [r["n"] for r in spread(one, "id").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 4000 and len(sizes) >= 4 and max(sizes) < 2000
        assert "Exchange" not in spread(eight, "id")._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def notes_folder(spark, path, texts):
    """A folder with a documents table of these texts."""
    rows = [(i, t, "en", f"f{i % 2}", len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_note_texts_are_not_written_when_read_once(spark, tmp_path, monkeypatch):
    from notemill.plans import registry, standins
    monkeypatch.setattr(standins, "materialise", lambda *_: pytest.fail("note texts are written"))
    folder = notes_folder(spark, tmp_path, ["The cell grows. It stops here.", "The cell grows. Nothing else does.", "It stops here."])
    found = registry.all_queries()
    assert [tuple(r) for r in found["largest_file"](spark, folder).collect()] == [("f0", 2)]
    assert found["top_sentences"](spark, folder).collect()[0]["count"] >= 1
