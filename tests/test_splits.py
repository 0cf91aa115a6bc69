import math
from collections import Counter, defaultdict

import pytest

from notemill.operators import splits


def strata(n):
    """One stratum of a third, many small ones, one of a single row."""
    return [(i, "single" if i == 0 else "big" if i % 3 == 0 else f"s{i % 37}") for i in range(n)]


@pytest.mark.parametrize("n,partitions", [(1000, 1), (1000, 7), (997, 3), (41, 2)])
def test_sizes_are_exact_and_proportional(spark, n, partitions):
    rows = spark.createDataFrame(strata(n), "key long, stratum string").repartition(partitions)
    got = splits.stratified_split(rows, "stratum", "key").collect()
    assert len(got) == n and len({r["key"] for r in got}) == n
    held, val = math.ceil((0.15 + 0.05) * n), round(0.15 * n)
    assert Counter(r["split"] for r in got) == {k: v for k, v in (("train", n - held), ("val", val), ("test", held - val)) if v}
    per = defaultdict(Counter)
    for r in got:
        per[r["stratum"]][r["split"]] += 1
    for stratum, counts in per.items():
        size = sum(counts.values())
        assert abs(size - counts["train"] - held * size / n) < 1


def dealt_plainly(sizes, total, share):
    """Largest remainder by definition."""
    whole = {s: share * n // total for s, n in sizes.items()}
    order = sorted(sizes, key=lambda s: (-(share * sizes[s] % total), s))
    for s in order[:share - sum(whole.values())]:
        whole[s] += 1
    return whole


@pytest.mark.parametrize("classes", [4096, 3, 1])
def test_shares_of_many_strata(spark, monkeypatch, classes):
    """Equal, near and far remainders; a stratum of nearly everything; the same rows whatever the classes."""
    monkeypatch.setattr(splits, "REMAINDERS", classes)
    for sizes in ({f"s{i:03}": 7 for i in range(300)}, {f"s{i:03}": i * i % 50 + 1 for i in range(300)}, {"a": 10**15, "b": 3, "c": 4}, {"only": 9}):
        n = sum(sizes.values())
        held = math.ceil((0.15 + 0.05) * n)
        tests = held - round(0.15 * n)
        held_here = dealt_plainly(sizes, n, held)
        test_here = dealt_plainly(held_here, held, tests)
        got = splits.allocate(spark.createDataFrame(list(sizes.items()), "s string, n long").repartition(3), "s", 0.15, 0.05).collect()
        assert {r["s"]: (r["train"], r["val"], r["test"]) for r in got} == {
            s: (sizes[s] - held_here[s], held_here[s] - test_here[s], test_here[s]) for s in sizes}


def test_no_strata(spark):
    assert splits.allocate(spark.createDataFrame([], "s string, n long"), "s", 0.15, 0.05).collect() == []


def test_split_does_not_depend_on_partitions(spark):
    def run(partitions):
        rows = spark.createDataFrame(strata(500), "key long, stratum string").repartition(partitions)
        return {r["key"]: r["split"] for r in splits.stratified_split(rows, "stratum", "key").collect()}
    assert run(1) == run(9)


def test_many_rows_per_bucket(spark, monkeypatch):
    """With one hash digit the cuts fall inside crowded buckets."""
    rows = spark.createDataFrame(strata(800), "key long, stratum string")
    fine = {r["key"]: r["split"] for r in splits.stratified_split(rows, "stratum", "key").collect()}
    monkeypatch.setattr(splits, "BUCKET_DIGITS", 1)
    assert fine == {r["key"]: r["split"] for r in splits.stratified_split(rows, "stratum", "key").collect()}


def test_categories(spark):
    rows = spark.createDataFrame([(i, "w " * i, None if i == 1 else "n " * (9 - i)) for i in range(1, 9)],
                                 "id long, snippet string, notes string")
    got = {r["id"]: r["combined_category"] for r in splits.categorise(rows).collect()}
    assert got[1] == "short_short" and got[8].startswith("very_long_") and len(got) == 8
    table = splits.cross_table(splits.categorise(rows), "snippet_category", "notes_category").collect()
    assert sum(sum(r[c] for c in ("short", "medium", "long", "very_long")) for r in table) == 8
    balance = splits.balance(spark.createDataFrame([("b",), ("a",), ("a",), ("c",)], "c string"), "c").first()
    assert tuple(balance) == ("a", 2, "b", 1, 2.0)


def test_a_null_stratum_is_split_like_any_other(spark):
    rows = spark.createDataFrame([(i, "a" if i % 2 else None) for i in range(100)], "k long, s string")
    found = {(r["s"], r["split"]): r["count"] for r in splits.stratified_split(rows, "s", "k").groupBy("s", "split").count().collect()}
    assert sum(n for (_, split), n in found.items() if split == "train") == 80
    assert sum(n for (_, split), n in found.items() if split == "val") == 15
    assert found[None, "train"] == found["a", "train"] == 40


def test_words_are_counted_once_per_job(spark, tmp_path, monkeypatch):
    """The kept rows carry their word counts; categories and the written files are the same as without them."""
    from notemill.plans import jobs
    from notemill.functions import text as tx
    rows = [(f"f{i % 3}", f"R-{i}", "o", " ".join(["w"] * (i % 17)) if i % 11 else None, None, " ".join(["s"] * (i % 23)), f"{i:05d}") for i in range(300)]
    schema = "file_id string, reaction_id string, original_notes string, notes string, only_references string, snippet string, row_order string"
    df = spark.createDataFrame(rows, schema)
    df.write.parquet(f"{tmp_path}/reactions")
    jobs.build_splits(spark, str(tmp_path))
    monkeypatch.setattr(tx, "word_count", lambda *_: pytest.fail("words are counted again"))
    _, again = jobs.build_splits(spark, str(tmp_path))
    monkeypatch.undo()
    wanted = splits.categorise(df.dropDuplicates(["snippet", "notes"]))
    key = lambda r: tuple(r[c] or "" for c in ("snippet", "notes", "combined_category"))
    found = spark.read.schema("snippet string, notes string, combined_category string").json(again)
    assert sorted(map(key, found.collect())) == sorted(map(key, wanted.collect()))
    assert not any(c.startswith("_words") for c in spark.read.json(again).columns)
