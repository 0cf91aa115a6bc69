"""Ranks by bucket counts against sorted lists."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from notemill.operators import selection, statistics


def values_of(kind, rng, n):
    return {"even": lambda: rng.uniform(-5, 5), "steep": lambda: 10 ** rng.uniform(-300, 300) * rng.choice([-1, 1]),
            "few": lambda: float(rng.choice([1, 2, 2, 3])), "one": lambda: 4.0, "crowded": lambda: rng.choice([0.0, 1e9]) + rng.gauss(0, 1e-3)}[kind], n


@pytest.mark.parametrize("last, buckets", [(100_000, 4096), (5, 64)])
def test_values_at_ranks(spark, monkeypatch, last, buckets):
    monkeypatch.setattr(selection, "LAST_ROWS", last)
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    rng, rows = random.Random(4), []
    for kind, n in (("even", 300), ("steep", 200), ("few", 150), ("one", 40), ("crowded", 200), (None, 1)):
        make = values_of(kind or "even", rng, n)[0]
        rows += [(kind, make(), "x") for _ in range(n)]
    rows += [("few", None, "x"), ("few", float("nan"), "x"), ("nothing", None, "x")]
    df = spark.createDataFrame(rows, "g string, v double, rank string").repartition(6)
    held = {}
    for g, v, _ in rows:
        if v is not None and v == v:
            held.setdefault(g, []).append(v)
    asked = [(g, r) for g, vs in held.items() for r in {0, len(vs) - 1, len(vs) // 2, len(vs) // 3, len(vs)}]
    got = selection.values_at(df, "v", spark.createDataFrame(asked, "g string, rank long"), "g").collect()
    wanted = {(g, r): sorted(held[g])[r] for g, r in asked if r < len(held[g])}
    assert {(r["g"], r["rank"]): r["value"] for r in got} == wanted and len(got) == len(wanted)


def test_quantiles_of_all_rows_and_of_endless_values(spark):
    rng = np.random.default_rng(3)
    values = rng.normal(size=999)
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    row = selection.quantiles(df, "v", (0, 0.05, 0.5, 0.9, 1)).first()
    assert row["n"] == 999 and row["q"] == pytest.approx(np.quantile(values, (0, 0.05, 0.5, 0.9, 1)).tolist())
    endless = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,)], "v double")
    assert selection.quantiles(endless, "v", (0.5,)).first()["q"] == [1.0]
    assert selection.quantiles(df.filter("v > 100"), "v", (0.5,)).collect() == []


def test_columns_and_groups_together(spark):
    rows = [("a", 1, 2.0), ("a", 3, None), ("b", 5, 7.0), (None, 9, 1.0), ("a", 4, 6.0)]
    df = spark.createDataFrame(rows, "g string, x long, y double")
    got = {(r["g"], r["column"]): (r["count"], r["median"], r["minimum"], r["p95"]) for r in statistics.describe_columns(df, ["x", "y"], "g").collect()}
    assert got == {("a", "x"): (3, 3.0, 1.0, pytest.approx(3.9)), ("a", "y"): (2, 4.0, 2.0, pytest.approx(5.8)), ("b", "x"): (1, 5.0, 5.0, 5.0),
                   ("b", "y"): (1, 7.0, 7.0, 7.0), (None, "x"): (1, 9.0, 9.0, 9.0), (None, "y"): (1, 1.0, 1.0, 1.0)}
