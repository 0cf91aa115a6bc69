"""Length categories and exact stratified splits.

The split never moves a row: three small tables (rows per stratum, rows per stratum and hash bucket,
cut points per stratum) decide it, and the last pass compares each row's hash with its stratum's cuts.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notemill import fixed_values as fv
from notemill.functions import text as tx
from notemill.operators import joins, ranks
from notemill.operators.once import evaluate_once
from notemill.operators.sampling import hash_order
from notemill.session import drop_scratch, materialise, scratch_path

BUCKET_DIGITS = 4       # 65,536 hash buckets per stratum
REMAINDERS = 4096       # classes of remainders


def word_counts(df: DataFrame, columns=("snippet", "notes"), null_as_word: bool = False) -> DataFrame:
    """Adds the word count of each column as ``_words_{column}``. Written with a table, they save ``categorise`` its passes over the texts."""
    return evaluate_once(df, {f"_words_{c}": tx.word_count(F.col(c), null_as_word) for c in columns})


def length_cuts(df: DataFrame, columns=("snippet", "notes"), null_as_word: bool = False) -> DataFrame:
    """One row: an array of three word count quartiles per column."""
    thirds = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    count = lambda c: F.col(f"_words_{c}") if f"_words_{c}" in df.columns else tx.word_count(F.col(c), null_as_word)
    return df.agg(*[F.percentile(count(c), thirds).alias(c) for c in columns])


def categorise(df: DataFrame, first: str = "snippet", second: str = "notes", null_as_word: bool = False) -> DataFrame:
    """Length category of both columns against their own quartiles, and the combined category. Counts of ``word_counts`` are used and dropped."""
    cuts = length_cuts(df, (first, second), null_as_word).select(F.struct(first, second).alias("cuts")).scalar()
    missing = [c for c in (first, second) if f"_words_{c}" not in df.columns]
    counted = word_counts(df, missing, null_as_word) if missing else df
    both = counted.withColumns({f"{c}_category": tx.length_category(F.col(f"_words_{c}"), cuts[c]) for c in (first, second)})
    return both.drop(f"_words_{first}", f"_words_{second}").withColumn(
        "combined_category", F.concat_ws("_", f"{first}_category", f"{second}_category"))


def cross_table(df: DataFrame, rows: str, columns: str, values=fv.LENGTH_CATEGORIES) -> DataFrame:
    """Counts of one column by another with known values, zeros filled in."""
    return df.groupBy(rows).pivot(columns, list(values)).count().na.fill(0)


def balance(df: DataFrame, column: str) -> DataFrame:
    """Most and least common value with their counts, and the ratio; ties go to the first name."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    most, least = F.min(F.struct(-F.col("n"), column)), F.min(F.struct("n", column))
    return counts.agg(most.alias("m"), least.alias("l")).select(
        F.col("m")[column].alias("most_common"), (-F.col("m.col1")).alias("most_count"),
        F.col("l")[column].alias("least_common"), F.col("l.n").alias("least_count"),
        (-F.col("m.col1") / F.col("l.n")).alias("ratio"))


def _largest_remainder(strata: DataFrame, stratum: str, count: str, total: int, share: int, name: str) -> DataFrame:
    """Deal ``share`` out of ``total`` over the strata in proportion to their ``count``; ties by name.

    Every stratum gets its whole part. Which ones get one more is a selection: strata are counted by the size of their
    remainder in ``REMAINDERS`` classes, those above the class where the share ends get one, and only the strata of that
    class are put in order, over all tasks. Products of row counts outgrow 64 bits, hence decimals.
    """
    wide = [F.lit(v).cast("decimal(19,0)") for v in (share, total)]
    product = wide[0] * F.col(count).cast("decimal(19,0)")
    rest = (product % wide[1]).cast("decimal(19,0)")
    dealt = strata.withColumns({"_rest": rest, "_whole": ((product - rest) / wide[1]).cast("long")})
    size = F.floor(F.col("_rest") * F.lit(REMAINDERS).cast("decimal(19,0)") / wide[1])
    dealt = materialise(dealt.withColumn("_class", F.least(size, F.lit(REMAINDERS - 1)).cast("int")), "dealt")
    left, last = share - dealt.agg(F.sum("_whole").alias("n")).first()["n"], REMAINDERS
    for row in sorted(dealt.groupBy("_class").agg(F.count("*").alias("n")).collect(), reverse=True):
        last = row["_class"]
        if row["n"] >= left:
            break
        left -= row["n"]
    one = (F.col("_class") > last).cast("long")
    if left:
        inside = dealt.filter(F.col("_class") == last).select(stratum, "_rest")
        placed = ranks.dense_index(inside, [F.desc("_rest"), stratum], "_place")
        dealt = dealt.join(placed.filter(F.col("_place") < left).select(stratum, F.lit(1).cast("long").alias("_one")), stratum, "left")
        one = F.coalesce("_one", one)
    return dealt.withColumn(name, F.col("_whole") + one).select(*strata.columns, name)


def allocate(counts: DataFrame, stratum: str, val: float, test: float) -> DataFrame:
    """Rows of each stratum (not null) for train, val and test; the three totals are exact.

    First all held-out rows are dealt out, then the test rows among them. Only totals and class counts come to the driver.
    """
    counts = materialise(counts.select(stratum, "n"), "strata")
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    sizes = rows.select("rows", F.ceil(F.lit(val + test) * F.col("rows")).cast("long").alias("held"),
                        F.bround(F.lit(val) * F.col("rows")).cast("long").alias("vals")).first()
    if not sizes["rows"]:
        return counts.select(stratum, "n", *[F.lit(0).cast("long").alias(c) for c in ("train", "val", "test")])
    df = _largest_remainder(counts, stratum, "n", sizes["rows"], sizes["held"], "_held_here")
    if sizes["held"]:
        df = _largest_remainder(df, stratum, "_held_here", sizes["held"], sizes["held"] - sizes["vals"], "test")
    else:
        df = df.withColumn("test", F.lit(0).cast("long"))
    return df.select(stratum, "n", (F.col("n") - F.col("_held_here")).alias("train"),
                     (F.col("_held_here") - F.col("test")).alias("val"), "test")


def stratified_split(df: DataFrame, stratum: str, key: str, shares: dict = fv.SPLIT_SHARES,
                     seed: int = fv.SPLIT_SEED) -> DataFrame:
    """Add a ``split`` column. Sizes are exact overall and within one row per stratum.

    Rows of a stratum are ordered by a hash of their key; the first ones train, the next validate, the
    last test. The cuts are found in the one hash bucket where they fall, so a stratum holding most
    rows is never sorted as a whole.
    """
    order = F.concat_ws(":", hash_order(key, seed), F.col(key).cast("string"))
    # a null stratum is one like the others, so its key must join
    named = F.when(F.col(stratum).isNull(), "null").otherwise(F.concat(F.lit("v"), F.col(stratum).cast("string")))
    written = scratch_path(df.sparkSession, "split")
    keyed = materialise(df.select(named.alias("_stratum"), order.alias("_order"))
                        .withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS)), path=written)
    buckets = materialise(keyed.groupBy("_stratum", "_bucket").agg(F.count("*").alias("n")), "buckets")
    sizes = allocate(buckets.groupBy("_stratum").agg(F.sum("n").alias("n")), "_stratum", shares["val"], shares["test"])
    so_far = Window.partitionBy("_stratum").orderBy("_bucket")
    placed = (buckets.withColumn("_upto", F.sum("n").over(so_far)).withColumn("_before", F.col("_upto") - F.col("n"))
              .drop("n").join(sizes, "_stratum"))
    # one row per stratum and cut: the bucket that holds the cut-th row of the stratum
    wanted = placed.select("*", F.explode(F.array(F.struct(F.lit("train").alias("cut"), F.col("train").alias("rank")),
                                                  F.struct(F.lit("val").alias("cut"), (F.col("train") + F.col("val")).alias("rank")))).alias("c"))
    wanted = wanted.filter("_before < c.rank AND c.rank <= _upto").select(
        "_stratum", "_bucket", F.col("c.cut").alias("cut"), (F.col("c.rank") - F.col("_before")).alias("_rank"))
    near = keyed.join(F.broadcast(wanted) if joins.small_enough(wanted) else wanted, ["_stratum", "_bucket"])
    ranked = near.withColumn("_place", F.row_number().over(Window.partitionBy("_stratum", "_bucket", "cut").orderBy("_order")))
    cuts = ranked.filter("_place = _rank").groupBy("_stratum").agg(
        F.max(F.when(F.col("cut") == "train", F.col("_order"))).alias("_train_cut"),
        F.max(F.when(F.col("cut") == "val", F.col("_order"))).alias("_val_cut"))
    cuts = materialise(cuts, "cuts")
    drop_scratch(df.sparkSession, written)
    small = joins.small_enough(cuts)
    rows = joins.lookup_join(df.withColumns({"_order": order, "_stratum": named}), cuts, "_stratum",
                             F.col("_order"), small=small)
    return rows.withColumn(
        "split", F.when(F.col("_order") <= F.col("_train_cut"), "train")
        .when(F.col("_order") <= F.col("_val_cut"), "val").otherwise("test")
    ).drop("_order", "_stratum", "_train_cut", "_val_cut")


def split_counts(df: DataFrame, stratum: str) -> DataFrame:
    """Rows of each stratum in each split."""
    return cross_table(df, stratum, "split", list(fv.SPLIT_SHARES))
