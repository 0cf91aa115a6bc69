"""Text quality by a sparse ensemble of rules.

Statistics of the whole text feed small trees; every path of a tree from its root is a rule (a conjunction of
thresholds). A logistic regression with a lasso penalty keeps few of the rules, with weights. What remains
is compiled into one Spark column expression, which scores any table that has the statistics.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.llm.blocks import NOT_SPACE, pieces, text_bytes, word_hashes, word_spans
from notemill.session import materialise

TREES, DEPTH, PENALTY, SEED = 12, 3, 0.002, 11
#: Bound of the labelled rows that are learnt from; beyond it a share by hash is taken.
MOST_ROWS = 200_000

STATISTICS = ("words", "mean_length", "distinct_words", "distinct_pairs", "top_word", "same_as_before", "upper", "digits", "marks",
              "odd_marks", "bars", "exclamations", "stops", "lines", "words_per_line", "long_words", "distinct_lines", "top_byte")

_BYTE = {name: np.isin(np.arange(256), np.frombuffer(chars, dtype=np.uint8)) for name, chars in (
    ("upper", bytes(range(65, 91))), ("digits", bytes(range(48, 58))), ("odd_marks", b"#$%&*@^~<>{}[]\\/=+_"), ("bars", b"|\t"),
    ("exclamations", b"!"), ("stops", b".,;:?"),
    ("marks", bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])))}


def _share(part: float, whole: float) -> float:
    return float(part) / whole if whole else 0.0


def text_statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` per text; an empty text has zeros."""
    raw, offsets = text_bytes(texts)
    starts, ends, first = word_spans(raw, offsets, NOT_SPACE)
    hashes = word_hashes(raw, starts, ends)
    lengths = ends - starts
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:]
    out = np.zeros((len(texts), len(STATISTICS)))
    for i in range(len(texts)):
        a, b, lo, hi = first[i], first[i + 1], offsets[i], offsets[i + 1]
        n, size = int(b - a), int(hi - lo)
        if not n:
            continue
        counts = np.bincount(raw[lo:hi], minlength=256)
        own, spans = hashes[a:b], lengths[a:b]
        _, often = np.unique(own, return_counts=True)
        lines = [x for x in raw[lo:hi].tobytes().split(b"\n") if x.strip()]
        solid = max(1, size - int(counts[32] + counts[9:14].sum()))
        by = {name: int(counts[chars].sum()) for name, chars in _BYTE.items()}
        out[i] = (n, spans.mean(), len(often) / n, _share(len(np.unique(pairs[a:b - 1])), n - 1), often.max() / n,
                  _share((own[1:] == own[:-1]).sum(), n - 1), by["upper"] / solid, by["digits"] / solid, by["marks"] / solid,
                  by["odd_marks"] / solid, by["bars"] / solid, by["exclamations"] / solid, by["stops"] / n, len(lines), n / len(lines),
                  (spans > 14).mean(), len(set(lines)) / len(lines), counts[33:].max() / solid)
    return out


def statistics(text: Column) -> Column:
    """The statistics of a text as an array, in the order of ``STATISTICS``. Null counts as empty."""
    def of(texts: pa.Array) -> pa.Array:
        rows = [text_statistics(p.column(0)) for p in pieces(pa.RecordBatch.from_arrays([texts], ["text"]), "text")]
        flat = np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * len(STATISTICS)), pa.array(flat.ravel()))
    return F.arrow_udf(of, "array<double>")(text)


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, is above, threshold) that all hold, and the weight of that."""
    conditions: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, row: Column) -> Column:
        parts = [(F.get(row, F.lit(i)) > t) if above else (F.get(row, F.lit(i)) <= t) for i, above, t in self.conditions]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole & part
        return whole


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self, row: Column) -> Column:
        """Probability of a good text: one expression over the array of statistics."""
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.holds(row), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(nodes: list) -> list[tuple]:
    """The conditions on the way to every node but the roots. A node has tree, id, left, right, statistic, threshold."""
    by_id = {(n["tree"], n["id"]): n for n in nodes}
    found, open_nodes = {}, [((tree, 0), ()) for tree in sorted({n["tree"] for n in nodes})]
    while open_nodes:
        key, path = open_nodes.pop()
        node = by_id[key]
        if path:
            found[tuple(sorted(set(path)))] = None
        if node["left"] >= 0:
            for child, above in ((node["left"], False), (node["right"], True)):
                open_nodes.append(((key[0], child), (*path, (node["statistic"], above, node["threshold"]))))
    return sorted(found)


def _nodes(forest) -> list:
    """The forest's nodes: at most TREES * 2 ** (DEPTH + 1) of them."""
    out = []
    for tree, model in enumerate(forest.trees):
        stack, count = [(model._call_java("rootNode"), 0)], 1
        while stack:
            node, number = stack.pop()
            row = {"tree": tree, "id": number, "left": -1, "right": -1, "statistic": -1, "threshold": 0.0}
            if node.subtreeDepth() > 0:
                split = node.split()
                row |= {"left": count, "right": count + 1, "statistic": split.featureIndex(), "threshold": split.threshold()}
                stack += [(node.leftChild(), count), (node.rightChild(), count + 1)]
                count += 2
            out.append(row)
    return out


def learn(labelled: DataFrame, row: str = "statistics", label: str = "label", key: str = "doc_id") -> Ensemble:
    """Rules and weights from rows with statistics and a label of 0 or 1; other labels are left out.

    With labels of one value only, or none, the score is the smoothed share of good rows.
    """
    known = labelled.filter(F.col(label).isin(0, 1) & F.col(row).isNotNull())
    counts = {r[label]: r["count"] for r in known.groupBy(label).count().collect()}
    good, total = counts.get(1, 0), sum(counts.values())
    if not good or good == total:
        return Ensemble((), float(np.log((good + 1) / (total - good + 1))))
    if total > MOST_ROWS:
        known = known.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int((1 << 20) * MOST_ROWS / total))
    rows = materialise(known.select(F.col(label).cast("double").alias("label"), F.col(row).alias("row")), "labelled")
    vectors = rows.select("label", array_to_vector("row").alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird", subsamplingRate=0.7).fit(vectors)
    rules = [Rule(conditions) for conditions in tree_rules(_nodes(forest))]
    if not rules:
        return Ensemble((), float(np.log((good + 1) / (total - good + 1))))
    held = F.array(*[rule.holds(F.col("row")).cast("double") for rule in rules])
    facts = materialise(rows.select("label", held.alias("facts")), "rules")
    lasso = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, maxIter=60, standardization=False).fit(
        facts.select("label", array_to_vector("facts").alias("features")))
    weights = lasso.coefficients.toArray()
    return Ensemble(tuple(Rule(r.conditions, float(w)) for r, w in zip(rules, weights) if w), float(lasso.intercept))
