"""Divergence of sources against plain arithmetic, and its edge rows."""

import random
import re
from collections import Counter, defaultdict

import pytest

from notemill.llm import divergence, queries
from tests.llm.test_operators import WORDS, prose


def plainly(rows):
    """The same by definition: (lang, source, part, item, value, rank)."""
    held, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups[lang].add(source)
        held[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in seen[lang].items() if n >= 3)
        counts = {s: {t: held[lang, s][t] for t in kept} for s in sources}
        counts[None] = {t: sum(counts[s][t] for s in sources) for t in kept}
        share = {s: {t: 1 + 10**9 * (c + 1) // (sum(own.values()) + len(kept)) for t, c in own.items()} for s, own in counts.items()}
        apart = lambda p, q: (p - q) * (p - q) // q
        for s in sources:
            pairs = [(sum(apart(share[s][t], share[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(apart(share[s][t], share[None][t]), t) for t in kept if counts[s][t] and share[s][t] > share[None][t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, 200)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def rows_of(seed, count, langs, sources):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        words = [rng.choice(WORDS[:12]) + rng.choice(["", "É", "漢", "X9y", "-b", "\n"]) for _ in range(rng.randint(0, 40))]
        rows.append((rng.choice(langs), rng.choice(sources), rng.choice([" ", "1", "_"]).join(words)))
    return rows


@pytest.mark.parametrize("term_block, group_block", [(4096, 16), (7, 3), (1, 1)])
def test_equals_plain_arithmetic(spark, term_block, group_block):
    rows = rows_of(3, 150, ["en", "de", "", None], [f"s{i}" for i in range(9)] + [None, ""])
    rows += [("lone", "a", "unlike"), ("lone", "b", None), ("lone", "c", "..."), ("one", "only", "so so so"), ("en", "s1", "z" * 30_000)] + rows[:5]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n int").repartition(5)
    found = divergence.audit(docs, term_block, group_block).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(map(tuple, found.collect())) == plainly(rows)


def test_hot_source_long_text_and_hand_over(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(divergence, "LONG_TEXT", 1000)
    long = prose(5, 5000)
    rows = [("en", "hot", long)] * 30 + [("en", f"s{i}", prose(i, 50)) for i in range(40)]
    found = divergence._term_lists(long.encode())
    assert [t.decode() for part in found for t in part] == long.split()
    spark.createDataFrame(rows, "lang string, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, queries.op11_divergence(spark, str(tmp_path)).collect())) == plainly(rows)


def test_counts_are_handed_on_in_parts(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "COUNTED", 1)
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "a"], "source": ["s", "s"], "text": ["x y x", "x"]})
    rows = [r for b in divergence._counted(iter([batch, batch])) for r in b.to_pylist()]
    assert [(r["term"], r["n"], r["docs"]) for r in rows] == [("x", 3, 2), ("y", 1, 1)] * 2


def test_large_counts_are_exact(spark):
    n, size = 2**61, 2**62
    row = spark.range(1).select(divergence.share(*[divergence.F.lit(v) for v in (n, size, 77)]).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 1) // (size + 77)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).collect() == []
