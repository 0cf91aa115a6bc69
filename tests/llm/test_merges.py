"""Byte-level BPE by segment trees against the library, and its edge rows."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from notemill.llm import merges, queries
from tests.llm.test_operators import EDGE, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def merger():
    with open(PATH, encoding="utf-8") as file:
        return merges.Merger(merges.read_rules(file.read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(merger, text):
    return np.frombuffer(merger.encode([text])[0], dtype=np.int32).tolist()


def test_ids_and_text_equal_the_library(merger, library):
    rng = random.Random(5)
    parts = ["abcdefg etaoin", "aAbB 019\n\t.,;'s't", "éèüß漢字😀👍🏽  \x85", "!@#$%^&*()_-=  ", "aaaab", "\x00\x1c​ﻯ՘\U0001df1f꟎",
             ["<|endoftext|>", "<|endof", " "]]
    for _ in range(4000):
        text = "".join(rng.choice(rng.choice(parts)) for _ in range(rng.randint(0, 60)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert ids_of(merger, text) == ids and merger.text(ids) == library.decode(ids, skip_special_tokens=False)
        chance = [rng.randrange(50257) for _ in range(8)]
        assert merger.text(chance) == library.decode(chance, skip_special_tokens=False)


def test_every_character_is_split_like_the_library(merger, library):
    characters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(characters), 5000):
        text = "".join(f"a{c}b1{c} {c}  {c}{c}" for c in characters[at:at + 5000])
        assert ids_of(merger, text) == library.encode(text, add_special_tokens=False).ids


def test_single_and_batched_trees_agree(merger):
    rng = random.Random(9)
    for size in (2, 4, 8, 16, 32):
        pieces = [bytes(rng.choice(b"etaoinshr \xc3\xa9") for _ in range(rng.randint(1, size + 1))) for _ in range(300)]
        packed = merger.merged_together(pieces, size)
        assert [np.frombuffer(p, dtype=np.int32).tolist() for p in packed] == [merger.merged([merger.first[b] for b in p]) for p in pieces]


def test_lowest_rank_then_leftmost():
    """Of equal ranks the left pair goes first: aaa becomes (aa)a."""
    rules = {"tokens": [b"a", b"b", b"aa", b"ab"], "bytes": [0, 1], "added": {}, "pairs": [(0, 0, 2), (0, 1, 3)]}
    merger = merges.Merger(rules | {"bytes": [0] * 256}, r"(?s:.)+")
    assert merger.merged([0, 0, 0]) == [2, 0] and merger.merged([0, 0, 1]) == [2, 1] and merger.merged([0, 1, 0, 1]) == [3, 3]


def test_long_pieces_and_forgotten_ones(merger, library, monkeypatch):
    for text in ("ab" * 30_000, "z" * 9001, "-=" * 5000 + "abc", prose(1, 40_000)):
        assert ids_of(merger, text) == library.encode(text).ids
    monkeypatch.setattr(merges, "PIECES", 50)
    monkeypatch.setattr(merges, "BLOCK", 400)
    for seed in range(20):
        text = prose(seed, 300) + "<|endoftext|>" + prose(seed, 40)
        assert ids_of(merger, text) == library.encode(text).ids
    assert all(len(p) <= 60 for p in merger.young)


def test_query_rows(spark, tmp_path, library):
    rows = [*EDGE, (95, prose(3, 20_000)), (96, "a<|endoftext|>b"), (96, "a<|endoftext|>b")]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, coded string, ids string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    encoded = [(i, library.encode(t or "", add_special_tokens=False).ids, t or "") for i, t in rows]
    wanted = [(i, len(ids), sha(",".join(map(str, ids))), sha(t)) for i, ids, t in encoded]
    assert sorted(map(repr, map(tuple, queries.op13_merge_bpe(spark, str(tmp_path)).collect()))) == sorted(map(repr, wanted))
    frame.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    assert queries.op13_merge_bpe(spark, f"{tmp_path}/empty").collect() == []
