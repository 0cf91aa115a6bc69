"""Byte-level BPE by merge rules: a segment tree over the ranks of adjacent pairs.

A piece starts as one symbol per byte. Leaf i of its tree holds the rank of the pair of symbols that starts at byte i,
combined with i, or nothing where no rule joins them. The root is the least leaf: the lowest rank, and of equal ranks
the leftmost. Applying that merge changes three leaves (the pair itself, the pair to its left, and the one that
began at the symbol swallowed), each a walk towards the root that ends as soon as a node keeps its value. The
encoding is done when the root is empty. A piece of n bytes takes O(n log n) whatever its merges are.

Most pieces are a word; those of at most ``TOGETHER`` bytes are merged side by side, one tree in every row of an array.
Pieces already met are looked up: two generations of about ``PIECES`` each, of which the older is forgotten.
"""

import itertools
import json
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from notemill.llm.blocks import given_back

#: Known pieces of one generation; longer ones (in bytes) have a tree of their own and are not kept.
PIECES, TOGETHER = 200_000, 33
#: Characters of text whose pieces are met together.
BLOCK = 1 << 19
NONE = 1 << 62

#: Code points that are letters or numbers in newer Unicode tables than those the rules were made with;
#: there they belong to neither.
NEWER = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7
10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6
187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81
1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E
2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""


def newer_class() -> str:
    ranges = [part.split("-") for part in NEWER.split()]
    return "[" + "".join(rf"\U{r[0]:0>8}-\U{r[-1]:0>8}" for r in ranges) + "]"


def byte_characters() -> list[str]:
    """The visible character that stands for each byte in a vocabulary file: Latin-1's own where it can be seen, the
    characters from U+0100 on, in order, for the others."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in seen else chr(next(hidden)) for b in range(256)]


def read_rules(data: str) -> dict:
    """What a vocabulary file says: bytes of every id, id of each byte, (left, right) ids of every merge by rank with
    the id it makes, and the strings that are one token wherever they stand."""
    given = json.loads(data)
    vocabulary, bytes_of = given["model"]["vocab"], {c: b for b, c in enumerate(byte_characters())}
    added = {one["content"]: one["id"] for one in given.get("added_tokens", [])}
    pairs = [tuple(rule.split(" ")) if isinstance(rule, str) else tuple(rule) for rule in given["model"]["merges"]]
    tokens = [b""] * (1 + max([*vocabulary.values(), *added.values()]))
    for text, i in [*vocabulary.items(), *added.items()]:
        # like the library's decoder: a string with a character that stands for no byte is taken as it is
        tokens[i] = bytes(map(bytes_of.get, text)) if all(c in bytes_of for c in text) else text.encode()
    return {"tokens": tokens, "bytes": [vocabulary[c] for c in byte_characters()], "added": added,
            "pairs": [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]}


def beyond_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return True
    return False


class Merger:
    """Encodes and decodes with one set of rules."""

    def __init__(self, rules: dict, pattern: str):
        self.tokens, self.first = rules["tokens"], rules["bytes"]
        self.rank = {a << 32 | b: rank for rank, (a, b, _) in reversed(list(enumerate(rules["pairs"])))}
        self.made = [c for _, _, c in rules["pairs"]]
        self.added = rules["added"]
        self.split = regex.compile(pattern)
        strict = (pattern.replace(r"\p{L}+", rf"(?:(?!{newer_class()})\p{{L}})+").replace(r"\p{N}+", rf"(?:(?!{newer_class()})\p{{N}})+")
                  .replace(r"[^\s\p{L}\p{N}]+", rf"(?:[^\s\p{{L}}\p{{N}}]|{newer_class()})+"))
        self.strict, self.newer = regex.compile(strict), regex.compile(newer_class())
        own = sorted(self.added, key=len, reverse=True)
        self.own = regex.compile("|".join(map(regex.escape, own))) if own else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        codes = np.array([a << 32 | b for a, b, _ in rules["pairs"]], dtype=np.int64)
        self.codes, self.ranks = np.unique(codes, return_index=True)
        self.made_ids, self.first_ids = np.array(self.made, dtype=np.int64), np.array(self.first, dtype=np.int64)

    def merged(self, symbols: list[int]) -> list[int]:
        """Apply the lowest-rank, leftmost merge until none is left."""
        count = len(symbols)
        if count < 2:
            return symbols
        rank, made = self.rank.get, self.made
        size = 1 << (count - 2).bit_length()
        tree = [NONE] * (2 * size)
        leaf = size
        for left, right in zip(symbols, symbols[1:]):
            found = rank(left << 32 | right)
            if found is not None:
                tree[leaf] = found * size + leaf - size
            leaf += 1
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        root = tree[1]
        while root != NONE:
            found, at = divmod(root, size)
            symbols[at] = symbol = made[found]
            gone = after[at]
            following = after[at] = after[gone]
            symbols[gone] = -1
            changes = [(at, NONE)]
            if following < count:
                before[following] = at
                found = rank(symbol << 32 | symbols[following])
                if found is not None:
                    changes = [(at, found * size + at)]
                changes.append((gone, NONE))
            previous = before[at]
            if previous >= 0:
                found = rank(symbols[previous] << 32 | symbol)
                changes.append((previous, NONE if found is None else found * size + previous))
            for place, value in changes:
                node = size + place
                while tree[node] != value:
                    tree[node] = value
                    if node == 1:
                        break
                    other = tree[node ^ 1]
                    node >>= 1
                    if other < value:
                        value = other
            root = tree[1]
        return [s for s in symbols if s >= 0]

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
        """Leaf values of many pairs at once; -1 stands for no symbol."""
        code = left << 32 | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at] * size + place, NONE)

    def merged_together(self, pieces: list[bytes], size: int) -> list[bytes]:
        """The same for many pieces of at most ``size`` + 1 bytes: one tree a row, one merge in every row a step.

        Every array has columns to spare for the place behind the last symbol.
        """
        rows, levels = np.arange(len(pieces)), size.bit_length() - 1
        counts = np.array([len(p) for p in pieces])
        width = size + 2
        symbols = np.full((len(pieces), width), -1, dtype=np.int64)
        symbols[np.arange(width) < counts[:, None]] = self.first_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        tree = np.full((len(pieces), 2 * size + 2), NONE, dtype=np.int64)
        tree[:, size:2 * size] = self.leaves(symbols[:, :size], symbols[:, 1:size + 1], np.arange(size), size)
        for level in range(levels - 1, -1, -1):
            first = 1 << level
            tree[:, first:2 * first] = np.minimum(tree[:, 2 * first:4 * first:2], tree[:, 2 * first + 1:4 * first:2])
        after = np.tile(np.arange(1, width + 1), (len(pieces), 1)).ravel()
        before = np.tile(np.arange(-1, width - 1), (len(pieces), 1)).ravel()
        flat, nodes, columns = symbols.ravel(), tree.ravel(), 2 * size + 2
        rows = rows[tree[:, 1] != NONE]
        while len(rows):
            base, trunk = rows * width, rows * columns
            root = nodes[trunk + 1]
            at = root & (size - 1)
            symbol = self.made_ids[root >> levels]
            gone = after[base + at]
            following = after[base + gone]
            flat[base + at], flat[base + gone] = symbol, -1
            after[base + at] = following
            before[base + following] = at
            previous = before[base + at]
            left = np.where(previous < 0, -1, flat[base + np.maximum(previous, 0)])
            nodes[trunk + size + gone] = NONE
            nodes[trunk + size + at] = self.leaves(symbol, flat[base + following], at, size)
            behind = previous >= 0
            nodes[(trunk + size + previous)[behind]] = self.leaves(left, symbol, previous, size)[behind]
            changed = np.stack([at, np.minimum(gone, size - 1), np.where(behind, previous, at)]) + size
            for _ in range(levels):
                changed >>= 1
                nodes[trunk + changed] = np.minimum(nodes[trunk + 2 * changed], nodes[trunk + 2 * changed + 1])
            rows = rows[nodes[trunk + 1] != NONE]
        left = symbols >= 0
        packed, ends = symbols[left].astype(np.int32).tobytes(), np.cumsum(left.sum(axis=1)) * 4
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def learn(self, pieces: set[str]) -> list[str]:
        """Put the ids of all these pieces among the young ones; the long pieces are returned, to be forgotten again."""
        if len(self.young) >= PIECES:
            self.old, self.young = self.young, {}
        unknown = pieces.difference(self.young)
        again = unknown & self.old.keys()
        self.young.update((p, self.old[p]) for p in again)
        classes: dict[int, list[tuple[str, bytes]]] = {}
        long = []
        for piece in unknown - again:
            data = piece.encode()
            if len(data) > TOGETHER:
                self.young[piece] = array("i", self.merged([self.first[b] for b in data])).tobytes()
                long.append(piece)
            else:
                size = max(2, 1 << max(len(data) - 2, 0).bit_length())
                classes.setdefault(size, []).append((piece, data))
        for size, members in classes.items():
            self.young.update(zip([p for p, _ in members], self.merged_together([d for _, d in members], size)))
        return long

    def parts(self, text: str) -> Iterator[str]:
        """The strings between the added tokens, and those tokens."""
        at = 0
        if self.own:
            for match in self.own.finditer(text):
                yield text[at:match.start()]
                yield match.group()
                at = match.end()
        yield text[at:] if at else text

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text in order, in lists of bounded size; an added token is a piece of its own."""
        for i, part in enumerate(self.parts(text)):
            if i % 2:
                self.young[part] = array("i", [self.added[part]]).tobytes()
                yield [part]
                continue
            split = self.strict if beyond_latin(part) and self.newer.search(part) else self.split
            if len(part) < BLOCK:
                yield split.findall(part)
            else:
                found = (match.group() for match in split.finditer(part))
                while some := list(itertools.islice(found, BLOCK // 8)):
                    yield some

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of every text as packed 32-bit integers. Pieces are met in blocks of texts, each new piece once a block."""
        out: list[list[bytes] | None] = [None if t is None else [] for t in texts]
        held, size = [], 0
        for row, text in enumerate(texts):
            for some in self.pieces(text) if text else ():
                held.append((row, some))
                size += len(some)
                if size >= BLOCK // 8:
                    self.settle(held, out)
                    held, size = [], 0
        self.settle(held, out)
        return [None if parts is None else b"".join(parts) for parts in out]

    def settle(self, held: list[tuple[int, list[str]]], out: list) -> None:
        long = self.learn(set(itertools.chain.from_iterable(some for _, some in held)))
        for row, some in held:
            out[row].append(b"".join(map(self.young.__getitem__, some)))
        for piece in long:
            del self.young[piece]

    def text(self, ids: list[int]) -> str:
        """The text of ids; bytes that no text can hold become U+FFFD, unknown ids give nothing."""
        tokens, last = self.tokens, len(self.tokens)
        return b"".join([tokens[i] for i in ids if 0 <= i < last]).decode("utf-8", "replace")


_mergers: dict[int, Merger] = {}


def _merger(rules: dict, pattern: str) -> Merger:
    """One merger per Python worker, whose known pieces serve later tasks too."""
    key = hash((pattern, tuple(rules["pairs"]), tuple(rules["tokens"])))
    if key not in _mergers:
        _mergers.clear()
        _mergers[key] = Merger(rules, pattern)
    return _mergers[key]


def round_trip(spark: SparkSession, path: str, pattern: str):
    """A function from a text column to (ids, decoded), both made in one Python worker.

    A null text gives nulls, an empty one no ids. Texts of any length are encoded whole; a piece without a break costs its
    length times the logarithm. Equal texts give equal results; rows are taken one by one, so that extra columns
    and repeated ids do not matter. The rules are read on the driver and broadcast; their size is fixed.
    """
    with open(path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(read_rules(file.read()))

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(texts: pa.Array) -> pa.Array:
        given_back()
        merger = _merger(shared.value, pattern)
        packed = merger.encode(texts.to_pylist())
        offsets = np.zeros(len(packed) + 1, dtype=np.int32)
        np.cumsum([len(p or b"") // 4 for p in packed], out=offsets[1:])
        decoded = pa.array([None if p is None else merger.text(np.frombuffer(p, dtype=np.int32).tolist()) for p in packed], type=pa.string())
        mask = pc.is_null(texts)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(p for p in packed if p), dtype=np.int32)), mask=mask)
        return pa.StructArray.from_arrays([ids, decoded], names=["ids", "decoded"])

    return both
