"""Small helpers that run inside tasks: bounded pieces of Arrow batches, words and their hashes."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from notemill.session import bounded_batches  # noqa: F401

PIECE_BYTES = 1 << 18


def given_back() -> None:
    """Return memory of past batches to the system; workers live on and would keep it beside the next stage's."""
    pa.default_memory_pool().release_unused()


#: The white space that ends a word is space and code points 9 to 13.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~_SPACE

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

#: Letters and digits of ASCII, and every byte of any other character.
ALNUM = np.zeros(256, dtype=bool)
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    ALNUM[ord(_a):ord(_b) + 1] = True
ALNUM[128:] = True

_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES, rows: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts take ``limit`` bytes at most; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (held + size > limit or i - start >= rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)
    given_back()


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins and ends in them. Null counts as empty."""
    values = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[values.offset:values.offset + len(values) + 1]
    if not len(values):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return (_LOWER[raw] if lower else raw), offsets - offsets[0]


def word_spans(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each text's first word (one entry more than texts)."""
    inside = is_word[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(raw), dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(raw), dtype=bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that any of their bits can be used."""
    values = (values ^ (values >> np.uint64(32))) * _PRIME
    values = (values ^ (values >> np.uint64(29))) * _STEP
    return values ^ (values >> np.uint64(32))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word's bytes."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    shift = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(shift, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _STEP, dtype=np.uint64))
    terms = _BYTE_VALUES[raw[place + np.repeat(starts, lengths)]] * powers[place]
    return mixed(np.add.reduceat(terms, shift) + lengths.astype(np.uint64))


def window_hashes(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """A hash of every run of ``width`` values; runs may cross texts, the caller drops those."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = np.uint64((0xA0761D6478BD642F * (2 * seed + 1) | 1) & (2**64 - 1))
    values = mixed(hashes + np.uint64(seed))
    done, length, power, total, total_length = values, 1, base, None, 0
    rest = width
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:
                if total is None:
                    total = done
                else:
                    total = total[:len(total) - length] * power + done[total_length:total_length + len(total) - length]
                total_length += length
            rest >>= 1
            if rest:
                done = done[:len(done) - length] * power + done[length:]
                power = power * power
                length *= 2
    return mixed(total[:count])


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column out of flat values and the length of each row's list."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))
