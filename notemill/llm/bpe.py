"""Byte-level BPE as a lazily determinised transducer, and decoding through a UTF-8 state machine.

The merges are never replayed on a text. Of every prefix of a piece the encoding ends in one known
token, and what stands before that token is the encoding of a shorter prefix. The transducer reads a
piece byte by byte. Its state is the longest end of the bytes read that is a path of the vocabulary's
trie; each state lists the tokens that end there. The last tokens of the prefixes from which a token may
still grow are its registers, at most as many as the longest token has bytes: of the listed tokens,
the one that may stand behind its register is the next register. What all registers lead back to is
certain and is emitted. States and moves are made when first met. Whether two tokens stay apart is seen by undoing
their merges from the last to the first; these answers and the pieces seen are kept in two generations, of which
the older is forgotten, which changes no result. Pieces are met in blocks of texts, each new one once.
"""

import base64
import itertools
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from notemill.llm.blocks import given_back

PIECES, PAIRS, MOVES = 200_000, 300_000, 200_000
CERTAIN_EVERY = 4096
#: Characters of a text from which its pieces are taken in parts, and pieces that are met together.
LONG_TEXT, BLOCK = 1 << 20, 1 << 16
LONGEST_KEPT = 64


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id, from a file of base64 tokens and ranks."""
    found = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                found[int(rank)] = base64.b64decode(token)
    return [found.get(i, b"") for i in range(max(found) + 1)]


class Transducer:
    """Encodes the pieces of one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.ids = {token: i for i, token in enumerate(tokens) if token}
        self.split = regex.compile(pattern)
        self.child: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        for token, i in self.ids.items():
            node = 0
            for byte in token:
                node = self.child.setdefault(node << 8 | byte, len(self.child) + 1)
            self.token_at[node] = i
        self.known: dict[str, bytes] = {}
        self.once_known: dict[str, bytes] = {}
        self.stays: dict[int, bool] = {}
        self.once_stays: dict[int, bool] = {}
        self.made: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.moves: dict[int, tuple[int, int, tuple[tuple[int, int], ...]]] = {}
        self.paths: dict[int, bytes] = {0: b""}

    def merged(self, piece: bytes, least: int = 1) -> list[int]:
        """The merges as defined: the adjacent pair of least rank first, until ``least`` parts are left. For one token only."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        ranks = [self.ids.get(a + b, 1 << 62) for a, b in zip(parts, parts[1:])]
        while len(ranks) >= least:
            best = min(ranks)
            if best == 1 << 62:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = self.ids.get(parts[at - 1] + parts[at], 1 << 62)
            if at < len(ranks):
                ranks[at] = self.ids.get(parts[at] + parts[at + 1], 1 << 62)
        return [self.ids[p] for p in parts]

    def half(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; None for a single byte."""
        if token not in self.halves:
            data = self.tokens[token]
            self.halves[token] = tuple(self.merged(data, 2)) if len(data) > 1 else None
        return self.halves[token]

    def stay(self, left: int, right: int) -> bool:
        """Whether no merge ever takes place across the border of two tokens.

        Backwards in time: of the tokens at the border the one made last is undone (of equal ones the right, as merges of
        one rank go from left to right). In between stands a pair that would have merged if its rank came before the
        merge just undone; left of that merge, an equal rank comes before it too.
        """
        limit, ids, tokens = 1 << 62, self.ids, self.tokens
        while True:
            rank = ids.get(tokens[left] + tokens[right])
            if rank is not None and rank < limit:
                return False
            of_left, of_right = self.half(left), self.half(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and left > right):
                limit, left = left, of_left[1]
            else:
                limit, right = right + 1, of_right[0]

    def apart(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens stay as they are."""
        key = left << 32 | right
        found = self.once_stays.get(key)
        if found is None:
            found = self.stay(left, right)
        if len(self.stays) >= PAIRS:
            self.once_stays, self.stays = self.stays, {}
        self.stays[key] = found
        return found

    def move(self, state: int, byte: int) -> tuple[int, int, tuple[tuple[int, int], ...]]:
        """The next state, its depth, and the tokens that end there with their lengths, longest first.

        Tokens that the merges never make are left out. Made once per state and byte.
        """
        path = self.paths[state] + bytes([byte])
        following, depth, ends = 0, 0, []
        for start in range(len(path)):
            node = 0
            for step in path[start:]:
                node = self.child.get(node << 8 | step, -1)
                if node < 0:
                    break
            if node < 0:
                continue
            if not depth:
                following, depth = node, len(path) - start
                self.paths[node] = path[start:]
            token = self.token_at.get(node)
            if token is not None and self.is_made(token):
                ends.append((token, len(path) - start))
        found = self.moves[state << 8 | byte] = (following, depth, tuple(ends))
        return found

    def is_made(self, token: int) -> bool:
        """Whether the merges make a token out of its bytes."""
        found = self.made.get(token)
        if found is None:
            found = self.made[token] = self.merged(self.tokens[token]) == [token]
        return found

    def certain(self, registers: list[tuple[int, int]], depth: int) -> int:
        """The last place that the encodings of all live prefixes share."""
        place = len(registers) - 1
        shared = {place}
        while place:
            place -= registers[place][1]
            shared.add(place)
        least = len(registers) - 1
        for start in range(len(registers) - 1 - depth, len(registers) - 1):
            while start not in shared:
                start -= registers[start][1]
            least = min(least, start)
        return least

    def piece_ids(self, piece: bytes) -> list[int]:
        """Ids of one piece. A piece that is itself a token is that token."""
        if piece in self.ids:
            return [self.ids[piece]]
        if len(self.moves) > MOVES:
            self.moves.clear()
            self.paths = {0: b""}
        out: list[int] = []
        moves, stays = self.moves, self.stays
        state, registers = 0, [(-1, 0)]
        for byte in piece:
            state, depth, ends = moves.get(state << 8 | byte) or self.move(state, byte)
            here = len(registers)
            for end in ends:
                before = registers[here - end[1]][0]
                if before < 0:
                    break
                apart = stays.get(before << 32 | end[0])
                if self.apart(before, end[0]) if apart is None else apart:
                    break
            registers.append(end)
            if here >= CERTAIN_EVERY and not here % CERTAIN_EVERY:
                cut = self.certain(registers, depth)
                if cut:
                    out += self.behind(registers[:cut + 1])
                    registers = [(registers[cut][0], 0), *registers[cut + 1:]]
        return out + self.behind(registers)

    def ids_together(self, pieces: list[bytes]) -> Iterator[list[int]]:
        """Ids of short pieces given in the order of their bytes: the states and registers of the beginning that a piece
        shares with the one before it are gone on from."""
        if len(self.moves) > MOVES:
            self.moves.clear()
            self.paths = {0: b""}
        known, moves, stays = self.ids, self.moves, self.stays
        before, states, registers = b"", [0], [(-1, 0)]
        for piece in pieces:
            if piece in known:
                yield [known[piece]]
                continue
            shared, most = 0, min(len(before), len(piece))
            while shared < most and before[shared] == piece[shared]:
                shared += 1
            del states[shared + 1:], registers[shared + 1:]
            state = states[shared]
            for byte in piece[shared:]:
                state, _, ends = moves.get(state << 8 | byte) or self.move(state, byte)
                here = len(registers)
                for end in ends:
                    left = registers[here - end[1]][0]
                    if left < 0:
                        break
                    apart = stays.get(left << 32 | end[0])
                    if self.apart(left, end[0]) if apart is None else apart:
                        break
                states.append(state)
                registers.append(end)
            before = piece
            yield self.behind(registers)

    @staticmethod
    def behind(registers: list[tuple[int, int]]) -> list[int]:
        """The tokens that lead to the last register."""
        place, out = len(registers) - 1, []
        while place:
            token, size = registers[place]
            out.append(token)
            place -= size
        return out[::-1]

    def learn(self, pieces: set[str]) -> list[str]:
        """Put the ids of these pieces among the known ones. The long pieces are returned, to be forgotten again."""
        if len(self.known) >= PIECES:
            self.once_known, self.known = self.known, {}
        unknown = pieces.difference(self.known)
        again = unknown & self.once_known.keys()
        self.known.update((p, self.once_known[p]) for p in again)
        unknown -= again
        long = [p for p in unknown if len(p) > LONGEST_KEPT]
        self.known.update((p, array("i", self.piece_ids(p.encode())).tobytes()) for p in long)
        short = sorted((p.encode(), p) for p in unknown.difference(long))
        for (_, piece), ids in zip(short, self.ids_together([data for data, _ in short])):
            self.known[piece] = array("i", ids).tobytes()
        return long

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text in order, in lists of bounded size."""
        if len(text) < LONG_TEXT:
            yield self.split.findall(text)
        else:
            found = (match.group() for match in self.split.finditer(text))
            while some := list(itertools.islice(found, BLOCK)):
                yield some

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of every text as packed 32-bit integers; None for None."""
        out: list[list[bytes] | None] = [None if t is None else [] for t in texts]
        held, size = [], 0
        for row, text in enumerate(texts):
            for some in self.pieces(text) if text else ():
                held.append((row, some))
                size += len(some)
                if size >= BLOCK:
                    self.settle(held, out)
                    held, size = [], 0
        self.settle(held, out)
        return [None if parts is None else b"".join(parts) for parts in out]

    def settle(self, held: list[tuple[int, list[str]]], out: list) -> None:
        long = self.learn(set(itertools.chain.from_iterable(some for _, some in held)))
        for row, some in held:
            out[row].append(b"".join(map(self.known.__getitem__, some)))
        for piece in long:
            del self.known[piece]

    def text_ids(self, text: str) -> bytes:
        """Ids of one text as packed 32-bit integers."""
        return self.encode([text])[0]


class Utf8Stream:
    """Text out of byte chunks: a state is the unfinished character's bytes, a move reads one token.

    Bytes that no text can hold become U+FFFD.
    """

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.moves: dict[tuple[bytes, int], tuple[str, bytes]] = {}
        #: The move from the start state where it ends there again, else None.
        self.whole = [None if self.unfinished(t) else self.move(b"", i)[0] for i, t in enumerate(tokens)]
        self.moves.clear()

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end begin a character that is not complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC2:
                needed = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF5 else 0
                if needed <= back:
                    return 0
                second = data[-back + 1] if back > 1 else None
                low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
                return back if second is None or low <= second <= high else 0
            if byte < 0x80:
                return 0
        return 0

    def move(self, state: bytes, token: int) -> tuple[str, bytes]:
        data = state + (self.tokens[token] if 0 <= token < len(self.tokens) else b"")
        left = self.unfinished(data)
        cut = len(data) - left
        found = (data[:cut].decode("utf-8", "replace"), data[cut:])
        if len(self.moves) >= PIECES:
            self.moves.clear()
        self.moves[state, token] = found
        return found

    def text(self, ids: list[int]) -> str:
        try:
            if min(ids, default=0) >= 0:
                return "".join([self.whole[i] for i in ids])
        except (TypeError, IndexError):
            pass
        return self.stepwise(ids)

    def stepwise(self, ids: list[int]) -> str:
        state, out, moves = b"", [], self.moves
        for token in ids:
            part, state = moves.get((state, token)) or self.move(state, token)
            out.append(part)
        if state:
            out.append(state.decode("utf-8", "replace"))
        return "".join(out)


_machines: dict[tuple, object] = {}


def _machine(kind, *parts):
    """One machine per Python worker: what it has learnt serves the worker's later tasks too."""
    key = (kind.__name__, *[hash(tuple(p)) if isinstance(p, list) else p for p in parts])
    if key not in _machines:
        _machines.clear() if len(_machines) > 4 else None
        _machines[key] = kind(*parts)
    return _machines[key]


def _encoded(machine: Transducer, texts: pa.Array) -> pa.Array:
    given_back()
    packed = machine.encode(texts.to_pylist())
    offsets = np.zeros(len(packed) + 1, dtype=np.int32)
    np.cumsum([len(p or b"") // 4 for p in packed], out=offsets[1:])
    values = pa.array(np.frombuffer(b"".join(p for p in packed if p), dtype=np.int32))
    mask = pa.array([p is None for p in packed], type=pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)


def _decoded(machine: Utf8Stream, ids: pa.Array) -> pa.Array:
    flat, ends = pc.fill_null(ids.flatten(), -1).to_numpy(), np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())
    rows = (flat[a:b].tolist() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()))
    return pa.array([machine.text(row) if valid else None for row, valid in zip(rows, ids.is_valid().to_pylist())], type=pa.string())


def encoder(spark: SparkSession, path: str, pattern: str):
    """A function from a text column to its ids (array of int). A null text gives null ids, an empty one no ids.

    The vocabulary file is read on the driver and broadcast; a vocabulary has a fixed size.
    """
    shared = spark.sparkContext.broadcast(read_ranks(path))

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        return _encoded(_machine(Transducer, shared.value, pattern), texts)

    return ids


def decoder(spark: SparkSession, path: str):
    """A function from an array of ids to their text. Null stays null; unknown ids give nothing."""
    shared = spark.sparkContext.broadcast(read_ranks(path))

    @F.arrow_udf("string")
    def text(ids: pa.Array) -> pa.Array:
        return _decoded(_machine(Utf8Stream, shared.value), ids)

    return text


def round_trip(spark: SparkSession, path: str, pattern: str):
    """A function from a text column to (ids, decoded): the encoder and the decoder one after the other in the same
    Python worker, so that a task needs one worker and one copy of the vocabulary. A null text gives nulls."""
    shared = spark.sparkContext.broadcast(read_ranks(path))

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(texts: pa.Array) -> pa.Array:
        ids = _encoded(_machine(Transducer, shared.value, pattern), texts)
        return pa.StructArray.from_arrays([ids, _decoded(_machine(Utf8Stream, shared.value), ids)], names=["ids", "decoded"])

    return both


def id_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids, one space between them."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)
