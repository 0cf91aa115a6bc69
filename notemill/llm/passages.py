"""Passages that repeat across documents, located by automata over words.

A passage is any run of ``WIDTH`` words. Confirming: of every run the least hash of its 8-word phrases is its
anchor, so that equal runs have equal anchors wherever they stand. Only anchors that stand in texts of different content
can belong to a repeated run; the runs behind those are hashed whole (128 bits) and counted, which tells the first document of each.
Locating: documents are dealt into shards with the passages confirmed for them, a shard's passages become one
Aho-Corasick automaton over its words, and every document of the shard is streamed through it; each occurrence that an earlier
document holds too is cut.
"""

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notemill.llm import filters
from notemill.llm.blocks import NOT_SPACE, list_column, mixed, pieces, text_bytes, window_hashes, word_hashes, word_spans
from notemill.session import materialise

WIDTH, PHRASE = 50, 8
SHARD_BYTES = 1 << 19


class Words:
    """Words of a piece of a batch: byte spans, hashes, and each text's first word."""

    def __init__(self, texts: pa.Array):
        self.raw, offsets = text_bytes(texts)
        self.starts, self.ends, self.first = word_spans(self.raw, offsets, NOT_SPACE)
        self.hashes = word_hashes(self.raw, self.starts, self.ends)
        self.counts = np.diff(self.first)

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of all runs of ``width`` words within one text, and the text of each."""
        many = np.maximum(self.counts - width + 1, 0)
        owner = np.repeat(np.arange(len(many)), many)
        place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + self.first[:-1][owner]
        return place, owner

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and texts of all runs of ``WIDTH`` words, and the anchor of each."""
        place, owner = self.runs(WIDTH)
        if not len(place):
            return place, owner, np.zeros(0, np.uint64)
        least = window_hashes(self.hashes, PHRASE, seed=3)
        span, width = WIDTH - PHRASE + 1, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
        return place, owner, least[place]


    def content(self, seed: int) -> np.ndarray:
        """A hash of each text's whole word sequence."""
        place = np.arange(len(self.hashes)) - np.repeat(self.first[:-1], self.counts)
        terms = mixed(self.hashes + mixed(place.astype(np.uint64) + np.uint64(seed)))
        sums = np.zeros(len(terms) + 1, dtype=np.uint64)
        np.cumsum(terms, out=sums[1:])
        return mixed(sums[self.first[1:]] - sums[self.first[:-1]]).view(np.int64)


_INFO = "doc_id long, n_words long, c1 long, c2 long, anchors array<long>"


def _info(batches):
    for batch in batches:
        for piece in pieces(batch, "text"):
            words = Words(piece.column("text"))
            _, owner, anchor = words.anchors()
            changed = np.ones(len(anchor), dtype=bool)
            changed[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            many = np.bincount(owner[changed], minlength=len(words.counts))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(words.counts), pa.array(words.content(1)), pa.array(words.content(2)),
                 list_column(anchor[changed].view(np.int64), many, pa.int64())], ["doc_id", "n_words", "c1", "c2", "anchors"])


_RUNS = "h1 long, h2 long, doc_id long, c1 long, start int"


def _runs(repeated, reps):
    def read(batches):
        for batch in batches:
            for piece in pieces(batch.filter(pa.array(reps.value.holds(batch.column("_hash").to_numpy().view(np.uint64)))), "text"):
                words = Words(piece.column("text"))
                place, owner, anchor = words.anchors()
                held = np.flatnonzero(repeated.value.holds(anchor))
                if not len(held):
                    continue
                ids = piece.column("doc_id").to_numpy()
                one, two = (window_hashes(words.hashes, WIDTH, seed=s).view(np.int64) for s in (5, 9))
                at, of = place[held], owner[held]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[at]), pa.array(two[at]), pa.array(ids[of]), pa.array(words.content(1)[of]),
                     pa.array((at - words.first[:-1][of]).astype(np.int32))], ["h1", "h2", "doc_id", "c1", "start"])
    return read


def _stretches(starts: list[int]) -> list[tuple[int, int]]:
    """Word ranges that consecutive runs cover."""
    out = []
    for start in starts:
        if out and start <= out[-1][2] + 1:
            out[-1][1], out[-1][2] = start + WIDTH, start
        else:
            out.append([start, start + WIDTH, start])
    return [(a, b) for a, b, _ in out]


def _cut_shard(ids: list, texts: list[list[bytes]], starts: list[list[int]], firsts: list[list[int]]) -> list[list[bytes]]:
    """The kept words of a shard's documents. A passage's value is the last of its runs' first documents: whatever
    document comes later has all of its runs from an earlier one."""
    number: dict[bytes, int] = {}
    coded = [tuple(number.setdefault(w, len(number) + 1) for w in words) for words in texts]
    passages: dict[tuple[int, ...], int] = {}
    for words, places, first in zip(coded, starts, firsts):
        at = dict(zip(places, first))
        for a, b in _stretches(places):
            passage = words[a:b]
            latest = max(at[s] for s in range(a, b - WIDTH + 1))
            passages[passage] = min(latest, passages.get(passage, latest))
    if not passages:
        return texts
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for passage, first in passages.items():
        automaton.add_word(passage, (len(passage), first))
    automaton.make_automaton()
    out = []
    for doc_id, words, text in zip(ids, coded, texts):
        gone = np.zeros(len(words) + 1, dtype=np.int64)
        if len(words) >= WIDTH:
            for end, (size, first) in automaton.iter(words):
                if first < doc_id:
                    gone[end + 1 - size] += 1
                    gone[end + 1] -= 1
        keep = (np.cumsum(gone[:-1]) == 0).tolist()
        out.append([w for w, k in zip(text, keep) if k])
    return out


_KEPT = "doc_id long, n_words long, n_removed long, kept string"


def _kept(batches):
    for batch in batches:
        for piece in pieces(batch, "text", SHARD_BYTES):
            # bytes.split() without arguments splits at exactly the white space of ASCII
            texts = [(t or "").encode("utf-8", "replace").split() for t in piece.column("text").to_pylist()]
            ids, kept = piece.column("doc_id").to_pylist(), list(texts)
            if "spans" in piece.schema.names:
                content = Words(piece.column("text")).content(1).tolist()
                copies, spans = piece.column("copies").to_pylist(), piece.column("spans").to_pylist()
                mine = [sorted((s["start"], s["first"]) for s in row or [] if s["c1"] == c) for row, c in zip(spans, content)]
                shard = [i for i, c in enumerate(content) if c not in (copies[i] or ())]
                cut = _cut_shard([ids[i] for i in shard], [texts[i] for i in shard], [[s for s, _ in mine[i]] for i in shard],
                                 [[f for _, f in mine[i]] for i in shard])
                kept = [[]] * len(texts)
                for i, words in zip(shard, cut):
                    kept[i] = words
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([len(t) - len(k) for t, k in zip(texts, kept)], pa.int64()),
                 pa.array([b" ".join(k).decode("utf-8", "replace") for k in kept], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"])


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space, for every row of ``docs`` (doc_id, text).

    Every word is cut that is covered by a run of ``WIDTH`` words which also starts in a document with a smaller
    doc_id; all runs are judged on the input. Null texts have no words. Rows without a doc_id take no part and keep
    everything; rows that share a doc_id are one document and cut nothing of each other. A text equal to an earlier one
    word for word goes as a whole, and only the first of equal texts is compared with others.
    """
    spark = docs.sparkSession

    def shared(frame, column):
        return spark.sparkContext.broadcast(filters.hash_set(frame, column))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = texts.filter("doc_id is not null and text is not null")
    info = materialise(known.mapInArrow(_info, _INFO).filter(F.col("n_words") >= WIDTH), "info")
    contents = info.groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"))
    copies = (info.select("doc_id", "c1", "c2").join(contents, ["c1", "c2"]).filter("rep < doc_id")
              .groupBy("doc_id").agg(F.collect_set("c1").alias("copies")))
    repeated = (info.select("c1", F.explode("anchors").alias("anchor")).groupBy("anchor")
                .agg(F.min("c1").alias("_a"), F.max("c1").alias("_b")).filter("_a <> _b"))
    hashed = known.withColumn("_hash", filters.id_hash(F.col("doc_id")))
    reps = shared(contents.select(filters.id_hash(F.col("rep")).alias("h")), "h")
    runs = materialise(hashed.mapInArrow(_runs(shared(repeated, "anchor"), reps), _RUNS), "runs")
    firsts = runs.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("_last")).filter("first < _last")
    later = runs.join(firsts.drop("_last"), ["h1", "h2"]).filter(F.col("doc_id") > F.col("first"))
    spans = later.groupBy("doc_id").agg(F.collect_list(F.struct("start", "first", "c1")).alias("spans"))
    marks = materialise(spans.join(copies, "doc_id", "full"), "marks")

    touched = shared(marks.select(filters.id_hash(F.col("doc_id")).alias("h")), "h")

    flagged = texts.withColumn("_may", F.col("doc_id").isNotNull() & filters.may_hold(touched, filters.id_hash(F.col("doc_id"))))
    rest = flagged.filter("not _may").select("doc_id", "text").mapInArrow(_kept, _KEPT)
    changed = flagged.filter("_may").select("doc_id", "text").join(marks, "doc_id", "left").mapInArrow(_kept, _KEPT)
    return rest.unionByName(changed)
