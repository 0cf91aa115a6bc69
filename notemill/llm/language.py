"""Language of a text as a mixture: which languages it holds, and in what proportions.

Learning counts byte trigrams of letters per language over all given texts. A new text's proportions are
those that make its trigrams likeliest (expectation-maximisation). The set of languages grows by the next
strongest one as long as the likelihood gains more than the penalty of one more language.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemill.llm.blocks import ALNUM, PIECE_BYTES

GRAMS = 1 << 14
MAX_LANGUAGES = 1000
SMOOTHING = 0.1
STEPS, SET_STEPS = 12, 6
#: What one more language must gain, times the logarithm of the number of trigrams (which overlap).
PENALTY = 5.0
UNKNOWN = "und"

_KEEP = np.where(ALNUM, np.arange(256), 0x20).astype(np.uint8)
_KEEP[ord("0"):ord("9") + 1] = 0x20


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    likelihood: np.ndarray      # trigram by language


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of all texts, and the index of the text of each. Case and anything but letters are ignored."""
    coded = [b"  " + (t or "").lower().encode("utf-8", "replace") + b"  " for t in texts]
    lengths = np.array([len(c) for c in coded])
    raw = _KEEP[np.frombuffer(b"".join(coded), dtype=np.uint8)].astype(np.uint32)
    codes = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    blank = raw == 0x20
    kept = ~(blank[1:-1] & (blank[:-2] | blank[2:]))
    owner = np.repeat(np.arange(len(texts)), lengths)[:-2][kept]
    hashed = (codes[kept] * np.uint32(2654435761)) >> np.uint32(32 - GRAMS.bit_length() + 1)
    return hashed.astype(np.int64), owner


def groups(values: list[str | None], most: int = 64):
    """Index ranges of at most ``most`` texts that stay below a piece's bytes, unless one text is longer."""
    start, held = 0, 0
    for i, value in enumerate(values):
        size = len(value or "")
        if i > start and (i - start >= most or held + size > PIECE_BYTES):
            yield start, i
            start, held = i, 0
        held += size
    if start < len(values):
        yield start, len(values)


def _count(batches):
    """Trigram counts per language of one task; handed on early when there are many languages."""
    counts: dict[str, np.ndarray] = {}

    def rows():
        for lang, found in counts.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(found[at], pa.int64())], ["lang", "gram", "n"])

    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for start, end in groups(texts):
            hashed, owner = trigrams(texts[start:end])
            names = sorted(set(langs[start:end]))
            index = np.array([names.index(v) for v in langs[start:end]])
            found = np.bincount(index[owner] * GRAMS + hashed, minlength=len(names) * GRAMS).reshape(len(names), GRAMS)
            for name, row in zip(names, found):
                counts[name] = counts[name] + row if name in counts else row
            if len(counts) > 256:
                yield from rows()
                counts.clear()
    yield from rows()


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Trigram likelihoods of every language, over all rows with a text and a language.

    The model has at most ``MAX_LANGUAGES`` * ``GRAMS`` numbers; more languages are an error. No rows: no language.
    """
    known = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).dropna()
    counts = known.mapInArrow(_count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    per_lang = counts.groupBy("lang").agg(F.collect_list(F.struct("gram", "n")).alias("grams"))
    found = per_lang.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    found.sort(key=lambda r: r["lang"])
    table = np.full((GRAMS, len(found)), SMOOTHING)
    for i, row in enumerate(found):
        for gram, n in row["grams"]:
            table[gram, i] += n
    return Model(tuple(r["lang"] for r in found), table / table.sum(axis=0, keepdims=True))


def _steps(shares, p, owner, starts, counts, totals, steps):
    for _ in range(steps):
        weighted = p * shares[owner]
        weighted *= (counts / weighted.sum(axis=1))[:, None]
        shares = np.add.reduceat(weighted, starts, axis=0) / totals[:, None]
    return shares


def mixtures(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Shares of every language per text, zero outside the chosen set, and the mean log-likelihood ratio of a
    trigram against even chance. Texts without trigrams have all zeros."""
    width = len(model.languages)
    shares, fit = np.zeros((len(texts), width)), np.zeros(len(texts))
    if not width:
        return shares, fit
    hashed, owner = trigrams(texts)
    cells = np.bincount(owner * GRAMS + hashed, minlength=len(texts) * GRAMS)
    at = np.flatnonzero(cells)
    if not len(at):
        return shares, fit
    owner, p, counts = at // GRAMS, model.likelihood[at % GRAMS], cells[at].astype(float)
    rows, starts = np.unique(owner, return_index=True)
    owner = np.searchsorted(rows, owner)
    totals = np.add.reduceat(counts, starts)
    full = _steps(np.full((len(rows), width), 1.0 / width), p, owner, starts, counts, totals, STEPS)
    order = np.argsort(-full, axis=1, kind="stable")
    rank = np.argsort(order, axis=1, kind="stable")
    best = (rank < 1).astype(float)
    likely = np.add.reduceat(counts * np.log((p * best[owner]).sum(axis=1)), starts)
    active = np.arange(len(rows))
    for size in range(2, width + 1):
        inside = np.isin(owner, active)
        sub_owner, sub_p, sub_counts = np.searchsorted(active, owner[inside]), p[inside], counts[inside]
        sub_starts = np.searchsorted(sub_owner, np.arange(len(active)))
        first = full[active] * (rank[active] < size) + 1e-9 * (rank[active] < size)
        first /= first.sum(axis=1, keepdims=True)
        trial = _steps(first, sub_p, sub_owner, sub_starts, sub_counts, totals[active], SET_STEPS)
        value = np.add.reduceat(sub_counts * np.log((sub_p * trial[sub_owner]).sum(axis=1)), sub_starts)
        better = value - likely[active] > PENALTY * np.log(totals[active] + 1)
        best[active[better]], likely[active[better]] = trial[better], value[better]
        active = active[better]
        if not len(active):
            break
    shares[rows], fit[rows] = best, likely / totals + np.log(GRAMS)
    return shares, fit


RESULT = "lang string, score double, fit double, languages array<struct<lang string, share double>>"


def identifier(model: Model):
    """A function from a text column to (lang, score, fit, languages).

    ``lang`` is the language with the largest share (ties: the first by name), ``score`` its share, ``languages``
    the chosen set by falling share. Null texts and texts without a letter are ``und`` with score 0 and no
    languages; so is every text when nothing was learnt. ``fit`` above 0 means likelier than even chance.
    """
    @F.arrow_udf(RESULT)
    def identify(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        out = []
        for start, end in groups(values):
            part = values[start:end]
            shares, fit = mixtures(model, part)
            for text, row, gain in zip(part, shares, fit):
                chosen = [(model.languages[i], float(row[i])) for i in np.argsort(-row, kind="stable") if row[i] > 0]
                if not has_letter(text) or not model.languages:
                    out.append((UNKNOWN, 0.0, 0.0, []))
                else:
                    chosen = chosen or [(name, 1.0 / len(model.languages)) for name in model.languages]
                    out.append((chosen[0][0], min(1.0, chosen[0][1]), float(gain), chosen))
        sets = pa.array([[{"lang": a, "share": b} for a, b in o[3]] for o in out],
                        type=pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))
        return pa.StructArray.from_arrays(
            [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64()),
             pa.array([o[2] for o in out], pa.float64()), sets], ["lang", "score", "fit", "languages"])

    return identify


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether the key's CRC-32, as text, leaves that remainder. A null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))
