"""Language identification with a linear-chain conditional random field over words.

States are the languages of the training rows. A word's score for a language is the sum of learned weights of its
features: its affixes (byte n-grams at either end), its inner byte n-grams, the word itself, and its entry in a lexicon of
word frequencies by language. Transitions between the languages of neighbouring words are learned with them, so words of
code-switched text get labels of their own. Forward-backward gives each word's posterior; the language of a text is the
one with the largest sum over its words.

The lexicon counts all training rows. The weights are fitted on a bounded sample of them (``SAMPLE_ROWS`` rows of each
language of at most ``SAMPLE_CHARS`` characters, whole texts), cut into pieces and dealt together to code-switched chains.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from vitrine.llm import words as W
from vitrine.llm.arrow import add_columns

CHAIN = 64               # words of a chain; longer texts are consecutive chains
PIECE = 16               # words of one training text that stand together in a chain
TABLE_BITS = 17          # weights of hashed features
LEXICON_BITS = 16
SAMPLE_ROWS, SAMPLE_CHARS = 120, 20_000
ROUNDS, RATE, DECAY = 25, 0.3, 1e-6
NONE = "und"
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray      # 2^TABLE_BITS x languages
    lexicon: np.ndarray      # 2^LEXICON_BITS x languages, log frequencies less their mean
    lexicon_weight: float
    start: np.ndarray        # scores of a chain's first language
    move: np.ndarray         # scores of neighbouring languages, from x to


@dataclass
class Distinct:
    """Features of the distinct words of a chunk."""

    feature: np.ndarray   # hashed features, word after word
    begin: np.ndarray     # first feature of each word
    entry: np.ndarray     # lexicon entry of each word


def features(data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> Distinct:
    """Byte n-grams of two to four of each word between boundary marks, and the word itself."""
    size = end - start + 2
    begin = np.cumsum(size) - size
    inside = np.arange(size.sum()) - np.repeat(begin, size)
    source = np.clip(np.repeat(start, size) + inside - 1, 0, max(0, len(data) - 1))
    framed = data[source].astype(np.uint64) + np.uint64(1)
    framed[begin] = 257
    framed[begin + size - 1] = 258
    left = np.repeat(size, size) - inside
    found, word = [hashes], [np.arange(len(start))]
    owner = np.repeat(np.arange(len(start)), size)
    for n in (2, 3, 4):
        whole = np.flatnonzero(left[:len(framed) - n + 1] >= n)
        found.append(W.grams(framed, n, seed=67)[whole])
        word.append(owner[whole])
    found, word = np.concatenate(found), np.concatenate(word)
    order = np.argsort(word, kind="stable")
    return Distinct((found[order] >> np.uint64(64 - TABLE_BITS)).astype(np.int64),
                    np.searchsorted(word[order], np.arange(len(start))),
                    (hashes >> np.uint64(64 - LEXICON_BITS)).astype(np.int64))


def emissions(model: Model, of: Distinct) -> np.ndarray:
    """Scores of distinct words, words x languages."""
    if not len(of.begin):
        return np.zeros((0, len(model.languages)))
    sums = np.add.reduceat(model.weights[of.feature], of.begin, axis=0)
    return sums + model.lexicon_weight * model.lexicon[of.entry]


def distinct_words(words: W.Words) -> tuple[Distinct, np.ndarray]:
    hashes, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
    return features(words.data, words.start[first], words.end[first], hashes), which


def forward_backward(score: np.ndarray, length: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors of chains: (step, chain, language), expected moves and summed log-likelihood parts (log Z).

    ``score`` is (step, chain, language); steps behind a chain's ``length`` are ignored.
    """
    steps, chains, k = score.shape
    top = score.max(axis=2, keepdims=True)
    likely = np.exp(score - top)
    move, first = np.exp(model.move), np.exp(model.start)
    forward, scale = np.zeros_like(likely), np.ones((steps, chains))
    for t in range(steps):
        now = (first[None, :] if t == 0 else forward[t - 1] @ move) * likely[t]
        scale[t] = now.sum(axis=1)
        forward[t] = now / scale[t][:, None]
    backward = np.ones_like(likely)
    moves = np.zeros((k, k))
    for t in range(steps - 2, -1, -1):
        live = (t + 1 < length)[:, None]
        ahead = likely[t + 1] * backward[t + 1] / scale[t + 1][:, None]
        backward[t] = np.where(live, ahead @ move.T, 1.0)
        moves += ((forward[t] * live).T @ ahead) * move
    inside = np.arange(steps)[:, None] < length[None, :]
    log_z = float(((np.log(scale) + top[:, :, 0]) * inside).sum())
    return forward * backward * inside[:, :, None], moves, np.array(log_z)


def chains_of(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """Word index at (step, chain) and the length of each chain; rows are cut into chains of at most ``CHAIN`` words."""
    counts = words.counts()
    per_row = -(-counts // CHAIN)
    row = np.repeat(np.arange(words.rows), per_row)
    number = np.arange(per_row.sum()) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    begin = words.first[row] + number * CHAIN
    length = np.minimum(CHAIN, words.first[row + 1] - begin)
    steps = int(length.max()) if len(length) else 0
    at = begin[None, :] + np.arange(steps)[:, None]
    return np.minimum(at, max(0, len(words.row) - 1)), length


def label(model: Model, words: W.Words) -> np.ndarray:
    """Posterior of each language for each word."""
    out = np.zeros((len(words.row), len(model.languages)))
    if len(words.row):
        of, which = distinct_words(words)
        at, length = chains_of(words)
        posterior, _, _ = forward_backward(emissions(model, of)[which[at]], length, model)
        inside = np.arange(at.shape[0])[:, None] < length[None, :]
        out[at[inside]] = posterior[inside]
    return out


def fit(texts: list[str], labels: list[int], languages: list[str], lexicon: np.ndarray) -> Model:
    """Weights by adaptive gradient ascent on the likelihood of code-switched chains dealt from ``texts``."""
    k = len(languages)
    model = Model(languages, np.zeros((1 << TABLE_BITS, k)), lexicon, 1.0, np.zeros(k), np.zeros((k, k)))
    words = W.split(pa.array(texts, pa.string()), W.SPACED)
    if not len(words.row):
        return model
    of, which = distinct_words(words)
    # Pieces of different texts follow each other in a fixed shuffled order; chains run across them.
    piece = words.place() // PIECE
    name = W.mix(words.row.astype(np.uint64) * np.uint64(1_000_003) + piece.astype(np.uint64) + np.uint64(73))
    order = np.lexsort((np.arange(len(piece)), name))
    chains = len(order) // CHAIN
    rest = order[chains * CHAIN:]
    order = np.concatenate([order, np.resize(rest, CHAIN - len(rest))]) if len(rest) else order
    at = order.reshape(-1, CHAIN).T
    length = np.full(at.shape[1], CHAIN)
    if len(rest):
        length[-1] = len(rest)
    truth = np.asarray(labels)[words.row[at]]
    inside = np.arange(CHAIN)[:, None] < length[None, :]
    wanted = np.zeros((*at.shape, k))
    np.put_along_axis(wanted, truth[:, :, None], 1.0, axis=2)
    wanted *= inside[:, :, None]
    pairs = inside[1:]
    seen_moves = np.zeros((k, k))
    np.add.at(seen_moves, (truth[:-1][pairs], truth[1:][pairs]), 1)
    owner = np.repeat(np.arange(len(of.begin)), np.diff(np.append(of.begin, len(of.feature))))
    squares = [np.full_like(model.weights, 1e-8), 1e-8, np.full(k, 1e-8), np.full((k, k), 1e-8)]
    for _ in range(ROUNDS):
        posterior, moves, _ = forward_backward(emissions(model, of)[which[at]], length, model)
        error = wanted - posterior
        by_word = np.stack([np.bincount(which[at].ravel(), error[:, :, i].ravel(), len(of.begin)) for i in range(k)], axis=1)
        by_feature = np.stack([np.bincount(of.feature, by_word[owner, i], 1 << TABLE_BITS) for i in range(k)], axis=1)
        by_feature -= DECAY * len(order) * model.weights
        gradients = [by_feature, float((by_word * lexicon[of.entry]).sum()), error[0].sum(axis=0), seen_moves - moves]
        steps = []
        for i, g in enumerate(gradients):
            squares[i] = squares[i] + np.square(g)
            steps.append(RATE * g / np.sqrt(squares[i]))
        model.weights += steps[0]
        model.lexicon_weight += float(steps[1])
        model.start += steps[2]
        model.move += steps[3]
    return model


def count_lexicon(training: DataFrame, languages: list[str]) -> np.ndarray:
    """Words of all training rows by language, in hashed entries, as log frequencies less their mean."""
    k = len(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((1 << LEXICON_BITS, k), np.int64)
        for batch in batches:
            index = pc.index_in(batch.column("lang"), pa.array(languages)).to_numpy(zero_copy_only=False)
            for a, b in W.chunks(batch.column("text")):
                words = W.split(batch.column("text").slice(a, b - a), W.SPACED)
                entry = (words.hash >> np.uint64(64 - LEXICON_BITS)).astype(np.int64) * k + index[a:b][words.row].astype(np.int64)
                counts += np.bincount(entry, minlength=counts.size).reshape(counts.shape)
        used = np.flatnonzero(counts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(counts[used, i]) for i in range(k))],
                                         ["entry", *(f"n{i}" for i in range(k))])

    schema = ", ".join(["entry long", *(f"n{i} long" for i in range(k))])
    sums = training.select("text", "lang").mapInArrow(run, schema).groupBy("entry") \
        .agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(k)]).toPandas()  # at most 2^LEXICON_BITS rows
    counts = np.zeros((1 << LEXICON_BITS, k))
    counts[sums["entry"].to_numpy()] = sums[[f"n{i}" for i in range(k)]].to_numpy()
    logs = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * len(counts)))
    return logs - logs.mean(axis=1, keepdims=True)


def train(training: DataFrame) -> Model | None:
    """The model of ``training`` (text, lang); None where no row has a text and a language."""
    usable = training.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    languages = [r["lang"] for r in usable.select("lang").distinct().orderBy("lang").collect()]
    if not languages:
        return None
    order = Window.partitionBy("lang").orderBy("_order", "text")
    sample = usable.where((F.length("text") <= SAMPLE_CHARS) & (F.length("text") > 0)) \
        .withColumn("_order", F.xxhash64("text")).withColumn("_rank", F.row_number().over(order)) \
        .where(F.col("_rank") <= SAMPLE_ROWS).orderBy("lang", "_rank").toPandas()
    place = {x: i for i, x in enumerate(languages)}
    return fit(sample["text"].tolist(), [place[x] for x in sample["lang"]], languages, count_lexicon(usable, languages))


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode())


def _predict(shared):
    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        model = Model(**shared.value) if shared.value else None
        words = W.split(part.column("text"), W.SPACED)
        letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[words.data])])
        high = np.concatenate([[0], np.cumsum(words.data >= 0x80)])
        offsets = W.text_bytes(part.column("text"))[1]
        known = np.diff(letters[offsets]) > 0
        for row in np.flatnonzero(~known & (np.diff(high[offsets]) > 0)):
            known[row] = _has_letter(words.data[offsets[row]:offsets[row + 1]].tobytes())
        spoken = (letters[words.end] > letters[words.start]) | (high[words.end] > high[words.start])
        posterior = label(model, words) * spoken[:, None] if model else np.zeros((len(words.row), 0))
        sums = np.stack([np.bincount(words.row, posterior[:, i], words.rows) for i in range(posterior.shape[1])], axis=1) \
            if posterior.shape[1] else np.zeros((words.rows, 0))
        known &= sums.any(axis=1)
        best = sums.argmax(axis=1) if sums.shape[1] else np.zeros(words.rows, int)
        total = sums.sum(axis=1)
        score = np.where(known, np.divide(sums.max(axis=1, initial=0), total, out=np.zeros(len(total)), where=total > 0), 0.0)
        return {"lang_pred": pa.array([model.languages[b] if ok else NONE for b, ok in zip(best, known, strict=True)], pa.string()),
                "score": pa.array(np.clip(score, 0, 1))}
    return compute


def identify(docs: DataFrame, is_training: Column) -> DataFrame:
    """``docs`` (text, lang, ...) with ``lang_pred`` and ``score``, the share of the text's words in that language.

    The model learns from the text and the language of rows where ``is_training`` holds and neither is null. Null texts
    and texts without a letter are ``und`` with score 0, as are all texts when nothing can be learned. Equal sums go to
    the language that sorts first. Columns of ``docs`` with the added names are replaced.
    """
    model = train(docs.where(is_training))
    return add_columns(docs, "lang_pred string, score double", 
                       _predict(docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)))


def keep_identified(docs: DataFrame, is_training: Column, least: float = 0.5) -> DataFrame:
    """The documents with a language that at least the share ``least`` of their words is in; columns unchanged."""
    packed = docs.select("text", "lang", F.struct(*[docs[c] for c in docs.columns]).alias("_row"), is_training.alias("_known"))
    found = identify(packed, F.col("_known"))
    return found.where((F.col("lang_pred") != NONE) & (F.col("score") >= least)).select("_row.*")


def word_labels(texts: list[str], model: Model) -> list[list[str]]:
    """The likeliest language of each word of some texts."""
    words = W.split(pa.array(texts, pa.string()), W.SPACED)
    best = label(model, words).argmax(axis=1)
    return [[model.languages[i] for i in best[a:b]] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
