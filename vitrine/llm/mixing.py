"""Mixing documents to target weights of domains whose membership is soft.

A classifier trained on a labelled table gives each document a probability for each domain. Nonnegative rates, one for
each document, are then fitted by projected gradient so that the expected tokens of each domain, the sum over documents of
rate x tokens x probability, meet the targets in the least squares.

A step moves every rate by the same function of the document's probabilities, so the rates after any number of steps
follow from the sequence of K-vectors of residuals, K being the number of domains. The distributed state is therefore the
table of tokens and probabilities; each step is one pass over it that replays the residuals so far and sums up K numbers.
The gradient of a rate is scaled by 1 / (tokens x sum of probability x tokens of the domain), the longest steps that surely
descend: a document of a small domain moves as fast as one of a large domain.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.llm import softmax, words as W
from vitrine.llm.arrow import add_columns, hand_back
from vitrine.llm.store import stored

TARGETS = {"high": 0.9, "low": 0.1, "toxic": 0.0}
TRAINING_ROWS = 20_000     # bound of the labelled rows that fit the classifier
FEATURES = 1 << 17
PENALTY = 1e-3
ITERATIONS = 50
CHUNK_BYTES = 1 << 18      # text whose code points a task holds at a time
BEGINNINGS = (3, 5)        # characters of a word's beginnings
STEPS = 60                 # passes over the table at most
TOLERANCE = 1e-4           # relative distance of domain totals from their targets
TOKENS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


def domain_of_labels() -> Column:
    """Domain of a row of the labels table (quality, toxic); null where neither tells."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")


def with_tokens(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``_words``: distinct tokens of the whole text, their beginnings, and marks.

    This is the definition of the classifier's features; ``hashed_features`` finds their hash buckets in Arrow batches.
    """
    text = F.coalesce("text", F.lit(""))
    listed = docs.withColumn("_words", F.regexp_extract_all(F.lower(text), F.lit(TOKENS), F.lit(0))) \
        .withColumns({"n_tokens": F.size("_words").cast("long"), "_distinct": F.array_distinct("_words")})
    capitals = F.when(2 * F.regexp_count(text, F.lit(r"\p{Lu}")) > F.length(text), "<capitals>")
    few = F.when(F.col("n_tokens") > 4 * F.size("_distinct"), "<few distinct>")

    def beginnings(n: int) -> Column:   # a second parameter of the lambda would be the word's place
        return F.transform("_distinct", lambda w: F.concat(F.lit(f"<{n}>"), F.left(w, F.lit(n))))

    return listed.withColumn("_words", F.concat(
        "_distinct", *map(beginnings, BEGINNINGS), F.array_compact(F.array(capitals, few)))).drop("_distinct")


@dataclass
class Features:
    """Features of some texts: ``row`` and ``bucket`` of each, once for every occurrence that counts; tokens of the texts."""

    row: np.ndarray
    bucket: np.ndarray
    n_tokens: np.ndarray


def _kinds() -> np.ndarray:
    """Kind of each code point: 0 ASCII white space, 1 letter or number, 2 capital letter, 3 other."""
    def kind(c: str) -> int:
        if c in " \t\n\x0b\f\r":
            return 0
        category = unicodedata.category(c)
        return 2 if category == "Lu" else 1 if category[0] in "LN" else 3

    return np.fromiter((kind(chr(i)) for i in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)


def hashed_features(column: pa.Array) -> Features:
    """What ``with_tokens`` lists, as hash buckets, for a chunk of texts."""
    kinds, rows = W.worker_cache("kinds", _kinds), len(column)
    given = pc.fill_null(column, "").cast(pa.large_string())
    capital = kinds[_code_points(given)] == 2
    sizes = pc.utf8_length(given).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(rows), sizes)
    shouting = 2 * np.bincount(owner[capital], minlength=rows) > sizes

    lower = pc.utf8_lower(given)
    code = _code_points(lower)
    ends = np.cumsum(pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64))
    kind = np.minimum(kinds[code], 3)
    kind[kind == 2] = 1
    change = np.ones(len(code), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[ends[:-1][ends[:-1] < len(code)]] = True
    start = np.flatnonzero(change)
    size = np.diff(np.append(start, len(code)))
    token = kind[start] > 0 if len(start) else np.zeros(0, bool)
    start, size = start[token], size[token]
    row = np.searchsorted(ends, start, side="right")
    n_tokens = np.bincount(row, minlength=rows)

    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    value = (code[np.repeat(start, size) + place].astype(np.uint64) + np.uint64(1)) * W.constants(int(size.max()) if len(size) else 0, 83)[place]
    cut = np.cumsum(size) - size
    whole = np.add.reduceat(value, cut) if len(cut) else np.zeros(0, np.uint64)
    order = np.argsort(W.mix(whole + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), kind="stable")
    fresh = np.ones(len(order), bool)
    fresh[1:] = (whole[order[1:]] != whole[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
    first = np.sort(order[fresh])
    found = [(row[first], W.mix(whole[first]))]
    for n in BEGINNINGS:
        sums = np.add.reduceat(np.where(place < n, value, np.uint64(0)), cut) if len(cut) else whole
        found.append((row[first], W.mix(sums[first] ^ W.constants(1, n)[0])))
    few = np.flatnonzero(n_tokens > 4 * np.bincount(row[first], minlength=rows))
    for mark, where in ((1, np.flatnonzero(shouting)), (2, few)):
        found.append((where, np.full(len(where), W.mix(np.array([mark << 40], np.uint64))[0])))
    bucket = np.concatenate([h for _, h in found]) % np.uint64(FEATURES)
    return Features(np.concatenate([r for r, _ in found]), bucket.astype(np.int64), n_tokens)


def _code_points(texts: pa.Array) -> np.ndarray:
    data, _ = W.text_bytes(texts)
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted buckets and their counts of each text with tokens."""
    for batch in batches:
        for a, b in W.chunks(batch.column("text"), CHUNK_BYTES):
            part = batch.slice(a, b - a)
            found = hashed_features(part.column("text"))
            pair, count = np.unique(found.row * FEATURES + found.bucket, return_counts=True)
            bounds = np.searchsorted(pair, np.arange(len(part) + 1) * FEATURES)
            lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, t))
                     for x, t in ((pair % FEATURES, pa.int32()), (count, pa.float64()))]
            yield pa.RecordBatch.from_arrays([*lists, part.column("domain")], ["bucket", "n", "domain"]) \
                .filter(pa.array(found.n_tokens > 0))
    hand_back()


def fit_classifier(training: DataFrame, domains: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets with weights, their weights (buckets x domains), and intercepts, from rows of ``_training_rows``.

    The gradient of a bucket's weights is at most its count over all rows, divided by the rows. Where that is below the
    penalty, weight 0 is the optimum whatever the other weights are; such buckets are left out before the fit. The rows
    are at most ``TRAINING_ROWS``, so one task fits them: 12 bytes for each distinct bucket of a text. Only the weights
    that are not zero reach the driver.
    """
    rows = training.count()
    kept = training.select(F.explode(F.arrays_zip("bucket", "n")).alias("x")).groupBy("x.bucket").agg(F.sum("x.n").alias("n")) \
        .where(F.col("n") >= PENALTY * rows).select("bucket").toArrow()   # at most FEATURES numbers
    used = np.sort(kept.column("bucket").to_numpy()).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(FEATURES, -1, np.int32)
        slot[used] = np.arange(len(used), dtype=np.int32)
        row, column, value, label, seen = [], [], [], [], 0
        for batch in batches:
            lists = batch.column("bucket")
            own = slot[lists.flatten().to_numpy()]
            at = np.repeat(np.arange(seen, seen + len(batch), dtype=np.int32), pc.list_value_length(lists).to_numpy())
            row.append(at[own >= 0])
            column.append(own[own >= 0])
            value.append(batch.column("n").flatten().to_numpy()[own >= 0].astype(np.uint32))   # counts
            label.append(pc.index_in(batch.column("domain"), pa.array(domains)).to_numpy())
            seen += len(batch)
        hand_back()
        row = np.concatenate(row)   # each list is gone before the next array is made
        column = np.concatenate(column)
        value = np.concatenate(value)
        counts = softmax.Sparse(row, column, value, seen, len(used))
        weights, intercepts = softmax.fit(counts, np.concatenate(label), len(domains), PENALTY, ITERATIONS)
        some = np.flatnonzero((weights != 0).any(axis=1))
        yield pa.RecordBatch.from_pydict({"bucket": pa.array([-1, *used[some]], pa.int32()),
                                          "weights": pa.array([intercepts.tolist(), *weights[some].tolist()])})

    fitted = training.coalesce(1).mapInArrow(run, "bucket int, weights array<double>").toArrow()
    weights = np.array(fitted.column("weights").to_pylist())
    return fitted.column("bucket").to_numpy()[1:].astype(np.int64), weights[1:].reshape(-1, len(domains)), weights[0]


def posteriors(found: Features, rows: int, buckets: np.ndarray, weights: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """Probability of each domain for each of ``rows`` texts."""
    slot = np.full(FEATURES, -1, np.int64)
    slot[buckets] = np.arange(len(buckets))
    own = slot[found.bucket]
    row, own = found.row[own >= 0], own[own >= 0]
    z = np.stack([np.bincount(row, weights[own, k], minlength=rows) for k in range(len(intercepts))], axis=1) + intercepts
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def domain_posteriors(docs: DataFrame, labelled: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with ``n_tokens`` and ``p_<domain>`` for each domain of ``labelled`` (doc_id, domain).

    The classifier is a multinomial logistic regression on hashed counts of ``with_tokens``. An L1 penalty leaves out the
    many rare words. It is fitted on at most ``TRAINING_ROWS`` labelled documents with words, those of the smallest hashes
    of doc_id. Of a document's conflicting labels ``toxic`` counts, else the first in alphabetical order.
    With a single domain its probability is 1 everywhere; without any labelled document there is one domain, ``all``.
    """
    named = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isNotNull()) \
        .groupBy("doc_id").agg(F.when(F.max(F.col("domain") == "toxic"), "toxic").otherwise(F.min("domain")).alias("domain"))
    worded = docs.where(F.col("text").rlike(r"\S")).select("doc_id")   # a token is any character that is not white space
    known = F.broadcast(named.join(worded, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_ROWS))  # bounded rows of two short columns
    training = stored(docs.select("doc_id", "text").join(known, "doc_id").select("text", "domain")
                      .mapInArrow(_training_rows, "bucket array<int>, n array<double>, domain string"), "training")
    domains = [r["domain"] for r in training.select("domain").distinct().orderBy("domain").collect()]
    fitted = fit_classifier(training, domains) if len(domains) > 1 else None
    domains = domains or ["all"]
    names = [f"p_{d}" for d in domains]

    def compute(part: pa.RecordBatch) -> dict[str, pa.Array]:
        found = hashed_features(part.column("text"))
        p = posteriors(found, len(part), *fitted) if fitted else np.ones((len(part), 1))
        return {"n_tokens": pa.array(found.n_tokens, pa.int64()), **{n: pa.array(p[:, k]) for k, n in enumerate(names)}}

    return add_columns(docs, ", ".join(["n_tokens long", *[f"`{n}` double" for n in names]]), compute,
                       size=CHUNK_BYTES), domains


@dataclass
class Fit:
    """State of a fit: the common first rate, expected tokens of the domains at rate 1, residuals of the steps so far."""

    start: float
    there: np.ndarray
    residuals: list[np.ndarray]


def replay(shares: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the accelerated projected-gradient steps so far, and the point where the next gradient is taken."""
    rate = ahead = np.full(len(shares), fit.start)
    momentum, scale = 1.0, np.maximum(shares @ fit.there, 1e-300)
    for residual in fit.residuals:
        after = np.maximum(0.0, ahead - shares @ residual / scale)
        following = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead = after + (momentum - 1) / following * (after - rate)
        rate, momentum = after, following
    return rate, ahead


def _numbers(batch: pa.RecordBatch, domains: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("n_tokens").to_numpy(zero_copy_only=False).astype(float), \
        np.stack([batch.column(f"p_{d}").to_numpy(zero_copy_only=False) for d in domains], axis=1)


def fit_rates(weighted: DataFrame, domains: list[str], targets: dict[str, float]) -> Fit:
    """The fit over ``weighted`` (n_tokens, p_<domain>).

    The budget is the smallest at which no domain with a target has to be cut: the largest ratio of its expected tokens to
    its weight. Without tokens or targets all rates stay 1.
    """
    k = len(domains)
    weighted = weighted.select("n_tokens", *[f"p_{d}" for d in domains])

    def totals(rates) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(k)
            for batch in batches:
                tokens, shares = _numbers(batch, domains)
                total += shares.T @ (tokens * rates(shares))
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], [f"t{i}" for i in range(k)])

        parts = weighted.mapInArrow(run, ", ".join(f"t{i} double" for i in range(k)))
        return np.array([x or 0.0 for x in parts.agg(*[F.sum(f"t{i}") for i in range(k)]).first()])

    there = totals(lambda shares: 1.0)
    weight = np.array([max(0.0, targets.get(d, 0.0)) if n > 0 else 0.0 for d, n in zip(domains, there, strict=True)])
    if not weight.any():
        return Fit(1.0, there, [])
    weight /= weight.sum()
    budget = float((there[weight > 0] / weight[weight > 0]).max())
    fit, before = Fit(budget / float(there.sum()), there, []), None
    for _ in range(STEPS):
        residual = totals(lambda shares: replay(shares, fit)[1]) - weight * budget
        if np.abs(residual).max() <= TOLERANCE * budget \
                or before is not None and np.abs(residual - before).max() <= TOLERANCE * TOLERANCE * budget:
            break
        fit.residuals.append(residual)
        before = residual
    return fit


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None,
        keep: list[str] | None = None, whole_from: float | None = None) -> tuple[DataFrame, list[str]]:
    """``docs`` (or its columns ``keep``) with n_tokens, p_<domain>, ``rate`` and ``copies``, and the domains.

    ``copies`` is the rate rounded down or up by a hash of doc_id and text, in proportion. With ``whole_from``, documents
    of at least that rate keep one copy at least, which exceeds the targets by what rounding down would have left out.
    Texts without words have the classifier's prior and no weight. Nulls in any column and repeated rows are taken as
    they are; columns of ``docs`` with the added names are replaced.
    """
    scored, domains = domain_posteriors(docs, labelled)
    added = ["n_tokens", *[f"p_{d}" for d in domains]]
    names = [c for c in keep or docs.columns if c not in (*added, "rate", "copies")]
    kept = stored(scored.withColumn("_key", F.xxhash64("doc_id", "text")).select(
        *names, "n_tokens", *[f"p_{d}" for d in domains], "_key"), "posteriors")
    fit = fit_rates(kept, domains, targets or TARGETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rate, _ = replay(_numbers(batch, domains)[1], fit)
            chance = (batch.column("_key").to_numpy(zero_copy_only=False) >> 11 & ((1 << 53) - 1)) / float(1 << 53)
            copies = (np.floor(rate) + (chance < rate - np.floor(rate))).astype(np.int64)
            if whole_from is not None:
                copies = np.where(rate >= whole_from, np.maximum(copies, 1), copies)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate), pa.array(copies)],
                                             [*batch.schema.names, "rate", "copies"])

    schema = kept.limit(0).withColumns({"rate": F.lit(0.0), "copies": F.lit(0).cast("long")}).schema
    return kept.mapInArrow(run, schema).drop("_key"), domains


def resample(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None,
             whole_from: float | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its rate asks for; ``whole_from`` as in ``mix``."""
    names = docs.columns
    packed = docs.select("doc_id", "text", F.struct(*[docs[c] for c in names]).alias("_row"))
    mixed, _ = mix(packed, labelled, targets, keep=["_row"], whole_from=whole_from)
    return mixed.where("copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_i")) \
        .select("_row.*")
