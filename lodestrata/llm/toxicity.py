"""Toxicity: a factorization machine over hashed terms.

The score of a text is a logistic function of a bias, a weight for each of its terms and, for each two
terms, the product of their factor vectors: an insult and a group may each be harmless and the pair
not. Terms are the words of a text and their first and last bytes, known by 64-bit hashes, so that
inflected and compound forms share terms. The machine is fitted on a bounded sample of labelled rows; every
text is scored whole, in tasks, by the fitted arrays, whose size is bounded too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import memory
from .wordhash import _TABLE, _WORD_BYTE, mix, slices, text_buffer

#: labelled rows of either label that are fitted on, and terms that have a weight
MOST_LABELLED = 4000
MOST_TERMS = 8192
FACTORS = 8
ENDS = (4, 5, 6)

_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 1 << 64)
_SALT = np.arange(1, 2 * len(ENDS) + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


class Machine(NamedTuple):
    """Hashes of the terms in order, their weights and factors, and the bias."""

    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float


def terms_of(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of terms and the places of their texts: all words, then all first and all last bytes of each length.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, in lower case.
    """
    data, offsets = text_buffer(texts)
    inside = _WORD_BYTE[data]
    before = np.r_[False, inside[:-1]]
    before[offsets[:-1][offsets[:-1] < data.size]] = False  # a text's first byte continues no word
    starts = np.flatnonzero(inside & ~before)
    if not starts.size:
        return
    at = np.flatnonzero(inside)
    first = np.searchsorted(at, starts)
    length = np.diff(np.r_[first, at.size])
    powers = np.cumprod(np.r_[np.uint64(1), np.full(int(length.max()), _BASE, np.uint64)], dtype=np.uint64)
    inverse = np.cumprod(np.r_[np.uint64(1), np.full(int(length.max()), _INVERSE, np.uint64)], dtype=np.uint64)
    place = np.arange(at.size) - np.repeat(first, length)
    sums = np.r_[np.uint64(0), np.cumsum(_TABLE[data[at]] * powers[place], dtype=np.uint64)]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    end = first + length
    yield mix((sums[end] - sums[first]) ^ _SALT[0]), owner
    for i, n in enumerate(ENDS):
        long = length > n
        a, b = first[long], end[long]
        yield mix((sums[a + n] - sums[a]) ^ _SALT[2 * i + 1]), owner[long]
        yield mix(((sums[b] - sums[b - n]) * inverse[length[long] - n]) ^ _SALT[2 * i + 2]), owner[long]


def _examples(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = list(terms_of(part["text"]))
            owner = np.concatenate([np.empty(0, np.int64), *[o for _, o in found]])
            hashes = np.concatenate([np.empty(0, np.uint64), *[h for h, _ in found]])
            order = np.lexsort((hashes, owner))
            owner, hashes = owner[order], hashes[order]
            new = np.r_[True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])] if owner.size else np.empty(0, bool)
            owner, hashes = owner[new], hashes[new]
            ends = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.record_batch([part["label"], pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))], names=["label", "terms"])
    memory.release()


def held_out(key: Column) -> Column:
    """Whether a row's label is kept from the fit: crc32 of the key as text is a multiple of 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def examples(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MOST_LABELLED) -> DataFrame:
    """(label, terms) of at most ``most`` labelled rows of either label, those whose keys have the least hashes.

    Rows held out, and those without key or label, are left out. Of several texts with one key the one
    with the least hash counts.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key))).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).distinct()
    ranked = known.withColumn("place", F.expr("row_number() OVER (PARTITION BY label ORDER BY xxhash64(key), key)"))
    chosen = ranked.where(F.col("place") <= most).select("key", "label")
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "key")  # at most 2 * most keys
    return found.groupBy("key", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("label", "text").mapInArrow(_examples, "label int, terms array<long>")


def _gains(column: np.ndarray, label: np.ndarray, row: np.ndarray, width: int) -> np.ndarray:
    """The likelihood ratio of each term's presence and the label."""
    total, ones = label.size, label.sum()
    has = np.bincount(column, minlength=width).astype(float)
    hit = np.bincount(column, weights=label[row], minlength=width)

    def term(observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    rest, missed = total - has, ones - hit
    return 2 * (term(hit, has * ones / total) + term(has - hit, has * (total - ones) / total) + term(missed, rest * ones / total) + term(rest - missed, rest * (total - ones) / total))


def forward(machine: Machine, column: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The log odds of each row of (row, term) places, each at most once, and the sums of its terms' factors."""
    add = lambda values: np.bincount(row, weights=values, minlength=rows)
    sums = np.stack([add(machine.factors[column, f]) for f in range(machine.factors.shape[1])], axis=1)
    squares = add((machine.factors**2).sum(axis=1)[column])
    return machine.bias + add(machine.weights[column]) + ((sums**2).sum(axis=1) - squares) / 2, sums


def fit(found: pa.Table, most_terms: int = MOST_TERMS, factors: int = FACTORS, passes: int = 40, step: float = 0.2, decay: float = 1e-5) -> Machine:
    """A machine fitted to (label, terms) by adaptive gradient steps on batches of rows.
    Only terms of three rows or more that tell the labels apart have weights, the best ``most_terms``. Without
    rows of both labels there are none, and every score is the share of label 1 (0 without rows).
    """
    label = found["label"].to_numpy().astype(float)
    share = float(np.clip(label.mean(), 1e-6, 1 - 1e-6)) if label.size else 1e-6
    bias = float(np.log(share / (1 - share)))
    lists = found["terms"].combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
    hashes = lists.flatten().to_numpy().view(np.uint64)
    row = np.repeat(np.arange(label.size), np.diff(lists.offsets.to_numpy()))
    terms, column, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    gains = np.where(counts >= 3, _gains(column, label, row, terms.size), 0) if label.any() and not label.all() else np.zeros(terms.size)
    chosen = np.flatnonzero(gains > 6.6)
    chosen = np.sort(chosen[np.lexsort((chosen, -gains[chosen]))[:most_terms]])
    number = np.full(terms.size, -1)
    number[chosen] = np.arange(chosen.size)
    column, row = number[column], row[number[column] >= 0]
    column, width = column[column >= 0], chosen.size
    random = np.random.default_rng(13)
    machine = Machine(terms[chosen], np.zeros(width), random.normal(0, 0.05, (width, factors)), bias)
    if not width:
        return machine
    values = np.r_[machine.weights, machine.factors.ravel(), bias]
    squares = np.full(values.size, 1e-8)
    starts = np.searchsorted(row, np.arange(label.size + 1))
    for _ in range(passes):
        for rows in np.array_split(random.permutation(label.size), max(1, label.size // 512)):
            sizes = starts[rows + 1] - starts[rows]
            at = np.repeat(starts[rows] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            c, r = column[at], np.repeat(np.arange(rows.size), sizes)
            machine = Machine(machine.terms, values[:width], values[width:-1].reshape(width, factors), values[-1])
            odds, sums = forward(machine, c, r, rows.size)
            slope = (1 / (1 + np.exp(-np.clip(odds, -40, 40))) - label[rows]) / rows.size
            add = lambda weights, c=c: np.bincount(c, weights=weights, minlength=width)
            here = slope[r]
            pairs = np.stack([add(here * sums[r, f]) for f in range(factors)], axis=1) - machine.factors * add(here)[:, None]
            gradient = np.r_[add(here), pairs.ravel(), slope.sum()] + decay * np.r_[values[:-1], 0.0]
            squares += gradient**2
            values = values - step * gradient / np.sqrt(squares)
    return Machine(terms[chosen], values[:width], values[width:-1].reshape(width, factors), float(values[-1]))


def _score(shared: object, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    machine = shared.value
    seen = np.zeros(1 << 20, bool)  # which hashes can be a term's, by their upper bits
    seen[machine.terms >> np.uint64(44)] = True
    width = max(machine.terms.size, 1)
    for batch in batches:
        for part in slices(batch, "text"):
            places = [np.empty(0, np.int64)]
            for hashes, owner in terms_of(part["text"]):
                maybe = np.flatnonzero(seen[hashes >> np.uint64(44)])
                at = np.searchsorted(machine.terms, hashes[maybe])
                known = machine.terms[np.minimum(at, width - 1)] == hashes[maybe] if machine.terms.size else np.empty(0, bool)
                places.append(owner[maybe][known] * width + at[known])
            found = np.unique(np.concatenate(places))
            odds, _ = forward(machine, found % width, found // width, part.num_rows)
            yield pa.record_batch([part["row"], pa.array(1 / (1 + np.exp(-np.clip(odds, -700, 700))))], names=["row", "score"])
    memory.release()


def score(spark: SparkSession, docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """All rows with ``score`` and ``predicted`` in place of columns of these names."""
    carried = [c for c in docs.columns if c not in ("score", "predicted")]
    inner = docs.select(F.struct(*[F.col(c) for c in carried if c != text], F.lit(0).alias("_")).alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    shared = spark.sparkContext.broadcast(machine)  # at most MOST_TERMS terms
    kind = inner.schema["row"].dataType.simpleString()
    found = inner.mapInArrow(lambda batches: _score(shared, batches), f"row {kind}, score double")
    return found.select(*[F.col("row")[c].alias(c) for c in carried if c != text], "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", most: int = MOST_LABELLED) -> DataFrame:
    """(key, held_out, score, predicted) of every row: the probability of label 1, and whether it is 0.5 or more.

    Only the text is an input of the score. The labels of rows whose key's crc32, as text, is a multiple of 5 are
    never read. A null text is empty; an empty text has the score of no terms, which is the bias; repeated
    rows are scored each, null keys are not held out, and no rows give none. Other columns are not read.
    """
    machine = fit(examples(docs, labels, key, text, label, most).toArrow())
    scored = score(spark, docs.select(F.col(key).alias("key"), F.col(text).alias("text")), machine)
    return scored.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score", "predicted")
