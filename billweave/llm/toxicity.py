"""Toxicity [op 4]: a factorization machine over hashed terms.

A text's terms are its words in lower case and the words' beginnings (of the lengths in ``STARTS``), hashed;
a term counts once. The machine adds a weight for each
term and, for each pair of terms, the product of their factor vectors, so an insult together with a mention of
a group can weigh more than both alone.

It is fitted on a bounded sample of labelled texts: at most ``SAMPLE_PER_CLASS`` of each label, those with the
smallest hash of doc_id, with classes weighted back to their shares among all labels. Of a sampled text at most
``SAMPLE_TEXT_TERMS`` hashed terms count, those with the smallest hashes; so the sample has a bound in bytes. Every
hashed term takes part that tells something by a chi-squared test, alone or together with another one: pairs of all
whole words that are frequent enough to pass are tested too. Weights and factors, at most 2 ** ``HASH_BITS`` rows of them,
are broadcast, and every document is scored.

Defined results: a NULL or empty text gets the score of a text without known terms. Labels other than 0 and
1, and labels of unknown documents, are not used; of several labels of a document the larger counts. With
labels of one class or none, every score is that class's share (0 without labels). A NULL doc_id is not held
out. Repeated rows are scored each; of the texts of one doc_id the smallest is learned from. Other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, smallest_hashes, text_of

STARTS = (4, 5, 6, 7)
HASH_BITS = 20
SAMPLE_PER_CLASS = 5000
SAMPLE_TEXT_TERMS = 8192
LEAST_TEXTS = 3
# Least chi-squared of a term; least gain in it of a pair over both its terms.
TELLING, PAIR_TELLING = 10, 40
PAIR_BLOCK = 1024
FACTORS = 8
EPOCHS = 40
BATCH = 256
WEIGHT_DECAY, FACTOR_DECAY = 1e-4, 1e-3
THRESHOLD = 0.3
SLICE_BYTES = 8_000_000
REMEMBERED_WORDS = 500_000
_NONE = np.zeros(0, np.int32)
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def hashed(word: str) -> list[int]:
    """Hashed terms of a word: the word, an even number, and its beginnings, odd ones."""
    starts = [f"^{word[:n]}" for n in STARTS if len(word) >= n]
    codes = [zlib.crc32(t.encode()) & ((1 << HASH_BITS) - 1) for t in (word, *starts)]
    return [codes[0] & ~1, *(c | 1 for c in codes[1:])]


@dataclass
class Machine:
    """``place`` gives a hashed term's row in ``weights`` and ``factors``, or -1."""

    bias: float
    place: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def places(self, word: str) -> np.ndarray:
        found = self.place[hashed(word)]
        return found[found >= 0]

    def raw(self, rows: list[np.ndarray]) -> np.ndarray:
        """Log odds of texts, each given as the places of its terms."""
        counts = np.asarray([len(r) for r in rows])
        out = np.full(len(rows), self.bias)
        some = np.flatnonzero(counts)
        if len(some):
            flat = np.concatenate(rows)
            starts = np.cumsum(counts[some]) - counts[some]
            v = self.factors[flat]
            total = np.add.reduceat(v, starts)
            out[some] += np.add.reduceat(self.weights[flat], starts)
            out[some] += 0.5 * (total**2 - np.add.reduceat(v**2, starts)).sum(axis=1)
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(rows), -30, 30)))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[DataFrame, dict[int, int]]:
    """(toxic, terms) of the sampled texts, and how many usable labels of each class there are."""
    usable = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    chosen = None
    for kind in (0, 1):
        own = usable.filter(F.col("toxic") == kind)
        own = smallest_hashes(own, [F.xxhash64("doc_id"), F.col("doc_id")], per_class, counts.get(kind, 0))
        chosen = own if chosen is None else chosen.unionByName(own)
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
    )
    most = SAMPLE_TEXT_TERMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            terms = [sorted({h for w in words_of(t) for h in hashed(w)})[:most] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(terms, pa.list_(pa.int32()))], ["toxic", "terms"]
            )

    return texts.select("text", "toxic").mapInArrow(run, "toxic int, terms array<int>"), counts


def _chi_squared(toxic: np.ndarray, all_: np.ndarray, totals: tuple[int, int]) -> np.ndarray:
    """Of terms (or pairs) in so many toxic texts and texts at all, with the numbers of clean and toxic texts."""
    n = sum(totals)
    expected = all_ * (totals[1] / n)
    spread = expected * (1 - all_ / n) * (totals[0] / n)
    return np.where(all_ >= LEAST_TEXTS, (toxic - expected) ** 2 / np.maximum(spread, 1e-3), 0)


def telling(terms: np.ndarray, texts: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Terms (of ``texts``, side by side) that tell a label alone or in a pair, sorted.

    A pair that all toxic texts and no clean ones had would need ``fewest`` texts to pass; other terms are in no such pair.
    """
    totals = int((labels == 0).sum()), int((labels == 1).sum())
    seen = np.bincount(terms, minlength=1 << HASH_BITS)
    seen_toxic = np.bincount(terms[labels[texts] == 1], minlength=1 << HASH_BITS)
    alone = _chi_squared(seen_toxic, seen, totals)
    fewest = max(LEAST_TEXTS, int(PAIR_TELLING * totals[1] / (totals[0] + PAIR_TELLING)))
    tried = 2 * np.flatnonzero(seen_toxic[::2] >= fewest)
    blocks = [tried[i : i + PAIR_BLOCK] for i in range(0, len(tried), PAIR_BLOCK)]
    order = np.argsort(terms, kind="stable")
    by_term = terms[order]

    def matrix(block: np.ndarray) -> np.ndarray:
        """Texts with any of the block's terms as rows of 0 and 1."""
        begins, ends = np.searchsorted(by_term, block), np.searchsorted(by_term, block, side="right")
        x = np.zeros((len(labels), len(block)), np.float32)
        for column, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist(), strict=True)):
            x[texts[order[begin:end]], column] = 1
        return x

    paired: list[np.ndarray] = []
    toxic_rows = labels == 1
    for i, one in enumerate(blocks):
        x = matrix(one)
        for two in blocks[i:]:
            y = matrix(two)
            toxic = x[toxic_rows].T @ y[toxic_rows]
            rows, columns = np.nonzero(toxic >= fewest)
            if not len(rows):
                continue
            gain = _chi_squared(toxic[rows, columns], (x.T @ y)[rows, columns], totals)
            gain -= np.maximum(alone[one[rows]], alone[two[columns]])
            paired += [one[rows[gain > PAIR_TELLING]], two[columns[gain > PAIR_TELLING]]]
    return np.unique(np.concatenate([np.flatnonzero(alone > TELLING), *paired]))


def fit(found: list[tuple[int, np.ndarray]], counts: dict[int, int], seed: int = 7) -> Machine:
    """Fits the machine to (label, hashed terms) by Adam steps on the weighted log loss.

    A step takes a batch of texts as a dense matrix over the terms that occur in it, and moves these terms only.
    """
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    place = np.full(1 << HASH_BITS, -1, np.int32)
    labels = np.asarray([y for y, _ in found])
    if len(set(labels.tolist())) < 2:
        return Machine(bias, place, np.zeros(0), np.zeros((0, FACTORS)))
    lengths = [len(t) for _, t in found]
    flat = np.concatenate([t for _, t in found]).astype(np.int64)
    known = telling(flat, np.repeat(np.arange(len(found)), lengths), labels)
    place[known] = np.arange(len(known))
    rows = [p[p >= 0] for p in np.split(place[flat], np.cumsum(lengths)[:-1])]
    totals = [float((labels == k).sum()) for k in (0, 1)]
    weight = np.where(labels == 1, share / totals[1], (1 - share) / totals[0]) * len(labels)
    rng = np.random.default_rng(seed)
    weights, factors = np.zeros(len(known), np.float32), rng.normal(0, 0.01, (len(known), FACTORS)).astype(np.float32)
    free = np.asarray([bias], np.float32)
    state = [np.zeros_like(p) for p in (free, weights, factors) for _ in (0, 1)]
    batches = []
    for part in np.array_split(rng.permutation(len(found)), max(1, len(found) // BATCH)):
        columns, at = np.unique(np.concatenate([rows[i] for i in part]), return_inverse=True)
        batches.append((part, columns, np.repeat(np.arange(len(part)), [len(rows[i]) for i in part]), at))
    step = 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(batches)):
            part, columns, row, at = batches[k]
            x = np.zeros((len(part), len(columns)), np.float32)
            x[row, at] = 1
            w, v = weights[columns], factors[columns]
            total = x @ v
            z = free + x @ w + 0.5 * (total**2 - x @ v**2).sum(axis=1)
            error = (weight[part] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) / len(part)).astype(np.float32)
            pull = x.T @ error
            moves = (
                (free, slice(None), error.sum(keepdims=True)),
                (weights, columns, pull + WEIGHT_DECAY * w),
                (factors, columns, x.T @ (error[:, None] * total) - v * pull[:, None] + FACTOR_DECAY * v),
            )
            step += 1
            for (p, of, g), m, s in zip(moves, state[::2], state[1::2], strict=True):
                m[of] += 0.1 * (g - m[of])
                s[of] += 0.01 * (g * g - s[of])
                p[of] -= 0.02 * (m[of] / (1 - 0.9**step)) / (np.sqrt(s[of] / (1 - 0.99**step)) + 1e-8)
    return Machine(float(free[0]), place, weights, factors)


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    rows, counts = sample(docs, labels)
    table = rows.toArrow().combine_chunks()  # bounded: see SAMPLE_PER_CLASS and SAMPLE_TEXT_TERMS
    if not table.num_rows:
        return fit([], counts)
    terms = table.column("terms").chunk(0)
    parts = np.split(terms.flatten().to_numpy(), np.cumsum(terms.value_lengths().to_numpy())[:-1])
    return fit(list(zip(table.column("toxic").to_pylist(), parts, strict=True)), counts)


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(
        (machine.bias, machine.place, machine.weights, machine.factors)
    )
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Machine(*sent.value)
        known: dict[str, np.ndarray] = {}
        for batch in pieces(batches, "text", SLICE_BYTES):
            if len(known) > REMEMBERED_WORDS:
                known.clear()
            places = []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                for word in words.difference(known):
                    known[word] = own.places(word)
                places.append(np.unique(np.concatenate([_NONE, *map(known.__getitem__, words)])))
            scores = own.scores(places)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= threshold).astype(np.int32), pa.int32()),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
