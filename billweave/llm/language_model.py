"""Language-model scores [op 8]: a bigram model in Elias-Fano tries, sharded over the cluster.

Words (ASCII letters in lower case, cut at ASCII white space) and one end per text are tokens; a bigram is a
token with the one before it, the context (for the first token: a begin mark). The model is learned from the
texts that are not held out:

* seen bigram: (1 - b) * count(context, token) / count(context);
* unseen after a known context: b * p1(token); after an unknown one: p1(token);
* p1 is the add-one unigram probability. b is the Witten-Bell share of the context, the number of its
  successors over that number plus its count.

No part of the model is gathered in one place. Bigrams of all texts, counted per text, are shuffled once by
context. A shard first adds up its training counts and builds its trie: contexts as a sorted level, monotone
pointers to their successors, successors by a 32-bit fingerprint, and 16-bit quantised log probabilities, all
Elias-Fano coded or memory-mapped. Then it looks up the bigrams of its texts: the context by successor search,
the token by a search relative to the context's range. Unseen tokens are joined with the unigram table.

Contexts with at least a thousandth of all tokens (so at most ``MOST_SPLIT``) are split: their bigrams are
dealt by context and token. Their counts, known from the unigram pass, and their numbers of successors, counted
by a pass of their own over distinct bigrams, are broadcast. A shard's rows are spooled to an unnamed temporary file, so even a bigram that is in every text needs little memory.

Defined results: a NULL or empty text is one end token. Repeated rows are each scored, and learned from, as
rows of their own. A NULL doc_id is not held out. Without training texts all counts are 0. Empty tables give
empty results. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
import math
import pickle
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, stored, text_of
from .elias_fano import EliasFano, find_within, mapped

# A context with at least this share of all tokens is split over shards.
MOST_SPLIT = 1000
SHARD_TOKENS = 3_000_000
SLICE_BYTES = 6_000_000
SPOOL_BYTES = 40_000_000
BEGIN, END = xxhash.xxh64_intdigest(b" begin"), xxhash.xxh64_intdigest(b" end")
_LOG_RANGE = 12.0
_PARTS = "doc_id long, row_key long, n_tokens long, n_known long, base double, score double, n_rows long, unseen long, unseen_n long"
# Words travel as 48 bits of their hash, documents as 16-bit numbers within a slice; counts are compressed.
_BLOBS = ("contexts", "n_tokens", "tokens", "n_docs", "trained", "docs", "times", "doc_ids", "row_keys")
_COUNTS = {"n_tokens": "<u4", "n_docs": "<u4", "trained": "<u4", "docs": "<u2", "times": "<u4"}
_SLICE_ROWS = 1 << 16


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(7)) == 2, F.lit(False))


def tokens_of(text: str) -> list[bytes]:
    """Words: bytes.lower and bytes.split know ASCII letters and white space only."""
    return text.encode().lower().split()


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def unigram_counts(docs: DataFrame) -> DataFrame:
    """Training counts per hashed word: word, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE_BYTES):
            numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
            flat = [numbers[w] for t in batch.column("text").to_pylist() for w in tokens_of(t)]
            words = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
            yield pa.RecordBatch.from_arrays(
                [_signed(words), pa.array(np.bincount(flat, minlength=len(words)).astype(np.int64))], ["word", "n"]
            )

    return docs.filter("not held_out").select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(
        F.sum("n").alias("n")
    )


def _coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words, tokens per text, and the contexts and tokens of all texts in a row, as places in the words."""
    numbers: defaultdict[bytes, int] = defaultdict(itertools.count(2).__next__)
    number = numbers.__getitem__
    coded = [list(map(number, tokens_of(t))) for t in texts]
    words = np.empty(len(numbers) + 2, np.uint64)
    words[:2] = BEGIN, END
    words[2:] = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
    lengths = np.asarray([len(c) + 1 for c in coded])
    token = np.fromiter(itertools.chain.from_iterable(itertools.chain(c, (1,)) for c in coded), np.int64, int(lengths.sum()))
    context = np.r_[np.int64(0), token[:-1]]
    context[np.cumsum(lengths) - lengths] = 0
    return words, lengths, context, token


def split_successors(docs: DataFrame, split: list[int]) -> dict[int, int]:
    """How many distinct tokens follow each of the ``split`` contexts (at most ``MOST_SPLIT`` and one) in training texts."""
    place = {word: k for k, word in enumerate(split)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE_BYTES):
            words, _, context, token = _coded(batch.column("text").to_pylist())
            at = np.asarray([place.get(w, -1) for w in words.tolist()])[context]
            here = at >= 0
            pairs = np.unique((at[here].astype(np.uint64) << np.uint64(48)) | _short(words)[token[here]])
            yield pa.RecordBatch.from_arrays([_signed(pairs)], ["pair"])

    pairs = docs.filter("not held_out").select("text").mapInArrow(run, "pair long").distinct()
    counts = pairs.groupBy(F.shiftrightunsigned("pair", 48).alias("at")).agg(F.count("*").alias("n")).collect()
    return {split[r["at"]]: r["n"] for r in counts}


def _sliced_bigrams(batch: pa.RecordBatch, split: set[int], shards: int) -> Iterator[tuple]:
    """The bigrams of one slice, as one row of arrays for each shard."""
    words, lengths, context, token = _coded(batch.column("text").to_pylist())
    doc = np.repeat(np.arange(len(lengths)), lengths)
    keys = np.sort((context * len(words) + token) * len(lengths) + doc)
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    times = np.diff(np.r_[begin, len(keys)])
    pair, doc = np.divmod(keys[begin], len(lengths))
    first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    n_docs = np.diff(np.r_[first, len(pair)])
    held = np.asarray(batch.column("held_out").to_pylist(), bool)
    trained = np.add.reduceat(np.where(held[doc], 0, times), first)
    context, token = np.divmod(pair[first], len(words))
    is_split = np.asarray([int(w) in split for w in words])
    dealt = words[context] ^ np.where(is_split[context], (words[token] >> np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15), 0)
    shard = ((dealt ^ (dealt >> np.uint64(32))) % np.uint64(shards)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    entry_order = np.argsort(np.repeat(shard, n_docs), kind="stable")
    context, token, n_docs, trained, shard = (a[order] for a in (context, token, n_docs, trained, shard))
    doc, times = doc[entry_order], times[entry_order]
    edges = np.searchsorted(shard, np.arange(shards + 1))
    entries = np.r_[0, np.cumsum(n_docs)]
    doc_ids, row_keys = (batch.column(c) for c in ("doc_id", "row_key"))
    names = pickle.dumps(doc_ids.to_pylist())
    row_keys = row_keys.to_numpy(zero_copy_only=False).astype(np.int64).tobytes()
    for k in range(shards):
        a, b = edges[k], edges[k + 1]
        if a == b:
            continue
        starts = np.flatnonzero(np.r_[True, context[a + 1 : b] != context[a : b - 1]])
        yield (
            k,
            _packed_words(words[context[a:b][starts]]),
            _packed_counts(np.diff(np.r_[starts, b - a]), "n_tokens"),
            _packed_words(words[token[a:b]]),
            _packed_counts(n_docs[a:b], "n_docs"),
            _packed_counts(trained[a:b], "trained"),
            _packed_counts(doc[entries[a] : entries[b]], "docs"),
            _packed_counts(times[entries[a] : entries[b]], "times"),
            names,
            row_keys,
        )


class Shard:
    """The trie of a shard's contexts."""

    def __init__(self, contexts: np.ndarray, tokens: np.ndarray, counts: np.ndarray, known: dict[int, tuple[int, int]]):
        """Bigrams (48 bits of each word) with training counts, in any order, with repeats; ``known``: the counts and
        numbers of successors of split contexts, over all shards."""
        contexts, tokens, counts = (a[counts > 0] for a in (contexts, tokens, counts))
        # A split context is known even where none of its training bigrams is.
        split = np.fromiter((c >> 16 for c, (n, _) in known.items() if n), np.uint64)
        found = np.union1d(contexts, split)
        owner = np.searchsorted(found, contexts)
        keys = (owner.astype(np.uint64) << np.uint64(32)) | (tokens >> np.uint64(16))
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        counts = np.add.reduceat(counts[order], first) if len(first) else counts
        keys = keys[first]
        owner = (keys >> np.uint64(32)).astype(np.int64)
        successors = np.bincount(owner, minlength=len(found))
        totals = np.bincount(owner, counts, minlength=len(found))
        kinds = successors.copy()
        at = np.searchsorted(found, split)
        totals[at], kinds[at] = [n for n, _ in known.values() if n], [k for n, k in known.values() if n]
        backoff = kinds / np.maximum(kinds + totals, 1)
        self.contexts = EliasFano(found, (1 << 48) - 1)
        self.pointers = EliasFano(np.r_[0, np.cumsum(successors)], len(keys))
        self.tokens = mapped((keys & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        logs = np.log10((1 - backoff)[owner] * counts / np.maximum(totals[owner], 1))
        self.quantised = mapped(np.round(np.clip(-logs, 0, _LOG_RANGE) * (65535 / _LOG_RANGE)).astype(np.uint16))
        self.totals, self.backoff = totals, backoff

    def find(self, contexts: np.ndarray, n_tokens: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Contexts with ``n_tokens`` tokens each: the index of every context, and of every bigram (or -1)."""
        at = self.contexts.find(contexts)
        here = np.maximum(at, 0)
        if not self.contexts.count:
            return at, np.full(len(tokens), -1, np.int64)
        begin = self.pointers.access(here).astype(np.int64)
        end = np.where(at >= 0, self.pointers.access(here + 1).astype(np.int64), begin)
        found = find_within(
            self.tokens, np.repeat(begin, n_tokens), np.repeat(end, n_tokens), (tokens >> np.uint64(16)).astype(np.uint32)
        )
        return at, found

    def log_probability(self, index: np.ndarray) -> np.ndarray:
        return self.quantised[index] * (-_LOG_RANGE / 65535)


def _short(words: np.ndarray) -> np.ndarray:
    """The 48 bits of hashed words that travel."""
    return words >> np.uint64(16)


def _packed_words(words: np.ndarray) -> bytes:
    return np.ascontiguousarray(_short(words).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpacked_words(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _packed_counts(values: np.ndarray, name: str) -> bytes:
    return zstandard.compress(values.astype(_COUNTS[name]).tobytes(), 1)


def _unpacked(row: dict, but: tuple[str, ...] = ()) -> dict:
    """The arrays of a row, without those named in ``but``."""
    out = {n: _unpacked_words(row[n]) for n in ("contexts", "tokens")}
    out |= {
        n: np.frombuffer(zstandard.decompress(row[n]), kind).astype(np.int64)
        for n, kind in _COUNTS.items()
        if n not in but
    }
    return out | {"doc_ids": pickle.loads(row["doc_ids"]), "row_keys": np.frombuffer(row["row_keys"], np.int64)}


def _shard_parts(rows: Iterator[dict], known: dict[int, tuple[int, int]], log_p1: dict[int, float]) -> Iterator[pa.RecordBatch]:
    """Sums per text of one shard's bigrams; unseen tokens that need the unigram table are rows of their own."""
    with tempfile.SpooledTemporaryFile(SPOOL_BYTES) as spool:
        contexts, tokens, counts, n_rows = [], [], [], 0
        for row in rows:
            pickle.dump(row, spool)
            n_rows += 1
            x = _unpacked(row, ("docs", "times", "n_docs"))
            some = x["trained"] > 0
            contexts.append(np.repeat(x["contexts"], x["n_tokens"])[some])
            tokens.append(x["tokens"][some])
            counts.append(x["trained"][some])
        shard = Shard(np.concatenate(contexts), np.concatenate(tokens), np.concatenate(counts), known)
        del contexts, tokens, counts
        spool.seek(0)
        common = _short(np.fromiter(log_p1, np.uint64, len(log_p1)))
        order = np.argsort(common)
        common, common_logs = common[order], np.fromiter(log_p1.values(), float, len(log_p1))[order]
        for _ in range(n_rows):
            x = _unpacked(pickle.load(spool))
            at, found = shard.find(x["contexts"], x["n_tokens"], x["tokens"])
            total = np.where(at >= 0, shard.totals[np.maximum(at, 0)] if len(shard.totals) else 0, 0)
            backoff = np.where(at >= 0, shard.backoff[np.maximum(at, 0)] if len(shard.totals) else 1, 1)
            word = x["contexts"] != np.uint64(BEGIN >> 16)
            base = np.repeat(np.where(word, np.log10(total + 1), 0), x["n_tokens"])
            is_known = np.repeat(word & (total > 0), x["n_tokens"])
            is_begin = np.repeat(~word, x["n_tokens"])
            place = np.minimum(np.searchsorted(common, x["tokens"]), len(common) - 1)
            is_common = common[place] == x["tokens"]
            log_backoff = np.log10(np.repeat(backoff, x["n_tokens"]))
            logs = np.where(found >= 0, 0, log_backoff + np.where(is_common, common_logs[place], 0))
            seen = np.flatnonzero(found >= 0)
            logs[seen] = shard.log_probability(found[seen])
            asks = (found < 0) & ~is_common
            doc, times = x["docs"], x["times"]
            spread = lambda values: np.repeat(values, x["n_docs"])  # noqa: B023, E731
            sums = [
                np.bincount(doc, w, len(x["row_keys"]))
                for w in (times, times * spread(is_known), times * spread(base), times * spread(logs), times * spread(is_begin))
            ]
            there = np.flatnonzero(sums[0])
            asked = np.flatnonzero(spread(asks))
            rows_of = np.r_[there, doc[asked]]
            zeros = lambda: np.zeros(len(asked))  # noqa: B023, E731
            ints = lambda a: pa.array(np.r_[a[there], zeros()].astype(np.int64))  # noqa: B023, E731
            empty = np.zeros(len(there), bool)
            wanted = np.repeat(x["tokens"], x["n_docs"])[asked].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x["doc_ids"][i] for i in rows_of.tolist()], pa.int64()),
                    pa.array(x["row_keys"][rows_of]),
                    ints(sums[0]),
                    ints(sums[1]),
                    pa.array(np.r_[sums[2][there], zeros()]),
                    pa.array(np.r_[sums[3][there], zeros()]),
                    ints(sums[4]),
                    pa.array(np.r_[np.zeros(len(there), np.int64), wanted], mask=np.r_[~empty, np.zeros(len(asked), bool)]),
                    pa.array(np.r_[np.zeros(len(there), np.int64), times[asked]]),
                ],
                [c.split()[0] for c in _PARTS.split(", ")],
            )


def score(docs: DataFrame) -> DataFrame:
    """One row per document: the contract's columns, with the base score and the model's score."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text")
    ).withColumn("row_key", F.xxhash64("doc_id", "text"))
    unigrams = stored(unigram_counts(rows), "unigrams")
    n_texts = rows.filter("not held_out").count()
    words, kinds = unigrams.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = words + n_texts, kinds + (n_texts > 0)
    log_all = math.log10(n + v + 1)
    common = {
        r["word"] % (1 << 64): r["n"]
        for r in unigrams.filter(F.col("n") * MOST_SPLIT >= n).orderBy(F.desc("n")).limit(MOST_SPLIT).collect()
    }
    log_p1 = {w: math.log10(c + 1) - log_all for w, c in common.items()} | {END: math.log10(n_texts + 1) - log_all}
    counts = common | {BEGIN: n_texts}
    split = set(counts)
    successors = split_successors(rows, list(counts))
    known = {word: (count, successors.get(word, 0)) for word, count in counts.items()}
    shards = max(1, math.ceil(n / SHARD_TOKENS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE_BYTES, _SLICE_ROWS):
            for row in _sliced_bigrams(batch, split, shards):
                kinds_ = [pa.int32(), *[pa.binary()] * len(_BLOBS)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], k) for x, k in zip(row, kinds_, strict=True)], ["shard", *_BLOBS]
                )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = (row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())
        for _, own in itertools.groupby(every, lambda row: row["shard"]):
            yield from _shard_parts(own, known, log_p1)

    dealt = rows.mapInArrow(deal, "shard int, " + ", ".join(f"{b} binary" for b in _BLOBS))
    parts = stored(dealt.repartitionById(shards, "shard").sortWithinPartitions("shard").mapInArrow(look_up, _PARTS), "language-model-parts")
    asked = parts.filter("unseen is not null").select("doc_id", "row_key", "unseen", "unseen_n")
    shortened = unigrams.groupBy(F.shiftrightunsigned("word", 16).alias("unseen")).agg(F.sum("n").alias("n"))
    answered = asked.join(shortened, "unseen", "left").select(
        "doc_id",
        "row_key",
        *[F.lit(0).cast("long").alias(c) for c in ("n_tokens", "n_known")],
        F.lit(0.0).alias("base"),
        (F.col("unseen_n") * (F.log10(F.coalesce("n", F.lit(0)) + 1) - log_all)).alias("score"),
        F.lit(0).cast("long").alias("n_rows"),
    )
    sums = (
        parts.filter("unseen is null")
        .drop("unseen", "unseen_n")
        .unionByName(answered)
        .groupBy("doc_id", "row_key")
        .agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score", "n_rows")])
    )
    times = F.col("n_rows")  # equal rows have equal sums
    one = sums.select(
        "doc_id",
        (F.col("n_tokens") / times).cast("long").alias("n_tokens"),
        ((F.col("n_known") / times).cast("long") + (1 if n_texts else 0)).alias("n_known"),
        (F.col("base") / times + math.log10(n_texts + 1)).alias("base"),
        (F.col("score") / times).alias("score"),
        F.explode(F.sequence(F.lit(1), times.cast("int"))).alias("copy"),
    )
    return one.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * log_all).alias("base_score"),
        "score",
    )
