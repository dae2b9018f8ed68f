"""Spelling variant grouping [op 12]: words one edit apart, found by neighbourhoods over a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols. Two words one edit apart have reduced words at most one edit apart, so a
word is looked up under its reduced word and every reduced word one edit away, which are few, since there are few
symbols to put in. The reduced vocabulary is joined with these keys and hits are verified on the original words.
Of two reduced words one edit apart one is generated from the other: the shorter from the longer, or the one with
the smaller symbol; the hit then counts for both. A key also holds the half of the original word that the edit
leaves alone, so a key of many reduced words doesn't pair all of them.

Keys are 64-bit polynomial hashes, made for all edits of a batch of words from prefix sums; a word of length L has
some ``2.5 * L`` keys of a few bytes whatever its length. Equal hashes of different keys only cost a comparison.

A word's form is its most frequent near word, if that is ``RATIO`` times as frequent; roots follow forms, which grow
by that factor at each step, by doubling: four rounds reach 16 steps. Each round writes a table to the shared folder.

Defined results: a NULL text has no words; a NULL doc_id is '' where it is hashed. Repeated rows count each. An
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import stored

MIN_LETTERS = 7
MIN_COUNT = 2
# A form is at least so many times as frequent as its variant.
RATIO = 10
# One in so many of a document's words loses a letter before it is counted.
DAMAGED = 31
SYMBOLS = 4
# Words that a task counts before it hands them on.
HELD_WORDS = 300_000
# Letters whose keys are made at once.
KEY_LETTERS = 100_000
_SLICE_CHARS = 4_000_000
# In Latin-1 a letter is one byte; anything else becomes a blank, also "?", which stands for other characters.
_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0xC0 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)


def group(docs: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the vocabulary."""
    words = stored(word_counts(docs).filter(F.col("n") >= MIN_COUNT), "vocabulary")
    near = near_words(words, symbols)
    forms = stored(with_forms(words, near), "forms")
    return forms.join(_roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n: runs of letters, some of them damaged, of at least ``MIN_LETTERS`` letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                start = zlib.crc32(f"{doc_id}:".encode())
                for word, n in _runs(text.as_py()).items():
                    word = _damaged(word, start)
                    if len(word) >= MIN_LETTERS:
                        counts[word] += n
            if len(counts) > HELD_WORDS:
                yield _count_batch(counts)
                counts = Counter()
        yield _count_batch(counts)

    found = (
        docs.filter(F.col("text").isNotNull())
        .select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
        .mapInArrow(run, "word string, n long")
    )
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _runs(text: str) -> Counter:
    """The text's runs of enough letters, as Latin-1; a very long text is cut at other characters."""
    letters = text.encode("latin-1", "replace").translate(_LETTERS)
    found: Counter = Counter()
    begin = 0
    while begin < len(letters):
        end = letters.find(b" ", begin + _SLICE_CHARS)
        end = len(letters) if end < 0 else end
        found.update(w for w in letters[begin:end].split() if len(w) >= MIN_LETTERS)
        begin = end
    return found


def _damaged(word: bytes, start: int) -> bytes:
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
    if h % DAMAGED:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count_batch(counts: Counter) -> pa.RecordBatch:
    words = pa.array([w.decode("latin-1") for w in counts], pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, other, other_n: all pairs of words that are one edit apart, in both directions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = np.cumsum([0, *(len(w) for w in batch.column("word").to_pylist())])
            begin = 0
            while begin < batch.num_rows:
                end = max(int(np.searchsorted(letters, letters[begin] + KEY_LETTERS, "right")) - 1, begin + 1)
                part = batch.slice(begin, end - begin)
                own, near = neighbour_keys(part.column("word").to_pylist(), symbols)
                yield pa.RecordBatch.from_arrays([*part.columns, own, near], ["word", "n", "own", "near"])
                begin = end

    keyed = words.mapInArrow(run, "word string, n long, own array<long>, near array<long>")
    keyed = stored(keyed, "reduced-words")
    targets = keyed.select(F.posexplode("own").alias("half", "key"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    # A word's own keys find the words with the same reduced word; each such pair is taken from one side.
    same = keyed.select("word", "n", F.lit(True).alias("same"), F.explode("own").alias("key"))
    edited = keyed.select("word", "n", F.lit(False).alias("same"), F.explode("near").alias("key"))
    hits = same.unionByName(edited).join(targets, "key")
    # A pair that both halves find counts for the first.
    middle = F.floor(F.length("other") / 2).cast("int")
    first_half = F.left("word", middle) == F.left("other", middle)
    real = (
        (~F.col("same") | (F.col("word") < F.col("other")))
        & ((F.col("half") == 0) | ~first_half)
        & (F.levenshtein("word", "other", 1) == 1)
    )
    both = F.array(
        F.struct(F.col("word"), F.col("other"), F.col("other_n")),
        F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")),
    )
    return hits.filter(real).select(F.inline(both))


def neighbour_keys(words: list[str], symbols: int) -> tuple[pa.ListArray, pa.ListArray]:
    """Keys of each word itself (first half intact, second half intact), and of its reduced neighbours.

    The neighbours are the reduced words with one symbol less, or with one symbol replaced by a smaller one. A key is
    a hash of the reduced word, its length, which half of the original is intact, and that half.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(words) else lengths
    longest = int(lengths.max(initial=0))
    with np.errstate(over="ignore"):
        power, inverse = _powers(_BASE, longest + 1), _powers(_INVERSE, longest + 1)
        reduced = _mix(letters.astype(np.uint64)) % np.uint64(symbols)
        marks = _mix(np.arange(symbols).astype(np.uint64) + np.uint64(1 << 32))
        word = np.repeat(np.arange(len(words)), lengths)
        at = np.arange(len(letters)) - starts[word]
        # Prefix sums of each word's hash; position i holds that of the first i symbols. One more entry per word.
        reduced_sum, whole_sum = (
            _prefix(x * power[at], starts, lengths) for x in (marks[reduced.astype(np.int64)], _mix(letters.astype(np.uint64)))
        )
        base = starts + np.arange(len(words))  # where a word's prefix sums begin

        def key(hash_: np.ndarray, length: np.ndarray, word: np.ndarray, first: np.ndarray) -> np.ndarray:
            """Of a reduced word of ``length``, made of ``word``; ``first`` says which half is intact."""
            half = length // 2
            begin = np.where(first, 0, lengths[word] - (length - half))
            end = np.where(first, half, lengths[word])
            intact = (whole_sum[base[word] + end] - whole_sum[base[word] + begin]) * inverse[begin]
            return _mix(_mix(hash_ + length.astype(np.uint64)) ^ (intact * np.uint64(2) + first.astype(np.uint64)))

        every = np.arange(len(words))
        total = reduced_sum[base + lengths]
        own = np.stack([key(total, lengths, every, np.full(len(words), f)) for f in (True, False)], 1).ravel()

        before, after = reduced_sum[base[word] + at], reduced_sum[base[word] + at + 1]
        less = before + (total[word] - after) * _INVERSE
        found = [(word, key(less, lengths[word] - 1, word, at >= (lengths[word] - 1) // 2))]
        for symbol in range(symbols - 1):
            smaller = np.flatnonzero(reduced > symbol)
            w, i = word[smaller], at[smaller]
            other = total[w] + (marks[symbol] - marks[reduced[smaller].astype(np.int64)]) * power[i]
            found.append((w, key(other, lengths[w], w, i >= lengths[w] // 2)))
    of, keys = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((keys, of))
    of, keys = of[order], keys[order]
    new = np.concatenate([[True], (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])])[: len(of)]
    ends = np.cumsum(np.bincount(of[new], minlength=len(words)))
    lists = lambda offsets, values: pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(values.view(np.int64))
    )
    return lists(np.arange(len(words) + 1) * 2, own), lists(np.concatenate([[0], ends]), keys[new])


# An odd number and its inverse modulo 2 ** 64.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]), dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64, which spread every bit over all others."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _prefix(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of each word's first 0, 1, ... values; one entry more than the word has values."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    places = np.arange(len(values) + len(starts)) - np.repeat(np.arange(len(starts)), lengths + 1)
    return sums[places] - np.repeat(sums[starts], lengths + 1)


def with_forms(words: DataFrame, near: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n: the most frequent near word, the smallest of equals, if frequent enough."""
    rows = words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n"))
    pairs = near.select("word", F.lit(None).cast("long").alias("n"), "other", "other_n")
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("minus_n"), F.col("other").alias("form"))))
    found = (
        rows.unionByName(pairs)
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.count("other").alias("n_near"), best.alias("best"))
    )
    form_n = -F.col("best.minus_n")
    has = form_n >= RATIO * F.col("n")
    return found.select(
        "word", "n", "n_near", F.when(has, F.col("best.form")).alias("form"), F.when(has, form_n).alias("form_n")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of the words that have a form: roots are followed to their roots until none has one."""
    roots = stored(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = Observation()
        step = (
            roots.join(ahead, "root", "left")
            .observe(moved, F.count("further").alias("moved"))
            .select("word", F.coalesce("further", "root").alias("root"))
        )
        roots = stored(step, "roots")
        if not moved.get["moved"]:
            return roots
