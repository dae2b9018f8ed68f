"""Quality rules [op 9]: base counts, and a log-likelihood ratio of hashed n-grams between trusted and raw text.

Two multinomials over hashed n-grams are counted: one over all documents (raw), one over trusted documents
(target). A document's score is the sum of its n-grams' log ratios over their number plus ``PRIOR_NGRAMS``;
documents below a threshold derived from the trusted documents' scores are rejected. Only built-in
functions are used.

N-grams are words, and pairs of word shapes (runs of letters and of digits become one character), so that
text of unknown words still has n-grams that both multinomials have seen.

Defined results: a NULL text counts as empty, has no words and fails the base rules. Repeated rows are each
judged alike. A NULL ``doc_id`` is kept. Without any trusted document nothing is rejected by the ratio. Other
columns of the input are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, carried, let, number_array, packed, text_of, unpacked, words_of

SYMBOLS = "#*$%&|<>"
# A power of two.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Hash buckets of words and of shape pairs, each.
BUCKETS = 4096
# Ids of trusted documents are broadcast up to so many; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
# N-grams of ratio 0 that every document is taken to have besides its own.
PRIOR_NGRAMS = 40
# A document is rejected below: median of trusted scores - SPREADS * (median - 5 % quantile).
SPREADS = 4.0


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the base columns of the contract, with the array ``word_hashes``."""
    text = F.col("text")
    rest = carried(docs)
    counted = docs.select("doc_id", text_of().alias("text"), *rest).select(
        "doc_id", "text", words_of(text).alias("words"), *rest
    )
    hashed = counted.select(
        "doc_id",
        "text",
        F.transform("words", lambda w: F.xxhash64(w)).alias("word_hashes"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        *rest,
    )
    grams = F.when(F.size("word_hashes") >= WINDOW, _windows(F.col("word_hashes"))).otherwise(
        F.array().cast("array<bigint>")
    )
    lines = F.filter(F.split(text, "\n"), lambda line: F.ltrim(line, F.lit(SPACE_CHARS)) != "")
    split = hashed.select("doc_id", "text", "word_hashes", "word_chars", grams.alias("grams"), lines.alias("lines"), *rest)
    repeats = F.size(F.array_distinct("grams")) < F.size("grams")
    return split.select(
        "doc_id",
        "text",
        "word_hashes",
        F.size("word_hashes").cast("long").alias("n_words"),
        "word_chars",
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(repeats, _covered(F.col("grams"))).otherwise(0).cast("long").alias("n_repeat_words"),
        *rest,
    )


def _windows(hashes: Column) -> Column:
    """A hash of each window of ``WINDOW`` words, made of those of its halves, and these of theirs."""

    def doubled(halves: Column, width: int) -> Column:
        def pairs(n: Column) -> Column:
            later = F.slice(halves, F.lit(width + 1), n)
            return F.zip_with(F.slice(halves, F.lit(1), n), later, lambda a, b: F.xxhash64(a, b))

        return let(F.size(halves) - width, pairs)

    def doubled_once(halves: Column, width: int) -> Column:
        return let(halves, lambda h: doubled(h, width))  # a second argument of the lambda would be its index

    width = 1
    while width < WINDOW:
        hashes = doubled_once(hashes, width)
        width *= 2
    return hashes


def _covered(grams: Column) -> Column:
    """Number of words inside windows whose hash is found twice or more."""

    def repeated(pairs: Column) -> Column:
        def kept(x: Column, k: Column) -> Column:
            before, after = F.get(pairs, k - 1), F.get(pairs, k + 1)
            same = (x["g"] == before["g"]) | (x["g"] == after["g"])
            return F.when(F.coalesce(same, F.lit(False)), x["i"])

        return F.array_sort(F.array_compact(F.transform(pairs, kept)))

    def total(starts: Column) -> Column:
        own = F.transform(
            starts, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW)))
        )
        return F.aggregate(own, F.lit(0), lambda a, x: a + x)

    pairs = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return let(pairs, lambda p: let(repeated(p), total))


def ngram_buckets(word_hashes: Column, text: Column) -> Column:
    """Bucket numbers of a text's words (0 up to BUCKETS) and shape pairs (BUCKETS up to 2 * BUCKETS)."""
    return F.concat(F.transform(word_hashes, _word_bucket), _shape_buckets(text))


def _word_bucket(word_hash: Column) -> Column:
    return F.pmod(word_hash, F.lit(BUCKETS)).cast("int")


def _shape_buckets(text: Column) -> Column:
    shape = F.regexp_replace(F.regexp_replace(text, r"\p{L}+", "a"), r"\p{N}+", "0")
    shapes = F.transform(words_of(shape), lambda w: F.xxhash64(w))
    return let(
        shapes,
        lambda s: F.transform(
            s, lambda h, i: (F.pmod(F.xxhash64(h, F.get(s, i + 1)), F.lit(BUCKETS)) + BUCKETS).cast("int")
        ),
    )


def trusted_ids(labels: DataFrame, broadcast: int = BROADCAST_IDS) -> DataFrame:
    """Ids of all trusted documents (quality 1); marked for a broadcast if there are at most ``broadcast`` of them."""
    ids = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return F.broadcast(ids) if ids.count() <= broadcast else ids


def fit_ratio(docs: DataFrame, trusted: DataFrame) -> list[float] | None:
    """Log ratios per bucket; all documents are counted. None without trusted documents."""
    marked = docs.select("doc_id", "text").join(trusted.withColumn("is_trusted", F.lit(1)), "doc_id", "left")
    hashed = marked.select(
        text_of().alias("text"), F.coalesce("is_trusted", F.lit(0)).alias("is_trusted")
    ).select("is_trusted", "text", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("word_hashes"))
    counts = (
        hashed.select("is_trusted", F.explode(ngram_buckets(F.col("word_hashes"), F.col("text"))).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("raw"), F.sum("is_trusted").alias("target"))
        .collect()  # one row per bucket
    )
    raw, target = [0] * (2 * BUCKETS), [0] * (2 * BUCKETS)
    for row in counts:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not sum(target):
        return None
    ratios: list[float] = []
    for part in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        all_raw, all_target = sum(raw[part]) + BUCKETS, sum(target[part]) + BUCKETS
        ratios += [
            math.log((t + 1) / all_target) - math.log((r + 1) / all_raw)
            for r, t in zip(raw[part], target[part], strict=True)
        ]
    return ratios


def _score(word_hashes: Column, text: Column, ratios: list[float]) -> Column:
    """The ratios of a text's :func:`ngram_buckets`, which are as many shape pairs as words, added up in their order."""
    model = number_array(ratios)
    words = F.aggregate(word_hashes, F.lit(0.0), lambda a, h: a + F.get(model, _word_bucket(h)))
    total = F.aggregate(_shape_buckets(text), words, lambda a, b: a + F.get(model, b))
    return total / (2 * F.size(word_hashes) + PRIOR_NGRAMS)


def fit_threshold(docs: DataFrame, trusted: DataFrame, ratios: list[float]) -> float:
    """The score below which documents are rejected, from the trusted documents' scores."""
    texts = docs.select("doc_id", "text").join(trusted, "doc_id", "left_semi").select(text_of().alias("text"))
    hashed = texts.select("text", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("word_hashes"))
    scored = hashed.select(_score(F.col("word_hashes"), F.col("text"), ratios).alias("score"))
    low, middle = scored.agg(F.percentile_approx("score", [0.05, 0.5], 10_000)).first()[0]
    return middle - SPREADS * max(middle - low, 1e-3)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: base columns, ``base_failed``, ``score`` and ``kept``."""
    trusted = trusted_ids(labels)
    ratios = fit_ratio(docs, trusted)
    counted = base_counts(docs)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *carried(docs)]
    if ratios is None:
        return counted.select(
            *columns, failed.alias("base_failed"), (~failed).alias("kept"), F.lit(0.0).alias("score")
        )
    threshold = fit_threshold(docs, trusted, ratios)
    scored = counted.select(
        *columns,
        failed.alias("base_failed"),
        _score(F.col("word_hashes"), F.col("text"), ratios).alias("score"),
    )
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))




def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns as they were."""
    return judge(packed(docs), labels).filter("kept").select(*unpacked(docs))
