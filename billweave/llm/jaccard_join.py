"""N-gram Jaccard join [op 7]: MinHash candidates, Bayesian pruning, exact verification.

Two texts are linked when the sets of their five-word shingles have a Jaccard similarity of 0.8 or more.

1. Equal texts are one class from here on (by a 64-bit hash of the text), so copies cost nothing further.
2. Each text gets ``BANDS * ROWS`` MinHash values. Texts that agree in all values of a band are candidates; a
   pair at the threshold misses every band with a probability of about 1e-7. Every text is joined with the
   smallest one of its band value only, never with all, and the connected components of these pairs are the
   groups inside which links can be.
3. A group is cut into blocks by hash, so that a block has at most about ``BLOCK_TEXTS`` texts and
   ``BLOCK_SHINGLES`` shingles, and each pair of blocks is a unit of work of bounded size. There, pairs are
   compared a few MinHash values at a time; a pair is dropped as soon as the posterior probability that it
   reaches the threshold falls below ``TOLERANCE``. The rest is verified exactly on the shingle sets.
4. A unit returns the number of links per text and a spanning forest of its links, not the links, so a group
   of n near copies returns n rows. The forests' connected components are the classes.

Words are runs of other than ASCII white space, as they are. A text of fewer than five words has one shingle of
all its words; a text without words has none, and is linked with equal texts only.

Defined results: a NULL text counts as empty. Rows equal in doc_id and text count as separate documents. A
NULL doc_id is kept and is the smallest. Empty tables give empty results. Other columns are not looked at by
the join; ``keep_one`` keeps them all.
"""

from __future__ import annotations

import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, own_columns, partitions_for, pieces, split_join, stored, text_of, unpacked
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 5
TOLERANCE = 1e-7
# MinHash values compared before each pruning.
STEP = 20
BLOCK_TEXTS = 400
BLOCK_SHINGLES = 400_000
SLICE_BYTES = 4_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _functions() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_077)
    flips = rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
    return flips, rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shingles of all texts in a row (repeats included), and how many each text has."""
    numbers: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    number = numbers.__getitem__
    coded = [list(map(number, t.encode().split())) for t in texts]
    words = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
    lengths = np.asarray([len(c) for c in coded], np.int64)
    flat = words[np.fromiter(itertools.chain.from_iterable(coded), np.int64, int(lengths.sum()))]
    counts = np.where(lengths >= SHINGLE, lengths - SHINGLE + 1, np.minimum(lengths, 1))
    begins = np.cumsum(lengths) - lengths
    starts = np.repeat(begins, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    width = np.repeat(np.minimum(lengths, SHINGLE), counts)
    out = np.zeros(len(starts), np.uint64)
    for k in range(SHINGLE):
        here = width > k
        out[here] = _mixed(out[here] * _MIX + flat[starts[here] + k])
    return out, counts


def signatures(hashed: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """MinHash values of each text that has shingles (rows in order), as 32-bit numbers."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    low = (hashed >> np.uint64(32)).astype(np.uint32)
    out = np.empty((BANDS * ROWS, len(starts)), np.uint32)
    if len(starts):
        for i, (flip, factor) in enumerate(zip(*_functions(), strict=True)):
            out[i] = np.minimum.reduceat((low ^ flip) * factor, starts)
    return out.T


def band_keys(values: np.ndarray) -> np.ndarray:
    """One key per text and band."""
    parts = values.reshape(len(values), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        keys = _mixed(keys * _MIX + parts[:, :, k])
    return keys


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn(
        "text_id", F.xxhash64("text")
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """text_id, n_shingles and band keys of every document; equal texts of one slice are hashed once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE_BYTES):
            ids = batch.column("text_id").to_pylist()
            first: dict[int, int] = {}
            for i, name in enumerate(ids):
                first.setdefault(name, i)
            place = {name: k for k, name in enumerate(first)}
            texts = batch.column("text").take(pa.array(list(first.values()), pa.int32())).to_pylist()
            hashed, counts = shingles(texts)
            keys = np.zeros((len(texts), BANDS), np.uint64)
            keys[counts > 0] = band_keys(signatures(hashed, counts))
            some = (counts > 0).tolist()
            rows_ = keys.view(np.int64).tolist()
            order = [place[name] for name in ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_id"),
                    pa.array(counts[order]),
                    pa.array([rows_[k] if some[k] else [] for k in order], pa.list_(pa.int64())),
                ],
                ["doc_id", "text_id", "n_shingles", "bands"],
            )

    return rows.mapInArrow(run, "doc_id long, text_id long, n_shingles long, bands array<long>")


def least_matches(step: int = STEP, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number of compared values, the fewest equal ones with which a pair stays a candidate.

    Under a uniform prior, the posterior probability of a similarity of at least t after m of k equal values is
    the probability of at most m successes in k + 1 trials of chance t.
    """
    out = {}
    for k in range(step, BANDS * ROWS + 1, step):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
        out[k] = m
    return out


def surviving_pairs(values: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (numbers of texts) that Bayesian pruning leaves."""
    equal = np.zeros(len(left), np.int32)
    for k, least in least_matches().items():
        if not len(left):
            break
        for j in range(k - STEP, k):
            column = values[:, j]
            equal += column[left] == column[right]
        stay = equal >= least
        left, right, equal = left[stay], right[stay], equal[stay]
    return left, right


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether each pair's sets (sorted, distinct) reach the threshold, exactly."""
    sizes = np.asarray([len(s) for s in sets])
    if len(left) > 4 * len(sets):
        common = _common_by_matrix(sets, left, right)
    else:
        common = np.asarray(
            [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left, right, strict=True)], np.int64
        )
    either = sizes[left] + sizes[right] - common
    return common >= np.ceil(THRESHOLD * either - 1e-9)


def _common_by_matrix(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of intersections, from products of incidence matrices of some columns at a time."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.r_[True, flat[1:] != flat[:-1]]
    shared = np.repeat(np.diff(np.r_[np.flatnonzero(new), len(flat)]) > 1, np.diff(np.r_[np.flatnonzero(new), len(flat)]))
    owner, column = owner[shared], (np.cumsum(new) - 1)[shared]
    if not len(column):
        return np.zeros(len(left), np.int64)
    column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1
    product = np.zeros((len(sets), len(sets)), np.float32)
    width = 8192
    for begin in range(0, int(column[-1]) + 1, width):
        a, b = np.searchsorted(column, [begin, begin + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], column[a:b] - begin] = 1
        product += part @ part.T
    return np.round(product[left, right]).astype(np.int64)


def _unit_rows(unit: list[tuple], one: int, two: int) -> list[tuple[int, int, int | None]]:
    """(text_id, links, root) for the texts of a unit of two blocks: (text_id, copies, second block, values, set)."""
    ids = [u[0] for u in unit]
    copies = np.asarray([u[1] for u in unit])
    second = np.asarray([u[2] for u in unit])
    if one == two:
        left, right = np.triu_indices(len(unit), 1)
    else:
        left, right = (a.ravel() for a in np.meshgrid(np.flatnonzero(~second), np.flatnonzero(second), indexing="ij"))
    values = np.asarray([u[3] for u in unit])
    left, right = surviving_pairs(values, left, right)
    if not len(left):
        return []
    good = linked([u[4] for u in unit], left, right)
    left, right = left[good], right[good]
    links = np.bincount(left, copies[right], len(unit)) + np.bincount(right, copies[left], len(unit))
    parent = list(range(len(unit)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(ids[i], int(links[i]), ids[root(i)]) for i in np.flatnonzero(links).tolist()]


def _units(members: DataFrame) -> DataFrame:
    """Shingle sets and MinHash values of candidate texts, once for every pair of blocks they take part in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE_BYTES):
            hashed, counts = shingles(batch.column("text").to_pylist())
            values = iter(signatures(hashed, counts))
            edges = np.r_[0, np.cumsum(counts)].tolist()
            sets, kept = [], []
            for a, b in zip(edges, edges[1:], strict=False):
                sets.append(np.unique(hashed[a:b]).tobytes())
                kept.append(next(values).tobytes() if b > a else b"")
            same = [batch.column(c) for c in ("text_id", "copies", "group", "block", "blocks")]
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(kept, pa.binary()), pa.array(sets, pa.binary())],
                ["text_id", "copies", "group", "block", "blocks", "values", "shingles"],
            )

    schema = "text_id long, copies long, group long, block int, blocks int, values binary, shingles binary"
    hashed = members.select("text_id", "copies", "group", "block", "blocks", "text").mapInArrow(run, schema)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return hashed.select("*", other).select(
        "text_id",
        "copies",
        "group",
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        (F.col("block") > F.col("other")).alias("second"),
        "values",
        "shingles",
    )


def _links(units: DataFrame) -> DataFrame:
    """text_id, links and root, for each unit in which a text has links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def every() -> Iterator[tuple]:
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("group", "one", "two", "text_id", "copies", "second")]
                blobs = [batch.column(c) for c in ("values", "shingles")]
                for i, (group, one, two, name, copies, second) in enumerate(zip(*columns, strict=True)):
                    values = np.frombuffer(blobs[0][i].as_py(), np.uint32)
                    yield (group, one, two), (name, copies, second, values, np.frombuffer(blobs[1][i].as_py(), np.uint64))

        for (_, one, two), rows in itertools.groupby(every(), lambda r: r[0]):
            unit = {r[1][0]: r[1] for r in rows}  # a repeated row is there once
            found = _unit_rows(list(unit.values()), one, two)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[i] for f in found], pa.int64()) for i in range(3)], ["text_id", "links", "root"]
                )

    spread = units.repartition(partitions_for(units.sparkSession), "group", "one", "two")
    return spread.sortWithinPartitions("group", "one", "two").mapInArrow(run, "text_id long, links long, root long")


def _results(docs: DataFrame) -> DataFrame:
    """One row per distinct text: its first doc_id, copies, links to other texts' documents, class number."""
    rows = _identified(docs)
    texts = stored(
        _keyed(rows)
        .groupBy("text_id")
        .agg(
            F.min(F.struct("doc_id")).getField("doc_id").alias("first_id"),
            F.count("*").alias("copies"),
            F.max("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
        ),
        "jaccard-texts",
    )
    banded = texts.select("text_id", F.explode("bands").alias("band")).repartition(partitions_for(docs.sparkSession), "band")
    heads = banded.groupBy("band").agg(F.min("text_id").alias("head"))
    candidates = banded.join(heads, "band").filter("text_id <> head").select(F.col("text_id").alias("a"), F.col("head").alias("b"))
    groups = components(candidates).select(F.col("node").alias("text_id"), F.col("root").alias("group"))
    known = texts.select("text_id", "first_id", "copies", "n_shingles")
    grouped = stored(groups.join(known, "text_id"), "jaccard-groups")
    sizes = grouped.groupBy("group").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("all_shingles"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("all_shingles") / BLOCK_SHINGLES)).cast("int")
    sizes = stored(sizes.select("group", "n", blocks.alias("blocks")), "jaccard-sizes")
    placed = split_join(grouped, sizes, "group").withColumn(
        "block", F.pmod(F.xxhash64("text_id", F.lit(1)), "blocks").cast("int")
    )
    # The one row of each text that stands for it; so the shuffle is not by text alone.
    own = F.coalesce("doc_id", F.lit(0)).alias("own_id")
    members = rows.select("text_id", own, "text").join(
        placed.withColumn("own_id", F.coalesce("first_id", F.lit(0))).hint("shuffle_hash"), ["text_id", "own_id"]
    )
    found = stored(_links(_units(members)), "jaccard-links")
    roots = components(found.select(F.col("text_id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("text_id").agg(F.sum("links").alias("links"))
    of_text = (
        known.join(links, "text_id", "left")
        .join(roots.withColumnRenamed("node", "text_id"), "text_id", "left")
        .select(
            "text_id", "first_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "text_id").alias("root")
        )
    )
    return stored(of_text, "jaccard-classes")


def _firsts(of_text: DataFrame) -> DataFrame:
    """Of each class, its number of texts, its smallest doc_id and that document's text."""
    return of_text.groupBy("root").agg(F.min(F.struct("first_id", "text_id")).alias("least"), F.count("*").alias("n")).select(
        "root", "n", F.col("least.first_id").alias("class_id"), F.col("least.text_id").alias("class_text")
    )


def join(docs: DataFrame) -> DataFrame:
    """One row per document.

    copy_of: the smallest doc_id with an equal text; n_copies: documents with an equal text; class_id: the
    smallest doc_id it is connected with by links; n_links: other documents linked with it, equal ones too.
    """
    of_text = _results(docs)
    named = split_join(of_text, stored(_firsts(of_text), "jaccard-firsts"), "root")
    return (
        _identified(docs)
        .select("doc_id", "text_id")
        .join(named, "text_id")
        .select(
            "doc_id",
            F.col("first_id").alias("copy_of"),
            F.col("copies").alias("n_copies"),
            "class_id",
            (F.col("links") + F.col("copies") - 1).alias("n_links"),
        )
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with only the document of the smallest doc_id of every class, all columns as they were."""
    first = _firsts(_results(docs)).select(
        F.coalesce("class_id", F.lit(0)).alias("own_id"), F.col("class_text").alias("text_id")
    )
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("own_id"),
        F.xxhash64(text_of()).alias("text_id"),
        F.struct(*own_columns(docs)).alias(ROW),
    )
    kept = rows.join(first.hint("shuffle_hash"), ["text_id", "own_id"])
    return kept.dropDuplicates(["text_id", "own_id"]).select(*unpacked(docs))
