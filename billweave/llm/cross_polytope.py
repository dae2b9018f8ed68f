"""Approximate nearest neighbours by cross-polytope hashing [op 13], with exact reranking by inner product.

A vector is put through three rounds of random signs and a Walsh-Hadamard transform, which act like a random
rotation in O(d log d), and is assigned to the nearest signed axis. That is one hash value; a table's cell joins
as many of them as the number of rows asks for. Rows are indexed in a few tables, once each; queries visit many cells
of each table, those first whose axes are nearest to the query (multiprobe). Rows and queries of a cell meet in one
task, which computes their inner products in double precision and hands on each query's best.

Inner products become nearness of directions by one more coordinate, which brings the rows of a norm band to the
same length. Bands are powers of two, each with an index of its own; a band of equal norms needs no such coordinate.

The number of cells to visit is fitted: up to ``SAMPLE`` queries are compared with all rows by brute force, and the
smallest number by which ``recall`` of their neighbours is found is used for all. Queries that find fewer than k rows
visit eight times as many cells, until they have them or all cells are visited, so nobody gets less than there is.

Scale: equal vectors are searched once, and of rows with equal vectors only the k + 1 smallest ids can be among
anyone's k nearest, so a vector that a third of the rows share costs no more than others. Cells with more than
``CELL_ROWS`` rows or queries are split into units of that size, by a hash of the id. Tables that are broadcast are
measured first.

Defined results: a row is a pair of id and vector. Rows with a NULL id, or a vector that is NULL, zero or holds NULL or
non-finite components, take no part; repeated rows count once; vectors of another length are not compared. A query
isn't its own neighbour, but equal vectors under other ids are. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billweave.operators.lookups import Lookup, join_lookup, settle

from .common import split_join, stored

K_NEAREST = 20
TABLES = 4
RECALL = 0.95
# Queries that the number of visited cells is fitted on, at most.
SAMPLE = 256
# Rows, and queries, that meet in one unit of work, about; a cell has at most half as many rows on average.
CELL_ROWS = 4096
# A table has fewer cells than this, whatever the number of rows.
MOST_CELLS = 1 << 40
# Norms of a band that differ by less than this share count as equal.
EQUAL_NORMS = 1e-3
SEED = 20_061
_GROUP = "dim int, band int"


def nearest(vectors: DataFrame, queries: Column, k: int = K_NEAREST, recall: float = RECALL, tables: int = TABLES) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest of ``vectors`` (vec_id, embedding).

    ``queries`` says which rows are queries.
    """
    rows = stored(_usable(vectors, queries), "vectors")
    indexed, groups = _with_groups(_few_copies(rows, k + 1))
    wanted = _one_per_vector(rows.filter("is_query").select("vec_id", "dim", "vec"))
    asked = wanted.groupBy("dim", "vec").agg(F.min("rep").alias("rep"), F.count(F.lit(1)).alias("n"))
    totals = groups.table.groupBy("dim").agg(F.sum("n_rows").alias("in_dim"))
    asked = stored(join_lookup(asked, groups.reduced_to(totals), {"dim": "dim"}, "inner"), "queries")
    named = groups.table.select(F.col("dim").alias("of_dim"), "band", "low", "high", "n_rows")
    probed = stored(join_lookup(asked, groups.reduced_to(named), {"dim": "of_dim"}, "inner"), "queries")
    probes = fitted_probes(indexed, probed, k, recall, tables)
    found = None
    cells = stored(_row_cells(indexed, tables), "cells")
    all_cells = _most_cells(groups.table)
    while True:
        best = stored(_search(cells, probed, k + 1, probes, tables), "found")
        enough = F.size("found") >= F.least(F.lit(k + 1), F.col("in_dim"))
        judged = asked.select("rep", "in_dim").join(best, "rep", "left")
        done = F.coalesce(enough, F.lit(False))
        found = best if found is None else found.unionByName(best)
        short = judged.filter(~done).select("rep")
        if probes >= all_cells or short.isEmpty():
            break
        found = stored(found.join(short, "rep", "left_anti"), "found")
        probed = stored(probed.join(short, "rep", "left_semi"), "queries")
        probes *= 8
    counted = asked.select("rep", "n").join(found, "rep")
    each = split_join(wanted.select("vec_id", "rep"), counted, "rep")
    is_own = lambda x: x["same"] & (x["vec_id"] == F.col("vec_id"))
    others = F.slice(F.filter("found", lambda x: ~is_own(x)), 1, k)
    return each.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score"
    )


def _usable(vectors: DataFrame, queries: Column) -> DataFrame:
    """vec_id, is_query, vec, dim, norm of the rows that take part, once each."""
    vec = F.col("embedding")
    inf = F.lit(float("inf")).cast("double")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == inf))
    largest = F.array_max(F.transform(vec, lambda x: F.abs(x.cast("double"))))
    parts = F.aggregate("vec", F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") / F.col("largest"), F.lit(2.0)))
    return (
        vectors.filter(F.col("vec_id").isNotNull() & vec.isNotNull() & ~bad)
        .select(F.col("vec_id").cast("long"), F.coalesce(queries, F.lit(False)).alias("is_query"), vec.alias("vec"), largest.alias("largest"))
        .filter("largest > 0")
        .select("vec_id", "is_query", "vec", F.size("vec").alias("dim"), (F.col("largest") * F.sqrt(parts)).alias("norm"))
        .groupBy("vec_id", "vec")
        .agg(F.max("is_query").alias("is_query"), F.first("dim").alias("dim"), F.first("norm").alias("norm"))
    )


def _few_copies(rows: DataFrame, copies: int) -> DataFrame:
    """Without the rows that lose every tie: of equal vectors, those beyond the smallest ids."""
    by = Window.partitionBy("vec").orderBy("vec_id")
    return rows.withColumn("copy", F.row_number().over(by)).filter(F.col("copy") <= copies).drop("copy", "is_query")


def _with_groups(rows: DataFrame) -> tuple[DataFrame, Lookup]:
    """With the band of the norm, and the number and the norms of the rows of the same length and band."""
    band = F.least(F.greatest(F.round(F.log2("norm")), F.lit(-2000)), F.lit(2000)).cast("int")
    rows = stored(rows.withColumn("band", band), "banded-vectors")
    groups = rows.groupBy("dim", "band").agg(
        F.min("norm").alias("low"), F.max("norm").alias("high"), F.count(F.lit(1)).alias("n_rows")
    )
    groups = settle(groups, "bands")
    return join_lookup(rows, groups, {"dim": "dim", "band": "band"}, "inner"), groups


def _one_per_vector(queries: DataFrame) -> DataFrame:
    """Queries with ``rep``, the name of their vector: the smallest id that has it, and a hash of it."""
    reps = queries.groupBy("vec").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n"))
    return split_join(queries, reps, "vec").select(
        "vec_id", "dim", "vec", F.struct("first", F.xxhash64("vec").alias("hash")).alias("rep")
    )


def _most_cells(groups: DataFrame) -> int:
    """No table has more cells: there are less than ``4 * (dim + 1)`` axes, and hashes are joined for rows only."""
    of = 4 * (F.col("dim") + 1) * F.greatest(F.lit(1.0), 2 * F.col("n_rows") / CELL_ROWS)
    return int(groups.agg(F.max(of)).first()[0] or 0)


class _Hash:
    """The hash of one table for the vectors of one length and norm band."""

    def __init__(self, dim: int, low: float, high: float, n_rows: int, table: int):
        self.high = high
        self.grows = high - low > EQUAL_NORMS * high
        self.size = 1 << max(int(dim + self.grows - 1).bit_length(), 1)
        self.axes = 2 * self.size
        self.functions = 1
        while self.axes**self.functions * CELL_ROWS < 2 * n_rows and self.axes ** (self.functions + 1) < MOST_CELLS:
            self.functions += 1
        self.cells = self.axes**self.functions
        rng = np.random.default_rng([SEED, table, self.size])
        self.signs = rng.choice([-1.0, 1.0], (self.functions, 3, self.size))

    def _turned(self, x: np.ndarray, function: int) -> np.ndarray:
        for signs in self.signs[function]:
            x = _hadamard(x * signs)
        return x

    def _padded(self, x: np.ndarray, is_row: bool) -> np.ndarray:
        """Rows at a common length of 1, by one more coordinate; queries at length 1, with 0 there."""
        scale = self.high if self.grows and is_row else np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        padded = np.zeros((len(x), self.size))
        padded[:, : x.shape[1]] = x / scale
        if self.grows and is_row:
            padded[:, x.shape[1]] = np.sqrt(np.maximum(1 - (padded**2).sum(1), 0))
        return padded

    def cells_of(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row: the signed axes nearest to it, as one number."""
        padded, cell = self._padded(x, True), np.zeros(len(x), np.int64)
        for f in range(self.functions):
            turned = self._turned(padded, f)
            axis = np.abs(turned).argmax(1)
            cell = cell * self.axes + 2 * axis + (turned[np.arange(len(x)), axis] < 0)
        return cell

    def probes(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` best cells for each query, best first: the largest sums of components along the axes."""
        padded = self._padded(x, False)
        cells, sums = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for f in range(self.functions):
            turned = self._turned(padded, f)
            along = np.stack([turned, -turned], 2).reshape(len(x), -1)
            axes = np.argsort(-along, axis=1, kind="stable")[:, :n]
            sums = (sums[:, :, None] + np.take_along_axis(along, axes, 1)[:, None, :]).reshape(len(x), -1)
            cells = (cells[:, :, None] * self.axes + axes[:, None, :]).reshape(len(x), -1)
            best = np.argsort(-sums, axis=1, kind="stable")[:, :n]
            sums, cells = np.take_along_axis(sums, best, 1), np.take_along_axis(cells, best, 1)
        return cells


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row."""
    n, d = x.shape
    half = 1
    while half < d:
        pairs = x.reshape(n, d // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, d)
        half *= 2
    return x / math.sqrt(d)


def _matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _hashed(batch: pa.RecordBatch, tables: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[_Hash]]]:
    """Row numbers, vectors and hashes of each length and band in a batch."""
    names = ("dim", "band", "low", "high", "n_rows")
    columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
    keys = np.stack(columns[:2], 1)
    _, first, of = np.unique(keys, axis=0, return_index=True, return_inverse=True)
    for group, at in enumerate(first):
        mine = np.flatnonzero(of.ravel() == group)
        dim, _, low, high, n_rows = (c[at].item() for c in columns)
        vectors = _matrix(batch.column("vec").take(pa.array(mine)), dim)
        yield mine, vectors, [_Hash(dim, low, high, n_rows, t) for t in range(tables)]


def _row_cells(indexed: DataFrame, tables: int) -> DataFrame:
    """Rows once per table, with their cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, tables), np.int64)
            for mine, vectors, hashes in _hashed(batch, tables):
                for t, h in enumerate(hashes):
                    found[mine, t] = h.cells_of(vectors) * tables + t
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * tables, pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("vec_id", "dim", "band", "vec")] + [lists], ["vec_id", "dim", "band", "vec", "cells"]
            )

    vec = indexed.schema["vec"].dataType.simpleString()
    return indexed.mapInArrow(run, f"vec_id long, {_GROUP}, vec {vec}, cells array<long>")


def _query_cells(probed: DataFrame, probes: int, tables: int) -> DataFrame:
    """Queries with the cells that they visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            widest = 4 * (max(whole.column("dim").to_pylist(), default=0) + 1)
            step = max(1, (1 << 22) // (probes * widest))
            for begin in range(0, whole.num_rows, step):
                batch = whole.slice(begin, step)
                found: list = [None] * batch.num_rows
                for mine, vectors, hashes in _hashed(batch, tables):
                    cells = np.concatenate([h.probes(vectors, probes) * tables + t for t, h in enumerate(hashes)], 1)
                    for i, row in zip(mine, cells):
                        found[i] = row
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in ("rep", "dim", "band", "vec")] + [pa.array(found, pa.list_(pa.int64()))],
                    ["rep", "dim", "band", "vec", "cells"],
                )

    vec, rep = (probed.schema[c].dataType.simpleString() for c in ("vec", "rep"))
    columns = ["rep", "dim", "band", "vec", "low", "high", "n_rows"]
    return probed.select(*columns).mapInArrow(run, f"rep {rep}, {_GROUP}, vec {vec}, cells array<long>")


def fitted_probes(indexed: DataFrame, probed: DataFrame, k: int, recall: float, tables: int) -> int:
    """Cells per table that a query visits, so that ``recall`` of a sample's neighbours are found."""
    n = probed.count()
    few = probed.filter(F.pmod(F.col("rep.hash"), F.lit(max(1, n // (4 * SAMPLE)))) == 0)
    sample = few.orderBy(F.hash("rep"), "rep", "band").limit(SAMPLE).collect()
    if not sample:
        return 1
    by_dim: dict[int, list[int]] = {}
    for i, row in enumerate(sample):
        by_dim.setdefault(row.dim, []).append(i)
    asked = {dim: (np.array(i), np.array([sample[j].vec for j in i], np.float64)) for dim, i in by_dim.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best rows of a task for each query of the sample, with the rows' cells."""
        best: dict[int, list[tuple]] = {}
        for batch in batches:
            ids, bands = batch.column("vec_id").to_numpy(), batch.column("band").to_numpy()
            for mine, vectors, hashes in _hashed(batch, tables):
                dim = vectors.shape[1]
                if dim not in asked:
                    continue
                of, queries = asked[dim]
                cells = np.stack([h.cells_of(vectors) for h in hashes], 1)
                scores = queries @ vectors.T
                top = np.argpartition(-scores, min(k, len(mine) - 1), axis=1)[:, : k + 1]
                for i, at, s in zip(of, top, np.take_along_axis(scores, top, 1)):
                    rows = [(-x, int(ids[mine[j]]), int(bands[mine[j]]), cells[j].tolist()) for j, x in zip(at, s)]
                    best[i] = sorted(best.get(i, []) + rows)[: k + 1]
        flat = [(i, -s, v, b, c) for i, rows in best.items() for s, v, b, c in rows]
        kinds = (pa.int32(), pa.float64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
        columns = zip(*flat) if flat else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["query", "score", "vec_id", "band", "cells"])

    each = indexed.mapInArrow(run, "query int, score double, vec_id long, band int, cells array<long>")
    by = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    true = each.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k + 1).collect()
    stats = {(r.dim, r.band): (r.low, r.high, r.n_rows) for r in sample}
    # The first number of probes, doubled until enough is found, then the smallest that is enough.
    hashes = {g: [_Hash(g[0], *s, t) for t in range(tables)] for g, s in stats.items()}
    most = max(h[0].cells for h in hashes.values())
    pairs = [(r.query, (sample[r.query].dim, r.band), r.cells) for r in true]
    pairs = [p for p in pairs if p[1] in hashes]
    n = min(64, most)
    while True:
        probes = {}
        for g, h in hashes.items():
            of, queries = asked[g[0]]
            lists = [x.probes(queries, n) for x in h]
            probes |= {(i, g): [lst[j] for lst in lists] for j, i in enumerate(of)}
        ranks = []
        for query, group, cells in pairs:
            hits = [np.flatnonzero(p == c) for p, c in zip(probes[query, group], cells)]
            ranks.append(min((int(x[0]) + 1 for x in hits if len(x)), default=most + 1))
        needed = sorted(ranks)[min(math.ceil(recall * len(ranks)), len(ranks)) - 1] if ranks else 1
        if needed <= n or n >= most:
            return min(needed, most)
        n = min(4 * n, most)


def _search(cells: DataFrame, probed: DataFrame, k: int, probes: int, tables: int) -> DataFrame:
    """rep and found: the k best rows of the cells that each query visits."""
    unit = ["dim", "band", "cell"]
    visits = stored(_query_cells(probed, probes, tables), "visits")
    rows = cells.select("vec_id", "dim", "band", "vec", F.explode("cells").alias("cell"))
    asked = visits.select("rep", "dim", "band", "vec", F.explode("cells").alias("cell"))
    sizes = (
        rows.select(*unit, F.lit(1).alias("row"), F.lit(0).alias("query"))
        .unionByName(asked.select(*unit, F.lit(0).alias("row"), F.lit(1).alias("query")))
        .groupBy(*unit)
        .agg(F.sum("row").alias("rows"), F.sum("query").alias("queries"))
        .filter((F.col("rows") > CELL_ROWS) | (F.col("queries") > CELL_ROWS))
        .select(*unit, F.ceil(F.col("rows") / CELL_ROWS).alias("row_parts"), F.ceil(F.col("queries") / CELL_ROWS).alias("query_parts"))
    )
    large = settle(sizes, "large-cells")
    keys = {c: c for c in unit}
    all_parts = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    rows = join_lookup(rows, large, keys, "left").na.fill(1, ["row_parts", "query_parts"])
    rows = rows.select(
        *unit, F.pmod(F.xxhash64("vec_id"), F.col("row_parts")).alias("row_part"),
        all_parts(F.col("query_parts")).alias("query_part"), "vec_id", "vec",
    )
    asked = join_lookup(asked, large, keys, "left").na.fill(1, ["row_parts", "query_parts"])
    asked = asked.select(
        *unit, all_parts(F.col("row_parts")).alias("row_part"),
        F.pmod(F.xxhash64("rep"), F.col("query_parts")).alias("query_part"), "rep", "vec",
    )
    parts = [*unit, "row_part", "query_part"]

    def best(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[pa.Table] = [_no_hits.slice(0, 0)]
        if queries.num_rows and rows.num_rows:
            dim = queries.column("dim")[0].as_py()
            order = np.argsort(rows.column("vec_id").to_numpy(), kind="stable")
            ids = rows.column("vec_id").to_numpy()[order]
            vectors = _matrix(rows.column("vec").combine_chunks(), dim)[order]
            wanted = _matrix(queries.column("vec").combine_chunks(), dim)
            for begin in range(0, len(wanted), 256):
                part = slice(begin, begin + 256)
                of, at, score = _best_of(wanted[part], vectors, ids, k)
                same = (wanted[part][of] == vectors[at]).all(1)
                reps = queries.column("rep").combine_chunks().take(pa.array(begin + of))
                out.append(
                    pa.table({"rep": reps, "vec_id": ids[at], "score": score, "same": pa.array(same)}, schema=_no_hits.schema)
                )
        return pa.concat_tables(out)

    rep = probed.schema["rep"].dataType.simpleString()
    hits = asked.groupBy(*parts).cogroup(rows.groupBy(*parts)).applyInArrow(
        best, f"rep {rep}, vec_id long, score double, same boolean"
    )
    hits = hits.distinct()  # a row is found in several tables
    by = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    hits = hits.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
    listed = F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score", "same")))
    return hits.groupBy("rep").agg(listed.alias("found"))


_no_hits = pa.table(
    {
        "rep": pa.array([], pa.struct([("first", pa.int64()), ("hash", pa.int64())])),
        "vec_id": pa.array([], pa.int64()),
        "score": pa.array([], pa.float64()),
        "same": pa.array([], pa.bool_()),
    }
)


def _best_of(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, row and score of each query's k best rows; equal scores go to smaller ids.

    The matrix product only narrows the choice: its last bits depend on the shape of the matrices. The scores
    are sums in the order of the components.
    """
    rough = queries @ rows.T
    if rows.shape[0] > k:
        bound = -np.partition(-rough, k - 1, axis=1)[:, k - 1 : k]
        slack = 1e-9 * np.abs(queries).max(1, keepdims=True) * np.abs(rows).max(initial=0) * rows.shape[1]
        of, at = np.nonzero(rough >= bound - slack)
    else:
        of, at = (x.ravel() for x in np.indices(rough.shape))
    score = np.cumsum(queries[of] * rows[at], axis=1)[:, -1]
    order = np.lexsort((ids[at], -score, of))
    of, at, score = of[order], at[order], score[order]
    place = np.arange(len(of)) - np.searchsorted(of, of)
    return of[place < k], at[place < k], score[place < k]
