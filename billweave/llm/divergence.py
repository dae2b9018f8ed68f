"""Source divergence audit [op 11]: how far the term distributions of a language's sources lie from each other.

A group is a language and a source. A language keeps the terms of at least ``min_docs`` of its documents, and a
group gives each kept term a smoothed share in units of 1e-9, in whole numbers throughout. The matrix of groups by
kept terms is cut into blocks: rows by a hash of the source, columns by a hash of the term, some ``ROWS`` by some
``COLUMNS``. Each pair of row blocks is one task's work per column block, done over two K²-trees
(:mod:`billweave.llm.k2tree`): all-zero quadrants are priced from the two groups' shares of an unseen term, the other
leaves are visited for all pairs of their groups together. Terms of a column block are ordered by how many groups
have them, which keeps zeros side by side. Columns that a unit never sees are priced at once, at the end.

Scale: terms are counted per task before the shuffle, so a hot source is no hot task. The cells of a row block are
copied once per other row block of their language, which grows like the result, all pairs of sources. What is
broadcast is measured first (:func:`billweave.operators.lookups.join_lookup`).

Defined results: NULL text, language or source counts as ''. Repeated rows count each. A language without a kept
term has distance 0 between all its sources, and no terms. An empty table gives an empty result. Other columns are
not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billweave.operators.lookups import join_lookup, settle

from .common import stored
from .k2tree import K2Tree, height_of, pair_distances

MIN_DOCS = 30
TOP_TERMS = 50
# Shares are in units of one over SCALE, of counts that are SMOOTHING higher.
SCALE = 1_000_000_000
SMOOTHING = 5
# Groups and terms of a block of the matrix, about.
ROWS = 192
COLUMNS = 2048
# Terms that a task counts before it hands them on.
HELD_TERMS = 400_000
_SLICE_BYTES = 4_000_000
# A term is a run of ASCII letters and of bytes of other characters; only A-Z become lower case.
_TERM_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
_COUNTED = "lang string, source string, term string, n long, docs long"
_PRICED = "lang string, one string, two string, value long"
_PAIRS = pa.schema([("lang", pa.string()), ("one", pa.string()), ("two", pa.string()), ("value", pa.int64())])


def audit(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    rows: int = ROWS,
    columns: int = COLUMNS,
) -> DataFrame:
    """lang, source, part, item, value, rank: distances to the other sources, and the most overused terms."""
    counted = stored(term_counts(docs), "terms")
    is_term = F.col("term") != ""
    kept = stored(
        counted.filter(is_term)
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= min_docs)
        .drop("docs"),
        "kept-terms",
    )
    cells = stored(counted.filter(is_term).drop("docs").join(kept, ["lang", "term"]), "cells")
    groups = settle(_groups(counted, kept, cells, rows, columns), "groups")
    cells = join_lookup(cells, groups, {"lang": "lang", "source": "source"}, "inner").select(
        "lang",
        "source",
        "term",
        _share(F.col("n"), F.col("total"), F.col("kept")).alias("share"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("lang_share"),
        "row_block",
        "row_blocks",
        F.pmod(F.xxhash64("term"), F.col("column_blocks")).alias("column_block"),
    )
    overused = cells.filter("share > lang_share").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.col("share") - F.col("lang_share")).alias("value"),
    )
    distances = _distances(cells, groups.table)
    return _ranked(distances).unionByName(_ranked(overused).filter(F.col("rank") <= top_terms))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, its occurrences and documents in the group; the term '' stands for the group itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for key, text in zip(keys, texts):
                n, docs = counts.setdefault(key, (Counter(), Counter()))
                _count(text.as_py(), n, docs)
            if sum(len(n) for n, _ in counts.values()) > HELD_TERMS:
                yield from _counted(counts)
                counts = {}
        yield from _counted(counts)

    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = rows.mapInArrow(run, _COUNTED)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _count(text: bytes, n: Counter, docs: Counter) -> None:
    """Adds a document's terms; a very long text is cut at blanks, so that its terms are never all held at once."""
    cleared = text.translate(_TERM_BYTES)
    seen: set[bytes] = set()
    begin = 0
    while begin < len(cleared):
        end = cleared.find(b" ", begin + _SLICE_BYTES)
        end = len(cleared) if end < 0 else end
        terms = cleared[begin:end].split()
        n.update(terms)
        seen.update(terms)
        begin = end
    docs.update(seen)


def _counted(counts: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in counts.items():
        terms = [b"", *n]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array([0, *n.values()], pa.int64()),
                pa.array([0, *(docs[t] for t in n)], pa.int64()),
            ],
            ["lang", "source", "term", "n", "docs"],
        )


def _groups(counted: DataFrame, kept: DataFrame, cells: DataFrame, rows: int, columns: int) -> DataFrame:
    """Every group with its and its language's totals, and its place among the blocks of the matrix."""
    groups = counted.filter("term = ''").select("lang", "source")
    langs = (
        groups.groupBy("lang")
        .agg(F.count(F.lit(1)).alias("sources"))
        .join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total")), "lang", "left")
        .na.fill(0)
    )
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = join_lookup(groups, settle(langs, "languages"), {"lang": "lang"}, "inner")
    row_blocks = F.ceil(F.col("sources") / rows)
    return known.join(totals, ["lang", "source"], "left").na.fill(0, ["total"]).select(
        "lang",
        "source",
        "kept",
        "total",
        "lang_total",
        row_blocks.alias("row_blocks"),
        F.pmod(F.xxhash64("source"), row_blocks).alias("row_block"),
        F.greatest(F.ceil(F.col("kept") / columns), F.lit(1)).alias("column_blocks"),
    )


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * kept)), exact; 0 where no term is kept."""
    whole = lambda c: c.cast("decimal(19,0)")
    over = F.lit(SCALE).cast("decimal(10,0)") * whole(n + SMOOTHING)
    return F.when(kept > 0, F.floor(1 + _div(over, whole(total + SMOOTHING * kept)))).otherwise(0).cast("long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, F.when(b > 0, b))


def _distances(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, part, item, value for both directions of all pairs of a language's sources."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - 1))
    unseen = _share(F.lit(0), F.col("total"), F.col("kept"))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("column_blocks") - 1))
    groups = groups.select("*", blocks.alias("column_block")).select(
        "lang", "source", F.lit(None).cast("string").alias("term"), unseen.alias("share"), "kept",
        "row_block", "column_block", other.alias("other"),
    )
    cells = cells.select(
        "lang", "source", "term", "share", F.lit(0).cast("long").alias("kept"), "row_block", "column_block",
        other.alias("other"),
    )
    units = groups.unionByName(cells).select(
        "lang",
        F.least("row_block", "other").alias("one"),
        F.greatest("row_block", "other").alias("two"),
        "column_block",
        (F.col("row_block") > F.col("other")).alias("second"),
        "source",
        "term",
        "share",
        "kept",
    )
    priced = units.groupBy("lang", "one", "two", "column_block").applyInArrow(_priced, _PRICED)
    pairs = priced.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
    sides = F.explode(
        F.array(
            F.struct(F.col("one").alias("source"), F.col("two").alias("item")),
            F.struct(F.col("two").alias("source"), F.col("one").alias("item")),
        )
    )
    return pairs.select("lang", sides.alias("side"), "value").select(
        "lang", "side.source", F.lit("pair").alias("part"), "side.item", "value"
    )


def _priced(unit: pa.Table) -> pa.Table:
    """The unit's part of the distances of its pairs of groups. Shares of unseen columns are added in block 0."""
    lang, block = unit.column("lang")[0].as_py(), unit.column("column_block")[0].as_py()
    diagonal = unit.column("one")[0].as_py() == unit.column("two")[0].as_py()
    second = unit.column("second").to_numpy(zero_copy_only=False)
    is_group = unit.column("term").is_null().to_numpy()
    share = unit.column("share").to_numpy()
    names = np.array(unit.column("source").to_pylist(), dtype=object)
    kept = int(unit.column("kept").to_numpy().max(initial=0))
    terms = unit.column("term").combine_chunks().dictionary_encode()
    columns = terms.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    n_columns = len(terms.dictionary)
    # Columns that many groups have come first.
    order = np.argsort(-np.bincount(columns[~is_group], minlength=n_columns), kind="stable")
    place = np.empty(n_columns, np.int64)
    place[order] = np.arange(n_columns)

    sides = [(second == s) for s in ((False,) if diagonal else (False, True))]
    sources, trees = [], []
    height = height_of(max(int((is_group & s).sum()) for s in sides), n_columns)
    for side in sides:
        mine = np.flatnonzero(is_group & side)
        mine = mine[np.argsort(names[mine])]
        row_of = {name: i for i, name in enumerate(names[mine])}
        at = np.flatnonzero(~is_group & side)
        rows = np.fromiter((row_of[n] for n in names[at]), np.int64, len(at))
        sources.append(names[mine])
        trees.append(K2Tree(rows, place[columns[at]], share[at], share[mine], height))
    one, two = trees[0], trees[-1]
    if not len(one.zero) or not len(two.zero):  # no source has been dealt to this block
        return pa.table({"lang": [], "one": [], "two": [], "value": []}, schema=_PAIRS)
    # Only what differs from all columns being unseen is added up; that is added once, in block 0.
    apart = np.abs(one.zero[:, None] - two.zero[None, :])
    value = pair_distances(one, two, n_columns) + ((kept if block == 0 else 0) - n_columns) * apart
    a, b = np.indices(value.shape).reshape(2, -1)
    if diagonal:
        a, b = a[a < b], b[a < b]
    return pa.table(
        {
            "lang": pa.array([lang] * len(a), pa.string()),
            "one": pa.array(sources[0][a], pa.string()),
            "two": pa.array(sources[-1][b], pa.string()),
            "value": pa.array(value[a, b], pa.int64()),
        },
        schema=_PAIRS,
    )


def _ranked(items: DataFrame) -> DataFrame:
    by = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    return items.withColumn("rank", F.row_number().over(by))
