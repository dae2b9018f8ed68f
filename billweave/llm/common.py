"""Small helpers of the operators: tables, stored intermediates, and local bindings in expressions."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billweave.session import scratch_path

# ASCII white space, as regular expression and as characters.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
# A key with at least this share of all rows is hot.
MOST_HOT = 1000
# Texts that are read in many places are cut into blocks of so many code points.
BLOCK_CHARS = 1024


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, even where ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Length of the chunks in which :func:`running` goes over an array.
CHUNK = 256


def running(values: Column, combine: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """Running sums (or other combinations) of an array of 32-bit whole numbers, as which they are kept: a sum beyond
    these wraps around, also in a session in which an overflow is an error.

    Chunks are run through by themselves and raised by what came before them, which is a running sum over the
    chunks. So the work is linear for up to ``CHUNK ** levels`` values, and an array is copied only within a chunk.
    """

    def combined(a: Column, x: Column) -> Column:
        return F.shiftright(F.shiftleft(combine(a.cast("long"), x.cast("long")), 32), 32).cast("int")

    def within(chunk: Column) -> Column:
        none = F.filter(chunk, lambda x: F.lit(False))
        return F.aggregate(
            chunk, none, lambda a, x: F.concat(a, F.array(F.coalesce(combined(F.get(a, F.size(a) - 1), x), x)))
        )

    def raised(chunks: Column, before: Column) -> Column:
        return F.flatten(
            F.transform(
                chunks,
                lambda c, k: F.when(k == 0, c).otherwise(F.transform(c, lambda x: combined(F.get(before, k - 1), x))),
            )
        )

    def body(v: Column) -> Column:
        if levels == 1:
            return within(v)
        chunks = F.transform(F.sequence(F.lit(1), F.size(v), F.lit(CHUNK)), lambda k: F.slice(v, k, CHUNK))
        lasts = lambda c: F.transform(c, lambda x: F.get(x, F.size(x) - 1))
        in_chunks = let(
            F.transform(chunks, within), lambda c: let(running(lasts(c), combine, levels - 1), lambda b: raised(c, b))
        )
        return F.when(F.size(v) <= CHUNK, within(v)).otherwise(in_chunks)

    return let(values, body)


def in_blocks(text: Column) -> Column:
    """A text in blocks of ``BLOCK_CHARS`` code points, of which :func:`cut` reads parts."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))


def cut(blocks: Column, start: Column, end: Column) -> Column:
    """Code points from ``start`` to before ``end``. Its time doesn't depend on how far into the text they are."""
    first = F.floor(start / BLOCK_CHARS).cast("int")
    last = F.floor(F.greatest(end - 1, start) / BLOCK_CHARS).cast("int")
    near = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
    return F.substring(near, start - first * BLOCK_CHARS + 1, end - start)


def smallest_hashes(rows: DataFrame, by: list[Column], n: int, total: int) -> DataFrame:
    """``n`` of ``total`` rows: those with the smallest 64-bit hashes in ``by[0]``, ties by what follows.

    Rows far above the ``n``-th hash are dropped first, so that about ``2 * n`` rows are sorted, however many tasks
    there are. Hashes that are no uniform numbers, such as those of repeated rows, can leave fewer than ``n``.
    """
    if total > 4 * n:
        rows = rows.filter(by[0] < int(2 * n / total * 2.0**64) - 2**63)
    return rows.orderBy(*by).limit(n)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def number_array(values: list[float]) -> Column:
    """A constant array of doubles; one expression whatever its length."""
    return F.split(F.lit(",".join(f"{v:.6g}" for v in values)), ",").cast("array<double>")


def below(bounds: list, key: Column, inclusive: bool) -> Column:
    """How many of the sorted bounds are below ``key`` (or equal, if inclusive), by binary search."""
    if not bounds:
        return F.lit(0)
    kind = "string" if isinstance(bounds[0], str) else "bigint"
    known = F.from_json(F.lit(json.dumps(bounds)), f"array<{kind}>")
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]

    def go(at: Column, by: Column) -> Column:
        bound = F.get(known, at + by - 1)
        passed = (bound <= key) if inclusive else (bound < key)
        return F.when((at + by <= len(bounds)) & F.coalesce(passed, F.lit(False)), at + by).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), go)


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_join(rows: DataFrame, counted: DataFrame, key: str, n: str = "n") -> DataFrame:
    """``rows`` joined with ``counted``: one stored row per ``key``, with the number ``n`` of rows that have it.

    Keys with at least a thousandth of all these rows, so at most ``MOST_HOT`` of them, are broadcast, and their
    rows stay where they are; the others are shuffled. So a key with a third of all rows is not one task's work.
    """
    total = counted.agg(F.sum(n)).first()[0] or 0
    is_hot = F.col(n) * MOST_HOT >= total
    hot = F.broadcast(counted.filter(is_hot))
    others = rows.join(hot.select(key), key, "left_anti").join(counted.filter(~is_hot), key)
    return rows.join(hot, key).unionByName(others)


def pieces(
    batches: Iterator[pa.RecordBatch], column: str, limit: int, rows: int = 1 << 30
) -> Iterator[pa.RecordBatch]:
    """Slices batches so that the texts of ``column`` in one slice have about ``limit`` bytes (or are one text)."""
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        begin, total = 0, 0
        for i, n in enumerate(sizes):
            if i > begin and (total + n > limit or i - begin >= rows):
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += int(n)
        if begin < batch.num_rows:
            yield batch.slice(begin)


# Name of the column that carries a whole input row through an operator, whatever its columns are called.
ROW = "__row"


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the row itself as one struct: no name of an extra column can clash."""
    return docs.select("doc_id", "text", F.struct(*own_columns(docs)).alias(ROW))


def own_columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def carried(df: DataFrame) -> list[str]:
    return [ROW] if ROW in df.columns else []


def unpacked(docs: DataFrame, text: Column | None = None) -> list[Column]:
    """The columns of ``docs`` out of the carried row, with another text if one is given."""
    return [
        (text if c == "text" and text is not None else F.col(ROW)[c]).alias(c) for c in docs.columns
    ]
