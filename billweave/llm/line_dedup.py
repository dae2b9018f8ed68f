"""Line dedup [op 6]: winnowing over line hashes; matches are extended, and later repeated runs deleted.

A text is its lines with a word, in order; lines without one are passed over. From every line on, a gram is
the fewest lines that hold ``GRAM_WORDS`` words. In every window, the fewest lines that hold ``SURE_WORDS``
words, the gram with the smallest hash is selected as a fingerprint. So two texts that share a run of
``SURE_WORDS`` words in whole lines share a fingerprint, and no shorter run than ``GRAM_WORDS`` counts.

Each fingerprint is joined with its first occurrence, by doc_id and position: one match per occurrence,
however many there are. A match is extended line by line both ways, and the lines of the later text that it
covers are deleted. A text can match an earlier place of its own. What is deleted always stands in an earlier
line run; the first occurrence of a run stays.

The first occurrence of a fingerprint may stand in other lines than that of the run around it. So windows whose
fingerprint repeats are joined with their own first occurrence too, by a hash of the whole window, and each later
one is deleted. From every line a window goes on, and up to every line one leads; together they cover every run
of ``SURE_WORDS`` words in whole lines, so each such run that stands earlier is deleted, whatever was matched.

Defined results: a NULL text stays NULL, and matches nothing. Rows that are equal in doc_id and text are one
document: both stay as they are, or lose the same lines. A NULL doc_id comes first. Empty tables give empty
results; all columns of the input are kept, whatever their names.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW, own_columns, pieces, split_join, stored, text_of, unpacked

GRAM_WORDS = 25
SURE_WORDS = 50
SLICE_BYTES = 8_000_000
_FOUND = "doc_id long, row_key long, hashes binary, words array<int>, grams array<long>, places array<int>"
_WINDOWS = "doc_id long, row_key long, window long, begin int, end int"


def lines_of(text: str) -> list[tuple[int, str]]:
    """Lines with a word: their number among all lines, and the line."""
    return [(i, line) for i, line in enumerate(text.split("\n")) if line.strip(" \t\x0b\x0c\r")]


def _ends(words: list[int], least: int) -> list[int]:
    """For each line, one past the last of the fewest lines that hold ``least`` words; 0 if there are too few."""
    out, end, held = [], 0, 0
    for n in words:
        while held < least and end < len(words):
            held += words[end]
            end += 1
        out.append(end if held >= least else 0)
        held -= n
    return out


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def _selected(hashes: bytes, words: list[int]) -> tuple[list[int], list[int]]:
    """Grams (hashes, by first line), and for each line from which a window goes on, the place of its gram."""
    gram_end, sure_end = _ends(words, GRAM_WORDS), _ends(words, SURE_WORDS)
    grams = [xxhash.xxh64_intdigest(hashes[8 * i : 8 * e]) if e else 0 for i, e in enumerate(gram_end)]
    chosen: list[int] = []
    window: deque[int] = deque()
    ahead = 0
    for i, end in enumerate(sure_end):
        if not end:
            break
        while ahead < len(grams) and 0 < gram_end[ahead] <= end:
            while window and grams[window[-1]] >= grams[ahead]:
                window.pop()
            window.append(ahead)
            ahead += 1
        while window[0] < i:
            window.popleft()
        chosen.append(window[0])
    return grams, chosen


def fingerprints(text: str) -> tuple[bytes, list[int], list[int], list[int]]:
    """Line hashes, words per line, and the selected grams with their first lines."""
    lines = [line.encode() for _, line in lines_of(text)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, lines), np.uint64, len(lines)).tobytes()
    words = [len(line.split()) for line in lines]
    grams, chosen = _selected(hashes, words)
    places = list(dict.fromkeys(chosen))
    return hashes, words, [_signed(grams[p]) for p in places], places


def windows(hashes: bytes, words: list[int], places: set[int]) -> list[tuple[int, int, int]]:
    """Hash, first line and end of the windows that can repeat: whose gram, at one of ``places``, does."""
    _, chosen = _selected(hashes, words)
    found = {(i, end) for i, (end, gram) in enumerate(zip(_ends(words, SURE_WORDS), chosen, strict=False)) if gram in places}
    # The window that leads up to a line holds the one that goes on from its own first line.
    for i, end in enumerate(_ends(words[::-1], SURE_WORDS)):
        begin = len(words) - end
        if end and begin < len(chosen) and chosen[begin] in places:
            found.add((begin, len(words) - i))
    return [(_signed(xxhash.xxh64_intdigest(hashes[8 * b : 8 * e])), b, e) for b, e in sorted(found)]


def _line_table(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE_BYTES):
            found = [fingerprints(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    pa.array([f[0] for f in found], pa.binary()),
                    pa.array([f[1] for f in found], pa.list_(pa.int32())),
                    pa.array([f[2] for f in found], pa.list_(pa.int64())),
                    pa.array([f[3] for f in found], pa.list_(pa.int32())),
                ],
                ["doc_id", "row_key", "hashes", "words", "grams", "places"],
            )

    return rows.select("doc_id", "row_key", "text").mapInArrow(run, _FOUND)


def extended(later: np.ndarray, earlier: np.ndarray, seeds: list[tuple[int, int]]) -> list[int]:
    """Lines of ``later`` that the matches at ``seeds`` (line there, line in ``earlier``) cover."""
    covered: set[int] = set()
    reached: dict[int, int] = {}  # by distance: the end of the last run there
    for place, first in sorted(seeds):
        if place < reached.get(place - first, 0):
            continue
        shift = place - first
        low = max(0, shift)
        high = min(len(later), len(earlier) + shift)
        equal = later[low:high] == earlier[low - shift : high - shift]
        breaks = np.flatnonzero(~equal) + low
        k = int(np.searchsorted(breaks, place))
        begin = int(breaks[k - 1]) + 1 if k else low
        end = int(breaks[k]) if k < len(breaks) else high
        covered.update(range(begin, end))
        reached[shift] = end
    return sorted(covered)


def _window_table(table: DataFrame, occurrences: DataFrame) -> DataFrame:
    """The windows that can repeat: those whose gram is one of ``occurrences``, the first one's too."""
    held = occurrences.groupBy(F.col("doc_id").alias("o_id"), "row_key").agg(F.collect_set("place").alias("repeated"))
    both = (
        held.join(table.select("doc_id", "row_key", "hashes", "words"), "row_key")
        .filter(F.col("o_id").eqNullSafe(F.col("doc_id")))
        .select("doc_id", "row_key", "hashes", "words", "repeated")
        .dropDuplicates(["doc_id", "row_key"])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "hashes", SLICE_BYTES):
            columns = [batch.column(c).to_pylist() for c in ("hashes", "words", "repeated")]
            found = [windows(h, w, set(p)) for h, w, p in zip(*columns, strict=True)]
            row = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            flat = [w for f in found for w in f]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(row),
                    batch.column("row_key").take(row),
                    pa.array([w[0] for w in flat], pa.int64()),
                    pa.array([w[1] for w in flat], pa.int32()),
                    pa.array([w[2] for w in flat], pa.int32()),
                ],
                ["doc_id", "row_key", "window", "begin", "end"],
            )

    return both.mapInArrow(run, _WINDOWS)


def repeated_lines(rows: DataFrame) -> DataFrame:
    """Of texts that repeat something: doc_id, row_key and the numbers of their lines (with a word) to delete."""
    table = stored(_line_table(rows), "line-fingerprints")
    grams = table.select(
        "doc_id", "row_key", F.explode(F.arrays_zip("grams", "places")).alias("g")
    ).select("doc_id", "row_key", F.col("g.grams").alias("gram"), F.col("g.places").alias("place"))
    here = F.struct("doc_id", "row_key", "place")
    firsts = grams.groupBy("gram").agg(F.min(here).alias("first"), F.count("*").alias("n")).filter("n > 1")
    occurrences = split_join(grams, stored(firsts, "line-firsts"), "gram")
    matches = occurrences.filter(~here.eqNullSafe(F.col("first")))
    pairs = (
        matches
        .groupBy("doc_id", "row_key", F.col("first.doc_id").alias("first_id"), F.col("first.row_key").alias("first_key"))
        .agg(F.collect_set(F.struct("place", F.col("first.place").alias("first"))).alias("seeds"))
    )
    earlier = table.select(
        F.col("doc_id").alias("e_id"), F.col("row_key").alias("first_key"), F.col("hashes").alias("first_hashes")
    )
    later = table.select(F.col("doc_id").alias("l_id"), "row_key", "hashes")
    both = (
        pairs.join(earlier, "first_key")
        .filter(F.col("e_id").eqNullSafe(F.col("first_id")))
        .join(later, "row_key")
        .filter(F.col("l_id").eqNullSafe(F.col("doc_id")))
        .select("doc_id", "row_key", "hashes", "first_hashes", "seeds")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                extended(
                    np.frombuffer(r["hashes"], np.uint64),
                    np.frombuffer(r["first_hashes"], np.uint64),
                    [(s["place"], s["first"]) for s in r["seeds"]],
                )
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(found, pa.list_(pa.int32()))],
                ["doc_id", "row_key", "lines"],
            )

    covered = both.mapInArrow(run, "doc_id long, row_key long, lines array<int>")
    windows_ = stored(_window_table(table, occurrences), "line-windows")
    begin = F.struct("doc_id", "row_key", "begin")
    first_windows = windows_.groupBy("window").agg(F.min(begin).alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = (
        split_join(windows_, stored(first_windows, "line-first-windows"), "window")
        .filter(~begin.eqNullSafe(F.col("first")))
        .select("doc_id", "row_key", F.sequence("begin", F.col("end") - 1).alias("lines"))
    )
    return covered.unionByName(again).groupBy("doc_id", "row_key").agg(
        F.array_distinct(F.flatten(F.collect_set("lines"))).alias("lines")
    )


def without_lines(text: str, drop: set[int]) -> str:
    """The text without those of its lines with a word that are numbered in ``drop``."""
    gone = {i for k, (i, _) in enumerate(lines_of(text)) if k in drop}
    return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone)


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from the texts."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.struct(*own_columns(docs)).alias(ROW)
    ).withColumn("row_key", F.xxhash64("doc_id", "text"))
    gone = repeated_lines(rows).select(F.col("doc_id").alias("gone_id"), "row_key", "lines")
    joined = rows.join(gone.hint("shuffle_hash"), "row_key", "left").filter(
        F.col("lines").isNull() | F.col("gone_id").eqNullSafe(F.col("doc_id"))
    )
    return _rewritten(joined.select(ROW, "lines"), docs)


def _rewritten(joined: DataFrame, docs: DataFrame) -> DataFrame:
    flat = joined.select(*unpacked(docs), F.col("lines").alias("__lines"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [
                without_lines(t, set(drop)) if drop else t
                for t, drop in zip(batch.column("text").to_pylist(), batch.column("__lines").to_pylist(), strict=True)
            ]
            columns = [c for c, f in zip(batch.columns, batch.schema, strict=True) if f.name != "__lines"]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in batch.schema if f.name != "__lines"])

    return flat.mapInArrow(run, docs.schema)
