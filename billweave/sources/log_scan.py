"""Event logs whose objects run over any number of lines, read in splits like any other file.

A split is scanned from its first line to its last by the task that reads it. What it cannot know is whether its
beginning belongs to an object of the split before. So each split gives its records, with their places; its first
characters; and, if it ends inside an object, the text from there on. Neighbours' ends are joined by file and place
and decoded together; that gives the objects that lie across a border and how far they reach, and records that the
next split has seen inside such an object are taken back. Only these ends are shuffled, not the log.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billweave.operators.lookups import join_lookup, settle
from billweave.schema import REPORT_COLUMNS
from billweave.session import scratch_path
from billweave.sources.event_logs import Number, as_text, is_cut, record_of

# The scan travels to the executors by value, so that those need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Characters of an object at most; a longer one is cut.
LONGEST_OBJECT = 1 << 18
# Characters that are looked at first for an object, and by how many times more if it doesn't end there. The errors of
# the decoder count lines from the beginning of its text, so many of them in a long text would cost its square.
_WINDOW, _WIDER = 1 << 12, 8
# A token that the end of a window cuts (a literal, a number, an escape) is reported at most so many characters before.
_TOKEN = 16
_PLACE = ["file", "split", "start"]
_EDGE = ["n_chars", "head", "tail"]
_SCANNED = "file string, split long, start long, " + ", ".join(f"`{c}` string" for c in REPORT_COLUMNS)


def scan_event_log(
    spark: SparkSession, path: str | list[str], cut_rows: str = "fail", longest: int = LONGEST_OBJECT
) -> DataFrame:
    """The report records in log files, all columns as text, whatever lines their objects are printed on.

    An object counts as in :func:`billweave.sources.event_logs.event_records`. One that a file ends inside of, or that
    is longer than ``longest`` characters, is an error, or is passed over with ``cut_rows="skip"``; a brace that
    begins no JSON ends nothing. Lines are joined by line feeds again. The log is read once; what has been found
    is written to the shared folder.
    """
    if cut_rows not in ("fail", "skip"):
        raise ValueError("cut_rows is either 'fail' or 'skip'")
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("file", "split", "value")]
            begin = 0
            for i in range(1, batch.num_rows + 1):
                if i < batch.num_rows and columns[0][i] == columns[0][begin] and columns[1][i] == columns[1][begin]:
                    continue
                at = (columns[0][begin], columns[1][begin])
                if split is None or split.at != at:
                    if split is not None:
                        yield split.end()
                    split = _Split(at, cut_rows, longest)
                yield split.add("\n".join(columns[2][begin:i]) + "\n")
                begin = i
        if split is not None:
            yield split.end()

    path_ = scratch_path(spark, "log-scan")
    schema = f"{_SCANNED}, n_chars long, head string, tail string"
    lines.mapInArrow(scan, schema).write.parquet(path_)
    found = spark.read.schema(schema).parquet(path_)
    records = found.filter("head IS NULL").drop(*_EDGE)
    ends = found.filter("head IS NOT NULL").select(*_PLACE, *_EDGE)

    by = Window.partitionBy("file").orderBy("split")
    order = settle(ends.select("file", "split").withColumn("place", F.row_number().over(by)), "log-splits")
    ends = join_lookup(ends, order, {"file": "file", "split": "split"}, "inner")
    # No split but a file's last is shorter than this, so that many of them hold the longest object.
    shortest = ends.agg(F.min(F.when(F.col("place") > 1, F.col("n_chars")))).first()[0] or longest
    ahead = min(1 + longest // max(shortest, 1), 64)
    wanted = ends.filter("tail IS NOT NULL").select(
        "file", "split", "start", "tail", F.col("place").alias("from"), F.explode(F.sequence(F.col("place"), F.col("place") + ahead)).alias("place")
    )
    following = F.array_sort(
        F.collect_list(F.when(F.col("place") > F.col("from"), F.struct("place", "n_chars", "head")))
    )
    borders = (
        wanted.join(ends.select("file", "place", "n_chars", "head"), ["file", "place"])
        .groupBy("file", "split", "start", "from", "tail")
        .agg(following.alias("following"))
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _across(row, cut_rows)

    path_ = scratch_path(spark, "log-borders")
    schema = f"{_SCANNED}, reach long"
    borders.mapInArrow(decode, schema).write.parquet(path_)
    across = spark.read.schema(schema).parquet(path_)

    reach = across.filter("reach IS NOT NULL").select("file", "split", "start", "reach")
    numbers = ends.select("file", "split", "n_chars").join(reach, ["file", "split"], "left")
    judged = numbers.groupBy("file").applyInPandas(_judged, "file string, split long, hidden long, counts boolean")
    judged = settle(judged, "log-judged")
    keys = {"file": "file", "split": "split"}
    inside = join_lookup(records, judged, keys, "inner").filter("start >= hidden")
    across = join_lookup(across.filter("reach IS NULL"), judged, keys, "inner").filter("counts")
    return inside.select(*REPORT_COLUMNS).unionByName(across.select(*REPORT_COLUMNS))


class _Split:
    """The scan of one split's text, as its lines come in."""

    def __init__(self, at: tuple[str, int], cut_rows: str, longest: int):
        self.at, self.cut_rows, self.longest = at, cut_rows, longest
        self.decoder = json.JSONDecoder(parse_float=Number)
        self.head, self.text, self.begin, self.tried = "", "", 0, 0

    def add(self, text: str) -> pa.RecordBatch:
        if len(self.head) < self.longest:
            self.head += text[: self.longest - len(self.head)]
        self.text += text
        # An open object is tried again when twice as much of it is there.
        return self._scan() if len(self.text) >= 2 * self.tried else _batch(self.at, [])

    def end(self) -> pa.RecordBatch:
        length = self.begin + len(self.text)
        found = self._scan()
        edge = (length, self.head, self.text or None)
        return pa.concat_batches([found, _batch(self.at, [(self.begin, {})], edge)])

    def _scan(self) -> pa.RecordBatch:
        """Records up to the first object that isn't complete, which is what is left of the text."""
        found, at = [], self.text.find("{")
        while at >= 0:
            record, end = _decoded(self.decoder, self.text, at)
            if end is None:
                if len(self.text) - at < self.longest:
                    break
                _refuse(self.cut_rows, self.text, at)
                end = at + 1
            elif record is not None:
                found.append((self.begin + at, record))
            at = self.text.find("{", end)
        done = at if at >= 0 else len(self.text)
        self.begin, self.text = self.begin + done, self.text[done:]
        self.tried = len(self.text)
        return _batch(self.at, found)


def _decoded(decoder: json.JSONDecoder, text: str, at: int) -> tuple[dict | None, int | None]:
    """The record of the object at a brace, if it has one, and where to go on; None where the text ends inside it."""
    size = _WINDOW
    while True:
        part = text[at : at + size]
        whole = at + len(part) == len(text)
        try:
            found, end = decoder.raw_decode(part)
        except RecursionError:
            return None, at + 1
        except json.JSONDecodeError as error:
            unterminated = error.msg.startswith("Unterminated string")
            if not whole and (unterminated or error.pos >= len(part) - _TOKEN):
                size *= _WIDER
                continue
            ends = whole and (error.pos >= len(part.rstrip()) or (unterminated and "\n" not in part[error.pos :].rstrip("\n")))
            return None, None if ends else at + 1
        return record_of(found), at + end


def _refuse(cut_rows: str, text: str, at: int) -> None:
    if cut_rows == "fail" and is_cut(text, at, json.JSONDecodeError("", text, len(text))):
        raise ValueError("a log has an object that does not end, or a longer one than it may have")


def _across(border: dict, cut_rows: str) -> pa.RecordBatch:
    """The records that begin in the tail of a split, and how far the last object reaches into the next splits."""
    decoder = json.JSONDecoder(parse_float=Number)
    text = border["tail"]
    for part in border["following"]:
        text += part["head"]
        if part["n_chars"] > len(part["head"]):
            break
    found, at, reach = [], 0, 0
    while 0 <= at < len(border["tail"]):
        record, end = _decoded(decoder, text, at)
        if end is None:
            _refuse(cut_rows, text, at)
            end = at + 1
        elif record is not None:
            found.append((border["start"] + at, record))
        reach = max(reach, end - len(border["tail"]))
        at = text.find("{", end)
    place = (border["file"], border["split"])
    rows = _batch(place, [*found, (border["start"], {})])
    reaches = pa.array([None] * len(found) + [reach], pa.int64())
    return pa.RecordBatch.from_arrays([*rows.columns[: -len(_EDGE)], reaches], [*rows.schema.names[: -len(_EDGE)], "reach"])


def _judged(file: pd.DataFrame) -> pd.DataFrame:
    """Numbers of one file's splits: characters that belong to objects begun before, and which open ends count."""
    file = file.sort_values("split", ignore_index=True)
    hidden, counts, left = [], [], 0
    for n, start, reach in zip(file["n_chars"], file["start"], file["reach"]):
        hidden.append(min(left, n))
        open_ = pd.notna(start) and start >= left
        counts.append(bool(open_))
        left = max(int(reach) if open_ else 0, left - n)
    return file[["file", "split"]].assign(hidden=hidden, counts=counts)


def _batch(at: tuple[str, int], found: list[tuple[int, dict]], edge: tuple | None = None) -> pa.RecordBatch:
    n = len(found)
    ends = edge or (None, None, None)
    columns = [
        pa.array([at[0]] * n, pa.string()),
        pa.array([at[1]] * n, pa.int64()),
        pa.array([place for place, _ in found], pa.int64()),
        *[pa.array([as_text(r.get(c)) for _, r in found], pa.string()) for c in REPORT_COLUMNS],
        *[pa.array([value] * n, kind) for value, kind in zip(ends, (pa.int64(), pa.string(), pa.string()))],
    ]
    return pa.RecordBatch.from_arrays(columns, [*_PLACE, *REPORT_COLUMNS, *_EDGE])
