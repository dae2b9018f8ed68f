"""Report files: CSV and Parquet, read as text."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

# Quotes inside quoted fields are doubled, as in the JSON text of the product column.
CSV_FORMAT = {"header": "true", "quote": '"', "escape": '"'}
# Endings of CSV files, compressed or not.
CSV_FILES = "*.{csv,csv.gz,csv.bz2,csv.deflate,csv.lz4,csv.snappy}"
_PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy")
# Files whose first lines are read at the same time, each by a job of its own.
HEADERS_AT_ONCE = 16


def read_csv_report(
    spark: SparkSession,
    path: str | list[str],
    column_types: dict[str, str] | None = None,
    multi_line: bool = False,
    bad_lines: str = "fail",
) -> DataFrame:
    """CSV report files of one header as one relation; every column is text.

    A file with another header than the first one fails the job (:func:`read_csv_folder` takes different headers).
    A line with too few or too many fields fails the job; so does one that is cut by a line feed inside quotes,
    which takes ``multi_line``. With ``bad_lines="null"`` such a line has what could be read, NULL elsewhere,
    and its text in the column ``_corrupt_record``.

    ``column_types`` declares other types for some columns. ``multi_line`` allows line feeds
    inside quoted fields, at the price that a file can no longer be split between tasks.
    """
    if bad_lines not in ("fail", "null"):
        raise ValueError("bad_lines is either 'fail' or 'null'")
    # A blank field is NULL either way; the header of every file is checked against the first one.
    reader = spark.read.options(**CSV_FORMAT, multiLine=multi_line, enforceSchema=False)
    names = reader.csv(path).columns
    declared = column_types or {}
    schema = T.StructType(
        [T.StructField(n, T.DataType.fromDDL(declared.get(n, "string"))) for n in names]
    )
    # Without pruning each line is read whole, so that its fields are counted whatever is selected.
    reader = reader.options(columnPruning=False, mode="FAILFAST" if bad_lines == "fail" else "PERMISSIVE")
    if bad_lines == "null":
        schema = schema.add(CORRUPT_COLUMN, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.schema(schema).csv(path)


def read_csv_folder(
    spark: SparkSession,
    folder: str,
    columns: list[str] | tuple[str, ...] | None = None,
    unknown: str = "drop",
    missing: str = "null",
    multi_line: bool = False,
    bad_lines: str = "fail",
) -> DataFrame:
    """All CSV files under a folder as one relation, whatever the order of their columns.

    Every file's header is read and its columns are taken by name, in any case of letters. The result has
    ``columns``, by default those of all files in the order of their first appearance. A column of a file that isn't
    among them is dropped, or an error with ``unknown="fail"``; one that a file lacks is NULL, or an error with
    ``missing="fail"``. A header that names a column twice is an error. Files of one header are one scan.
    """
    if unknown not in ("drop", "fail") or missing not in ("null", "fail"):
        raise ValueError("unknown is 'drop' or 'fail', missing is 'null' or 'fail'")
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, header in csv_headers(spark, csv_files(spark, folder)).items():
        by_header.setdefault(header, []).append(file)
    if not by_header:
        raise ValueError(f"no CSV files found under {folder}")
    wanted = list(columns) if columns else list({n.lower(): n for h in reversed(by_header) for n in reversed(h)}.values())[::-1]
    parts = []
    for header, files in by_header.items():
        have = {n.lower(): n for n in header}
        strange = [n for n in header if n.lower() not in {w.lower() for w in wanted}]
        absent = [w for w in wanted if w.lower() not in have]
        if strange and unknown == "fail":
            raise ValueError(f"{files[0]} has unknown columns: {', '.join(strange)}")
        if absent and missing == "fail":
            raise ValueError(f"{files[0]} lacks columns: {', '.join(absent)}")
        rows = read_csv_report(spark, files, multi_line=multi_line, bad_lines=bad_lines)
        taken = [
            (F.lit(None).cast("string") if w.lower() not in have else F.col(f"`{have[w.lower()]}`")).alias(w) for w in wanted
        ]
        parts.append(rows.select(*taken, *([CORRUPT_COLUMN] if bad_lines == "null" else [])))
    return reduce(DataFrame.unionByName, parts)


def csv_files(spark: SparkSession, folder: str) -> list[str]:
    """The CSV files under a folder, sub-folders included, compressed ones too; only listed, not read."""
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=CSV_FILES).load(folder)
    return sorted(r.path for r in listed.select("path").collect())


def csv_headers(spark: SparkSession, files: list[str]) -> dict[str, tuple[str, ...]]:
    """The column names of each file. A file without a line is left out; of the others only the first is read.

    A file may be read in splits: the first line is that of the split at place 0, which comes first in the first task.
    """

    def first_line(file: str) -> str | None:
        row = spark.read.text(file).filter("_metadata.file_block_start = 0").first()
        return row.value if row else None

    found: dict[str, tuple[str, ...]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for file, line in zip(files, pool.map(first_line, files)):
            if line is None:
                continue
            names = tuple(next(csv.reader([line.removeprefix("\ufeff")])))
            if len({n.lower() for n in names}) < len(names):
                raise ValueError(f"{file} names a column twice")
            found[file] = names
    return found


def register_csv_folder(spark: SparkSession, folder: str, files: list[str] | None = None) -> list[str]:
    """Makes each CSV file of a folder, or each of those named, a temporary view called like the file.

    A folder called ``name.csv`` counts as a file. A line that doesn't fit its header fails the query.
    """
    root = folder.rstrip("/")
    if files is None:
        marker = "/" + root.rsplit("/", 1)[-1] + "/"
        files = sorted({f.rsplit(marker, 1)[-1].split("/")[0] for f in csv_files(spark, root)})
    views = [_stem(file) for file in files]
    if len({v.lower() for v in views}) < len(views):
        raise ValueError("two files of the folder have the same name but for their ending or case")
    for view, file in zip(views, files):
        read_csv_report(spark, f"{root}/{file}").createOrReplaceTempView("`" + view.replace("`", "``") + "`")
    return views


def _stem(file: str) -> str:
    path = PurePosixPath(file)
    return PurePosixPath(path.stem).stem if path.suffix in _PACKED else path.stem


def read_parquet_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet files by file, pattern or folder, sub-folders included; fails when there are none."""
    paths = [path] if isinstance(path, str) else path
    reader = spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.parquet")
    report = reader.parquet(*paths)
    if report.isEmpty():
        raise ValueError(f"no report rows found at {', '.join(paths)}")
    return report
