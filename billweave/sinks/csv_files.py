"""CSV output with a header, readable by :func:`billweave.sources.files.read_csv_report`."""

from __future__ import annotations

from pyspark.sql import DataFrame

from billweave.sources.files import CSV_FORMAT


# A compressed file is read by one task, so files end after so many rows.
ROWS_PER_FILE = 200_000


def write_csv(df: DataFrame, folder: str, compression: str = "gzip") -> None:
    """Writes the files of each task into a new folder, texts untrimmed. Blank texts are written like NULL, as nothing.

    Files are packed, quickly rather than tightly: report lines repeat most of their text. ``compression`` names another
    codec of Spark's, or ``none``. Files with line feeds inside texts can only be read back with ``multi_line=True``.
    """
    df.write.options(
        **CSV_FORMAT,
        **{"compression": compression, "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": ROWS_PER_FILE},
        emptyValue="",
        nullValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(folder)
