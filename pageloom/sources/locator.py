"""Late fetch: wide columns are read where they lie.

A job that needs the bodies of some rows joins on narrow columns and carries
the rows' place (file and row number, as the scan's ``_metadata`` tells it);
:func:`fetch` then reads the bodies of the rows that are left from their
files.  Bodies are in no exchange, and rows nobody wants are not shipped.
Stores that only Spark reads are the exception: there bodies are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.session import materialize, ship_package

#: Stores whose files a task opens by itself.
READABLE = {"file", "s3", "gs"}
#: Rows decoded at a time, and the bytes of bodies handed on at a time.
ROWS, HANDED_ON = 64, 16 << 20


def located(table: DataFrame, *cols) -> DataFrame:
    """``cols`` of a table of Parquet files, with every row's place
    (``file``, ``row``).  Columns computed over the scan may be among them."""
    return table.select(*cols, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


class _Rows:
    """One column of Parquet files, by place; places come in order, so a file
    is read forwards, and only the row groups that hold a place."""

    def __init__(self, column: str):
        self.column, self.file = column, None

    def _open(self, file: str) -> None:
        import pyarrow.fs
        import pyarrow.parquet as pq
        parts = urlsplit(file)
        if parts.scheme == "file":
            fs, path = pyarrow.fs.LocalFileSystem(), unquote(parts.path)
        else:
            fs, path = pyarrow.fs.FileSystem.from_uri(file)
        self.parquet, self.file = pq.ParquetFile(fs.open_input_file(path)), file
        self.group, self.group_end, self.end = -1, 0, 0  # ends of the group and of the decoded rows

    def at(self, file: str, row: int):
        if file != self.file or row < self.end - len(self.values):
            self._open(file)
            self.values = []
        while row >= self.group_end:
            self.group += 1
            self.end, self.values, self.batches = self.group_end, [], None
            self.group_end += self.parquet.metadata.row_group(self.group).num_rows
        if self.batches is None:
            self.batches = self.parquet.iter_batches(ROWS, row_groups=[self.group], columns=[self.column])
        while row >= self.end:
            batch = next(self.batches).column(0)
            self.values, self.end = batch, self.end + len(batch)
        return self.values[row - self.end + len(self.values)].as_py()


def _fetcher(column: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = _Rows(column)
        for frame in frames:
            bodies, size, start = [], 0, 0
            for i, (file, row) in enumerate(zip(frame["file"], frame["row"])):
                bodies.append(rows.at(file, row))
                size += len(bodies[-1] or "")
                if size >= HANDED_ON or i + 1 == len(frame):
                    yield frame.iloc[start:i + 1].assign(**{column: pd.Series(bodies, dtype=object, index=frame.index[start:i + 1])})
                    bodies, size, start = [], 0, i + 1
    return run


def fetch(wanted: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """``wanted(file, row, ...)``, places of rows of ``table``, with the
    ``column`` of the row that each names; a row may be named many times.

    The places are written and ordered by range, with all other columns as
    the tie-break, so that tasks get even shares even where a third of the
    rows name one place, and each reads its files once, forwards.  Where the
    files are in no store of READABLE, places and bodies are joined instead;
    both are plain inputs, so a place with many rows is split."""
    places = materialize(wanted, "places")
    one = places.select("file").head()
    if one is None or urlsplit(one["file"]).scheme not in READABLE:
        return places.join(located(table, column), ["file", "row"])
    ship_package(wanted.sparkSession)
    others = [c for c in places.columns if c not in ("file", "row")]
    ordered = places.repartitionByRange("file", "row", *others).sortWithinPartitions("file", "row")
    return ordered.mapInPandas(_fetcher(column), T.StructType([*places.schema.fields, table.select(column).schema[0]]))
