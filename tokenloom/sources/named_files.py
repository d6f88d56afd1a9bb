"""A writer of files with planned names: each file is written whole by one task, or not at all.

Tasks write below ``_written`` under a name of their attempt and report file names and record counts; the
commit moves the reported files to their places and removes the rest, so attempts that failed or ran twice
leave nothing behind.
"""

from __future__ import annotations

import posixpath
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

HIDDEN = "_written"
PIECE = 1 << 20  # bytes of records that become Python objects at a time


@dataclass
class WrittenFiles(WriterCommitMessage):
    """``(name, place, records)`` of each file of a task."""

    files: list[tuple[str, str, int]]


class NamedFilesWriter(DataSourceArrowWriter):
    """Writes rows ``file, value`` that come ordered by file."""

    def __init__(self, options: dict):
        path = options["path"]
        self.system, self.folder = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        self.end = options.get("linesep", "\n").encode()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        base, done, name, out, n = f"{self.folder}/{HIDDEN}/{uuid.uuid4().hex}", [], None, None, 0
        for batch in iterator:
            names, values = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).fill_null(b"")
            piece = np.cumsum(pc.binary_length(values).to_numpy(zero_copy_only=False), dtype=np.int64) // PIECE
            starts = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1] or piece[i] != piece[i - 1]]
            for a, b in zip(starts, [*starts[1:], len(names)], strict=True):
                if names[a] != name:
                    if out is not None:
                        out.close()
                        done.append((name, f"{base}/{name}", n))
                    name, n = names[a], 0
                    self.system.create_dir(posixpath.dirname(f"{base}/{name}"))
                    out = self.system.open_output_stream(f"{base}/{name}")
                out.write(b"".join(v + self.end for v in values.slice(a, b - a).to_pylist()))
                n += b - a
        if out is not None:
            out.close()
            done.append((name, f"{base}/{name}", n))
        return WrittenFiles(done)

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        twice = [name for name, n in Counter(f[0] for f in files).items() if n > 1]
        if twice:
            self.abort(messages)
            raise ValueError(f"files in more than one place of the rows: {sorted(twice)[:5]}")
        for name, place, _ in files:
            final = f"{self.folder}/{name}"
            self.system.create_dir(posixpath.dirname(final))
            self.system.move(place, final)
        self.abort(messages)

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        if self.system.get_file_info(f"{self.folder}/{HIDDEN}").type != fs.FileType.NotFound:
            self.system.delete_dir(f"{self.folder}/{HIDDEN}")


class NamedFiles(DataSource):
    """``df.write.format("tokenloom_named_files")``; options ``path`` and ``lineSep``."""

    @classmethod
    def name(cls) -> str:
        return "tokenloom_named_files"

    def schema(self) -> str:
        return "file string, value string"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter({k.lower(): v for k, v in self.options.items()})


def write_named(planned: DataFrame, folder: str, order: Sequence[str], line_sep: str = "\n") -> None:
    """Write rows ``file, value`` (and the columns of ``order``) to the files that they name, in that order.

    A file is one task's; its size is that of the plan.  Null values are empty records.  The folder must be
    one that Arrow's file systems reach from every executor.
    """
    planned.sparkSession.dataSource.register(NamedFiles)
    rows = planned.repartition("file").sortWithinPartitions("file", *order).select("file", F.col("value").cast("string"))
    rows.write.format(NamedFiles.name()).mode("append").option("lineSep", line_sep).save(folder)
