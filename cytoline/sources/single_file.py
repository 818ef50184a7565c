"""Text written to one file, by a data source with a commit: sorted parts side by side, then joined, or nothing at all.

Each task writes its rows to a part of its own in a folder beside the file. The commit joins the parts in order of their
tasks, in blocks, and moves the result to its place in one step; a job that fails leaves neither file nor parts. Without
rows there is no file, and one that was there before goes. For files that a person or another tool reads, such as lists
of intervals: joining runs through one process, so tables of any size belong in folders of parts.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .pileup_source import opened

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["cytoline.sources.pileup_source"])

BLOCK = 8 << 20


@dataclass
class Part(WriterCommitMessage):
    name: str
    number: int
    rows: int


class SingleFileWriter(DataSourceArrowWriter):
    def __init__(self, path: str, header: str | None):
        self.path, self.header = path, header
        self.parts = f"{path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        store, folder = opened(self.parts)
        task, rows = TaskContext.get(), 0
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/{name}") as out:
            for batch in iterator:
                lines = pc.binary_join_element_wise(pc.fill_null(batch.column(0), ""), "\n", "")
                out.write("".join(lines.to_pylist()).encode())
                rows += batch.num_rows
        return Part(name, task.partitionId(), rows)

    def commit(self, messages: list[Part | None]) -> None:
        store, target = opened(self.path)
        _, folder = opened(self.parts)
        kept = sorted((m for m in messages if m and m.rows), key=lambda m: m.number)
        if kept:
            with store.open_output_stream(f"{folder}/joined") as out:
                if self.header is not None:
                    out.write(f"{self.header}\n".encode())
                for part in kept:
                    with store.open_input_stream(f"{folder}/{part.name}") as f:
                        while block := f.read(BLOCK):
                            out.write(block)
        if (there := store.get_file_info(target).type) == fs.FileType.Directory:
            store.delete_dir(target)
        elif there == fs.FileType.File and not kept:
            store.delete_file(target)
        if kept:
            store.move(f"{folder}/joined", target)
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)

    def abort(self, messages: list[Part | None]) -> None:
        store, folder = opened(self.parts)
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


class SingleFile(DataSource):
    """Options: ``path``; ``header``, a first line. Rows are of one text column."""

    @classmethod
    def name(cls) -> str:
        return "single_file"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> SingleFileWriter:
        options = {k.lower(): v for k, v in self.options.items()}
        return SingleFileWriter(options["path"], options.get("header"))


def write(df: DataFrame, path: str, sep: str = "\t", header: bool = False, missing: str = "") -> None:
    """The rows of ``df``, in the order of its partitions, as one text file; no file without rows. Nulls are ``missing``."""
    df.sparkSession.dataSource.register(SingleFile)
    line = F.concat_ws(sep, *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(missing)) for c in df.columns)).alias("value")
    out = df.select(line).write.format("single_file").mode("overwrite")
    (out.option("header", sep.join(df.columns)) if header else out).save(path)
