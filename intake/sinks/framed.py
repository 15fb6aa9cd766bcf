"""Writing files of the ``framed`` format (:class:`intake.sources.formats.Framed`).

``write_framed`` is a ``DataSource`` writer: a task writes its records below a
staging folder, a new file wherever the column ``file_by`` changes, and the files
are moved to their places only when the job commits; what a failed attempt or job
staged is deleted.  A commit message is a task's list of files.
"""

from __future__ import annotations

import datetime as dt
import decimal
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceWriter, WriterCommitMessage

from intake.sources import storage
from intake.sources.formats import Framed


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]]        # staged, final


def _text(value):
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    raise TypeError(f"no JSON for {type(value).__name__}")


class _FramedWriter(DataSourceWriter):
    def __init__(self, options, run: str):
        self.folder, self.by = options["path"].rstrip("/"), options.get("file_by")
        self.staging = f"{self.folder}/_staging-{run}"

    def write(self, rows):
        records = (row.asDict(recursive=True) for row in rows)
        return self.write_records((r.pop(self.by) if self.by else None, r) for r in records)

    def write_records(self, records):
        """Write (key, record)."""
        from pyspark import TaskContext

        task, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        files, out, last, count = [], None, None, 0
        encode = json.JSONEncoder(default=_text, ensure_ascii=False).encode

        def close():
            out.write(Framed.HEAD.pack(Framed.END, count & 0xFFFFFFFF))
            out.close()

        try:
            for key, record in records:
                if out is None or key != last:
                    if out is not None:
                        close()
                    name = f"{key}.frm" if self.by else f"part-{task:05d}.frm"
                    staged = f"{self.staging}/{attempt}/{name}"
                    out, last, count = storage.open_output(staged), key, 0
                    files.append((staged, f"{self.folder}/{name}"))
                    out.write(Framed.MAGIC)
                out.write(Framed.frame(encode(record).encode()))
                count += 1
        finally:
            if out is not None and not out.closed:
                close()
        return _Written(files)

    def commit(self, messages):
        for m in messages:
            for staged, final in m.files if m else ():
                storage.move(staged, final)
        storage.remove_folder(self.staging)

    def abort(self, messages):
        storage.remove_folder(self.staging)


# of these a batch's columns give the values that rows give
_PLAIN = (T.StringType, T.BooleanType, T.IntegralType, T.FractionalType, T.DateType, T.TimestampNTZType)


class _FramedBatchWriter(_FramedWriter, DataSourceArrowWriter):
    """Records of plain columns, taken from Arrow batches without a row object each."""

    def write(self, batches):
        return self.write_records(r for b in batches for r in self._records(b))

    def _records(self, batch):
        names = [n for n in batch.schema.names if n != self.by]
        keys = batch.column(self.by).to_pylist() if self.by else [None] * batch.num_rows
        if not names:
            return ((k, {}) for k in keys)
        return zip(keys, (dict(zip(names, v)) for v in zip(*[batch.column(n).to_pylist() for n in names])))


class FramedSink(DataSource):
    @classmethod
    def name(cls):
        return "framed_sink"

    def writer(self, schema, overwrite):
        plain = all(isinstance(f.dataType, _PLAIN) for f in schema)
        return (_FramedBatchWriter if plain else _FramedWriter)(self.options, uuid.uuid4().hex)


def write_framed(df: DataFrame, folder: str, file_by: str | None = None) -> None:
    """Write ``df`` as framed files below ``folder``: one a task, or ``<value>.frm`` per value of ``file_by``,
    whose rows must be next to each other and in one task (``repartition`` and ``sortWithinPartitions`` by it)."""
    spark = df.sparkSession
    if not storage.openable(folder):
        raise ValueError(f"tasks cannot write to {folder}")
    spark.dataSource.register(FramedSink)
    writer = df.write.format("framed_sink").mode("append")
    (writer.option("file_by", file_by) if file_by else writer).save(folder)
