"""Recognized documents kept as JSON, one file for each hash."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import datasource as ds

from .. import schemas
from . import stores


def documents(spark: SparkSession, path: str) -> DataFrame:
    """One multi-line JSON object per file; the confidence is a double even where the file has a whole number."""
    return spark.read.schema(schemas.OCR_DOCUMENT).option("multiLine", True).json(path)


class _Written(ds.WriterCommitMessage):
    def __init__(self, n: int):
        self.n = n


class _Writer(ds.DataSourceWriter):
    def __init__(self, options: dict[str, str], schema):
        self.folder = stores.local_name(options["path"].rstrip("/"))
        self.ending = options.get("ending", "_ocr.json")
        self.draft = f"{self.folder}/.draft-{uuid.uuid4().hex}"

    def write(self, rows: Iterator[Row]) -> _Written:
        """All of a task's files are written aside and renamed to their names at its end: none is ever partial, a task that runs again replaces its own."""
        store, task = stores.of(self.folder), f"{self.draft}/{uuid.uuid4().hex}"
        store.make(task)
        names = []
        for row in rows:
            found = row.asDict(recursive=True)
            names.append(f"{found['file_hash']}{self.ending}")
            store.put(f"{task}/{names[-1]}", json.dumps(found, ensure_ascii=False, indent=2).encode())
        for name in names:
            store.move(f"{task}/{name}", f"{self.folder}/{name}")
        return _Written(len(names))

    def commit(self, messages: list[_Written]) -> None:
        stores.of(self.folder).remove(self.draft)

    def abort(self, messages: list[_Written]) -> None:
        """What tasks had finished stays, whole; the rest goes."""
        stores.of(self.folder).remove(self.draft)


class CorpusJson(ds.DataSource):
    """``df.write.format("corpus_json").mode("append").save(folder)``: a file ``<file_hash>_ocr.json`` for each row; repeated hashes of a task keep the last."""

    @classmethod
    def name(cls) -> str:
        return "corpus_json"

    def writer(self, schema, overwrite: bool) -> ds.DataSourceWriter:
        return _Writer(self.options, schema)


def write(docs: DataFrame, folder: str) -> None:
    docs.sparkSession.dataSource.register(CorpusJson)
    docs.select("file_hash", "source_pdf", "ocr_results", "total_pages").write.format("corpus_json").mode("append").save(folder)
