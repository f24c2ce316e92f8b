"""Tables published by version: readers see a whole version or the one before, never half of one.

A version is a folder of tables. It is written beside the others, and then one small file that names the
current version is replaced in a single step. What fails before that step leaves everything as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .shared import SharedTables, _file_system, delete_folder

_POINTER = "CURRENT.json"


class Version(SharedTables):
    """The tables of one version, by the labels they were published under."""

    def __init__(self, spark: SparkSession, root: str, one: str, tables: Mapping[str, Mapping[str, str]] = {}):
        self.spark, self.id, self.path = spark, one, f"{root}/{one}"
        self._folders = set()
        self._labels = {label: held["name"] for label, held in tables.items()}
        self._tables = {}
        for held in tables.values():
            schema = T.StructType.fromJson(json.loads(held["schema"]))
            self._tables[held["name"]] = spark.read.schema(schema).parquet(f"{self.path}/{held['name']}")

    def label(self, names: Mapping[str, str]) -> None:
        """Say under which labels stored tables are published."""
        self._labels = dict(names)

    def path_of(self, label: str) -> str:
        return f"{self.path}/{self._labels[label]}"

    def read(self, label: str) -> DataFrame:
        return self._tables[self._labels[label]]

    def entries(self) -> dict[str, dict[str, str]]:
        return {
            label: {"name": name, "schema": self._tables[name].schema.json()}
            for label, name in self._labels.items()
        }


class Published:
    """Versions of a set of tables below one folder of the shared file system."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        """``keep`` versions stay, so that readers of the one before can finish."""
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def _state(self) -> dict:
        where, files = _file_system(self.spark, f"{self.root}/{_POINTER}")
        if not files.exists(where):
            return {"versions": [], "tables": {}}
        stream = files.open(where)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _point(self, state: dict) -> None:
        """Replace the pointer in one step: written beside it, then renamed over it."""
        beside, files = _file_system(self.spark, f"{self.root}/.{_POINTER}-{uuid.uuid4().hex}")
        stream = files.create(beside, True)
        try:
            stream.write(json.dumps(state).encode())
        finally:
            stream.close()
        jvm = self.spark.sparkContext._jvm
        hadoop = jvm.org.apache.hadoop.fs
        rename = getattr(hadoop, "Options$Rename")
        over = self.spark.sparkContext._gateway.new_array(rename, 1)
        over[0] = rename.OVERWRITE
        context = hadoop.FileContext.getFileContext(
            files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        pointer, _ = _file_system(self.spark, f"{self.root}/{_POINTER}")
        context.rename(files.makeQualified(beside), files.makeQualified(pointer), over)

    def versions(self) -> list[str]:
        """The versions that can be read, the current one first."""
        return self._state()["versions"]

    def current(self) -> Version:
        state = self._state()
        if not state["versions"]:
            raise LookupError(f"nothing has been published below {self.root}")
        return Version(self.spark, self.root, state["versions"][0], state["tables"])

    def read(self, label: str) -> DataFrame:
        """A table of the current version."""
        return self.current().read(label)

    @contextmanager
    def new_version(self) -> Iterator[Version]:
        """Tables to be written. Left without an error they become the current version, else they are removed."""
        version = Version(self.spark, self.root, f"v{uuid.uuid4().hex}")
        try:
            yield version
            before = self._state()["versions"]
            stay = [version.id, *before][: self.keep]
            self._point({"versions": stay, "tables": version.entries()})
        except BaseException:
            delete_folder(self.spark, version.path)
            raise
        for one in before:
            if one not in stay:
                delete_folder(self.spark, f"{self.root}/{one}")
