"""A Spark data source of gzip objects, each under its own key.

    pages.select("s3_key", "html").write.format("keyed_objects").option("path", root).mode("append").save()
    spark.read.format("keyed_objects").option("path", root).load()

Tasks write objects straight under their keys, and list them in a manifest of their own. A
write counts once its driver has named the manifests of the tasks that succeeded in one
commit file; a reader sees only what a commit names. A task that fails deletes what it wrote;
what a lost executor leaves is in no commit, and is overwritten by the task that runs instead
of it, or swept by the abort. The driver handles a name for each task, never one for each object.

Filters on s3_key (=, IN, LIKE 'prefix%') choose manifests by their first and last key, and
objects before they are fetched.
"""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "s3_key string, html string"
_COMMITS, _MANIFESTS = "_commits", "_manifests"


def _store(path: str):
    """The file system and the path in it. It has threads, so it is loaded by the worker that uses it, not before workers fork."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))


def _put(store, path: str, data: bytes) -> None:
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path, compression=None) as out:
        out.write(data)


def _get(store, path: str) -> bytes:
    with store.open_input_stream(path, compression=None) as f:
        return f.read()


def _listed(store, path: str) -> list[str]:
    from pyarrow import fs

    return [info.path for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True))]


def _delete(store, paths: list[str]) -> None:
    for path in paths:
        if store.get_file_info(path).is_file:
            store.delete_file(path)


@dataclass
class Written(WriterCommitMessage):
    """A task's manifest, and the first and last of its keys; '' for a task without rows."""

    manifest: str
    first: str
    last: str


class ObjectWriter(DataSourceWriter):
    def __init__(self, path: str, schema: StructType):
        if not {"s3_key", "html"} <= set(schema.names):
            raise ValueError("objects have columns s3_key and html")
        self.path, self.at, self.job = path, [schema.names.index(c) for c in ("s3_key", "html")], uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Written:
        """Null html is an empty object; a null key is an error."""
        store, root = _store(self.path)
        keys: list[str] = []
        try:
            for row in iterator:
                key, html = (row[i] for i in self.at)
                if not key or key.startswith(("_", "/")) or ".." in key.split("/"):
                    raise ValueError(f"not a key of an object: {key!r}")
                keys.append(key)
                _put(store, f"{root}/{key}", gzip.compress((html or "").encode(), mtime=0))
            if not keys:
                return Written("", "", "")
            manifest = f"{_MANIFESTS}/{self.job}/{uuid.uuid4().hex}"
            _put(store, f"{root}/{manifest}", "\n".join(keys).encode())
            return Written(manifest, min(keys), max(keys))
        except BaseException:
            _delete(store, [f"{root}/{key}" for key in keys])
            raise

    def commit(self, messages: list) -> None:
        store, root = _store(self.path)
        named = [[m.manifest, m.first, m.last] for m in messages if m is not None and m.manifest]
        _put(store, f"{root}/{_COMMITS}/{self.job}.json", json.dumps(named).encode())

    def abort(self, messages: list) -> None:
        store, root = _store(self.path)
        for manifest in _listed(store, f"{root}/{_MANIFESTS}/{self.job}"):
            _delete(store, [*(f"{root}/{key}" for key in _get(store, manifest).decode().split("\n")), manifest])


@dataclass
class Manifest(InputPartition):
    name: str


class ObjectReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.prefix, self.keys = path, "", None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            match f:
                case StringStartsWith(("s3_key",), value) if value.startswith(self.prefix):
                    self.prefix = value
                case EqualTo(("s3_key",), value) if self.keys is None:
                    self.keys = {value}
                case In(("s3_key",), values) if self.keys is None:
                    self.keys = set(values)
                case _:
                    yield f

    def _wanted(self, key: str) -> bool:
        return key.startswith(self.prefix) and (self.keys is None or key in self.keys)

    def partitions(self) -> list[InputPartition]:
        store, root = _store(self.path)
        found = []
        for commit in _listed(store, f"{root}/{_COMMITS}"):
            for name, first, last in json.loads(_get(store, commit)):
                near = last >= self.prefix and (first <= self.prefix or first.startswith(self.prefix))
                if near and (self.keys is None or any(first <= k <= last for k in self.keys)):
                    found.append(Manifest(name))
        return found

    def read(self, partition: Manifest | None) -> Iterator[tuple]:
        if partition is None:  # no commit yet
            return
        store, root = _store(self.path)
        for key in _get(store, f"{root}/{partition.name}").decode().split("\n"):
            if self._wanted(key):
                yield key, gzip.decompress(_get(store, f"{root}/{key}")).decode()


class KeyedObjects(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyed_objects"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("objects are only added")
        return ObjectWriter(self.options["path"], schema)

    def reader(self, schema: StructType) -> DataSourceReader:
        return ObjectReader(self.options["path"])
