"""A stored table kept by key: rows lie in buckets by a hash of the key, and a change rewrites only the buckets it touches.

Layout under ``base``: ``data/<name>/bucket=<k>/`` holds files of one write, which are never written again, and
``manifest/<version>.json`` says which folder each bucket is read from, with the table's columns. A version comes into being by
one rename of its manifest to a name that must not exist yet; until then readers see the version before, so a write that fails
leaves nothing but unread files, and of two writers one must start anew. The driver handles one line per bucket.

Rows of untouched buckets keep their files. Columns that a change adds are null in older files, which are read under the
table's present columns; a change that drops a column rewrites all buckets, so that the column can come again without old values.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hirelattice.operators.upsert import align, delete_by, upsert
from hirelattice.operators.dedup import dedup_rank

BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer has made the same version first; read again and redo the change."""


class _Files:
    """The few file operations that the manifest needs, on whatever file system ``base`` names."""

    def __init__(self, spark: SparkSession, base: str):
        self._jvm = spark._jvm.org.apache.hadoop.fs
        self.base = base.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self._bytes = spark._jvm.org.apache.hadoop.io.IOUtils
        self._out = spark._jvm.java.io.ByteArrayOutputStream

    def path(self, name: str):
        return self._jvm.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        source, out = self.fs.open(self.path(name)), self._out()
        self._bytes.copyBytes(source, out, 65536, True)
        return out.toString("UTF-8")

    def create(self, name: str, text: str) -> bool:
        """Write under a name of its own, then rename; False if ``name`` is there already."""
        draft = self.path(f"draft-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.fs.mkdirs(self.path(name).getParent())
        # a rename never replaces a file here; local file systems need the check beforehand
        done = not self.fs.exists(self.path(name)) and self.fs.rename(draft, self.path(name))
        if not done:
            self.fs.delete(draft, False)
        return done

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class BucketedTable:
    """``keys`` and the number of buckets are fixed when the first version is written.

    Rows whose key holds a null are kept, and added anew by every change, as in ``upsert``.
    """

    def __init__(self, spark: SparkSession, base: str, keys: list[str], buckets: int = 64):
        self.spark, self.base, self.keys, self.buckets = spark, base.rstrip("/"), keys, buckets
        self._files = _Files(spark, base)
        first = self.versions()[:1]
        if first:
            self.buckets = self._manifest(first[0])["buckets"]

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._files.names("manifest") if n.endswith(".json") and not n.startswith(".")]

    def _name(self, version: int) -> str:
        return f"manifest/{version:010d}.json"

    def _manifest(self, version: int) -> dict:
        return json.loads(self._files.read(self._name(version)))

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def files_of(self, version: int | None = None) -> dict[int, str]:
        """The folder, below ``base``, that each bucket of a version is read from."""
        version = self.latest() if version is None else version
        return {int(k): v for k, v in self._manifest(version)["folders"].items()} if version is not None else {}

    def applied(self, writer: str) -> int | None:
        """The last change of that writer that the table holds."""
        version = self.latest()
        return None if version is None else self._manifest(version)["applied"].get(writer)

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The table as of a version, by default the newest; ``buckets`` opens only these."""
        version = self.latest() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no version of a table in {self.base}")
        manifest = self._manifest(version)
        schema = T.StructType.fromJson(manifest["schema"])
        folders = [v for k, v in manifest["folders"].items() if buckets is None or int(k) in buckets]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/{f}" for f in folders])

    def _bucket(self):
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _store(self, rows: DataFrame, label: str) -> tuple[str, list[int]]:
        """Write rows by bucket; the folder's name and the buckets it has."""
        name = f"data/{label}-{uuid.uuid4().hex}"
        rows.withColumn(BUCKET, self._bucket()).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.base}/{name}")
        return name, [int(n.split("=")[1]) for n in self._files.names(name) if n.startswith(f"{BUCKET}=")]

    def _commit(self, base: int | None, schema: T.StructType, folders: dict[int, str], writer: tuple[str, int] | None) -> int:
        version = 0 if base is None else base + 1
        applied = {} if base is None else self._manifest(base)["applied"]
        if writer:
            applied[writer[0]] = writer[1]
        text = json.dumps({"buckets": self.buckets, "schema": schema.jsonValue(), "folders": folders, "applied": applied})
        if not self._files.create(self._name(version), text):
            raise Conflict(f"version {version} of {self.base} is there already")
        return version

    def _skips(self, writer: tuple[str, int] | None) -> bool:
        last = self.applied(writer[0]) if writer else None
        return last is not None and last >= writer[1]

    def replace(self, rows: DataFrame, writer: tuple[str, int] | None = None) -> int:
        """All rows anew, as a first version or in place of what is there."""
        if self._skips(writer):
            return self.latest()
        base = self.latest()
        name, have = self._store(rows, "whole")
        return self._commit(base, rows.schema, {k: f"{name}/{BUCKET}={k}" for k in have}, writer)

    def upsert(self, batch: DataFrame, mode: str = "append_new", order: list | None = None, writer: tuple[str, int] | None = None,
               base: int | None = None) -> int:
        """Rows of ``batch`` in place of rows of the same key; the version that holds them.

        ``writer`` names a stream of changes and numbers this one: a change that the table holds already is left out, so that it may
        be delivered again. ``base`` is the version the change was worked out from, by default the newest.
        """
        if self._skips(writer):
            return self.latest()
        base = self.latest() if base is None else base
        # written once, by bucket: tells the buckets touched, and the rows can't change while they are merged
        staged, touched = self._store(dedup_rank(batch, self.keys, order) if order else batch, "staged")
        fresh = self._staged(staged, touched, batch.schema)
        if base is None:
            return self._commit(base, batch.schema, {k: f"{staged}/{BUCKET}={k}" for k in touched}, writer)
        folders = self.files_of(base)
        old = self.read(base, touched)
        new, _ = align(old, fresh, mode)
        dropped = set(old.columns) - set(new.columns)
        if dropped:
            old, touched = self.read(base), sorted({*touched, *folders})
        if set(new.columns) == set(batch.columns) and not dropped and not any(k in folders for k in touched):
            written, have = staged, touched  # nothing to merge with
        else:
            written, have = self._store(upsert(old, fresh, self.keys, mode), "merged")
        schema = align(old, fresh, mode)[0].schema
        kept = {k: v for k, v in folders.items() if k not in touched}
        version = self._commit(base, schema, kept | {k: f"{written}/{BUCKET}={k}" for k in have}, writer)
        if written != staged:
            self._files.delete(staged)
        return version

    def delete(self, ids: DataFrame, writer: tuple[str, int] | None = None) -> int:
        """Without the rows whose key is among ``ids``; only their buckets are written."""
        if self._skips(writer):
            return self.latest()
        base = self.latest()
        if base is None:
            raise FileNotFoundError(f"no version of a table in {self.base}")
        staged, touched = self._store(ids.select(*self.keys).distinct(), "staged")
        old = self.read(base, touched)
        written, have = self._store(delete_by(old, self._staged(staged, touched, ids.select(*self.keys).schema), self.keys), "merged")
        kept = {k: v for k, v in self.files_of(base).items() if k not in touched}
        version = self._commit(base, old.schema, kept | {k: f"{written}/{BUCKET}={k}" for k in have}, writer)
        self._files.delete(staged)
        return version

    def _staged(self, name: str, buckets: list[int], schema: T.StructType) -> DataFrame:
        if not buckets:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/{name}/{BUCKET}={k}" for k in buckets])

    def vacuum(self, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` versions and the files that only they read; how many folders went.

        Files of a change still being written are not told apart from forgotten ones: run it between changes.
        """
        versions = self.versions()
        stay = versions[-keep:]
        used = {f for v in stay for f in self.files_of(v).values()}
        for version in versions[:-keep]:
            self._files.delete(self._name(version))
        gone = 0
        for write in self._files.names("data"):
            parts = [f"data/{write}/{p}" for p in self._files.names(f"data/{write}") if p.startswith(f"{BUCKET}=")]
            left = [p for p in parts if p in used]
            for p in parts if left else [f"data/{write}"]:
                if p not in used:
                    self._files.delete(p)
                    gone += 1
        return gone
