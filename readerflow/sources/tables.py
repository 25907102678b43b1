"""Keyed tables whose reloads are seen whole or not at all.

A table is a folder of immutable versions, ``data/version=<n>/bucket=<k>``, and of
manifests, ``_manifests/<n>``: one small file that says how the table is bucketed,
its columns, and which version holds each bucket. A write has two phases. First
the new content of the touched buckets is written as a new version, which no
reader looks at. Then the manifest of that number is created, which is one file
and switches all buckets at once. A reader takes the newest manifest, so during a
write it sees the old table, and after it the new one; a write that is cut off
before the switch leaves files that nobody reads. Two writers cannot both create
one manifest: the second is told to write again.

Only buckets that hold a replaced key are read and written; ``vacuum`` removes
what no kept manifest names.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .media import _hadoop, delete, exists, key_bucket


class ConcurrentWrite(RuntimeError):
    """Another writer has replaced the table since this write began."""


class KeyedTable:
    """A bucketed table of rows by ``key`` at ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    # ---- manifests
    def versions(self) -> list[int]:
        """Numbers of the manifests, ascending."""
        folder = f"{self.path}/_manifests"
        if not exists(self.spark, folder):
            return []
        fs, p = _hadoop(self.spark, folder)
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self, version: int | None = None) -> dict | None:
        """The newest manifest (or that of ``version``); None if there is no table."""
        known = self.versions()
        if version is None and not known:
            return None
        fs, p = _hadoop(self.spark, f"{self.path}/_manifests/{known[-1] if version is None else version}")
        stream = fs.open(p)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _switch(self, manifest: dict) -> None:
        """Create the manifest: written under another name, then renamed, which fails if the number is taken."""
        target = f"{self.path}/_manifests/{manifest['version']}"
        fs, made = _hadoop(self.spark, f"{target}.{manifest['writer']}")
        _, final = _hadoop(self.spark, target)
        out = fs.create(made, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        if fs.exists(final) or not fs.rename(made, final):
            fs.delete(made, False)
            raise ConcurrentWrite(target)

    # ---- reading
    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or as they were at ``version``."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(self.path)
        schema = StructType.fromJson(m["schema"])
        return self._buckets(m, schema).select(*schema.names)

    def read_keys(self, keys: DataFrame, key: str) -> DataFrame:
        """The newest rows of the keys in ``keys``; only the buckets that hold these are read."""
        m = self.manifest()
        if m is None or m["key"] != key:
            raise ValueError(f"no table by {key} at {self.path}")
        schema = StructType.fromJson(m["schema"])
        only = [r[0] for r in keys.select(key_bucket(key, m["n_buckets"])).distinct().collect()]  # at most ``n_buckets`` numbers
        return self._buckets(m, schema, only).join(keys.select(key).distinct(), key, "left_semi").select(*schema.names)

    def _buckets(self, m: dict, schema: StructType, only: list[int] | None = None) -> DataFrame:
        paths = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(m["buckets"].items(), key=lambda x: int(x[0])) if only is None or int(b) in only]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # ---- writing
    def replace(self, rows: DataFrame, key: str, buckets: int, gone: DataFrame | None = None) -> int:
        """Replace the keys of ``rows`` (and those of ``gone``, which may have no rows left) in one step; returns the version.

        The table is made if there is none. ``buckets`` must be the number that it was made with.
        """
        spark = self.spark
        m = self.manifest() or {"version": 0, "n_buckets": buckets, "key": key, "schema": rows.schema.jsonValue(), "buckets": {}}
        if (m["n_buckets"], m["key"]) != (buckets, key):
            raise ValueError(f"the table at {self.path} has {m['n_buckets']} buckets by {m['key']}, not {buckets} by {key}")
        schema = StructType.fromJson(m["schema"])
        new = rows.select(*schema.names)
        keys = new.select(key) if gone is None else gone.select(key).unionByName(new.select(key))
        keys = keys.select(F.col(key).alias("__key")).distinct()
        touched = [r[0] for r in keys.select(key_bucket("__key", buckets)).distinct().collect()]  # at most ``buckets`` numbers
        old = self._buckets(m, schema, [b for b in touched if str(b) in m["buckets"]])
        kept = old.join(keys, old[key].eqNullSafe(keys["__key"]), "left_anti")
        # a folder that a cut-off write left is never used again
        version, writer = m["version"] + 1, spark.range(1).select(F.uuid()).first()[0]
        data = f"{self.path}/data/version={version}-{writer}"
        # few files a bucket, and no bucket in one task: AQE joins small parts and splits large ones
        merged = kept.unionByName(new).withColumn("bucket", key_bucket(key, buckets))
        merged.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(data)
        fs, p = _hadoop(spark, data)
        written = [f.getPath().getName().split("=")[1] for f in fs.listStatus(p) if f.getPath().getName().startswith("bucket=")]
        held = {b: v for b, v in m["buckets"].items() if int(b) not in touched} | {b: f"{version}-{writer}" for b in written}
        self._switch(m | {"version": version, "writer": writer, "buckets": held})
        return version

    def vacuum(self, keep: int = 1) -> None:
        """Remove all but the newest ``keep`` manifests, and the versions' folders that none of those names."""
        known = self.versions()
        left, used = known[-max(1, keep):], set()
        for v in left:
            used |= set(self.manifest(v)["buckets"].items())
        for v in known:
            if v not in left:
                delete(self.spark, f"{self.path}/_manifests/{v}")
        fs, p = _hadoop(self.spark, f"{self.path}/data")
        for f in fs.listStatus(p):
            version = f.getPath().getName().split("=")[1]
            for b in fs.listStatus(f.getPath()):
                name = b.getPath().getName()
                if name.startswith("bucket=") and (name.split("=")[1], version) not in used:
                    fs.delete(b.getPath(), True)
            if not any(version == v for _, v in used):
                fs.delete(f.getPath(), True)
