"""A warehouse folder that is rebuilt as a whole.

Every build writes its tables into version folders of their own and then commits: one
marker file, whose name holds the version, appears in ``_commits``. Readers take the
newest marker, so they see a build with all of its tables or not at all; a build that
fails leaves no marker and changes nothing. Files of committed versions are never
touched until ``vacuum``, so a reader that has started keeps its version.

    root/<model>/<version>/...            Parquet, plain, partitioned or bucketed
    root/_manifests/<version>.json        schemas, layouts, views, where the raw tables are
    root/_commits/<number>-<version>      empty; the greatest name is current

``attach`` makes a committed version readable in any later session: tables (bucketed
ones with their buckets), the models that stay views (built lazily from the raw tables
that the manifest names) and views with stored SQL.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------- files

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, *parts) if any(parts) else self.root)

    def _names(self, *parts: str) -> list[str]:
        at = self._path(*parts)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _create(self, text: str, *parts: str) -> None:
        """A new file; an error if there is one."""
        out = self._fs.create(self._path(*parts), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def _read(self, *parts: str) -> str:
        stream = self._fs.open(self._path(*parts))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    # ------------------------------------------------------------- versions

    def commits(self) -> list[str]:
        """The markers, oldest first."""
        return self._names("_commits")

    def current(self) -> str | None:
        """The version that readers see."""
        done = self.commits()
        return done[-1].split("-", 1)[1] if done else None

    def begin(self) -> str:
        """A name for a new version; nothing is written yet."""
        return uuid.uuid4().hex

    def commit(self, version: str, tables: dict[str, dict], views: dict[str, str] | None = None, source: dict | None = None) -> None:
        """Make ``version`` current. ``tables``: what ``write`` gave for each of them. Stored views of the version before are kept."""
        last = self.current()
        kept = self.manifest(last)["views"] if last else {}
        self._create(json.dumps({"tables": tables, "views": kept | (views or {}), "source": source}, indent=1), "_manifests", f"{version}.json")
        done = self.commits()
        number = int(done[-1].split("-", 1)[0]) + 1 if done else 0
        self._create("", "_commits", f"{number:010d}-{version}")

    def manifest(self, version: str) -> dict:
        return json.loads(self._read("_manifests", f"{version}.json"))

    def create_view(self, name: str, sql: str) -> None:
        """Store a view over the warehouse's tables and views; a commit of its own that shares all tables."""
        last = self.current()
        if last is None:
            raise ValueError("nothing is built yet")
        m = self.manifest(last)
        self.commit(self.begin(), m["tables"], {name: sql}, m["source"])

    def vacuum(self, keep: int = 2) -> list[str]:
        """Drop committed versions but the newest ``keep``: their markers first, then table folders that no kept version names. Builds under way are not touched."""
        done = self.commits()
        old, new = done[:-keep] if keep else done, done[-keep:] if keep else []
        used = {t["path"] for c in new for t in self.manifest(c.split("-", 1)[1])["tables"].values()}
        gone = {t["path"] for c in old for t in self.manifest(c.split("-", 1)[1])["tables"].values()} - used
        for c in old:
            self._fs.delete(self._path("_commits", c), False)
        for path in sorted(gone):
            self._fs.delete(self._path(path), True)
        for c in old:
            self._fs.delete(self._path("_manifests", f"{c.split('-', 1)[1]}.json"), False)
        return sorted(gone)

    # ------------------------------------------------------------- tables

    def write(self, version: str, name: str, df: DataFrame, partition_by: Sequence[str] = (), bucket_by: Sequence[str] = (),
              sort_by: Sequence[str] = (), buckets: int | None = None, observe: dict[str, Column] | None = None,
              columns: Sequence[str] | None = None) -> tuple[DataFrame, dict, dict]:
        """Write one table of a version: (a scan of it, its manifest entry, what was observed).

        ``bucket_by`` deals the rows to files by hash and sorts them, so that later joins and groups by those columns need no
        shuffle. ``sort_by`` without buckets range-partitions: files follow each other in order. ``observe`` are aggregates
        that are taken from the rows on their way out, at no second scan. ``columns`` are those of the table; other columns of ``df``
        are in its files and in the scan that is returned, but in no later one.
        """
        path = f"{name}/{version}"
        seen = None
        entry = {"path": path, "schema": df.select(*columns or df.columns).schema.jsonValue(), "partition_by": list(partition_by), "bucket_by": list(bucket_by), "buckets": None}
        if bucket_by:
            n = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            entry["buckets"] = n
            df = df.repartition(n, *bucket_by)  # the same hash: a file for each bucket
        elif partition_by:
            df = df.hint("rebalance", *partition_by)
        elif sort_by:
            df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        if observe:
            seen = Observation(f"{name}-{version}")
            df = df.observe(seen, *(c.alias(k) for k, c in observe.items()))
        w = df.write.mode("errorifexists").format("parquet").option("path", os.path.join(self.root, path))
        if bucket_by:
            w.bucketBy(entry["buckets"], *bucket_by).sortBy(*bucket_by).saveAsTable(self._table(version, name))
        else:
            (w.partitionBy(*partition_by) if partition_by else w).save()
        return self._scan(version, name, entry | {"schema": df.schema.jsonValue()}), entry, dict(seen.get) if seen else {}

    def _table(self, version: str, name: str) -> str:
        return f"rf_{version[:16]}_{name}"

    def _scan(self, version: str, name: str, entry: dict) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        location = os.path.join(self.root, entry["path"])
        if not entry["bucket_by"]:
            return self.spark.read.schema(schema).parquet(location).select(*schema.names)
        table = self._table(version, name)
        if not self.spark.catalog.tableExists(table):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            by = ", ".join(f"`{c}`" for c in entry["bucket_by"])
            self.spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {entry['buckets']} BUCKETS LOCATION '{location}'")
        return self.spark.table(table).select(*schema.names)

    # ------------------------------------------------------------- reading

    def tables(self, version: str | None = None) -> dict[str, DataFrame]:
        """The tables of a version (the current one by default), as they are however often the warehouse is rebuilt meanwhile."""
        version = version or self.current()
        if version is None:
            return {}
        # A stored view's commit shares the tables of the version that wrote them.
        return {n: self._scan(e["path"].rsplit("/", 1)[1], n, e) for n, e in self.manifest(version)["tables"].items()}

    def attach(self, version: str | None = None) -> dict[str, DataFrame]:
        """Register a version in this session: its tables, the models that are views, and stored views, as temporary views by name."""
        from rankforge.plans.graph import MODEL_ORDER, ModelGraph
        from rankforge.sources.io import read_all_raw

        version = version or self.current()
        if version is None:
            return {}
        m = self.manifest(version)
        out = self.tables(version)
        if m["source"]:
            graph = ModelGraph(read_all_raw(self.spark, m["source"]["raw"], m["source"]["format"]), reuse_shared=False, **m["source"]["options"])
            for name, df in out.items():
                graph.replace(name, df)
            out |= {n: graph[n] for n in MODEL_ORDER if n not in out}
        for name, df in out.items():
            df.createOrReplaceTempView(name)
        for name, sql in m["views"].items():
            out[name] = self.spark.sql(sql)
            out[name].createOrReplaceTempView(name)
        return out
