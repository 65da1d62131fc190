"""Versioned layer store (SINK-9, SINK-11).

The reference commits all statements of a layer in one transaction. Files
have no cross-table transactions, and a table cannot be overwritten while it
is being read, so every run writes each table of a layer into a *new* version
directory and publishes the layer by writing a marker last::

    {base}/bronze/{entity}/load={id}/       append-only Parquet, one directory per load
    {base}/{layer}/v000007/{table}/         one immutable version per run
    {base}/{layer}/_published/after-v000006 marker: version 7 (its text) follows version 6

Readers take the last published version, so a failed run leaves the
previous version in place. A run claims its version number with a marker that
only one run can create (``begin``), so two runs never write the same version.
Publishing is a compare-and-swap on the version that the run began from: the
marker bears the parent's name and is put in place, whole, only where none is
(a rename that does not replace, on one machine a hard link). Of all runs that began
from version 6 exactly one publishes; the others fail and lose nobody's rows. Markers
are some bytes each and stay when ``vacuum`` removes their versions. Only a missing path
before the first publication reads as empty; any other error is raised. The base
may be any shared file system whose rename is atomic and does not replace, as HDFS's is.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.keys import materialize, with_known_rows
from strata.operators.lookup import broadcast_if_small
from strata.schemas import PARTITION_BY, empty_frame, schema_of


class StoreConflict(Exception):
    """Another run wrote or published the version in question."""


class LayerStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self._begun: dict = {}  # (layer, version) -> the version that was published when it began

    def _path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        found = jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), found

    def exists(self, path: str) -> bool:
        fs, found = self._path(path)
        return fs.exists(found)

    def delete(self, path: str) -> None:
        fs, found = self._path(path)
        fs.delete(found, True)

    def _put_new(self, path: str, text: str) -> bool:
        """``path`` with ``text``, at once and only if there is none; whether it was put."""
        fs, target = self._path(path)
        jvm = self.spark.sparkContext._jvm
        fs.mkdirs(target.getParent())
        _, draft = self._path(f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if fs.getUri().getScheme() != "file":
                return not fs.exists(target) and fs.rename(draft, target)
            files = jvm.java.nio.file
            local = lambda p: files.Paths.get(p.toUri().getPath(), self.spark.sparkContext._gateway.new_array(jvm.String, 0))
            try:
                files.Files.createLink(local(target), local(draft))
                return True
            except Exception:
                if fs.exists(target):
                    return False
                raise
        finally:
            fs.delete(draft, False)

    def begin(self, layer: str) -> int:
        """Claim a version number that no other run has: the next after every
        claimed or published one. ``create`` without overwriting is exclusive."""
        current = self.current_version(layer)
        version = current
        while True:
            version += 1
            fs, claim = self._path(f"{self.base}/{layer}/_claimed/v{version:06d}")
            if fs.exists(claim) or self.exists(self._vdir(layer, version)):
                continue
            try:
                fs.create(claim, False).close()
            except Exception:
                if fs.exists(claim):  # another run was faster
                    continue
                raise
            self._begun[layer, version] = current
            return version

    # -- paths ---------------------------------------------------------------
    def _vdir(self, layer: str, version: int) -> str:
        return f"{self.base}/{layer}/v{version:06d}"

    def table_path(self, layer: str, table: str, version: int | None = None) -> str:
        if layer == "bronze":
            return f"{self.base}/bronze/{table}"
        return f"{self._vdir(layer, version)}/{table}"

    # -- versions ------------------------------------------------------------
    def _published(self, layer: str) -> list:
        """The markers' names, ascending: each version's parent is older than itself, and the
        last marker's text is the current version."""
        fs, root = self._path(f"{self.base}/{layer}/_published")
        if not fs.exists(root):
            return []
        return sorted(n for n in (st.getPath().getName() for st in fs.listStatus(root)) if n.startswith("after-v"))

    def _version_in(self, layer: str, marker: str) -> int:
        fs, found = self._path(f"{self.base}/{layer}/_published/{marker}")
        jvm = self.spark.sparkContext._jvm
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(found)))
        try:
            return int(lines.readLine())
        finally:
            lines.close()

    def current_version(self, layer: str) -> int:
        markers = self._published(layer)
        return self._version_in(layer, markers[-1]) if markers else 0

    def publish(self, layer: str, version: int) -> None:
        """Make ``version`` the successor of the version its run began from, if none is yet."""
        parent = self._begun.get((layer, version))
        parent = self.current_version(layer) if parent is None else parent
        if not self._put_new(f"{self.base}/{layer}/_published/after-v{parent:06d}", str(version)):
            raise StoreConflict(f"{layer} v{version}: another run has published a successor of version {parent}")

    # -- tables --------------------------------------------------------------
    def read(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        """The table at ``version`` (default: published); an empty DataFrame
        with the registered schema on first run (SINK-10): before any version
        is published, or before a bronze table's first load. A published
        version without the table is an error."""
        schema = schema_of(layer, table)
        if layer != "bronze":
            version = self.current_version(layer) if version is None else version
            if version == 0:
                return empty_frame(self.spark, schema)
        elif not self.exists(self.table_path(layer, table)):
            return empty_frame(self.spark, schema)
        df = self.spark.read.schema(schema).parquet(self.table_path(layer, table, version))
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])

    def write(self, layer: str, table: str, df: DataFrame, version: int) -> DataFrame:
        """Materialise one table of an unpublished version and read it back,
        which also cuts the lineage for the steps that depend on it."""
        path = self.table_path(layer, table, version)
        if (layer, version) not in self._begun and self.exists(self._vdir(layer, version)):
            raise StoreConflict(f"{layer} v{version} exists and is not this run's")
        self._begun.setdefault((layer, version), self.current_version(layer))
        parts = PARTITION_BY.get((layer, table), [])
        if parts:  # small values share a task and a large one is split over several, once their sizes are known
            df = df.hint("rebalance", *parts)
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", "zstd").partitionBy(*parts).parquet(path)
        return with_known_rows(self.spark.read.schema(df.schema).parquet(path).select(*df.columns), seen.get["n"])

    def versions(self, layer: str) -> list:
        """Published version numbers of ``layer`` that are still there, ascending."""
        found = (self._version_in(layer, m) for m in self._published(layer))
        return sorted(v for v in found if self.exists(self._vdir(layer, v)))

    def vacuum(self, layer: str, keep: int = 2) -> list:
        """Delete version directories older than the ``keep`` newest published
        versions (each run writes a whole new version, so old ones must go at
        scale). Unpublished directories below the oldest kept version are
        failed runs and go too. Returns the deleted version numbers."""
        published = self.versions(layer)
        if len(published) <= keep:
            return []
        floor = published[-keep]
        sc = self.spark.sparkContext
        jvm = sc._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{layer}")
        fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
        deleted = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v") and name[1:].isdigit() and int(name[1:]) < floor:
                fs.delete(st.getPath(), True)
                deleted.append(int(name[1:]))
        return sorted(deleted)

    def bronze(self, table: str) -> DataFrame:
        """All loads of a bronze table, read as one directory, with the name of each row's ``load``."""
        schema = schema_of("bronze", table).add("load", "string")
        if not self.exists(self.table_path("bronze", table)):
            return empty_frame(self.spark, schema)
        return self.spark.read.schema(schema).parquet(self.table_path("bronze", table))

    def unmerged(self, table: str, ledger: DataFrame) -> DataFrame:
        """The rows of the loads that ``ledger`` (bronze, load) does not list. The names are
        compared in Spark, and prune the directories that the scan opens (a load is a partition)."""
        rows = self.bronze(table)
        new = materialize(rows.select("load").distinct().join(
            ledger.filter(F.col("bronze") == table).select("load"), "load", "left_anti"), "loads")
        # the condition, true of every name, tells the optimizer that the join is worth pruning by
        return rows.join(broadcast_if_small(new.filter("load > ''")), "load", "left_semi").drop("load")

    def compact_bronze(self, table: str, version: int | None = None) -> str | None:
        """Rewrite the loads that silver ``version`` (default: the published one) has merged as one
        load of few files, and return its name (None if there are fewer than two).

        The new load is listed in the version's ledger before it can be seen, so no later run
        merges its rows again, and it is in place before the old ones go: a reader may for a
        moment see a row twice (with its id), never miss one. What a lost driver leaves undone
        the next compaction of the table finishes, from the list of loads it wrote first.
        Names are compared in Spark; the driver streams them to delete one folder at a time."""
        version = self.current_version("silver") if version is None else version
        root = self.table_path("bronze", table)
        ledger = f"{self.base}/silver/v{version:06d}/_loads"
        if not (version and self.exists(root) and self.exists(ledger)):
            return None
        self._finish_compactions(root)
        merged = self.spark.read.parquet(ledger).filter(F.col("bronze") == table).select("load").distinct()
        names = self.bronze(table).select("load").distinct().join(merged, "load", "left_semi")
        name = f"compact-{uuid.uuid4().hex}"
        names.coalesce(1).write.parquet(f"{root}/_compacted/{name}")
        old = self.spark.read.parquet(f"{root}/_compacted/{name}")
        if old.limit(2).count() < 2:
            self.delete(f"{root}/_compacted/{name}")
            return None
        rows = self.bronze(table).join(broadcast_if_small(old.filter("load > ''")), "load", "left_semi").drop("load")
        rows.hint("rebalance").write.option("compression", "zstd").parquet(f"{root}/_compacted/{name}.rows")
        self.spark.createDataFrame([(table, name)], "bronze string, load string").write.mode("append").parquet(ledger)
        fs, source = self._path(f"{root}/_compacted/{name}.rows")
        if not fs.rename(source, self._path(f"{root}/load={name}")[1]):
            raise StoreConflict(f"{table}: {name} could not be put in place")
        self._finish_compactions(root)
        return name

    def _finish_compactions(self, root: str) -> None:
        """Delete the loads that compactions have replaced, and drafts of those that were not done."""
        fs, lists = self._path(f"{root}/_compacted")
        if not fs.exists(lists):
            return
        for st in fs.listStatus(lists):
            name = st.getPath().getName()
            if self.exists(f"{root}/load={name}"):
                for r in self.spark.read.parquet(f"{root}/_compacted/{name}").toLocalIterator():
                    self.delete(f"{root}/load={r['load']}")
            self.delete(f"{root}/_compacted/{name}")

    def append_bronze(self, table: str, df: DataFrame, load_id: str) -> DataFrame:
        """Each load (a batch run or a stream micro-batch) is its own
        ``load=`` directory, so batch and streaming loads can share a table
        and a replayed load rewrites only itself. Returns the load as read
        back (its count is a Parquet metadata read)."""
        path = f"{self.table_path('bronze', table)}/load={load_id}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
