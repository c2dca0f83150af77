"""Layer databases whose tables are replaced together.

The tables of a layer are folders of Parquet files, one folder for each load. A manifest names the loads that belong together,
and the manifest with the greatest number is the layer's state: it comes into being in one step, by a rename that fails if
another run has taken the number. So a reader of a snapshot has all tables of one state, whatever is loaded meanwhile,
and a run that fails half-way leaves the state before it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parceltrail.operators.joins import BUCKETS, HOT_FACTOR, HotKeys

#: Distinct values that a task keeps count of to find hot ones; a value with more than about 1 / TRACKED of the rows is found.
TRACKED = BUCKETS
#: Loads of failed runs are removed when they are so old.
ORPHAN_SECONDS = 7 * 24 * 3600


@dataclass(frozen=True)
class Stored:
    """A load of a table: its folder, schema, rows, and the rows of the most frequent values of its join columns."""

    location: str
    schema: str
    rows: int
    frequent: dict[str, list[tuple]]

    def read(self, spark: SparkSession) -> DataFrame:
        # With the schema at hand, no job looks for it in the files.
        return spark.read.schema(StructType.fromJson(json.loads(self.schema))).parquet(self.location)


class Snapshot:
    """The tables of a layer at one moment."""

    def __init__(self, spark: SparkSession, layer: str, root: str, tables: Mapping[str, Stored]):
        self.spark, self.layer, self.root, self.tables = spark, layer, root, dict(tables)

    def _entry(self, table: str) -> Stored:
        if table not in self.tables:
            raise LookupError(f"no complete load of {self.layer}.{table} below {self.root}")
        return self.tables[table]

    def read(self, table: str) -> DataFrame:
        return self._entry(table).read(self.spark)

    def hot_keys(self, table: str) -> HotKeys:
        """What is known of the table's hot keys since it was written; joins take it as ``count_on``."""
        entry = self._entry(table)
        return HotKeys(entry.rows, entry.frequent)


class Load:
    """New tables of a layer, which become its state together when the block ends without an error."""

    def __init__(self, store: LayerStore, layer: str):
        self.store, self.layer = store, layer
        self.tables: dict[str, Stored] = {}

    def __enter__(self) -> Load:
        self.store.create_layer(self.layer)
        return self

    def __exit__(self, failed, *_) -> None:
        if failed is None and self.tables:
            self.store._publish(self.layer, self.tables)

    def write(self, table: str, df: DataFrame, join_columns: Sequence[str] = ()) -> DataFrame:
        """Write a table and return it as stored; other readers don't see it yet.

        While it is written, its rows are counted and the frequent values of ``join_columns`` are found.
        """
        location = f"{self.store._folder(self.layer, table)}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        seen = Observation()
        most = BUCKETS // HOT_FACTOR
        frequent = [F.expr(f"approx_top_k(`{c}`, {most}, {TRACKED})").alias(f"top_{c}") for c in join_columns]
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *frequent).write.parquet(location)
        rows = seen.get["rows"]
        tops = {c: [(r["item"], r["count"]) for r in seen.get[f"top_{c}"] or [] if r["item"] is not None] for c in join_columns}
        # Only what no hash bucket of average size would hold.
        large = {c: [(k, n) for k, n in top if n * BUCKETS > rows * HOT_FACTOR] for c, top in tops.items()}
        self.tables[table] = Stored(location, df.schema.json(), rows, large)
        return self.read(table)

    def read(self, table: str) -> DataFrame:
        return self.tables[table].read(self.store.spark)

    def write_all(
        self, tables: Mapping[str, Callable[[], DataFrame]], join_columns: Mapping[str, Sequence[str]] | None = None
    ) -> None:
        """Write independent tables at the same time: a small one then runs in the idle cores at the end of a large one."""

        def one(table: str) -> None:
            self.write(table, tables[table](), (join_columns or {}).get(table, ()))

        with ThreadPoolExecutor(len(tables)) as pool:
            target = inheritable_thread_target(self.store.spark)(one)
            for done in [pool.submit(target, table) for table in tables]:
                done.result()


class LayerStore:
    """Parquet tables ``<layer>.<table>`` below ``root``, a folder all executors can reach.

    ``prefix`` is put before the database names, so that several stores can share one catalog.
    Each load of a table has a folder of its own, named by its time: ``<root>/<layer>/<table>/<load>``; manifests are
    ``<root>/<layer>/_manifests/<number>.json``. In the catalog a table is a view of its newest load, replaced in one
    statement, also with another schema. SQL that needs several tables of one state reads a ``snapshot``.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def create_layer(self, layer: str) -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} LOCATION '{self.root}/{layer}'"
        )

    def load(self, layer: str) -> Load:
        """``with store.load(layer) as load``: the tables written in the block replace those of the layer together."""
        return Load(self, layer)

    def replace(self, layer: str, table: str, df: DataFrame) -> DataFrame:
        """Write ``df`` as the new content of one table and return the stored table."""
        with self.load(layer) as load:
            load.write(table, df)
        return load.read(table)

    def snapshot(self, layer: str) -> Snapshot:
        """The layer's tables as the newest manifest names them; nothing that is loaded later changes them."""
        numbers = self._numbers(layer)
        return Snapshot(self.spark, layer, self.root, self._manifest(layer, numbers[-1]) if numbers else {})

    def read(self, layer: str, table: str) -> DataFrame:
        """The newest load of one table."""
        return self.snapshot(layer).read(table)

    def clean(self, layer: str, keep: int = 2, orphan_seconds: int = ORPHAN_SECONDS) -> list[str]:
        """Remove the loads that the last ``keep`` manifests don't name, and return their folders.

        Readers of older snapshots must have ended. A folder that no manifest has ever named belongs to a run that failed
        or is not over yet; it goes when it is ``orphan_seconds`` old.
        """
        numbers = self._numbers(layer)
        old, kept = numbers[:-keep], numbers[-keep:]
        used = {stored.location for n in kept for stored in self._manifest(layer, n).values()}
        named = {stored.location for n in old for stored in self._manifest(layer, n).values()}
        limit = time.time_ns() - orphan_seconds * 10**9
        gone = sorted(named - used)
        for table in self._children(f"{self.root}/{layer}"):
            for load in self._children(f"{self.root}/{layer}/{table}") if not table.startswith("_") else []:
                location, made = f"{self._folder(layer, table)}/{load}", load.split("-")[0]
                if location not in used | named and made.isdigit() and int(made) < limit:
                    gone.append(location)
        for location in gone:
            self._system(location).delete(self._path(location), True)
        # Last, so that a clean-up that was interrupted finds its folders again.
        for n in old:
            self._system(self.root).delete(self._path(self._file(layer, n)), False)
        return gone

    def _folder(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _file(self, layer: str, number: int) -> str:
        return f"{self.root}/{layer}/_manifests/{number:020d}.json"

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _system(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _children(self, path: str) -> list[str]:
        system = self._system(path)
        if not system.exists(self._path(path)):
            return []
        return sorted(f.getPath().getName() for f in system.listStatus(self._path(path)))

    def _numbers(self, layer: str) -> list[int]:
        names = self._children(f"{self.root}/{layer}/_manifests")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit()]

    def _manifest(self, layer: str, number: int) -> dict[str, Stored]:
        path = self._path(self._file(layer, number))
        stream = self._system(self.root).open(path)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        tables = json.loads(text)
        return {
            t: Stored(e["location"], e["schema"], e["rows"], {c: [tuple(x) for x in top] for c, top in e["frequent"].items()})
            for t, e in tables.items()
        }

    def _publish(self, layer: str, tables: Mapping[str, Stored]) -> None:
        """Make a manifest of the newest one and ``tables``, and the views of the latter."""
        while True:
            numbers = self._numbers(layer)
            number = numbers[-1] + 1 if numbers else 0
            merged = (self._manifest(layer, numbers[-1]) if numbers else {}) | dict(tables)
            text = json.dumps({t: asdict(s) for t, s in merged.items()})
            if self._commit(layer, number, text):
                break
        for table, stored in tables.items():
            self._show(layer, table, stored.location)

    def _commit(self, layer: str, number: int, text: str) -> bool:
        """Write a manifest beside the others, then give it its number; False if another run was faster."""
        fresh = self._path(f"{self.root}/{layer}/_manifests/_{uuid.uuid4().hex}")
        out = self._system(self.root).create(fresh)
        out.write(text.encode())
        out.close()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        files = hadoop.FileContext.getFileContext(fresh.toUri(), self.spark._jsc.hadoopConfiguration())
        how = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            files.rename(fresh, self._path(self._file(layer, number)), how)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception.toString()):
                raise
            self._system(self.root).delete(fresh, False)
            return False
        return True

    def _show(self, layer: str, table: str, location: str) -> None:
        name = self.name(layer, table)
        known = {t.name: t.tableType for t in self.spark.catalog.listTables(f"{self.prefix}{layer}", table)}
        if known.get(table) == "MANAGED":
            raise ValueError(f"{name} is a table that is not this library's")
        if known.get(table) == "EXTERNAL":
            self.spark.sql(f"DROP TABLE {name}")  # of an older version of this library; its files stay
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{location}`")
