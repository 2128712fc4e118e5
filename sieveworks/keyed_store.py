"""A table of first records by key, in hash buckets behind a pointer: what comes in is written once, and nothing else is."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.dedupe import keep_first
from .runstate import listed, read_text, removed, write_text

#: Rows of a batch up to which its keys are broadcast to find those that the store has; about a hundred bytes each.
SENT_ROWS = 200_000

#: Tables of a bucket beyond which compact() makes one of them.
LAYERS = 8

BUCKET = "__bucket"


class KeyedStore:
    """Rows of a schema by a text key, the first of each key, in a folder that driver and executors share.

    The pointer file names, for each bucket, the tables that hold its rows; a
    table is whole before the pointer moves, so a write that fails changes
    nothing, and what it left is never read.  One writer at a time.  The number of
    buckets is fixed when the store is made and bounds the pointer.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | str, key: str = "key", buckets: int = 64):
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        held = read_text(spark, f"{self.root}/current.json")
        self.state = json.loads(held) if held else {"buckets": buckets, "tables": {}, "batches": {}}

    @property
    def is_new(self) -> bool:
        return not self.state["tables"] and not self.state["batches"]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.state["buckets"])).cast("int")

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows, or those of some buckets; only their files are opened."""
        wanted = self.state["tables"] if buckets is None else {str(b): self.state["tables"].get(str(b), []) for b in buckets}
        paths = [f"{table}/{BUCKET}={b}" for b, tables in sorted(wanted.items()) for table in tables]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _commit(self, tables: dict[str, list[str]], batch: tuple[str, int] | None) -> None:
        state = self.state | {"tables": self.state["tables"] | tables}
        if batch:
            state["batches"] = state["batches"] | {batch[0]: batch[1]}
        write_text(self.spark, f"{self.root}/current.json", json.dumps(state))
        self.state = state

    def _written(self, rows: DataFrame) -> tuple[str, list[int]]:
        """A new table of rows by bucket, and its buckets."""
        path = f"{self.root}/tables/{uuid.uuid4().hex}"
        cast = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        rows.select(*cast, self._bucket().alias(BUCKET)).write.partitionBy(BUCKET).parquet(path)
        found = {f.rpartition(f"/{BUCKET}=")[2].split("/")[0] for f in listed(self.spark, path) if f.endswith(".parquet")}
        return path, sorted(int(b) for b in found if b.isdigit())

    def insert(self, rows: DataFrame, order: str, batch: tuple[str, int] | None = None) -> int:
        """Adds the rows whose key the store lacks, of several with one key the first by order; returns their number.

        Null and empty keys are left out.  batch is a stream's name and the
        number of its batch: one that was added before adds nothing.  Only keys of
        the buckets that the batch touches are read, and they are not shuffled
        while the batch has few rows; all that is written are the new rows.
        """
        if batch and self.state["batches"].get(batch[0], -1) >= batch[1]:
            return 0
        size, at = Observation(), f"{self.root}/staged/{uuid.uuid4().hex}"
        first = keep_first(rows.where(F.coalesce(F.col(self.key), F.lit("")) != ""), self.key, order)
        first.observe(size, F.count(F.lit(1)).alias("n"), F.collect_set(self._bucket()).alias("b")).write.parquet(at)
        staged, said = self.spark.read.schema(first.schema).parquet(at), size.get
        known = self.read(said.get("b") or []).select(self.key)
        sent = staged.select(F.col(self.key).alias("__sent"))
        sent = F.broadcast(sent) if said.get("n", 0) <= SENT_ROWS else sent
        there = known.join(sent, F.col(self.key) == F.col("__sent"), "left_semi")
        table, touched = self._written(staged.join(there, self.key, "left_anti"))
        self._commit({str(b): [*self.state["tables"].get(str(b), []), table] for b in touched}, batch)
        removed(self.spark, at)
        return self.spark.read.schema(self.schema).parquet(table).count() if touched else 0

    def update(self, keys: DataFrame, values: dict[str, Column]) -> list[int]:
        """Sets columns of the rows whose key stands in keys; rewrites their buckets and returns them."""
        asked = keys.select(F.col(self.key)).where(F.col(self.key).isNotNull()).distinct()
        touched = sorted(r.b for r in asked.select(self._bucket().alias("b")).distinct().collect())  # as many as buckets
        touched = [b for b in touched if self.state["tables"].get(str(b))]
        if touched:
            marked = self.read(touched).join(asked.withColumn("__hit", F.lit(True)), self.key, "left")
            table, found = self._written(marked.withColumns({c: F.when(F.col("__hit"), v).otherwise(F.col(c)) for c, v in values.items()}))
            self._commit({str(b): [table] for b in found}, None)
        return touched

    def compact(self, layers: int = LAYERS) -> list[int]:
        """Makes one table of the buckets that have more than layers, and returns them; the old ones stay until vacuum()."""
        deep = sorted(int(b) for b, t in self.state["tables"].items() if len(t) > layers)
        if deep:
            table, found = self._written(self.read(deep))
            self._commit({str(b): [table] for b in found}, None)
        return deep

    def vacuum(self) -> None:
        """Deletes files that no bucket names any more; nobody may still read them."""
        used = {f"{t}/{BUCKET}={b}".split(":", 1)[-1].lstrip("/") for b, ts in self.state["tables"].items() for t in ts}
        for f in [*listed(self.spark, f"{self.root}/tables"), *listed(self.spark, f"{self.root}/staged")]:
            if f.rpartition("/")[0].split(":", 1)[-1].lstrip("/") not in used:
                removed(self.spark, f)
