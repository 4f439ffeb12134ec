"""Which keys a stored table already holds, in hash buckets, so that a batch reads only its own.

An anti-join against the table reads the whole history for every batch.  The index keeps
the keys alone, one folder per bucket of their hash; a batch names its buckets (at most
``buckets`` numbers) and the scan skips all other folders.

Table and index are two writes, and a job can die between them.  Before a batch is
appended its keys are noted; a note that is still there when the next batch comes is
settled first: those of its keys that reached the table enter the index.  So a batch
that is run again neither repeats rows nor loses any.  One writer at a time, as a
stream's micro-batches are.

A batch adds up to one file a bucket; ``build`` writes the index afresh from the table
into a new folder and then names it the valid one.  Folders of earlier builds can be
deleted.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brinkcast.operators.ordered import stored
from brinkcast.operators.writes import first_per_key
from brinkcast.sources.tables import PARTITION_TIME, TABLES, TableStore


class KeyIndex:
    """The keys of one table of a store.

    Rows with a NULL in their key are compared with nothing: each batch's first one is
    appended, as by ``insert_absent``.  ``buckets`` must stay what it was when the index
    was built; it is part of the folder's name.
    """

    def __init__(self, store: TableStore, table: str, keys: list[str], buckets: int = 64):
        self.store, self.table, self.keys, self.buckets = store, table, list(keys), buckets
        self.types = {f.name: f.dataType for f in StructType.fromDDL(TABLES[table]).fields}
        self.schema = ", ".join(f"{k} {self.types[k].simpleString()}" for k in keys)
        self.root = f"{store.path(table)}_keys_{'_'.join(keys)}_{buckets}"

    def _read(self, path: str, schema: str) -> DataFrame:
        spark = self.store.spark
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            return spark.createDataFrame([], schema)

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` written beside the index, over those of the batch before: later steps
        read the columns that they need."""
        path = f"{self.root}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.store.spark.read.schema(rows.schema).parquet(path)

    def _typed(self, rows: DataFrame) -> DataFrame:
        """The table's columns in its types: a number and its digits hash differently."""
        return rows.select(*[F.col(c).cast(t).alias(c) for c, t in self.types.items() if c in rows.columns])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _built(self) -> int | None:
        return self._read(f"{self.root}/built", "build int").agg(F.max("build")).first()[0]

    def _add(self, keys: DataFrame, build: int, mode: str = "append") -> None:
        rows = keys.select(*self.keys).withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        rows.write.mode(mode).partitionBy("bucket").parquet(f"{self.root}/build={build}")

    def build(self) -> int:
        """Write the index from the table; valid only once it is complete."""
        build = (self._built() or 0) + 1
        self._add(self.store.read(self.table).select(*self.keys).distinct(), build, "overwrite")
        made = self.store.spark.range(1).select(F.lit(build).alias("build"))
        made.write.mode("append").parquet(f"{self.root}/built")
        self._note(None)
        return build

    def among(self, rows: DataFrame, build: int | None = None) -> DataFrame:
        """Known keys in the buckets of ``rows``; the other buckets are not read."""
        build = build or self._built() or self.build()
        wanted = sorted(r[0] for r in self._typed(rows).select(self._bucket()).distinct().collect())  # at most ``buckets``
        known = self._read(f"{self.root}/build={build}", f"{self.schema}, bucket int")
        return known.where(F.col("bucket").isin(wanted) if wanted else F.lit(False)).select(*self.keys)

    def _note(self, rows: DataFrame | None) -> None:
        """Keys about to be appended, with their day; None: nothing is open."""
        day = PARTITION_TIME.get(self.table)
        if rows is None:
            rows = self.store.spark.createDataFrame([], f"{self.schema}, day date")
        else:
            rows = rows.select(*self.keys, (F.to_date(day) if day else F.lit(None).cast("date")).alias("day"))
        rows.write.mode("overwrite").parquet(f"{self.root}/open")

    def _settle(self, build: int) -> None:
        """Enter what a batch that did not end has appended; only its days are read."""
        noted = self._read(f"{self.root}/open", f"{self.schema}, day date")
        span = noted.agg(F.count("*").alias("n"), F.min("day").alias("lo"), F.max("day").alias("hi")).first()
        if not span["n"]:
            return
        rows = self.store.read(self.table)
        if self.table in PARTITION_TIME and noted.where("day is null").isEmpty():
            rows = rows.where(F.col("day").between(F.lit(span["lo"]), F.lit(span["hi"])))
        arrived = rows.select(*self.keys).join(noted.select(*self.keys), self.keys, "left_semi").distinct()
        self._add(stored(arrived.join(self.among(noted, build), self.keys, "left_anti")), build)
        self._note(None)

    def append_new(self, batch: DataFrame, order: list[str] | None) -> int:
        """Append the batch rows whose key the table lacks, the first of each in ``order``;
        None: the batch holds each key once.

        The batch is read once and reduced to what is new, which is stored; returns the
        number of rows appended.
        """
        build = self._built() or self.build()
        self._settle(build)
        first = self._kept(self._typed(batch if order is None else first_per_key(batch, self.keys, order)), "batch")
        known = self.among(first, build)
        fresh = first if known.isEmpty() else self._kept(first.join(known, self.keys, "left_anti"), "fresh")
        if fresh.isEmpty():
            return 0
        self._note(fresh)
        n = self.store.append(self.table, fresh)
        self._add(fresh, build)
        self._note(None)
        return n
