"""Materialized warehouse: each layer is written once as Parquet to shared
storage and read back, which cuts the lineage (an executor lost later only
re-reads files) and lets every report start from a column-pruned scan.

The storage folder is a fresh sub-folder of the cluster's
``spark.checkpoint.dir`` (see ``tillroll.session``).
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import threading
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.plans import layers, metrics
from tillroll.session import delete_folder, list_folders, materialize, read_pointer, storage_root, task_count, write_pointer
from tillroll.sources import fixture_map
from tillroll.sources.periods import ingest, read_period, type_period
from tillroll.sources.reference import read_stockcode_categories, stockcode_categories

_CACHE: dict[tuple, "Warehouse"] = {}
_LOCK = threading.Lock()


def _code_hash() -> str:
    """Fingerprint of this package's source: stored tables of another code
    version are never reused."""
    h = hashlib.sha1()
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for dirpath, _, files in sorted(os.walk(pkg)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(dirpath, f), "rb") as fh:
                    h.update(f.encode() + fh.read())
    return h.hexdigest()[:12]


_CODE_HASH = _code_hash()


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Source tables (path, size, modification time) + code version."""
    h = hashlib.sha1(os.path.abspath(sf_dir).encode())
    try:
        status = _listing(spark, sf_dir)
    except Exception:  # noqa: BLE001 — unreadable listing: no reuse
        status = uuid.uuid4().hex
    h.update(status.encode())
    return f"{os.path.basename(os.path.abspath(sf_dir))}-{h.hexdigest()[:12]}-{_CODE_HASH}"


def _listing(spark: SparkSession, sf_dir: str) -> str:
    """State of the source folder: its entries (one per table) and, in one call, the
    number and size of all files below."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = [f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(p)]
    whole = fs.getContentSummary(p)
    return "|".join(sorted(parts)) + f"|{whole.getFileCount()}:{whole.getLength()}"


def drop_old_versions(spark: SparkSession, sf_dir: str) -> list[str]:
    """Delete the stored tables that older sources or code versions of this data folder
    left under this project's own warehouse folder; returns their names."""
    current = fingerprint(spark, sf_dir)
    base = os.path.dirname(storage_root(spark, current))
    stem = f"{os.path.basename(os.path.abspath(sf_dir))}-"
    old = [n for n in list_folders(spark, base) if n != current and n.startswith(stem) and n.count("-") == current.count("-")]
    for name in old:
        delete_folder(spark, os.path.join(base, name))
    return old


def _catalog_name(path: str) -> str:
    """The catalog table of a stored folder, which no other folder has."""
    return "tillroll_" + hashlib.sha1(path.encode()).hexdigest()[:20]


class Warehouse:
    """Layers built on demand, each written once and then read from Parquet."""

    #: Facts in one folder a month of this column.
    BY_MONTH = {"fact_orders": "order_datetime"}
    MONTH_COL = "order_month"
    #: Line facts in buckets of this column: reports per invoice move no line.
    BY_INVOICE = {"fact_order_lines": S.INVOICE}
    #: An invoice of more than a quarter of a bucket's share of lines is stored apart.
    HOT_SHARE = 4
    CODEC = "zstd"

    ORDER = ["landing", "bronze", "silver_transactions", "fact_order_lines", "fact_orders",
             "dim_customers", "dim_products", "customer_rfm"]

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None, *,
                 materialize: bool = True, categories_path: str | None = None):
        """``categories_path``: a CSV of special codes and categories to use in place of the
        built-in table (S4); its tables are stored under a root of their own."""
        self.spark = spark
        self.categories_path = categories_path
        self.sf_dir = sf_dir
        self.materialize = materialize
        self.root = root or storage_root(spark, fingerprint(spark, sf_dir) + (
            f"_{hashlib.sha1((categories_path + _listing(spark, categories_path)).encode()).hexdigest()[:8]}" if categories_path else ""))
        self._paths: dict[str, str] = {}
        self._tables: dict[str, DataFrame] = {}
        self._parts: dict[str, list[DataFrame]] = {}
        self._split: tuple[DataFrame, DataFrame] | None = None
        self._lock = threading.RLock()

    @classmethod
    def for_source(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        key = (id(spark), spark.sparkContext.applicationId, os.path.abspath(sf_dir))
        with _LOCK:
            wh = _CACHE.get(key)
            if wh is None:
                wh = cls(spark, sf_dir)
                _CACHE[key] = wh
            return wh

    # -- raw inputs (not materialized: a projection of the source tables) --
    def raw_period_files(self) -> tuple[DataFrame, DataFrame]:
        """The two raw period inputs as they arrive (overlap included)."""
        self.table("landing")
        col = fixture_map.RAW_PERIOD_COL
        if self.materialize:
            base = self._paths["landing"]
            return (read_period(self.spark, os.path.join(base, f"{col}={fixture_map.PERIOD_EARLY}")),
                    read_period(self.spark, os.path.join(base, f"{col}={fixture_map.PERIOD_LATE}")))
        land = self.table("landing")
        return (land.filter(F.col(col) == fixture_map.PERIOD_EARLY).drop(col),
                land.filter(F.col(col) == fixture_map.PERIOD_LATE).drop(col))

    def raw_periods(self) -> tuple[DataFrame, DataFrame]:
        """The two typed raw periods, overlap included."""
        early, late = self.raw_period_files()
        return (type_period(early, fixture_map.PERIOD_EARLY),
                type_period(late, fixture_map.PERIOD_LATE))

    def consolidated(self) -> DataFrame:
        """P6 + P7 over the raw period inputs (the bronze table before it is stored)."""
        early, late = self.raw_period_files()
        return ingest(early, late, fixture_map.PERIOD_EARLY, fixture_map.PERIOD_LATE,
                      fixture_map.OVERLAP_START)

    def categories(self) -> DataFrame:
        if self.categories_path:
            return read_stockcode_categories(self.spark, self.categories_path)
        return stockcode_categories(self.spark)

    # -- layers --
    def _compute(self, name: str) -> DataFrame:
        if name == "landing":
            return fixture_map.landing(self.spark, self.sf_dir)
        if name == "bronze":
            return self.consolidated()
        if name == "silver_transactions":
            return layers.silver(self.table("bronze"), self.categories(), (self._split_bronze()[0], self.repeat_suspects()))
        if name == "fact_order_lines":
            return layers.fact_order_lines(self.table("silver_transactions"))
        if name == "fact_orders":
            return self.by_invoice(layers.fact_orders)
        if name == "dim_customers":
            return layers.dim_customers(self.table("fact_orders"))
        if name == "dim_products":
            return layers.dim_products(self.table("fact_order_lines"))
        if name == "customer_rfm":
            return layers.customer_rfm(self.table("fact_orders"))
        raise KeyError(name)

    def table(self, name: str) -> DataFrame:
        """A warehouse layer (``ORDER``), built on first use."""
        with self._lock:
            if name not in self._tables:
                self._tables[name] = self._store(name, lambda: self._compute(name))
            return self._tables[name]

    def derived(self, name: str, fn) -> DataFrame:
        """A report-side table several reports read (e.g. the value curve),
        computed once by ``fn(self)`` and stored like a layer."""
        with self._lock:
            if name not in self._tables:
                self._tables[name] = self._store(name, lambda: fn(self))
            return self._tables[name]

    def _split_bronze(self) -> tuple[DataFrame, DataFrame]:
        """Bronze lines without an equal, and suspects; the filter is counted once."""
        with self._lock:
            if self._split is None:
                self._split = layers.repeat_suspects(self.table("bronze"))
            return self._split

    def repeat_suspects(self) -> DataFrame:
        """Bronze lines that may have an equal in the business columns."""
        return self.derived("repeat_suspects", lambda wh: wh._split_bronze()[1])

    def by_invoice(self, per_invoice) -> DataFrame:
        """``per_invoice`` (a grouping by invoice) of all lines, part by part: the lines in
        buckets, which need no exchange, and those of the large invoices."""
        self.table("fact_order_lines")
        parts = self._parts.get("fact_order_lines", [self._tables["fact_order_lines"]])
        return reduce(DataFrame.unionByName, [per_invoice(p) for p in parts])

    def metrics(self, name: str) -> DataFrame | None:
        """The metrics observed when a table was written, merged to one row; None if tables
        are not stored."""
        self.table(name)
        if not self.materialize:
            return None
        path = read_pointer(self.spark, os.path.join(self.root, f"{name}.current"))
        parts = [json.loads(line) for line in read_pointer(self.spark, f"{path}.metrics").splitlines()]
        rows = [self.spark.range(1).select(*[F.lit(value).cast(kind).alias(c) for c, (value, kind) in part.items()]) for part in parts]
        return metrics.merged(name, reduce(DataFrame.unionByName, rows))

    def _write_observed(self, name: str, df: DataFrame, path: str, write) -> None:
        """``write(df)`` and, beside the table, the metrics observed meanwhile (a line of
        text a part): on the last step before the files, so a task that ran again counts once."""
        if name not in metrics.OBSERVED:
            write(df)
            return
        seen = Observation()
        write(df.observe(seen, *metrics.aggregates(name)))
        kinds, values = metrics.measured(name, df).schema, seen.get
        line = json.dumps({f.name: [None if values[f.name] is None else str(values[f.name]), f.dataType.simpleString()] for f in kinds.fields})
        before = read_pointer(self.spark, f"{path}.metrics")
        write_pointer(self.spark, f"{path}.metrics", f"{before}\n{line}" if before else line)

    def _hot_keys(self, df: DataFrame, key: str, rows: int, buckets: int) -> DataFrame:
        """The keys with more lines than a bucket's share / ``HOT_SHARE`` of ``rows``: fewer
        than ``HOT_SHARE * buckets`` of them."""
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        return materialize(counts.where(F.col("_n") * self.HOT_SHARE * buckets > rows).select(key))

    def _write_buckets(self, name: str, path: str) -> str:
        """Lines in buckets (one file each, by a catalog table) and the lines of the large
        invoices in a folder of their own; returns the folder, which says what it holds.
        Buckets are as many as keep one size when the lines grow; what follows from a
        line's other columns is not moved but computed again where the line arrives."""
        key = self.BY_INVOICE[name]
        rows = self.metrics("silver_transactions").first()["rows"]
        buckets = max(8, task_count(self.spark, rows))
        hot = self._hot_keys(self.table("silver_transactions"), key, rows, buckets)
        seeds = self.table("silver_transactions").select(*layers.SEED_COLUMNS)

        def full(x: DataFrame) -> DataFrame:
            return layers.fact_order_lines(layers.with_flags(x))

        some = hot.count() > 0
        path = f"{path}-b{buckets}{'-hot' if some else ''}"
        lines = seeds
        if some:
            mark = F.broadcast(hot.withColumnRenamed(key, "_key"))  # at most HOT_SHARE * buckets rows
            same = F.col(key).eqNullSafe(F.col("_key"))
            self._write_observed(name, full(seeds.join(mark, same, "left_semi")), path,
                                 lambda x: x.write.option("compression", self.CODEC).parquet(os.path.join(path, "hot")))
            lines = seeds.join(mark, same, "left_anti")
        self._write_observed(name, full(lines.repartition(buckets, key)), path, lambda x: (
            x.write.format("parquet").option("compression", self.CODEC).bucketBy(buckets, key).sortBy(key)
            .option("path", os.path.join(path, "lines")).saveAsTable(_catalog_name(path))))
        return path

    def _read_buckets(self, name: str, path: str) -> DataFrame:
        """The catalog table over the folder that the pointer names, made again in a session
        that does not have it; the large invoices' lines are added."""
        table, folder = _catalog_name(path), os.path.join(path, "lines")
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(folder).schema.fields)
            key, buckets = self.BY_INVOICE[name], re.search(r"-b(\d+)", path).group(1)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                           f"INTO {buckets} BUCKETS LOCATION '{folder}'")
        parts = [self.spark.table(table)]
        if path.endswith("-hot"):
            parts.append(self.spark.read.parquet(os.path.join(path, "hot")))
        self._parts[name] = parts
        return reduce(DataFrame.unionByName, parts)

    def _store(self, name: str, compute) -> DataFrame:
        if not self.materialize:
            return compute()
        # each build writes a folder of its own and, once that is whole, a small pointer
        # file that names it: a reader never sees a table in the making
        pointer = os.path.join(self.root, f"{name}.current")
        path = read_pointer(self.spark, pointer)
        if path is None:
            path = os.path.join(self.root, f"{name}-{uuid.uuid4().hex[:12]}")
            if name in self.BY_INVOICE:
                path = self._write_buckets(name, path)
                write_pointer(self.spark, pointer, path)
                return self._read_buckets(name, path)
            df = compute()
            if name in self.BY_MONTH:
                # one folder a month, so a date range opens the months it touches; the
                # rebalance keeps files even where a month is large
                df = df.withColumn(self.MONTH_COL, F.trunc(F.col(self.BY_MONTH[name]).cast("date"), "month"))
                df = df.hint("rebalance", self.MONTH_COL).sortWithinPartitions(self.MONTH_COL, self.BY_MONTH[name])
            folders = fixture_map.RAW_PERIOD_COL if name == "landing" else self.MONTH_COL if name in self.BY_MONTH else None
            self._write_observed(name, df, path, lambda x: (
                x.write.partitionBy(folders) if folders else x.write).option("compression", self.CODEC).parquet(path))
            write_pointer(self.spark, pointer, path)
        if name in self.BY_INVOICE:
            return self._read_buckets(name, path)
        self._paths[name] = path
        return self.spark.read.parquet(path).drop(self.MONTH_COL)

    def orders_between(self, first_year: int, last_year: int) -> DataFrame:
        """Orders of the months of some years: only their folders are read."""
        orders = self.table("fact_orders")
        if not self.materialize:
            return orders
        month = F.col(self.MONTH_COL)
        return self.spark.read.parquet(self._paths["fact_orders"]).filter(
            month.between(F.lit(f"{first_year}-01-01").cast("date"), F.lit(f"{last_year}-12-01").cast("date"))) \
            .drop(self.MONTH_COL)

    def build(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.ORDER}

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every layer to ``spark.sql`` under its table name."""
        names = []
        for name in self.ORDER:
            self.table(name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        self.categories().createOrReplaceTempView(prefix + "stockcode_categories")
        return names + [prefix + "stockcode_categories"]
