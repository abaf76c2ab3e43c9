"""The three layers as databases of external parquet tables (DDL-1..3, SRC-5).

Table data lives under one root folder on shared storage; the session catalog only
records names and locations.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barlake.schemas import BRONZE_BARS, BRONZE_INFO, GOLD_METRICS, SILVER_BARS, SILVER_PROFILE
from barlake.session import is_local
from barlake.sinks.append import sql_string
from barlake.sinks.tables import _fs_and_path

# Table names of the medallion, fixed by the jobs.
BARS_BRONZE = "market_data_1m"
INFO_BRONZE = "ticker_info"
BARS_SILVER = "ticker_ohlcv_1m"
PROFILE_SILVER = "ticker_profile"
METRICS_GOLD = "ticker_daily_metrics"

# Derived partition columns: the gold job reads a date range, and an upsert rewrites only
# the days, or the hash buckets of tickers, that hold source rows.
LOAD_PARTITION = "load_prdt"
BARS_PARTITION = "bar_date"
METRICS_PARTITION = "date"
PROFILE_PARTITION = "ticker_bucket"
# Bytes of a profile bucket beyond which the buckets are halved: a merge rewrites whole buckets.
BUCKET_BYTES = 64 << 20

# (layer, table) -> (columns, partition column and its type)
TABLES: dict[tuple[str, str], tuple[StructType, str, str]] = {
    ("bronze", BARS_BRONZE): (BRONZE_BARS, LOAD_PARTITION, "date"),
    ("bronze", INFO_BRONZE): (BRONZE_INFO, LOAD_PARTITION, "date"),
    ("silver", BARS_SILVER): (SILVER_BARS, BARS_PARTITION, "date"),
    ("silver", PROFILE_SILVER): (SILVER_PROFILE, PROFILE_PARTITION, "int"),
    ("gold", METRICS_GOLD): (GOLD_METRICS, METRICS_PARTITION, "date"),
}


def profile_bucket(buckets: int, ticker: str = "ticker") -> Column:
    """Partition of a profile among ``buckets`` (a power of two): from ``buckets`` to below twice that,
    so a partition's name tells among how many it is one, and the count is stored with the table."""
    return (F.pmod(F.xxhash64(ticker), F.lit(buckets)) + F.lit(buckets)).cast("int")


def bucket_count(partitions: list[int]) -> int:
    """The number of buckets that partition values were made with; 1 for an empty table."""
    return 1 << (max(partitions, default=1).bit_length() - 1)


@dataclass
class Lake:
    """Names and locations of the bronze, silver and gold tables."""

    spark: SparkSession
    root: str
    databases: dict[str, str] = field(
        default_factory=lambda: {"bronze": "bronze", "silver": "silver", "gold": "gold"}
    )
    catalog: str | None = None
    # The lake lives no longer than the session (tests, scratch lakes): any catalog will do.
    temporary: bool = False

    def database(self, layer: str) -> str:
        name = f"`{self.databases[layer]}`"
        return f"`{self.catalog}`.{name}" if self.catalog else name

    def table(self, layer: str, name: str) -> str:
        """Full table name; with a catalog it does not depend on the session's current one."""
        return f"{self.database(layer)}.`{name}`"

    def location(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def scan(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(self.table(layer, name))

    def sql(self, query: str) -> DataFrame:
        """Ad-hoc SQL over the layer tables and temp views (SRC-6)."""
        return self.spark.sql(query)

    def _persistent(self) -> bool:
        """Whether the catalog that holds the tables outlives the session. ``spark_catalog`` is the
        session's own one, unless a plugin stands in for it."""
        if self.catalog not in (None, "spark_catalog"):
            return True
        plugin = self.spark.conf.get("spark.sql.catalog.spark_catalog", None)
        # Fixed value: Spark's name of its own session catalog.
        return plugin not in (None, "builtin") or self.spark.conf.get("spark.sql.catalogImplementation") != "in-memory"

    def attach(self, layer: str, name: str, values: list) -> None:
        """Register single partitions whose files are there already; nothing else is listed."""
        partition = TABLES[layer, name][1]
        for value in values:
            literal = "NULL" if value is None else sql_string(str(value))
            self.spark.sql(f"ALTER TABLE {self.table(layer, name)} ADD IF NOT EXISTS PARTITION (`{partition}` = {literal})")

    def create(self) -> "Lake":
        """Create the databases and tables that are absent, from their declared columns; on an
        existing lake this runs no job.

        A local session's catalog is new each time: a table whose folder already holds data
        gets its partitions registered again. On a cluster that would list the whole
        history in every job, so a persistent catalog is required there.
        """
        if not self.temporary and not is_local(self.spark) and not self._persistent():
            raise RuntimeError("the session has no persistent catalog; set spark.sql.catalogImplementation=hive or pass a catalog")
        for layer in self.databases:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}")
        if self.catalog is not None:
            self.spark.catalog.setCurrentCatalog(self.catalog)
        for (layer, name), (schema, partition, kind) in TABLES.items():
            table, location = self.table(layer, name), self.location(layer, name)
            if self.spark.catalog.tableExists(table):
                continue
            fs, path = _fs_and_path(self.spark, location)
            held = fs.exists(path)
            columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != partition]
            self.spark.sql(
                f"CREATE TABLE {table} ({', '.join(columns)}, `{partition}` {kind}) USING parquet "
                f"PARTITIONED BY (`{partition}`) LOCATION {sql_string(location)}"
            )
            if held:
                self.spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        return self

    def drop(self) -> None:
        """Drop the databases and their tables from the catalog; the files stay."""
        for layer in self.databases:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")
