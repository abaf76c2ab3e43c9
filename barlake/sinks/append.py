"""Append a load batch to a table partitioned by load date (SNK-1, SNK-2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


# Numeric types that Spark's parquet reader widens in place (narrow -> wide).
_WIDER = {
    "tinyint": ["smallint", "int", "bigint", "double"],
    "smallint": ["int", "bigint", "double"],
    "int": ["bigint", "double"],
    "float": ["double"],
}


def sql_string(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ddl_type(field: StructField) -> str:
    return field.dataType.simpleString()


def _merged_type(table: StructField, batch: StructField) -> str:
    """The type that holds the table's and the batch's values without loss."""
    old, new = _ddl_type(table), _ddl_type(batch)
    if old == new or old in _WIDER.get(new, []) or new == "void":
        return old
    if new in _WIDER.get(old, []):
        return new
    raise ValueError(f"column {table.name}: the table has {old}, the batch has {new}")


def create_if_missing(df: DataFrame, table: str, partition_col: str, location: str) -> None:
    """Create an external table with the frame's columns, if there is none."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {_ddl_type(f)}" for f in df.schema.fields)
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{partition_col}`) LOCATION {sql_string(location)}"
        )


def table_location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]


def aligned(df: DataFrame, table: str, partition_col: str) -> DataFrame:
    """The batch in the columns of ``table``, which first gets the batch's new columns and wider types."""
    spark = df.sparkSession
    existing = {f.name.lower(): f for f in spark.table(table).schema.fields}
    incoming = {f.name.lower(): f for f in df.schema.fields}
    if len(incoming) < len(df.columns):
        raise ValueError(f"columns of the batch differ in case only: {df.columns}")
    added = [f for k, f in incoming.items() if k not in existing]
    wider = {k: t for k, f in existing.items() if k in incoming and (t := _merged_type(f, incoming[k])) != _ddl_type(f)}
    if wider:
        _widen(spark, table, {existing[k].name: t for k, t in wider.items()}, partition_col)
    if added:
        cols = ", ".join(f"`{f.name}` {_ddl_type(f)}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    columns = [
        (F.col(f"`{incoming[k].name}`") if k in incoming else F.lit(None)).cast(wider.get(k, _ddl_type(f))).alias(f.name)
        for k, f in existing.items()
    ]
    columns += [F.col(f"`{f.name}`") for f in added]
    return df.select(*columns)


def append_partitioned(
    df: DataFrame,
    table: str,
    partition_col: str = "load_prdt",
    location: str | None = None,
) -> None:
    """Append ``df`` to ``table``, creating it (partitioned, parquet) if missing.

    Columns evolve: columns new to the table are added to its schema first
    (earlier rows read null in them), and table columns missing from the batch
    are written as typed nulls. Columns are matched by name, whatever the case. A batch of a
    wider type (bigint for int, double for float) widens the table's column, one of a
    narrower type is cast; any other change of type is an error.
    """
    rows = df
    if df.sparkSession.catalog.tableExists(table):
        rows, location = aligned(df, table, partition_col), None
    writer = rows.write.format("parquet").partitionBy(partition_col).mode("append")
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def _widen(spark: SparkSession, table: str, types: dict[str, str], partition_col: str) -> None:
    """Declare columns of an external parquet table with wider types, in place.

    One change of the catalog entry: the table is never without one, no partition is listed, and the
    files stay, because the reader widens their values. SQL has no such statement for
    parquet tables; the session catalog's own call for added columns does it.
    """
    kind = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Type'").first()["data_type"]
    if kind.upper() != "EXTERNAL":
        raise ValueError(f"{table} is a managed table; only external tables are widened")
    fields = [
        StructField(f.name, _parse_datatype_string(types[f.name]) if f.name in types else f.dataType, f.nullable, f.metadata)
        for f in spark.table(table).schema.fields
        if f.name != partition_col
    ]
    state = spark._jsparkSession.sessionState()
    name = state.sqlParser().parseTableIdentifier(table)
    schema = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(StructType(fields).json())
    state.catalog().alterTableDataSchema(name, schema)
    spark.catalog.refreshTable(table)
