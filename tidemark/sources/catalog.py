"""Layer tables in the session catalog."""

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.history import BATCH, STREAM
from tidemark.schemas import LAYERS


def create_layers(spark: SparkSession, location=None, layers=LAYERS):
    """Create schemas and tables that are missing, partitioned by date."""
    for name, (table, columns, partition_col) in layers.items():
        database = table.split(".")[0]
        # a stream's micro-batch is a partition of bronze, so that a repeated one replaces itself
        more, parts = "", partition_col
        if name == "bronze":
            more, parts = f", {STREAM} STRING, {BATCH} BIGINT", f"{partition_col}, {STREAM}, {BATCH}"
        where = f" LOCATION '{location}/{database}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}{more}) "
            f"USING parquet PARTITIONED BY ({parts}) "
            "TBLPROPERTIES ('parquet.compression' = 'snappy')"
        )


def register_views(frames: dict[str, DataFrame]):
    """Offer layers to ``spark.sql`` under plain names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def list_objects(spark: SparkSession) -> DataFrame:
    """Databases and tables of the current catalog: one SHOW TABLES per database."""
    found = None
    for database in spark.catalog.listDatabases():
        tables = spark.sql(f"SHOW TABLES IN `{database.name}`").selectExpr(
            "namespace AS database", "tableName AS table", "if(isTemporary, 'TEMPORARY', 'TABLE') AS kind"
        )
        found = tables if found is None else found.union(tables)
    return found


def add_column(spark: SparkSession, table: str, column: str, kind: str):
    """Add a column without rewriting files; old rows read as NULL."""
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({column} {kind})")
