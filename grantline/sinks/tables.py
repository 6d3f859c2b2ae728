"""Saved tables and row counts."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from grantline.sources.tables import table_name


_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
#: The table property that names the run that wrote a table.
RUN = "grantline.run"


def save_table(rows: DataFrame, name: str, path: str | None = None) -> None:
    """Overwrite a table, schema included."""
    writer = rows.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table_name(name))


def merge_table(rows: DataFrame, name: str, partition: str, path: str | None = None) -> None:
    """Overwrite the partitions that the rows are of, and keep all others, and every column of both.

    Columns that the table lacks are added to it; columns that the rows lack become typed nulls in their
    partitions.  A column that both have must be of one type.
    """
    spark, table = rows.sparkSession, table_name(name)
    if not spark.catalog.tableExists(table):
        writer = rows.write.partitionBy(partition)
        (writer.option("path", path) if path else writer).saveAsTable(table)
        return
    saved = {field.name: field for field in spark.table(table).schema}
    new = [field for field in rows.schema if field.name not in saved]
    wrong = [f.name for f in rows.schema if f.name in saved and f.dataType != saved[f.name].dataType]
    if wrong:
        raise ValueError(f"columns of another type than in {name}: {wrong}")
    if new:
        added = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    columns = [
        F.col(f"`{field.name}`") if field.name in rows.columns else F.lit(None).cast(field.dataType).alias(field.name)
        for field in spark.table(table).schema
    ]
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        rows.select(*columns).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def mark_run(spark: SparkSession, names: list[str], run: str) -> None:
    """Say of tables, one after the other, that a run wrote them; overwriting a table takes that away."""
    for name in names:
        spark.sql(f"ALTER TABLE {table_name(name)} SET TBLPROPERTIES ('{RUN}' = '{run}')")


def run_of(spark: SparkSession, name: str) -> str | None:
    """The run that wrote a table and all that belongs to it."""
    properties = spark.sql(f"SHOW TBLPROPERTIES {table_name(name)}")
    found = properties.filter(F.col("key") == RUN).first()
    return found.value if found else None


def with_row_count(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows while another action runs, instead of in a second pass.

    The count is right where the rows go straight to the writer.  Behind it there must be no exchange: a
    sample for ranges, or a map task that is run again, would be counted as well.
    """
    observed = Observation(name)
    return rows.observe(observed, F.count(F.lit(1)).alias("n_rows")), observed


def row_counts(relations: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several relations as one result."""
    counts = [
        rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("relation"), "n_rows")
        for name, rows in relations.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
