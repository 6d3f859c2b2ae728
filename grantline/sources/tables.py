"""Catalog tables by three-part name, and landed JSON with what is wrong with it."""

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

_PART = r"(?:[A-Za-z0-9_-]+|`[A-Za-z0-9_-]+`)"
_TABLE = re.compile(rf"{_PART}(?:\.{_PART}){{2}}")


def table_name(name: str) -> str:
    """Check ``catalog.schema.table`` and return it quoted."""
    name = name.strip()
    if not _TABLE.fullmatch(name):
        raise ValueError(f"not a catalog.schema.table name: {name!r}")
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(table_name(name))


@dataclass(frozen=True)
class Landed:
    """Landed JSON: ``records`` that fit the schema; ``rejected``: ``line`` and ``reason`` of all others.

    Each text is in one of the two, so their counts add up to the lines.  ``drift`` counts the fields that
    the schema lacks: ``field`` (a dotted path, ``[]`` for the elements of a list), ``type``, ``n_values``.
    """

    records: DataFrame
    rejected: DataFrame
    drift: DataFrame


_CORRUPT = "_corrupt_record"


def parse_landed(lines: DataFrame, column: str, schema: StructType, needed: tuple[str, ...] = ()) -> Landed:
    """JSON texts in a column; other columns go along with records and rejects.

    Why a text is rejected: ``malformed`` (no JSON), ``not_an_object``, ``wrong_type`` (a field is of another form
    than the schema says), ``missing_field`` (one of ``needed`` is not there or null).
    """
    others = [c for c in lines.columns if c != column]
    # Spark keeps a text that it cannot read as the schema says in the extra field.
    read = F.from_json(
        column, StructType([*schema.fields, StructField(_CORRUPT, StringType())]), {"columnNameOfCorruptRecord": _CORRUPT}
    )
    parsed = lines.select(*others, F.col(column).alias("line"), read.alias("_record"))
    fits = F.col("_record").isNotNull() & F.col(f"_record.{_CORRUPT}").isNull()
    whole = reduce(lambda all_of, c: all_of & F.col(f"_record.`{c}`").isNotNull(), needed, F.lit(True))
    records = parsed.filter(fits & whole).select(*others, *[F.col(f"_record.`{c}`").alias(c) for c in schema.names])
    value = F.try_parse_json("line")
    reason = (
        F.when(fits, "missing_field").when(value.isNull(), "malformed")
        .when(~F.schema_of_variant(value).startswith("OBJECT"), "not_an_object").otherwise("wrong_type")
    )
    rejected = parsed.filter(~(fits & whole)).select(*others, "line", reason.alias("reason"))
    return Landed(records, rejected, _drift(lines, column, schema))


def _drift(lines: DataFrame, column: str, schema: StructType) -> DataFrame:
    spark = lines.sparkSession
    texts = lines.select(F.try_parse_json(column).alias("v")).filter("v IS NOT NULL")

    def fields(values: DataFrame, own: StructType, prefix: str) -> list[DataFrame]:
        keys = values.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).filter("key IS NOT NULL")
        found = [
            keys.filter(~F.col("key").isin(own.names))
            .select(F.concat(F.lit(prefix), "key").alias("field"), F.schema_of_variant("value").alias("type"))
        ]
        for field in own.fields:
            inner, is_list = (field.dataType.elementType, True) if isinstance(field.dataType, ArrayType) else (field.dataType, False)
            if isinstance(inner, StructType):
                values_of = keys.filter(F.col("key") == field.name)
                if is_list:
                    values_of = values_of.select(F.explode(F.expr("try_variant_get(value, '$', 'array<variant>')")).alias("v"))
                else:
                    values_of = values_of.select(F.col("value").alias("v"))
                found += fields(values_of, inner, f"{prefix}{field.name}{'[]' if is_list else ''}.")
        return found

    return reduce(DataFrame.unionByName, fields(texts, schema, "")).groupBy("field", "type").agg(F.count("*").alias("n_values"))


def landed(spark: SparkSession, path: str, schema: StructType, needed: tuple[str, ...] = ()) -> Landed:
    """Landed files of one JSON record per line (see ``parse_landed``); blank lines do not count."""
    lines = spark.read.text(path).filter(F.trim(F.col("value")) != "")
    return parse_landed(lines, "value", schema, needed)


def read_landed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The landed JSON records that fit a fixed schema (see ``grantline.schemas``)."""
    return landed(spark, path, schema).records


def query_table(spark: SparkSession, name: str) -> DataFrame:
    """Read a saved table back through SQL."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": table_name(name)})
