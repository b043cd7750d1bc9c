"""How messages depart from the schema they are parsed by.

A fixed schema drops fields it does not know and turns a value of another type into
NULL, both silently. Here the new row of every message is taken as a variant instead,
its fields are listed with the types they have, and what the schema does not expect is
counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import emit_where
from tidemark.schemas import TableSpec
from tidemark.session import new_run_folder

UNKNOWN, CHANGED, TOO_LARGE, ABSENT = "unknown field", "changed type", "out of range", "absent field"


def new_rows(rows: DataFrame) -> DataFrame:
    """``after``, the new row of each topic row that has one, as a variant."""
    value = F.try_parse_json(F.col("value").cast("string"))
    parsed = rows.select(F.try_variant_get(value, "$.after", "variant").alias("after"))
    return emit_where(parsed, F.schema_of_variant("after").startswith("OBJECT"), ["after"])


def observed_schema(rows: DataFrame) -> DataFrame:
    """One row: the schema that all new rows have in common, in Spark's notation."""
    return new_rows(rows).agg(F.schema_of_variant_agg("after").alias("schema"))


def _problem(field: Column, found: Column, spec: TableSpec) -> Column:
    problem = F.when(~field.isin(*spec.record.fieldNames()), UNKNOWN)
    for wire in spec.record.fields:
        whole = isinstance(wire.dataType, (T.IntegerType, T.LongType))
        fits = found.isin("VOID", "BIGINT" if whole else "STRING")
        problem = problem.when((field == wire.name) & ~fits, CHANGED)
        if isinstance(wire.dataType, T.IntegerType):
            small = F.try_variant_get("value", "$", "int").isNotNull()
            problem = problem.when((field == wire.name) & (found == "BIGINT") & ~small, TOO_LARGE)
    return problem


def drift(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """``table_name``, ``field``, ``problem``, ``found_type`` and ``rows`` of each departure.

    An absent field is one that a new row does not have at all; NULL is a value.
    """
    spark = rows.sparkSession
    fields = new_rows(rows).lateralJoin(spark.tvf.variant_explode_outer(F.col("after").outer()))
    found = F.schema_of_variant("value")
    counts = (
        fields.select("pos", F.col("key").alias("field"), found.alias("found_type"), _problem(F.col("key"), found, spec).alias("problem"))
        .groupBy("field", "problem", "found_type")
        .agg(F.count("field").alias("rows"), F.count_if(F.coalesce("pos", F.lit(0)) == 0).alias("objects"))
    )
    # a few rows, written so that the messages are gone through once and not for each of the three uses
    folder = new_run_folder(spark, "drift")
    counts.write.parquet(folder)
    counted = spark.read.schema(counts.schema).parquet(folder)
    present = counted.groupBy("field").agg(F.sum("rows").alias("present"))
    expected = spark.createDataFrame([(n,) for n in spec.record.fieldNames()], "field string")
    missing = counted.agg(F.sum("objects")).scalar() - F.coalesce("present", F.lit(0))
    absent = expected.join(present, "field", "left").select(
        "field", F.lit(ABSENT).alias("problem"), F.lit(None).cast("string").alias("found_type"), missing.alias("rows")
    )
    departures = counted.filter("problem IS NOT NULL").select("field", "problem", "found_type", "rows")
    out = departures.unionByName(absent.filter("rows > 0"))
    return out.select(F.lit(spec.name).alias("table_name"), "field", "problem", "found_type", "rows")
