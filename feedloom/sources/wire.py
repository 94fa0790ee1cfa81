"""Published feeds as JSON text and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import collapse, escape, unescape


def to_wire(columns: list[str], escaped: list[str] = (), collapsed: list[str] = ()) -> Column:
    """One JSON object in the given order of keys."""
    form = lambda c: collapse(F.col(c)) if c in collapsed else F.col(c)
    return F.to_json(F.struct(*((escape(form(c)) if c in escaped else form(c)).alias(c) for c in columns)))


def from_wire(wire: Column, schema: T.StructType, escaped: list[str] = ()) -> Column:
    got = F.from_json(wire, schema, {"mode": "PERMISSIVE"})
    return F.struct(*((unescape(got[f.name]) if f.name in escaped else got[f.name]).alias(f.name) for f in schema.fields))


def read(spark, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def write_selected(records: DataFrame, path: str) -> None:
    """Published records in a folder by source."""
    records.write.mode("overwrite").partitionBy("source").json(path)


def read_selected(spark, path: str, schema: T.StructType, sources: list[str]) -> DataFrame:
    """Records of some sources: the others' folders are not read."""
    return spark.read.schema(schema).json(path).filter(F.col("source").isin(sources))
