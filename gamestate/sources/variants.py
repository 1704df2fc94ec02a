"""Landed documents as variants: keys that nobody declared are kept, found, and read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed line: its document as a variant, null where the line is no JSON."""
    return spark.read.text(path).where("trim(value) <> ''").select(F.try_parse_json("value").alias("doc"))


def get(path: str, kind: str, doc: str = "doc") -> Column:
    """The value at a path ('details.k') as a type; null where it is missing or of another kind."""
    return F.try_variant_get(doc, f"$.{path}", kind)


def schema(docs: DataFrame) -> str:
    """The type that fits all documents, declared or not."""
    return docs.agg(F.schema_of_variant_agg("doc")).first()[0]


def undeclared(docs: DataFrame, declared: StructType) -> DataFrame:
    """(path, kind, documents): keys of the documents that the declared type lacks, at any depth of what it declares.

    kind fits all values of the key; documents counts those that hold it, each element of an array by itself.
    """
    spark = docs.sparkSession
    out = None
    for path, known, level in _levels(docs.where("doc is not null").select("doc"), "", declared):
        keys = spark.sql("select key, value from {level}, lateral variant_explode(doc)", level=level).where(~F.col("key").isin(known))
        found = keys.groupBy(F.concat(F.lit(path), "key").alias("path")).agg(F.schema_of_variant_agg("value").alias("kind"), F.count("*").alias("documents"))
        out = found if out is None else out.unionByName(found)
    return out


def _levels(docs: DataFrame, path: str, kind: StructType) -> list[tuple[str, list[str], DataFrame]]:
    """Each declared object: its path, its keys, and the documents' parts there."""
    spark = docs.sparkSession
    out = [(path, kind.names, docs.where(F.schema_of_variant("doc").startswith("OBJECT")))]
    for f in kind.fields:
        inner, at = f.dataType, docs.select(F.try_variant_get("doc", f"$.{f.name}", "variant").alias("doc")).where("doc is not null")
        if isinstance(inner, ArrayType) and isinstance(inner.elementType, StructType):
            items = spark.sql("select value as doc from {level}, lateral variant_explode(doc)", level=at.where(F.schema_of_variant("doc").startswith("ARRAY")))
            out += _levels(items, f"{path}{f.name}[].", inner.elementType)
        elif isinstance(inner, StructType):
            out += _levels(at, f"{path}{f.name}.", inner)
    return out
