"""Rows of an entity export, whatever their columns."""

from __future__ import annotations

import datetime as dt
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.scalars import once
from martloom.ingest.shop import run_stamp

PLAIN = (T.StringType, T.NumericType, T.BooleanType)


def flat_rows(entities: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Scalars as they are, nested values as JSON text, anything else as text, plus the load stamp."""

    def flat(f: T.StructField):
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(f.name).alias(f.name)
        if isinstance(f.dataType, PLAIN):
            return F.col(f.name)
        return F.col(f.name).cast("string").alias(f.name)

    return entities.select(*[flat(f) for f in entities.schema.fields], run_stamp(run_at))


# ------------------------------------------------------------------ documents without a declaration


def read_or_reject(texts: DataFrame, text: str = "body") -> tuple[DataFrame, DataFrame]:
    """Rows with `doc`, the document as a variant in place of its text, and the rows whose text is no JSON object.

    Every row of texts is in exactly one of the two. An object that names a key twice is none.
    """
    others = [c for c in texts.columns if c != text]
    read = texts.select("*", once(F.try_parse_json(text)).alias("doc"))
    object_ = F.coalesce(F.schema_of_variant("doc").startswith("OBJECT<"), F.lit(False))
    return read.filter(object_).select(*others, "doc"), read.filter(~object_).select(*texts.columns)


def shape_of(docs: DataFrame, doc: str = "doc") -> T.StructType:
    """The fields that any of the documents has, with the type all its values fit: one aggregation over the documents,
    combined by task; a line of text for them all reaches the driver. A field that holds unlike values is a variant."""
    found = docs.agg(F.schema_of_variant_agg(doc)).first()[0]
    shape = T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<")) if found else None
    return shape if isinstance(shape, T.StructType) else T.StructType()


def _value(doc: Column, f: T.StructField, kind: str) -> Column:
    quote = '"' if "'" in f.name else "'"
    return F.try_variant_get(doc, f"$[{quote}{f.name}{quote}]", kind)


def _kind(f: T.StructField) -> str:
    return f.dataType.simpleString() if isinstance(f.dataType, (T.NumericType, T.BooleanType)) else "string"


def wide_rows(docs: DataFrame, shape: T.StructType, run_at: dt.datetime, doc: str = "doc") -> DataFrame:
    """A column per field: numbers and truth values as they are where all documents agree, nested values as JSON text,
    everything else, unlike values included, as text; null where a document lacks the field. Plus the load stamp.

    Names that differ in case only are one column, under the name that sorts first, as text if their types differ.
    A document that does not fit the shape, which another load may have found, has nulls where it doesn't.
    """
    columns = []
    for _, same in groupby(sorted(shape.fields, key=lambda f: (f.name.lower(), f.name)), key=lambda f: f.name.lower()):
        fields = list(same)
        kinds = {_kind(f) for f in fields}
        kind = kinds.pop() if len(kinds) == 1 else "string"
        columns.append(F.coalesce(*[_value(F.col(doc), f, kind) for f in fields]).alias(fields[0].name))
    return docs.select(*[c for c in docs.columns if c != doc], *columns, run_stamp(run_at))


def long_rows(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """A row per document and field: the document's other columns, field, kind of the value, and the value as text (null for
    a JSON null). A document without fields has no row."""
    each = docs.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col(doc).outer()))
    # 12, 2.5 and 1e3 are numbers alike; what an object or array holds is not told here
    kind = F.regexp_extract(F.schema_of_variant("value"), r"^\w+", 0)
    number = kind.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    return each.select(
        *[c for c in docs.columns if c != doc], F.col("key").alias("field"), F.lower(F.when(number, "NUMBER").otherwise(kind)).alias("kind"),
        F.col("value").cast("string").alias("value"),
    )
