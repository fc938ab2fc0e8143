"""Typed CSV load with a header row."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.specs import TableSpec

_UNPARSED = "_unparsed"


def read_csv(spark: SparkSession, path: str, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """``(rows in the spec's types, malformed rows as text)``.

    Fields are read as text and then cast, so whether a row is malformed does
    not depend on the columns a query happens to use. An unquoted empty field is
    NULL; quotes are doubled inside quoted fields. Files whose fields may hold
    line breaks cannot be split, so only tables that need it are read that way.
    """
    text = (
        spark.read.schema(spec.change_schema.add(_UNPARSED, "string"))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _UNPARSED)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", spec.multiline_text)
        .csv(path)
    )
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in spec.source_schema}
    misfits = [F.col(name).isNotNull() & value.isNull() for name, value in typed.items()]
    malformed = reduce(or_, misfits, F.col(_UNPARSED).isNotNull())
    as_read = F.coalesce(F.col(_UNPARSED), F.to_csv(F.struct(*spec.columns)))
    return (
        text.filter(~malformed).select(*[value.alias(name) for name, value in typed.items()]),
        text.filter(malformed).select(as_read.alias("line")),
    )
