"""Small tables written in code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """Rows held by the driver as a relation whose size the optimizer knows.

    ``createDataFrame`` on a list gives a table of unknown size, and a join with
    one shuffles the other side however large that is; this one is broadcast.
    """
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows, strict=True)) or [()] * len(arrow)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=arrow.names))


def inline(spark: SparkSession, data: Mapping[str, Sequence]) -> DataFrame:
    """Columns of mixed values as one table of text."""
    columns = [[None if v is None else str(v) for v in values] for values in data.values()]
    schema = ", ".join(f"`{name}` string" for name in data)
    return literal_table(spark, list(zip(*columns, strict=True)), schema)
