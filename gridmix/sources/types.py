"""Column types of landed text: a lattice of whole number, number, text.

The load step of the source infers a type per column and takes text where
values are mixed. Here the files stay text as landed; one aggregation over all
rows counts per column the values, the numbers and the whole numbers among them,
and the least kind that holds them all decides. A column without a value is a
number, as its missing values are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as a number in landed text (ASCII white space around it is ignored).
WHOLE = r"^[ \t]*[+-]?[0-9]{1,18}[ \t]*$"
NUMBER = r"^[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*$"
TYPES = {"whole": "bigint", "number": "double", "text": "string"}


def _counts(column: str) -> list[Column]:
    c = F.col(f"`{column}`")
    return [F.count(c), F.count_if(c.rlike(NUMBER)), F.count_if(c.rlike(WHOLE)), F.count(F.lit(1))]


def column_kinds(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """column_name, n_values, n_numbers, n_whole, kind: one pass over ``df``, a row a column."""
    names = columns or [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    told = df.agg(*[F.struct(F.lit(c).alias("column_name"), *[
        x.alias(n) for x, n in zip(_counts(c), ("n_values", "n_numbers", "n_whole", "n_rows"))]).alias(f"c{i}")
        for i, c in enumerate(names)])
    rows = told.select(F.explode(F.array(*[f"c{i}" for i in range(len(names))])).alias("c")).select("c.*")
    # a missing value has no whole number, so a column with one is a number at least
    kind = (F.when(F.col("n_numbers") < F.col("n_values"), "text")
            .when((F.col("n_whole") == F.col("n_values")) & (F.col("n_values") == F.col("n_rows"))
                  & (F.col("n_rows") > 0), "whole").otherwise("number"))
    return rows.withColumn("kind", kind).drop("n_rows")


def typed(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``df`` with its text columns in the types that hold all their values."""
    kinds = {r["column_name"]: r["kind"] for r in column_kinds(df, columns).collect()}    # a row a column
    return df.select(*[F.trim(F.col(f"`{c}`")).cast(TYPES[kinds[c]]).alias(c)
                       if kinds.get(c, "text") != "text" else F.col(f"`{c}`") for c in df.columns])
