"""One-hot encoding for columns of any number of categories: an index table, joined, into sparse vectors.

``model.one_hot`` makes a column a category and so has to collect them.  Here
the categories stay a table: neither the schema, the plan nor the driver holds
anything per category.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.expressions import require_columns
from tessera.operators.scan import prefix_scan
from tessera.session import scratch_dir


def category_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col, value, at): the distinct known values of each column as texts, numbered from 0 in ascending order; a written table.

    The numbers are positions of a prefix scan, so a column with most of all
    categories is spread over many tasks.
    """
    require_columns(df, cols, "category_index input")
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols]))
    values = df.select(pairs.alias("p")).select("p.col", "p.value").where("value is not null").distinct()
    numbered = prefix_scan(values, ["col"], ["value"], position="at").select("col", "value", "at")
    path = scratch_dir(df.sparkSession, "categories")
    numbered.write.parquet(path)
    return df.sparkSession.read.schema("col string, value string, at long").parquet(path)


def index_sizes(index: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """Number of categories of each column; one row a column reaches the driver."""
    found = {r["col"]: r["n"] for r in index.groupBy("col").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: found.get(c, 0) for c in cols}


def sparse_one_hot(df: DataFrame, cols: Sequence[str], index: DataFrame | None = None, numeric: Sequence[str] = (),
                   out_col: str = "features") -> DataFrame:
    """``df`` with a sparse Spark ML vector: the numeric columns, then a 1 for each column's category.

    ``index`` is a table of :func:`category_index` (of the training rows, say);
    a NULL or a value that it lacks has no 1.  Numeric values must be known; an
    unknown one is NaN.  The index is joined once a column; the planner
    broadcasts small ones, AQE splits a frequent category's part of the others.
    """
    require_columns(df, [*cols, *numeric], "sparse_one_hot input")
    index = index if index is not None or not cols else category_index(df, cols)
    sizes, offset, places = index_sizes(index, cols) if cols else {}, len(numeric), []
    out = df
    for i, c in enumerate(cols):
        own = index.where(F.col("col") == c).select(F.col("value").alias(f"__v{i}"), F.col("at").alias(f"__a{i}"))
        out = out.join(own, F.col(f"`{c}`").cast("string") == F.col(f"__v{i}"), "left")
        places.append((F.col(f"__a{i}") + offset).cast("int"))
        offset += sizes[c]
    hot = F.array_compact(F.array(*places)) if places else F.array().cast("array<int>")
    known = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in numeric]
    indices = F.concat(F.array(*[F.lit(i) for i in range(len(numeric))]).cast("array<int>"), hot)
    values = F.concat(F.array(*known).cast("array<double>"), F.transform(hot, lambda _: F.lit(1.0)))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(offset).alias("size"), indices.alias("indices"), values.alias("values"))
    out = out.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), vector.alias("vector"))
    # The struct is the vector's own storage form; passing it through gives it the type.
    schema = T.StructType([T.StructField("row", out.schema["row"].dataType), T.StructField("vector", VectorUDT())])
    return out.mapInArrow(lambda batches: batches, schema).select("row.*", F.col("vector").alias(out_col))


def sparse_entries(df: DataFrame, vector_col: str = "features") -> DataFrame:
    """``df`` with the vectors as (size int, indices array<int>, values array<double>): what they store, in ascending order of the indices.

    A row costs its stored values, not its vector's length; of a dense vector all are stored.
    """
    require_columns(df, [vector_col], "sparse_entries input")
    # The vector's own storage form, the other way round than in sparse_one_hot; numbered columns, as mapInArrow takes no name with a dot.
    fields = [T.StructField(f"c{i}", VectorUDT.sqlType() if f.name == vector_col else f.dataType) for i, f in enumerate(df.schema.fields)]
    out = df.toDF(*[f.name for f in fields]).mapInArrow(lambda batches: batches, T.StructType(fields))
    name = f"c{df.columns.index(vector_col)}"
    v = F.col(name)
    every = F.when(F.size(v["values"]) > 0, F.sequence(F.lit(0), F.size(v["values"]) - 1)).otherwise(F.array().cast("array<int>"))
    entries = F.struct(F.coalesce(v["size"], F.size(v["values"])).alias("size"), F.coalesce(v["indices"], every).alias("indices"),
                       v["values"].alias("values"))
    return out.withColumn(name, F.when(v.isNotNull(), entries)).toDF(*df.columns)
