"""Small helpers shared by the operators of this subpackage.

Keys: a row of a table is known by its id and a hash of its text, so repeated ids with different
texts never share results. Null ids are kept; joins on keys are null-safe.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsepanel.session import shared_table_path

ROW = "row_key"
#: Rows up to which a side is broadcast; beyond it the join shuffles both sides.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text (null: empty) and the row key, whatever else the table holds."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).withColumn(
        ROW, F.xxhash64("text")
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: a cut of the lineage."""
    spark = df.sparkSession
    path = shared_table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the counted rows are within the bound, else the table as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_rows(rows: DataFrame, other: DataFrame, how: str = "left") -> DataFrame:
    """Join on doc_id (null-safe) and row key; the columns of ``rows``, then the rest of ``other``."""
    rest = [c for c in other.columns if c not in ("doc_id", ROW)]
    right = other.select(F.col("doc_id").alias("_doc_id"), F.col(ROW).alias("_row"), *rest)
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col(ROW) == F.col("_row"))
    joined = rows.join(right, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("_doc_id", "_row")


def join_table(docs: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join a table with doc_id and text, whatever else it holds, to results known by id and row key.

    Gives the table's columns; for a left join those of ``other`` follow under names the table hasn't.
    """

    def fresh(name: str) -> str:
        while name in docs.columns:
            name += "_"
        return name

    key, right_id, right_key = fresh("_key"), fresh("_right_id"), fresh("_right_key")
    extra = {c: fresh(f"_{c}") for c in other.columns if c not in ("doc_id", ROW)}
    right = other.select(
        F.col("doc_id").alias(right_id),
        F.col(ROW).alias(right_key),
        *(F.col(c).alias(name) for c, name in extra.items()),
    )
    left = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col(right_id)) & (F.col(key) == F.col(right_key))
    names = [*docs.columns, *(extra.values() if how == "left" else ())]
    return left.join(right, same, how).select([F.col(f"`{c}`") for c in names])


#: Bytes of input that row-wise functions with much output are given at once.
SLICE_BYTES = 1 << 22


def sliced(batch: pa.RecordBatch, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about so many bytes, a row at least."""
    rows = max(1, batch.num_rows * most_bytes // max(1, batch.nbytes))
    for begin in range(0, batch.num_rows, rows):
        yield batch.slice(begin, rows)


def arrow_map(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], dict | None],
    schema: str,
    slice_bytes: int | None = None,
) -> DataFrame:
    """mapInArrow with a function from one batch to columns; batches are bounded by Spark.

    ``slice_bytes`` cuts them further, for functions that look at single rows and give much more than they get.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow_schema = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole,) if slice_bytes is None else sliced(whole, slice_bytes):
                columns = function(batch)
                if columns is not None:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(columns[f.name], f.type)
                            if not isinstance(columns[f.name], pa.Array)
                            else columns[f.name].cast(f.type)
                            for f in arrow_schema
                        ],
                        schema=arrow_schema,
                    )

    return df.mapInArrow(run, schema)
