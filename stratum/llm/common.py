"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.session import drop_scratch, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage, and a lost executor loses nothing of it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._scratch = path
    return kept


def forget(*frames: DataFrame) -> None:
    """Delete the files of :func:`stored` frames that nothing reads any more:
    what was derived from them must itself be stored by now."""
    for df in frames:
        drop_scratch(df.sparkSession, df._scratch)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_file_order(docs: DataFrame, part: str, row: str) -> DataFrame:
    """``docs`` with its place in the files it is read from: the number in the
    name of the part file and the row in it. Spark reads files in any order;
    sorted by these two, rows are in the order in which a sorted frame was
    written. Of a frame that is not read from files the places are those of its
    partitions."""
    try:
        file = docs.metadataColumn("_metadata")
        number = F.regexp_extract(file["file_name"], r"^part-(\d+)", 1).try_cast("int")
        return docs.withColumns({part: F.coalesce(number, F.lit(0)), row: file["row_index"]})
    except AnalysisException:
        return docs.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()})


def copies(rows: DataFrame, n: str, number: str, chunk: int = 10_000) -> DataFrame:
    """Each row ``n`` times, numbered from 0 in ``number``. First every
    ``chunk`` copies become a row and these are dealt out, so a row with very
    many copies is multiplied by many tasks."""
    at = rows.withColumn(number, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1, F.lit(chunk).cast("bigint"))))
    at = at.repartition(F.xxhash64(*at.columns))
    upto = F.least(F.col(number) + chunk, F.col(n)) - 1
    return at.withColumn(number, F.explode(F.sequence(F.col(number), upto))).drop(n)


def with_field(schema: T.StructType, name: str, dtype: T.DataType) -> T.StructType:
    """``schema`` with ``name`` appended; a column of that name goes."""
    return T.StructType([f for f in schema.fields if f.name != name]).add(name, dtype)


def append_column(batch, name: str, values):
    """An Arrow batch with one column appended; a column of that name goes."""
    import pyarrow as pa

    keep = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(i) for i in keep), values], names=[*(batch.schema.names[i] for i in keep), name]
    )


def text_slices(column, max_bytes: int = 2 << 20):
    """Row ranges ``(start, end)`` of an Arrow string column of about
    ``max_bytes`` each (one row at least), so that a batch of very long texts
    is not turned into Python objects all at once."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > max_bytes:
            yield start, i
            start, size = i, 0
        size += n
    if lengths:
        yield start, len(lengths)


def first_of_each(batches):
    """Arrow batches without the rows whose ``key`` the row before already had:
    a merge join leaves rows of equal id and text next to each other."""
    import numpy as np
    import pyarrow as pa

    last = None
    for batch in batches:
        keys = batch.column("key").to_numpy()
        if len(keys):
            new = np.r_[last is None or keys[0] != last, keys[1:] != keys[:-1]]
            last = keys[-1]
            yield batch.filter(pa.array(new))


def worker_cache(name: str, make):
    """An object that a Python worker keeps between its tasks, made on first
    use; the caller bounds its size. A new worker simply starts anew."""
    import sys
    import types

    kept = sys.modules.setdefault("_kept_between_tasks", types.ModuleType("_kept_between_tasks"))
    if not hasattr(kept, name):
        setattr(kept, name, make())
    return getattr(kept, name)
