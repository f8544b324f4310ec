"""What the corpus operators share: reading tables, scratch tables in the
shared folder, and blocks of text for vectorised code."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs_of(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text, *more) with a null text as the empty string; other
    columns of the input are left behind, so their names cannot clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *[F.col(c) for c in more],
    )


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.  Only where the session
    names none and runs on one machine (tests) a local one is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spotgrain-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table of the shared folder and read it again: cuts
    the lineage, and survives the loss of executors.  The table goes when the
    application ends, or with ``release``."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    out = spark.read.schema(schema).parquet(path)
    out._scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more."""
    for t in tables:
        where = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
        where.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def columns_of(df: DataFrame) -> list[Column]:
    """Every column by its exact name, dots and all."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


#: Stands for a null doc_id where rows are put in order.
LAST = (1 << 63) - 1


def row_order(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """ord and th: rows are ordered by doc_id (null last), then by 31 bits of
    the text's hash, so rows that share an id have places of their own."""
    return [F.coalesce(F.col(doc_id), F.lit(LAST)).alias("ord"), F.shiftrightunsigned(F.xxhash64(F.col(text), F.lit(31)), 33).cast("long").alias("th")]


def place_of(at: str) -> Column:
    """ord, th and a place within the row (under 2^31) as one number."""
    wide = F.col("ord").cast("decimal(20,0)") * F.lit(1 << 62).cast("decimal(19,0)")
    return (wide.cast("decimal(38,0)") + (F.col("th") * F.lit(1 << 31) + F.col(at)).cast("decimal(19,0)")).cast("decimal(38,0)")


def join_counted(left: DataFrame, right: DataFrame, on: list[str], n: str = "n", how: str = "inner", most: int = 20_000) -> DataFrame:
    """Inner or left join with ``right``, a written table with one row for each key and
    in column ``n`` how many rows of ``left`` have it.  Fewer than ``most`` keys
    have over a ``most``-th of those rows each: these are broadcast, so that a
    hot key's rows stay where they are.  All other keys are joined by an
    exchange, where none has more rows than that."""
    total = right.agg(F.sum(n)).first()[0] or 0
    hot = right.where(F.col(n) > max(500, total // most))
    if not hot.head(1):
        return left.join(right, on, how)
    cold = right.where(F.col(n) <= max(500, total // most))
    return left.join(F.broadcast(hot), on).unionByName(left.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on, how))


def repeated_rows(rows: DataFrame) -> DataFrame | None:
    """(uid) of the rows, of a written table (uid, ord, digest), that have the
    id and the text of a row with a smaller uid; None if there are none."""
    groups = materialize(rows.groupBy("ord", "digest").agg(F.count("*").alias("n"), F.min("uid").alias("least")).where("n > 1"), "equal-rows")
    if not groups.head(1):
        release(groups)
        return None
    return materialize(join_counted(rows.select("uid", "ord", "digest"), groups, ["ord", "digest"]).where("uid <> least").select("uid"), "repeated-rows")


def text_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets, without a copy."""
    col = batch.column(batch.schema.get_field_index(name))
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def row_blocks(offsets: np.ndarray, limit: int = 1 << 21):
    """(first, last+1) of runs of rows with about ``limit`` bytes together; a
    longer row is a run of its own.  Bounds what vectorised code allocates."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def ids_of(batch: pa.RecordBatch, name: str = "doc_id") -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
