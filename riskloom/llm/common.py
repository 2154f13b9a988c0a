"""Shared pieces: table readers, written intermediate tables, folds, Arrow maps."""

from __future__ import annotations

import os
import posixpath
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Words are maximal runs without these bytes (space, \t \n \v \f \r).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder path under the shared folder of ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets one of its own."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(os.path.abspath(spark.conf.get("spark.sql.warehouse.dir")
                                                            .removeprefix("file:")) + "/_checkpoints")
        base = spark.sparkContext.getCheckpointDir()
    return posixpath.join(base, f"llm-{uuid.uuid4().hex[:16]}")


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and reread: later
    passes, and tasks rerun after a lost executor, read the files."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables made by ``written`` that nothing will read again."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def fold(key: Column | str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus`` (null key: -1)."""
    col = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(modulus)), F.lit(-1)).cast("int")


def hash_below(key: str, share: float, seed: int = 17) -> Column:
    """A repeatable sample: true for about ``share`` of the keys."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch | dict]],
              schema: StructType) -> DataFrame:
    """``mapInArrow`` where ``fn`` turns one batch into batches or column dicts."""
    names = [f.name for f in schema.fields]
    types = {f.name: _arrow_type(f) for f in schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in fn(batch):
                if isinstance(out, dict):
                    out = pa.RecordBatch.from_arrays(
                        [out[n] if isinstance(out[n], pa.Array) else pa.array(out[n], types[n]) for n in names], names)
                yield out
    return df.mapInArrow(run, schema)


def _arrow_type(f: StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(f.dataType)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 of each text of a batch (null: empty)."""
    col = batch.column(batch.schema.get_field_index(name))
    return [t or b"" for t in col.cast(pa.binary()).to_pylist()]


def arrow_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], dict], schema: StructType) -> DataFrame:
    """``fn`` applied to each group of rows with equal keys. The groups are
    read as runs of a sorted stream, so many small ones cost little; each group
    must be of bounded size."""
    import numpy as np
    names = [f.name for f in schema.fields]
    types = {f.name: _arrow_type(f) for f in schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            cut = np.zeros(n, bool)
            for k in keys:
                col = batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)
                cut[1:] |= col[1:] != col[:-1]
                if held:
                    last = held[-1].column(batch.schema.get_field_index(k))[-1].as_py()
                    cut[0] |= last != col[0]
            edges = np.flatnonzero(cut).tolist()
            outs = []
            if held and edges:
                held.append(batch.slice(0, edges[0]))
                outs.append(fn(pa.Table.from_batches(held)))
                held = []
            if not edges:
                held.append(batch)
                continue
            if not cut[0] and not outs:
                edges.insert(0, 0)
            whole = pa.Table.from_batches([batch])
            for lo, hi in zip(edges, edges[1:]):
                outs.append(fn(whole.slice(lo, hi - lo)))
            held = [batch.slice(edges[-1])]
            if outs:
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([pa.array(o[c], types[c]) for o in outs]) for c in names], names)
        if held:
            out = fn(pa.Table.from_batches(held))
            yield pa.RecordBatch.from_arrays([pa.array(out[c], types[c]) for c in names], names)
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)
