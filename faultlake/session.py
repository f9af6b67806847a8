"""Session helpers: table access, shared scratch space and staged tables.

Everything that cuts lineage goes to the folder named in ``spark.checkpoint.dir``; a local one is
made only where the session names none (tests, one-machine runs).
"""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the data folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for staged data: the session's checkpoint folder, or a temporary one where none is set and all runs on one machine.

    On a cluster a temporary folder would be another one on every machine, so a session without ``spark.checkpoint.dir`` is refused (ValueError).
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    made = getattr(spark, "_faultlake_scratch", None)
    if made is None:
        made = "file://" + tempfile.mkdtemp(prefix="faultlake-")
        spark._faultlake_scratch = made
        spark.sparkContext.setCheckpointDir(made)
    return made


def staged_folder(spark: SparkSession) -> str:
    """Folder of this application's staged tables, deleted when the application ends."""
    root = f"{scratch_dir(spark)}/staged/{spark.sparkContext.applicationId}"
    if getattr(spark, "_faultlake_staged", None) != root:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        spark._faultlake_staged = root
    return root


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Later stages start from the written table, so a lost executor costs no recomputation of what lies
    before it, and a table used twice is computed once.
    """
    path = f"{staged_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked_broadcast(small: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint behind a count: only a side of at most ``max_rows`` rows is broadcast.

    A larger side is returned as it is and Spark joins it by sort-merge or shuffled hash.
    """
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the unit for explicit repartitioning."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def global_ordinal(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Number the rows of each ``group`` from 0 by ``order`` without one task per group.

    Rows are range-partitioned by (group, order), counted per (partition, group), and each row's number
    is its place in its partition plus the counts of the partitions before it. A group that holds a third
    of all rows is spread over many tasks. ``order`` must be total within a group.
    """
    from pyspark.sql import Window as W

    n = parallelism(df.sparkSession)
    cut = stage(df.repartitionByRange(n, group, *order).withColumn("_part", F.spark_partition_id()))
    local = W.partitionBy("_part", group).orderBy(*order)
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = cut.groupBy(group, "_part").agg(F.count("*").alias("_n")).select(
        group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (cut.withColumn("_here", F.row_number().over(local) - 1)
            .join(offsets, [group, "_part"])
            .withColumn(name, (F.col("_here") + F.col("_before")).cast("long"))
            .drop("_part", "_here", "_before"))


def map_groups(df: DataFrame, group: str, run: Callable[[pa.Table, np.ndarray], pa.RecordBatch | pa.Table], schema: str, together: bool = False) -> DataFrame:
    """``run(rows, sizes)`` over Arrow tables of whole groups: rows of ``df`` with those of a group one after another, and how many each group has.

    Groups are shuffled and sorted as plain rows, which spill (``together``: ``df`` has the rows of each group one after another in one partition
    already, and is taken as it is). Rows come in batches, and a worker holds one batch and the group it breaks off in, however many groups a task has.
    """
    def ends(keys: pa.Array | pa.ChunkedArray) -> np.ndarray:
        keys = keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys
        return pc.run_end_encode(keys).run_ends.to_numpy()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(parts)
            out = run(rows, np.diff(ends(rows[group]), prepend=0))
            return iter([out] if isinstance(out, pa.RecordBatch) else out.to_batches())

        held: list[pa.RecordBatch] = []  # the group broken off
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch[group]
            cut = int(np.append(0, ends(keys))[-2])
            if cut or (held and held[-1][group][-1].as_py() != keys[0].as_py()):
                yield from done([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from done(held)

    return (df if together else df.repartition(group).sortWithinPartitions(group)).mapInArrow(whole, schema)


def configure_logging(level: str = "INFO", logfile: str | None = None) -> None:
    """Messages of the driver to the console, or with their times to a file; the executors' logs are the cluster's."""
    line = "%(levelname)s:%(name)s:%(message)s"
    handler = logging.FileHandler(logfile, encoding="utf-8") if logfile else logging.StreamHandler()
    handler.setFormatter(logging.Formatter(("%(asctime)s " if logfile else "") + line))
    root = logging.getLogger()
    root.setLevel(level.upper())
    root.addHandler(handler)


STRINGS = T.ArrayType(T.StringType())
