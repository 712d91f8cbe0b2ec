"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle behind the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # partitions that turn out small are hash-joined without sorting either side
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs rely on; a value somebody set at start is kept."""
    started_with = dict(spark.sparkContext.getConf().getAll())
    for key, value in _RUNTIME_DEFAULTS.items():
        if key not in started_with:
            spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application; Spark copies the file to the executors."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for module in sorted(root.rglob("*.py")):
                z.write(module, module.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(application)


def input_bytes(tables: Iterable[DataFrame]) -> int:
    """Bytes of the files and tables these plans read, from their listings; nothing is read."""
    total = 0
    for table in tables:
        leaves = table._jdf.queryExecution().optimizedPlan().collectLeaves()
        total += sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return total


#: More reducers than this cost the driver more in bookkeeping than they spare the tasks.
MOST_PARTITIONS = 20_000


def shuffle_partitions(total_bytes: int, cores: int, per_task: int = 128 << 20, most: int = MOST_PARTITIONS) -> int:
    """About ``per_task`` bytes per partition, at least one per core and at most ``most``.

    Adaptive execution merges partitions that turn out small and splits those that a join finds too large, so the
    number only has to be right within a factor. At 100 TB the bound holds, which makes 5 GB per task: such tasks
    spill, but map outputs times reducers stay within what a driver can hold.
    """
    return max(cores, min(most, -(-total_bytes // per_task)))


def size_shuffles(spark: SparkSession, tables: Iterable[DataFrame], per_task: int = 128 << 20) -> None:
    """Fit the number of shuffle partitions to the job that reads ``tables``. A number set at start is kept."""
    if spark.sparkContext.getConf().get("spark.sql.shuffle.partitions") is None:
        wanted = shuffle_partitions(input_bytes(tables), spark.sparkContext.defaultParallelism, per_task)
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one the cluster names, else a temporary one in local mode."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return f"{named.rstrip('/')}/{_run}" if _run else named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="martloom-")
    context.setCheckpointDir(made)
    return scratch_dir(spark)


_run = ""


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Everything :func:`cut` writes meanwhile goes into one folder, which is removed at the end.

    Results must be written elsewhere before the block ends. One run at a time per session.
    """
    global _run
    if _run:
        yield scratch_dir(spark)
        return
    scratch_dir(spark)  # names a folder where none is set
    _run = f"run-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    try:
        yield scratch_dir(spark)
    finally:
        _run = ""
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the files.

    Later passes read only the columns they need, and a lost executor costs a re-read
    instead of the whole upstream job.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
