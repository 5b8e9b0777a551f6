"""Session settings and the staging area for reused intermediate tables."""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def local_session(cpus="*", partitions=8, memory="8g", app="hazline"):
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can read, as the cluster names it in spark.checkpoint.dir.

    Only a local master without that setting gets a temporary folder of its own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = sc.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="hazline-")
        atexit.register(shutil.rmtree, _LOCAL_DIRS[app], ignore_errors=True)
    return _LOCAL_DIRS[app]


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def create_path(spark: SparkSession, path: str) -> bool:
    """Creates an empty file; False where it exists. At most one of several writers gets True."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    return files.createNewFile(target)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Rows hashed over all shuffle partitions, for work that grows from few or uneven inputs."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go at the end of the query that wrote them, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


class Stage:
    """Writes a table once so that several consumers read it instead of recomputing it.

    Parquet rather than checkpoint(): the consumers get column pruning and the
    planner gets the real size, and the plan above is computed only once.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.root = f"{folder or shared_dir(spark)}/stage-{uuid.uuid4().hex}"

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()

    def write(self, name: str, df: DataFrame) -> str:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return path

    def put(self, name: str, df: DataFrame) -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(self.write(name, df))

    def close(self) -> None:
        delete_path(self.spark, self.root)
