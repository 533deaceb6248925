"""Session helpers.

The library never creates a session behind a caller's back; operators take
DataFrames.  ``get_session`` is for tests, the bench and scripts.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings tidemark sessions start with.  ANSI makes bad casts fail loudly
# (the operators also check explicitly, so results do not depend on it), UTC
# for any zone-aware timestamp a caller adds.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


MiB = 1 << 20


def scale_settings(input_bytes: int, total_cores: int, shuffle_bytes: int | None = None,
                   target_partition_mib: int = 256, max_split_mib: int = 256,
                   max_partitions: int = 100_000) -> dict:
    """Partition sizing for a run that reads ``input_bytes`` on ``total_cores``.

    * initial shuffle partitions ≈ expected shuffle volume / target size
      (default volume: a quarter of the input — pruning and partial
      aggregation shrink it), at least 2 per core and at most
      ``max_partitions`` (shuffle blocks grow as mappers × reducers); each
      reducer then sorts / aggregates about ``target_partition_mib`` without
      spilling, and AQE coalesces the small ones;
    * file splits of at most ``max_split_mib`` so scan tasks fit memory and
      every core gets work;
    * AQE advisory size = target; a join partition above four times the
      target (and the skew factor times the median) is split as skewed.
    """
    volume = input_bytes // 4 if shuffle_bytes is None else shuffle_bytes
    parts = -(-volume // (target_partition_mib * MiB))
    parts = int(min(max_partitions, max(2 * total_cores, parts)))
    split = max(16 * MiB, min(max_split_mib * MiB, input_bytes // max(1, 3 * total_cores)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_mib * MiB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes":
            str(4 * target_partition_mib * MiB),
    }


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "tidemark", extra: dict | None = None,
                scale: tuple[int, int] | None = None) -> SparkSession:
    """Session with tidemark's settings.  ``scale=(input_bytes, total_cores)``
    applies ``scale_settings`` instead of the fixed ``shuffle_partitions``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    sized = scale_settings(*scale) if scale else {}
    for key, value in {**SESSION_CONF, **sized, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local tests) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: staged writes, "
                               "checkpoints and stream state must survive executor loss")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir (for staged writes)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidemark-{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staging folder this library created (after its data is committed)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def rename_path(spark: SparkSession, src: str, dst: str) -> None:
    """Rename a folder (parents are made); a file system that declines raises."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(src).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(dst).getParent())
    if fs.exists(path(dst)) or not fs.rename(path(src), path(dst)):
        raise OSError(f"cannot rename {src} to {dst}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file (an existing one is replaced)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Publish a small file whole unless there is one: of several writers one succeeds.
    A draft is renamed to it, which distributed file systems decline if the name is taken;
    a local rename would replace the file, so there the draft is linked instead."""
    jvm = spark.sparkContext._jvm
    as_path = jvm.org.apache.hadoop.fs.Path
    draft = f"{path.rpartition('/')[0]}/_draft-{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    fs = as_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        if fs.exists(as_path(path)):
            return False
        if fs.getUri().getScheme() != "file":
            return bool(fs.rename(as_path(draft), as_path(path)))
        local = [jvm.java.io.File(as_path(p).toUri().getPath()).toPath() for p in (path, draft)]
        try:
            jvm.java.nio.file.Files.createLink(*local)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in str(e.java_exception):
                return False
            raise
        return True
    finally:
        delete_path(spark, draft)


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is absent."""
    if not path_exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)]
