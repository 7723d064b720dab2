"""Session helpers: a tuned builder and the checkpoint-folder rule."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


#: Spark's setting: a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app: str = "kinlink",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE (coalesce + skew join) and UTC time.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to
    the data (about 128-256 MB of shuffle per partition); AQE then coalesces
    small ones and splits skewed join partitions at run time.  Without it
    Spark's own setting stays.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = (b.config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read
    it from the session and never invent one on a cluster.  Only a local
    master (tests, laptops) with no setting gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="kinlink-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared "
        "checkpoint folder on a cluster")


def materialize(df, tag: str = "t"):
    """Cut lineage by writing ``df`` as parquet under the checkpoint folder.

    One computation (an RDD ``checkpoint()`` recomputes an uncached plan to
    write it), columnar and compressed, and it survives lost executors.
    What the computation shuffled is removed with its end.
    Returns ``(frame, path)``; ``drop_materialized(spark, path)`` removes
    an intermediate table once nothing reads it any more.
    """
    import uuid
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/kinlink-{tag}-{uuid.uuid4().hex}"
    # small row groups keep the table splittable, so reading it back uses
    # every core instead of one task per file
    was = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("parquet.block.size", 8 * 1024 * 1024).option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if was is None else spark.conf.set(CLEANUP, was)
    return spark.read.parquet(path), path


def drop_materialized(spark, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(p, True)


def clear_materialized(spark) -> int:
    """Remove every table ``materialize`` wrote under the checkpoint folder.

    Call at the end of a job, once no DataFrame built from them is used
    any more.  Returns the number of folders removed.
    """
    root = spark.sparkContext.getCheckpointDir()
    if not root:
        return 0
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return 0
    n = 0
    for st in fs.listStatus(base):
        if st.getPath().getName().startswith("kinlink-"):
            fs.delete(st.getPath(), True)
            n += 1
    return n
