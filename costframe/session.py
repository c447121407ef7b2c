"""Session helpers.

`get_spark` is for tests and the bench; on a cluster the caller's session is used as is.
`scratch_path` gives a folder under the shared checkpoint dir named by the session
(`spark.checkpoint.dir`); only when that is unset (local tests) a fresh /tmp folder is set. Every folder
given out is registered: `scratch_scope` removes those of a block of work when it ends, and what is left
goes when the driver process ends.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "costframe",
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediate tables."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: only the session conf is visible
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        master = "" if sc is None else sc.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # One JVM only (tests): nothing names a shared folder, so take a fresh one.
        root = tempfile.mkdtemp(prefix="costframe-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _GIVEN.setdefault(spark.sparkContext.applicationId, []).append((spark, path))
    return path


#: Scratch folders given out, by application.
_GIVEN: dict[str, list[tuple[SparkSession, str]]] = {}


def release_scratch(spark: SparkSession, since: int = 0) -> int:
    """Remove the scratch folders of this application from the `since`-th on; returns how many.

    Results that still read them can no longer be computed, so call it when their actions have ended.
    """
    given = _GIVEN.get(spark.sparkContext.applicationId, [])
    done, given[since:] = given[since:], []
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for _, path in done:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(done)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """A block whose scratch folders go at its end, those of inner blocks first:

        with scratch_scope(spark):
            QUERIES[name](spark, path).write.parquet(out)
    """
    since = len(_GIVEN.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        release_scratch(spark, since)


@atexit.register
def _release_all() -> None:
    for app, given in list(_GIVEN.items()):
        context = given[0][0].sparkContext if given else None
        with contextlib.suppress(Exception):  # a session that has ended: nothing can be reached any more
            if context is not None and context._jsc is not None and context.applicationId == app:
                release_scratch(given[0][0])
