"""Session set-up, the shared working folder and the shipping of this package to the executors."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
#: Scratch paths made inside each open released() block.
_OPEN: list[list[str]] = []
#: Rows in an Arrow batch. Spark's default of 10,000 is meant for short rows; with texts, the batches that JVM and Python hold at once would take most of an executor.
ARROW_ROWS = 512


def get_session(app: str = "quarry", **conf: str) -> SparkSession:
    """A session with the settings the operators expect; conf overrides them."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application; size Arrow batches for texts."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    where = f"{scratch(spark, 'package')}/quarry.zip"
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    stream = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(there, True)
    stream.write(bytearray(body.getvalue()))
    stream.close()
    spark.sparkContext.addPyFile(where)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local master gets a folder of its own; on a cluster there is no folder to guess.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            where = known.get()
        elif spark.sparkContext.master.startswith("local"):
            where = tempfile.mkdtemp(prefix="quarry-shared-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def _on_store(spark: SparkSession, path: str):
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, which is removed at the end of the innermost released() block, or of the application."""
    path = f"{shared_dir(spark)}/quarry-{label}-{uuid.uuid4().hex}"
    store, there = _on_store(spark, path)
    store.deleteOnExit(there)
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    store, there = _on_store(spark, path)
    store.delete(there, True)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at the end; results have to be written elsewhere by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            drop(spark, path)


def materialise(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write df as a table in the shared folder (or at path) and read it back: lineage is cut, statistics are exact."""
    path = path or scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame) -> DataFrame:
    """df itself if it reads files row by row, else a written copy.

    Of both, a task that is run again sees the same rows in the same order, so numbers that are given
    by place (monotonically_increasing_id) hold within a query.
    """
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    for plan in nodes:
        if plan.nodeName() not in ("Project", "Filter", "LogicalRelation"):
            return materialise(df, "rows")
        nodes += [plan.children().apply(i) for i in range(plan.children().size())]
    return df


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of df's size: for a file scan, the size of its files."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 55 else 0


def parts(df: DataFrame, target: int = 2 << 20) -> int:
    """How many pieces of about target bytes df makes; at least the session's shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // target))
