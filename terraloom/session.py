"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "terraloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and Arrow transfer switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("terraloom.shared.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="terraloom-")
        spark.conf.set("terraloom.shared.dir", named)
    return named.rstrip("/")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed wherever it is not installed on the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="terraloom-ship-")) / "terraloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


_handed_out: dict[str, list[str]] = {}


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    path = f"{shared_dir(spark)}/terraloom/{label}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def handed_out(spark: SparkSession) -> list[str]:
    """Paths below the shared folder that this application was given so far."""
    return list(_handed_out.get(spark.sparkContext.applicationId, []))


def discard(spark: SparkSession, names: list[str]) -> None:
    """Delete tables below the shared folder once nothing reads them any more."""
    context = spark.sparkContext
    own = _handed_out.get(context.applicationId, [])
    for name in names:
        if name in own:
            own.remove(name)
            path = context._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Delete what this application wrote below the shared folder.

    Results that still read from there become unreadable: write them out first.
    """
    discard(spark, handed_out(spark))


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage like a reliable checkpoint, but stays columnar: readers prune
    columns and the planner sees the true size. Survives lost executors.
    """
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a join side that is never broadcast: for tables that grow with the input.

    Spark judges a table by its compressed files and sends up to ten times as much through
    the driver when it broadcasts a table just below its bound.
    """
    return df.hint("merge")


#: A table of more rows is joined by shuffle in ``lookup``, however small its files are.
BROADCAST_ROWS = 20_000
#: A key with more facts is joined by broadcast, however large the table is.
HEAVY_ROWS = 2_000_000


def lookup(facts: DataFrame, dim: DataFrame, keys: list[str], weight: str, how: str = "left",
           share: int = 1000) -> DataFrame:
    """Join every fact to its single ``dim`` row when a few keys may own most facts.

    ``dim`` must be unique on ``keys`` and carry in ``weight`` the number of facts per
    key. Keys owning more than ``HEAVY_ROWS`` facts, or 1/``share`` of a smaller table,
    are broadcast: there are at most total / bound of them. The rest is shuffled, and no
    key in it owns more rows than one task takes. Without heavy keys this is the plain join.
    """
    rows, total, top = dim.agg(F.count("*"), F.sum(weight), F.max(weight)).first()
    bound = max(min((total or 0) // share, HEAVY_ROWS), 10_000)
    sized = shuffled if rows > BROADCAST_ROWS else lambda df: df
    if (top or 0) <= bound:
        return facts.join(sized(dim), keys, how)
    heavy = dim.where(F.col(weight) > bound)
    light = dim.where(F.col(weight) <= bound)
    small = F.broadcast(heavy)
    on_heavy = facts.join(small, keys, "inner")
    on_light = facts.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(sized(light), keys, how)
    return on_heavy.unionByName(on_light)
