"""Session and lineage helpers shared by all multi-round jobs."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reliefgrid.rounds import Journal, Rounds, shared_folder


#: Files of cells are packed about thirtyfold, so that is their size where a join asks what may be broadcast; shuffles
#: are written in many parts, which the adaptive planner puts together up to a size that fits the sorts of a chain of windows.
BOUNDED = {
    "spark.sql.sources.fileCompressionFactor": "30",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",  # with more a writing task would sort its rows in memory
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
}


def bounded_tasks(spark: SparkSession) -> None:
    """The settings of BOUNDED for a session made elsewhere, unless it names a number of parts itself."""
    if spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None:
        for name, value in BOUNDED.items():
            spark.conf.set(name, value)


def get_session(app: str = "reliefgrid", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library was designed for."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        **BOUNDED,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


_ROUNDS: dict[str, Rounds] = {}


def _rounds_of(spark: SparkSession) -> Rounds:
    app = spark.sparkContext.applicationId
    if app not in _ROUNDS:
        _ROUNDS[app] = Rounds(spark, "rounds")
    return _ROUNDS[app]


def journal(spark: SparkSession, job: str, name: str | None = None, **settings) -> Journal:
    """The journal of the job called ``name``; without a name a new one among the application's round tables."""
    if name is None:
        return Journal(spark, f"{_rounds_of(spark).base}/{job}-{uuid.uuid4().hex}", settings)
    return Journal(spark, f"{shared_folder(spark)}/{job}-{name}", settings)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows starts at files.

    The tables of an application lie in one folder, which ``clear_rounds`` deletes.
    """
    rounds = _rounds_of(df.sparkSession)
    typed = df.withColumns({f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema.fields if f.dataType.typeName() == "void"})
    return rounds.put(typed, f"cut{rounds.count}")


def clear_rounds(spark: SparkSession) -> None:
    """Delete the round tables of the application, once no result still reads them."""
    if rounds := _ROUNDS.pop(spark.sparkContext.applicationId, None):
        rounds.clear()


_SHIPPED: set[str] = set()


BATCH_ROWS = 1000  # rows of an Arrow batch: texts can be long, and both sides of the pipe hold a batch


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the workers, once per application.

    Functions that run in Python workers refer to their modules by name, and a
    worker need not see the folder that the driver started from.  Arrow batches of the
    session are held to BATCH_ROWS.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows)) > BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="reliefgrid-")), "reliefgrid_modules.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for package in ("reliefgrid", "workload"):
            for folder, _, names in os.walk(os.path.join(root, package)):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, root))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
