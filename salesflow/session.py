"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "salesflow", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with the settings the plans rely on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        # Split a hot join key even where the rows have to be shuffled again for it.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Checkpoints go away with the frames that use them.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local master, where driver and executors are one process, may fall
    back to a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="salesflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nothing has been written to yet, inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Setting of a session: a query's shuffle files go away when it ends.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Queries planned in the block leave no shuffle files, for those whose result is written.

    Else they stay until the driver happens to collect its garbage. Not for several threads of
    a session at once.
    """
    before = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, before)


def cut(df: DataFrame, release: bool = False) -> DataFrame:
    """Write ``df`` to the checkpoint folder and go on from the written rows.

    With ``release`` what was shuffled for it goes away at once.
    """
    shared_folder(df.sparkSession)
    if not release:
        return df.checkpoint(eager=True)
    with releasing(df.sparkSession):
        return df.select("*").checkpoint(eager=True)
