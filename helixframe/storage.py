"""Where intermediate tables go, and what may be broadcast."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table of a few short columns that may be broadcast; larger ones are joined by shuffles.
BROADCAST_ROWS = 200_000

_private: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; on one machine (a local master) a private one where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _private:
        _private[app] = folder = tempfile.mkdtemp(prefix="helixframe-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _private[app]


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder, lineage cut."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def small(written: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`written` (a checkpoint, so that counting it is cheap) marked for broadcast if it has at most `most` rows."""
    return F.broadcast(written) if written.limit(most + 1).count() <= most else written
