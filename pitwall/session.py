"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Rows one task may hold comfortably.  Groups above this size take the sliced
# paths in operators.scan / operators.history / operators.quantiles.
ROWS_PER_TASK = 4_000_000


def get_session(app: str = "pitwall", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; the cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local["):
        ship_code(spark)
    return spark


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, so that they need no copy of their own."""
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="pitwall-code-")  # read by the driver only, which serves it
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/{root.name}.zip", "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(f"{folder}/{root.name}.zip")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  A local session without any
    gets a temporary one, which goes with the process; elsewhere that is an error,
    as executors would not see each other's files."""
    folder = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
              or spark.conf.get("pitwall.shared.dir", None))
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="pitwall-shared-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("pitwall.shared.dir", folder)
    return folder


_DROPS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing, _lock = 0, threading.Lock()


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs begun inside drop their shuffle files when they are done.

    Otherwise the files stay until the driver happens to collect garbage, so a chain of written
    tables holds the shuffles of all its steps.  Meant for jobs that nobody repeats on the same
    plan; one that does runs its lost stages again.
    """
    global _writing
    with _lock:
        mine = _writing or spark.conf.get(_DROPS, "false") != "true"  # a session that has it on keeps it
        if mine:
            _writing += 1
            spark.conf.set(_DROPS, "true")
    try:
        yield
    finally:
        with _lock:
            if mine:
                _writing -= 1
                if not _writing:
                    spark.conf.set(_DROPS, "false")


def materialise(df: DataFrame, schema: StructType | None = None, done: Sequence[DataFrame] = ()) -> DataFrame:
    """Write the rows once to the shared folder and read them from there.

    Cuts the lineage and survives lost executors.  The table is Parquet, so each
    later reader loads only the columns it needs.  ``schema`` may name other types for
    the same stored form.  ``done`` are written tables that nothing but ``df`` reads: they
    are removed once ``df`` is there.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/pitwall-{uuid.uuid4().hex}"
    with passing_shuffles(spark):
        df.write.parquet(path)
    remove_written(*done)
    return spark.read.schema(schema or df.schema).parquet(path)


def remove_written(*tables: DataFrame) -> None:
    """Remove tables of ``materialise`` that nobody reads any more; others are an error."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            if not folder.rsplit("/", 1)[-1].startswith("pitwall-"):
                raise ValueError(f"{folder} is no table of materialise")
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
