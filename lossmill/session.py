"""Session settings and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "lossmill", memory: str = "16g") -> SparkSession:
    """Single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine;
    on a cluster that folder would not be visible to the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lossmill-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_dropping: dict[SparkSession, tuple[int, str]] = {}
_drop_lock = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside are deleted when a write ends.

    Otherwise they stay until the driver happens to collect its garbage, which with
    much memory may be never. For writes whose rows nothing else takes from the shuffle.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with _drop_lock:  # threads may write at the same time
        inside, before = _dropping.get(spark, (0, ""))
        if not inside:
            before = spark.conf.get(setting, "false")
            spark.conf.set(setting, "true")
        _dropping[spark] = inside + 1, before
    try:
        yield
    finally:
        with _drop_lock:
            inside, before = _dropping.pop(spark)
            if inside > 1:
                _dropping[spark] = inside - 1, before
            else:
                spark.conf.set(setting, before)


def cut_lineage(frame: DataFrame, spread: bool = False) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    Later stages depend on the written files only, so a lost executor costs a
    re-read and not a recomputation of everything upstream. ``spread`` deals the
    rows out to all shuffle partitions, for small frames that take many passes.
    """
    path = scratch_path(frame.sparkSession, "stage")
    if spread:
        partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        frame = frame.repartition(partitions)
    with shuffles_dropped(frame.sparkSession):
        frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_sent: set[str] = set()
_sending = threading.Lock()  # models train side by side


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors once per application, like --py-files."""
    context = spark.sparkContext
    with _sending:
        if context.applicationId in _sent:
            return
        package = Path(__file__).resolve().parent
        path = Path(tempfile.mkdtemp(prefix="lossmill-py-")) / "lossmill.zip"
        with zipfile.ZipFile(path, "w") as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(str(path))
        _sent.add(context.applicationId)
