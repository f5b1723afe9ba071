"""Session set-up shared by tests, the bench and the registered queries."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that may change on a running session. Event time is zone-less in the tables, so the session clock is UTC;
# keyed state goes to RocksDB so that it is not bounded by executor heap.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # A timestamp text that does not fit its format is a bad record, not an error of the job.
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and the web page off. A cluster's own master and conf win when unset here."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """A session with the runtime settings: the caller's own if it has them, else one beside it that shares all but those."""
    if all(spark.conf.get(key, None) == value for key, value in RUNTIME_CONF.items()):
        return spark
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **RUNTIME_CONF}.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


_LOCAL_BASE: list[str] = []


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for tables and checkpoints under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session of one process (``local``, ``local[n]``) without that setting gets a folder under the system's temporary
    one, which goes when Python ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        if not _LOCAL_BASE:
            _LOCAL_BASE.append(tempfile.mkdtemp(prefix="run-"))
            atexit.register(shutil.rmtree, _LOCAL_BASE[0], ignore_errors=True)
        base = _LOCAL_BASE[0]
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a written table in the shared folder: later steps read it, and a lost executor repeats only its reading."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
