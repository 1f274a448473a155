"""Session construction and the few session-level settings the library relies on.

Cluster jobs get their session from the platform; the library only reads
settings from it.  ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job here assumes.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "kestrel") -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="kestrel-local-", dir=os.environ.get("TMPDIR", "/tmp"))
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               # local runs only: tables go to a scratch warehouse
               .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse")))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per session.

    Jobs whose functions run in Python tasks then work from any folder and on
    machines where the package is not installed.
    """
    sc = spark.sparkContext
    if getattr(sc, "_kestrel_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # The session's own temporary folder: tasks fetch the file when they first start.
    path = os.path.join(tempfile.mkdtemp(prefix="ship-", dir=sc._temp_dir), "kestrel.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(base, name)
                z.write(full, os.path.join("kestrel", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._kestrel_shipped = True


def few_rows_at_once(spark: SparkSession, rows: int = 1000) -> None:
    """Send at most ``rows`` rows at once to Python from now on; a smaller setting stays.

    A batch is held whole in the JVM and in the Python worker, which keep that memory: of
    whole texts, the default of 10,000 rows takes tens of MB of each.  A stage's last step runs
    when its caller writes it, so the setting is the session's.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it once per session.

    On a cluster the platform names it in ``spark.checkpoint.dir``; a session
    that already has a folder keeps it (setting it again would nest a new
    folder inside the old one).  Only a local session without the setting gets
    a scratch folder; elsewhere a missing setting is an error, since a folder
    of the driver's machine is invisible to the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="kestrel-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()
