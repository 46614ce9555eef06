"""Session helpers: a local session for tests and tools, and the shared scratch folder."""

from __future__ import annotations

import atexit
import hashlib
import io
import os
import shutil
import tempfile
import threading
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured like the tests and the benchmark expect."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("adtally")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local master, where driver and
    executors are one machine, may do without: a temporary folder is then made and
    registered as the checkpoint folder. Elsewhere a missing setting is an error, because
    each executor would write to a disk of its own.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="adtally-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    path = "/".join([base.rstrip("/"), *parts])
    if path.startswith("/") or path.startswith("file:"):
        os.makedirs("/" + path.removeprefix("file:").lstrip("/"), exist_ok=True)
    return path


_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``adtally`` importable in the Python workers (once per SparkContext).

    Functions given to ``mapInArrow`` and the ZIP data source refer to this package by
    module name, so the workers need it. It is zipped on the driver and sent with
    ``addPyFile``, the same way ``--py-files`` would send it to every executor.
    """
    sc = spark.sparkContext
    with _SHIP_LOCK:
        if not getattr(sc, "_adtally_shipped", False):
            # the driver serves the file to each executor that joins, so it stays to the end
            folder = tempfile.mkdtemp(prefix="adtally-ship-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            sc.addPyFile(package_zip(folder))
            sc._adtally_shipped = True


def package_zip(folder: str) -> str:
    """A ZIP of this package's modules in ``folder``, named after its content."""
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for here, dirs, files in sorted(os.walk(root)):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(here, name)
                    zf.write(full, os.path.join("adtally", os.path.relpath(full, root)))
    path = os.path.join(folder, f"adtally-{hashlib.sha1(buf.getvalue()).hexdigest()[:12]}.zip")
    with open(path, "wb") as out:
        out.write(buf.getvalue())
    return path
