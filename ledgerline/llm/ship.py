"""Send this library to the executors of a session that was not started with ``--py-files``."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import SparkSession

from ledgerline.session import checkpoint_dir

TEXTS_PER_BATCH = 1000          # whole texts in one Arrow batch; the default of 10,000 is hundreds of MB
_SENT: set[str] = set()


def _zipped(package: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in sorted(os.walk(package)):
            if "__init__.py" not in names:      # a zip has no folders without one
                z.writestr(os.path.join("ledgerline", os.path.relpath(folder, package), "__init__.py"), "")
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("ledgerline", os.path.relpath(full, package)))
    return out.getvalue()


def ship(spark: SparkSession) -> None:
    """Add the package, as a zip in the shared checkpoint folder, to the session's Python files.

    Once for each application. Also bounds the rows of an Arrow batch, as texts are long.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_PER_BATCH)
    sc = spark.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if sc.applicationId in _SENT or not os.path.isdir(package):      # sent, or running from a zip that Spark sent
        return
    path = f"{checkpoint_dir(spark).rstrip('/')}/{sc.applicationId}/ledgerline.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(_zipped(package)))
    finally:
        out.close()
    sc.addPyFile(path)
    _SENT.add(sc.applicationId)
