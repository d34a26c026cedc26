"""Makes the package importable where Spark runs Python."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once a context."""
    context = spark.sparkContext
    if getattr(context, "_graphloom_shipped", False):
        return
    package = Path(__file__).parent
    sources = sorted(p for p in package.rglob("*.py"))
    name = hashlib.sha256(b"".join(p.read_bytes() for p in sources)).hexdigest()[:12]
    path = os.path.realpath(os.path.join(tempfile.mkdtemp(prefix="graphloom-"), f"graphloom-{name}.zip"))
    with zipfile.ZipFile(path, "w") as z:
        for p in sources:
            z.write(p, str(Path(package.name) / p.relative_to(package)))
    context.addPyFile(path)
    context._graphloom_shipped = True
