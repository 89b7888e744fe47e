"""The package itself for the executors' Python, wherever the driver has it from."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to all executors, once for each application; a package that isn't a folder has been sent already."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parent
    if sc.applicationId in _SHIPPED or not root.is_dir():
        return
    target = Path(tempfile.mkdtemp(prefix="voxloom-")) / "voxloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, Path(root.name) / path.relative_to(root))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)
