"""Getting the package to Python workers that don't have it on their path."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers of this application once, unless PYTHONPATH has it."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parent.parent
    if sc.applicationId in _done or any(p and Path(p).resolve() == root for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)):
        return
    target = Path(tempfile.mkdtemp(prefix="strandline-")) / "strandline.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted((root / "strandline").rglob("*.py")):
            z.write(p, p.relative_to(root))
    sc.addPyFile(str(target))
    _done.add(sc.applicationId)
