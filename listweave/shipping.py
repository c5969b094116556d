"""Send this package to the executors, so that Python functions find it wherever they run."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the application once; Spark serves them to every executor."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="listweave-code-")) / "listweave_code.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*")):
            if path.suffix in {".py", ".json"}:
                z.write(path, Path(root.name) / path.relative_to(root))
    spark.sparkContext.addPyFile(str(target))
    _SENT.add(app)
