"""Sessions, and how the package reaches the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their Python can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="inkwell-")) / "inkwell.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))  # Spark serves it to executors that share no folder
    _shipped.add(app)


def session(cpus: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session as tests and benchmarks use it."""
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", memory)
    spark = builder.config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
