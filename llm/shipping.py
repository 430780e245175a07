"""Make the package importable in Python workers, and the checkpoint folder known."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

from punctual.session import ensure_checkpoints

_ARCHIVE = "llm_operators.zip"


def ready(spark: SparkSession) -> SparkSession:
    """Send this package's sources to the executors once per application."""

    context = spark.sparkContext
    ensure_checkpoints(spark)
    if _ARCHIVE not in context._python_includes:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="llm-"), _ARCHIVE)
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for package in ("llm", "punctual"):
                for folder, _, names in os.walk(os.path.join(root, package)):
                    for name in names:
                        if name.endswith(".py"):
                            full = os.path.join(folder, name)
                            archive.write(full, os.path.relpath(full, root))
        context.addPyFile(path)
    return spark
