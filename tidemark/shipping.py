"""The package on the executors: sent along as a zip file, so that Python workers can import it wherever they run."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each application. Call before an operator that runs Python there."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as bundle:
        for folder, _, names in os.walk(home):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    bundle.write(full, os.path.join("tidemark", os.path.relpath(full, home)))
    context.addPyFile(path)  # served by the driver; the local file is only its source
    context._tidemark_shipped = True
