"""Python code for executors."""

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Let executors import this package, whatever their PYTHONPATH."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.abspath(__file__))
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as archive:
            for folder, _, names in os.walk(root):
                for name in (n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
        # A file of the driver, which Spark hands to the executors.
        path = os.path.join(tempfile.mkdtemp(prefix="tremor-"), "tremor.zip")
        with open(path, "wb") as out:
            out.write(packed.getvalue())
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark
