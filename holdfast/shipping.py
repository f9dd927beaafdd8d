"""Making this package importable in Python workers.

Code that runs in tasks refers to functions of this package. A job submitted with the
package among its Python files needs nothing more; this covers every other way of starting.
"""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to all workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    base = os.path.join(tempfile.mkdtemp(prefix="holdfast-"), "holdfast")
    root, name = os.path.split(_PACKAGE)
    context.addPyFile(shutil.make_archive(base, "zip", root, name))
    _shipped.add(context.applicationId)
