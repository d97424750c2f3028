"""Python workers import this package; a session started elsewhere has to send it to them."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

import granero


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for each Spark context, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_granero_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(granero.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="granero-"), "granero.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("granero", os.path.relpath(full, root)))
    context.addPyFile(path)
    context._granero_shipped = True


def shipped(build: Callable[..., Any]) -> Callable[..., Any]:
    """Ship before a function whose first argument is the session."""

    @functools.wraps(build)
    def run(spark: SparkSession, *rest: Any) -> Any:
        ship(spark)
        return build(spark, *rest)

    return run
