"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.session import configure

# Texts and pages vary from a few bytes to hundreds of kilobytes, so Arrow
# batches are kept short: a Python worker holds a few MB of text at a time.
ARROW_ROWS = 256


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``d``, with the session configured
    for the library and for short Arrow batches."""
    configure(spark)
    ship_package(spark)
    short_batches(spark)
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give Python workers the package, once per application, unless their
    ``PYTHONPATH`` (inherited or set by ``--py-files``) has it already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    if sc.applicationId in _shipped or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _shipped.add(sc.applicationId)
    if os.path.isdir(root):                             # else it came in an archive, which --py-files has sent
        d = tempfile.mkdtemp()                          # the driver serves the archive from here
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        sc.addPyFile(shutil.make_archive(os.path.join(d, "lakemart_package"), "zip", root, "lakemart"))


def short_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def whole_text(name: str) -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))
