"""Arrow functions on the executors, with this library's code at hand there."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import catalens
from catalens.staging import shared_folder

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: a zip in the shared folder, added as a Python file.

    A package that was loaded from an archive came that way itself.
    """
    root, app = Path(catalens.__file__).parent, spark.sparkContext.applicationId
    if app in _shipped or not root.is_dir():
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    path = f"{shared_folder(spark)}/catalens-code/{uuid.uuid4().hex}/catalens-code.zip"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    out.write(packed.getvalue())
    out.close()
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` whose function may use this package."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
