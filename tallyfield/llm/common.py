"""Reading the given tables and cutting lineage with written tables."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import tallyfield
from tallyfield.session import scratch_dir


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, as --py-files does; once for each application."""
    context = spark.sparkContext
    name = "tallyfield-workers.zip"
    if name in context._python_includes:
        return
    root = Path(tallyfield.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / name
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """The same rows, written once to the shared folder and read again.

    Later stages then never run the plan above a second time, and a lost executor costs only
    the reading of its part.
    """
    path = scratch_dir(df.sparkSession)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def vocabulary_path(path: str | None, name: str) -> str:
    """A given path, or that of the installed public vocabulary; looked up where the task runs."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)
