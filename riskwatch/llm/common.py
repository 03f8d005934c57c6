"""Reading tables, staging shared intermediates, and small column helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# By application: a folder of a local session that names none, and what was staged.
_own_folder: dict[str, str] = {}
_staged: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named in ``spark.checkpoint.dir``.

    Only a session without other machines may do without, as in tests; it gets a
    scratch folder, and the session's settings stay as they are.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folder:
        _own_folder[application] = tempfile.mkdtemp(prefix="llm-shared-")
    return _own_folder[application]


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def new_table(spark: SparkSession, path: str, name: str) -> str:
    """A catalogue name for a table kept at ``path``; ``drop_staged`` drops it."""
    table = f"{name}_{path[-32:]}"
    _tables.setdefault(spark.sparkContext.applicationId, []).append(table)
    return table


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and gives back the table.

    Later uses read the files, so a lost executor costs a re-read of a part and
    Spark knows the table's size. ``drop_staged`` removes the files again.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Removes what this session's operators wrote to the shared folder; call it
    when their results are written elsewhere."""
    for table in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python this package, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as files:
        for source in sorted(package.rglob("*.py")):
            files.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; text of one byte a character takes the fast way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
