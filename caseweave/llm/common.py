"""Shared helpers: scratch tables, batches for Python tasks, word splitting."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

import caseweave

# Rows, and bytes, that a Python task receives at once. Texts are whole, so a batch holds
# at most this many bytes or one text.
BATCH_ROWS = 256
BATCH_BYTES = 16 << 20

# The white space that separates words.
WHITE_SPACE = "\t\n\x0b\x0c\r "
WHITE_SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

Columns = dict[str, Sequence[Any]]


_SENT: set[str] = set()


def _send_package(spark: SparkSession) -> None:
    """Give the executors this package, as --py-files does, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SENT:
        _SENT.add(app)
        package = Path(caseweave.__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="caseweave-")
        packed = shutil.make_archive(f"{folder}/caseweave", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(packed)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that keep Python batches short and let AQE split full keys of joins.

    They stay set: results are lazy, and the settings count when they are computed.
    Tighter bounds of the session are left as they are.
    """
    _send_package(spark)
    conf = spark.conf
    held = conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    if not held.rstrip("b").isdigit() or int(held.rstrip("b")) > BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Only a local master, whose executors are this
    process, may do without: it gets a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="caseweave-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/caseweave-llm"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the tables that operators of this application wrote on their way.

    To be called once their results are stored: results are lazy and read them.
    """
    folder = f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder of its own for each call, so that reruns never meet."""
    app = spark.sparkContext.applicationId
    return f"{scratch_dir(spark)}/{app}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write once to the shared folder and read back: cuts the lineage, survives lost executors.

    ``narrow`` is for tables of a few numbers per row: each core writes one file, which
    takes its share of the partitions one after the other, instead of a file for each.
    """
    path = scratch_path(df.sparkSession, name)
    if narrow:
        df = df.coalesce(df.sparkSession.sparkContext.defaultParallelism)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id, the whole text with NULL as empty, and the named columns; others are dropped."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *columns)


def map_columns(
    df: DataFrame, start: Callable[[], Callable[[Columns], Columns]], schema: str
) -> DataFrame:
    """Apply a function of column lists to every batch of rows.

    `start` is called once per task and returns that function. Lists hold Python
    values, with None for NULL, so that 64-bit ids stay exact.
    """
    prepare(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            found = function({c: batch.column(c).to_pylist() for c in batch.schema.names})
            yield pa.RecordBatch.from_pydict(found, schema=target)

    return df.mapInArrow(run, schema)


def filter_texts(df: DataFrame, start: Callable[[], Callable[[str], bool]]) -> DataFrame:
    """The rows, with all columns as they are, whose text (NULL as empty) passes."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = start()
        for batch in batches:
            mask = [passes(text or "") for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def n_words(text: Column) -> Column:
    """Number of words between white space; NULL counts none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
