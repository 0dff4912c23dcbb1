"""What the operators of this package share: reading, staging, column clean-up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.session import checkpoint_dir

#: Arrow batches handed to Python stay under this many bytes, however long single texts are.
ARROW_BATCH_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided tables, read whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage like ``checkpoint()``, but leaves compressed, columnar files: a lost
    executor costs a re-read, and later readers fetch only the columns they use.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table from which everything needed has been staged anew."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded_batches(spark: SparkSession) -> None:
    """Let Spark cut Arrow batches by bytes as well as by rows, so long texts can't pile up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))


def id_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the whole text; a null text becomes the empty text."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )


def crc_fold(doc_id: str, folds: int = 5) -> F.Column:
    """crc32 of the id's decimal text, modulo ``folds``: the fold that splits training from held-out rows."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def struct_type(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])
