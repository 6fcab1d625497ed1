"""Reading corpora, intermediate tables in the shared folder, and dropping rows from a corpus."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlake.operators.staging import staging_root

#: Separators of words and runs of white space, in Java's and DuckDB's notation alike.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def text_of(docs: DataFrame, column: str = "text") -> Column:
    return F.coalesce(docs[column], F.lit(""))


def row_key(docs: DataFrame) -> list[Column]:
    """doc_id and a hash of the text (text_key): rows with equal keys are copies of one row."""
    return [docs["doc_id"].alias("doc_id"), F.xxhash64(text_of(docs)).alias("text_key")]


class Scratch:
    """Intermediate tables of one run, in the folder that all executors share.

    Written tables cut the lineage: a lost executor costs its running tasks only. ``drop`` frees a
    table that no later plan reads; the rest goes when the application ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"
        self._at(self.root)[0].deleteOnExit(self._at(self.root)[1])

    def _at(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), place

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.read(name, df.schema)

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            files, place = self._at(self.path(name))
            files.delete(place, True)


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


def keep_rows(docs: DataFrame, verdicts: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of docs that verdicts (doc_id, text_key, kept; a row for each row) keep.

    Only the dropped keys are joined to the texts. Of repeated rows (equal doc_id and text) of
    which one is kept, one stays.
    """
    keys = scratch.put(
        verdicts.groupBy("doc_id", "text_key")
        .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows"))
        .where("not kept or rows > 1"),
        "changed-rows",
    )
    packed = docs.select(*row_key(docs), F.struct("*").alias("row"))
    left = packed.join(keys, same_row(packed, keys), "left_anti").select("row.*")
    repeated = keys.where("kept")
    if repeated.isEmpty():
        return left
    once = packed.join(repeated, same_row(packed, repeated), "left_semi")
    once = once.dropDuplicates(["doc_id", "text_key"]).select("row.*")
    return left.unionByName(once)


def limit_batches(spark: SparkSession, rows: int) -> None:
    """From now on the session hands Python workers at most so many rows at once; a smaller limit of its own stays.

    An executor and its worker both hold a whole batch, each in its own memory. Results do not depend on it.
    """
    now = int(spark.conf.get(BATCH_ROWS))
    if not 0 < now <= rows:  # none or less stands for no limit
        spark.conf.set(BATCH_ROWS, rows)


Query = Callable[[SparkSession, str], DataFrame]
