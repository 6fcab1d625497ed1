"""Exact deduplication as a stream with keyed state on disk.

Row digests stream through an aggregation whose state (RocksDB, no watermark, so no expiry) holds
for each digest how many rows had it, the smallest identifier, and where the content of that row
lies. Spark combines a batch's rows per digest before it shuffles them, so a text with very many
copies reaches the state as one row for each task. Hits, the rows of digests seen more than once,
are checked on their full bytes before they count as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlake.llm.tables import SPACES, Scratch, keep_rows, row_key, text_of

STATE = "spark.sql.streaming.stateStore"
#: State in RocksDB on disk. Small stores take no space ahead, and a batch saves what it has changed.
#: The stores of an executor share one bounded memory, however many partitions it has. Renaming by the
#: file system, and no checksum files beside its own, save about 20 processes a store and batch: where Hadoop
#: has no native library, it starts one for each file made or link looked for.
STATE_SETTINGS = {
    f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STATE}.rocksdb.allowFAllocate": "false",
    f"{STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{STATE}.rocksdb.maxMemoryUsageMB": "64",
    f"{STATE}.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.checkpointFileManagerClass": "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager",
    "spark.sql.streaming.checkpoint.fileChecksum.enabled": "false",
}
DIGEST_BYTES = 32
FILES_PER_BATCH = 4096


def normalised(text: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text, SPACES, " ")


def first_row() -> Column:
    """The row with the smallest doc_id, nulls last, with its place."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id", "text_key"))


def exact_duplicates(docs: DataFrame, digest_bytes: int = DIGEST_BYTES, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """For each row of docs: doc_id, text_key, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and empty texts are equal to each other. keep_id is the smallest
    doc_id among the equal texts, null ids last. Exactly one row of a group is kept, also when rows
    repeat. Other columns of docs are not read. An empty table gives no rows. digest_bytes shortens
    the digest that keys the state; results do not depend on it.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    sha = F.unhex(F.sha2(normalised(text_of(docs)), 256))
    rows = scratch.put(
        docs.select(*row_key(docs), sha.alias("sha")).select(
            "*",
            F.substring("sha", 1, digest_bytes).alias("digest"),
            F.monotonically_increasing_id().alias("row_id"),
        ),
        "rows",
    )
    # stored, so that Spark can split the rows of a very frequent digest where they are joined
    groups = scratch.put(_stream_groups(scratch, rows, files_per_batch), "groups")
    repeated = groups.where("group_size > 1")
    hits = rows.join(repeated.select("digest"), "digest", "left_semi")
    texts = _texts(docs, hits)
    bad = scratch.put(
        texts.groupBy("digest", "content").agg(F.count(F.lit(1)).alias("n")).groupBy("digest").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("digest"),
        "colliding",
    )
    joined = rows.join(groups, "digest")
    if not bad.isEmpty():
        joined = joined.join(bad, "digest", "left_anti").unionByName(_by_content(docs, rows.join(bad, "digest", "left_semi")))
    return joined.select(
        "doc_id",
        "text_key",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("first.row_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _stream_groups(scratch: Scratch, rows: DataFrame, files_per_batch: int) -> DataFrame:
    """digest, group_size and first row of each digest, from the last state of the stream."""
    spark = scratch.spark
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_per_batch).parquet(scratch.path("rows"))
    state = stream.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), first_row().alias("first"))
    scratch.put(rows.limit(0).groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), first_row().alias("first")), "updates/empty")

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(scratch.path(f"updates/batch-{number}"))

    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        query = (
            state.writeStream.outputMode("update")
            .foreachBatch(save)
            .option("checkpointLocation", scratch.path("state"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
    scratch.drop("state")
    updates = spark.read.schema(state.schema).parquet(scratch.path("updates/*"))
    # group sizes only grow, so a digest's largest update is its last
    last = updates.groupBy("digest").agg(F.max(F.struct("group_size", "first")).alias("last"))
    return last.select("digest", "last.group_size", "last.first")


def _texts(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """digest and whole normalised text of the rows in hits, looked up by identifier and text hash."""
    named = docs.select(*row_key(docs), text_of(docs).alias("content"))
    found = hits.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "digest").distinct()
    same = named["doc_id"].eqNullSafe(found["hit_id"]) & (named["text_key"] == found["hit_key"])
    return named.join(found, same).select("doc_id", "text_key", "digest", normalised(F.col("content")).alias("content"))


def _by_content(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Groups of rows whose digest has several contents, keyed by digest and content."""
    texts = _texts(docs, rows).distinct().withColumnsRenamed({"doc_id": "text_id", "text_key": "its_key", "digest": "its_digest"})
    same = rows["doc_id"].eqNullSafe(texts["text_id"]) & (rows["text_key"] == texts["its_key"]) & (rows["digest"] == texts["its_digest"])
    full = rows.join(texts, same).select(rows["*"], "content")
    groups = full.groupBy("digest", "content").agg(F.count(F.lit(1)).alias("group_size"), first_row().alias("first"))
    return full.join(groups, ["digest", "content"]).drop("content")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, all columns."""
    return keep_rows(docs, exact_duplicates(docs), Scratch(docs.sparkSession, "exact-kept"))
