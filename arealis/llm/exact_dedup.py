"""Exact deduplication through streaming state.

A stream of digests runs through a stateful aggregation whose keys live in RocksDB
in the shared folder and never expire. Each key retains, for its digest, the stable
identifier and the content locator (file and row) of the row that stays, and the
number of rows. Rows of one digest are combined inside each task before the shuffle,
so a text that a third of all rows share costs one row per task. Afterwards the full
bytes of every hit are compared; digests whose texts differ are grouped again by text.

Defined cases: a null text counts as empty; empty texts form one group; a null
identifier sorts last; of equal texts with equal lengths and identifiers the first by
file and row stays; repeated rows are separate members of their group; extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import documents, scratch_path, stored

LEDGER = "digest binary, size long, id long, file string, row long"


def normalised(text: Column) -> Column:
    """The text without the six ASCII white space characters, in bytes."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "").cast("binary")


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def located(docs: DataFrame) -> DataFrame:
    """``docs`` as a frame whose rows have a file and a row number: a plain file scan
    as it is, anything else written once to the shared folder."""
    try:
        docs.select(docs.metadataColumn("_metadata").getField("row_index"))
        return docs
    except Exception as error:  # the analyser's ways to say that there is no such column
        if not any(word in str(error) for word in ("_metadata", "METADATA", "row_index")):
            raise
        return stored(docs, "content")


def _rank(prefix: str = "") -> Column:
    """The largest of a group is the row that stays."""
    at = lambda name: F.col(prefix + name)
    return F.struct(
        at("size").alias("size"),
        (-F.coalesce(at("id"), F.lit(2**63 - 1))).alias("down"),
        at("id").alias("id"),
        at("file").alias("file"),
        at("row").alias("row"),
    )


def retained(spark, ledger: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream the ledger table at path ``ledger`` through keyed state and read the
    state back: digest, best (size, id, file, row), members."""
    checkpoint = scratch_path(spark, "state")
    session = spark.newSession()
    for name, value in (
        ("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")),
        ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"),
        ("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"),
        ("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true"),
        ("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "200"),
        # many small stores: no disk set aside for each, no count of rows kept
        ("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false"),
        ("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false"),
    ):
        session.conf.set(name, value)
    arrived = session.readStream.schema(LEDGER).option("maxFilesPerTrigger", files_per_batch).parquet(ledger)
    state = arrived.groupBy("digest").agg(F.max(_rank()).alias("best"), F.count("*").alias("members"))
    run = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    found = spark.read.format("statestore").load(checkpoint)
    best, members = (F.col("value").getField(field.name) for field in found.schema["value"].dataType.fields)
    return found.select(F.col("key").getField("digest").alias("digest"), best.alias("best"), members.alias("members"))


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", digest=sha256, files_per_batch: int = 1000) -> tuple[DataFrame, DataFrame]:
    """The decisions (file, row, id, digest, keep_id, keep_file, keep_row, group_size,
    kept) for every row of ``docs``, and the located frame that file and row refer to.

    ``digest`` maps the normalised bytes to a binary key; any function does, as full
    bytes decide."""
    spark = docs.sparkSession
    docs = located(docs)
    meta = docs.metadataColumn("_metadata")
    content = docs.select(
        normalised(docs[text]).alias("content"),
        F.length(F.coalesce(docs[text], F.lit(""))).cast("long").alias("size"),
        docs[key].cast("long").alias("id"),
        meta.getField("file_path").alias("file"),
        meta.getField("row_index").alias("row"),
    ).withColumn("digest", digest(F.col("content")))
    ledger = scratch_path(spark, "ledger")
    content.select("digest", "size", "id", "file", "row").write.parquet(ledger)
    rows = spark.read.schema(LEDGER).parquet(ledger)
    kept = stored(retained(spark, ledger, files_per_batch), "kept")

    # full bytes of every hit: one text per digest and task goes on, and the least, the
    # greatest and the one at the retained locator must be the same
    hits = kept.where("members > 1").select("digest", F.col("best.file").alias("at_file"), F.col("best.row").alias("at_row"))
    met = content.select("digest", "content", "file", "row").join(hits, "digest")
    met = met.groupBy("digest").agg(
        F.min("content").alias("low"),
        F.max("content").alias("high"),
        F.max(F.when((F.col("file") == F.col("at_file")) & (F.col("row") == F.col("at_row")), F.col("content"))).alias("held"),
    )
    differ = stored(met.where("low <> high or held is null or held <> low").select("digest"), "differ")

    decided = rows.join(kept, "digest").select("file", "row", "id", "digest", "best", "members")
    if not differ.isEmpty():
        again = content.join(F.broadcast(differ) if differ.count() <= 10_000 else differ, "digest")
        best = again.groupBy("digest", "content").agg(F.max(_rank()).alias("best"), F.count("*").alias("members"))
        split = again.join(best, ["digest", "content"]).select("file", "row", "id", "digest", "best", "members")
        decided = decided.join(differ, "digest", "left_anti").unionByName(split)
    decided = decided.select(
        "file",
        "row",
        "id",
        "digest",
        F.col("best.id").alias("keep_id"),
        F.col("best.file").alias("keep_file"),
        F.col("best.row").alias("keep_row"),
        F.col("members").cast("long").alias("group_size"),
        ((F.col("best.file") == F.col("file")) & (F.col("best.row") == F.col("row"))).alias("kept"),
    )
    return decided, docs


def unique(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, in their own columns."""
    decided, docs = deduplicate(docs, text, key)
    meta = docs.metadataColumn("_metadata")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("whole"), meta.getField("file_path").alias("file"), meta.getField("row_index").alias("row"))
    return rows.join(decided.where("kept").select("file", "row"), ["file", "row"], "left_semi").select("whole.*")


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    decided, _ = deduplicate(documents(spark, sf_dir))
    return decided.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE = r"""
WITH n AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS c FROM documents),
w AS (SELECT *, first_value(doc_id) OVER (PARTITION BY c ORDER BY length(t) DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY c) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(c) AS text_sha256 FROM w
"""
