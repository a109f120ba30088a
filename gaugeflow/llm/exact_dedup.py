"""Exact deduplication against a persistent digest index, bucketed and sorted by digest.

Texts are equal when their SHA-256 is equal. The index holds a row for each known
digest, in a folder that names its number of buckets. A batch is reduced to a row for each
digest (a partial maximum before the shuffle, so a group of copies leaves each task as one
row), dealt into the index's own buckets, and joined to it by a sort-merge anti join: what
is stored is read where it lies, whatever the session's number of shuffle partitions is.
What is new is appended. Once appended rows amount to a share of the index, its buckets are
merged to one sorted file each, which later joins need not sort again; the amount written
by merges stays in proportion to what was added.

Defined results: null text is empty text, and empty texts are equal to each other. Of
equal texts the row with the largest ``doc_id`` stays, a null ``doc_id`` counting as
smallest; of repeated rows with that ``doc_id`` exactly one stays. Where an earlier batch
brought the text, none of the new rows stays. An empty table adds nothing. Other columns
stay as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeflow import files
from gaugeflow.llm import common
from gaugeflow.session import scratch_dir, settings

#: Appended rows are merged with the rest once they amount to this share of it.
MERGE_SHARE = 0.5
#: A digest is hot from this share of a batch's rows on; so there are at most as many hot ones.
HOT_SHARE = 1000


def digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(common.text_or_empty(text), 256))


def in_place(spark: SparkSession):
    """Settings under which a join reads the index's buckets as they lie.

    Merged buckets are read in order, so they need no sort; and the join stays above the
    exchange that deals the batch into the buckets.
    """
    rule = "org.apache.spark.sql.catalyst.optimizer.PushDownLeftSemiAntiJoin"
    excluded = filter(None, [spark.conf.get("spark.sql.optimizer.excludedRules", None), rule])
    return settings(
        spark, spark__sql__legacy__bucketedTableScan__outputOrdering="true",
        spark__sql__optimizer__excludedRules=",".join(excluded),
    )


class DigestIndex:
    """Digests of all texts seen so far, in a folder that outlives the session.

    ``buckets`` of a new index are the session's shuffle partitions, 32 at least; an
    existing one keeps those it has. Below ``buckets=<n>`` stand merged states of the index,
    ``gen=<k>``, of which the newest complete one counts.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        known = files.matching(spark, f"{self.path}/buckets=*")
        if known:
            self.buckets = int(known[0].rpartition("=")[2])
        else:
            self.buckets = buckets or max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.root = f"{self.path}/buckets={self.buckets}"
        self.generation = max(files.complete_folders(spark, self.root, "gen"), default=0)
        self._define(self.name)

    @property
    def folder(self) -> str:
        return f"{self.root}/gen={self.generation}"

    @property
    def name(self) -> str:
        return "gaugeflow_digests_" + hashlib.md5(self.folder.encode()).hexdigest()

    def _define(self, name: str) -> None:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT, "
            "keep_row BIGINT, group_size BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.folder}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def not_known(self, marks: DataFrame) -> DataFrame:
        """A row for each digest of ``marks`` (doc_id, digest, row_no) that is not stored."""
        groups = marks.groupBy("digest").agg(
            F.max(F.struct("doc_id", "row_no")).alias("keep"),
            F.count(F.lit(1)).alias("group_size"),
        )
        # Few rows are broadcast by Spark's own size check; else no side but this one moves.
        return groups.repartition(self.buckets, "digest").join(self.table(), "digest", "left_anti")

    def append_new(self, marks: DataFrame, batch: str) -> None:
        """Add the digests of ``marks`` (doc_id, digest, row_no) that are not known yet."""
        with in_place(self.spark):
            self.not_known(marks).select(
                "digest", F.col("keep.doc_id").alias("keep_id"),
                F.col("keep.row_no").alias("keep_row"), "group_size", F.lit(batch).alias("batch"),
            ).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def merge(self, share: float = MERGE_SHARE) -> bool:
        """Merge each bucket's files, if all but the largest hold ``share`` of it."""
        sizes: dict[str, list[int]] = {}
        for path, size in files.sizes(self.spark, f"{self.folder}/*.parquet").items():
            sizes.setdefault(path.rpartition("_")[2], []).append(size)
        added = sum(sum(s) - max(s) for s in sizes.values())
        if not added or added < share * sum(max(s) for s in sizes.values()):
            return False
        rows = self.table()
        self.generation += 1
        files.delete(self.spark, self.folder)  # what a merge that failed has left
        self._define(self.name)
        # A task reads one bucket, so it writes one file of it, and nothing is exchanged.
        with settings(self.spark, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
            rows.write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        return True

    def vacuum(self) -> None:
        """Delete merged states that are no longer read."""
        for n in files.complete_folders(self.spark, self.root, "gen"):
            if n < self.generation:
                files.delete(self.spark, f"{self.root}/gen={n}")

    def mark(self, docs: DataFrame) -> DataFrame:
        """Append a batch; say for each row which one stays.

        Returns doc_id, keep_id, group_size, kept, digest. The digests are written first,
        so the texts are read once and row numbers stay what they were.
        """
        batch = uuid.uuid4().hex
        marks = common.written(
            docs.select(
                common.doc_id(), digest().alias("digest"),
                F.monotonically_increasing_id().alias("row_no"),
            ),
            "digests",
        )
        self.append_new(marks, batch)
        self.merge()
        index = self.table()
        total = marks.count()
        # At most HOT_SHARE digests have that share of the rows, which bounds the broadcast.
        hot = index.filter(F.col("group_size") * HOT_SHARE >= F.lit(total))
        hot = hot.filter(F.col("batch") == batch).select(
            F.col("digest").alias("hot_digest"), F.struct("*").alias("hot")
        )
        tagged = marks.join(F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left")
        # Hot rows have their answer; a key that matches nothing spreads them over the tasks.
        spread = F.unhex(F.md5(F.col("row_no").cast("string")))
        found = tagged.withColumn(
            "key", F.when(F.col("hot").isNull(), F.col("digest")).otherwise(spread)
        ).repartition(self.buckets, "key").join(
            index.select(F.col("digest").alias("key"), F.struct("*").alias("cold")), "key", "left"
        )
        known = F.coalesce("hot", "cold")
        return found.select(
            "doc_id",
            known["keep_id"].alias("keep_id"),
            known["group_size"].alias("group_size"),
            ((known["batch"] == batch) & (known["keep_row"] == F.col("row_no"))).alias("kept"),
            "digest",
        )


def new_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index in the shared scratch folder."""
    return DigestIndex(spark, scratch_dir(spark, "digest-index"), buckets)


def keep_first_seen(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = index.mark(docs).filter("kept").select(F.col("digest").alias("kept_digest"))
    rows = docs.select(
        F.struct("*").alias("row"), digest().alias("digest"), common.doc_id().alias("id")
    )
    # The largest id of each digest, one row of it; Spark keeps one in each task before the
    # shuffle, and the join finds the rows where the window has put them.
    largest = Window.partitionBy("digest").orderBy(F.desc_nulls_last("id"))
    return (
        rows.withColumn("place", F.row_number().over(largest)).filter("place = 1")
        .join(kept, F.col("digest") == F.col("kept_digest"), "left_semi")
        .select("row.*")
    )


