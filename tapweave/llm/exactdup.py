"""Exact deduplication as a stateful stream.

The corpus is read as a stream of files, and each text once: a first stream
lands one small row per document, with its stable identifier, its content
locator (file and row), its size and the SHA-256 digest of its normalised text.
A second, stateful stream runs over these rows. Its state, kept on the
executors' disks (RocksDB) without expiry and saved in the shared folder with
every batch, holds one row per distinct content: the digest, the identifier and
the locator of the member that stays so far, and the number of members. Each
task combines its rows before they are shuffled, so a text that a third of all
rows share is a handful of rows at the state. A digest that was hit more than
once is checked on the full bytes: the least and the greatest normalised text of
its members must be the same string, again combined in each task first. Members
of a digest that fails the check are told apart by their whole texts.

A caller's ``home`` folder keeps digests, state and checkpoints, so that a later
run, in another session too, goes on where the last one ended.

Texts are equal when identical after deleting blanks, tabs and line ends
(U+0020, U+0009 to U+000D). The member with most code points stays, then the
smallest id (null ids last), then the first by file and row.

Defined results: null texts count as empty and are all equal; repeated rows are
members like others, one stays; an empty table gives no rows; other columns are
passed through by ``keep_first`` under their names, whatever those are.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapweave.functions.stage import Stages
from tapweave.llm.common import likely, text_or_empty

# Files taken into one batch of the stream.
FILES_PER_BATCH = 1000

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # no disk ahead of need, there are many stores
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _texts(spark: SparkSession, path: str) -> DataFrame:
    """The rows at ``path`` with their content locator ``__at``."""
    return _with_locator(spark.read.parquet(path).select("*", "_metadata")).drop("_metadata")


def _with_locator(df: DataFrame) -> DataFrame:
    return df.withColumn("__at", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")))


def _with_digest(df: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({"__n": F.length(text_or_empty()), "__digest": digest(normalised(text_or_empty()))})


def _order(key: str) -> Column:
    """What sorts first stays."""
    return F.struct((-F.col("__n")).alias("n"), F.col(key).isNull().alias("no_id"), F.col(key).alias("id"), F.col("__at").alias("at"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _run(rows: DataFrame, mode: str, folder: str, saved: str) -> None:
    """Run a stream over all that is there; each batch is a folder below ``folder``.

    A query that failed goes on from its checkpoint when called with the same
    folders; a batch that ran twice overwrites what it wrote.
    """

    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/batch={batch}")

    with _settings(rows.sparkSession, _STATE_CONF):
        query = rows.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", saved).trigger(availableNow=True)
        query.start().awaitTermination()


def _folder(stages: Stages, home: str | None, name: str) -> str:
    """A folder of the run, or one that lives on in ``home``."""
    return stages.path(name) if home is None else f"{home.rstrip('/')}/{name}"


def stream_digests(
    spark: SparkSession, path: str, stages: Stages, key: str = "doc_id",
    digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH, home: str | None = None,
) -> tuple[str, str]:
    """Land the key, ``__at``, ``__n`` and ``__digest`` of every row at ``path``: their folder and schema.

    With ``home``, files that an earlier call with it has landed are not read again.
    """
    schema = spark.read.parquet(path).schema
    # a pattern, so that a table may also be a single file
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path[:-1] + f"[{path[-1]}]")
    rows = _with_digest(_with_locator(source.select(key, "text", "_metadata")), digest).select(key, "__at", "__n", "__digest")
    folder = _folder(stages, home, "digests")
    _run(rows, "append", folder, _folder(stages, home, "landing"))
    return f"{folder}/*", _ddl(rows)


def state_of(
    spark: SparkSession, landed: tuple[str, str], stages: Stages, key: str = "doc_id",
    files_per_batch: int = FILES_PER_BATCH, home: str | None = None,
) -> DataFrame:
    """Run the stateful stream over landed digests and return its state: __digest, first (who stays), members.

    With ``home``, the state that an earlier call has saved there goes on: only new rows are read, and they meet all earlier ones.
    """
    path, schema = landed
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    states = rows.groupBy("__digest").agg(F.min(_order(key)).alias("first"), F.count(F.lit(1)).alias("members"))
    folder = _folder(stages, home, "states")
    _run(states, "update", folder, _folder(stages, home, "stream"))
    changes = spark.read.schema(f"batch long, {_ddl(states)}").option("basePath", folder).parquet(f"{folder}/*")
    last = changes.groupBy("__digest").agg(F.max(F.struct("batch", "members", "first")).alias("s"))
    return last.select("__digest", "s.first", "s.members")


def stream_state(
    spark: SparkSession, path: str, stages: Stages, key: str = "doc_id",
    digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH, home: str | None = None,
) -> DataFrame:
    """Run both streams over all files at ``path`` and return the state."""
    landed = stream_digests(spark, path, stages, key, digest, files_per_batch, home)
    return state_of(spark, landed, stages, key, files_per_batch, home)


def duplicates(
    spark: SparkSession, path: str, stages: Stages, key: str = "doc_id",
    digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH, home: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The landed digests of the rows at ``path``, and the written table of groups with several members.

    A group has ``__digest``, ``__body`` (null, or the whole normalised text if
    its digest stands for different texts), ``first`` and ``members``. Texts are
    read again only for the rows of such groups.
    """
    landed = stream_digests(spark, path, stages, key, digest, files_per_batch, home)
    told = spark.read.schema(landed[1]).parquet(landed[0])
    hits = stages.write(state_of(spark, landed, stages, key, files_per_batch, home).where("members > 1"), "hits")
    body = normalised(text_or_empty())
    places = likely(told, hits, "__digest").join(hits, "__digest", "left_semi")
    members = likely(_texts(spark, path).select("text", "__at"), places, "__at").withColumn("__body", body)
    checked = members.withColumn("__digest", digest(F.col("__body"))).groupBy("__digest")
    checked = checked.agg(F.min("__body").alias("least"), F.max("__body").alias("most"))
    differ = stages.write(
        checked.where("least <> most").select("__digest").join(hits, "__digest", "left_semi"), "collisions"
    )
    groups = hits.withColumn("__body", F.lit(None).cast("string"))
    if not differ.isEmpty():
        apart = (
            _with_digest(_texts(spark, path).select(key, "text", "__at"), digest)
            .join(differ, "__digest", "left_semi").withColumn("__body", body)
            .groupBy("__digest", "__body").agg(F.min(_order(key)).alias("first"), F.count(F.lit(1)).alias("members"))
        )
        groups = groups.join(differ, "__digest", "left_anti").unionByName(apart)
        groups = stages.write(groups, "groups")
    return told, groups


def judged(
    spark: SparkSession, path: str, stages: Stages, key: str = "doc_id",
    digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH, home: str | None = None,
) -> DataFrame:
    """``__at``, the key, keep_id, group_size, kept and text_digest of every row at ``path``.

    Rows whose digest was seen once pass without a shuffle.
    """
    told, groups = duplicates(spark, path, stages, key, digest, files_per_batch, home)

    def told_by(df: DataFrame, keep_id: Column, size: Column, kept: Column) -> DataFrame:
        return df.select(
            "__at", key, keep_id.alias("keep_id"), size.cast("long").alias("group_size"), kept.alias("kept"),
            F.col("__digest").alias("text_digest"),
        )

    def joined(df: DataFrame) -> DataFrame:
        single = F.col("members").isNull()
        keep_id = F.when(single, F.col(key)).otherwise(F.col("first.id"))
        return told_by(df, keep_id, F.coalesce("members", F.lit(1)), single | (F.col("first.at") == F.col("__at")))

    alone = told_by(likely(told, groups, "__digest", "left_anti"), F.col(key), F.lit(1), F.lit(True))
    some = likely(told, groups, "__digest")
    collided = groups.where(F.col("__body").isNotNull())
    plain = groups.where(F.col("__body").isNull()).drop("__body")
    if collided.isEmpty():
        return alone.unionByName(joined(some.join(plain, "__digest", "left")))
    names = collided.select("__digest").distinct()
    rest = some.join(names, "__digest", "left_anti")
    apart = _with_digest(_texts(spark, path).select(key, "text", "__at"), digest).join(names, "__digest", "left_semi")
    apart = apart.withColumn("__body", normalised(text_or_empty())).join(collided, ["__digest", "__body"], "left")
    return alone.unionByName(joined(rest.join(plain, "__digest", "left"))).unionByName(joined(apart))


def mark(
    spark: SparkSession, path: str, stages: Stages, key: str = "doc_id",
    digest: Callable[[Column], Column] = sha256, files_per_batch: int = FILES_PER_BATCH, home: str | None = None,
) -> DataFrame:
    """One row for each row at ``path``: its key, keep_id, group_size, kept and text_digest.

    ``home`` is a shared folder that keeps the state from call to call. Files that
    were added to ``path`` since the last call meet the saved state, earlier ones
    are not streamed again, and the rows returned are those of all arrivals.
    """
    return judged(spark, path, stages, key, digest, files_per_batch, home).drop("__at")


def keep_first(docs: DataFrame, stages: Stages, key: str = "doc_id") -> DataFrame:
    """The documents that stay, with their own columns: lands ``docs`` as files and streams them.

    Only locators of dropped rows are joined back.
    """
    spark, path = docs.sparkSession, stages.path("landed")
    docs.write.parquet(path)
    dropped = stages.write(judged(spark, path, stages, key).where("NOT kept").select("__at"), "dropped")
    rows = _texts(spark, path)
    sure = likely(rows, dropped, "__at", "left_anti")
    return sure.unionByName(likely(rows, dropped, "__at").join(dropped, "__at", "left_anti")).select(docs.columns)
