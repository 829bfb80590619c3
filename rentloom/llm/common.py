"""Helpers that several operators share."""

from __future__ import annotations

import contextlib
import functools
import gc
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentloom.session import delete_folder, deleted_at_exit, shared_folder

#: Most members of a group that one task compares with one another; larger groups are
#: compared block against block, each pair of blocks in a task of its own.
BLOCK = 2000
#: Rows of an Arrow batch.
ROWS = 2000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Tables that are only needed inside the `passing` blocks that are open, the innermost last.
_passing: list[list[str]] = []


def freed(spark: SparkSession) -> None:
    """Shuffle files of frames that nothing refers to any more are deleted now. Spark does so when
    the driver collects garbage, which else happens long after a step is written down."""
    gc.collect()
    spark._jvm.System.gc()


@contextlib.contextmanager
def passing(spark: SparkSession):
    """Tables landed inside are deleted at the end, with the shuffle files made on the way. What
    is to stay is `written` inside, so nothing left needs them, were an executor lost."""
    _passing.append([])
    try:
        yield
    finally:
        for path in _passing.pop():
            delete_folder(spark, path)
        freed(spark)


def settled(df: DataFrame) -> DataFrame:
    """Rows written to the shared folder, so that lost executors cost nothing done before.
    Spark deletes them with the frame where its cleaner is set to."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    freed(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> str:
    """Where df is written as Parquet: a folder below the shared one, deleted when the process
    ends or earlier by session.delete_folder."""
    path = f"{shared_folder(df.sparkSession)}-{name}"
    deleted_at_exit(df.sparkSession, path)
    freed(df.sparkSession)
    df.write.parquet(path)
    return path


def landed(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet below the shared folder and read again."""
    path = written(df, name)
    if _passing:
        _passing[-1].append(path)
    return df.sparkSession.read.parquet(path)


def passed(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """landed(make()), without the tables that make() landed on the way."""
    with passing(spark):
        path = written(make(), name)
    if _passing:
        _passing[-1].append(path)
    return spark.read.parquet(path)


@functools.cache
def _sent(application: str, context) -> tempfile.TemporaryDirectory:
    """This package as an archive that Spark hands to every worker of the application. The
    driver alone reads the folder, which goes when the driver ends."""
    folder = tempfile.TemporaryDirectory(prefix="rentloom-code-")
    package = Path(__file__).parents[1]
    context.addPyFile(shutil.make_archive(f"{folder.name}/rentloom", "zip", package.parent, package.name))
    return folder


def prepared(spark: SparkSession) -> None:
    """Sees to it that workers find this package."""
    _sent(spark.sparkContext.applicationId, spark.sparkContext)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with this package at hand on the workers.

    Rows hold whole texts, so where the session leaves Spark's default of 10,000 rows to a
    batch, it is set to ROWS: a batch is held by the executor and by its worker at once.
    """
    spark = df.sparkSession
    prepared(spark)

    def returning(batches):
        try:
            yield from run(batches)
        finally:
            # a worker lives on for other stages; what it needed here goes back to the system
            for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
                pool.release_unused()

    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    return df.mapInArrow(returning, schema)


def in_batches(
    df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
) -> DataFrame:
    """step over every Arrow batch."""
    return mapped(df, lambda batches: map(step, batches), schema)


def kept(df: DataFrame, keeps: Callable[[], Callable[[list[str]], np.ndarray]]) -> DataFrame:
    """Rows of df, with all their columns, for whose texts keeps()(texts) is true."""

    def run(batches):
        test = keeps()
        for batch in batches:
            yield batch.filter(pa.array(test(texts(batch)), pa.bool_()))

    return mapped(df, run, ddl(df))


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Column name as strings; null counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def remainder(key: str | Column, divisor: int) -> Column:
    """crc32 of the key as text modulo divisor, by which rows are held out."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string").cast("binary")) % divisor


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, divisor: int, left_out: int, most: int,
) -> DataFrame:
    """(doc_id, text, label) of at most `most` rows per label, taken in the order of a hash.

    Rows whose remainder is left_out and labels other than 0 and 1 take no part. The sample
    is at most 2 * most ids, so it may be broadcast; only its texts are shuffled, one of each id, and they are
    looked for once: the sample is written to the shared folder.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & (remainder("doc_id", divisor) != left_out))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [
        known.filter(F.col("label") == value).distinct().orderBy(*order).limit(most)
        for value in (0, 1)
    ]
    return settled(one_text_each(docs, parts[0].unionByName(parts[1]), ["doc_id"]))


def one_text_each(docs: DataFrame, ids: DataFrame, on: list[str]) -> DataFrame:
    """ids, which must be few, with the text of the docs that share its columns `on`; of several
    under one id that with the smallest hash.

    Every task keeps one text per id before the shuffle, so a sample has as many rows as ids
    even where an id holds a large share of docs."""
    found = docs.select(*on, "text").join(F.broadcast(ids), on)
    best = F.min(F.struct(F.xxhash64("text").alias("mark"), "text")).alias("best")
    return found.groupBy(*ids.columns).agg(best).select(*ids.columns, "best.text")


def compared_blocks(members: DataFrame, key: str, item: str, block: int = BLOCK) -> DataFrame:
    """Members of groups of two or more, dealt into cells whose pairs are to be compared.

    members: distinct (key, item). A group of up to `block` members is one cell. A larger
    one is cut by a hash of the item into blocks, and each pair of blocks is a cell, so no
    task holds a whole group. Adds cell_a, cell_b (the blocks that meet) and own (the
    member's block). The counts are summed before the shuffle and joined back by a
    sort-merge join, whose skewed partitions adaptive execution splits. It is asked for: members
    come out of an explode, which Spark does not count in their size, so it would broadcast them
    by way of the driver.
    """
    sizes = members.groupBy(key).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    parts = F.ceil(F.col("size") / block).cast("int")
    return (
        members.join(sizes.hint("merge"), key)
        .withColumn("own", F.pmod(F.xxhash64(item), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("cell_a", F.least("own", "other"))
        .withColumn("cell_b", F.greatest("own", "other"))
        .drop("size", "other")
    )


def sorted_cells(cells: DataFrame, key: str) -> DataFrame:
    """Cells side by side in each partition; hashing deals the cells of a large group out."""
    by = [key, "cell_a", "cell_b"]
    return cells.repartition(*by).sortWithinPartitions(*by)


def whole_cells(
    batches: Iterator[pa.RecordBatch], key: str,
) -> Iterator[pa.Table]:
    """Tables that end where a cell ends; at most one batch and one cell are held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        last = [batch.column(n)[-1].as_py() for n in (key, "cell_a", "cell_b")]
        cut = batch.num_rows - 1
        columns = [batch.column(n) for n in (key, "cell_a", "cell_b")]
        while cut >= 0 and [c[cut].as_py() for c in columns] == last:
            cut -= 1
        if cut >= 0:
            yield pa.Table.from_batches([*held, batch.slice(0, cut + 1)])
            held = [batch.slice(cut + 1)]
        else:
            first = held and [held[0].column(n)[-1].as_py() for n in (key, "cell_a", "cell_b")]
            if held and first != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression (the last is the constant), by Newton steps. Both
    classes weigh as much as they are frequent; a small ridge keeps separable data finite."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + keep * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep + 1e-9), gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.column_stack((x, np.ones(len(x)))) @ w, -30, 30)))
