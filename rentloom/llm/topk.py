"""Exact top-k by inner product, located by refining global score histograms.

All scores are computed block against block, once per round, and never kept. In each round a
block counts, per query, how many of its scores fall into each bucket of the range that can
still hold the k-th score; nothing is selected inside a block. The sums over all blocks tell in which
bucket the k-th score lies and how many of that bucket's scores are still wanted, and the next round cuts that
bucket into buckets. After the last round the k-th value is known exactly, every block returns
what reaches it, and ties are broken by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import PythonException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentloom.llm import common

#: Vectors of a candidate block and of a query block.
CANDIDATES, QUERIES = 4096, 256
#: Buckets into which a round cuts the scores still possible, as a power of two.
STEP = 9
#: Scores must stay below this, so that the width of their range fits into 64 bits too.
LIMIT = 1 << 61
TOO_WIDE = "a score does not fit into 64 bits"


def whole_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v, dims): floor(scale * x) of each component as a long. Rows with a null id
    or vector, or with a null or non-finite component, are left out."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & fine).select(
        "vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"),
        F.size(x).alias("dims"))


def blocks(vectors: DataFrame, size: int, count: int) -> DataFrame:
    """One row per block: dims, block, ids and packed 64-bit components of at most about
    `size` vectors, dealt out by a hash. No sort or window runs over all rows."""

    def pack(batches):
        held: dict[tuple[int, int], list] = {}

        def out(key):
            ids, rows = zip(*held.pop(key))
            return pa.record_batch([
                pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                pa.array([np.array(ids, np.int64).tobytes()]),
                pa.array([np.array(rows, np.int64).reshape(len(ids), -1).tobytes()]),
            ], ["dims", "block", "ids", "data"])

        for batch in batches:
            names = ("dims", "block", "vec_id", "v")
            for d, b, i, v in zip(*(batch.column(n).to_pylist() for n in names)):
                held.setdefault((d, b), []).append((i, v))
                if len(held[d, b]) == size:
                    yield out((d, b))
        for key in list(held):
            yield out(key)

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).cast("int"))
    # a block's rows meet in one partition; equal vectors differ in their ids, so no block is hot
    return common.mapped(
        dealt.repartition("dims", "block"), pack, "dims int, block int, ids binary, data binary")


def scored(ids_q: bytes, data_q: bytes, ids_c: bytes, data_c: bytes, dims: int):
    """(query ids, candidate ids, scores), scores as longs, a query's own row at the bottom.

    Scores are as exact as the block needs: in doubles below 2**53, else in longs; candidates
    that might leave those are multiplied as whole numbers of any size. Only a score that
    really is LIMIT or more is refused."""
    qi, ci = np.frombuffer(ids_q, np.int64), np.frombuffer(ids_c, np.int64)
    q = np.frombuffer(data_q, np.int64).reshape(len(qi), dims)
    c = np.frombuffer(data_c, np.int64).reshape(len(ci), dims)
    own = qi[:, None] == ci[None, :]
    if dims == 0:
        scores = np.zeros((len(qi), len(ci)), np.int64)
    else:
        most = np.abs(c).max(1).astype(float) * float(np.abs(q).max()) * dims
        if most.max() < 2**53:
            scores = (q.astype(float) @ c.T.astype(float)).astype(np.int64)
        else:
            wide = most >= LIMIT
            scores = np.empty((len(qi), len(ci)), np.int64)
            scores[:, ~wide] = q @ c[~wide].T
            exact = q.astype(object) @ c[wide].T.astype(object)
            exact[own[:, wide]] = 0
            if np.abs(exact).max(initial=0) >= LIMIT:
                raise OverflowError(TOO_WIDE)
            scores[:, wide] = exact.astype(np.int64)
    scores[own] = -np.iinfo(np.int64).max
    return qi, ci, scores


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5,
          query_block: int = QUERIES, candidate_block: int = CANDIDATES, step: int = STEP) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k candidates with the highest integer
    inner product for each query; all if there are fewer; ties go to the smaller vec_id.

    queries, candidates: (vec_id, v, dims) as whole_vectors gives them. Rows with the
    query's own vec_id are no candidates for it. Vectors meet only those of equal length.
    A score of 2**61 or more (LIMIT) is refused; large components alone are not.
    Rows that repeat are rows of their own and may both be returned; a query id that
    repeats is one query (its smallest vector counts). Empty tables give an empty result.
    """
    queries = queries.groupBy("vec_id").agg(F.min(F.struct("dims", "v")).alias("s")).select(
        "vec_id", "s.v", "s.dims")
    sizes = [df.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("v", F.abs))), F.max("dims")).first()
             for df in (queries, candidates)]
    if not sizes[0][0] or not sizes[1][0]:
        return candidates.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score long")
    bound = min(LIMIT - 1, max(1, int(sizes[0][1] or 0) * int(sizes[1][1] or 0) * int(sizes[0][2])))
    n_blocks = -(-sizes[1][0] // candidate_block)
    left = common.settled(blocks(queries, query_block, -(-sizes[0][0] // query_block))).withColumnsRenamed(
        {"block": "query_block", "ids": "q_ids", "data": "q_data"})
    right = common.settled(blocks(candidates, candidate_block, n_blocks))
    low, bits = -bound, int(2 * bound + 1).bit_length()
    bounds = None
    while bits > 0:
        wide = max(0, bits - step)
        counts = _histogram(_met(left, right, bounds, n_blocks), k, low, bits, wide)
        try:
            bounds = common.settled(_located(counts))
        except PythonException as e:
            if TOO_WIDE in str(e):
                raise OverflowError(TOO_WIDE) from e
            raise
        bits = wide
    found = _reaching(_met(left, right, bounds, n_blocks), k)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _met(left: DataFrame, right: DataFrame, bounds: DataFrame | None, n_blocks: int) -> DataFrame:
    """Each query block beside every candidate block, by an equi-join on the block, with the
    bounds of its queries, which are as many as its ids. Blocks none of whose queries has a
    candidate are left out once that is known."""
    if bounds is None:
        asked = left.withColumn("bounds", F.lit(None).cast("array<struct<query_id:bigint,start:bigint,wanted:bigint>>"))
    else:
        by_block = bounds.groupBy("dims", "query_block").agg(
            F.collect_list(F.struct("query_id", "start", "wanted")).alias("bounds"))
        asked = left.join(by_block, ["dims", "query_block"])
    sent = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    return sent.join(right, ["dims", "block"])


def _located(counts: DataFrame) -> DataFrame:
    """(dims, query_block, query_id, start, wanted): the bucket that holds each query's k-th
    score (the last one, where there are fewer), and which of its scores from the top that is."""
    summed = counts.groupBy("dims", "query_block", "query_id", "start", "wanted").agg(F.sum("n").alias("n"))
    down = Window.partitionBy("query_id").orderBy(F.col("start").desc())
    running = summed.withColumns({
        "upto": F.sum("n").over(down), "total": F.sum("n").over(Window.partitionBy("query_id"))})
    rank, above = F.least("wanted", "total"), F.col("upto") - F.col("n")
    return running.filter((F.col("upto") >= rank) & (above < rank)).select(
        "dims", "query_block", "query_id", "start", (rank - above).alias("wanted"))


def _rows(batches) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _histogram(met: DataFrame, k: int, low: int, bits: int, wide: int) -> DataFrame:
    """(dims, query_block, query_id, start, wanted, n): all scores of a block counted in
    buckets of 2**wide, inside each query's range of 2**bits."""

    def run(batches):
        for row in _rows(batches):
            qi, _, scores = scored(row["q_ids"], row["q_data"], row["ids"], row["data"], row["dims"])
            if row["bounds"] is None:
                asked = np.arange(len(qi))
                first, wanted = np.full(len(qi), low, np.int64), np.full(len(qi), k, np.int64)
            else:
                held = {b["query_id"]: (b["start"], b["wanted"]) for b in row["bounds"]}
                asked = np.flatnonzero([q in held for q in qi.tolist()])
                first, wanted = np.array([held[q] for q in qi[asked].tolist()], np.int64).reshape(-1, 2).T
            # a query's own row lies below every range
            within = scores[asked] - np.maximum(first, low)[:, None]
            inside = (scores[asked] >= first[:, None]) & (within < 1 << bits)
            across = 1 << (bits - wide)
            at = (np.arange(len(asked)) * across)[:, None] + (within >> wide)
            n = np.bincount(at[inside], minlength=len(asked) * across)
            filled = np.flatnonzero(n)
            query, bucket = filled // across, filled % across
            yield pa.record_batch([
                pa.array(np.full(len(filled), row["dims"], np.int32)),
                pa.array(np.full(len(filled), row["query_block"], np.int32)),
                pa.array(qi[asked][query]), pa.array(first[query] + (bucket << wide)), pa.array(wanted[query]),
                pa.array(n[filled]),
            ], ["dims", "query_block", "query_id", "start", "wanted", "n"])

    return common.mapped(met, run, "dims int, query_block int, query_id long, start long, wanted long, n long")


def _reaching(met: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): scores that reach the k-th. Of a block's ties at most k,
    those with the smallest ids, can be among the best."""

    def run(batches):
        for row in _rows(batches):
            qi, ci, scores = scored(row["q_ids"], row["q_data"], row["ids"], row["data"], row["dims"])
            held = {b["query_id"]: b["start"] for b in row["bounds"]}
            order = np.argsort(ci, kind="stable")
            ci, scores = ci[order], scores[:, order]
            parts = []
            for i, q in enumerate(qi.tolist()):
                at = np.flatnonzero(scores[i] >= held[q]) if q in held else np.empty(0, np.int64)
                at = at[np.argsort(-scores[i, at], kind="stable")[:k]]
                parts.append((np.full(len(at), q), ci[at], scores[i, at]))
            yield pa.record_batch(
                [pa.array(np.concatenate(x)) for x in zip(*parts)], ["query_id", "vec_id", "score"])

    return common.mapped(met, run, "query_id long, vec_id long, score long")
