"""Near copies by 64-bit fingerprints whose bits are majorities over hashed word shingles.

Candidate pairs agree on some of the fixed bit blocks of the fingerprint (pigeonhole, so no
pair within the distance is missed). Pivot distance tables then do the deciding work: the
Hamming distances of every fingerprint to fixed reference fingerprints are computed once, as
a column beside it. A pair whose distances to any reference differ by more than the bound
cannot be near (the triangle inequality): candidates are ordered by the first distance, so only
neighbours within the bound are paired at all, the greatest difference over the other
references discards among those, and only what is left is compared bit by bit.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentloom.llm import common
from rentloom.llm.components import components

#: Shingle length in words, seed of XXH64, and the most bits by which linked fingerprints differ.
WORDS, SEED, BITS = 4, 42, 4
#: Bit blocks of the pigeonhole keys: near pairs agree on all but BITS of them.
BLOCKS = 7
#: Reference fingerprints of the pivot tables.
PIVOTS = 16
#: Shingle hashes whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str, words: int = WORDS) -> int:
    """Only A-Z are lower-cased; words are runs without ASCII white space. Shingles count as
    often as they occur; fewer words than a shingle make one shingle, no word gives zero.
    A bit is set if it is set in more than half of the hashes."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    n = max(1, len(found) - words + 1)
    stops = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))
    ends = stops[min(words, len(found)) - 1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    pairs = zip(starts[:n].tolist(), ends.tolist())
    while part := list(itertools.islice(pairs, CHUNK)):
        hashes = np.array([digest(line[s:e], SEED) for s, e in part], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    # unpackbits gives each byte of the little-endian word from its highest bit down
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits).view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, key: str = "doc_id") -> DataFrame:
    """(key, fp): fp holds the 64 bits as a signed long. Null texts count as empty."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t, words) for t in common.texts(batch)], np.uint64)
        return pa.record_batch(
            [batch.column(key), pa.array(found.view(np.int64))], [key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return common.in_batches(docs.select(key, "text"), step, f"{key} {kind}, fp long")


def block_masks(blocks: int) -> list[int]:
    """The 64 bits cut into neighbouring blocks of nearly equal width."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def keyed(distinct: DataFrame, bits: int = BITS, blocks: int = BLOCKS) -> DataFrame:
    """(key, fp, ...): one row for each choice of blocks - bits blocks. Of any pair within the
    distance at least one choice agrees in full."""
    masks = block_masks(blocks)
    chosen = [sum(c) for c in itertools.combinations(masks, blocks - bits)]
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(chosen)]
    return distinct.withColumn("key", F.explode(F.array(*keys)))


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Fixed reference fingerprints, spread by a hash."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i) for i in range(count)], np.uint64)


def tabled(distinct: DataFrame, count: int = PIVOTS) -> DataFrame:
    """distinct with d0, d1, ...: longs that each hold eight distances, to as many references,
    the first in the lowest byte."""
    references = [_signed(int(p)) for p in pivots(count)]

    def packed(part: list[int]) -> Column:
        distances = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long") for p in part]
        return functools.reduce(
            lambda a, b: a.bitwiseOR(b), [F.shiftleft(d, 8 * i) for i, d in enumerate(distances)])

    return distinct.withColumns({
        f"d{i // 8}": packed(references[i: i + 8]) for i in range(0, count, 8)})


def table_names(count: int = PIVOTS) -> list[str]:
    return [f"d{i}" for i in range(-(-count // 8))]


def near_pairs(fps: np.ndarray, left: np.ndarray, right: np.ndarray, bits: int,
               table: np.ndarray) -> np.ndarray:
    """Which of the pairs (left[i], right[i]) of fps differ by at most bits. table: a row of
    distances to the references for each of fps."""
    keep = np.ones(len(left), bool)
    for j in range(table.shape[1]):
        at = np.flatnonzero(keep)
        keep[at] = np.abs(table[left[at], j] - table[right[at], j]) <= bits
    at = np.flatnonzero(keep)
    keep[at] = np.bitwise_count(fps[left[at]] ^ fps[right[at]]) <= bits
    return keep


def cell_pairs(group: np.ndarray, own: np.ndarray, same: np.ndarray, most: int = 1 << 20,
               place: np.ndarray | None = None, reach: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs to compare, cell by cell, at most about `most` at a time. group: cell
    numbers, sorted. In a cell of two blocks (same is false) only pairs across them count.
    With `place`, sorted within each cell, only pairs whose places differ by at most reach."""
    n = len(group)
    ends = np.searchsorted(group, group, side="right")
    lefts, rights, held = [], [], 0
    open_ = np.arange(n)
    for step in range(1, int((ends - np.arange(n)).max(initial=0))):
        open_ = open_[open_ + step < ends[open_]]
        if place is not None:
            open_ = open_[place[open_ + step] - place[open_] <= reach]
        if len(open_) == 0:
            break
        i = open_[same[open_] | (own[open_] != own[open_ + step])]
        lefts.append(i)
        rights.append(i + step)
        held += len(i)
        if held >= most:
            yield np.concatenate(lefts), np.concatenate(rights)
            lefts, rights, held = [], [], 0
    if lefts:
        yield np.concatenate(lefts), np.concatenate(rights)


def forest(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index reachable from each of n nodes."""
    label = np.arange(n)
    a = np.concatenate([p[0] for p in pairs]) if pairs else np.empty(0, np.int64)
    b = np.concatenate([p[1] for p in pairs]) if pairs else np.empty(0, np.int64)
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if np.array_equal(before, label):
            return label


def links(distinct: DataFrame, bits: int = BITS, blocks: int = BLOCKS, block: int = common.BLOCK,
          count: int = PIVOTS) -> DataFrame:
    """(a, b): rows that connect the same fingerprints as all pairs within the distance do. Of
    what is connected in a cell each member is named with the smallest one, never all pairs."""

    names = table_names(count)

    def run(batches):
        for cells in common.whole_cells(batches, "key"):
            fps = cells.column("fp").to_numpy().view(np.uint64)
            columns = [cells.column(c).to_numpy() for c in ("key", "cell_a", "cell_b")]
            new = np.zeros(len(fps), bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            group = np.cumsum(new)
            packed = np.column_stack([cells.column(c).to_numpy() for c in names]).astype("<i8")
            table = packed.view(np.int8).reshape(len(fps), -1)[:, :count]
            order = np.lexsort((table[:, 0], group))
            fps, table = fps[order], table[order]
            own, same = cells.column("own").to_numpy()[order], (columns[1] == columns[2])[order]
            found = []
            for left, right in cell_pairs(group, own, same, place=table[:, 0], reach=bits):
                near = near_pairs(fps, left, right, bits, table[:, 1:])
                found.append((left[near], right[near]))
            root = forest(len(fps), found)
            at = np.flatnonzero(root != np.arange(len(fps)))
            signed = fps.view(np.int64)
            yield pa.record_batch(
                [pa.array(signed[at]), pa.array(signed[root[at]])], ["a", "b"])

    cells = common.compared_blocks(keyed(tabled(distinct, count), bits, blocks), "key", "fp", block)
    return common.mapped(common.sorted_cells(cells, "key"), run, "a long, b long").distinct()


def components_by_fingerprint(docs: DataFrame, words: int = WORDS, bits: int = BITS,
                              blocks: int = BLOCKS, block: int = common.BLOCK) -> DataFrame:
    """Every row's doc_id with its fingerprint (16 hex digits) and component_id.

    component_id is the smallest doc_id reachable over links of at most `bits` differing
    bits, the row itself included. Documents without words have the fingerprint zero and
    are linked like any other. Rows may repeat (each comes out again); a null doc_id takes
    part but is no component's smallest id unless all are null. Other columns of docs are
    not read. An empty table gives an empty result.
    """
    prints = common.settled(fingerprints(docs, words))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    joined = components(links(distinct.select("fp"), bits, blocks, block))
    groups = distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    smallest = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = groups.select("fp", "component").join(smallest, "component").drop("component")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One document of every component, columns as given: the text of the smallest doc_id.

    Texts that share a doc_id are told apart, so each stays unless its own component keeps
    another; of rows equal in doc_id and text one stays, chosen by a hash of its columns. Rows
    without a doc_id cannot be named by a component and stay.
    """
    named = docs.filter("doc_id is not null").select(
        F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("version")).alias("doc"), "text")
    prints = common.settled(fingerprints(named, key="doc"))
    joined = components(links(prints.select("fp").distinct(), BITS, BLOCKS, common.BLOCK))
    groups = prints.groupBy("fp").agg(F.min("doc").alias("doc")).join(joined.withColumnRenamed("node", "fp"), "fp", "left")
    kept = groups.groupBy(F.coalesce("component", "fp").alias("component")).agg(F.min("doc").alias("doc")).select(
        F.col("doc.doc_id").alias("_doc_id"), F.col("doc.version").alias("_version"))
    # the join and the choice among equal rows share one shuffle of the texts
    told = docs.withColumn("_text", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = (F.col("doc_id") == F.col("_doc_id")) & (F.col("_text") == F.col("_version"))
    first = Window.partitionBy("doc_id", "_text").orderBy(F.xxhash64(*docs.columns))
    rows = (
        told.join(kept, same, "left_semi")
        .withColumn("_copy", F.row_number().over(first)).filter("_copy = 1").drop("_copy", "_text")
    )
    return rows.unionByName(docs.filter("doc_id is null")).select(*docs.columns)
