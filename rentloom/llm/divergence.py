"""How far the sources of a language stand apart, over a cube of blocks.

Texts are counted where they lie; a language keeps the terms that enough of its documents
hold. A group is a (language, source). The distance of all groups of a language is worked out
over a cube: a cell is (block of groups, block of groups, block of terms), and a task holds
one cell. Each group's counts are sliced by term block and copied to the cells its group
block takes part in, a cell gives the partial distances of its pairs over its terms, and
these are summed along the term axis. A cell's size is set by the block lengths, however
frequent a source, language or term is.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentloom.llm import common

#: Documents of a language that must hold a term, pseudo-count, and scale of shares.
LEAST, PLUS, SCALE = 30, 5, 1_000_000_000
#: Groups of a group block and terms of a term block, on average.
GROUPS, TERMS = 64, 4096
#: Terms of a group that are reported.
TOP = 50
#: Rows that a task sums up before it hands them on.
HELD = 400_000
#: What each byte of UTF-8 becomes: ASCII letters in lower case, other ASCII a space, the rest itself.
_BYTES = bytes(
    ord(chr(b).lower()) if chr(b) in string.ascii_letters else b if b > 0x7F else 0x20 for b in range(256))


def _terms(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The text number and the term of every occurrence."""
    texts = pa.concat_arrays([pc.fill_null(texts, "").cast(pa.large_string())])
    _, offsets, values = texts.buffers()
    plain = (values.to_pybytes() if values else b"").translate(_BYTES)
    lists = pc.split_pattern(pa.LargeStringArray.from_buffers(len(texts), offsets, pa.py_buffer(plain)), " ")
    flat = lists.flatten()
    filled = pc.not_equal(flat, "")
    return pc.list_parent_indices(lists).filter(filled).to_numpy(), pc.dictionary_encode(flat.filter(filled))


def _summed(keys: np.ndarray, amounts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], [np.add.reduceat(a[order], first) for a in amounts]


def _counted(batch: pa.RecordBatch) -> pa.Table | None:
    """lang, source, term, count, docs of one batch."""
    text, terms = _terms(batch.column("text"))
    if len(text) == 0:
        return None
    names = [pc.dictionary_encode(pc.fill_null(batch.column(c), "")) for c in ("lang", "source")]
    langs, sources = (n.indices.to_numpy().astype(np.int64) for n in names)
    size, wide = len(terms.dictionary), len(names[1].dictionary)
    keys, [count] = _summed(
        text.astype(np.int64) * size + terms.indices.to_numpy(), [np.ones(len(text), np.int64)])
    keys, [count, docs] = _summed(
        (langs * wide + sources)[keys // size] * size + keys % size, [count, np.ones(len(keys), np.int64)])
    group, term = keys // size, keys % size
    return pa.table({
        "lang": names[0].dictionary.take(pa.array(group // wide)), "source": names[1].dictionary.take(pa.array(group % wide)),
        "term": terms.dictionary.take(pa.array(term)).cast(pa.string()), "count": count, "docs": docs})


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): how often a group has a term, and in how many of its
    rows. Tasks sum up what they hold before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[pa.Table] = []
        rows = 0

        def merged():
            return pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate(
                [("count", "sum"), ("docs", "sum")]).rename_columns(["lang", "source", "term", "count", "docs"])

        for batch in batches:
            if (found := _counted(batch)) is None:
                continue
            held.append(found)
            rows += len(found)
            if rows > HELD:
                held = [merged()]
                rows = len(held[0])
                if rows > HELD // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
        if held:
            yield from merged().to_batches()

    named = docs.select("lang", "source", "text")
    counted = common.mapped(named, run, "lang string, source string, term string, count long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (count + PLUS) / (total + PLUS * kinds)), exactly; null without terms."""
    top = (count.cast("decimal(20,0)") + PLUS) * F.lit(SCALE)
    below = (total + PLUS * kinds).cast("decimal(20,0)")
    return F.when(kinds > 0, 1 + F.call_function("div", top.cast("decimal(38,0)"), below))


class Shares:
    """Tables that both parts of the audit read, written once.

    groups: lang, source, total, kinds, groups, base (share of a term the group lacks);
    kept: lang, source, term, p (the group's share), q (the language's);
    blocks: lang, slice, terms (kept terms of a term block).
    """

    def __init__(self, docs: DataFrame, least: int = LEAST, terms: int = TERMS):
        named = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")])
        counts = common.landed(term_counts(docs), "term_counts")
        vocabulary = common.landed(
            counts.groupBy("lang", "term").agg(F.sum("count").alias("everywhere"), F.sum("docs").alias("docs"))
            .filter(F.col("docs") >= least).drop("docs"), "vocabulary")
        langs = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("everywhere").alias("all"))
        known = counts.drop("docs").join(vocabulary, ["lang", "term"])
        totals = known.groupBy("lang", "source").agg(F.sum("count").alias("total"))
        groups = (
            named.distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
            .fillna(0, ["total", "kinds", "all"]))
        sizes = named.distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("groups"))
        slices = F.greatest(F.lit(1), F.ceil(F.col("kinds") / terms)).cast("int")
        self.groups = common.landed(groups.join(sizes, "lang").withColumns({
            "slices": slices, "base": F.coalesce(share(F.lit(0), F.col("total"), F.col("kinds")), F.lit(0))}), "groups")
        placed = known.join(self.groups.select("lang", "source", "total", "kinds", "all", "slices"), ["lang", "source"])
        self.kept = common.landed(placed.select(
            "lang", "source", "term", share(F.col("count"), F.col("total"), F.col("kinds")).alias("p"),
            share(F.col("everywhere"), F.col("all"), F.col("kinds")).alias("q"),
            F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice")), "shares")
        per_lang = self.groups.select("lang", "slices").distinct()
        self.blocks = vocabulary.join(per_lang, "lang").groupBy(
            "lang", F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice")).agg(F.count(F.lit(1)).alias("terms"))


CELL = ["lang", "block_a", "block_b", "slice"]


def _cells(shares: Shares, size: int) -> DataFrame:
    """Rows of the cells: a group (term null, p its base, terms the slice's) or one share."""
    parts = F.ceil(F.col("groups") / size).cast("int")
    groups = shares.groups.select(
        "lang", "source", "base", "slices", parts.alias("parts"),
        F.pmod(F.xxhash64("source"), parts).alias("own"))
    heads = groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).join(
        shares.blocks, ["lang", "slice"], "left").select(
        "lang", "source", "own", "parts", "slice", F.lit(None).cast("string").alias("term"), F.col("base").alias("p"),
        F.coalesce("terms", F.lit(0)).alias("terms"))
    rows = shares.kept.join(groups.select("lang", "source", "own", "parts"), ["lang", "source"]).select(
        "lang", "source", "own", "parts", "slice", "term", "p", F.lit(0).cast("long").alias("terms"))
    return heads.unionByName(rows).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "lang", F.least("own", "other").alias("block_a"), F.greatest("own", "other").alias("block_b"), "slice",
        "source", "own", "term", "p", "terms")


def _partial(cell: pa.Table) -> pa.Table:
    """Distances of the cell's pairs of groups over the cell's terms."""
    head = pc.is_null(cell["term"])
    groups, rows = cell.filter(head).sort_by("source"), cell.filter(pc.invert(head))
    names, base = groups["source"].combine_chunks(), groups["p"].to_numpy()
    terms = pc.dictionary_encode(rows["term"].combine_chunks())
    shares = np.repeat(base[:, None], len(terms.dictionary), axis=1)
    shares[pc.index_in(rows["source"], names).to_numpy(), terms.indices.to_numpy()] = rows["p"].to_numpy()
    own = groups["own"].to_numpy()
    block_a, block_b = cell["block_a"][0].as_py(), cell["block_b"][0].as_py()
    lacking = groups["terms"][0].as_py() - len(terms.dictionary)
    left, right, value = ([np.empty(0, np.int64)] for _ in range(3))  # a block can be empty
    last = np.flatnonzero(own == block_b)
    for a in np.flatnonzero(own == block_a).tolist():
        others = last[last > a] if block_a == block_b else last
        left.append(np.full(len(others), a))
        right.append(others)
        value.append(np.abs(shares[others] - shares[a]).sum(axis=1) + lacking * np.abs(base[others] - base[a]))
    left, right, value = map(np.concatenate, (left, right, value))
    return pa.table({
        "lang": pa.array([cell["lang"][0].as_py()] * len(left), pa.string()),
        "a": names.take(pa.array(left)), "b": names.take(pa.array(right)), "value": value})


def distances(shares: Shares, size: int = GROUPS) -> DataFrame:
    """(lang, source, item, value) for every two different sources of a language, both ways."""
    partial = _cells(shares, size).groupBy(*CELL).applyInArrow(
        _partial, "lang string, a string, b string, value long")
    whole = partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return whole.select("lang", F.inline(both), "value")


def audit(
    docs: DataFrame, least: int = LEAST, top: int = TOP, groups: int = GROUPS, terms: int = TERMS,
) -> DataFrame:
    """lang, source, part, item, value, rank: for each group its distance to every other source
    of the language (part pair), and its `top` terms that are more frequent than in the
    language as a whole (part term).

    Null text, lang and source count as empty texts. Every row is a document, so repeated
    rows count again. A group without terms, or a language that keeps no term, still has its
    pairs (with distance 0 where no term is kept). Other columns are not read; an empty
    table gives an empty result.
    """
    common.prepared(docs.sparkSession)
    shares = Shares(docs, least, terms)
    over = shares.kept.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = distances(shares, groups).withColumn("rank", ranked).withColumn("part", F.lit("pair"))
    words = over.withColumn("rank", ranked).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return pairs.unionByName(words).select("lang", "source", "part", "item", "value", "rank")
