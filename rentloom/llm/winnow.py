"""Document fingerprints by winnowing, in DataFrame functions alone.

Words are hashed, the hashes of K words in a row are rolled into one, and of every
window of W such hashes the smallest is kept with its position, of equal ones the rightmost.
Two texts that share K + W - 1 words in a row share at least one fingerprint.

Both the rolled hashes and the window minima are built by doubling: a run of 2n comes of two
runs of n, one further on, so an array is passed over a few times, whatever K and W.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words of a rolled hash and hashes of a window.
K, W = 2, 4
#: A key holds 31 bits of hash above 32 bits that fall as the position rises.
LOW = (1 << 32) - 1
#: Scripts written without spaces: every character is a word.
UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}])"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def doubled(values: Column, runs: int, join: Callable[[Column, Column], Column]) -> Column:
    """join over every run of `runs` elements, out of two runs that may overlap. Behind the
    last whole run join meets null."""

    def further(step: int) -> Callable[[Column], Column]:
        return lambda v: F.zip_with(v, F.slice(v, step + 1, F.size(v)), join)

    size = 1
    while size < runs:
        step = min(size, runs - size)
        values = bound(values, further(step))
        size += step
    return values


def words(text: Column) -> Column:
    spaced = F.when(text.rlike(UNSPACED), F.regexp_replace(text, UNSPACED, " $1 ")).otherwise(text)
    return F.array_remove(F.split(spaced, r"\s+"), "")


def _selected(found: Column, k: int, w: int) -> Column:
    """Keys of the window minima of an array of words."""
    n = F.size(found)
    rolled = doubled(F.transform(found, lambda x: F.xxhash64(x)), k, lambda a, b: F.xxhash64(a, b))
    hashes = F.when(n >= k, F.slice(rolled, 1, F.greatest(n - (k - 1), F.lit(1)))).when(
        n > 0, F.array(F.xxhash64(found))).otherwise(F.array().cast("array<bigint>"))
    keys = bound(hashes, lambda h: F.transform(h, lambda x, i: F.shiftleft(
        F.shiftrightunsigned(x, 33), 32).bitwiseOR(F.lit(LOW) - i)))
    least = doubled(keys, w, lambda a, b: F.least(a, b))
    windows = bound(least, lambda m: F.slice(m, 1, F.greatest(F.size(m) - (w - 1), F.lit(1))))
    return F.array_distinct(windows)


def keys(text: Column, k: int = K, w: int = W) -> Column:
    """The fingerprint as one long per hash, in the order of positions; see fingerprint."""
    return bound(words(F.coalesce(text, F.lit(""))), lambda found: _selected(found, k, w))


def hash_of(key: Column) -> Column:
    return F.shiftrightunsigned(key, 32).cast("int")


def position_of(key: Column) -> Column:
    return F.lit(LOW) - key.bitwiseAND(F.lit(LOW))


def fingerprint(text: Column, k: int = K, w: int = W) -> Column:
    """array<struct<hash int, position bigint>> in the order of positions (words, from 0).

    Null counts as empty, and a text without words has no fingerprint. A text of fewer than
    k words has one, of all its words; one of fewer than w hashes has its smallest.
    """
    return F.transform(keys(text, k, w), lambda x: F.struct(hash_of(x).alias("hash"), position_of(x).alias("position")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two arrays of hashes; two empty ones are alike."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(
        F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1)))


def written(found: Column) -> Column:
    return F.lower(F.array_join(F.transform(found, lambda x: F.hex(hash_of(x))), " "))


def places(found: Column) -> Column:
    return F.transform(found, lambda x: position_of(x).cast("int"))


def _dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """Rows with the block they are looked at in: neighbouring doc_ids, about equally many.

    The last row of a block is followed by the first of the block below, which comes along as
    a guest; the very first follows the last. Only ids are looked through for
    this; the borders and first ids of at most `blocks` blocks pass the driver.
    """
    ids = docs.select("doc_id")
    cuts = [i / blocks for i in range(1, blocks)]
    borders = sorted(set(ids.agg(F.percentile_approx("doc_id", cuts, 100 * blocks).alias("x")).first().x or []))
    column = F.col("doc_id")
    block = F.size(F.filter(F.lit(borders).cast("array<bigint>"), lambda b: b <= column)) if borders else F.lit(0)
    tops = sorted((r.block, r.top) for r in ids.groupBy(block.alias("block")).agg(F.max("doc_id").alias("top")).collect())
    guests = [(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)]
    asked = F.broadcast(docs.sparkSession.range(1).select(
        F.inline(F.arrays_zip(F.lit([g[0] for g in guests]).cast("array<bigint>").alias("doc_id"),
                              F.lit([g[1] for g in guests]).cast("array<int>").alias("host")))))
    return docs.join(asked, "doc_id", "left").select(
        *docs.columns, F.posexplode(F.array_compact(F.array(block.cast("int"), F.col("host")))).alias("guest", "block"))


def compared(docs: DataFrame, k: int = K, w: int = W, blocks: int | None = None) -> DataFrame:
    """Every row's fingerprint beside that of its edited text and of its next document, with the
    positions of both (`positions`, `edited_positions`: word numbers from 0, one per hash).

    The edited text has its last third (rounded down) replaced by as many code points from
    the start of the next document by descending doc_id (after the last: the first). Null texts
    are empty. Rows that share a doc_id each come out; as a next document the one whose text
    has the smallest hash counts. Rows without doc_id have no next document. Other columns are
    not read; an empty table gives an empty result. Texts are shuffled once.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id"), text.alias("text"))
    if blocks is None:
        blocks = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(rows.filter("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("long")), blocks)
    down = Window.partitionBy("block").orderBy("guest", F.col("doc_id").desc())
    following = Window.partitionBy("block").orderBy("rank").rangeBetween(1, 1)
    ranked = dealt.withColumn("rank", F.dense_rank().over(down)).withColumn("mark", F.xxhash64("text"))
    own = ranked.withColumn("own", keys(F.col("text"), k, w))
    joined = own.withColumn("next", F.min_by(F.struct("text", "own"), "mark").over(following)).filter("guest = 0")
    alone = rows.filter("doc_id is null").withColumn("own", keys(F.col("text"), k, w)).withColumn(
        "next", F.struct(F.lit("").alias("text"), F.array().cast("array<bigint>").alias("own")))
    names = ["doc_id", "text", "own", "next"]
    both = joined.select(*names).unionByName(alone.select(F.col("doc_id").cast("long"), *names[1:]))
    size = F.char_length("text")
    third = F.floor(size / 3).cast("int")
    edited = both.select(
        "doc_id", size.cast("long").alias("n_chars"), "own", F.col("next.own").alias("next_own"),
        F.concat(F.substring("text", F.lit(1), size - third), F.substring("next.text", F.lit(1), third)).alias("edited"))
    alike = [F.transform(c, hash_of) for c in ("own", "edited_own", "next_own")]
    return edited.withColumn("edited_own", keys(F.col("edited"), k, w)).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("own")).alias("fingerprint"), written(F.col("edited_own")).alias("edited_fingerprint"),
        places(F.col("own")).alias("positions"), places(F.col("edited_own")).alias("edited_positions"),
        likeness(alike[0], alike[1]).alias("near_edited"), likeness(alike[0], alike[2]).alias("near_next"))
