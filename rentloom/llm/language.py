"""Language identification with bit-sliced Bloom filters over character n-grams.

One table of bit masks holds the filters of all languages side by side: bit j of a slot
belongs to language j, so the few slots of an n-gram, joined by AND, give all languages that
contain it at once. A text's language is the one that contains most of its n-grams, after
the hits that a filter gives by chance are taken off.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentloom.llm import common

#: Rows of each language that the filters are built from, in the order of a hash.
MOST = 2000
DIVISOR, LEFT_OUT = 4, 2
#: Characters of an n-gram; slots of the table, a power of two; slots an n-gram sets.
SIZE, SLOTS, PROBES = 4, 1 << 20, 3
#: An n-gram belongs to a language if it occurs so often in its sample, and at least at this
#: share of the rate that it has in the language where it is most frequent.
TIMES, SHARE = 2, 0.1
#: Languages of one table of masks; more languages use more tables.
SLICES = 63
#: Most languages that a model tells apart.
LANGUAGES = 1000
UNKNOWN = "und"
#: Code points looked at together.
CHUNK = 1 << 22


@functools.cache
def _folded() -> np.ndarray:
    """Lower-case letter for every code point; a space for what is no letter."""
    out = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if (letter := chr(c)).isalpha():
            low = letter.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all their bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts, the number of the text each belongs to (sorted),
    and whether each text has a letter. Runs of other characters count as one space; two
    spaces stand before a text and one behind it."""
    lengths = np.array([len(t) for t in texts], np.int64) + 2
    joined = ("  " + "  ".join(texts) + "  ").encode("utf-32-le", "surrogatepass")
    codes = _folded()[np.frombuffer(joined, np.uint32)]
    # the two spaces before a text count to it
    owner = np.repeat(np.arange(len(texts) + 1), np.append(lengths, 2))
    space = codes == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    starts = np.append(0, np.cumsum(lengths))
    keep[starts] = keep[starts + 1] = True
    codes, owner, space = codes[keep], owner[keep], space[keep]
    lettered = np.zeros(len(texts) + 1, bool)
    lettered[owner[~space]] = True
    n = len(codes) - SIZE + 1
    packed = codes[:n].astype(np.uint64)
    for i in range(1, SIZE):
        packed = packed * np.uint64(0x110001) + codes[i: i + n]
    # the last n-gram of a text may end in the space that follows it, none goes further
    last = owner[SIZE - 1:]
    whole = (owner[:n] == owner[SIZE - 2: SIZE - 2 + n]) & (
        (last == owner[:n]) | ((last == owner[:n] + 1) & ~space[SIZE - 2: SIZE - 2 + n]))
    whole &= ~space[SIZE - 2: SIZE - 2 + n] | ~space[SIZE - 1:]
    return mixed(packed[whole]), owner[:n][whole], lettered[:-1]


def slots(hashes: np.ndarray, probe: int, size: int) -> np.ndarray:
    return (mixed(hashes + np.uint64((probe + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) & np.uint64(size - 1)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: A row of masks for every SLICES languages.
    masks: np.ndarray
    #: Chance that an n-gram outside a language is found in its filter.
    chance: np.ndarray


def fit(docs: DataFrame, most: int = MOST, size: int = SLOTS) -> Model:
    """Filters from the texts of rows with a language that are not left out, at most `most`
    per language. The counts are summed in the tasks, the masks joined by OR before they
    reach the driver: at most `size` slots per table of languages."""
    known = docs.select("doc_id", "lang").filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (common.remainder("doc_id", DIVISOR) != LEFT_OUT))
    languages = tuple(sorted(r.lang for r in known.select("lang").distinct().limit(LANGUAGES + 1).collect()))
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    tables = max(1, -(-len(languages) // SLICES))
    masks = np.zeros((tables, size), np.uint64)
    if not languages:
        return Model(languages, masks, np.zeros(0))
    number = {name: i for i, name in enumerate(languages)}
    sample = common.one_text_each(docs, _first_ids(known, most), ["doc_id", "lang"])

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                hashes, owner, _ = grams(common.texts(part))
                of = np.array([number[x] for x in part.column("lang").to_pylist()], np.int64)[owner]
                pairs, n = np.unique(np.stack([hashes.view(np.int64), of]), axis=1, return_counts=True)
                yield pa.record_batch(
                    [pa.array(pairs[0]), pa.array(pairs[1].astype(np.int32)), pa.array(n.astype(np.int64))],
                    ["gram", "of", "n"])

    counts = common.mapped(sample, count, "gram long, of int, n long").groupBy("gram", "of").agg(F.sum("n").alias("n"))
    counts = common.settled(counts)
    totals = {r.of: r.n for r in counts.groupBy("of").agg(F.sum("n").alias("n")).collect()}
    rates = F.create_map(*(x for k, v in totals.items() for x in (F.lit(k), F.lit(1.0 / v)))) if totals else F.lit(None)
    rated = counts.withColumn("rate", F.col("n") * rates[F.col("of")] if totals else F.lit(0.0))
    most_frequent = F.max("rate").over(Window.partitionBy("gram"))
    members = rated.withColumn("top", most_frequent).filter(
        (F.col("n") >= TIMES) & (F.col("rate") >= SHARE * F.col("top")))

    def place(batches):
        for batch in batches:
            hashes, of = batch.column("gram").to_numpy().view(np.uint64), batch.column("of").to_numpy()
            for probe in range(PROBES):
                yield pa.record_batch([
                    pa.array((of // SLICES).astype(np.int32)), pa.array(slots(hashes, probe, size)),
                    pa.array(np.int64(1) << (of % SLICES).astype(np.int64))], ["row", "slot", "mask"])

    joined = common.mapped(members.select("gram", "of"), place, "row int, slot long, mask long").groupBy(
        "row", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    masks[joined["row"].to_numpy(), joined["slot"].to_numpy()] = joined["mask"].to_numpy().view(np.uint64)
    filled = np.array([
        float(((masks[i // SLICES] >> np.uint64(i % SLICES)) & np.uint64(1)).mean()) for i in range(len(languages))])
    return Model(languages, masks, filled**PROBES)


def _first_ids(known: DataFrame, most: int) -> DataFrame:
    """(doc_id, lang): of each language the `most` ids that are first in the order of a hash.

    Only ids whose hash lies low enough are shuffled: of about n ids of a language the
    lowest 4 * most / n of all hash values hold 4 * most, give or take a tenth, so neither
    the shuffle nor a language's window grows with the corpus. (That fewer than `most` lie there is
    beyond twenty deviations.) n is told by a sketch that every task sums up by itself."""
    about = known.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("about"))
    # a hash shifted to 52 bits is a whole number in a double
    low = F.shiftrightunsigned(F.xxhash64("doc_id"), 12)
    share = F.lit(4.0 * most) / F.greatest(F.col("about"), F.lit(1))
    likely = known.join(F.broadcast(about), "lang").filter(low < share * float(1 << 52)).select("doc_id", "lang").distinct()
    first = Window.partitionBy("lang").orderBy(low, "doc_id")
    return likely.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= most).drop("at")


def foretold(texts: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of every text. The score is the best language's share in the sum
    of the best two, by their corrected shares of the text's n-grams."""
    hashes, owner, lettered = grams(texts)
    count = np.bincount(owner, minlength=len(texts)).astype(float)
    found = [functools.reduce(np.bitwise_and, (row[slots(hashes, p, row.size)] for p in range(PROBES))) for row in model.masks]
    shares = np.zeros((len(texts), len(model.languages)))
    for i, chance in enumerate(model.chance):
        bit = (found[i // SLICES] >> np.uint64(i % SLICES)) & np.uint64(1)
        hits = np.bincount(owner, weights=bit, minlength=len(texts))
        shares[:, i] = np.clip((hits / np.maximum(count, 1) - chance) / max(1e-9, 1 - chance), 0, 1)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = shares.argmax(1)  # ties go to the first name
    ordered = np.sort(np.column_stack((shares, np.zeros(len(texts)))), axis=1)
    score = ordered[:, -1] / np.maximum(ordered[:, -1] + ordered[:, -2], 1e-9)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
    return names, np.where(lettered, score, 0.0)


def predict(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score) of every whole text; `und` with score 0 where the text is
    null or has no letter, or no language was learned. A text none of whose n-grams is
    known gets the first language with score 0. Repeated rows are told alike; other columns
    are not read. Masks are PROBES reads per n-gram from a table of fixed size."""

    def run(batches):
        for batch in batches:
            texts, at = common.texts(batch), 0
            while at < len(texts):
                end, size = at + 1, len(texts[at])
                while end < len(texts) and size + len(texts[end]) <= CHUNK:
                    size += len(texts[end])
                    end += 1
                names, score = foretold(texts[at:end], model)
                yield pa.record_batch(
                    [batch.column(key).slice(at, end - at), pa.array(names, pa.string()), pa.array(score)],
                    [key, "lang_pred", "score"])
                at = end

    kind = docs.schema[key].dataType.simpleString()
    return common.mapped(docs.select(key, "text"), run, f"{key} {kind}, lang_pred string, score double")
