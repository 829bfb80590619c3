"""Quality by compression: which of two zstandard dictionaries shortens a text more.

One dictionary is trained on pieces of texts labelled good, one on pieces labelled bad. A
whole text is cut into pieces, each compressed alone with either dictionary, so the
dictionaries matter up to its end. The normalised difference of the sums, with the
share of its length that the text keeps, is calibrated by a logistic regression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentloom.llm import common

#: Rows of each label that the model is fitted on, in the order of a hash.
MOST = 4000
#: Pieces of each label that a dictionary is trained on; bytes of a piece and of a dictionary.
PIECES, PIECE, DICTIONARY = 8000, 1024, 112_640
LEVEL = 3
#: Rows whose crc32 modulo DIVISOR is LEFT_OUT are not learned from.
DIVISOR, LEFT_OUT = 4, 2
THRESHOLD = 0.7


def cut(text: str, size: int = PIECE) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data[i: i + size] for i in range(0, len(data), size)]


def trained(pieces: list[bytes]) -> bytes:
    """A dictionary; where there are too few pieces to train one, their own content."""
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY:]


def compressor(dictionary: bytes):
    kept = zstandard.ZstdCompressionDict(dictionary)
    kept.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=kept, write_content_size=False, write_checksum=False, write_dict_id=False).compress


def features(text: str, good, bad) -> tuple[float, float, float]:
    """Normalised difference of the compressed sizes; how far the share of the text that is
    left falls below what prose keeps; the logarithm of the length."""
    pieces = cut(text)
    n = sum(map(len, pieces))
    if n == 0:
        return 0.0, 0.0, 0.0
    a, b = sum(len(good(p)) for p in pieces), sum(len(bad(p)) for p in pieces)
    return 10 * (b - a) / (b + a), max(0.0, 0.25 - a / n) * 20, float(np.log1p(n)) / 4


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    #: The score of every text where one of the labels was never seen.
    constant: float | None = None


def _pieces(sample: DataFrame) -> DataFrame:
    """(label, fold, turn, mark, piece): pieces of the sample. Turn t has the piece of each
    text with the t-th smallest hash, so that long texts do not crowd out short ones."""

    def run(batches):
        for batch in batches:
            out = []
            for text, label, fold in zip(
                    common.texts(batch), batch.column("label").to_pylist(), batch.column("fold").to_pylist()):
                marked = sorted((xxhash.xxh64_intdigest(p) >> 1, p) for p in set(cut(text)))
                out += [(label, fold, turn, *m) for turn, m in enumerate(marked)]
            if out:
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.record_batch(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["label", "fold", "turn", "mark", "piece"])

    return common.mapped(sample, run, "label int, fold int, turn long, mark long, piece binary")


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Model:
    """Learns labels.quality from at most `most` rows per label, never from rows left out.

    Calibration uses scores that a text gets from dictionaries trained without its half of
    the sample; the model's own are trained on all of it.
    """
    sample = common.labelled_sample(docs, labels, "quality", DIVISOR, LEFT_OUT, most).select(
        "text", "label", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int").alias("fold"))
    found: dict[tuple[int, int], list[bytes]] = {}
    for label in (0, 1):
        rows = _pieces(sample.filter(F.col("label") == label)).orderBy("turn", "mark", "piece").limit(PIECES)
        for row in rows.select("fold", "piece").collect():
            found.setdefault((label, row.fold), []).append(bytes(row.piece))
    shared = set.intersection(*(
        {line for (of, _), pieces in found.items() if of == label for p in pieces for line in p.split(b"\n")}
        for label in (0, 1)))
    # lines that stand in good and in bad texts tell neither from the other
    found = {k: [x for p in pieces if (x := b"\n".join(line for line in p.split(b"\n") if line not in shared))]
             for k, pieces in found.items()}
    both = {label: found.get((label, 0), []) + found.get((label, 1), []) for label in (0, 1)}
    if not both[0] or not both[1]:
        return Model(b"", b"", (), 0.0 if both[0] else 1.0)
    # a half without pieces borrows the other's
    apart = {(label, fold): trained(found.get((label, fold)) or both[label]) for label in (0, 1) for fold in (0, 1)}

    def run(batches):
        pairs = [(compressor(apart[1, 1 - fold]), compressor(apart[0, 1 - fold])) for fold in (0, 1)]
        for batch in batches:
            x = [features(t, *pairs[fold]) for t, fold in zip(common.texts(batch), batch.column("fold").to_pylist())]
            yield pa.record_batch(
                [batch.column("label"), *(pa.array(c, pa.float64()) for c in np.array(x).reshape(-1, 3).T)], ["label", "a", "b", "c"])

    rows = np.array([tuple(r) for r in common.mapped(
        sample, run, "label int, a double, b double, c double").collect()], float)
    weights = common.logistic(rows[:, 1:], rows[:, 0])
    return Model(trained(both[1]), trained(both[0]), tuple(weights.tolist()))


def scorer(model: Model):
    """texts -> scores."""
    if model.constant is not None:
        return lambda texts: np.full(len(texts), model.constant)
    pair, weights = (compressor(model.good), compressor(model.bad)), np.array(model.weights)
    return lambda texts: common.probability(
        np.array([features(t, *pair) for t in texts]).reshape(-1, 3), weights)


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, score) of every whole text: 0 to 1, higher the likelier the label good.

    Null texts count as empty; empty texts get the score of a text without evidence.
    Repeated rows are scored alike; other columns are not read. Where a label was never
    seen, all texts get 0 (only bad ones seen) or 1.
    """

    def run(batches):
        scores = scorer(model)
        for batch in batches:
            yield pa.record_batch([batch.column(key), pa.array(scores(common.texts(batch)))], [key, "score"])

    kind = docs.schema[key].dataType.simpleString()
    return common.mapped(docs.select(key, "text"), run, f"{key} {kind}, score double")


def good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all columns, whose texts score at least the threshold."""

    def keeps():
        scores = scorer(model)
        return lambda texts: scores(texts) >= threshold

    return common.kept(docs, keeps)
