"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text.

Folding undoes spellings that hide a word: look-alike letters of other scripts, digits and
signs inside words, letters without width. The lexicon (words, and beginnings of words) and its
weights are learned from labelled texts, as are exceptions: words and pairs of words
that hold an entry but stand in clean texts. Hits are normalised by the length of the text.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentloom.llm import common

#: Rows of each label that the model is fitted on, in the order of a hash.
MOST = 4000
DIVISOR, LEFT_OUT = 5, 0
THRESHOLD = 0.5
#: Entries of a learned lexicon at most; texts in which one must occur; how many
#: times as frequent it must be in toxic texts; letters of a beginning.
ENTRIES, TEXTS, TIMES, LETTERS = 2000, 3, 6.0, (3, 12)

#: Letters that look like a Latin one, and digits and signs that stand for one.
LOOK_ALIKE = dict(zip(
    "аеіорсухѕјһԁԛԝкмтвнгαεικνορτυχɑɡⅼ", "aeiopcyxsjhdqwkmtbhraeiknoptuxagl", strict=True))
STAND_IN = dict(zip("0134578@$", "oieastbas", strict=True))
NO_WIDTH = "­​‌‍⁠﻿"

_FOLD = str.maketrans(LOOK_ALIKE | dict.fromkeys(NO_WIDTH, None))
_STAND_IN = str.maketrans(STAND_IN)
_MIXED = re.compile(r"[^\W_]*[0134578@$]+[^\W_][^\W_@$]*|[^\W_]+[0134578]+")
_WORDS = re.compile(r"[^\W_]+")


def _letters(found: re.Match) -> str:
    word = found[0]
    return word.translate(_STAND_IN) if any(c.isalpha() for c in word) else word


def words(text: str) -> list[str]:
    """Folded words. Compatibility forms are composed where there are other characters than
    Latin-1 ones; digits and signs are read as letters only inside words with letters."""
    folded = text.lower()
    if not folded.isascii():
        folded = unicodedata.normalize("NFKC", folded).translate(_FOLD)
    if re.search(r"[0134578@$]", folded):
        folded = _MIXED.sub(_letters, folded)
    return _WORDS.findall(folded)


@dataclass(frozen=True)
class Model:
    """lexicon: entry to weight; an entry that ends in a space is a whole word, others are
    beginnings of words. exceptions: words, or pairs of words with a space between."""

    lexicon: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    weights: tuple[float, ...] = ()
    constant: float | None = None


def matcher(model: Model):
    """text -> (words, weight of the hits, hits, words hit with the word before and after)."""
    automaton = ahocorasick.Automaton()
    for entry, weight in model.lexicon.items():
        automaton.add_word(" " + entry, (len(entry) + 1, weight))
    if model.lexicon:
        automaton.make_automaton()

    def match(text: str) -> tuple[int, float, int, list[tuple[str, str, str]]]:
        found = words(text)
        if not model.lexicon or not found:
            return len(found), 0.0, 0, []
        line = f" {' '.join(found)} "
        best: dict[int, float] = {}
        for end, (size, weight) in automaton.iter(line):
            at = end + 1 - size
            best[at] = max(weight, best.get(at, 0.0))
        total, hits, seen = 0.0, 0, []
        for at, weight in best.items():
            stop = line.index(" ", at + 1)
            word = line[at + 1: stop]
            before = line[line.rindex(" ", 0, at) + 1: at] if at else ""
            after = line[stop + 1: (line.find(" ", stop + 1) + 1 or len(line) + 1) - 1]
            if not model.exceptions.isdisjoint((word, f"{before} {word}", f"{word} {after}")):
                continue
            total, hits = total + weight, hits + 1
            seen.append((before, word, after))
        return len(found), total, hits, seen

    return match


def features(n: float, total: float, hits: float) -> tuple[float, ...]:
    """Weight of the hits by length, on the whole, and the length."""
    return total / (n + 30) ** 0.5, 20 * total / (n + 30), float(np.log1p(hits)), float(np.log1p(n)) / 4


def _beginnings(sample: DataFrame) -> DataFrame:
    """(entry, label, n, texts): occurrences of words and beginnings, summed in each task."""

    def run(batches):
        n: Counter = Counter()
        texts: Counter = Counter()

        def out():
            keys = list(n)
            batch = pa.record_batch([
                pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int32()),
                pa.array([n[k] for k in keys]), pa.array([texts[k] for k in keys]),
            ], ["entry", "label", "n", "texts"])
            n.clear(), texts.clear()
            return batch

        for batch in batches:
            for text, label in zip(common.texts(batch), batch.column("label").to_pylist()):
                own: Counter = Counter()
                for word, times in Counter(words(text)).items():
                    own[word + " "] += times
                    for size in range(LETTERS[0], min(len(word), LETTERS[1]) + 1):
                        own[word[:size]] += times
                for entry, times in own.items():
                    n[entry, label] += times
                    texts[entry, label] += 1
                if len(n) > 200_000:
                    yield out()
        if n:
            yield out()

    return common.mapped(sample, run, "entry string, label int, n long, texts long")


def chosen(rows: Iterable[tuple[str, int, int]], toxic_words: int, clean_words: int) -> dict[str, float]:
    """Lexicon out of (entry, toxic occurrences, clean occurrences): the most telling ones by
    the likelihood ratio, of nested ones just the most telling, of equals the longest."""

    def telling(t: int, c: int) -> float:
        share = toxic_words / (toxic_words + clean_words)
        e = share * (t + c)
        return t * np.log(t / e) + (c * np.log(c / (t + c - e)) if c else 0.0)

    lexicon: dict[str, float] = {}
    shorter: set[str] = set()
    for entry, t, c in sorted(rows, key=lambda r: (-telling(r[1], r[2]), -len(r[0]), r[0])):
        if entry in shorter or any(entry[:i] in lexicon for i in range(1, len(entry))):
            continue
        rate = (t + 0.5) / toxic_words / ((c + 0.5) / clean_words)
        lexicon[entry] = float(min(8.0, np.log(rate)))
        shorter.update(entry[:i] for i in range(1, len(entry)))
        if len(lexicon) == ENTRIES:
            break
    return lexicon


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Model:
    """Learns labels.toxic from at most `most` rows per label, never from rows left out."""
    sample = common.labelled_sample(docs, labels, "toxic", DIVISOR, LEFT_OUT, most)

    def sums(entry: DataFrame) -> DataFrame:
        toxic = F.col("label") == 1
        return entry.groupBy("entry").agg(
            F.sum(F.when(toxic, F.col("n")).otherwise(0)).alias("t"),
            F.sum(F.when(toxic, 0).otherwise(F.col("n"))).alias("c"),
            F.sum(F.when(toxic, F.col("texts")).otherwise(0)).alias("tt"))

    entries = common.settled(sums(_beginnings(sample)))
    whole = entries.filter(F.col("entry").endswith(" ")).agg(F.sum("t"), F.sum("c")).first()
    toxic_words, clean_words = int(whole[0] or 0), int(whole[1] or 0)
    if not toxic_words or not clean_words:
        return Model(constant=1.0 if toxic_words else 0.0)
    likely = entries.filter(
        (F.col("tt") >= TEXTS)
        & (F.col("t") * float(clean_words) >= TIMES * float(toxic_words) * (F.col("c") + 0.5)))
    # many more than ENTRIES, as nested ones go; the order is by the evidence
    rows = likely.orderBy(F.col("t") - F.col("c") * (toxic_words / clean_words), "entry", ascending=False).limit(
        20 * ENTRIES).select("entry", "t", "c").collect()
    plain = Model(chosen([tuple(r) for r in rows], toxic_words, clean_words))

    def run(batches):
        match = matcher(plain)
        for batch in batches:
            out = [match(t) for t in common.texts(batch)]
            yield pa.record_batch([
                batch.column("label"), pa.array([x[0] for x in out], pa.int64()),
                pa.array([[p for b, w, a in x[3] for p in {w, f"{b} {w}", f"{w} {a}"}] for x in out], pa.list_(pa.string())),
            ], ["label", "n", "phrases"])

    hit = common.mapped(sample, run, "label int, n long, phrases array<string>")
    phrases = hit.select("label", F.explode("phrases").alias("entry")).groupBy("entry").agg(
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("label") == 1, 0).otherwise(1)).alias("c"))
    clean = phrases.filter(
        (F.col("c") >= TEXTS) & (F.col("t") * float(clean_words) <= float(toxic_words) * F.col("c")))
    excepted = frozenset(r.entry for r in clean.orderBy(F.col("c").desc(), "entry").limit(ENTRIES).collect())
    model = Model(plain.lexicon, excepted)

    def measured(batches):
        match = matcher(model)
        for batch in batches:
            x = np.array([features(*match(t)[:3]) for t in common.texts(batch)]).reshape(-1, 4)
            yield pa.record_batch(
                [batch.column("label"), *(pa.array(c) for c in x.T)], ["label", "a", "b", "c", "d"])

    found = np.array([tuple(r) for r in common.mapped(
        sample, measured, "label int, a double, b double, c double, d double").collect()], float)
    weights = common.logistic(found[:, 1:], found[:, 0], ridge=0.3)
    return Model(plain.lexicon, excepted, tuple(weights.tolist()))


def scorer(model: Model):
    """texts -> scores."""
    if model.constant is not None:
        return lambda texts: np.full(len(texts), model.constant)
    match, weights = matcher(model), np.array(model.weights)
    return lambda texts: common.probability(
        np.array([features(*match(t)[:3]) for t in texts]).reshape(-1, 4), weights)


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, score) of every whole text: 0 to 1, higher the likelier toxic.

    Null texts count as empty. Repeated rows are scored alike; other columns are not read.
    Where a label was never seen, all texts get 1 (only toxic ones seen) or 0.
    """

    def run(batches):
        scores = scorer(model)
        for batch in batches:
            yield pa.record_batch([batch.column(key), pa.array(scores(common.texts(batch)))], [key, "score"])

    kind = docs.schema[key].dataType.simpleString()
    return common.mapped(docs.select(key, "text"), run, f"{key} {kind}, score double")


def harmless(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all columns, whose texts score below the threshold."""

    def keeps():
        scores = scorer(model)
        return lambda texts: scores(texts) < threshold

    return common.kept(docs, keeps)
