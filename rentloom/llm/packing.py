"""Packing of token ids into windows by minimum bin slack.

Documents are tokenised and packed where they lie, without a shuffle: a task gathers pieces
until it holds a bounded number of ids, packs them, and goes on. Within such a buffer whole
windows are cut off long documents first. What remains is a multiset of lengths below the
window, and each window takes the sub-multiset that comes closest to its capacity, found by
a subset-sum over a bitset and read off by backtracking the counts.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentloom.llm import common

WINDOW = 1024
#: Ids that a task holds before it packs them.
HELD = 1 << 21
#: Id that ends each document.
STOP = 0
#: Documents encoded at once.
AT_ONCE = 4000
#: Characters encoded at once.
LONG = 1 << 25
#: A space after which the text may not be cut before.
ODD_SPACE = re.compile(r" (?:\s|$)")


class Encoder:
    """Ids of texts, as the tokenizers library gives them for a byte-level vocabulary file
    (whose words take one leading space) without special tokens added.

    Text is cut before every single space that a printing character follows. No word of the
    vocabulary's pattern spans such a place, so each different part is encoded once per
    batch. Ranks are the vocabulary's ids; that its merges stand in that order is checked
    here, and equal ids by the tests.
    """

    #: Fixed value: how the byte-level vocabulary cuts text into words.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        vocabulary = known["model"]["vocab"]
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))]
                  for m in known["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"the merges of {path} are not in the order of their ids")
        self.special = {t["content"]: t["id"] for t in known["added_tokens"]}
        to_byte = byte_of_letter()
        ranks = {bytes(to_byte[c] for c in token): i for token, i in vocabulary.items() if token not in self.special}
        self.encoding = tiktoken.Encoding(
            "file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.spaced = np.zeros(max([*ranks.values(), *self.special.values()]) + 1, bool)
        self.spaced[[i for token, i in ranks.items() if token[0] == 32]] = True

    def one(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode(text, allowed_special="all"), "<u4")

    def spellings(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, each after a space, and where each part's begin. Only the first
        token of a part starts with a space."""
        if len(parts) == 0:
            return np.empty(0, "<u4"), np.zeros(1, np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(parts)], parts), " ")
        ids = np.array(self.encoding.encode_ordinary(" " + joined[0].as_py()), "<u4")
        starts = np.append(np.flatnonzero(self.spaced[ids]), len(ids))
        if len(starts) != len(parts) + 1:
            raise AssertionError("parts and their ids differ in number")
        return ids, starts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if sum(map(len, texts)) > LONG:
            if len(texts) == 1:
                return [self.one(texts[0])]
            half = len(texts) // 2
            return self.encode(texts[:half]) + self.encode(texts[half:])
        odd = [i for i, t in enumerate(texts)
               if ODD_SPACE.search(t) or any(s in t for s in self.special)]
        plain = list(texts)
        for i in odd:
            plain[i] = ""
        lists = pc.split_pattern(pa.array(plain, pa.string()), " ")
        edges, values = lists.offsets.to_numpy(), lists.flatten()
        later = np.ones(len(values), bool)
        later[edges[:-1]] = False  # every text has a first part
        coded = pc.dictionary_encode(values.filter(pa.array(later)))
        ids, starts = self.spellings(coded.dictionary)
        spelled = pa.LargeListArray.from_arrays(starts, pa.array(ids)).take(coded.indices)
        flat, ends = spelled.flatten().to_numpy(), spelled.offsets.to_numpy()
        cuts = ends[edges - np.arange(len(edges))]
        out = [np.concatenate((self.one(values[a].as_py()), flat[b:c]))
               for a, b, c in zip(edges[:-1].tolist(), cuts[:-1].tolist(), cuts[1:].tolist())]
        for i in odd:
            out[i] = self.one(texts[i])
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each worker process, which runs many tasks."""
    return Encoder(path)


def byte_of_letter() -> dict[str, int]:
    """Which byte each letter of a byte-level vocabulary stands for: printing Latin-1
    characters for themselves, the others in order from code point 256 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printing]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}


def fill(counts: np.ndarray, capacity: int) -> list[int]:
    """Lengths of the sub-multiset of counts (counts[l] pieces of length l) whose sum is the
    largest up to capacity; of several, the one that uses the longest lengths first.

    reach[i] is a bitset (an integer) of the sums that the first i kinds of length can make.
    A count c is added as parts 1, 2, 4, ... and a rest, so kinds cost their logarithm.
    """
    kinds = [int(x) for x in np.flatnonzero(counts)[::-1] if x <= capacity]
    full = (1 << capacity + 1) - 1
    reach, parts = [1], []
    for length in kinds:
        left, size = min(int(counts[length]), capacity // length), 1
        while left > 0:
            take = min(size, left)
            parts.append((length, take))
            reach.append((reach[-1] | reach[-1] << length * take) & full)
            left -= take
            size *= 2
        if reach[-1] >> capacity & 1:
            break
    total, taken = reach[-1].bit_length() - 1, []
    for i in range(len(parts) - 1, -1, -1):
        if reach[i] >> total & 1:
            continue  # can be made without this part
        length, take = parts[i]
        taken += [length] * take
        total -= length * take
    return taken


def plan(counts: np.ndarray, capacity: int) -> list[list[int]]:
    """Windows, each a list of lengths, that use up the multiset. The longest length left
    goes first; the rest of its window is filled with the least slack. A filling that the
    counts allow again is repeated without another search."""
    counts, windows = counts.copy(), []
    longest = len(counts) - 1
    while True:
        while longest > 0 and counts[longest] == 0:
            longest -= 1
        if longest == 0:
            return windows
        counts[longest] -= 1
        chosen = [longest, *fill(counts[: longest + 1], capacity - longest)]
        counts[longest] += 1
        used = np.bincount(chosen, minlength=len(counts))
        at = np.flatnonzero(used)
        times = int((counts[at] // used[at]).min())
        counts[at] -= times * used[at]
        windows += [chosen] * times


def powers(n: int) -> list[int]:
    """n as a sum of different powers of two, the largest first."""
    return [1 << i for i in range(n.bit_length() - 1, -1, -1) if n >> i & 1]


def placed(lengths: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of documents so long.

    Whole windows are cut off first. A window that stays unfilled is cut at powers of two,
    which need no padding either.
    """
    sequence = 0
    whole = lengths // capacity
    for doc in np.flatnonzero(whole).tolist():
        for i in range(int(whole[doc])):
            yield doc, i * capacity, capacity, sequence, 0
            sequence += 1
    rest = lengths % capacity
    order = np.argsort(rest, kind="stable")
    firsts = np.searchsorted(rest[order], np.arange(capacity + 1))
    next_of = firsts[:-1].copy()
    for window in plan(np.bincount(rest, minlength=capacity) * (np.arange(capacity) > 0), capacity):
        room = [capacity] if sum(window) == capacity else powers(sum(window))
        offset = 0
        for length in window:
            doc = int(order[next_of[length]])
            next_of[length] += 1
            start = int(whole[doc]) * capacity
            while length:
                take = min(length, room[0] - offset)
                yield doc, start, take, sequence, offset
                start, length, offset = start + take, length - take, offset + take
                if offset == room[0]:
                    room, offset, sequence = room[1:], 0, sequence + 1


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, held: int = HELD) -> DataFrame:
    """Pieces of the documents' ids: doc_id, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset.

    Each document's ids are its text's (null: none) and a closing STOP. Every id lies in one
    piece, every sequence has at most `window` ids and is either full or as long as a power
    of two. window must be a power of two. sequence_id holds the partition in its upper
    bits, as monotonically_increasing_id does. Repeated rows are documents of their own and
    other columns are not read; an empty table gives no piece. A document longer than
    `held` is packed alone.
    """

    def run(batches):
        encode = encoder(tokenizer).encode
        sequence = TaskContext.get().partitionId() << 33
        stop = np.array([STOP], "<u4")
        keys, ids, total = [], [], 0

        def flushed():
            nonlocal sequence
            lengths = np.array([len(x) for x in ids], np.int64)
            rows = list(placed(lengths, window))
            for at in range(0, len(rows), 2000):
                part = rows[at: at + 2000]
                doc, start, length, place, offset = map(list, zip(*part))
                yield pa.record_batch([
                    pa.array([keys[d] for d in doc], kind), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array([ids[d][s: s + n].tobytes() for d, s, n in zip(doc, start, length)], pa.binary()),
                    pa.array(lengths[doc], pa.int64()),
                    pa.array([sequence + p for p in place], pa.int64()), pa.array(offset, pa.int64()),
                ], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
            sequence += rows[-1][3] + 1

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                for key, found in zip(part.column("doc_id").to_pylist(), encode(common.texts(part))):
                    keys.append(key)
                    ids.append(np.append(found, stop))
                    total += len(ids[-1])
                    if total >= held:
                        yield from flushed()
                        keys, ids, total = [], [], 0
        if ids:
            yield from flushed()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return common.mapped(
        docs.select("doc_id", "text"), run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long")


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Packed pieces with a checksum in place of their ids."""
    return pack(docs, tokenizer, window).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")
