"""Byte-pair encoding by speculation: guess greedily, check pairs, merge only where wrong.

A word's tokens are guessed by the longest match from the left. The guess is what merging
would give if merging every two neighbouring tokens' letters gives back those two (no
merge then ever crosses a border between tokens, whatever stands beside them). Each pair is
judged once by exact merging and looked up ever after; all pairs of a batch's words are
checked as arrays. Words with a pair that fails are merged exactly.
"""

from __future__ import annotations

import functools
import gc
import heapq
import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentloom.llm import common
from rentloom.llm.packing import byte_of_letter

#: Documents encoded at once, and their characters.
AT_ONCE, LONG = 4000, 1 << 25
#: Pairs of tokens whose verdict is kept.
VERDICTS = 2_000_000
#: Parts of texts that a worker remembers with their ids, and the longest of them. There are two
#: such tables; the older one goes when the newer one is full.
REMEMBERED, SHORT = 150_000, 48
#: Letters of a word that is merged in a plain list.
PLAIN = 32
#: Letters by which the longest token that starts with them is looked up.
PREFIX = 3
#: White space on which Python and the vocabulary's rules differ.
ODD = re.compile("[\x1c-\x1f\x85\u180e\u200b\ufeff]")
SPACE = regex.compile(r"\p{White_Space}+")


class Vocabulary:
    """Rules of a vocabulary file of byte-pair kind whose words end in a suffix.

    Read for files with composed, lower-case text, words cut by one pattern with the rest
    thrown away, and no decoder (tokens are then joined by spaces); others are refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        model = known["model"]
        kinds = [n["type"] for n in (known["normalizer"] or {}).get("normalizers", [])]
        split = ((known["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        if (model["type"] != "BPE" or not model["end_of_word_suffix"] or known["decoder"] is not None
                or kinds != ["NFC", "Replace", "Lowercase"] or split.get("behavior") != "Removed" or not split["invert"]):
            raise ValueError(f"{path} has other rules than those implemented")
        self.suffix = model["end_of_word_suffix"]
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.special = {t["content"]: t["id"] for t in known["added_tokens"]}
        self.id_of = {t: i for t, i in model["vocab"].items()}
        self.rank = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): r for r, m in enumerate(model["merges"])}
        size = max([*self.id_of.values(), *self.special.values()]) + 1
        names = [""] * size
        for t, i in [*self.id_of.items(), *self.special.items()]:
            names[i] = t
        self.tokens, self.names = names, pa.array(names, pa.string())
        # longest match: tokens that end a word, by their letters, and all others
        self.last = {t[: -len(self.suffix)]: i for t, i in self.id_of.items() if t.endswith(self.suffix)}
        self.inner = {t: i for t, i in self.id_of.items() if not t.endswith(self.suffix)}
        self.reach: dict[str, int] = {}
        for t in self.inner:
            for n in range(1, min(len(t), PREFIX) + 1):
                if n == PREFIX or n == len(t):
                    self.reach[t[:n]] = max(self.reach.get(t[:n], 0), len(t))
        self.longest = max(map(len, [*self.last, *self.inner]))
        self.fresh: dict[str, bytes] = {}
        self.stale: dict[str, bytes] = {}
        letter = {b: c for c, b in byte_of_letter().items()}
        self.letters = {chr(b): letter[b] for b in range(256)}
        self.marks = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.verdict: dict[int, bool] = {}

    # --- one word -------------------------------------------------------------

    def exact(self, pieces: list[str]) -> list[str]:
        """Merges the pair of the lowest rank, leftmost first, until none is left. Kept as a
        linked list with a heap, so a long word costs little more than its length; a short one
        in a plain list, which costs less there."""
        n = len(pieces)
        if n <= PLAIN:
            return self._exact_short(list(pieces))
        pieces, after, before = list(pieces), [*range(1, n), -1], [-1, *range(n - 1)]
        rank = self.rank
        heap = [(r, i, pieces[i], pieces[i + 1]) for i in range(n - 1)
                if (r := rank.get((pieces[i], pieces[i + 1]))) is not None]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j < 0 or pieces[i] != a or pieces[j] != b:
                continue
            pieces[i], gone[j], after[i] = a + b, True, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (r := rank.get((pieces[left], pieces[right]))) is not None:
                    heapq.heappush(heap, (r, left, pieces[left], pieces[right]))
        return [p for p, g in zip(pieces, gone) if not g]

    def _exact_short(self, pieces: list[str]) -> list[str]:
        rank, none = self.rank.get, len(self.rank)
        ranks = [rank(pair, none) for pair in zip(pieces, pieces[1:])]
        while ranks and (least := min(ranks)) < none:
            i = ranks.index(least)
            pieces[i: i + 2] = [pieces[i] + pieces[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank((pieces[i], pieces[i + 1]), none)
            if i:
                ranks[i - 1] = rank((pieces[i - 1], pieces[i]), none)
        return pieces

    def spelled(self, letters: str, ends: bool) -> list[str]:
        return [*letters[:-1], letters[-1] + self.suffix] if ends else list(letters)

    def guess(self, letters: str) -> list[int]:
        """Ids of the longest matches from the left; every single letter is a token."""
        out, at, n = [], 0, len(letters)
        last, inner, longest, reach = self.last, self.inner, self.longest, self.reach
        while at < n:
            if n - at <= longest and (i := last.get(letters[at:] if at else letters)) is not None:
                out.append(i)
                break
            # no token is longer than the longest one with these first letters
            most = reach.get(letters[at: at + PREFIX], PREFIX - 1)
            for size in range(min(most, n - at - 1) or 1, 0, -1):
                if (i := inner.get(letters[at: at + size])) is not None:
                    out.append(i)
                    at += size
                    break
        return out

    # --- pairs ----------------------------------------------------------------

    def holds(self, left: int, right: int) -> bool:
        """Whether merging the letters of two tokens gives those tokens; left < 0: of one."""
        names = ([self.tokens[left]] if left >= 0 else []) + [self.tokens[right]]
        joined = "".join(names)
        ends = joined.endswith(self.suffix)
        return self.exact(self.spelled(joined[: -len(self.suffix)] if ends else joined, ends)) == names

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys, inverse = np.unique((left + 1) * (1 << 32) + right, return_inverse=True)
        if len(self.verdict) > VERDICTS:
            self.verdict.clear()
        verdicts = np.empty(len(keys), bool)
        for n, key in enumerate(keys.tolist()):
            if (known := self.verdict.get(key)) is None:
                known = self.verdict[key] = self.holds((key >> 32) - 1, key & 0xFFFFFFFF)
            verdicts[n] = known
        return verdicts[inverse]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of words given as letters."""
        guesses = [self.guess(w) for w in words]
        sizes = np.array([len(g) for g in guesses])
        flat = np.fromiter((i for g in guesses for i in g), np.int64, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        left = np.empty_like(flat)
        left[1:] = flat[:-1]
        left[starts] = -1  # the first token has no neighbour to the left
        # a token with a right neighbour is judged with it, so just words of one token are judged alone
        alone = np.zeros(len(flat), bool)
        alone[starts] = sizes > 1
        fine = np.ones(len(flat), bool)
        fine[~alone] = self.compatible(left[~alone], flat[~alone])
        for at in np.flatnonzero(~np.logical_and.reduceat(fine, starts)).tolist():
            guesses[at] = [self.id_of[t] for t in self.exact(self.spelled(words[at], True))]
        return guesses

    # --- texts ----------------------------------------------------------------

    def normal(self, text: str) -> str:
        """Composed and lower-cased letter by letter, so a sigma never takes its final form."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def parts(self, chunk: str) -> list[str | int]:
        """Words (as letters) and special ids of a text without white space."""
        if chunk.isascii() and chunk.isalpha():
            return [chunk.lower()]
        out: list[str | int] = []
        at = 0
        for mark in [*self.marks.finditer(chunk), None]:
            piece = chunk[at: mark.start() if mark else len(chunk)]
            for word in self.pattern.findall(self.normal(piece)):
                raw = word.encode("utf-8", "surrogatepass").decode("latin-1")
                out.append("".join(map(self.letters.__getitem__, raw)))
            if mark:
                out.append(self.special[mark[0]])
                at = mark.end()
        return out

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        parts = [self.parts(c) for c in chunks]
        words = list(dict.fromkeys(p for ps in parts for p in ps if isinstance(p, str)))
        ids = dict(zip(words, self.encode_words(words))) if words else {}
        return [[i for p in ps for i in (ids[p] if isinstance(p, str) else (p,))] for ps in parts]

    def remembered(self, chunks: list[str]) -> list[bytes]:
        """Ids of different chunks, as 32-bit integers in bytes; short chunks are kept for the
        batches that follow."""
        if len(self.fresh) > REMEMBERED:
            self.stale, self.fresh = self.fresh, {}
        fresh, stale, lacking = self.fresh, self.stale, []
        for c in chunks:
            if c not in fresh:
                if (ids := stale.get(c)) is None:
                    lacking.append(c)
                else:
                    fresh[c] = ids
        found = {c: array("i", ids).tobytes() for c, ids in zip(lacking, self.encode_chunks(lacking))}
        fresh.update((c, ids) for c, ids in found.items() if len(c) <= SHORT)
        return [found[c] if c in found else fresh[c] for c in chunks]

    def encode(self, texts: list[str]) -> pa.Array:
        """list<int32> of ids; no token spans white space, so each different part between
        white space is encoded once."""
        odd = {i for i, t in enumerate(texts) if ODD.search(t)}
        plain = [SPACE.sub(" ", t) if i in odd else t for i, t in enumerate(texts)]
        pieces = pa.array([t.split(" ") if i in odd else t.split() for i, t in enumerate(plain)], pa.list_(pa.string()))
        coded = pc.dictionary_encode(pieces.flatten())
        spelled = self.remembered(coded.dictionary.to_pylist())
        ends = np.cumsum([0, *map(len, spelled)]) // 4
        ids = pa.array(np.frombuffer(b"".join(spelled), np.int32))
        taken = pa.LargeListArray.from_arrays(ends, ids).take(coded.indices)
        cuts = taken.offsets.to_numpy()[pieces.offsets.to_numpy()]
        return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), taken.flatten())

    def decode(self, ids: pa.Array) -> pa.Array:
        """Texts of lists of ids: names joined by spaces, special ones too."""
        named = pa.ListArray.from_arrays(ids.offsets, self.names.take(ids.values))
        return pc.binary_join(named, " ")


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    """One for each worker process, which runs many tasks. It is never garbage, so it is taken out
    of what the collector looks through."""
    known = Vocabulary(path)
    gc.freeze()
    return known


def _slices(sizes: list[int], rows: int, total: int):
    """Ranges of rows of at most `rows` rows and, but for single rows, `total` size."""
    at = 0
    while at < len(sizes):
        end, held = at + 1, sizes[at]
        while end < len(sizes) and end - at < rows and held + sizes[end] <= total:
            held += sizes[end]
            end += 1
        yield at, end
        at = end


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """(key, ids) of every whole text, as the tokenizers library encodes with the file
    `tokenizer` and without adding special tokens; special strings inside a text give their
    ids. Null texts count as empty and have no ids. Repeated rows each come out, other
    columns are not read, an empty table gives an empty result."""

    def run(batches):
        rules = vocabulary(tokenizer)
        for batch in batches:
            texts = common.texts(batch)
            for a, b in _slices(list(map(len, texts)), AT_ONCE, LONG):
                yield pa.record_batch([batch.column(key).slice(a, b - a), rules.encode(texts[a:b])], [key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return common.mapped(docs.select(key, "text"), run, f"{key} {kind}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the text of the ids with special tokens kept."""

    def run(batches):
        rules = vocabulary(tokenizer)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_pylist()
            for a, b in _slices(sizes, AT_ONCE, LONG):
                part = pa.concat_arrays([batch.column("ids").slice(a, b - a)])
                yield pa.record_batch([batch.column(key).slice(a, b - a), part, rules.decode(part)], [key, "ids", "decoded"])

    kind = encoded.schema[key].dataType.simpleString()
    return common.mapped(encoded.select(key, "ids"), run, f"{key} {kind}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): what encode gives and what decode makes of it, in one pass."""

    def run(batches):
        rules = vocabulary(tokenizer)
        for batch in batches:
            texts = common.texts(batch)
            for a, b in _slices(list(map(len, texts)), AT_ONCE, LONG):
                ids = rules.encode(texts[a:b])
                yield pa.record_batch([batch.column(key).slice(a, b - a), ids, rules.decode(ids)], [key, "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    return common.mapped(docs.select(key, "text"), run, f"{key} {kind}, ids array<int>, decoded string")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Counts and checksums of the ids and of the text decoded from them."""
    found = round_trip(docs, tokenizer)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
