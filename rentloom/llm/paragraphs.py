"""Repeated passages, by MinHash bands over paragraphs and by word runs that fit anywhere.

A paragraph is a line, or neighbouring lines that are hard-wrapped (their lines are then
paragraphs too). Paragraphs are sketched by MinHash over shingles of five words; those that
collide in a band are joined, compared by their exact Jaccard similarity, and clustered by
connected components. A passage may also stand inside longer lines or run over line ends, so
runs of GRAM words are picked from every text, one at least of any WINDOW neighbours and by their
words alone: whatever RUN words two places share, a picked run is among them. Places that
share picked runs are compared on their texts and extended word by word to both sides.
Of each cluster the first place (by doc_id, then position) stays.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentloom.llm import common
from rentloom.llm.components import components
from rentloom.llm.language import mixed
from rentloom.llm.simhash import cell_pairs, forest
from rentloom.session import delete_folder

#: Words of a shingle and least similarity of lines.
WORDS, LIKE = 5, 0.8
#: Bands and rows of a band: a pair at LIKE collides with 1 - (1 - LIKE**ROWS)**BANDS = 99.8 %.
BANDS, ROWS = 6, 2
#: Least words of a paragraph that is removed, and of a passage inside lines that is told. Shorter
#: paragraphs are told too, but they are headings and phrases that documents share and keep.
HEADING, RUN = 10, 20
#: Most characters of a hard-wrapped line.
WIDE = 200
#: Words of a run that is picked, and neighbouring runs of which one is: RUN words hold a window.
GRAM = RUN // 2 + 1
WINDOW = RUN - GRAM + 1
#: Words to either side of a match that are compared with its first place.
BESIDE = WINDOW
#: Words to either side of a picked run of which four bits each go with it.
NEAR = 8
#: A character of a script that writes no spaces between words, and a word.
UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")
WORD = regex.compile(rf"{UNSPACED.pattern}|(?:(?!{UNSPACED.pattern})\S)+")
#: Documents and characters worked on at once.
AT_ONCE, CHUNK = 2000, 1 << 22


@functools.cache
def _space() -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[c for c in range(0x3001) if chr(c).isspace()]] = True
    return out


@functools.cache
def _unspaced() -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[m.start() for m in UNSPACED.finditer("".join(map(chr, range(0x110000))))]] = True
    return out


#: Multipliers of XXH64.
FIRST, SECOND, THIRD, FOURTH, FIFTH = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """XXH64 of the words data[offsets[i]: offsets[i + 1]], all at once but for those of 32 bytes
    and more: nearly every word is shorter, and new in large texts."""
    start, size = offsets[:-1], np.diff(offsets)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    out = size.astype(np.uint64) + FIFTH
    for i in range(3):
        on = np.flatnonzero(size >= 8 * i + 8)
        value = _turned(eight[start[on] + 8 * i] * SECOND, 31) * FIRST
        out[on] = _turned(out[on] ^ value, 27) * FIRST + FOURTH
    on = np.flatnonzero(size & 4)
    value = (eight[start[on] + (size[on] & -8)] & np.uint64(0xFFFFFFFF)) * FIRST
    out[on] = _turned(out[on] ^ value, 23) * SECOND + THIRD
    for i in range(3):
        on = np.flatnonzero((size & 3) > i)
        value = padded[start[on] + (size[on] & -4) + i].astype(np.uint64) * FIFTH
        out[on] = _turned(out[on] ^ value, 11) * FIRST
    out = (out ^ (out >> np.uint64(33))) * SECOND
    out = (out ^ (out >> np.uint64(29))) * THIRD
    out ^= out >> np.uint64(32)
    for i in np.flatnonzero(size >= 32).tolist():
        out[i] = xxhash.xxh64_intdigest(data[offsets[i]: offsets[i + 1]].tobytes())
    return out


class Words:
    """Words of many texts as one array of hashes, with the text, line and place of each.

    Words are runs without white space, lower-cased; in scripts that write no spaces every
    character is one."""

    def __init__(self, texts: list[str]):
        groups: dict[str, list[int]] = {"ascii": [], "utf-32-le": [], "unspaced": []}
        for i, t in enumerate(texts):
            groups["ascii" if t.isascii() else "unspaced" if self._has_unspaced(t) else "utf-32-le"].append(i)
        parts = [self._spaced(texts, groups[code], code) for code in ("ascii", "utf-32-le") if groups[code]]
        parts += [self._by_pattern(texts[i], i) for i in groups["unspaced"]]
        parts = parts or [(np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 4)]
        joined = [np.concatenate(x) for x in zip(*parts)]
        if len(parts) > 1:
            order = np.argsort(joined[1], kind="stable")
            joined = [x[order] for x in joined]
        self.hash, self.text, self.start, self.end, self.line = joined

    @staticmethod
    def _has_unspaced(text: str) -> bool:
        return bool(_unspaced()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].any())

    @staticmethod
    def _by_pattern(text: str, i: int):
        places = [m.span() for m in WORD.finditer(text)]
        words = [text[a:b].lower().encode("utf-8", "surrogatepass") for a, b in places]
        offsets = np.append(0, np.cumsum([len(w) for w in words], dtype=np.int64))
        hashes = digests(np.frombuffer(b"".join(words), np.uint8), offsets)
        start, end = np.array(places, np.int64).reshape(-1, 2).T
        ends = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 10)
        return hashes, np.full(len(start), i), start, end, np.searchsorted(ends, start)

    @staticmethod
    def _spaced(texts: list[str], which: list[int], code: str):
        """Words of the texts that `which` names, looked at as one text."""
        joined = " ".join([texts[i] for i in which])

        def points(text: str) -> np.ndarray:
            return np.frombuffer(text.encode(code, "surrogatepass"), np.uint8 if code == "ascii" else np.uint32)

        def edges(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            space = np.concatenate(([True], _space()[codes], [True]))
            found = np.flatnonzero(space[1:] != space[:-1])
            return space[1:-1], found[0::2], found[1::2]

        codes, lower = points(joined), points(joined.lower())
        _, start, end = edges(codes)
        # small letters may be more characters, never more words
        space, first, last = edges(lower)
        if len(first) != len(start):
            raise AssertionError("words and their places differ in number")
        letters, offsets = lower[~space], np.append(0, np.cumsum(last - first))
        if code != "ascii":
            size = 1 + (letters >= 0x80).astype(np.int8) + (letters >= 0x800) + (letters >= 0x10000)
            offsets = np.append(0, np.cumsum(size, dtype=np.int64))[offsets]
            text = letters.tobytes().decode(code, "surrogatepass").encode("utf-8", "surrogatepass")
            letters = np.frombuffer(text, np.uint8)
        begin = np.append(0, np.cumsum([len(texts[i]) + 1 for i in which]))
        text = np.repeat(np.arange(len(which)), np.diff(np.searchsorted(start, begin)))
        # line ends before a word, less those before its text
        ends = np.flatnonzero(codes == 10)
        lines = np.repeat(np.arange(len(ends) + 1), np.diff(np.concatenate(([0], np.searchsorted(start, ends), [len(start)]))))
        lines -= np.searchsorted(ends, begin[:-1])[text]
        return digests(letters, offsets), np.array(which)[text], start - begin[text], end - begin[text], lines

    def firsts(self) -> np.ndarray:
        """Where a new text or line begins."""
        new = np.ones(len(self.hash), bool)
        new[1:] = (self.text[1:] != self.text[:-1]) | (self.line[1:] != self.line[:-1])
        return new

    def runs(self, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of words and hash of every run that starts where begins says."""
        first = np.flatnonzero(begins)
        if len(first) == 0:
            return first, first, np.empty(0, np.uint64)
        size = np.diff(np.append(first, len(self.hash)))
        place = (np.arange(len(self.hash)) - np.repeat(first, size)).astype(np.uint64)
        summed = np.add.reduceat(mixed(self.hash + place * np.uint64(0x9E3779B97F4A7C15)), first)
        return first, size, mixed(summed + size.astype(np.uint64))

    def paragraphs(self, wide: int = WIDE):
        """First word, number of words, hash, number and owner of the lines and of the
        paragraphs that hard-wrapped lines form.

        Neighbours without a blank line between them, of at most `wide` characters, are
        wrapped alike; a line goes on in the next one unless it has less than half of the
        longest one's characters. Numbers of lines are odd, those of paragraphs even and
        before their lines'; the owner is the first line of the paragraph around."""
        first, size, digest = self.runs(self.firsts())
        n = len(first)
        if n == 0:
            return first, first, digest, first, first
        text, line = self.text[first], self.line[first]
        width = self.end[first + size - 1] - self.start[first]
        near = (text[1:] == text[:-1]) & (line[1:] == line[:-1] + 1) & (np.maximum(width[1:], width[:-1]) <= wide)
        run = np.flatnonzero(np.append(True, ~near))
        widest = np.repeat(np.maximum.reduceat(width, run), np.diff(np.append(run, n)))
        head = np.flatnonzero(np.append(True, ~(near & (2 * width >= widest)[:-1])))
        count = np.diff(np.append(head, n))
        owner = np.repeat(line[head], count)
        begins = np.zeros(len(self.hash), bool)
        begins[first[head]] = True
        joined = [x[count > 1] for x in (*self.runs(begins), 2 * line[head], line[head])]
        return [np.concatenate(x) for x in zip((first, size, digest, 2 * line + 1, owner), joined)]

    def picked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words and hashes of the runs of GRAM words that are the smallest, the rightmost
        of equals, of WINDOW neighbours in one text, wherever lines end; and four bits of each of
        the NEAR words before (low half, nearest lowest) and after."""
        n = len(self.hash) - RUN + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
        runs = np.zeros(n + WINDOW - 1, np.uint64)
        for i in range(GRAM):
            runs *= np.uint64(0x9E3779B97F4A7C15)
            runs += self.hash[i: i + len(runs)]
        runs = mixed(runs)
        best, at = runs[:n].copy(), np.arange(n)
        for i in range(1, WINDOW):
            lower = runs[i: i + n] <= best
            at[lower] = np.flatnonzero(lower) + i
            np.minimum(best, runs[i: i + n], out=best)
        chosen = np.zeros(len(runs), bool)
        chosen[at[self.text[:n] == self.text[RUN - 1:]]] = True
        first = np.flatnonzero(chosen)
        near = np.zeros(len(first), np.uint64)
        for i in range(NEAR):
            for at, shift in ((first - 1 - i, 4 * i), (first + GRAM + i, 32 + 4 * i)):
                within = np.clip(at, 0, len(self.hash) - 1)
                here = (at == within) & (self.text[within] == self.text[first])
                bits = np.where(here, self.hash[within] >> np.uint64(60), np.uint64(0))
                near |= bits << np.uint64(shift)
        return first, runs[first], near

    def shingles(self, first: np.ndarray, size: np.ndarray, words: int = WORDS):
        """Hashes of the shingles of runs of at least `words` words: flat, and sizes."""
        n = len(self.hash) - words + 1
        whole = np.zeros(max(n, 0), np.uint64)
        for i in range(words):
            whole = mixed(whole + self.hash[i: i + n] + np.uint64(i + 1)) if n > 0 else whole
        count = size - words + 1
        at = np.repeat(first - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(int(count.sum()))
        return whole[at], count


def _chunks(batch: pa.RecordBatch):
    """Parts of a batch with their texts, bounded in rows and, but for one row, in size."""
    texts, at = common.texts(batch), 0
    while at < len(texts):
        end, held = at + 1, len(texts[at])
        while end < len(texts) and end - at < AT_ONCE and held + len(texts[end]) <= CHUNK:
            held += len(texts[end])
            end += 1
        yield batch.slice(at, end - at), texts[at:end]
        at = end


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def versions(docs: DataFrame) -> DataFrame:
    """(doc_id, version, text). Rows that share a doc_id but not the text differ in version, so
    that each text has places of its own; rows equal in both are the same places."""
    return docs.select("doc_id", F.hash("text").alias("version"), "text")


def _named(part: pa.RecordBatch, text: np.ndarray) -> list[pa.Array]:
    return [part.column(c).take(pa.array(text)) for c in ("doc_id", "version")]


SKETCH = (
    "doc_id long, version int, hash long, first_char int, end_char int, words int, line int, owner int, "
    "bands array<long>, word int, near long")


def sketched(docs: DataFrame, least: int = WORDS) -> DataFrame:
    """Paragraphs and passages of every text, found in one look at it.

    Paragraphs of `least` words or more (a shingle at least) have line and owner (number and
    owner as paragraphs() gives them), words, and bands, a hash for each band of the MinHash.
    Runs that picked() gives have word, the number of their first one, and near. Both have the hash of
    their words; paragraphs have their place as well.
    """
    names = [f.split()[0] for f in SKETCH.split(", ")]
    kinds = [pa.list_(pa.int64()) if n == "bands" else pa.int64() if n in ("doc_id", "hash", "near") else pa.int32() for n in names]

    def rows(part: pa.RecordBatch, text: np.ndarray, **columns) -> pa.RecordBatch:
        found = dict(zip(("doc_id", "version"), _named(part, text))) | {
            n: x if isinstance(x, pa.Array) else pa.array(x.astype(np.int32)) for n, x in columns.items()}
        return pa.record_batch([found.get(n, pa.nulls(len(text), k)) for n, k in zip(names, kinds)], names)

    def paragraphs(part: pa.RecordBatch, w: Words, seeds: np.ndarray):
        found = w.paragraphs()
        keep = found[1] >= max(least, WORDS)
        first, size, digest, number, owner = [x[keep] for x in found]
        if len(first) == 0:
            return
        flat, count = w.shingles(first, size)
        at = np.cumsum(count) - count
        smallest = np.stack([np.minimum.reduceat(mixed(flat ^ s), at) for s in seeds], axis=1)
        bands = smallest.reshape(-1, BANDS, ROWS)
        keys = mixed(bands[:, :, 0] + np.arange(BANDS, dtype=np.uint64))
        for r in range(1, ROWS):
            keys = mixed(keys ^ bands[:, :, r])
        offsets = pa.array(np.arange(len(first) + 1, dtype=np.int32) * BANDS)
        yield rows(
            part, w.text[first], hash=_signed(digest), first_char=w.start[first], end_char=w.end[first + size - 1], words=size,
            line=number, owner=owner, bands=pa.ListArray.from_arrays(offsets, _signed(keys.ravel())))

    def passages(part: pa.RecordBatch, w: Words):
        first, digest, near = w.picked()
        text = w.text[first]
        yield rows(part, text, hash=_signed(digest), near=_signed(near), word=first - np.searchsorted(w.text, text))

    def run(batches):
        seeds = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
        for batch in batches:
            for part, texts in _chunks(batch):
                w = Words(texts)
                yield from paragraphs(part, w, seeds)
                yield from passages(part, w)

    return common.mapped(versions(docs), run, SKETCH)


def lines_of(sketches: DataFrame) -> DataFrame:
    return sketches.filter("line is not null").select(
        "doc_id", "version", "line", "owner", "hash", "first_char", "end_char", "words", "bands")


def passages_of(sketches: DataFrame) -> DataFrame:
    return sketches.filter("word is not null").select("doc_id", "version", "word", "near", "hash")


def sets_of_lines(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(hash, shingles): distinct shingle hashes, sorted, of the paragraphs (doc_id,
    version, line) wanted."""
    by_doc = wanted.groupBy("doc_id", "version").agg(F.collect_set("line").alias("lines"))
    joined = versions(docs).join(by_doc, ["doc_id", "version"]).select("text", "lines")

    def run(batches):
        for batch in batches:
            for part, texts in _chunks(batch):
                w = Words(texts)
                first, size, digest, number, _ = w.paragraphs()
                asked = [set(x) for x in part.column("lines").to_pylist()]
                keep = np.array([line in asked[t] for t, line in zip(w.text[first].tolist(), number.tolist())], bool)
                first, size, digest = first[keep], size[keep], digest[keep]
                flat, count = w.shingles(first, size)
                sets = [np.unique(x) for x in np.split(flat, np.cumsum(count)[:-1])] if len(first) else []
                yield pa.record_batch(
                    [_signed(digest), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["hash", "shingles"])

    return common.mapped(joined, run, "hash long, shingles array<long>").dropDuplicates(["hash"])


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """256 bits of every set, those that the upper eight bits of its members name."""
    upper = [(s.view(np.uint64) >> np.uint64(56)).astype(np.int64) for s in sets]
    out = np.zeros((len(sets), 256), bool)
    out[np.repeat(np.arange(len(sets)), [len(u) for u in upper]), np.concatenate(upper or [np.empty(0, np.int64)])] = True
    return np.packbits(out, axis=1).view(np.uint64)


def similar(
    sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, like: float = LIKE, bits: np.ndarray | None = None,
) -> np.ndarray:
    """Which pairs of sorted sets have a Jaccard similarity of at least `like`, exactly. With their
    bitmaps, pairs are left out whose bits alone show too many members that the other has not."""
    out = np.zeros(len(left), bool)
    sizes = np.array([len(s) for s in sets], np.int64)
    a, b = sizes[left], sizes[right]
    most = np.minimum(a, b)
    if bits is not None:
        x, y = bits[left], bits[right]
        most = np.minimum(a - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), b - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))
    for i in np.flatnonzero(most >= like * (a + b - most) - 1e-9).tolist():
        a, b = sets[left[i]], sets[right[i]]
        both = len(np.intersect1d(a, b, assume_unique=True))
        out[i] = both >= like * (len(a) + len(b) - both) - 1e-9
    return out


def line_links(docs: DataFrame, lines: DataFrame, block: int = common.BLOCK) -> DataFrame:
    """(a, b): hashes that connect the same lines as all similar pairs do; of what is connected
    in a group of colliding lines each is named with the first one, never all pairs."""
    # lines of one hash have the same bands
    members = lines.select("hash", "bands").dropDuplicates(["hash"]).select("hash", F.explode("bands").alias("key"))
    cells = common.landed(common.compared_blocks(members, "key", "hash", block), "cells")
    # one place of every paragraph that is to be compared, to read its words at
    firsts = lines.groupBy("hash").agg(F.min(F.struct("doc_id", "version", "line")).alias("place"))
    wanted = firsts.join(cells.select("hash").distinct(), "hash").select("place.*")
    # written down, so that the texts' shuffle files go before the sets are dealt to the cells
    full = cells.join(common.landed(sets_of_lines(docs, wanted), "sets"), "hash")

    def run(batches):
        for table in common.whole_cells(batches, "key"):
            columns = [table.column(c).to_numpy() for c in ("key", "cell_a", "cell_b")]
            new = np.zeros(len(columns[0]), bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            own, same = table.column("own").to_numpy(), columns[1] == columns[2]
            flat = table.column("shingles").combine_chunks()
            edges, values = flat.offsets.to_numpy(), flat.values.to_numpy()
            sets = [values[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            bits, found, root = bitmaps(sets), [], np.arange(len(own))
            for left, right in cell_pairs(np.cumsum(new), own, same, 1 << 16):
                # what is connected already needs no comparison
                apart = root[left] != root[right]
                left, right = left[apart], right[apart]
                near = similar(sets, left, right, bits=bits)
                found.append((left[near], right[near]))
                root = forest(len(own), found)
            at = np.flatnonzero(root != np.arange(len(own)))
            name = table.column("hash").to_numpy()
            yield pa.record_batch([pa.array(name[at]), pa.array(name[root[at]])], ["a", "b"])

    return common.mapped(common.sorted_cells(full, "key"), run, "a long, b long").distinct()


def _places(rows: DataFrame, cluster: str, place: list[str], apart) -> DataFrame:
    """Rows of clusters that stand in two places or more, with the first of them; apart() says
    of kept and other, the first and last place, whether they are two.

    The clusters are summed up before the shuffle and joined back by an ordinary join."""
    at = F.struct("doc_id", "version", *place)
    summed = rows.groupBy(cluster).agg(F.min(at).alias("kept"), F.max(at).alias("other"))
    return rows.join(summed.filter("kept <> other"), cluster).filter(apart()).drop("other").withColumn(
        "removed", at != F.col("kept"))


def repeated_lines(docs: DataFrame, block: int = common.BLOCK, lines: DataFrame | None = None) -> DataFrame:
    """(doc_id, version, first_char, end_char, words, kept_doc_id, removed) of clustered
    paragraphs. A paragraph that is kept and a line of its own are one place, not two."""
    lines = lines_of(common.landed(sketched(docs), "sketches")) if lines is None else lines
    joined = components(line_links(docs, lines, block))
    named = lines.drop("bands").join(joined.withColumnRenamed("node", "hash"), "hash", "left").withColumn(
        "cluster", F.coalesce("component", "hash"))
    kept, other = F.col("kept"), F.col("other")

    def apart(place):
        within = [place[c] == kept[c] for c in ("doc_id", "version", "owner")]
        return ~(within[0] & within[1] & within[2] & (kept["line"] % 2 == 0))

    at = F.struct("doc_id", "version", "line", "owner")
    places = _places(named, "cluster", ["line", "owner"], lambda: apart(other)).filter(~F.col("removed") | apart(at))
    return places.select(
        "doc_id", "version", *[F.col(c).cast("long").alias(c) for c in ("first_char", "end_char", "words")],
        F.col("kept.doc_id").alias("kept_doc_id"), "removed").distinct()


#: Bytes of a mark: 128 bits over the words within, 32 of each word to either side, their numbers.
MARK = 16 + 2 * 4 * BESIDE + 2
AROUND = (
    "doc_id long, version int, a int, b int, mark binary, first_char int, end_char int, "
    "starts array<int>, ends array<int>")
VERIFIED = (
    "doc_id long, version int, kept_doc_id long, kept_version int, ahead int, a int, b int, before int, after int, "
    "first_char int, end_char int")


class _Marks:
    """Words first to end of some texts, number `text` of them: 128 bits of their hashes, and of
    the BESIDE words before (nearest first) and after them the number and 32 bits of each hash."""

    def __init__(self, w: Words, texts: int, text: np.ndarray, a: np.ndarray, b: np.ndarray):
        begin = np.searchsorted(w.text, np.arange(texts + 1))
        self.first, self.end = a + begin[text], b + begin[text]
        self.low, self.high = np.minimum(a, BESIDE), np.minimum(begin[text + 1] - self.end, BESIDE)
        self.bytes = np.zeros((len(text), MARK), np.uint8)
        data = memoryview(w.hash).cast("B")
        digests = b"".join(
            [xxhash.xxh3_128_digest(data[8 * i: 8 * j]) for i, j in zip(self.first.tolist(), self.end.tolist())])
        self.bytes[:, :16] = np.frombuffer(digests, np.uint8).reshape(-1, 16)
        step = np.arange(BESIDE)
        most = max(len(w.hash) - 1, 0)
        for at, count, place in (
            (self.first[:, None] - 1 - step, self.low, 16), (self.end[:, None] + step, self.high, 16 + 4 * BESIDE)):
            found = w.hash[np.clip(at, 0, most)] if len(w.hash) else np.zeros(at.shape, np.uint64)
            short = np.where(step < count[:, None], found & np.uint64(0xFFFFFFFF), np.uint64(0)).astype("<u4")
            self.bytes[:, place: place + 4 * BESIDE] = np.ascontiguousarray(short).view(np.uint8)
        self.bytes[:, -2], self.bytes[:, -1] = self.low, self.high

    def same(self, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether the words within are those of the other marks, and how many are beside them
        without a break, before and after."""
        sides = []
        for place, count in ((16, -2), (16 + 4 * BESIDE, -1)):
            here, there = [np.ascontiguousarray(x[:, place: place + 4 * BESIDE]).view("<u4") for x in (self.bytes, other)]
            alike = np.logical_and.accumulate(here == there, axis=1).sum(axis=1)
            sides.append(np.minimum(alike, np.minimum(self.bytes[:, count], other[:, count])))
        return (self.bytes[:, :16] == other[:, :16]).all(axis=1), *sides


def _asked(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, version, text, asked): texts with the rows of wanted that are about them."""
    key = ["doc_id", "version"]
    asked = F.collect_list(F.struct(*[c for c in wanted.columns if c not in key])).alias("asked")
    return versions(docs).join(wanted.groupBy(*key).agg(asked), key)


def _fields(part: pa.RecordBatch) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """Columns of the rows in asked, and the number of the text that each is about."""
    asked = part.column("asked")
    rows = asked.flatten()
    return asked.value_parent_indices().to_numpy(), dict(zip([f.name for f in rows.type], rows.flatten()))


def around(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Words a to b of the texts wanted: their mark, where they stand, and the starts and ends of
    the BESIDE words before (nearest first) and after them."""
    names = [f.split()[0] for f in AROUND.split(", ")]

    def lists(values: np.ndarray, first: np.ndarray, count: np.ndarray, step: int) -> pa.Array:
        ends = np.cumsum(count)
        at = np.repeat(first, count) + step * (np.arange(int(count.sum())) - np.repeat(ends - count, count))
        return pa.ListArray.from_arrays(
            pa.array(np.append(0, ends).astype(np.int32)), pa.array(values[at].astype(np.int32)))

    def run(batches):
        for batch in batches:
            for part, texts in _chunks(batch):
                w = Words(texts)
                text, asked = _fields(part)
                a, b = [asked[n].to_numpy().astype(np.int64) for n in ("a", "b")]
                m = _Marks(w, len(texts), text, a, b)
                yield pa.record_batch([
                    *_named(part, text), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
                    pa.array([x.tobytes() for x in m.bytes], pa.binary()),
                    pa.array(w.start[m.first].astype(np.int32)), pa.array(w.end[m.end - 1].astype(np.int32)),
                    lists(w.start, m.first - 1, m.low, -1), lists(w.end, m.end, m.high, 1)], names)

    # rows that share doc_id and text give the same; tasks drop what they repeat before the shuffle
    return common.mapped(_asked(docs, wanted.distinct()), run, AROUND).dropDuplicates(["doc_id", "version", "a", "b"])


def verified(docs: DataFrame, runs: DataFrame, least: int) -> DataFrame:
    """Runs whose words a to b have the mark of their first place, and how many words before and
    after they share with it: `least` or more in all. first_char and end_char include those."""
    names = [f.split()[0] for f in VERIFIED.split(", ")]

    def run(batches):
        for batch in batches:
            for part, texts in _chunks(batch):
                w = Words(texts)
                text, asked = _fields(part)
                a, b, room = [asked[n].to_numpy().astype(np.int64) for n in ("a", "b", "room")]
                other = np.frombuffer(b"".join(asked["mark"].to_pylist()), np.uint8).reshape(-1, MARK)
                m = _Marks(w, len(texts), text, a, b)
                equal, left, right = m.same(other)
                before = np.minimum(left, room)
                after = np.minimum(right, room - before)
                at = np.flatnonzero(equal & (b - a + before + after >= least))
                taken = pa.array(at)
                numbers = [
                    before[at], after[at], w.start[(m.first - before)[at]], w.end[(m.end + after)[at] - 1]]
                yield pa.record_batch([
                    *_named(part, text[at]), *[asked[n].take(taken) for n in names[2:7]],
                    *[pa.array(x.astype(np.int32)) for x in numbers]], names)

    return common.mapped(_asked(docs, runs), run, VERIFIED)


def twice(picked: DataFrame) -> DataFrame:
    """Picked runs that stand in two places or more. Hashes are counted alone, so that what follows
    shuffles the places of those only."""
    again = common.landed(picked.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "again")
    return picked.join(again.hint("shuffle_hash"), "hash")


def shared_runs(found: DataFrame, gram: int = GRAM, least: int = RUN) -> DataFrame:
    """(doc_id, version, a, b, kept_doc_id, kept_version, ahead): words a to b that picked runs,
    of which found has those that stand twice(), cover without a gap here and, `ahead` words
    before, in the first place that holds them.

    Left out is what cannot reach `least` words, as bits of the words beside it differ too soon."""
    at = F.struct("doc_id", "version", "word", "near")
    summed = found.groupBy("hash").agg(F.min(at).alias("kept"))
    kept = F.col("kept")
    own = (F.col("doc_id") == kept["doc_id"]) & (F.col("version") == kept["version"])
    differ = F.col("near").bitwiseXOR(kept["near"])

    def alike(bits):
        """Words whose bits agree, from the nearest on: four zero bits each, below the first one."""
        return F.least(F.shiftright(F.bit_count(bits.bitwiseAND(-bits) - 1), 2), F.lit(NEAR))

    places = found.join(summed, "hash").filter(~own | (F.col("word") >= kept["word"] + gram)).select(
        "doc_id", "version", "word", kept["doc_id"].alias("kept_doc_id"), kept["version"].alias("kept_version"),
        (F.col("word") - kept["word"]).alias("ahead"),
        alike(differ.bitwiseAND(F.lit((1 << 32) - 1))).alias("before"), alike(F.shiftrightunsigned(differ, 32)).alias("after"))
    line = ["doc_id", "version", "kept_doc_id", "kept_version", "ahead"]
    ordered = Window.partitionBy(*line).orderBy("word")
    gap = F.coalesce(F.col("word") - F.lag("word").over(ordered) > gram, F.lit(False)).cast("int")
    runs = places.withColumn("gap", gap).withColumn("run", F.sum("gap").over(ordered))
    return runs.groupBy(*line, "run").agg(
        F.min("word").alias("a"), (F.max("word") + gram).alias("b"), F.min_by("before", "word").alias("before"),
        F.max_by("after", "word").alias("after"),
    ).filter(
        (F.col("b") - F.col("a") + F.col("before") + F.col("after") >= least) | (F.col("before") == NEAR) | (F.col("after") == NEAR)
    ).drop("run", "before", "after")


def _joined(rows: DataFrame, by: list[str]) -> DataFrame:
    """Passages (first_word, end_word, first_char, end_char) that overlap, as one."""
    ordered = Window.partitionBy(*by).orderBy("first_word", "end_word")
    before = F.max("end_word").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    begins = rows.distinct().withColumn("begins", F.coalesce(F.col("first_word") > before, F.lit(False)).cast("int"))
    return begins.withColumn("run", F.sum("begins").over(ordered)).groupBy(*by, "run").agg(
        F.min("first_char").cast("long").alias("first_char"), F.max("end_char").cast("long").alias("end_char"),
        (F.max("end_word") - F.min("first_word")).cast("long").alias("words"))


def _compared(docs: DataFrame, runs: DataFrame, least: int) -> DataFrame:
    """Runs that stand here and in their first place, word for word, extended to both sides:
    their places (first_word, end_word, first_char, end_char) and, where stays, the first ones.

    First places are few beside the runs: their marks are found first and go with the runs to
    the texts that these stand in."""
    start, end = (F.col("a") - F.col("ahead")).alias("a"), (F.col("b") - F.col("ahead")).alias("b")
    firsts = runs.select(F.col("kept_doc_id").alias("doc_id"), F.col("kept_version").alias("version"), start, end)
    kept = common.landed(around(docs, firsts), "around").withColumnsRenamed(
        {c: f"kept_{c}" for c in ("doc_id", "version", "a", "b")})
    key = ["kept_doc_id", "kept_version", "kept_a", "kept_b"]
    inside = (F.col("doc_id") == F.col("kept_doc_id")) & (F.col("version") == F.col("kept_version"))
    room = F.when(inside, F.greatest(F.lit(0), F.col("ahead") - F.col("b") + F.col("a"))).otherwise(2 * BESIDE)
    marked = runs.select("*", start.alias("kept_a"), end.alias("kept_b"), room.alias("room")).join(
        kept.select(*key, "mark"), key).drop("kept_a", "kept_b")
    here = common.landed(verified(docs, marked, least), "verified")

    def edge(char: str, chars: str, more: str):
        return F.when(F.col(more) == 0, F.col(char)).otherwise(F.get(F.col(chars), F.col(more) - 1)).alias(char)

    words = [(F.col("a") - F.col("before")).alias("first_word"), (F.col("b") + F.col("after")).alias("end_word")]
    there = here.select(
        "kept_doc_id", "kept_version", start.alias("kept_a"), end.alias("kept_b"), "before", "after").distinct().join(kept, key)
    return here.select(
        "doc_id", "version", "kept_doc_id", "kept_version", "ahead", *words, "first_char", "end_char",
        F.lit(False).alias("stays"),
    ).unionByName(there.select(
        F.col("kept_doc_id").alias("doc_id"), F.col("kept_version").alias("version"), "kept_doc_id", "kept_version",
        F.lit(0).alias("ahead"), (F.col("kept_a") - F.col("before")).alias("first_word"),
        (F.col("kept_b") + F.col("after")).alias("end_word"), edge("first_char", "starts", "before"),
        edge("end_char", "ends", "after"), F.lit(True).alias("stays")))


def repeated_runs(docs: DataFrame, found: DataFrame | None = None, least: int = RUN) -> DataFrame:
    """(doc_id, version, first_char, end_char, words, kept_doc_id, removed): passages of at
    least `least` words that stand elsewhere as a whole, compared word by word (by their hashes,
    128 bits of all within and 32 of each word at the ends). In one text a passage ends where
    its copy begins. A passage of a repeated row has the rank of the same one in the other rows.
    Every picked run is compared with its first place alone: words that only a later place
    continues are missed where that first place breaks off before `least` words."""
    spark = docs.sparkSession
    found = twice(passages_of(common.landed(sketched(docs), "sketches"))) if found is None else found
    runs = common.passed(spark, lambda: shared_runs(found, least=least), "runs")
    told = common.passed(spark, lambda: _compared(docs, runs, least), "told")
    removed = _joined(told.filter("not stays").drop("stays"), ["doc_id", "version", "kept_doc_id", "kept_version", "ahead"])
    stays = _joined(told.filter("stays").drop("stays", "kept_doc_id", "kept_version", "ahead"), ["doc_id", "version"])
    names = ["doc_id", "version", "first_char", "end_char", "words", "kept_doc_id", "removed"]
    return removed.withColumn("removed", F.lit(True)).select(*names).unionByName(
        stays.withColumn("kept_doc_id", F.col("doc_id")).withColumn("removed", F.lit(False)).select(*names))


def repeats(docs: DataFrame, block: int = common.BLOCK) -> DataFrame:
    """Passages that stand in two places or more: doc_id, kind (line or pieces), first_char,
    end_char, words, kept_doc_id (where the first place is) and removed (false for the first).

    Null and empty texts have no passage; rows without a doc_id take no part. Rows that share
    doc_id and text are one document, whose places come out once; texts that share a doc_id
    only are told apart. Other columns are not read; an empty table gives an empty result.
    doc_id is read as a long.
    """
    return _repeats(docs, block).drop("version")


def _repeats(docs: DataFrame, block: int = common.BLOCK) -> DataFrame:
    named = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession

    with common.passing(spark):
        # sketches of all words are the largest table; they go once the two kinds are taken out
        sketches = common.landed(sketched(named), "sketches")
        picked = common.written(twice(passages_of(sketches)), "twice")
        paragraphs = common.written(lines_of(sketches), "paragraphs")
    pieces = common.passed(spark, lambda: repeated_runs(named, spark.read.parquet(picked)), "pieces")
    delete_folder(spark, picked)
    lines = common.passed(spark, lambda: repeated_lines(named, block, spark.read.parquet(paragraphs)), "lines")
    delete_folder(spark, paragraphs)
    kinds = lines.withColumn("kind", F.lit("line")).unionByName(pieces.withColumn("kind", F.lit("pieces")))
    return kinds.select("doc_id", "version", "kind", "first_char", "end_char", "words", "kept_doc_id", "removed")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; the white space behind a span goes with it."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start > at:
            out.append(text[at:start])
        while end < len(text) and text[end].isspace():
            end += 1
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def without_repeats(docs: DataFrame, heading: int = HEADING) -> DataFrame:
    """docs with the removed passages cut out of their texts; all rows and columns stay, and so
    do paragraphs of fewer than `heading` words."""
    spark = docs.sparkSession
    with common.passing(spark):
        found = common.written(_repeats(docs), "repeats")
    spans = spark.read.parquet(found).filter(F.col("removed") & (F.col("words") >= heading)).groupBy(
        F.col("doc_id").alias("_doc_id"), F.col("version").alias("_version"),
    ).agg(F.collect_list(F.struct("first_char", "end_char")).alias("_spans"))
    same = (F.col("doc_id") == F.col("_doc_id")) & (F.hash("text") == F.col("_version"))
    joined = docs.join(spans, same, "left").drop("_doc_id", "_version")
    names = docs.columns

    def run(batches):
        for batch in batches:
            texts = [
                t if not s or t is None else cut(t, [(x["first_char"], x["end_char"]) for x in s])
                for t, s in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist())]
            yield pa.record_batch(
                [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names], names)

    return common.mapped(joined, run, common.ddl(docs))
