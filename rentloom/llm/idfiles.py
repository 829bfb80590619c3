"""Files of token ids: every document a zstandard frame of its own, one dictionary for all.

A folder holds

- `dictionary`: the dictionary, trained on serialised ids of a bounded sample;
- `<shard>.ids`: frames, one a document, one after another, in ascending order of doc_id;
- `<shard>.index`: a header (magic, version, bytes an id, SHA-256 of the dictionary, number of
  documents), then as arrays the doc_ids, whether each is null, where its frame begins, and
  how many ids stand before it in the shard;
- `manifest`: a Parquet table with a row a shard: order, file names, first and last doc_id,
  documents, ids. Only files it names belong to the folder, so what a lost or repeated task
  leaves is never read.

A frame is read with the dictionary and two numbers of the index, whatever stands beside it.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentloom.llm import common
from rentloom.llm.packing import AT_ONCE, encoder
from rentloom.session import shared_folder

#: Id that ends each document.
STOP = 2
#: Pieces that the dictionary is trained on, ids of each, and bytes of the dictionary.
PIECES, PIECE, SIZE = 4000, 512, 1 << 16
LEVEL = 3
#: Bytes of frames that a shard holds, about, and that a reader asks for at once.
SHARD, READ = 256 << 20, 4 << 20
MAGIC, VERSION = b"IDFRAMES", 1
HEADER = "<8sII32sQ"


def place(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder or file, with or without a scheme."""
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        pyarrow.fs.LocalFileSystem(), path)


def id_type(tokenizer: str) -> str:
    """The least width that holds every id of the vocabulary file."""
    return "<u2" if max(len(encoder(tokenizer).spaced), STOP + 1) <= 1 << 16 else "<u4"


def _ids(texts: list[str], tokenizer: str, kind: str) -> list[bytes]:
    """Serialised ids of each text, STOP behind them."""
    stop = np.array([STOP], kind)
    out = []
    for at in range(0, len(texts), AT_ONCE):
        out += [np.append(x.astype(kind), stop).tobytes() for x in encoder(tokenizer).encode(texts[at: at + AT_ONCE])]
    return out


def trained_dictionary(docs: DataFrame, tokenizer: str, pieces: int = PIECES, size: int = SIZE) -> bytes:
    """A dictionary trained on at most `pieces` pieces of PIECE ids, one each of rows chosen by a
    hash. Where the sample is too small to train on, the dictionary is empty."""
    count = docs.count()
    row = F.xxhash64("doc_id", F.monotonically_increasing_id())
    chosen = docs.select("doc_id", "text").filter(F.pmod(row, F.lit(max(count, 1))) < 2 * pieces)

    def run(batches):
        kind = id_type(tokenizer)
        for batch in batches:
            found = _ids(common.texts(batch), tokenizer, kind)
            wide = PIECE * np.dtype(kind).itemsize
            starts = [zlib.crc32(f) % max(1, len(f) // wide) * wide for f in found]
            yield pa.record_batch([pa.array([f[s: s + wide] for f, s in zip(found, starts)], pa.binary())], ["piece"])

    samples = [bytes(r.piece) for r in common.mapped(chosen, run, "piece binary").limit(pieces).collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def frames(docs: DataFrame, tokenizer: str, dictionary: bytes, level: int = LEVEL) -> DataFrame:
    """(doc_id, tokens, frame) of every row, compressed where its text lies."""

    def run(batches):
        kind = id_type(tokenizer)
        pack = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(dictionary)).compress
        wide = np.dtype(kind).itemsize
        for batch in batches:
            found = _ids(common.texts(batch), tokenizer, kind)
            yield pa.record_batch([
                batch.column("doc_id").cast(pa.int64()), pa.array([len(f) // wide for f in found], pa.int64()),
                pa.array([pack(f) for f in found], pa.binary())], ["doc_id", "tokens", "frame"])

    return common.mapped(docs.select("doc_id", "text"), run, "doc_id long, tokens long, frame binary")


def write(docs: DataFrame, tokenizer: str, folder: str, shard: int = SHARD, level: int = LEVEL) -> str:
    """Writes the ids of all rows of docs (doc_id, text) to a new folder and returns its path.

    Null texts have just the closing id. Rows without a doc_id come first; rows that share one
    stand in the order of their frames and then of the table, each a document of its own, and
    may lie in several shards, so no id makes a shard large. Other columns are not read; an
    empty table gives a folder without shards.
    """
    spark = docs.sparkSession
    dictionary = trained_dictionary(docs, tokenizer)
    system, root = place(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/dictionary", compression=None) as out:
        out.write(dictionary)
    digest = hashlib.sha256(dictionary).digest()
    # written, so that choosing the borders of the shards does not encode the texts again
    packed = common.landed(frames(docs, tokenizer, dictionary, level), "frames")
    total = packed.agg(F.sum(F.octet_length("frame"))).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-total // shard))
    order = ["doc_id", F.xxhash64("frame").alias("tie"), F.monotonically_increasing_id().alias("row")]
    ordered = packed.select(*order, "tokens", "frame").repartitionByRange(shards, "doc_id", "tie", "row").sortWithinPartitions(
        "doc_id", "tie", "row")
    kind = id_type(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]):
        system, root = place(folder)
        number = TaskContext.get().partitionId()
        name = f"{number:08d}-{uuid.uuid4().hex}"
        keys, sizes, tokens = [], [], []
        out = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            out = out or system.open_output_stream(f"{root}/{name}.ids", compression=None)
            found = batch.column("frame").to_pylist()
            out.write(b"".join(found))
            keys += batch.column("doc_id").to_pylist()
            sizes.append(np.array([len(f) for f in found], np.int64))
            tokens.append(batch.column("tokens").to_numpy())
        if out is None:
            return
        out.close()
        null = np.array([k is None for k in keys], np.uint8)
        with system.open_output_stream(f"{root}/{name}.index", compression=None) as index:
            index.write(struct.pack(HEADER, MAGIC, VERSION, np.dtype(kind).itemsize, digest, len(keys)))
            index.write(np.array([k or 0 for k in keys], "<i8").tobytes())
            index.write(null.tobytes())
            for each in (sizes, tokens):
                index.write(np.append(0, np.cumsum(np.concatenate(each))).astype("<u8").tobytes())
        yield pa.record_batch(
            [pa.array([x]) for x in (number, name)] + [pa.array([x], pa.int64()) for x in (
                keys[0], keys[-1], len(keys), int(sum(t.sum() for t in tokens)))],
            ["number", "name", "first_id", "last_id", "documents", "ids"])

    manifest = common.mapped(
        ordered, run, "number long, name string, first_id long, last_id long, documents long, ids long")
    manifest.write.parquet(f"{folder}/manifest")
    return folder


@functools.lru_cache(maxsize=4)
def _reader(folder: str, digest: bytes):
    """Decompressor with the folder's dictionary, which must be the one the index names."""
    system, root = place(folder)
    with system.open_input_file(f"{root}/dictionary") as file:
        content = file.read()
    if hashlib.sha256(content).digest() != digest:
        raise ValueError(f"the dictionary of {folder} is not the one its files were written with")
    return zstandard.ZstdDecompressor(dict_data=_dictionary(content))


class Shard:
    """One shard's index, and its documents by position."""

    def __init__(self, folder: str, name: str):
        self.folder, self.name = folder, name
        system, root = place(folder)
        with system.open_input_file(f"{root}/{name}.index") as file:
            data = file.read()
        magic, version, wide, digest, n = struct.unpack_from(HEADER, data)
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{name} is no file of this format")
        at = struct.calcsize(HEADER)
        self.kind = f"<u{wide}"
        self.keys = np.frombuffer(data, "<i8", n, at)
        self.null = np.frombuffer(data, np.uint8, n, at + 8 * n).astype(bool)
        self.offsets = np.frombuffer(data, "<u8", n + 1, at + 9 * n).astype(np.int64)
        self.tokens = np.frombuffer(data, "<u8", n + 1, at + 9 * n + 8 * (n + 1)).astype(np.int64)
        self.unpack = _reader(folder, digest).decompress
        self.frames = system.open_input_file(f"{root}/{name}.ids")

    def __len__(self) -> int:
        return len(self.keys)

    def ids(self, position: int) -> np.ndarray:
        """The ids of the document at a position; only its frame is read."""
        a, b = self.offsets[position: position + 2].tolist()
        self.frames.seek(a)
        return np.frombuffer(self.unpack(self.frames.read(b - a)), self.kind)

    def runs(self, bytes_: int = READ) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Position and ids of neighbouring documents, read about `bytes_` at once."""
        at = 0
        while at < len(self):
            end = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + bytes_, "right")) - 1)
            self.frames.seek(int(self.offsets[at]))
            data, zero = self.frames.read(int(self.offsets[end] - self.offsets[at])), self.offsets[at]
            cuts = (self.offsets[at: end + 1] - zero).tolist()
            yield at, [np.frombuffer(self.unpack(data[a:b]), self.kind) for a, b in zip(cuts, cuts[1:])]
            at = end


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with `before`, the ids of all shards before; a row a shard, a task each.

    The running sum goes over one row per shard, that is one per SHARD bytes of frames."""
    table = spark.read.parquet(f"{folder}/manifest")
    before = F.sum("ids").over(Window.orderBy("number")) - F.col("ids")
    found = table.withColumn("before", before)
    return found.repartition(max(1, table.count()), "number")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids (little-endian, 32 bits
    each) of every document of a folder."""

    def run(batches):
        for batch in batches:
            for name, before in zip(batch.column("name").to_pylist(), batch.column("before").to_pylist()):
                shard = Shard(folder, name)
                for at, found in shard.runs():
                    end = at + len(found)
                    yield pa.record_batch([
                        pa.array(shard.keys[at:end], mask=shard.null[at:end]), pa.array(shard.tokens[at:end] + before),
                        pa.array(np.diff(shard.tokens[at: end + 1])), pa.array([f.astype("<u4").tobytes() for f in found], pa.binary()),
                    ], ["doc_id", "start", "n_tokens", "ids"])

    return common.mapped(
        shards(spark, folder).select("name", "before"), run, "doc_id long, start long, n_tokens long, ids binary")


def places(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, name, position) of every document, out of the indexes alone."""

    def run(batches):
        for batch in batches:
            for name in batch.column("name").to_pylist():
                shard = Shard(folder, name)
                for at in range(0, len(shard), 1 << 16):
                    keys = shard.keys[at: at + (1 << 16)]
                    yield pa.record_batch([
                        pa.array(keys, mask=shard.null[at: at + len(keys)]), pa.array([name] * len(keys)),
                        pa.array(np.arange(at, at + len(keys)))], ["doc_id", "name", "position"])

    return common.mapped(shards(spark, folder).select("name"), run, "doc_id long, name string, position long")


def fetch(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, ids) of the documents whose doc_id stands in wanted; no other frame is read."""

    def run(batches):
        open_: dict[str, Shard] = {}
        for batch in batches:
            keys, found = batch.column("doc_id"), []
            for name, position in zip(batch.column("name").to_pylist(), batch.column("position").to_pylist()):
                if name not in open_:
                    open_ = {name: Shard(folder, name)}
                found.append(open_[name].ids(position).astype("<u4").tobytes())
            yield pa.record_batch([keys, pa.array(found, pa.binary())], ["doc_id", "ids"])

    asked = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    found = places(spark, folder).join(asked, "doc_id").sortWithinPartitions("name", "position")
    return common.mapped(found, run, "doc_id long, ids binary")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens and a checksum of the ids, from files written and read back."""
    spark = docs.sparkSession
    folder = write(docs, tokenizer, shared_folder(spark))
    return read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
