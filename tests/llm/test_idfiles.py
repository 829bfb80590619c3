import pathlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rentloom.llm import idfiles, queries

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    known = Tokenizer.from_file(FILE)
    return lambda text: np.array([*known.encode(text or "", add_special_tokens=False).ids, idfiles.STOP], "<u4").tobytes()


def test_query_reads_back_what_the_library_gives(spark, smallest, small, library):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op11_id_files"](spark, smallest).collect()}
    start, want = 0, {}
    for key, text in sorted((r[0], r[1]) for r in small("documents")):
        ids = library(text)
        want[key] = (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert got == want


@pytest.fixture(scope="module")
def odd(spark):
    texts = [None, "", "one", "<|endoftext|> two", "é" * 4000, "word " * 30000, "three", "three", " \n"] + [f"text {i}" for i in range(300)]
    rows = [(900 - 3 * i, t, 5, "x") for i, t in enumerate(texts)]
    rows += [(7, "same", 1, "y")] * 150 + [(7, "other", 1, "y")] * 40 + [(None, "no id", 1, "y"), (-5, "first", 1, "y")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, start int, ids string").repartition(5)


def test_ties_nulls_and_order(spark, odd, tmp_path, library):
    rows, docs = odd
    folder = idfiles.write(docs, FILE, f"file://{tmp_path}/ids", shard=2000)
    got = sorted((r.start, r.doc_id, bytes(r.ids)) for r in idfiles.read(spark, folder).collect())
    assert [g[1] for g in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    assert sorted((str(k), i) for _, k, i in got) == sorted((str(r[0]), library(r[1])) for r in rows)
    assert [g[0] for g in got] == np.cumsum([0, *[len(g[2]) // 4 for g in got]])[:-1].tolist()
    sizes = [r.documents for r in spark.read.parquet(f"{folder}/manifest").collect()]
    assert sum(sizes) == len(rows) and max(sizes) < 150  # rows of one id lie in several shards


def test_single_documents_are_fetched_by_their_frames(spark, odd, tmp_path, library):
    rows, docs = odd
    folder = idfiles.write(docs, FILE, str(tmp_path / "ids"))
    wanted = spark.createDataFrame([(7,), (-5,), (885,), (123456,), (None,)], "doc_id long")
    got = sorted((r.doc_id, bytes(r.ids)) for r in idfiles.fetch(spark, folder, wanted).collect())
    assert got == sorted((r[0], library(r[1])) for r in rows if r[0] in (7, -5, 885))
    name = spark.read.parquet(f"{folder}/manifest").first().name
    shard = idfiles.Shard(folder, name)
    whole = [x.astype("<u4").tobytes() for _, found in shard.runs(100) for x in found]
    assert whole == [shard.ids(i).astype("<u4").tobytes() for i in range(len(shard))]


def test_dictionary_is_used_checked_and_pays(spark, smallest, tmp_path):
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    folder = idfiles.write(docs, FILE, str(tmp_path / "ids"))
    content = (pathlib.Path(folder) / "dictionary").read_bytes()
    assert content
    sizes = [idfiles.frames(docs, FILE, d).selectExpr("sum(octet_length(frame)) AS n").first().n for d in (content, b"")]
    assert sizes[0] < 0.9 * sizes[1]
    (pathlib.Path(folder) / "dictionary").write_bytes(content[:-1] + b"!")
    idfiles._reader.cache_clear()
    with pytest.raises(ValueError, match="dictionary"):
        idfiles.Shard(folder, spark.read.parquet(f"{folder}/manifest").first().name)


def test_files_no_manifest_row_names_are_not_read(spark, docs, tmp_path):
    folder = idfiles.write(docs("a", "b"), FILE, str(tmp_path / "ids"))
    (tmp_path / "ids" / "00000000-left-behind.ids").write_bytes(b"half a frame")
    assert idfiles.read(spark, folder).count() == 2


def test_empty_table(spark, docs, tmp_path):
    folder = idfiles.write(docs("a").filter("false"), FILE, str(tmp_path / "ids"))
    assert idfiles.read(spark, folder).collect() == []
    assert idfiles.fetch(spark, folder, docs("a")).collect() == []
