"""Passages that repeat in other surroundings: wrapped otherwise, in repeated rows, in parts."""
import random

import numpy as np
import xxhash

from rentloom.llm import common
from rentloom.llm import paragraphs as par

SOUNDS = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]


def prose(rng, n):
    return ["".join(rng.choice(SOUNDS) for _ in range(rng.randint(2, 4))) for _ in range(n)]


def wrapped(words, size):
    return "\n".join(" ".join(words[i: i + size]) for i in range(0, len(words), size))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_line_ends_do_not_move_the_borders_of_pieces(spark):
    rng, rows = random.Random(3), []
    for k in range(40):
        passage = prose(rng, 60)
        rows.append((2 * k, " ".join(prose(rng, 80) + passage + prose(rng, 80))))
        rows.append((2 * k + 1, wrapped(prose(rng, 81) + passage + prose(rng, 84), 12 + k % 4)))
    told = {r.doc_id for r in par.repeated_runs(frame(spark, rows)).collect() if r.removed}
    assert len(told) >= 38 and all(i % 2 for i in told)


def test_repeated_rows_lose_their_passages_like_single_ones(spark):
    rng, rows, clean = random.Random(4), [], " ".join(prose(random.Random(5), 90))
    for k in range(20):
        passage = prose(rng, 60)
        rows.append((2 * k, " ".join(prose(rng, 80) + passage + prose(rng, 80))))
        rows += [(2 * k + 1, " ".join(prose(rng, 81) + passage + prose(rng, 84)))] * (2 + k % 2)
    rows.append((1, clean))  # another text of a doc_id whose other text is cut
    df = frame(spark, rows)
    found = [r for r in par.repeats(df).collect() if r.removed]
    alone = [r for r in par.repeats(frame(spark, sorted(set(rows)))).collect() if r.removed]
    assert sorted(found) == sorted(alone) and {r.doc_id for r in found} == set(range(1, 40, 2))
    texts = dict(r for r in rows if r[1] != clean)
    assert all(r.words == len(texts[r.doc_id][r.first_char: r.end_char].split()) for r in found)
    out = [tuple(r) for r in par.without_repeats(df).collect()]
    assert len(out) == len(rows) and (1, clean) in out
    assert len(set(out)) == len(set(rows)) and not {t for i, t in out if i % 2} & set(texts.values())


def test_short_lines_that_stand_apart_are_no_passage(spark):
    """Lines of four words, each in an earlier document, in an order that none of them has."""
    rng = random.Random(6)
    lines = [" ".join(prose(rng, 4)) for _ in range(60)]
    rows = [(k, "\n".join([" ".join(prose(rng, 40)), line, " ".join(prose(rng, 40))])) for k, line in enumerate(lines)]
    rng.shuffle(lines)
    rows.append((100, "\n".join(lines)))
    df = frame(spark, rows)
    assert par.repeats(df).collect() == []
    assert sorted(map(tuple, par.without_repeats(df).collect())) == rows


def test_runs_from_other_documents_are_told_apart(spark):
    """Every removed run stands, word for word, in the document that it names."""
    rng, rows = random.Random(8), []
    parts = [prose(rng, 50) for _ in range(12)]
    for k, part in enumerate(parts):
        rows.append((k, " ".join(prose(rng, 40) + part + prose(rng, 40))))
    rows.append((100, " ".join(w for part in parts for w in part)))
    rows.append((101, " ".join(prose(rng, 30) * 6)))  # repeats itself
    texts = dict(rows)
    found = par.repeats(frame(spark, rows)).filter("kind = 'pieces' and removed").collect()
    assert {r.kept_doc_id for r in found} == {*range(12), 101}
    for r in found:
        assert texts[r.doc_id][r.first_char: r.end_char] in texts[r.kept_doc_id]


def changed(words, at):
    return [w if i != at else "other" for i, w in enumerate(words)]


def test_short_paragraphs_are_clustered(spark):
    """Exact copies of 10 to 19 words and near copies of 24, each a line among others."""
    rng, rows = random.Random(9), []
    for k in range(30):
        short, longer = prose(rng, 10 + k % 10), prose(rng, 24)
        for i, words in ((2 * k, longer), (2 * k + 1, changed(longer, 0))):
            rows.append((i, "\n".join(" ".join(x) for x in (prose(rng, 40), short, prose(rng, 40), words, prose(rng, 40)))))
    texts = dict(rows)
    found = par.repeats(frame(spark, rows)).filter("kind = 'line'").collect()
    told = {(r.doc_id, r.words) for r in found if r.removed}
    assert told >= {(2 * k + 1, 10 + k % 10) for k in range(30)}
    assert sum((2 * k + 1, 24) in told for k in range(30)) >= 28
    assert {r.doc_id % 2 for r in found if r.removed} == {1} and all("\n" not in texts[r.doc_id][r.first_char: r.end_char] for r in found)


def test_wrapped_paragraphs_are_joined(spark):
    """Near copies that are wrapped otherwise, with a word changed in every piece's reach."""
    rng, rows = random.Random(10), []
    for k in range(30):
        words = prose(rng, 200)
        other = words
        for at in (20, 65, 110, 155, 195)[: 3 + k % 2]:
            other = changed(other, at)
        blocks = [[prose(rng, 50), w, prose(rng, 50)] for w in (words, other)]
        rows.append((2 * k, "\n\n".join(wrapped(b, 12) for b in blocks[0])))
        rows.append((2 * k + 1, "\n\n".join(wrapped(b, 13 + k % 3) for b in blocks[1])))
    found = par.repeated_lines(frame(spark, rows)).collect()
    assert sum((2 * k + 1, 200) in {(r.doc_id, r.words) for r in found if r.removed} for k in range(30)) >= 28
    assert {r.doc_id % 2 for r in found if r.removed} == {1}


def test_a_wrapped_paragraph_and_its_line_are_no_repeat(spark):
    rng = random.Random(11)
    text = " ".join(prose(rng, 30)) + "\nend"
    assert par.repeated_lines(frame(spark, [(1, text), (1, text)])).collect() == []
    found = par.repeated_lines(frame(spark, [(1, text), (2, text)])).collect()
    assert {(r.doc_id, r.removed, r.kept_doc_id) for r in found} == {(1, False, 1), (2, True, 1)}
    verse = " ".join(prose(rng, 12))
    found = par.repeated_lines(frame(spark, [(1, "\n".join([verse, " ".join(prose(rng, 12)), verse]))])).collect()
    assert [(r.removed, r.words) for r in sorted(found, key=lambda r: r.first_char)] == [(False, 12), (True, 12)]


def inside(words, start, end):
    """The words within the span, by counting those before it."""
    return words[start:end].lower().split()


def test_every_exact_passage_from_the_least_length_on_is_found_whole(spark):
    """20 to 60 words inside longer lines: recall and share of the passage that is cut."""
    rng, rows, passages = random.Random(21), [], {}
    for k in range(200):
        passage = prose(rng, 20 + k % 41)
        passages[2 * k + 1] = passage
        for i in (2 * k, 2 * k + 1):
            rows.append((i, " ".join(prose(rng, rng.randint(0, 60)) + passage + prose(rng, rng.randint(0, 60)))))
    texts = dict(rows)
    found = {r.doc_id: r for r in par.repeated_runs(frame(spark, rows)).collect() if r.removed}
    assert set(found) == set(passages)
    for i, r in found.items():
        got = texts[i][r.first_char: r.end_char].split()
        assert " ".join(passages[i]) in " ".join(got) and r.words == len(got) and r.kept_doc_id == i - 1


def test_passages_against_all_windows(spark):
    """A word is told where it lies in RUN words that stand in two places; brute force. The
    passages begin and break off at many words, so that first places often share too few."""
    rng = random.Random(22)
    parts = [prose(rng, rng.randint(12, 45)) for _ in range(25)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(1, 6)):
            part = rng.choice(parts)
            at = rng.randint(0, 8)
            words += part[at:] if rng.random() < 0.5 else part[: len(part) - at]
            words += prose(rng, rng.randint(0, 15))
        rows.append((i, wrapped(words, 9)))
    split = {i: t.split() for i, t in rows}
    seen = {}
    for i, words in split.items():
        for a in range(len(words) - par.RUN + 1):
            seen.setdefault(tuple(words[a: a + par.RUN]), []).append((i, a))
    twice, later = set(), set()
    for held in seen.values():
        for i, a in held if len(held) > 1 else []:
            twice |= {(i, a + j) for j in range(par.RUN)}
            later |= {(i, a + j) for j in range(par.RUN) if (i, a) != min(held)}
    texts, told, removed = dict(rows), set(), set()
    for r in par.repeated_runs(frame(spark, rows)).collect():
        before = len(texts[r.doc_id][: r.first_char].split())
        span = {(r.doc_id, before + j) for j in range(r.words)}
        assert len(inside(texts[r.doc_id], r.first_char, r.end_char)) == r.words
        told |= span
        removed |= span if r.removed else set()
        if r.removed:
            assert " ".join(inside(texts[r.doc_id], r.first_char, r.end_char)) in " ".join(split[r.kept_doc_id])
    assert told <= twice and removed <= later
    assert len(removed) >= 0.9 * len(later) and len(told) >= 0.9 * len(twice)


def test_passages_of_scripts_without_spaces_inside_lines(spark):
    rng = random.Random(23)

    def han(n):
        return "".join(chr(0x4E00 + rng.randrange(4000)) for _ in range(n))

    same = han(40)
    rows = [(1, han(90) + same + han(70)), (2, "x " + han(33) + same + han(120)), (3, han(200))]
    texts = dict(rows)
    found = par.repeated_runs(frame(spark, rows)).collect()
    assert {(r.doc_id, r.removed, r.words, texts[r.doc_id][r.first_char: r.end_char]) for r in found} == {
        (1, False, 40, same), (2, True, 40, same)}


def test_a_text_that_repeats_itself_keeps_its_first_period(spark):
    rng = random.Random(24)
    verse = prose(rng, 25)
    rows = [(1, " ".join(verse * 4)), (2, "na " * 500), (3, None), (4, "")]
    out = {r.doc_id: r.text for r in par.without_repeats(frame(spark, rows)).collect()}
    assert out[1].split()[:25] == verse and len(out[1].split()) < 50
    assert 11 <= len(out[2].split()) < 40 and out[3] is None and out[4] == ""


def test_large_tables_go_before_the_next_are_made(spark, monkeypatch):
    """Sketches of all words do not lie on disk while passages and lines are compared, and what
    goes beside the runs does not hold a row with arrays for each of them."""
    from rentloom import session

    rng, written, standing = random.Random(25), [], {}
    same = prose(rng, 60)
    rows = [(i, " ".join(prose(rng, 40) + same + prose(rng, 40))) for i in range(12)]
    write = common.written

    def noted(df, name):
        path = write(df, name)
        written.append((name, path))
        standing[name] = {n for n, p in written if session.folder_exists(spark, p)}
        if name == "around":
            standing["rows"] = spark.read.parquet(path).count()
        return path

    monkeypatch.setattr(common, "written", noted)
    found = [r for r in par.repeats(frame(spark, rows)).collect() if r.kind == "pieces"]
    assert {r.doc_id for r in found if r.removed} == set(range(1, 12)) and {r.words for r in found} == {60}
    assert "sketches" in standing["sketches"]
    assert not any("sketches" in standing[n] for n in ("runs", "around", "told", "cells", "lines"))
    assert not any("twice" in standing[n] for n in ("cells", "lines"))
    assert standing["rows"] < 11


def test_hashes_of_words_are_those_of_the_library():
    rng = random.Random(26)
    words = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(70)] * 3]
    offsets = np.append(0, np.cumsum([len(w) for w in words]))
    got = par.digests(np.frombuffer(b"".join(words), np.uint8), offsets)
    assert got.tolist() == [xxhash.xxh64_intdigest(w) for w in words]


def test_words_and_places_equal_plain_splitting():
    rng = random.Random(27)
    letters = "aAbZ \n\t\x1f\x85\u3000\u00dc\u00df\u0130\u03a3\u03c3\u00e9\U0001f600\ud812"
    texts = ["".join(rng.choices(letters[: rng.choice((7, 18))], k=rng.randint(0, 30))) for _ in range(300)]
    w = par.Words(texts)
    for i, t in enumerate(texts):
        at = w.text == i
        split = t.lower().split()
        assert w.hash[at].tolist() == [xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in split]
        assert [t[a:b] for a, b in zip(w.start[at], w.end[at])] == t.split()
        assert w.line[at].tolist() == [t[:a].count("\n") for a in w.start[at]]


def test_bitmaps_leave_out_no_similar_pair():
    rng = np.random.default_rng(28)
    pool = rng.integers(0, 1 << 64, 400, dtype=np.uint64, endpoint=False)
    sets = [np.unique(rng.choice(pool[: 20 + 3 * (i % 60)], 18 + 2 * (i % 60), replace=False)).view(np.int64) for i in range(120)]
    sets += [np.delete(s, [0, 5]) for s in sets]
    left, right = np.triu_indices(len(sets), 1)
    plain = [len(a & b) >= par.LIKE * len(a | b) - 1e-9 for a, b in (
        (set(sets[i].tolist()), set(sets[j].tolist())) for i, j in zip(left, right))]
    assert 0 < sum(plain) < len(plain)
    assert par.similar(sets, left, right, bits=par.bitmaps(sets)).tolist() == par.similar(sets, left, right).tolist() == plain
