import math
import random

import compare
import numpy as np
import pytest

from rentloom.llm import codes, queries


def plain(rows, parts, entries, rounds):
    """vec_id, code, error, label_error and final entries by Lloyd's rounds in Python integers."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width: (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    book = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), i) for i, e in enumerate(book[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for e in range(len(book[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][1] == e]
                if own:
                    book[p][e] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    return sorted(
        (str(i), bytes(e for _, e in f).hex(), err, by_label[label]) for (i, _, label), f, err in zip(kept, found, errors)), book


def table(spark, rows):
    return spark.createDataFrame([(*r, 1.5) for r in rows], "vec_id long, embedding array<double>, label int, error double")


@pytest.mark.parametrize("seed, entries, rounds, spread", [(1, 8, 2, 3), (2, 16, 5, 40), (3, 5, 6, 2000), (4, 64, 3, 5)])
def test_equals_plain_rounds(spark, seed, entries, rounds, spread):
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-spread, spread) / 256 + rng.choice([0, 0.001]) for _ in range(8)], rng.choice([None, 1, 2])) for i in range(300)]
    rows += [rows[5]] * 20 + [(None, [0.5] * 8, 7), (-3, [0.0] * 8, None)]
    got, want = codes.compressed(table(spark, rows), parts=4, entries=entries, rounds=rounds), plain(rows, 4, entries, rounds)
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in got.collect()) == want[0]
    text = ",".join(str(x) for part in want[1] for e in part for x in e)
    assert {r.codebooks_sha256 for r in got.collect()} == {__import__("hashlib").sha256(text.encode()).hexdigest()}


def test_bounds_never_change_what_is_nearest():
    """followed() equals a full measurement while entries drift, ties included; and it is lazy."""
    rng = np.random.default_rng(7)
    for size, b, step in ((16, 4, 1), (64, 16, 3), (64, 8, 40), (3, 1, 2)):
        x = rng.integers(-50, 50, (500, 4))
        book = rng.integers(-50, 50, (size, 4))
        state = codes.measured(x, book, b)
        for _ in range(6):
            new = book + rng.integers(-step, step + 1, book.shape)
            state = codes.followed(x, new, codes.above(codes.roots(codes.squares(new, book))), state)
            book, whole = new, codes.measured(x, new, b)
            assert (state.own == whole.own).all() and (state.error == whole.error).all()
            distance = np.sqrt(codes.squares(x[:, None], book[None]))
            listed = np.take_along_axis(distance, state.near.astype(int), 1)
            assert (state.low <= listed).all() and (np.diff(state.low, axis=1) >= 0).all()
            outside = distance.copy()
            np.put_along_axis(outside, state.near.astype(int), np.inf, 1)
            np.put_along_axis(outside, state.own.astype(int)[:, None], np.inf, 1)
            assert (state.outer <= outside.min(axis=1)).all()
        if step == 1:
            assert (state.depth <= 1).mean() > 0.5


def test_rows_left_out_outliers_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 5), 0.25 * i, -1.0, 3.0], i % 2) for i in range(1, 30)]
    odd = [(40, None, 1), (41, [None, 1.0, 1.0, 1.0], 1), (42, [nan] * 4, 1), (43, [inf] * 4, 1), (44, [], 1), (45, [1.0] * 3, 1), (46, [1.0] * 8, 1)]
    huge = [(50, [1e15, -1e15, 1e15, 1e15], 9), (51, [1e15, -1e15, 1e15, 1e15], 9)]
    got = codes.compressed(table(spark, good + odd + huge), parts=2, entries=4, rounds=2).collect()
    want, _ = plain(good + huge, 2, 4, 2)
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in got if r.error is not None) == [
        w if w[3] < 2**63 else (*w[:3], None) for w in want if w[2] < 2**63]
    assert len(got) == len(good + huge)


def test_few_rows_and_empty_table(spark):
    one = codes.compressed(table(spark, [(9, [0.1] * 16, None)])).collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in one] == [(9, "00" * 16, 0, 0)]
    assert codes.compressed(table(spark, []).filter("vec_id > 0")).collect() == []


def test_many_labels_are_not_broadcast(spark, monkeypatch):
    rows = [(i, [float(i % 7)] * 16, None if i % 3 else i) for i in range(60)]
    want = sorted(map(tuple, codes.compressed(table(spark, rows)).collect()))
    monkeypatch.setattr(codes, "BROADCAST_ROWS", 3)
    assert sorted(map(tuple, codes.compressed(table(spark, rows)).collect())) == want


def test_equals_sql(spark, smallest):
    got = queries.QUERIES["op12_vector_codes"](spark, smallest)
    assert compare.differences(got, compare.duck(smallest), queries.SQL["op12_vector_codes"]) == []
