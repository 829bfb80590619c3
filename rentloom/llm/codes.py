"""Product codes of vectors, learned by Lloyd's rounds with Drake and Hamerly's adaptive bounds.

A vector is cut into parts, each coded by the nearest entry of that part's codebook. The
first round measures all distances and keeps, per part, the next b closest entries with a
lower bound of the distance each (ordered: a bound holds for all entries from there on) and
one outer bound for the entries beyond. Later rounds lower the bounds by how far entries
moved. A part whose own entry is nearer than its first bound keeps it unseen; otherwise just
the entries whose bounds are not above are measured, and all of them only if the outer bound
is passed too. Bounds are floats rounded down and decide nothing by themselves: where they
leave a doubt, squared distances of integers decide. b follows how deep the searches went.
The bounds are kept in a table of the shared folder, beside the vectors.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentloom.llm import common
from rentloom.operators.joins import BROADCAST_ROWS

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Share of the searches whose depth the next b covers, and its limits as parts of the entries.
COVERED, FEWEST, MOST = 0.99, 8, 4
#: Components below this are squared and summed in 64 bits, others in integers of any size.
SMALL = 1 << 28
#: Components must stay below this.
LIMIT = 1 << 100
#: Parts into which rows of one label are dealt where the labels' sums are not broadcast.
SALTS = 16


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), exactly; as Python integers where 64 bits do not hold them."""
    if np.abs(x).max(initial=0) < 2.0**52 / scale:
        return np.floor(x * scale).astype(np.int64)
    flat = [int(c) * scale if abs(c) >= 2.0**52 else math.floor(c * scale) for c in x.ravel().tolist()]
    if max(map(abs, flat)) >= LIMIT:
        raise OverflowError("a component is too large to be coded")
    return np.array([*flat, None], object)[:-1].reshape(x.shape)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances over the last axis, exactly."""
    if a.dtype != object and b.dtype != object and max(
            np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < SMALL:
        return ((a - b) ** 2).sum(axis=-1)
    return ((a.astype(object) - b.astype(object)) ** 2).sum(axis=-1)


def roots(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(float))


def below(x: np.ndarray) -> np.ndarray:
    """Lower bounds in 32 bits: never above x."""
    with np.errstate(over="ignore"):
        return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def above(x: np.ndarray) -> np.ndarray:
    return x * (1 + 1e-12)


class Nearest:
    """For n rows of one part: own entry and its squared distance, the next closest entries,
    their ordered lower bounds, the outer bound, and how many bounds were passed (one more
    than there are: all entries were measured)."""

    def __init__(self, own, error, near, low, outer, depth):
        self.own, self.error, self.near, self.low, self.outer, self.depth = own, error, near, low, outer, depth


def measured(x: np.ndarray, book: np.ndarray, b: int) -> Nearest:
    """All distances measured; ties go to the lower index."""
    distance = squares(x[:, None, :], book[None])
    order = np.argsort(distance, axis=1, kind="stable")
    sorted_ = np.take_along_axis(distance, order, axis=1)
    bounds = below(roots(sorted_[:, 1:]))
    outer = bounds[:, b] if bounds.shape[1] > b else np.full(len(x), np.inf, np.float32)
    return Nearest(
        order[:, 0].astype(np.uint8), sorted_[:, 0], order[:, 1: b + 1].astype(np.uint8), bounds[:, :b], outer,
        np.full(len(x), b + 1, np.uint8))


def followed(x: np.ndarray, book: np.ndarray, drift: np.ndarray, old: Nearest) -> Nearest:
    """Nearest entries after entries moved by at most drift each."""
    n, b = old.near.shape
    kind = object if max(np.abs(a).max(initial=0) for a in (x, book)) >= SMALL else np.int64
    error = squares(x, book[old.own]).astype(kind)
    reach = above(roots(error))
    outer = below(old.outer - drift.max(initial=0))
    low = below(old.low - drift[old.near])
    low = np.minimum.accumulate(np.column_stack((low, outer))[:, ::-1], axis=1)[:, ::-1][:, :b]
    depth = (low <= reach[:, None]).sum(axis=1).astype(np.uint8)
    lost = outer <= reach
    out = Nearest(old.own.copy(), error, old.near.copy(), low, outer, depth)
    at = np.flatnonzero((depth > 0) & ~lost)
    if len(at):
        asked = np.column_stack((np.ones(len(at), bool), np.arange(b) < depth[at, None]))
        known = np.column_stack((old.own[at], old.near[at])).astype(np.int64)
        distance = np.zeros(known.shape, kind)
        distance[:, 0] = error[at]
        for z in range(1, b + 1):
            rows = np.flatnonzero(asked[:, z])
            if len(rows) == 0:
                break
            distance[rows, z] = squares(x[at[rows]], book[known[rows, z]])
        bounds = np.column_stack((np.zeros(len(at), np.float32), low[at]))
        bounds[asked] = below(roots(distance[asked]))
        # entries that were measured come first, by distance and index; the others stay where they are
        first = np.argsort(np.where(asked, known, ENTRIES * 4 + np.arange(b + 1)), axis=1, kind="stable")
        by = np.where(asked, distance, distance.max() + 1)
        order = np.take_along_axis(first, np.argsort(np.take_along_axis(by, first, 1), axis=1, kind="stable"), 1)
        known, bounds = np.take_along_axis(known, order, 1), np.take_along_axis(bounds, order, 1)
        out.own[at], out.error[at] = known[:, 0], np.take_along_axis(distance, order, 1)[:, 0]
        out.near[at] = known[:, 1:]
        tail = np.column_stack((bounds[:, 1:], outer[at]))
        out.low[at] = np.minimum.accumulate(tail[:, ::-1], axis=1)[:, ::-1][:, :b]
    if lost.any():
        again = measured(x[lost], book, b)
        for name in ("own", "near", "low", "outer", "depth"):
            getattr(out, name)[lost] = getattr(again, name)
        out.error[lost] = again.error
    return out


STATE = "own binary, depth binary, near binary, low binary, outer binary, error decimal(38,0)"


def _vectors(batch: pa.RecordBatch, dims: int, scale: int) -> np.ndarray:
    flat = pc.cast(batch.column("embedding").flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    return integers(flat.reshape(batch.num_rows, dims), scale)


def _array(batch: pa.RecordBatch, name: str, kind, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), kind).reshape(batch.num_rows, *shape).copy()


def _packed(a: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(a)], pa.binary())


class Codebooks:
    """Entries of every part: integers, parts x entries x components of a part."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def assigned(
    rows: DataFrame, books: Codebooks, b: int, scale: int = SCALE, moved: np.ndarray | None = None, held: int = 0,
) -> DataFrame:
    """rows with the state of every vector's parts; moved: how far each entry went since the
    state in rows, whose lists hold `held` entries, was made (None: there is none)."""
    entries = books.entries
    parts, _, width = entries.shape
    names = [c for c in rows.columns if c not in {"own", "depth", "near", "low", "outer", "error"}]

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _vectors(batch, parts * width, scale)
            if moved is not None:
                own = _array(batch, "own", np.uint8, parts)
                near = _array(batch, "near", np.uint8, parts, held)
                low = _array(batch, "low", np.float32, parts, held)
                outer = _array(batch, "outer", np.float32, parts)
            found = []
            for p in range(parts):
                part = x[:, p * width: (p + 1) * width]
                if moved is None:
                    found.append(measured(part, entries[p], b))
                    continue
                # a shorter list leaves the bound of its first lost entry as the outer one
                beyond = np.minimum(outer[:, p], low[:, p, b]) if b < held else outer[:, p]
                old = Nearest(own[:, p], None, near[:, p, :b], low[:, p, :b], beyond, None)
                found.append(followed(part, entries[p], moved[p], old))
            error = sum(f.error.astype(object) for f in found)
            state = [
                _packed(np.stack([getattr(f, n) for f in found], axis=1).astype(kind))
                for n, kind in (("own", np.uint8), ("depth", np.uint8), ("near", np.uint8), ("low", np.float32), ("outer", np.float32))]
            yield pa.record_batch(
                [*[batch.column(n) for n in names], *state, pa.array([Decimal(int(e)) for e in error], pa.decimal128(38, 0))],
                [*names, "own", "depth", "near", "low", "outer", "error"])

    return common.mapped(rows, run, f"{common.ddl(rows.select(*names))}, {STATE}")


def updated(state: DataFrame, books: Codebooks, b: int, scale: int = SCALE) -> tuple[Codebooks, np.ndarray, int]:
    """Codebooks of the parts' means, how far each entry moved, and the next b.

    Tasks sum up; a row per task and component is shuffled, and one per component collected.
    """
    parts, size, width = books.entries.shape

    def run(batches):
        total = np.zeros((parts, size, width), object)
        count, depths = np.zeros((parts, size), np.int64), np.zeros(b + 2, np.int64)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _vectors(batch, parts * width, scale)
            own = _array(batch, "own", np.uint8, parts)
            depths += np.bincount(_array(batch, "depth", np.uint8, parts).ravel(), minlength=b + 2)
            for p in range(parts):
                some = np.zeros((size, width), x.dtype)
                np.add.at(some, own[:, p], x[:, p * width: (p + 1) * width])
                total[p] += some
                count[p] += np.bincount(own[:, p], minlength=size)
        place = np.arange(parts * size * width)
        yield pa.record_batch([
            pa.array(place), pa.array([Decimal(int(t)) for t in total.ravel()], pa.decimal128(38, 0)),
            pa.array(np.repeat(count.ravel(), width))], ["place", "total", "n"])
        yield pa.record_batch([
            pa.array(-1 - np.arange(b + 2)), pa.nulls(b + 2, pa.decimal128(38, 0)), pa.array(depths)], ["place", "total", "n"])

    sums = common.mapped(state.select("embedding", "own", "depth"), run, "place long, total decimal(38,0), n long")
    found = {r.place: r for r in sums.groupBy("place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()}
    flat = [
        int(found[i].total) // found[i].n if i in found and found[i].n else old
        for i, old in enumerate(books.entries.ravel().tolist())]
    big = max(map(abs, flat)) >= 1 << 62
    new = np.array(flat, object if big else np.int64).reshape(books.entries.shape)
    moved = above(roots(squares(new, books.entries)))
    searches = np.cumsum([found[-1 - z].n if -1 - z in found else 0 for z in range(b + 1)])
    needed = int(np.searchsorted(searches, COVERED * searches[-1])) if searches[-1] else b
    return Codebooks(new), moved, max(1, size // FEWEST, min(b, needed))


def trained(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Codebooks | None]:
    """vectors with their final codes (own: an entry's index per part, a byte each) and error,
    and the codebooks (None without vectors).

    vectors: vec_id, embedding and any other columns, which stay unless they are named as those
    of STATE. Rows whose vector is null or
    empty, or holds null or non-finite components, are left out, as are vectors whose length
    `parts` does not divide or that differ in length from the first one kept. The codebooks
    start from the `entries` (at most 256) first rows by vec_id (nulls last), then vector.
    Repeated rows count again.
    """
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = vectors.filter(x.isNotNull() & fine & (F.size(x) > 0) & (F.size(x) % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    head = whole.select("vec_id", F.size(x).alias("dims")).orderBy(F.col("vec_id").asc_nulls_last(), "dims").first()
    if head is None:
        return assigned(whole, Codebooks(np.zeros((parts, 1, 1), np.int64)), 1, scale), None
    dims = head.dims
    whole = whole.filter(F.size(x) == dims)
    first = whole.select("vec_id", "embedding").orderBy(*order).limit(entries).collect()
    start = integers(np.array([r.embedding for r in first], float), scale)
    books = Codebooks(start.reshape(len(first), parts, dims // parts).transpose(1, 0, 2))
    b = min(max(1, len(first) // MOST), len(first) - 1)
    state = common.landed(assigned(whole, books, b, scale), "nearest")
    for _ in range(rounds):
        books, moved, wanted = updated(state, books, b, scale)
        held, b = b, min(b, wanted)
        state = common.landed(assigned(state, books, b, scale, moved, held), "nearest")
    return state, books


def compressed(vectors: DataFrame, **sizes) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (summed over rows of an equal
    label, nulls together) and the codebooks' checksum. A sum that a long does not hold is
    null. An empty table gives an empty result; for rows left out see trained."""
    state, books = trained(vectors.select("vec_id", "embedding", "label"), **sizes)
    by_label = state.groupBy("label").agg(F.sum("error").alias("label_error"))
    labels = by_label.count()
    if labels <= BROADCAST_ROWS:  # a row of a label and a number
        joined = state.join(F.broadcast(by_label.withColumnRenamed("label", "_label")), F.col("label").eqNullSafe(F.col("_label")))
    else:
        salted = by_label.withColumnRenamed("label", "_label").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = state.withColumn("salt", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(SALTS)).cast("int")).join(
            salted, F.col("label").eqNullSafe(F.col("_label")) & (F.col("salt") == F.col("_salt")))
    return joined.select(
        "vec_id", F.lower(F.hex("own")).alias("code"), F.col("error").try_cast("long").alias("error"),
        F.col("label_error").try_cast("long").alias("label_error"),
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))
