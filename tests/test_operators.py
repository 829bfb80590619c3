"""Operators against brute force and their stated properties."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rentloom.operators import dedupe, enrich, joins, reshape, spatial, stats
from rentloom.functions.geo import AlbersEqualArea, project_rings


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# --- quantiles --------------------------------------------------------------

def inverse_ecdf(pairs, p):
    total, upto = sum(w for _, w in pairs), 0
    for v, w in sorted(pairs):
        upto += w
        if upto * 100 >= total * p and total > 0:
            return v
    return None


@pytest.mark.parametrize("pairs, median", [
    ([(1.0, 1), (2.0, 1)], 1.0), ([(1.0, 1), (2.0, 3), (10.0, 1)], 2.0), ([(5.0, 0)], None),
    ([(1e300, 1), (-1e300, 1), (0.0, 1)], 0.0)])
def test_median_by_hand(spark, pairs, median):
    df = spark.createDataFrame([("g", *p) for p in pairs], "k string, v double, w long")
    out = stats.weighted_quantiles(df, ["k"], "v", "w", (50,)).first()
    assert out.q50 == median and out.n == sum(w for _, w in pairs)


@pytest.mark.parametrize("steps", [1, 16, 256, 100_000])
def test_quantiles_do_not_depend_on_buckets(spark, steps):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), round(rng.gauss(0, 40), 1), rng.randint(0, 4)) for _ in range(800)]
    rows += [("hot", 7.0, 1)] * 500 + [("a", float("nan"), 9), ("a", None, 9)]
    df = spark.createDataFrame(rows, "k string, v double, w long")
    percents = (1, 25, 50, 75, 99, 100)
    out = {r.k: r for r in stats.weighted_quantiles(df, ["k"], "v", "w", percents, steps).collect()}
    assert set(out) == {"a", "b", None, "hot"}
    for k, r in out.items():
        pairs = [(v, w) for g, v, w in rows if g == k and v is not None and v == v]
        assert [r[f"q{p}"] for p in percents] == [inverse_ecdf(pairs, p) for p in percents]
        assert list(r)[2:] == sorted(list(r)[2:])


@pytest.mark.parametrize("steps", [1, 256, 4096])
def test_buckets_never_fall(spark, steps):
    rng = random.Random(1)
    values = [s * rng.uniform(1, 2) * 2.0 ** rng.randint(-40, 40) for s in (1, -1) for _ in range(2000)]
    values += [s * 2.0 ** k * f for s in (1, -1) for k in range(-60, 60) for f in (1 - 2**-53, 1, 1 + 2**-52)]
    values += [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in sorted(values)], "v double")
    buckets = [r.b for r in df.select("v", stats._bucket(F.col("v"), steps).alias("b")).orderBy("v").collect()]
    assert buckets == sorted(buckets)


def test_scaled_weights_change_nothing(spark):
    df = spark.range(200).selectExpr("id % 3 AS k", "cast(id * 37 % 101 AS double) AS v", "id % 7 AS w")
    a = stats.weighted_quantiles(df, ["k"], "v", "w")
    b = stats.weighted_quantiles(df.withColumn("w", F.col("w") * 10), ["k"], "v", "w")
    assert got(a.drop("n"), "*") == got(b.drop("n"), "*")


def test_unit_weights_equal_percentile_disc(spark):
    df = spark.range(500).selectExpr("id % 3 AS k", "cast(id * 37 % 101 AS double) AS v", "1L AS w")
    disc = df.groupBy("k").agg(*[
        F.expr(f"percentile_disc({p / 100}) WITHIN GROUP (ORDER BY v)").alias(f"q{p}") for p in (25, 50, 75)])
    ours = stats.weighted_quantiles(df, ["k"], "v", "w", (25, 50, 75))
    assert got(ours, "k", "q25", "q50", "q75") == got(disc, "k", "q25", "q50", "q75")


def test_fractional_weights_lose_no_quantile(spark):
    """Against a plain running sum: no NULL, and the value reached up to a rounding error."""
    rng = random.Random(9)
    groups = {g: [(rng.choice([10.0, 20.5, 30.0, 900.0, 905.0]) + rng.randint(0, 3), rng.choice([0.1, 0.2, 0.7, 1.3]))
                  for _ in range(rng.randint(1, 9))] for g in range(300)}
    groups[-1] = [(float(i), w) for i, w in enumerate((.2, .7, .1, .2, .7, .1))]
    df = spark.createDataFrame([(g, v, w) for g, rows in groups.items() for v, w in rows], "g int, v double, w double")
    percents = (5, 25, 50, 75, 100)
    for r in stats.weighted_quantiles(df, ["g"], "v", "w", percents).collect():
        rows = sorted(groups[r.g])
        total = sum(w for _, w in rows)
        for p in percents:
            value = r[f"q{p}"]
            assert value is not None
            below = sum(w for v, w in rows if v < value)
            upto = sum(w for v, w in rows if v <= value)
            assert below * 100 < total * p + 1e-9 and upto * 100 > total * p - 1e-9


def test_share(spark):
    df = spark.createDataFrame([(True,), (True,), (False,), (None,)], "b boolean")
    assert got(stats.share_of_total(df, ["b"]), "b", "n", "prop") == [
        (False, 1, 0.25), (None, 1, 0.25), (True, 2, 0.5)]
    two = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "s string, b boolean")
    assert got(stats.share_of_total(two, ["s", "b"], within=["s"]), "s", "b", "prop") == [
        ("a", False, 0.5), ("a", True, 0.5), ("b", True, 1.0)]


def test_overlong_ranges_are_kept_without_numbers(spark):
    df = spark.createDataFrame([(1, 0.0, 3e12), (2, 0.0, 2.0), (3, None, 2.0)], "i int, lo double, hi double")
    out = reshape.expand_range(df.withColumns({"a": F.lit(100.0), "b": F.lit(200.0)}), "lo", "hi", "a", "b", "beds", "rent")
    assert got(out, "i", "beds", "rent") == [(1, None, None), (2, 0.0, 100.0), (2, 1.0, 150.0), (2, 2.0, 200.0)]


@pytest.mark.parametrize("text, expected", [
    ("2020-10-01T20:00:00-07:00", "2020-10-02 03:00:00"), ("2020-10-01 20:00:00+0530", "2020-10-01 14:30:00"),
    ("2020-10-01T20:00:00Z", "2020-10-01 20:00:00"), ("2020-10-01 20:00:00", "2020-10-01 20:00:00"),
    ("2020-10-01", "2020-10-01 00:00:00"), ("soon", None), (None, None),
])
def test_scrape_time_offsets(spark, text, expected):
    from rentloom.functions.dates import scraped_at
    found = spark.createDataFrame([(text,)], "t string").select(scraped_at(F.col("t")).cast("string")).first()[0]
    assert found == expected


def test_shared_folder_is_demanded_off_local(monkeypatch):
    from rentloom import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "local-cluster[2,1,1024]"

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.shared_folder(Cluster())


# --- dedupe -----------------------------------------------------------------

def test_keep_first_is_stable_and_idempotent(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1.0, float("nan")]), rng.choice(["x", None]), i, rng.random()) for i in range(300)]
    schema = "a double, b string, i long, r double"
    one = dedupe.keep_first(spark.createDataFrame(rows, schema), ["a", "b"], ["r", "i"])
    rng.shuffle(rows)
    other = dedupe.keep_first(spark.createDataFrame(rows, schema).repartition(7), ["a", "b"], ["r", "i"])
    assert got(one, "i") == got(other, "i") and one.count() == 6
    assert got(dedupe.keep_first(one, ["a", "b"], ["r", "i"]), "i") == got(one, "i")


def test_keep_first_without_order_is_deterministic(spark):
    rows = [("k", i) for i in range(50)]
    a = dedupe.keep_first(spark.createDataFrame(rows, "k string, i long"), ["k"])
    b = dedupe.keep_first(spark.createDataFrame(rows[::-1], "k string, i long").repartition(5), ["k"])
    assert a.collect() == b.collect()


def test_keep_latest_puts_missing_dates_last(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "2020-01-01", 2), ("k", "2020-02-01", 3)],
                               "k string, d string, i long").withColumn("d", F.to_date("d"))
    assert dedupe.keep_latest(df, ["k"], "d", ["i"]).first().i == 3


# --- joins ------------------------------------------------------------------

def test_natural_left(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, 10)], "k int, w int")
    assert got(joins.natural_left(left, right), "k", "v", "w") == [(1, "a", 10), (2, "b", None), (None, "c", None)]
    with pytest.raises(ValueError):
        joins.natural_left(left, right.withColumnRenamed("k", "z"))
    assert joins.natural_left(left, right, unique=True).count() == 3
    with pytest.raises(Exception, match="twice"):
        joins.natural_left(left, right.union(right), unique=True).collect()


def test_null_safe_left(spark):
    left = spark.createDataFrame([(1, None), (1, "x")], "a int, b string")
    right = spark.createDataFrame([(1, None, "hit")], "a int, b string, c string")
    assert got(joins.null_safe_left(left, right, ["a", "b"]), "a", "b", "c") == [(1, "x", None), (1, None, "hit")]


def test_broadcast_only_when_small(spark):
    small, big = spark.range(5), spark.range(300_000)
    fact = spark.range(10).toDF("id")
    assert joins.broadcast_if_small(big) is big
    assert joins.broadcast_if_small(small, max_rows=4) is small
    long = small.select("id", F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.broadcast_if_small(long, max_bytes=5000) is long
    assert joins.broadcast_if_small(long.select("id", F.array("t").alias("t")), max_bytes=5000).columns == ["id", "t"]
    empty = spark.range(0)
    assert joins.broadcast_if_small(empty) is not empty
    plan = fact.hint("merge").join(joins.broadcast_if_small(small), "id")
    assert plan.count() == 5


# --- reshape ----------------------------------------------------------------

@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lo=st.integers(0, 9), hi=st.integers(0, 9), a=st.integers(100, 900), b=st.integers(100, 900))
def test_expanded_ends_are_the_given_rents(spark, lo, hi, a, b):
    df = spark.createDataFrame([(float(lo), float(hi), float(a), float(b))], "l double, h double, a double, b double")
    out = got(reshape.expand_range(df, "l", "h", "a", "b", "beds", "rent"), "beds", "rent")
    assert len(out) == abs(hi - lo) + 1
    if lo != hi:
        assert out[0] == (float(min(lo, hi)), float(a)) and out[-1][1] == pytest.approx(b)
    else:
        assert out == [(float(lo), None)]


def test_expand_drops_missing_bounds_and_steps_from_halves(spark):
    df = spark.createDataFrame([(None, 2.0, 1.0, 2.0), (1.5, 3.0, 100.0, 200.0)],
                               "l double, h double, a double, b double")
    assert got(reshape.expand_range(df, "l", "h", "a", "b", "beds", "rent"), "beds", "rent") == [
        (1.5, 100.0), (2.5, 200.0)]


def test_absurd_range_does_not_stop_the_job(spark):
    df = spark.createDataFrame([(1.0, 9e12, 1.0, 2.0), (1.0, 2.0, 1.0, 2.0)],
                               "l double, h double, a double, b double")
    assert reshape.expand_range(df, "l", "h", "a", "b", "beds", "rent").count() == 3


def test_union_counts_and_fills(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2.5,)], "d double")
    assert got(reshape.harmonize_union([a, b]), "i", "s", "d") == [(1, "x", None), (None, None, 2.5)]


def test_split_leaves_unknown_out(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    buildings, units = reshape.split_building_unit(df, F.col("b"))
    assert buildings.count() == units.count() == 1


def test_pivot_back(spark):
    df = spark.createDataFrame([(1, "inv", "3"), (1, "rent", "9"), (1, "rent", "9"), (2, "inv", "4")],
                               "i int, var string, value string")
    assert got(reshape.pivot_inventory(df, ["i"], "var", "value", ["inv", "rent"]), "i", "inv", "rent") == [
        (1, "3", "9"), (2, "4", None)]


def test_sentinel(spark):
    df = spark.createDataFrame([(" a\nb ", "not available on this site", 1)], "x string, y string, n int")
    assert got(reshape.sentinel_to_null(df), "x", "y", "n") == [(" a\nb ", None, 1)]
    assert got(reshape.sentinel_to_null(df, trim=True), "x", "y") == [("a b", None)]


# --- spatial ----------------------------------------------------------------

def test_albers_against_the_published_example():
    """Snyder's worked example on the Clarke 1866 ellipsoid."""
    import math
    clarke = AlbersEqualArea(6378206.4, 0.00676866, (29.5, 45.5), (23.0, -96.0))
    n, c, rho0 = clarke._cone()
    q = clarke._area(math.sin(math.radians(35.0)))
    rho, theta = 6378206.4 * math.sqrt(c - n * q) / n, n * math.radians(-75.0 + 96.0)
    assert rho * math.sin(theta) == pytest.approx(1885472.7, abs=0.1)
    assert rho0 - rho * math.cos(theta) == pytest.approx(1535925.0, abs=0.1)


def square(x0, y0, x1, y1):
    return [{"x": x0, "y": y0}, {"x": x1, "y": y0}, {"x": x1, "y": y1}, {"x": x0, "y": y1}, {"x": x0, "y": y0}]


POLYGONS = "name string, geometry array<array<struct<x:double,y:double>>>"


@pytest.mark.parametrize("cell", [0.3, 1.0, 50.0])
def test_borders_holes_and_parts(spark, cell):
    polygons = spark.createDataFrame([
        ("ring", [square(0.0, 0.0, 4.0, 4.0), square(1.0, 1.0, 3.0, 3.0)]),
        ("two", [square(10.0, 0.0, 11.0, 1.0), square(12.0, 0.0, 13.0, 1.0)]),
        ("next", [square(4.0, 0.0, 6.0, 4.0)])], POLYGONS)
    points = {
        "in ring": (0.5, 0.5), "hole": (2.0, 2.0), "hole border": (1.0, 2.0), "shared": (4.0, 2.0),
        "corner": (0.0, 0.0), "part": (12.5, 0.5), "between": (11.5, 0.5), "far": (99.0, 99.0),
        "top": (2.0, 4.0), "none": (None, 1.0), "left": (-0.5, 4.0)}
    df = spark.createDataFrame([(k, *v) for k, v in points.items()], "id string, x double, y double")
    out = got(spatial.point_in_polygon(df, polygons, cell), "id", "name")
    assert out == sorted([
        ("in ring", "ring"), ("hole", None), ("hole border", "ring"), ("shared", "ring"),
        ("shared", "next"), ("corner", "ring"), ("part", "two"), ("between", None), ("far", None),
        ("top", "ring"), ("none", None), ("left", None)], key=str)
    assert spatial.point_in_polygon(df, polygons, cell, how="inner").count() == 7


def test_cells_equal_brute_force(spark):
    import math
    rng = random.Random(11)
    stars = []
    for i in range(12):
        cx, cy = rng.uniform(0, 20), rng.uniform(0, 20)
        ring = [(cx + r * math.cos(t), cy + r * math.sin(t)) for t, r in
                ((k * math.tau / 40, rng.uniform(0.5, 6)) for k in range(40))]
        stars.append((str(i), ring))
    points = [(i, rng.uniform(-5, 25), rng.uniform(-5, 25)) for i in range(600)]

    def winding(px, py, ring):
        inside = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                inside = not inside
        return inside

    expected = sorted(((i, n) for i, x, y in points for n, ring in stars if winding(x, y, ring)), key=str)
    polygons = spark.createDataFrame(
        [(n, [[{"x": x, "y": y} for x, y in ring]]) for n, ring in stars], POLYGONS)
    df = spark.createDataFrame(points, "id long, x double, y double")
    assert got(spatial.point_in_polygon(df, polygons, 0.7, how="inner"), "id", "name") == expected


# --- look-ups ---------------------------------------------------------------

def test_enrich_keeps_rows_and_matches_missing_keys(spark):
    df = spark.createDataFrame([("A st",), ("a ST",), (None,), ("zz",)], "address string")
    book = spark.createDataFrame([("a st", 1.0), (None, 9.0)], "address string, X double")
    out = enrich.enrich_distinct(df, ["address"], book, normalize=F.lower)
    assert got(out, "address", "X") == [("A st", 1.0), ("a ST", 1.0), ("zz", None), (None, 9.0)]


def test_enrich_by_three_fields(spark):
    df = spark.createDataFrame([("1 A", "S", "WA"), ("1 A", "S", None)], "address string, city string, state string")
    book = spark.createDataFrame([("1 A", "S", "WA", 5)], "address string, city string, state string, X int")
    out = enrich.enrich_distinct(df, ["address", "city", "state"], book)
    assert got(out, "state", "X") == [("WA", 5), (None, None)]


def logged(log):
    """A provider that writes down what it is asked; it fails at its first call and knows no b."""
    def provider(frame):
        import os
        first = not os.path.exists(log)
        with open(log, "a") as f:
            f.write("".join("failed\n" if first else f"{a}\n" for a in frame.address))
        if first:
            raise RuntimeError("first call fails")
        known = frame[frame.address != "b"]
        return known.assign(X=known.address.fillna("").str.len().astype("float"))
    return provider


@pytest.mark.parametrize("missing", [False, True])
def test_provider_sees_each_key_once_and_is_retried(spark, tmp_path, missing):
    log, store = tmp_path / "calls", str(tmp_path / "store")
    keys = ["ab", "abc", "b"] + [None] * missing
    df = spark.createDataFrame([(k,) for k in keys for _ in range(20)], "address string").coalesce(1)

    def asked():
        return sorted(line for line in log.read_text().splitlines() if line != "failed")

    def enriched(rows, **more):
        return enrich.enrich_distinct(rows, ["address"], provider=logged(str(log)), schema="address string, X double", **more)

    out = enriched(df, store=store)
    want = sorted([("ab", 2.0), ("abc", 3.0), ("b", None)] + [(None, 0.0)] * missing, key=str)
    for _ in range(2):  # a join that runs again asks nothing
        assert got(out.distinct(), "address", "X") == want and out.count() == 20 * len(keys)
    assert asked() == sorted(map(str, keys))
    more = enriched(df.union(spark.createDataFrame([("abcd",)], "address string")), store=store)
    assert got(more.distinct(), "address", "X") == sorted([*want, ("abcd", 4.0)], key=str)
    assert asked() == sorted([*map(str, keys), "abcd"])  # nor does a later call, not even without an answer
    both = out.union(more)
    assert both.count() == 40 * len(keys) + 1 and both.where("address = 'abcd' AND X = 4").count() == 1
    assert enriched(df.limit(0), store=store).count() == 0 and asked() == sorted([*map(str, keys), "abcd"])
    with pytest.raises(ValueError):
        enrich.enrich_distinct(df, [])


def test_a_provider_that_answers_twice_or_fails_leaves_the_store_as_it_was(spark, tmp_path):
    store = str(tmp_path / "store")
    df = spark.createDataFrame([("a",), ("b",)], "address string")
    schema = "address string, X double"
    enrich.stored_answers(df.where("address = 'a'"), lambda f: f.assign(X=1.0), schema, store)

    def fails(frame):
        raise RuntimeError("out of service")

    for bad in (fails, lambda f: f.assign(X=1.0).loc[[*f.index, *f.index]]):
        with pytest.raises(Exception, match="out of service|twice"):
            enrich.stored_answers(df, bad, schema, store, attempts=2)
    again = enrich.stored_answers(df, lambda f: f.assign(X=2.0), schema, store)
    assert got(again, "address", "X") == [("a", 1.0), ("b", 2.0)]


def test_nearest_takes_two_jobs_to_plan_whatever_its_depth(spark, tmp_path):
    spark.range(300).selectExpr("id", "id / 1e6 AS x", "0.0D AS y", "string(id) AS address").write.parquet(str(tmp_path / "p"))
    book = spark.read.parquet(str(tmp_path / "p")).drop("id")
    context = spark.sparkContext
    context.setJobGroup("nearest", "nearest")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which runs each stage as a job of its own
    try:
        out = enrich.enrich_nearest(spark.range(5).selectExpr("id", "0.1D AS x", "0.0D AS y"), "x", "y", book, 1.0, crowded=2)
        assert len(context.statusTracker().getJobIdsForGroup("nearest")) <= 3  # and one for the footer of what is read
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        context.setLocalProperty("spark.jobGroup.id", None)
    assert [r.rev_address for r in out.collect()] == ["299"] * 5


@pytest.mark.parametrize("crowded", [False, True])
def test_nearest_equals_brute_force(spark, crowded):
    rng = random.Random(17)
    spread = 0.4 if crowded else 60
    places = [(f"p{i:04d}", rng.uniform(0, spread), rng.uniform(0, spread)) for i in range(300)]
    places += [("z twin", places[0][1], places[0][2])]
    asked = [(i, rng.uniform(-3, spread + 3), rng.uniform(-3, spread + 3)) for i in range(200)]
    asked += [(900, None, 1.0), (901, asked[0][1], asked[0][2]), (902, 1e6, 1e6)]

    def nearest(x, y):
        if x is None:
            return None
        d, name = min((((x - a) ** 2 + (y - b) ** 2) ** 0.5, n) for n, a, b in places)
        return name.upper() if d <= 2.5 else None

    df = spark.createDataFrame(asked, "id long, x double, y double")
    book = spark.createDataFrame(places, "address string, x double, y double")
    out = enrich.enrich_nearest(df, "x", "y", book, 2.5, crowded=8)
    assert got(out, "id", "rev_address") == sorted(((i, nearest(x, y)) for i, x, y in asked), key=str)


def test_a_size_text_is_cleaned_once_a_row(spark):
    df = spark.createDataFrame([("Studios 4 RENT $1,500 View", None)], "rent_inv_0B string, rent_inv_1B string")
    out = reshape.inventory_by_size(df, ["rent_inv_0B", "rent_inv_1B"])
    assert got(out, "beds", "inv", "rent") == [(0.0, 4.0, "1500")]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Bedrooms") == 1


def test_nearest_shuffles_no_candidates_per_coordinate(spark, tmp_path):
    """200 coordinates stand in one cell with 400 places within reach of each."""
    spark.range(400).selectExpr("string(id) AS address", "id % 20 * 0.3D AS x", "floor(id / 20) * 0.3D AS y").write.parquet(str(tmp_path / "p"))
    df = spark.range(200).selectExpr("id", "id * 0.025D + 0.4D AS x", "id % 7 * 0.5D + 1.01D AS y")
    df.write.parquet(str(tmp_path / "d"))
    out = enrich.enrich_nearest(
        spark.read.parquet(str(tmp_path / "d")), "x", "y", spark.read.parquet(str(tmp_path / "p")), 5.0, crowded=400)
    for r in out.collect():
        away = [((r.x - p % 20 * 0.3) ** 2 + (r.y - p // 20 * 0.3) ** 2) ** 0.5 for p in range(400)]
        assert r.rev_distance == pytest.approx(min(away)) == pytest.approx(away[int(r.rev_address)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HYPOT" in plan.upper() and "Window" not in plan


def test_geoparse(spark):
    text = "Cozy. 12 N Oak Ave near park\nSeattle, WA 98105-1234"
    df = spark.createDataFrame([(text, "s"), (text, "s"), ("call", "s")], "listing_text string, city1 string")
    book = spark.createDataFrame([("12 N Oak Ave Seattle, WA 98105", 1.5)], "temp_add string, lng double")
    out = enrich.geoparse(df, "listing_text", ["listing_text", "city1"], book)
    assert got(out, "match_address", "match_address2", "temp_add", "lng") == [
        ("12 N Oak Ave", "Seattle, WA 98105", "12 N Oak Ave Seattle, WA 98105", 1.5),
        (None, None, "NA NA", None)]
    for fields in (["gone"], ["city1"]):
        with pytest.raises(ValueError):
            enrich.geoparse(df, "listing_text", fields, book)
    with pytest.raises(Exception, match="twice"):
        enrich.geoparse(df, "listing_text", ["listing_text", "city1"], book.union(book)).collect()


FIELDS = ["address1", "neigh1", "city1", "region1", "google_maps_url", "listing_text"]


@pytest.mark.parametrize("record, want", [
    # the text tells all; fields that say otherwise count nothing
    (("9 Elm St", None, "Tacoma", "OR", None, "12 Oak Ave. Seattle, WA 98105"), ("12 Oak Ave", "Seattle, WA 98105", 1.0)),
    # street from the first field that has one, the rest from the text
    (("near the park", "12 Oak Ave", "Tacoma", "WA", None, "Seattle, WA 98105-1234"), ("12 Oak Ave", "Seattle, WA 98105", 1.0)),
    # city and region from fields, ZIP from the text or from a field
    (("12 Oak Ave", None, " Seattle ", "WA", None, "ZIP 98105-1234"), ("12 Oak Ave", "Seattle, WA 98105", 1.0)),
    (("12 Oak Ave", None, "Seattle", "WA", None, None), ("12 Oak Ave", "Seattle, WA 98105", 1.0)),
    # no ZIP anywhere: of two addresses the one at the map link
    (("12 Oak Ave", None, "Seattle", "WA", "https://m.example.org/maps/search/47.9,-122.0", "call"), ("12 Oak Ave", "Seattle, WA 98199", 2.0)),
    (("12 Oak Ave", None, "Seattle", "WA", "https://m.example.org/maps/search/47.1,-122.0", ""), ("12 Oak Ave", "Seattle, WA 98105", 1.0)),
    # nothing to choose from, and nothing at all
    (("13 Oak Ave", None, "Seattle", "WA", None, "x"), ("13 Oak Ave", "Seattle, WA", None)),
    ((None, None, "Seattle", "WA", None, "x"), (None, "Seattle, WA", None)),
    ((None, None, "", "WA", None, None), (None, None, None)),
])
def test_fields_fill_in_what_the_text_lacks(spark, record, want):
    df = spark.createDataFrame([record], ", ".join(f"{f} string" for f in FIELDS))
    book = spark.createDataFrame(
        [("12 Oak Ave Seattle, WA 98105", -122.0, 47.0, 1.0), ("12 Oak Ave Seattle, WA 98199", -122.0, 48.0, 2.0)],
        "temp_add string, lng double, lat double, n double")
    out = enrich.geoparse(df, "listing_text", FIELDS, book)
    assert out.columns == [*FIELDS, "match_address", "match_address2", "temp_add", "lng", "lat", "n"]
    [row] = out.collect()
    assert (row.match_address, row.match_address2, row.n) == want
    assert row.temp_add == f"{want[0] or 'NA'} {want[1] or 'NA'}"


@pytest.mark.parametrize("text, street, city", [
    ("Sunny home in Seattle, WA 98101", None, "Seattle, WA 98101"),
    ("Located near Green Lake. Seattle, WA 98105-1234", None, "Seattle, WA 98105"),
    ("4500 9th Ave NE, Seattle, WA 98105", "4500 9th Ave NE", "Seattle, WA 98105"),
    ("1200 Martin Luther King Junior Memorial Way S, Seattle, WA 98144",
     "1200 Martin Luther King Junior Memorial Way S", "Seattle, WA 98144"),
    ("at 1234567 N Oak St. St. Paul, MN 55101 now", "1234567 N Oak St", "St. Paul, MN 55101"),
    ("Come to Llanfairpwllgwyngyllgogerychwyrndrobwllllantysiliogogogoch, WA 98101", None,
     "Llanfairpwllgwyngyllgogerychwyrndrobwllllantysiliogogogoch, WA 98101"),
    ("call 555 1234 today", None, None),
])
def test_addresses_in_prose(spark, text, street, city):
    df = spark.createDataFrame([(text,)], "t string")
    book = spark.createDataFrame([("x", 1.0)], "temp_add string, lng double")
    row = enrich.geoparse(df, "t", ["t"], book).first()
    assert (row.match_address, row.match_address2) == (street, city)


def test_rows_without_a_key_pass_by_the_look_up(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "i int, k string")
    book = spark.createDataFrame([("a", 1.5)], "k string, v double")
    out = enrich.enrich_distinct(df, ["k"], book)
    assert out.columns == ["i", "k", "v"] and got(out, "i", "v") == [(1, None), (2, 1.5), (3, None)]
    empty = spark.createDataFrame([("a", 1.5), (None, 9.0)], "k string, v double")
    assert got(enrich.enrich_distinct(df, ["k"], empty), "i", "v") == [(1, 9.0), (2, 1.5), (3, None)]
    for twice in (book.union(book), empty.union(empty.where("k is null"))):
        with pytest.raises(Exception, match="twice"):
            enrich.enrich_distinct(df, ["k"], twice).count()


def test_nothing_runs_while_a_look_up_is_planned(spark, smallest):
    from rentloom.workload import inputs

    context = spark.sparkContext
    rows = inputs.ads(spark, smallest).selectExpr("ad", "concat(l_partkey, ' bell st, ', n_name) AS address")
    book = inputs.address_book(spark, smallest)
    context.setJobGroup("planning", "planning")
    try:
        enrich.enrich_distinct(rows, ["address"], book, normalize=F.upper)
        joins.natural_left(rows, book, unique=True)
        assert list(context.statusTracker().getJobIdsForGroup("planning")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_a_look_up_is_read_once_and_missing_keys_are_dealt_out(spark, tmp_path):
    spark.createDataFrame([("a", 1.5), (None, 9.0)], "k string, v double").write.parquet(str(tmp_path / "book"))
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'a' END AS k")
    out = enrich.enrich_distinct(df, ["k"], spark.read.parquet(str(tmp_path / "book")).hint("merge"))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.split("Initial Plan")[0].count("FileScan") == 1
    assert out.groupBy("v").count().collect().__len__() == 2
    groups = [r.n for r in df.where("k is null").selectExpr(
        f"pmod(xxhash64(id, k, '_match'), {enrich.SALTS}) AS s").groupBy("s").agg(F.count("*").alias("n")).collect()]
    assert len(groups) == enrich.SALTS and max(groups) < 120


def test_projected_rings(spark):
    df = spark.createDataFrame([("a", [square(-96.0, 23.0, -95.0, 24.0)])], POLYGONS)
    first = df.select(project_rings(F.col("geometry")).alias("g")).first().g[0][0]
    assert first.x == pytest.approx(0, abs=1e-6) and first.y == pytest.approx(0, abs=1e-6)


def test_offers_take_the_first_per_size(spark):
    text = "$1,200+\nStudio$1,500\n1 bd$1,700\n1 bds$9,900\n12 bd$800\n13 bd$12\n2 bd$1,234,567\n3 bd"
    df = spark.createDataFrame([(text,), (None,), ("none",)], "t string")
    out = reshape.offers_in_text(df, F.col("t"), "o").select(F.inline("o"))
    assert got(out, "beds", "rent") == [(0.0, "1,200"), (1.0, "1,500"), (12.0, "9,900")]
