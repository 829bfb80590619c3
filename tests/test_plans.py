"""What the plans must look like to hold at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from rentloom.operators import dedupe, enrich, spatial, stats
from rentloom.plans import apartments, craigslist, gosection8, padmapper, stacked, tables, trulia, zillow
from rentloom.session import shared_folder
from rentloom.sources import files
from rentloom.sources.tables import apartments_scan, parquet_table, site_scan
from rentloom.workload import inputs, queries


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(queries.REGISTERED))
def test_no_cross_join_and_no_python_in_the_core(spark, smallest, name):
    text = plan(queries.REGISTERED[name](spark, smallest))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark, smallest, tmp_path):
    inputs.geocoded(spark, smallest).write.parquet(str(tmp_path / "geocoded.parquet"))
    table = parquet_table(spark, str(tmp_path), "geocoded")
    text = plan(apartments_scan(table).select("beds", "rent_mid"))
    scan = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "EqualTo(source" in scan and "GreaterThanOrEqual(listing_date" in scan
    assert "In(cbsafp" in scan
    read = next(line for line in text.splitlines() if "ReadSchema" in line)
    assert "geo_address" not in read and "beds" in read


def test_site_filter_reaches_the_scan(spark, smallest, tmp_path):
    inputs.extra_markets(spark, smallest).write.parquet(str(tmp_path / "m.parquet"))
    text = plan(site_scan(parquet_table(spark, str(tmp_path), "m"), "homes.com"))
    assert "EqualTo(website,homes.com)" in text


def test_dedupe_trims_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 5 AS k", "id", "cast(id AS string) AS payload")
    text = plan(dedupe.keep_first(df, ["k"], ["id"]))
    tree = text.split("(1) ")[0]
    assert tree.count("WindowGroupLimit") == 2 and tree.count("Exchange") == 1
    assert "row_number(), 1, Partial" in text


def test_stacked_dedupe_shuffles_no_column_twice(spark):
    df = spark.createDataFrame([(1.0, "a", "x"), (1.0, "a", "w"), (2.0, "b", "y")], "rent double, address string, url string")
    one = dedupe.Source(df, [df["rent"], df["address"]], [df["url"]])
    named = dedupe.Source(df, [F.col("rent"), F.col("address")], [F.col("url")])
    columns = {"rent": "double", "address": "string", "url": "string", "inv": "double"}
    out = dedupe.keep_first_stacked({"a": named, "b": named}, columns)
    assert sorted(map(tuple, out.collect())) == sorted(
        (s, *r, None) for s in "ab" for r in [(1.0, "a", "w"), (2.0, "b", "y")])
    assert sorted(map(tuple, dedupe.keep_first_stacked({"a": one, "b": named}, columns).collect())) == sorted(map(tuple, out.collect()))
    exchange = [line for line in plan(out).split("Exchange\n")[1].splitlines() if line.startswith("Input")]
    assert "[4]" in exchange[0] or "[5]" in exchange[0], exchange


def test_a_table_of_many_splits_is_not_dealt_out(spark, smallest, tmp_path):
    spark.range(1000).repartition(40).write.option("maxRecordsPerFile", 5).parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert many.rdd.getNumPartitions() >= 8
    assert "Exchange" not in plan(inputs.dealt(many))
    assert "Exchange" in plan(inputs.dealt(parquet_table(spark, smallest, "lineitem")))


def test_dedupe_with_an_order_reads_only_what_is_used(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(10).selectExpr("id % 5 AS k", "id", "'long' AS body").write.parquet(path)
    out = dedupe.keep_first(spark.read.parquet(path), ["k"], ["id"]).select("k", "id")
    read = next(line for line in plan(out).splitlines() if "ReadSchema" in line)
    assert "body" not in read


def test_quantiles_read_the_input_once(spark, smallest):
    df = stats.weighted_quantiles(inputs.listings(spark, smallest), ["source"], "rent", "inv")
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final
    # Partial sums run before the first shuffle.
    assert final.count("Scan parquet") == 3


def test_summary_groups_are_split_before_they_are_sorted(spark, smallest):
    text = plan(tables.rent_summary(tables.classified(
        inputs.listings(spark, smallest), queries._county(spark, smallest))))
    windows = [line for line in text.splitlines() if "hashpartitioning" in line and "_bucket" in line]
    assert windows


def test_points_are_not_shuffled_by_a_small_index(spark, smallest):
    points = spark.range(100).selectExpr("id", "-100 + id / 10 AS x", "30.0D AS y")
    outlines = queries._outlines(spark, smallest)
    tree = plan(spatial.point_in_polygon(points, outlines, 0.5)).split("(1) ")[0]
    assert "BroadcastHashJoin" in tree and tree.replace("BroadcastExchange", "").count("Exchange") == 0


def test_padmapper_rows_are_located_once_for_both_labels(spark):
    rows = spark.createDataFrame([("a", "b", "c", 1.0, 500.0, 3.0)],
                                 "cbsafp string, fips string, namelsad string, beds double, rent double, inv double")
    text = plan(tables.located_parts({"padmapper": rows}))
    assert text.split("(1) ")[0].count("Scan ExistingRDD") == 1


def test_no_window_without_partition(spark, smallest):
    for name in ("building_share", "rent_summary", "dedupe_latest"):
        text = plan(queries.REGISTERED[name](spark, smallest))
        for line in text.splitlines():
            if line.startswith("Arguments: [") and "windowspecdefinition(" in line:
                inside = line.split("windowspecdefinition(")[1]
                assert not inside.startswith("specifiedwindowframe"), name


def test_landed_ads_are_scanned_and_checked_once(spark, smallest):
    """Line items are read once for all sites; Padmapper reads its rows once."""
    text = plan(queries.REGISTERED["listing_table"](spark, smallest)).split("(1) ")[0]
    assert text.count("lineitem") == 0
    raw = inputs.padmapper(spark, smallest)
    one = plan(padmapper.typed(raw, queries.flat(queries._county(spark, smallest)))).split("(1) ")[0]
    assert one.count("Generate") - plan(raw).split("(1) ")[0].count("Generate") == 1


def _raw_sites(spark, smallest):
    base = inputs.ads(spark, smallest)
    return {
        "craigslist": inputs.craigslist(spark, smallest), "apartments": inputs.geocoded(spark, smallest, base),
        "gosection8": inputs.gosection8(spark, smallest, base), "trulia": inputs.trulia(spark, smallest, base),
        "zillow": inputs.zillow(spark, smallest, base), "padmapper": inputs.padmapper(spark, smallest, base)}


def test_all_sites_are_deduplicated_in_one_shuffle(spark, smallest):
    dim = queries.flat(queries._county(spark, smallest))
    text = plan(stacked.deduplicated(_raw_sites(spark, smallest), dim))
    by_site = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning") and "site#" in line]
    assert len(by_site) == 1
    tree = text.split("(1) ")[0]
    # Padmapper's ads are told apart once more before they are split by size
    assert tree.count("WindowGroupLimit") == 4 and tree.count("SortMergeJoin") == 0


def test_the_stack_keeps_what_each_site_keeps(spark, smallest):
    """Rows per site as from the sites' own plans, before and after they are located."""
    raw = _raw_sites(spark, smallest)
    county = queries._county(spark, smallest)
    dim, book = queries.flat(county), inputs.address_book(spark, smallest)
    alone = tables.located_parts({
        "craigslist": craigslist.build(raw["craigslist"], county), "apartments": apartments.build(raw["apartments"], dim),
        "gosection8": gosection8.build(raw["gosection8"], dim), "trulia": trulia.build(raw["trulia"], dim),
        "zillow": zillow.build(raw["zillow"], dim), "padmapper": padmapper.build(raw["padmapper"], county, book)})
    cells = spatial.cell_index(county.drop("container"), 20_000.0)
    together = stacked.located(raw, dim, cells, book, shared_folder(spark), 20_000.0)
    assert together.columns == alone.columns
    assert together.exceptAll(alone).count() == alone.exceptAll(together).count() == 0


def test_a_table_in_folders_per_site_is_read_in_part(spark, smallest, tmp_path):
    table = files.land(inputs.extra_markets(spark, smallest), str(tmp_path / "markets"), by=["website"])
    text = plan(site_scan(table, "homes.com"))
    assert "(website#" in next(line for line in text.splitlines() if line.startswith("PartitionFilters"))
    assert site_scan(table, "homes.com").count() == site_scan(inputs.extra_markets(spark, smallest), "homes.com").count() > 0


def test_shares_of_four_sites_take_one_scan_and_one_dedupe(spark, smallest):
    tree = plan(queries.REGISTERED["building_share"](spark, smallest)).split("(1) ")[0]
    assert tree.count("WindowGroupLimit") == 2 and "Union" not in tree
    assert tree.count("Scan parquet") == 4  # line items, suppliers, nations, regions


def test_rows_without_a_key_are_dealt_out_for_the_look_up(spark, smallest):
    text = plan(queries.REGISTERED["geoparse"](spark, smallest))
    assert any("_salt" in line for line in text.splitlines() if line.startswith("Left keys"))


def _methods(spark, df):
    """Bytes of the largest generated method of each compiled stage of a frame that has run."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]


def test_methods_of_padmapper_are_compiled(spark, smallest):
    """Java only interprets methods of more than 8000 bytes, whatever Spark's own limit is."""
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        out = queries.REGISTERED["site_padmapper"](spark, smallest)
        out.collect()
        assert max(_methods(spark, out)) <= 8000
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", limit)


def test_points_are_not_tested_for_null_by_their_formula(spark):
    points = spark.range(10).selectExpr("id", "sqrt(id * 1.5D) AS x", "sqrt(id * 2.5D) AS y")
    cells = spark.createDataFrame([("a", [[{"x": 0.0, "y": 0.0}, {"x": 9.0, "y": 0.0}, {"x": 0.0, "y": 9.0}]])],
                                  "name string, geometry array<array<struct<x: double, y: double>>>")
    out = spatial.point_in_polygon(points, cells, 1.0, how="inner")
    assert out.count() > 0
    filters = [line for line in plan(out).splitlines() if line.startswith("Condition")]
    assert not [line for line in filters if "xxhash64" in line]


def test_a_key_is_shuffled_once_to_its_look_up(spark, tmp_path):
    spark.createDataFrame([("a", 1.5)], "k string, v double").write.parquet(str(tmp_path / "book"))
    rows = spark.range(9).selectExpr("id", "CASE WHEN id > 1 THEN if(id > 4, 'a', '') END AS k")
    out = enrich.enrich_distinct(rows, ["k"], spark.read.parquet(str(tmp_path / "book")).hint("merge"))
    assert out.columns == ["id", "k", "v"]
    assert sorted(map(tuple, out.collect())) == [
        (i, None if i < 2 else "a" if i > 4 else "", 1.5 if i > 4 else None) for i in range(9)]
    sent = [part for part in plan(out).split("Exchange\n")[1:] if "id#" in part.splitlines()[0]]
    assert sent and "[4]" in sent[0].splitlines()[0]


def test_what_tells_buildings_apart_is_not_shuffled_with_units(spark, smallest):
    ads = padmapper.distinct_ads(padmapper.tidy(inputs.padmapper(spark, smallest)))
    sent = [part.splitlines()[0] for part in plan(ads).split("Exchange\n")[1:] if "_own#" in part.splitlines()[0]]
    assert len(sent) == 1 and "_loc#" in sent[0] and " loc#" not in sent[0]
