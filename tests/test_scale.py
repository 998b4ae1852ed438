"""Sliced windows give what plain windows give."""

from datetime import date, datetime, timedelta
from glob import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapweave import Settings
from tapweave.functions import windows
from tapweave.functions.stage import stage
from tapweave.functions.windows import cut_table, hot_groups, near_window, running_sum
from tapweave.operators import interline, visits
from tapweave.plans import prepare

T0 = datetime(2024, 1, 5)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for key, n in (("hot", 800), (None, 300), ("cold", 7), ("one", 1)):
        for i in range(n):
            ts = None if rng.random() < 0.01 else T0 + timedelta(seconds=rng.randrange(0, 30_000))
            data.append((key, ts, len(data), rng.randrange(0, 3)))
    return spark.createDataFrame(data, "k string, ts timestamp, id int, v int").cache()


@pytest.mark.parametrize("most", [1, 2, 9, 250, 10**9])
def test_near_window_equals_plain(rows, most):
    order = [F.col("ts"), F.col("id")]

    def columns(w):
        return {
            "back": F.lag("id").over(w),
            "ahead": F.lead("id", 2).over(w),
            "mean": F.round(F.avg("v").over(w.rowsBetween(-2, 2)), 9),
        }

    plain = rows.withColumns(columns(Window.partitionBy("k").orderBy(*order)))
    split = near_window(rows, ["k"], order, 2, columns, hot_groups(rows, ["k"], most), most)
    assert sorted(plain.collect(), key=lambda r: r.id) == sorted(split.collect(), key=lambda r: r.id)


@pytest.mark.parametrize("most", [1, 40, 10**9])
def test_running_sum_equals_plain(rows, most):
    order = [F.col("ts"), F.col("id")]
    plain = rows.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy(*order)))
    split = running_sum(rows, ["k"], order, F.col("v"), "s", hot_groups(rows, ["k"], most), most)
    assert sorted(plain.collect(), key=lambda r: r.id) == sorted(split.collect(), key=lambda r: r.id)


@pytest.fixture(scope="module")
def located(spark):
    """One trip and one block hold most of the rows."""
    rng = random.Random(9)
    day = date(2024, 1, 5)
    data = []
    for trip in range(40):
        n = 400 if trip == 0 else 8
        start = rng.randrange(0, 40_000)
        for seq in range(n):
            arrive = T0 + timedelta(seconds=start + seq * 40)
            data.append((day, trip, seq, rng.randrange(1, 5), arrive, arrive + timedelta(seconds=rng.choice((0, 20))),
                         trip % 3, "A", trip % 2, None if trip < 30 else 1))
    schema = (
        "service_date date, trip_id int, stop_sequence int, stop_id int, arrive_datetime timestamp,"
        " departure_datetime timestamp, route_id int, service_id string, direction_id int, block_id int"
    )
    return spark.createDataFrame(data, schema).cache()


def same(a, b):
    assert sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(a.columns)).collect()))


def cut(df, keys, rows=20):
    hot = hot_groups(df, keys, rows)
    assert hot is not None
    return hot, rows


def test_visits_with_hot_trip_and_stop(located):
    whole = visits.merge_repeated_stops(located)
    assert whole.count() < located.count()
    same(whole, visits.merge_repeated_stops(located, *cut(located, visits.TRIP_KEYS)))
    same(visits.add_headways(whole), visits.add_headways(whole, *cut(whole, visits.HEADWAY_KEYS)))


@pytest.mark.parametrize("first", [3, 398])
def test_headways_without_arrival_in_hot_stop(located, first):
    gaps = located.withColumn("arrive_datetime", F.when(F.col("stop_sequence") > first, F.col("arrive_datetime")))
    same(visits.add_headways(gaps), visits.add_headways(gaps, *cut(gaps, visits.HEADWAY_KEYS)))


def test_equal_times_keep_every_row(located):
    # ties in the order may not let a row fall between the two parts of a window
    tied = located.withColumn("arrive_datetime", F.date_trunc("hour", "arrive_datetime"))
    twice = tied.unionByName(tied)
    assert visits.add_headways(twice, *cut(twice, visits.HEADWAY_KEYS, 10)).count() == twice.count()


def test_rows_without_time_are_cut_too(located):
    none = located.withColumn("arrive_datetime", F.lit(None).cast("timestamp"))
    hot, rows = cut(none, visits.HEADWAY_KEYS)
    cuts = cut_table(none, visits.HEADWAY_KEYS, [F.col("arrive_datetime"), F.col("trip_id"), F.col("stop_sequence")], 3, rows, hot)
    assert cuts.select(F.max(F.size("__cuts"))).first()[0] > 3
    same(visits.add_headways(none), visits.add_headways(none, hot, rows))


def test_chains_with_hot_block(located):
    ends = interline.trip_ends(located)
    hot = cut(ends, interline.BLOCK_KEYS, 4)
    whole = interline.link_blocks(ends)
    assert whole.where("interlines_with_trip_id IS NOT NULL").count() > 0
    same(whole, interline.link_blocks(ends, *hot))
    chains = interline.chain_trips(whole)
    same(chains, interline.chain_trips(whole, *hot))


def scans_and_shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Scan parquet"), plan.count("Exchange hashpartitioning")


def test_one_read_and_one_shuffle(located):
    """As planned, before anything is run; cut groups add broadcasts of small tables only."""
    rows = stage(located, "located")
    by_stop = cut(rows, visits.HEADWAY_KEYS)
    assert scans_and_shuffles(visits.merge_repeated_stops(rows)) == (1, 1)
    assert scans_and_shuffles(visits.add_headways(rows)) == (1, 1)
    merged = visits.merge_repeated_stops(rows)
    assert scans_and_shuffles(visits.add_headways(merged)) == (1, 2)
    ends = stage(interline.trip_ends(rows), "ends")
    blocks = interline.link_blocks(ends)
    assert scans_and_shuffles(blocks) == (1, 1)
    # the windows of links and chains share a shuffle, the second gathers the trips of each chain
    assert scans_and_shuffles(interline.chain_trips(blocks))[0] == 1
    near = near_window(rows, visits.HEADWAY_KEYS, [F.col("arrive_datetime")], 1, lambda w: {"n": F.lead("trip_id").over(w)}, *by_stop)
    # the table of cuts is a second, small file
    assert scans_and_shuffles(near) == (2, 1)


def test_trips_without_a_block_can_be_left_unlinked(located):
    ends = interline.trip_ends(located)
    every, some = interline.link_blocks(ends), interline.link_blocks(ends, null_blocks=False)
    assert some.columns == every.columns and some.count() == every.count()
    assert every.where("block_id IS NULL AND interlines_with_trip_id IS NOT NULL").count() > 0
    assert some.where("block_id IS NULL AND route_id_next IS NOT NULL").count() == 0
    same(some.where("block_id IS NOT NULL"), every.where("block_id IS NOT NULL"))
    assert interline.chain_trips(some).count() == ends.count()


def test_marked_stops_and_merged_stops(located):
    marked = visits.mark_repeated_stops(located)
    assert marked.count() == located.count() and marked.where("is_repeated").count() > 0
    same(visits.drop_repeated_stops(marked), visits.merge_repeated_stops(located))
    same(marked, visits.mark_repeated_stops(located, *cut(located, visits.TRIP_KEYS)))


def shuffles_without_broadcasts(spark, build):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = build()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]


def test_trip_data_and_repeated_stops_share_a_shuffle(spark):
    """Of the given columns, by trip; headways take the second one, and nothing derived is in either."""
    raw = spark.createDataFrame(
        [(t, str(1 + n // 2), n, f"08:{n:02d}:00", f"08:{n:02d}:30", date(2024, 1, 5)) for t in range(6) for n in range(9)],
        "trip_id int, stop_id string, stop_sequence int, actual_arrive_time string, actual_departure_time string, service_date date",
    )
    trips = spark.createDataFrame([(t, f"{t}a", "A", 0, 1) for t in range(6)], "trip_id int, route_id string, service_id string, direction_id int, block_id int")
    stops = spark.createDataFrame([(n, date(2024, 1, 1), 45.0 + n, -122.0) for n in range(1, 6)], "stop_id int, release_date date, stop_lat double, stop_lon double")
    tapped = spark.createDataFrame([(date(2024, 1, 5),)], "service_date date")
    raw, trips = stage(raw, "raw"), stage(trips, "trips")
    s = Settings()
    scheduled = lambda: prepare.scheduled_visits(raw, trips, tapped, s, strict=False)
    # the visits, and the trips on the other side of the join
    lines = [x.lower() for x in shuffles_without_broadcasts(spark, scheduled)]
    assert len([x for x in lines if "(trip_id#" in x]) == 2 and not [x for x in lines if ", trip_id#" in x], lines
    positions = stage(prepare.stop_positions(stops, tapped), "positions")
    written = stage(scheduled(), "scheduled")
    done = prepare.prepare_visits(written, positions, s)
    assert scans_and_shuffles(done.select("trip_id", "stop_lat", "mean_boarding_interval_seconds"))[1] == 1
    # without headways there is nothing to shuffle for
    assert scans_and_shuffles(done.select("trip_id", "stop_id", "stop_lat"))[1] == 0
    old = visits.add_stop_locations(visits.numeric_routes(visits.add_trip_data(visits.add_visit_times(raw), trips)), stops, tapped)
    same(prepare.located_visits(written, positions).select("trip_id", "stop_sequence", "route_id", "stop_lat", "arrive_datetime"),
         old.select("trip_id", "stop_sequence", "route_id", "stop_lat", "arrive_datetime"))
    same(done.select("trip_id", "stop_sequence"), visits.merge_repeated_stops(old).select("trip_id", "stop_sequence"))


def test_no_table_is_written_where_no_group_is_hot(rows, monkeypatch):
    def fail(*_):
        raise AssertionError("written")

    monkeypatch.setattr(windows, "stage", fail)
    assert hot_groups(rows, ["k"], 10_000) is None
    with pytest.raises(AssertionError):
        hot_groups(rows, ["k"], 700)


def test_staged_times_are_small(spark):
    """Whole seconds in order and hashes: a few bits a time, half of a hash."""
    df = spark.range(0, 200_000, 1, 1).selectExpr("timestamp_seconds(1704067200 + 7 * id) AS t", "sha2(CAST(id AS string), 256) AS h")
    files = glob(f"{stage(df, 'times').inputFiles()[0].removeprefix('file://').rsplit('/', 1)[0]}/*.parquet")
    size = {}
    for column in (c for f in files for g in range(pq.ParquetFile(f).num_row_groups) for c in [pq.ParquetFile(f).metadata.row_group(g)]):
        for i in range(column.num_columns):
            part = column.column(i)
            size[part.path_in_schema] = size.get(part.path_in_schema, 0) + part.total_compressed_size
    assert size["t"] < 2 * 200_000 and size["h"] < 40 * 200_000, size
