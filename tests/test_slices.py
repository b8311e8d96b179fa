"""Slices of equal weight, zone maps and collapsed change logs against plain versions."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta
from statistics import median

import pytest

from acceptance.jdbc import fill_table, jdbc_options
from batchload import BatchRequest, build, tumbling
from batchload.operators import audit, collapse, slices
from batchload.operators.extract import assign_batches
from batchload.sources import jdbc, zones

DAY = 86400
START = datetime(2024, 1, 1)


def skewed(spark):
    """Forty days, of which one has half of all rows; keys below zero and null ones."""
    rows = [(i - 50, START + timedelta(hours=i * 40 * 24 / 900)) for i in range(900)]
    rows += [(1000 + i, START + timedelta(days=7, seconds=i % 5)) for i in range(900)]
    rows += [(None, START + timedelta(days=7)), (None, START + timedelta(days=20))]
    return spark.createDataFrame(rows, "id long, t timestamp_ntz").cache()


@pytest.mark.parametrize("n", [1, 2, 7, 16, 60])
def test_slices_are_even_and_lose_nothing(spark, n):
    rows = skewed(spark)
    plan = tumbling(spark, "20240101", "20240210", "yyyyMMdd", DAY)
    tagged = assign_batches(rows, plan, "t")
    counted = audit.row_counts_all(tagged, plan)
    found = slices.places(counted, n)
    cuts = slices.cut_keys(tagged, "id", found)
    sizes = [r["count"] for r in tagged.groupBy(slices.slice_number(cuts, "id")).count().collect()]
    assert sum(sizes) == tagged.count() and len(sizes) <= n
    assert len(sizes) == n and max(sizes) <= 2 * median(sizes)
    tests = jdbc._slice_tests(plan, cuts, "id", lambda p: jdbc.predicate(p, "t", None, lambda v: f"TIMESTAMP_NTZ'{v}'"))
    # One test for each row, as Spark reads the predicates too.
    hits = [tagged.where(test).count() for test in tests]
    assert sum(hits) == tagged.count() and sorted(hits) == sorted(sizes)


def test_the_running_sums_go_over_chunks(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(b, rng.randint(0, 9)) for b in range(500) if b % 7]
    monkeypatch.setattr(slices, "CHUNK", 16)
    got = slices.rows_before(spark.createDataFrame(rows, "batch_id long, n_rows long")).collect()
    before, expected = 0, {}
    for b, n in rows:
        expected[b] = before
        before += n
    assert {r.batch_id: r.before for r in got} == expected


def test_no_rows_no_cuts(spark):
    empty = spark.createDataFrame([], "batch_id long, n_rows long")
    assert slices.places(empty, 5) == [] and slices.cut_keys(empty, "batch_id", []) == []
    with pytest.raises(ValueError):
        slices.places(empty, 0)


@pytest.mark.parametrize("n", [1, 5, 24])
def test_sliced_scan_of_a_database(spark, n):
    rows = skewed(spark)
    options = jdbc_options(spark)
    name = fill_table(rows, options, "sliced")
    plan = tumbling(spark, "20240103", "20240205", "yyyyMMdd", DAY)
    counted = audit.row_counts(assign_batches(rows, plan, "t"))
    got = jdbc.scan_sliced(spark, options, name, plan, counted, n, "id", "t", key_sql='"id"', time_sql='"t"')
    expected = assign_batches(rows, plan, "t")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))
    assert got.rdd.getNumPartitions() == n
    # Counts that are wrong make uneven slices and lose no row.
    wrong = counted.selectExpr("batch_id", "CAST(1 AS bigint) AS n_rows")
    again = jdbc.scan_sliced(spark, options, name, plan, wrong, n, "id", "t", key_sql='"id"', time_sql='"t"')
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, expected.collect()))


def test_sliced_scan_of_layers(spark):
    """An open range and named partitions overlap: each is a scan of its own."""
    rows = skewed(spark).selectExpr("id", "t", "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS p")
    options = jdbc_options(spark)
    name = fill_table(rows, options, "layers", "p VARCHAR(9)")
    request = BatchRequest("j", "yyyyMMdd", start="20240108", partitions="a,b:20240102-20240120,a", interval_seconds=DAY)
    plan = build(spark, request)
    expected = assign_batches(rows, plan, "t", "p")
    got = jdbc.scan_sliced(
        spark, options, name, plan, audit.row_counts(expected), 4, "id", "t", "p",
        key_sql='"id"', time_sql='"t"', partition_sql='"p"',
    )
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))


@pytest.fixture
def files(spark, tmp_path):
    path = str(tmp_path / "data set")
    rows = spark.range(2400).selectExpr("id", "timestamp_ntz'2024-01-01' + id * interval '1' hour AS t", "id % 3 AS p")
    rows.repartitionByRange(20, "t").write.partitionBy("p").parquet(path)
    return path, str(tmp_path / "zones")


def test_zone_map_reads_few_files_and_all_rows(spark, files):
    path, map_path = files
    found = zones.update(spark, map_path, path, "t")
    table = spark.read.parquet(path)
    assert found.count() == len(table.inputFiles()) == 60
    for first, last, most in (("20240105", "20240106", 6), ("20240101", "20240201", 27), ("20300101", "20300102", 0)):
        plan = tumbling(spark, first, last, "yyyyMMdd", 6 * 3600)
        picked = zones.pick(table, found, plan, path)
        assert len(picked.inputFiles()) <= most
        got, whole = (Counter(map(tuple, assign_batches(df, plan, "t").collect())) for df in (picked, table))
        assert got == whole and picked.columns == table.columns


def test_zone_map_of_open_and_many_ranges(spark, files, monkeypatch):
    path, map_path = files
    found = zones.update(spark, map_path, path, "t")
    table = spark.read.parquet(path)
    spec = ",".join(f"{d % 3}:{START + timedelta(days=d):%Y%m%d}-{START + timedelta(days=d + 1):%Y%m%d}" for d in range(0, 90, 9))
    for options in (
        {"start": "20240320"}, {"end": "20240105"}, {"partitions": "1"}, {"partitions": spec, "interval_seconds": DAY},
    ):
        plan = build(spark, BatchRequest("j", "yyyyMMdd", **options))
        for most in (2000, 3):
            monkeypatch.setattr(zones, "MAX_RANGES", most)
            assert len(zones.ranges(plan)) <= most
            picked = zones.pick(table, found, plan, path)
            got, whole = (Counter(map(tuple, assign_batches(df, plan, "t", "p").collect())) for df in (picked, table))
            assert got == whole
        if "partitions" not in options:
            assert len(picked.inputFiles()) < 30


def test_zone_map_that_lags_behind(spark, files):
    path, map_path = files
    before = zones.update(spark, map_path, path, "t")
    known = before.count()
    late = spark.createDataFrame([(9, datetime(2024, 1, 5, 3), 1), (10, None, 2)], "id long, t timestamp_ntz, p long")
    late.coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    table = spark.read.parquet(path)
    plan = tumbling(spark, "20240105", "20240106", "yyyyMMdd", DAY)
    stale = before.where("n_rows > 0")
    assert assign_batches(zones.pick(table, stale, plan, path), plan, "t").count() == 25
    after = zones.update(spark, map_path, path, "t")
    assert after.count() == known + 2
    assert assign_batches(zones.pick(table, after, plan, path), plan, "t").count() == 25
    assert zones.update(spark, map_path, path, "t").count() == known + 2


def plain_present(changes):
    total, value = Counter(), {}
    for key, version, sign, text in changes:
        if sign is None or version is None:
            continue
        total[key, version] += sign
        if sign > 0:
            value[key, version] = text
    best = {}
    for (key, version), n in total.items():
        if n > 0 and (key not in best or best[key] < version):
            best[key] = version
    return {(key, version, value[key, version]) for key, version in best.items()}


@pytest.mark.parametrize("seed", range(4))
def test_collapse_in_any_batches(spark, seed):
    rng = random.Random(seed)
    changes = []
    for key in [*range(30), None]:
        for version in range(rng.randint(1, 4)):
            text = f"{key}-{version}"
            changes.append((key, version, 1, text))
            if rng.random() < 0.6:
                changes.append((key, version, -1, text))
    changes += [(1, None, 1, "x"), (1, 9, None, "x")]
    rng.shuffle(changes)
    schema = "key long, version int, sign int, text string"
    state = collapse.net(spark.createDataFrame(changes[:1], schema), ["key"])
    for part in (changes[1:20], changes[20:25], changes[25:]):
        state = collapse.fold(state, spark.createDataFrame(part, schema), ["key"])
    assert state.columns == ["key", "version", "sign", "text"]
    got = [(r["key"], r["version"], r["text"]) for r in collapse.present(state, ["key"]).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_present(changes)


def test_collapse_of_a_hot_key_and_of_nothing(spark):
    rows = spark.range(20_000).selectExpr("1 AS `k.1`", "id % 10 AS version", "IF(id < 19999, IF(id % 20 < 10, 1, -1), 1) AS sign", "id AS v")
    state = collapse.net(rows, ["k.1"])
    assert collapse.present(state, ["k.1"]).select("version").collect() == [(9,)]
    assert collapse.present(collapse.net(rows.where("false"), ["k.1"]), ["k.1"]).count() == 0
