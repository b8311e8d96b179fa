"""Plans: golden cases, and comparison with a plain loop over time."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from batchload import BatchRequest, build, partitions, tumbling
from batchload.functions.patterns import finest_unit
from batchload.plans import batch_plan

# Java-style pattern to strftime, with the unit it resolves to.
PATTERNS = {
    "yyyyMMddHHmmss": "%Y%m%d%H%M%S",
    "yyyyMMddHH": "%Y%m%d%H",
    "yyyyMMdd": "%Y%m%d",
    "yyyyMM": "%Y%m",
    "yyyy": "%Y",
    "yyyy-MM-dd HH,mm": "%Y-%m-%d %H,%M",
}


def listed(plan, spark):
    return plan.frame(spark).orderBy("batch_id").collect()


def texts(plan, spark):
    return [(r.start_text, r.end_text, r.partition) for r in listed(plan, spark)]


def loop(start, end, interval, strftime, partition=None):
    """Windows by stepping a cursor, the bounds as text."""
    cursor = datetime.strptime(start, strftime)
    stop = datetime.strptime(end, strftime)
    result = []
    while cursor < stop:
        following = cursor + timedelta(seconds=interval)
        result.append((cursor.strftime(strftime), following.strftime(strftime), partition))
        cursor = following
    return result


def test_fraction_right_behind_the_seconds(spark):
    plan = tumbling(spark, "20190101000000300", "20190101000002300", "yyyyMMddHHmmssSSS", 1)
    assert texts(plan, spark) == [
        ("20190101000000300", "20190101000001300", None),
        ("20190101000001300", "20190101000002300", None),
    ]
    with pytest.raises(ValueError):
        tumbling(spark, "20190101000000", "20190101000002", "yyyyMMddHHmmssSSS", 1)


def test_two_days(spark):
    plan = tumbling(spark, "20190101", "20190103", "yyyyMMdd", 86400)
    assert texts(plan, spark) == [
        ("20190101", "20190102", None),
        ("20190102", "20190103", None),
    ]
    assert [r.kind for r in listed(plan, spark)] == ["range", "range"]


def test_partition_ranges(spark):
    spec = "A_201901:20190101-20190201,A_201902:20190201-20190301"
    rows = listed(partitions(spark, spec, "yyyyMMdd", 86400), spark)
    assert [r.batch_id for r in rows] == list(range(59))
    assert [r.partition for r in rows] == ["A_201901"] * 31 + ["A_201902"] * 28
    assert rows[31].start_ts == datetime(2019, 2, 1)


def test_last_window_passes_the_end(spark):
    args = ("20190604083605", "20190604112235", "yyyyMMddHHmmss", 3600)
    rows = listed(tumbling(spark, *args), spark)
    assert len(rows) == 3 and rows[-1].end_text == "20190604113605"
    assert listed(tumbling(spark, *args, clamp_end=True), spark)[-1].end_text == "20190604112235"


def test_coarse_pattern_cuts_bounds(spark):
    plan = tumbling(spark, "20190101", "20190103", "yyyyMMdd", 129600)
    assert texts(plan, spark) == [
        ("20190101", "20190102", None),
        ("20190102", "20190104", None),
    ]


def test_open_and_named(spark):
    def kinds(**fields):
        rows = listed(build(spark, BatchRequest("job", "yyyyMMdd", **fields)), spark)
        return [(r.kind, r.start_text, r.end_text, r.partition) for r in rows]

    assert kinds(start="20190101") == [("start", "20190101", None, None)]
    assert kinds(end="20190101", start=" ") == [("end", None, "20190101", None)]
    assert kinds(partitions="P1,P2,") == [
        ("partition", None, None, "P1"),
        ("partition", None, None, "P2"),
    ]
    assert [k[0] for k in kinds(start="20190101", partitions="P1,P2")] == [
        "start",
        "partition",
        "partition",
    ]


def test_mixed_list(spark):
    plan = partitions(spark, "P1,A:20190101-20190103,B:20190103-20190103", "yyyyMMdd", 86400)
    assert texts(plan, spark) == [
        (None, None, "P1"),
        ("20190101", "20190102", "A"),
        ("20190102", "20190103", "A"),
    ]


def test_both_bounds_win_over_partitions(spark, caplog):
    request = BatchRequest(
        "job", "yyyyMMdd", "20190101", "20190103", 86400, partitions="P1,P2"
    )
    assert texts(build(spark, request), spark) == texts(
        tumbling(spark, "20190101", "20190103", "yyyyMMdd", 86400), spark
    )
    assert "ignored" in caplog.text


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    pattern=st.sampled_from(sorted(PATTERNS)),
    start=st.datetimes(datetime(1950, 1, 1), datetime(2030, 1, 1)),
    n=st.integers(1, 60),
    interval=st.sampled_from([1, 7, 600, 3600, 5000, 86400, 129600, 864000, 30000000]),
    extra=st.integers(0, 10**6),
)
def test_equals_loop(spark, pattern, start, n, interval, extra):
    strftime = PATTERNS[pattern]
    first = start.strftime(strftime)
    last = (start + timedelta(seconds=n * interval + extra % interval)).strftime(strftime)
    expected = loop(first, last, interval, strftime)
    if not expected:
        with pytest.raises(ValueError):
            tumbling(spark, first, last, pattern, interval)
        return
    plan = tumbling(spark, first, last, pattern, interval)
    if len(expected) > 5000:
        assert plan.n_batches == len(expected)
        return
    rows = listed(plan, spark)
    assert [(r.start_text, r.end_text, None) for r in rows] == expected
    assert [r.start_ts for r in rows[1:]] == [r.end_ts for r in rows[:-1]]
    assert rows[0].start_ts == datetime.strptime(first, strftime)
    assert plan.hull() == (rows[0].start_ts, rows[-1].end_ts)


@pytest.mark.parametrize("num_slices", [1, 2, 3, 7, 64, 65, 1000])
def test_split_keeps_every_batch_once(spark, num_slices):
    plan = partitions(spark, "A:20190101-20190201,P,B:20190201-20190301,C", "yyyyMMdd", 86400)
    pieces = plan.split(num_slices)
    assert len(pieces) == min(num_slices, plan.n_batches)
    sizes = [piece.n_batches for piece in pieces]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == plan.n_batches
    whole = listed(plan, spark)
    if num_slices < 10:
        assert [row for piece in pieces for row in listed(piece, spark)] == whole
    assert listed(plan.between(20, 40), spark) == whole[20:41]
    for fragment in plan.fragments(num_slices):
        (item,) = fragment.items
        first, last = whole[item.first_batch_id], whole[item.last_batch_id]
        assert fragment.lower(item) == first.start_ts and fragment.upper(item) == last.end_ts


def test_layers_hold_no_overlap(spark):
    request = BatchRequest(
        "job",
        "yyyyMMdd",
        start="20190101",
        partitions="A,B,A:20190101-20190103,A",
        interval_seconds=86400,
    )
    plan = build(spark, request)
    layers = plan.layers()
    assert [[i.partition for i in layer.items] for layer in layers] == [
        [None],
        ["A", "B"],
        ["A"],
        ["A"],
    ]
    assert sum(layer.n_batches for layer in layers) == plan.n_batches


def test_long_plan_is_listed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(batch_plan, "CHUNK", 10)
    plan = partitions(spark, "A:20190101-20190201,B:20190201-20190204", "yyyyMMdd", 86400)
    frame = plan.frame(spark)
    assert frame.rdd.getNumPartitions() > 1
    rows = frame.orderBy("batch_id").collect()
    assert [r.batch_id for r in rows] == list(range(34))
    assert rows[31].partition == "B" and rows[31].start_ts == datetime(2019, 2, 1)


def test_clock_change_of_the_session_zone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        args = ("201903092330", "201903100430", "yyyyMMddHHmm", 3600)
        assert texts(tumbling(spark, *args), spark) == loop(
            args[0], args[1], 3600, "%Y%m%d%H%M"
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "fields",
    [
        {"name": " ", "start": "20190101"},
        {"pattern": "", "start": "20190101"},
        {},
        {"start": "  ", "end": ""},
        {"start": "20190101", "end": "20190103"},
        {"start": "20190101", "end": "20190103", "interval_seconds": 0},
        {"start": "20190101", "end": "20190103", "interval_seconds": -5},
        {"start": "20190103", "end": "20190101", "interval_seconds": 60},
        {"start": "20190101", "end": "20190101", "interval_seconds": 60},
        {"start": "20190230"},
        {"start": "2019-01-01"},
        {"start": "20190101", "num_slices": 2, "parallelism": 3},
        {"start": "20190101", "num_slices": -1},
        {"start": "20190101", "batchsize": 0},
        {"start": "20190101", "n_columns": 0},
        {"partitions": "A,,B"},
        {"partitions": "A:"},
        {"partitions": ":20190101-20190102"},
        {"partitions": "A:20190101", "interval_seconds": 60},
        {"partitions": "A:20190101-20190102-20190103", "interval_seconds": 60},
        {"partitions": "A:20190101-20190102"},
    ],
)
def test_invalid_requests(spark, fields):
    with pytest.raises(ValueError):
        build(spark, BatchRequest(**{"name": "job", "pattern": "yyyyMMdd", **fields}))


def test_bounds_compare_as_times_not_as_text(spark):
    plan = tumbling(spark, "9-1-2019", "10-1-2019", "d-M-yyyy", 86400)
    assert texts(plan, spark) == [("9-1-2019", "10-1-2019", None)]


@pytest.mark.parametrize(
    "pattern, unit",
    [
        ("yyyyMMddHHmmssSSS", "exact"),
        ("yyyy-MM-dd'T'HH:mm:ss", "second"),
        ("yyyyMMdd hh:mm a", "minute"),
        ("yyyyMMddHH", "hour"),
        ("yyyyDDD", "day"),
        ("yyyyMM", "month"),
        ("yyyy", "year"),
    ],
)
def test_units(pattern, unit):
    assert finest_unit(pattern) == unit


@pytest.mark.parametrize(
    "pattern", ["MMdd", "HHmm", "yyyyHH", "yyyydd", "yyyyMMddmm", "yyyyMMddhh", "yyyyMMddHH z", ""]
)
def test_patterns_whose_texts_do_not_sort(pattern):
    with pytest.raises(ValueError):
        finest_unit(pattern)
