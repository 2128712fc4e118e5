"""Days as a stream, against a count in order of arrival."""

import random
from collections import Counter
from datetime import date, datetime, timedelta, timezone

import pytest
from sieveworks.streaming import days

KIND = "ts timestamp, pos long, day string, end long"
START = datetime(2024, 3, 1, tzinfo=timezone.utc)


def arrivals(seed, batches=5, rows=60):
    r, pos, out = random.Random(seed), 0, []
    for b in range(batches):
        batch = []
        for _ in range(rows):
            at = START + timedelta(days=3 * b, hours=r.randrange(0, 72), microseconds=r.randrange(10**6)) - timedelta(days=r.choice([0, 0, 0, 0, 1, 5, 9]))
            batch.append((None if r.random() < 0.03 else at, pos, "clash", pos))
            pos += 1
        out.append(batch)
    return out


def counted(batches, delay=timedelta(days=2)):
    """Closed days, late positions and open days, by the rule alone."""
    ends = lambda at: datetime(at.year, at.month, at.day, tzinfo=timezone.utc) + timedelta(days=1)
    latest, late, kept = None, [], Counter()
    for batch in batches:
        mark = latest and latest - delay
        for at, pos, *_ in batch:
            if at is None or mark and ends(at) <= mark:
                late.append(pos)
            else:
                kept[ends(at)] += 1
        latest = max([x[0] for x in batch if x[0]] + ([latest] if latest else []), default=None)
    mark = latest and latest - delay
    closed = {(e - timedelta(days=1)).date(): n for e, n in kept.items() if e <= mark}
    return closed, sorted(late), sum(kept.values()) - sum(closed.values())


def run(spark, tmp_path, batches, **options):
    landed, out, state = (f"file://{tmp_path}/{n}" for n in ("landed", "out", "state"))
    for batch in batches:
        spark.createDataFrame(batch, KIND).repartition(2).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(spark.createDataFrame([], KIND).schema).parquet(landed)
        days.count_days(stream, out, state, **options).awaitTermination()
    return out, stream.schema


def outcome(spark, out, schema):
    got = {r.day: r.records for r in days.closed_days(spark, out).collect()}
    return got, days.late_records(spark, out, schema).collect()


def test_closed_days_and_late_records_are_exact_over_restarts(spark, tmp_path):
    batches = arrivals(4)
    out, schema = run(spark, tmp_path, batches)
    closed, late, left = counted(batches)
    got, aside = outcome(spark, out, schema)
    assert got == closed and sorted(r.pos for r in aside) == late and late and closed and left
    by_pos = {row[1]: row for b in batches for row in b}
    assert {r.pos: (r.ts and r.ts.replace(tzinfo=timezone.utc), r.pos, r.day, r.end) for r in aside} == {p: by_pos[p] for p in late}
    assert sum(got.values()) + len(aside) + left == sum(map(len, batches))


def test_a_run_without_new_files_changes_nothing(spark, tmp_path):
    batches = arrivals(5, batches=2)
    out, schema = run(spark, tmp_path, batches)
    before = outcome(spark, out, schema)
    stream = spark.readStream.schema(schema).parquet(f"file://{tmp_path}/landed")
    days.count_days(stream, out, f"file://{tmp_path}/state").awaitTermination()
    after = outcome(spark, out, schema)
    assert after[0] == before[0] and sorted(after[1], key=str) == sorted(before[1], key=str)


@pytest.mark.parametrize("salts", [1, 8])
def test_a_day_that_ends_at_the_watermark_is_closed_and_one_record_later_is_late(spark, tmp_path, salts):
    at = lambda d, h=0: START + timedelta(days=d, hours=h)
    odd = [(datetime(y, 5, 1, tzinfo=timezone.utc), y, "x", 0) for y in (1950, 2150)]
    batches = [[(at(0, 5), 1, "x", 0), (at(0, 5), 1, "x", 0), (at(1, 1), 2, "x", 0), (at(3), 3, "x", 0), *odd], [(at(0, 6), 4, "x", 0), (at(1, 2), 5, "x", 0), (None, 6, "x", 0)]]
    out, schema = run(spark, tmp_path, batches, salts=salts)
    got, late = outcome(spark, out, schema)
    assert got == {date(2024, 3, 1): 2} and sorted(r.pos for r in late) == [4, 6, 1950, 2150]


def test_report_window(spark):
    table = spark.createDataFrame([(date(2024, 3, d), d) for d in (1, 2, 4, 8, 9)], "day date, records long")
    one = lambda a, b, t=table: tuple(days.report_window(t, a, b).first())
    assert one("2024-03-01", "2024-03-08") == (14, 3, 7) and one("2024-04-01", "2024-04-08") == (0, 0, 7) and one("2024-03-01", "2024-03-08", table.limit(0)) == (0, 0, 7)
