"""A stream gives what one batch over all its files gives."""

import pytest
from pyspark.sql import functions as F, types as T

from martkit.operators.clean import REQUIRED_FIELDS, required_fields, validate_items
from martkit.operators.merge import upsert
from martkit.operators.stats import validation_stats
from martkit.schemas import TableRules
from martkit.session import local_frame, scratch_path
from martkit.streaming.ingest import ChangeLog, read_stream, stream_ingest

RAW = T.StructType([T.StructField(n, T.StringType()) for n in ("url", "title", "price", "rating", "scraped_at")])
TYPED = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("price", T.DoubleType()), T.StructField("rating", T.LongType()),
    T.StructField("scraped_at", T.TimestampNTZType())])
FILES = [
    [{"url": "a", "title": "T", "price": "£1.50", "rating": "x", "scraped_at": "2026-02-10T10:00:00"},
     {"url": "b", "title": None, "price": "2", "rating": "3", "scraped_at": "2026-02-10T10:00:00Z"}],
    [{"url": "a", "title": None, "price": "free", "rating": "4", "scraped_at": "2026-02-11T10:00:00"}],
    [{"url": "c", "title": "C", "price": None, "rating": None, "scraped_at": "bad"},
     {"url": "b", "title": "B", "price": None, "rating": None, "scraped_at": "2026-02-12T10:00:00"}],
]


def run_ts():
    return F.lit("2026-03-01 00:00:00").cast("timestamp_ntz")


def validate(df):
    return validate_items(df, run_ts()).drop("_validation")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_and_survives_replay(spark):
    folder = scratch_path(spark, "in")
    for f in FILES:
        local_frame(spark, f, RAW).coalesce(1).write.mode("append").json(folder)
    log = ChangeLog(spark, scratch_path(spark, "log"), TYPED, "url", ["scraped_at"], by_arrival=False)
    base = local_frame(spark, [], TYPED)
    assert log.current(base).count() == 0
    checkpoint = scratch_path(spark, "ck")
    source = read_stream(spark, folder, RAW, "json", maxFilesPerTrigger="1")
    query = stream_ingest(source, log, validate, checkpoint)
    query.awaitTermination()
    assert query.lastProgress is not None and log.changes().select("batch_id").distinct().count() == 3

    whole = local_frame(spark, [r for f in FILES for r in f], RAW)
    want = rows(upsert(base, validate(whole), "url", ["scraped_at"]))
    assert rows(log.current(base)) == want
    assert [(r[0], r[1], r[2], r[3]) for r in want] == [("a", "T", 1.5, 4), ("b", "B", 2.0, 3), ("c", "C", None, None)]
    assert tuple(log.stats(base).first()) == (5, 3, 2, 100.0)

    # The same batch again, as after a lost commit, changes nothing.
    batch = log.changes().where("batch_id = 1").drop("batch_id").collect()
    log.write_batch(local_frame(spark, [r.asDict() for r in batch], TYPED), 1)
    assert rows(log.current(base)) == want
    # A restart from the checkpoint finds no new files.
    stream_ingest(source, log, validate, checkpoint).awaitTermination()
    assert rows(log.current(base)) == want

    # All batches but the last become the rows that still matter; later ones are merged as before.
    assert log.compact() == 1
    assert rows(log.current(base)) == want
    late = [{"url": "a", "title": "late", "price": "9", "rating": "1", "scraped_at": "2026-02-10T09:00:00"}]
    log.write_batch(validate(local_frame(spark, late, RAW)), 3)
    assert log.compact() == 2 and rows(log.current(base)) == want
    assert log.compact() == 2


def test_two_runs_share_a_log_only_by_one_checkpoint(spark):
    log = ChangeLog(spark, scratch_path(spark, "log"), TYPED, "url", ["scraped_at"])
    base, folder, checkpoint = local_frame(spark, [], TYPED), scratch_path(spark, "in"), scratch_path(spark, "ck")
    for f in FILES[:2]:
        local_frame(spark, f, RAW).coalesce(1).write.mode("append").json(folder)
        stream_ingest(read_stream(spark, folder, RAW, "json"), log, validate, checkpoint).awaitTermination()
    assert {r.url for r in log.current(base).collect()} == {"a", "b"}
    assert log.changes().count() == 3
    other = read_stream(spark, folder, RAW, "json")
    with pytest.raises(ValueError, match="another log"):
        stream_ingest(other, log, validate, scratch_path(spark, "ck"))
    assert log.changes().count() == 3


def test_rejects_and_counters(spark):
    rules = TableRules(T.StructType([
        T.StructField("url", T.StringType()), T.StructField("title", T.StringType(), False),
        T.StructField("rating", T.IntegerType())]))
    log = ChangeLog(spark, scratch_path(spark, "log"), TYPED, "url", ["scraped_at"])
    folder, checkpoint = scratch_path(spark, "in"), scratch_path(spark, "ck")
    wide = [{"url": "w", "title": "W", "price": "1", "rating": "99999999999999999999", "scraped_at": None}]
    for f in [*FILES, wide]:
        local_frame(spark, f, RAW).coalesce(1).write.mode("append").json(folder)
    source = read_stream(spark, folder, RAW, "json", maxFilesPerTrigger="1")
    stream_ingest(source, log, lambda df: validate_items(df, run_ts()), checkpoint, rules).awaitTermination()
    refused = {(r.url, r.reject_reason) for r in log.rejects(rules).collect()}
    assert refused == {("b", "title: is null"), ("a", "title: is null"), ("w", "rating: not a int")}
    assert tuple(log.counters().first())[:5] == (6, 3, 3, 5, 4)
    assert {r.url for r in log.changes().collect()} == {"a", "b", "c"}


def test_arrival_order(spark):
    log = ChangeLog(spark, scratch_path(spark, "log"), TYPED, "url", ["scraped_at"])
    base = local_frame(spark, [], TYPED)
    for i, f in enumerate([FILES[1], FILES[0]]):
        log.write_batch(validate(local_frame(spark, f, RAW)), i)
    got = {r.url: r.rating for r in log.current(base).collect()}
    assert got == {"a": 0, "b": 3}


def test_validation_statistics(spark):
    whole = local_frame(spark, [r for f in FILES for r in f], RAW)
    checked = validate_items(whole, run_ts())
    assert tuple(validation_stats(checked).first()) == (5, 2, 2, 5, 4, 20.0)
    assert tuple(validation_stats(checked.limit(0)).first()) == (0, 0, 0, 0, 0, 0.0)
    assert set(REQUIRED_FIELDS) >= {n for r in checked.select(required_fields(checked)).collect() for n in r[0]}


def test_levels_keep_a_read_short(spark):
    """After n batches a read opens some log n folders and gives what all batches give."""
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("a", T.LongType()),
                           T.StructField("b", T.StringType()), T.StructField("at", T.LongType())])
    base = local_frame(spark, [{"k": 0, "a": -1, "b": "old", "at": None}], schema)
    plain = ChangeLog(spark, scratch_path(spark, "log"), schema, "k", ["at"], by_arrival=False)
    levels = ChangeLog(spark, scratch_path(spark, "log"), schema, "k", ["at"], by_arrival=False)
    assert levels.fold_levels(3) == 0 and levels.compact() is None and levels.changes().count() == 0
    opened, written = [], 0
    for i in range(14):
        # Keys recur, fields are absent at times, and every fourth batch is older than those before it.
        at = i if i % 4 else i - 6
        batch = local_frame(spark, [{"k": i % 5, "a": i if i % 3 else None, "b": None if i % 2 else f"b{i}", "at": at},
                                    {"k": 100 + i, "a": i, "b": None, "at": at}], schema).coalesce(1)
        for log in (plain, levels):
            log.write_batch(batch, i)
        written += levels.fold_levels(3)
        opened.append(len({f.rsplit("/", 2)[-2] for f in levels.changes().inputFiles()}))
    assert written == 5 and [(r.first, r.upto, r.level) for r in levels._runs()] == [(0, 8, 2), (9, 11, 1)]
    assert max(opened) <= 3 * 2 + 1 and opened[-1] == 4
    want = rows(plain.current(base))
    assert rows(levels.current(base)) == want and len(want) == 19
    # The last batch, sent again in another form, replaces itself; then all that is older becomes one run.
    again = local_frame(spark, [{"k": 3, "a": 77, "b": "again", "at": 50}], schema)
    for log in (plain, levels):
        log.write_batch(again, 13)
    assert rows(levels.current(base)) == rows(plain.current(base))
    assert levels.compact() == 12 and len(levels._runs()) == 1
    assert rows(levels.current(base)) == rows(plain.current(base))
    with pytest.raises(ValueError):
        levels.fold_levels(1)
