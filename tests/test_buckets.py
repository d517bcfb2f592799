"""A table in buckets: results as of a plain upsert, other buckets untouched."""

import glob
import os

import pytest
from pyspark.sql import types as T

from martkit.operators.merge import upsert
from martkit.session import local_frame, scratch_path
from martkit.sources.buckets import BucketedTable, buckets_for

ITEM = T.StructType([T.StructField("k", T.LongType()), T.StructField("a", T.StringType()), T.StructField("n", T.LongType())])
UPDATE = T.StructType([*ITEM.fields, T.StructField("at", T.LongType())])


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(root):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/data/*/*/*.parquet")}


def make(spark, held, buckets=8):
    table = BucketedTable(spark, scratch_path(spark, "buckets"), ITEM, "k")
    table.replace(local_frame(spark, held, ITEM), buckets)
    return table


def test_upsert_rewrites_only_touched_buckets(spark):
    held = [{"k": i, "a": f"a{i}", "n": i} for i in range(200)] + [{"k": None, "a": "no key", "n": 1}]
    table = make(spark, held)
    assert rows(table.read()) == rows(local_frame(spark, held, ITEM))
    before, places = files(table.root), table.places()
    sent = [{"k": 7, "a": "first", "n": None, "at": 1}, {"k": 7, "a": None, "n": 70, "at": 2}, {"k": 7, "a": "late", "n": 1, "at": 0},
            {"k": None, "a": "lost", "n": 0, "at": 9}, {"k": 1000, "a": None, "n": 5, "at": 1}]
    updates = local_frame(spark, sent, UPDATE)
    want = rows(upsert(table.read(), updates, "k", ["at"], {"a": "new"}))
    touched = table.upsert(updates, ["at"], {"a": "new"})
    assert rows(table.read()) == want and (7, "first", 70) in want and (1000, "new", 5) in want
    after, now = files(table.root), table.places()
    # Old files are all as they were, and what was added is one file for each touched bucket.
    assert before.items() <= after.items() and len(after) - len(before) == touched <= 2
    assert sum(places.get(b) != now[b] for b in now) == touched
    assert rows(table.lookup([7, 1000, 5000])) == [(1000, "new", 5), (7, "first", 70)]
    opened = table.lookup([7]).inputFiles()
    assert len(opened) == 1


def test_no_updates_and_an_empty_table(spark):
    table = make(spark, [], 4)
    assert table.read().count() == 0 and table.lookup([1]).count() == 0
    assert table.upsert(local_frame(spark, [], UPDATE), ["at"]) == 0
    assert table.upsert(local_frame(spark, [{"k": None, "a": "x", "n": 1, "at": 1}], UPDATE), ["at"]) == 0
    sent = [{"k": 1, "a": str(i), "n": None, "at": i} for i in range(50)]
    assert table.upsert(local_frame(spark, sent, UPDATE), ["at"]) == 1
    assert rows(table.read()) == [(1, "49", None)]
    # A run that clears starts from nothing; the older files stay on storage.
    table.replace(local_frame(spark, [{"k": 2, "a": "z", "n": 3}], ITEM), 2)
    assert rows(table.read()) == [(2, "z", 3)]


def test_half_a_write_changes_nothing(spark):
    table = make(spark, [{"k": 1, "a": "x", "n": 1}])
    table._write(local_frame(spark, [{"k": 1, "a": "torn", "n": 2}], ITEM), 8, 1)
    assert rows(table.read()) == [(1, "x", 1)]


def test_errors(spark):
    table = make(spark, [])
    with pytest.raises(ValueError, match="no columns"):
        table.upsert(local_frame(spark, [], T.StructType([*UPDATE.fields, T.StructField("z", T.LongType())])), ["at"])
    with pytest.raises(LookupError):
        BucketedTable(spark, scratch_path(spark, "none"), ITEM, "k").read()
    with pytest.raises(ValueError):
        table.replace(local_frame(spark, [], ITEM), 0)
    assert buckets_for(0) == 1 and buckets_for((256 << 20) + 1) == 2
