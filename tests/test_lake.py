from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tablesync.operators import repair, upkeep
from tablesync.sources import lake
from tablesync.sources.lake import Lake


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "id bigint, name string")


def test_modes_and_time_travel(spark, folder):
    home = Lake(folder)
    with pytest.raises(lake.TableNotFound):
        lake.read(spark, home, "t")
    at = lambda d: datetime(2024, 1, d, tzinfo=timezone.utc)
    first = lake.write(frame(spark, 1, 2), home, "t", "create", watermark="id", committed_at=at(1))
    assert (first.rows, first.low, first.high) == (2, "1", "2")
    with pytest.raises(lake.TableExists):
        lake.write(frame(spark, 1), home, "t", "create")
    with pytest.raises(ValueError):
        lake.write(frame(spark, 1), home, "t", "merge")
    lake.write(frame(spark, 3).select("name", "id"), home, "t", "append", committed_at=at(2))
    assert rows(lake.read(spark, home, "t")) == [(1, "n1"), (2, "n2"), (3, "n3")]
    lake.write(frame(spark, 9), home, "t", "overwrite", committed_at=at(3))
    assert rows(lake.read(spark, home, "t")) == [(9, "n9")]
    assert rows(lake.read(spark, home, "t", as_of=at(2))) == [(1, "n1"), (2, "n2"), (3, "n3")]
    assert rows(lake.read(spark, home, "t", snapshot=1)) == [(1, "n1"), (2, "n2")]
    with pytest.raises(lake.TableNotFound):
        lake.read(spark, home, "t", as_of=datetime(2020, 1, 1, tzinfo=timezone.utc))


def test_append_refuses_unknown_and_fills_missing_columns(spark, folder):
    home = Lake(folder)
    lake.write(frame(spark, 1), home, "t", "append")
    with pytest.raises(ValueError):
        lake.write(frame(spark, 2).withColumn("more", F.lit(1)), home, "t", "append")
    lake.write(frame(spark, 2).select("id"), home, "t", "append")
    assert rows(lake.read(spark, home, "t").filter("id = 2")) == [(2, None)]


def test_failed_write_is_invisible(spark, folder):
    home = Lake(folder)
    lake.write(frame(spark, 1, 2), home, "t", "append")
    broken = frame(spark, 3, 4).withColumn("name", F.raise_error(F.lit("stop")))
    with pytest.raises(Exception):
        lake.write(broken, home, "t", "append")
    assert rows(lake.read(spark, home, "t")) == [(1, "n1"), (2, "n2")]
    lake.write(frame(spark, 3), home, "t", "append")
    assert lake.read(spark, home, "t").count() == 3


def test_empty_clone_has_no_rows(spark, folder):
    home = Lake(folder)
    assert lake.clone_empty(frame(spark, 1, 2), home, "t")
    assert not lake.clone_empty(frame(spark, 1), home, "t")
    assert lake.read(spark, home, "t").count() == 0
    assert lake.read(spark, home, "t").columns == ["id", "name"]
    lake.write(frame(spark, 5), home, "t", "append")
    assert lake.read(spark, home, "t").count() == 1


def test_evolution_reads_old_files(spark, folder):
    home = Lake(folder)
    lake.write(frame(spark, 1), home, "t", "append")
    lake.add_column(spark, home, "t", "size", "int")
    lake.rename_column(spark, home, "t", "name", "label")
    # A new column may take the old name without seeing old values.
    lake.add_column(spark, home, "t", "name", "string")
    new = spark.createDataFrame([(2, "x", 7, "y")], "id bigint, label string, size int, name string")
    lake.write(new, home, "t", "append")
    got = lake.read(spark, home, "t")
    assert got.columns == ["id", "label", "size", "name"]
    assert rows(got.filter("id = 1")) == [(1, "n1", None, None)]
    assert rows(got.filter("id = 2")) == [(2, "x", 7, "y")]
    assert rows(got.filter("label = 'n1'").select("id")) == [(1,)]


def test_upsert_is_idempotent_and_rewrites_touched_files_only(spark, folder):
    home = Lake(folder)
    lake.write(frame(spark, 1, 2, 3), home, "t", "append")
    lake.write(frame(spark, 10, 11), home, "t", "append")
    delta = spark.createDataFrame([(11, "old"), (11, "zz"), (12, "new")], "id bigint, name string")
    for _ in range(2):
        repair.upsert(spark, home, "t", delta, ["id"], ["name"])
        assert rows(lake.read(spark, home, "t")) == [
            (1, "n1"), (2, "n2"), (3, "n3"), (10, "n10"), (11, "zz"), (12, "new")
        ]
    kept = {s.id for s in lake.state(spark, home, "t", snapshot=1).segments}
    assert kept <= {s.id for s in lake.state(spark, home, "t").segments}
    assert lake.state(spark, home, "t").rows == 6


def test_upsert_after_evolution_and_partial_segments(spark, folder):
    home = Lake(folder)
    lake.write(frame(spark, *range(20)), home, "t", "append", partition_by=["bucket(5, id)"])
    lake.add_column(spark, home, "t", "size", "int")
    delta = spark.createDataFrame([(3, "three", 3), (100, "c", 1)], "id bigint, name string, size int")
    repair.upsert(spark, home, "t", delta, ["id"], ["size"])
    got = {r[0]: tuple(r[1:]) for r in lake.read(spark, home, "t").collect()}
    assert len(got) == 21 and got[3] == ("three", 3) and got[4] == ("n4", None)
    state = lake.state(spark, home, "t")
    removed = [p for s in state.segments for p in s.removed_folders]
    assert state.rows == 21 and len(removed) == 1
    live = {f.split(":")[-1] for f in lake.read(spark, home, "t").inputFiles()}
    assert lake.files(spark, home, "t").count() == len(live) - len(removed)


def test_trim_keeps_nulls(spark, folder):
    home = Lake(folder)
    df = spark.createDataFrame([(1, "a"), (5, "b"), (None, "c")], "id bigint, name string")
    lake.write(df, home, "t", "append", watermark="id")
    repair.trim(spark, home, "t", "id", "3")
    assert sorted(r["name"] for r in lake.read(spark, home, "t").collect()) == ["a", "c"]
    assert not repair.trim(spark, home, "t", "id", "3").committed


def test_partition_layout_prunes_derived_column(spark, folder, data):
    home = Lake(folder)
    events = spark.read.parquet(f"{data}/events.parquet")
    lake.write(events, home, "e", "append", partition_by=["days(ts)", "bucket(4, user_id)"])
    part = lake.read(spark, home, "e", between=("ts", "2024-01-10 00:00:00", "2024-01-11 12:00:00"))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_p_ts_day" in plan
    assert part.count() == events.filter("ts between '2024-01-10' and '2024-01-11 12:00:00'").count()
    assert part.columns == events.columns
    per = upkeep.partition_rows(spark, home, "e")
    assert per.agg(F.sum("rows")).first()[0] == events.count()


def test_upkeep(spark, folder):
    home = Lake(folder)
    at = lambda d: datetime(2024, 1, d, tzinfo=timezone.utc)
    for day, ids in ((1, (1, 2)), (2, (3, 4)), (3, (5, 6))):
        lake.write(frame(spark, *ids).repartition(2), home, "t", "append", committed_at=at(day))
    assert upkeep.table_health(lake.files(spark, home, "t")).first()["files"] == 6
    upkeep.compact(spark, home, "t", sort_by=["id"], committed_at=at(4))
    assert lake.files(spark, home, "t").count() == 1
    assert lake.read(spark, home, "t").count() == 6
    assert upkeep.unreferenced_files(spark, home, "t").count() == 0
    assert upkeep.expire_snapshots(spark, home, "t", at(4)) == [1, 2, 3]
    assert upkeep.remove_unreferenced(spark, home, "t") == 6
    assert rows(lake.read(spark, home, "t"))[0] == (1, "n1") and lake.read(spark, home, "t").count() == 6
    stats = {r["column"]: r for r in upkeep.record_statistics(spark, home, "t").collect()}
    assert stats["id"]["low"] == "1" and stats["name"]["nulls"] == 0
    assert "statistics" in lake.state(spark, home, "t").properties


def test_removed_files_go_when_no_snapshot_shows_them(spark, folder):
    home = Lake(folder)
    lake.write(
        frame(spark, *range(20)), home, "t", "append", partition_by=["bucket(5, id)"], committed_at=datetime(2024, 1, 1, tzinfo=timezone.utc))
    repair.upsert(spark, home, "t", spark.createDataFrame([(3, "x")], "id bigint, name string"), ["id"], ["name"])
    assert upkeep.unreferenced_files(spark, home, "t").count() == 0
    upkeep.expire_snapshots(spark, home, "t", datetime(2025, 1, 1, tzinfo=timezone.utc))
    assert upkeep.remove_unreferenced(spark, home, "t") == 1
    assert lake.read(spark, home, "t").count() == 20


def test_describe_and_identifiers(spark, folder):
    home = Lake(folder)
    lake.write(frame(spark, 1), home, "t", "append", identifier_columns=["id"])
    assert lake.set_identifiers(spark, home, "t", ["name", "ID"]) == "2,1"
    found = {r["table_name"]: r for r in lake.describe(spark, home, ["t", "missing"]).collect()}
    assert found["t"]["table_exists"] and not found["missing"]["table_exists"]
    assert found["t"]["columns"] == ["id", "name"] and found["t"]["rows"] == 1
    assert found["t"]["identifier_columns"] == ["name", "id"]
    assert found["t"]["properties"]["identifier-field-ids"] == "2,1"


def test_verify_counts_staged_rows(spark, folder):
    done = repair.staged_write(frame(spark, 1, 2, 3), Lake(folder), "t")
    assert done.rows == 3 and done.committed


def test_increment_skips_segments_by_statistics(spark, folder):
    home = Lake(folder)
    lake.write(frame(spark, 1, 2), home, "t", "append", watermark="id")
    lake.write(frame(spark, 3, 4), home, "t", "append", watermark="id")
    part = lake.read_increment(spark, home, "t", "id", "2", ordered=True)
    assert [r["id"] for r in part.collect()] == [3, 4]
    assert len({f.split("/seg=")[1].split("/")[0] for f in part.inputFiles()}) == 1
    assert lake.read_increment(spark, home, "t", "id", None).count() == 4


def test_partition_values_with_special_characters(spark, folder):
    home = Lake(folder)
    df = spark.createDataFrame([(1, "a b:c/100%+x"), (2, "plain"), (3, None)], "id bigint, name string")
    lake.write(df, home, "t", "append", partition_by=["name"])
    repair.upsert(spark, home, "t", spark.createDataFrame([(1, "a b:c/100%+x"), (4, "é")], "id bigint, name string"), ["id"], ["id"])
    repair.trim(spark, home, "t", "id", "3")
    assert rows(lake.read(spark, home, "t").filter("id <= 2")) == [(1, "a b:c/100%+x"), (2, "plain")]
    assert lake.read(spark, home, "t").count() == 3
    assert lake.files(spark, home, "t").count() == 3
    upkeep.expire_snapshots(spark, home, "t", datetime(2100, 1, 1, tzinfo=timezone.utc))
    upkeep.remove_unreferenced(spark, home, "t")
    assert lake.all_files(spark, home, "t").count() == 3 and lake.read(spark, home, "t").count() == 3


def test_small_files_join_and_large_ones_stay(spark, folder):
    home = Lake(folder)
    big = spark.range(200_000).select("id", F.expr("uuid()").alias("name")).coalesce(1)
    lake.write(big, home, "t", "append")
    kept = {r["path"] for r in lake.files(spark, home, "t").collect()}
    for i in range(3):
        lake.write(frame(spark, -i - 1), home, "t", "append")
    upkeep.compact_small_files(spark, home, "t", target_bytes=1 << 20)
    now = {r["path"] for r in lake.files(spark, home, "t").collect()}
    assert kept <= now and len(now) == 2
    assert lake.read(spark, home, "t").count() == 200_003
    assert not upkeep.compact_small_files(spark, home, "t", target_bytes=1 << 20).committed


def test_small_files_beside_a_large_one_join_without_it(spark, folder):
    """Judged file by file: in one write a file of the target size and small ones, by folders with and without a layout."""
    for spec in ([], ["kind"]):
        home = Lake(f"{folder}/{len(spec)}")
        large = spark.range(100_000).select("id", F.expr("uuid()").alias("name"), F.lit("a b").alias("kind")).coalesce(1)
        small = spark.range(-40, 0).select("id", F.lit("s").alias("name"), F.lit("a b").alias("kind")).coalesce(1)
        lake.write(large if spec else large.unionByName(small).repartitionById(2, F.expr("int(id < 0)")), home, "t", "append", partition_by=spec)
        for i in range(2):
            lake.write(small.withColumn("id", F.col("id") - 40 * (i + 1)), home, "t", "append")
        listed = {r["path"]: r["bytes"] for r in lake.files(spark, home, "t").collect()}
        top, total = max(listed, key=listed.get), lake.read(spark, home, "t").agg(F.count("*"), F.sum("id")).first()
        assert len(listed) == (3 if spec else 4)
        done = upkeep.compact_small_files(spark, home, "t", target_bytes=listed[top])
        assert done.committed and done.rows == (80 if spec else 120)
        now = {r["path"] for r in lake.files(spark, home, "t").collect()}
        assert top in now and len(now) == 2
        assert lake.read(spark, home, "t").agg(F.count("*"), F.sum("id")).first() == total
        assert lake.read(spark, home, "t", snapshot=3).agg(F.count("*"), F.sum("id")).first() == total
        assert lake.state(spark, home, "t").rows == total[0]
        assert not upkeep.compact_small_files(spark, home, "t", target_bytes=listed[top]).committed
        # Only what no snapshot shows goes, the small files beside the large one among it.
        assert upkeep.remove_unreferenced(spark, home, "t") == 0
        upkeep.expire_snapshots(spark, home, "t", datetime(2999, 1, 1))
        assert upkeep.remove_unreferenced(spark, home, "t") == (2 if spec else 3)
        assert {r["path"] for r in lake.all_files(spark, home, "t").collect()} == now
        # What replaces the folder later does not bring the joined rows back.
        repair.upsert(spark, home, "t", spark.createDataFrame([(5, "five", "a b")], "id bigint, name string, kind string"), ["id"], ["name"])
        assert lake.read(spark, home, "t").agg(F.count("*"), F.sum("id")).first() == total
        assert lake.state(spark, home, "t").rows == total[0]


def test_limited_files_are_full_however_many_tasks_write_a_folder(spark, folder):
    """At most one file of a folder has fewer rows than the limit, and no folder waits for a single task."""
    home, name = Lake(folder), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kind = F.expr("CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 = 1 THEN 'a' ELSE 'b' END")
    df = spark.range(10_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("name"), kind.alias("kind"))
    df = df.unionByName(spark.range(95).select(F.lit(-1).alias("id"), F.lit("same").alias("name"), F.lit("c").alias("kind")))
    known = spark.conf.get(name, None)
    spark.conf.set(name, "20000")  # small enough to deal the rows of a folder over several tasks
    try:
        lake.write(df, home, "t", "append", partition_by=["kind"], max_records_per_file=30)
    finally:
        spark.conf.set(name, known) if known else spark.conf.unset(name)
    read = lake.read(spark, home, "t")
    assert read.count() == 10_095 == lake.state(spark, home, "t").rows and read.exceptAll(df).count() == 0
    per = read.withColumn("file", F.input_file_name()).groupBy("kind", "file").agg(F.count(F.lit(1)).alias("n"))
    found = {r["kind"]: (r["files"], r["top"]) for r in per.groupBy("kind").agg(F.count(F.lit(1)).alias("files"), F.max("n").alias("top")).collect()}
    assert found == {None: (34, 30), "a": (34, 30), "b": (267, 30), "c": (4, 30)}
    writers = lake.files(spark, home, "t").filter("partition = '_p_kind=b'").select(F.regexp_extract("path", r"/part-(\d+)-", 1))
    assert writers.distinct().count() > 1


def test_a_file_is_sorted_in_ranges_of_bounded_rows(spark, folder, monkeypatch):
    """Rows that compress well: a file takes many, but no task sorts them all; its runs do not overlap."""
    home = Lake(folder)
    monkeypatch.setattr(upkeep, "SORT_ROWS", 1_000)
    df = spark.range(10_000).select(F.pmod(F.xxhash64("id"), F.lit(5_000)).alias("id"), F.lit("x").alias("name"))
    lake.write(df, home, "t", "append")
    wide = upkeep.sorted_layout(lake.read(spark, home, "t"), ["id"], 2, 10_000)
    assert ", 10)" in next(x for x in wide._jdf.queryExecution().executedPlan().toString().splitlines() if "rangepartitioning" in x)
    upkeep.compact(spark, home, "t", sort_by=["id"])
    assert lake.files(spark, home, "t").count() == 1
    got = [r["id"] for r in lake.read(spark, home, "t").coalesce(1).collect()]
    assert sorted(got) == sorted(r["id"] for r in df.collect())
    starts = [0, *[i for i in range(1, len(got)) if got[i] < got[i - 1]], len(got)]
    runs = sorted((got[a], got[b - 1]) for a, b in zip(starts, starts[1:]))
    assert len(runs) <= 10 and all(low[1] <= high[0] for low, high in zip(runs, runs[1:]))


def test_removed_files_are_not_opened(spark, folder):
    home = Lake(folder)
    lake.write(frame(spark, *range(20)), home, "t", "append", partition_by=["bucket(5, id)"])
    repair.upsert(spark, home, "t", spark.createDataFrame([(3, "x")], "id bigint, name string"), ["id"], ["name"])
    df = lake.read(spark, home, "t")
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    live = lake.files(spark, home, "t").count()
    assert leaf.metrics().get("numFiles").get().value() == live < lake.all_files(spark, home, "t").count()


def test_unfinished_commit_blocks_until_removed(spark, folder):
    import os

    home = Lake(folder)
    lake.write(frame(spark, 1), home, "t", "append")
    os.makedirs(f"{folder}/t/manifest/snapshot=2/_temporary")
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        lake.write(frame(spark, 2), home, "t", "append")
    assert upkeep.remove_unfinished_commits(spark, home, "t") == ["snapshot=2"]
    lake.write(frame(spark, 2), home, "t", "append")
    assert lake.read(spark, home, "t").count() == 2


def test_hour_layout_in_another_time_zone(spark, folder):
    home = Lake(folder)
    df = spark.sql("select id, timestamp'2024-03-10 00:30:00Z' + make_dt_interval(0, cast(id as int)) as at from range(24)")
    lake.write(df, home, "t", "append", partition_by=["hours(at)", "days(at)"], watermark="at")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        part = lake.read(spark, home, "t", between=("at", "2024-03-10T02:00:00+00:00", "2024-03-10T05:00:00+00:00"))
        assert sorted(r["id"] for r in part.collect()) == [2, 3, 4]
        assert lake.read_increment(spark, home, "t", "at", "2024-03-11 09:00:00").count() == 0
        assert lake.read_increment(spark, home, "t", "at", "2024-03-11 08:00:00").count() == 1
        assert lake.read_increment(spark, home, "t", "at", "2024-03-10T23:30:00+00:00").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_many_small_parts_join_in_several_tasks(spark, folder):
    """Far more small files than any constant: untouched parts stay, and several tasks write the rest."""
    home = Lake(folder)
    big = spark.range(400_000).select("id", F.expr("uuid()").alias("name")).repartition(3)
    lake.write(big, home, "t", "append")
    kept = {r["path"] for r in lake.files(spark, home, "t").collect()}
    small = spark.range(1_000_000, 1_060_000).select("id", F.expr("uuid()").alias("name"))
    lake.write(small.repartition(150), home, "t", "append")
    assert lake.files(spark, home, "t").count() == 153
    upkeep.compact_small_files(spark, home, "t", target_bytes=1 << 19)
    now = {r["path"] for r in lake.files(spark, home, "t").collect()}
    assert kept <= now and 3 <= len(now - kept) <= 8
    state = lake.state(spark, home, "t")
    assert len(state.segments) == 2 and not any(s.removed_folders for s in state.segments)
    assert lake.read(spark, home, "t").agg(F.count("*"), F.sum("id")).first()[:] == (460_000, sum(range(400_000)) + sum(range(1_000_000, 1_060_000)))


def test_buckets_are_rewritten_one_by_one(spark, folder):
    home = Lake(folder)
    lake.write(frame(spark, *range(40)), home, "t", "append", partition_by=["bucket(8, id)"])
    before = lake.files(spark, home, "t")
    inside = {r["partition"]: r["n"] for r in before.groupBy("partition").agg(F.count("*").alias("n")).collect()}
    paths = {r["path"] for r in before.collect()}
    for i in (0, 0, 7):
        repair.upsert(spark, home, "t", frame(spark, i), ["id"], ["name"])
    state = lake.state(spark, home, "t")
    assert lake.read(spark, home, "t").count() == 40 == state.rows
    first = next(s for s in state.segments if any(f"/seg={s.id}/" in p for p in paths))
    assert 1 <= len(first.removed_folders) <= 2
    still = paths & {r["path"] for r in lake.files(spark, home, "t").collect()}
    assert len(still) == sum(n for p, n in inside.items() if p not in first.removed_folders)
    # What no snapshot shows any more goes by folders.
    for number in upkeep.expire_snapshots(spark, home, "t", datetime(2999, 1, 1)):
        assert number < state.snapshot
    assert upkeep.remove_unreferenced(spark, home, "t") > 0
    assert {r["path"] for r in lake.all_files(spark, home, "t").collect()} == {r["path"] for r in lake.files(spark, home, "t").collect()}
    assert lake.read(spark, home, "t").count() == 40


def test_folders_with_special_names_and_nulls(spark, folder):
    home = Lake(folder)
    df = spark.createDataFrame([(1, "a b"), (2, "x/y=z%"), (3, None), (4, "ä:1")], "id bigint, name string")
    lake.write(df, home, "t", "append", partition_by=["name"], watermark="id")
    repair.upsert(spark, home, "t", spark.createDataFrame([(2, "x/y=z%"), (3, "n")], df.schema), ["id"], ["name"])
    assert rows(lake.read(spark, home, "t")) == [(1, "a b"), (2, "x/y=z%"), (3, "n"), (4, "ä:1")]
    repair.trim(spark, home, "t", "id", "3")
    assert rows(lake.read(spark, home, "t")) == [(1, "a b"), (2, "x/y=z%"), (3, "n")]
    upkeep.expire_snapshots(spark, home, "t", datetime(2999, 1, 1))
    upkeep.remove_unreferenced(spark, home, "t")
    assert rows(lake.read(spark, home, "t")) == [(1, "a b"), (2, "x/y=z%"), (3, "n")]
    assert lake.all_files(spark, home, "t").count() == lake.files(spark, home, "t").count()


def test_upserts_read_only_the_buckets_of_the_delta(spark, folder):
    home = Lake(folder)
    lake.write(frame(spark, *range(200)), home, "t", "append", partition_by=["bucket(16, id)"])
    current = lake.state(spark, home, "t")
    found = lake.buckets_of(frame(spark, 3), current, ["id"])
    assert [len(v) for v in found.values()] == [1]
    plan = lake.scan_with_files(spark, home, current, ["id"], (), found)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "array_contains" in plan


def test_increments_trims_and_upserts_prune_folders(spark, folder, data):
    home, events = Lake(folder), spark.read.parquet(f"{data}/events.parquet")
    lake.write(events, home, "t", "append", partition_by=["days(ts)"])
    rows = sorted(r["ts"] for r in events.select("ts").collect())
    middle = rows[len(rows) // 2]
    part = lake.read_increment(spark, home, "t", "ts", str(middle))
    assert part.count() == sum(t > middle for t in rows)
    current = lake.state(spark, home, "t")
    for df in (part, lake.scan_with_files(spark, home, current, ["ts"], [("ts", str(middle))]), lake.scan_with_files(spark, home, current, ["ts"], [("ts", str(middle), str(rows[-1]), True)])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    repair.trim(spark, home, "t", "ts", str(middle))
    assert lake.read(spark, home, "t").count() == sum(t <= middle for t in rows)
    repair.upsert(spark, home, "t", events.filter(F.col("ts") == F.lit(middle)), ["ts"], ["event_id"])
    assert lake.read(spark, home, "t").filter(F.col("ts") == F.lit(middle)).count() == 1


def test_increment_with_nothing_new_on_a_partitioned_table(spark, folder, data):
    home, events = Lake(folder), spark.read.parquet(f"{data}/events.parquet")
    lake.create_if_missing(spark, home, "t", events.schema, partition_by=["days(ts)"])
    assert lake.read_increment(spark, home, "t", "ts", "2024-01-01").count() == 0
    assert lake.read(spark, home, "t", between=("ts", "2024-01-01", "2024-02-01")).count() == 0
    lake.write(events, home, "t", "append", watermark="ts")
    top = str(events.agg(F.max("ts")).first()[0])
    found = lake.read_increment(spark, home, "t", "ts", top)
    assert found.count() == 0 and found.schema.names == events.schema.names


def test_runs_read_lake_increments_by_folders(spark, folder, data):
    from tablesync.operators.bookmarks import BookmarkStore
    from tablesync.plans.loads import Job, TableSpec, lake_delta

    home, events = Lake(folder), spark.read.parquet(f"{data}/events.parquet")
    lake.write(events, home, "t", "append", partition_by=["days(ts)"])
    rows = sorted(r["ts"] for r in events.select("ts").collect())
    middle = rows[len(rows) // 2]
    delta = lake_delta(spark, Job("j", home, Lake(f"{folder}/x"), BookmarkStore(f"{folder}/b")), TableSpec("t", "timestamp", "ts"), str(middle))
    assert delta.count() == sum(t > middle for t in rows)
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
