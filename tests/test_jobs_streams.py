"""File naming, listing, idempotent jobs and streaming equivalence."""

import os
import tempfile

from pyspark.sql import functions as F

from chainlens.sources import standins as S
from chainlens.sources.files import (batch_of_filename, batch_range_of_filename, list_files,
                                     read_dataset, sync_batches)

D = "/root/testdata/sf0.001"


def test_batch_from_file_name(spark):
    names = ["ethereum__transactions__00000000_to_00000999.parquet", "misc.parquet",
             "x__00001000_to_00001999.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "file_name string")
    got = [(r[0], r[1]) for r in df.select(batch_of_filename(F.col("file_name")),
                                          batch_range_of_filename(F.col("file_name"))).collect()]
    assert got == [(999, "00000000_to_00000999"), (None, None), (1999, "00001000_to_00001999")]


def test_sync_drops_unbatched_and_keeps_same_batch_files(spark):
    a = spark.createDataFrame([("t__0_to_9.parquet",), ("t2__0_to_9.parquet",), ("junk.parquet",),
                               ("t__10_to_19.parquet",)], "file_name string")
    b = spark.createDataFrame([("b__0_to_9.parquet",), ("other.parquet",)], "file_name string")
    rows = sync_batches(a, b).collect()
    assert len(rows) == 1 and rows[0]["batch_end"] == 9
    assert rows[0]["files_a"] == ["t2__0_to_9.parquet", "t__0_to_9.parquet"]


def test_list_missing_folder_is_empty(spark):
    assert list_files(spark, "/nonexistent/chainlens/folder").count() == 0


def test_read_dataset_batch_from_file_names(spark):
    d = tempfile.mkdtemp(prefix="chainlens-test-")
    b = S.blocks(spark, D).drop("block_batch")
    b.filter("block_number < 700").coalesce(1).write.parquet(f"{d}/p1")
    b.filter("block_number >= 700").coalesce(1).write.parquet(f"{d}/p2")
    for sub, name in (("p1", "blocks__00000000_to_00000699.parquet"),
                      ("p2", "blocks__00000700_to_00001499.parquet")):
        f = [x for x in os.listdir(f"{d}/{sub}") if x.endswith(".parquet")][0]
        os.rename(f"{d}/{sub}/{f}", f"{d}/{name}")
    got = read_dataset(spark, d).groupBy("block_batch").count().collect()
    assert sorted((r[0], r[1]) for r in got) == [(699, 700), (1499, 800)]


def test_incremental_job_runs_twice_without_new_output(spark):
    from chainlens.plans.jobs import scratch_path, write_rollups_incremental

    out = scratch_path(spark, "test-rollups")
    t, b, l = S.transactions(spark, D), S.blocks(spark, D), S.sequencer_labels(spark, D)
    first = write_rollups_incremental(spark, t, b, l, out).count()
    files1 = sorted(r["path"] for r in list_files(spark, out).collect())
    second = write_rollups_incremental(spark, t, b, l, out).count()
    files2 = sorted(r["path"] for r in list_files(spark, out).collect())
    assert first > 0 and second == 0 and files1 == files2


def test_stream_equals_batch(spark):
    from chainlens.plans.catalog import q_rollups_stream, rollups

    cols = sorted(rollups(spark, D).columns)
    a = sorted(map(tuple, q_rollups_stream(spark, D).select(*cols).collect()), key=repr)
    b = sorted(map(tuple, rollups(spark, D).select(*cols).collect()), key=repr)
    assert a == b


def test_compaction_preserves_rows(spark):
    from chainlens.plans.catalog import q_combine_files

    assert q_combine_files(spark, D).count() == S.univ2_swaps(spark, D).count()


def test_stream_picks_up_new_batch_only(spark):
    """A second availableNow run on the same checkpoint processes only the
    batch that arrived since, and the table then equals the batch job."""
    from chainlens.plans.catalog import rollups
    from chainlens.plans.jobs import scratch_path, write_batches
    from chainlens.streaming.incremental import start_rollups_stream

    d = "/root/testdata/sf0.01"
    t, b, l = S.transactions(spark, d), S.blocks(spark, d), S.sequencer_labels(spark, d)
    tx, bl = scratch_path(spark, "t-txs"), scratch_path(spark, "t-blocks")
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    write_batches(b, bl)
    write_batches(t.filter("block_batch < 2"), tx)
    start_rollups_stream(spark, tx, bl, l, out, ck).awaitTermination()
    first = spark.read.parquet(out).select("block_batch").distinct().count()
    write_batches(t.filter("block_batch = 2"), tx)          # a new batch lands
    start_rollups_stream(spark, tx, bl, l, out, ck).awaitTermination()
    got = spark.read.parquet(out)
    assert first == 2 and got.select("block_batch").distinct().count() == 3
    cols = sorted(c for c in got.columns)
    exp = rollups(spark, d)
    assert got.count() == exp.count()
    assert got.select(*cols).exceptAll(exp.select(*cols)).count() == 0


def test_daily_totals_watermark_drops_late_rows(spark):
    """Append mode: a day is emitted once the watermark passes it; a row
    arriving later for an already-closed day is dropped."""
    import datetime as dt

    from chainlens.plans.jobs import scratch_path
    from chainlens.streaming.incremental import start_daily_totals_stream

    schema = "block_datetime timestamp_ntz, sequencer_names string, gas_used long, n_input_bytes long"
    src, out, ck = (scratch_path(spark, "w-src"), scratch_path(spark, "w-out"),
                    scratch_path(spark, "w-ck"))
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    spark.createDataFrame([(day(1), "a", 1, 1), (day(2), "a", 2, 2)], schema).write.mode("append").parquet(src)
    start_daily_totals_stream(spark, src, out, ck, watermark="1 hour").awaitTermination()
    spark.createDataFrame([(day(5), "a", 5, 5)], schema).write.mode("append").parquet(src)
    start_daily_totals_stream(spark, src, out, ck, watermark="1 hour").awaitTermination()
    spark.createDataFrame([(day(1, 5), "a", 100, 100)], schema).write.mode("append").parquet(src)  # late
    start_daily_totals_stream(spark, src, out, ck, watermark="1 hour").awaitTermination()
    got = {r["day"]: r["gas_used"] for r in spark.read.parquet(out).collect()}
    assert got.get(dt.date(2024, 1, 1)) == 1       # late row dropped, day not reopened
    assert got.get(dt.date(2024, 1, 2)) == 2


def test_batch_without_labelled_rows_is_finished_once(spark):
    from pyspark.sql import functions as F

    from chainlens.plans.jobs import finished_path, scratch_path, write_rollups_incremental

    out = scratch_path(spark, "test-empty-batch")
    t, b, l = S.transactions(spark, D), S.blocks(spark, D), S.sequencer_labels(spark, D)
    bare = t.select(F.max("block_batch")).first()[0]
    labelled = [r[0] for r in l.select(l.columns[0]).collect()] + [r[0] for r in l.select(l.columns[-1]).collect()]
    t = t.filter((F.col("block_batch") != bare) | ~F.col("from_address").isin(labelled))
    first = write_rollups_incremental(spark, t, b, l, out).count()
    done = {r[0] for r in spark.read.parquet(finished_path(out)).collect()}
    assert bare in done and len(done) == first
    assert write_rollups_incremental(spark, t, b, l, out).count() == 0


def test_stream_waits_for_late_blocks(spark):
    from chainlens.operators.extend import rollup_transactions
    from chainlens.plans.jobs import scratch_path, write_batches
    from chainlens.streaming.incremental import start_rollups_stream

    t, b, l = S.transactions(spark, D, 300), S.blocks(spark, D, 300), S.sequencer_labels(spark, D)
    tx, bl, out, ck = (scratch_path(spark, f"late-{k}") for k in ("txs", "blocks", "out", "ck"))
    write_batches(t, tx)
    write_batches(b.filter("block_batch % 2 = 0"), bl)
    start_rollups_stream(spark, tx, bl, l, out, ck).awaitTermination()
    assert {r[0] for r in spark.read.parquet(out).select("block_batch").distinct().collect()} == {0, 2, 4}
    write_batches(b.filter("block_batch % 2 = 1"), bl)
    start_rollups_stream(spark, tx, bl, l, out, ck).awaitTermination()
    got, want = spark.read.parquet(out), rollup_transactions(t, b, l)
    cols = sorted(want.columns)
    assert got.filter("block_datetime is null").isEmpty()
    assert got.count() == want.count() and got.select(cols).exceptAll(want.select(cols)).isEmpty()


def test_micro_batch_reads_its_own_batches_only(spark):
    """Files of finished batches are spoiled in place; a new batch and a late side still go through."""
    import glob

    from chainlens.plans.jobs import scratch_path, write_batches
    from chainlens.streaming.incremental import start_rollups_stream

    t, b, l = S.transactions(spark, D, 300), S.blocks(spark, D, 300), S.sequencer_labels(spark, D)
    tx, bl, out, ck = (scratch_path(spark, f"own-{k}") for k in ("txs", "blocks", "out", "ck"))
    write_batches(t.filter("block_batch < 3"), tx)
    write_batches(b.filter("block_batch in (0, 1)"), bl)
    start_rollups_stream(spark, tx, bl, l, out, ck, max_files_per_trigger=2).awaitTermination()
    assert {r[0] for r in spark.read.parquet(out).select("block_batch").distinct().collect()} == {0, 1}
    for i in (0, 1):
        for f in glob.glob(f"{tx}/block_batch={i}/*.parquet") + glob.glob(f"{bl}/block_batch={i}/*.parquet"):
            with open(f, "wb") as h:
                h.write(b"spoiled")
        for f in glob.glob(f"{tx}/block_batch={i}/.*.crc") + glob.glob(f"{bl}/block_batch={i}/.*.crc"):
            os.remove(f)
    write_batches(b.filter("block_batch in (2, 4)"), bl)  # 2 is the late side of a known batch
    write_batches(t.filter("block_batch = 4"), tx)
    query = start_rollups_stream(spark, tx, bl, l, out, ck)
    query.awaitTermination()
    assert {r[0] for r in spark.read.parquet(out).select("block_batch").distinct().collect()} == {0, 1, 2, 4}
    n_files = len(glob.glob(f"{bl}/block_batch=[24]/*.parquet") + glob.glob(f"{tx}/block_batch=4/*.parquet"))
    assert sum(p["numInputRows"] for p in query.recentProgress) == n_files  # a row per file, not per row of data


def test_daily_totals_query_counts_every_row(spark):
    """The late rows of the registered query are in its totals."""
    from chainlens.plans import catalog

    rollups = catalog.rollups
    got = catalog.q_daily_totals_stream(spark, D).select("day", "sequencer_names", "n_txs", "gas_used", "n_input_bytes")
    want = rollups(spark, D).groupBy(F.to_date("block_datetime").alias("day"), "sequencer_names").agg(
        F.count("*").alias("n_txs"), F.sum("gas_used").alias("gas_used"), F.sum("n_input_bytes").alias("n_input_bytes"))
    late = rollups(spark, D).filter(f"to_date(block_datetime) < date'{catalog.LATE_DAY}' and block_number % 7 = 0")
    assert late.count() > 0 and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_daily_totals_complete_mode_keeps_late_and_undated_rows(spark):
    import datetime as dt

    from chainlens.plans.jobs import scratch_path
    from chainlens.streaming.incremental import start_daily_totals_stream

    schema = "block_datetime timestamp_ntz, sequencer_names string, gas_used long, n_input_bytes long"
    src, out, ck = (scratch_path(spark, f"complete-{k}") for k in ("src", "out", "ck"))
    day = lambda d: dt.datetime(2024, 1, d)
    for rows in ([(day(1), "a", 1, 1), (day(9), "a", 2, 2)], [(day(1), "a", 4, 4), (None, "a", 8, 8), (None, "b", None, 1)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        start_daily_totals_stream(spark, src, out, ck, mode="complete").awaitTermination()
    got = {(r.day, r.sequencer_names): (r.n_txs, r.gas_used) for r in spark.read.parquet(out).collect()}
    assert got == {(dt.date(2024, 1, 1), "a"): (2, 5), (dt.date(2024, 1, 9), "a"): (1, 2), (None, "a"): (1, 8), (None, "b"): (1, None)}


def test_pending_batches_prune_folders(spark):
    from chainlens.plans.jobs import id_range, only_batches, scratch_path, write_batches

    path = scratch_path(spark, "test-prune")
    write_batches(S.blocks(spark, D, 300), path)
    ids = spark.createDataFrame([(1,), (3,)], "block_batch bigint")
    got = only_batches(read_dataset(spark, path), ids, *id_range(ids))
    filters = [x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in x]
    assert filters and ">= 1" in filters[0] and "<= 3" in filters[0]
    assert {r[0] for r in got.select("block_batch").distinct().collect()} == {1, 3}
    assert id_range(ids.limit(0)) == (None, None)


def test_stream_computes_each_batch_once_in_bounded_commits(spark, monkeypatch):
    from chainlens.plans.jobs import scratch_path, write_batches
    from chainlens.streaming import incremental

    t, b, l = S.transactions(spark, D, 300), S.blocks(spark, D, 300), S.sequencer_labels(spark, D)
    tx, bl, out, ck = (scratch_path(spark, f"once-{k}") for k in ("txs", "blocks", "out", "ck"))
    write_batches(t.filter("block_batch < 3").repartition(7), tx)
    write_batches(b.filter("block_batch < 3"), bl)
    read, seen = incremental.read_batches, []
    monkeypatch.setattr(incremental, "read_batches", lambda s, p, ids: seen.append((p, list(ids))) or read(s, p, ids))
    incremental.start_rollups_stream(spark, tx, bl, l, out, ck, per_commit=2).awaitTermination()
    assert [ids for p, ids in seen if p == tx] == [[0, 1], [2]]
    assert {r[0] for r in spark.read.parquet(out).select("block_batch").distinct().collect()} == {0, 1, 2}


def test_batched_copy_has_few_files_a_batch(spark):
    """A batch's rows lie in the tasks of its chunks, whatever the number of tasks."""
    import glob

    from chainlens.plans.jobs import scratch_path, write_batches

    path, keep = scratch_path(spark, "few-files"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_batches(S.transactions(spark, D), path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", keep)
    batches = glob.glob(f"{path}/block_batch=*")
    assert batches and all(len(glob.glob(f"{x}/*.parquet")) <= 6 for x in batches)
