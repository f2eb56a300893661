"""The batch catalogue: discovery by listing alone, records, changed batches, commits."""

import os

import pytest
from pyspark.sql import functions as F

from chainlens.plans import jobs as J
from chainlens.sources import batches as B
from chainlens.sources import standins as S

D = "/root/testdata/sf0.001"


def put(folder, name, size=10):
    """A file that is no parquet file: whoever opens it fails."""
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(b"x" * size)
    return path


def ids(df):
    return sorted(r.block_batch for r in df.select("block_batch").collect())


def test_listing_opens_no_file(spark, tmp_path):
    t, b, out = (str(tmp_path / k) for k in ("t", "b", "out"))
    for i in (1, 2, 3):
        put(t, f"block_batch={i}/part-0.parquet", i)
    put(t, "block_batch=2/part-1.parquet", 5)
    put(t, "block_batch=7/notes.txt")
    put(t, "strange.parquet")
    for name in ("blocks__0_to_1.parquet", "blocks__2_to_3.parquet", "blocks__4_to_9.parquet"):
        put(b, name)
    states = {r.block_batch: (r.files, r.bytes) for r in B.batch_states(B.batch_files(spark, t)).collect()}
    assert states == {1: (1, 1), 2: (2, 7), 3: (1, 3)}
    both = B.common_batches(spark, t, b)
    assert ids(both) == [1, 3] and ids(B.pending_states(spark, both, out)) == [1, 3]
    B.record(both.filter("block_batch = 1"), out)
    assert ids(B.pending_states(spark, both, out)) == [3]
    put(t, "block_batch=1/part-9.parquet")  # a file is added to a finished batch
    both = B.common_batches(spark, t, b)
    assert ids(B.pending_states(spark, both, out)) == [3] and ids(B.pending_states(spark, both, out, refresh=True)) == [1, 3]
    assert ids(B.common_batches(spark, t, str(tmp_path / "missing"))) == []


def test_table_without_records(spark, tmp_path):
    out = str(tmp_path / "out")
    put(out, "block_batch=4/part-0.parquet")
    states = spark.createDataFrame([(4, 1), (5, 1)], "block_batch long, files long")
    assert ids(B.pending_states(spark, states, out)) == [5]
    assert sorted(r[0] for r in J.done_batches(spark, out).collect()) == [4]


def test_read_batches_lists_its_folders_only(spark, tmp_path):
    path = str(tmp_path / "blocks")
    J.write_batches(S.blocks(spark, D, 300), path)
    put(path, "block_batch=4/bad.parquet")
    df = B.read_batches(spark, path, [1, 3])
    assert ids(df.distinct()) and {r[0] for r in df.select("block_batch").distinct().collect()} == {1, 3}
    assert all("block_batch=1/" in f or "block_batch=3/" in f for f in df.inputFiles())
    with pytest.raises(FileNotFoundError):
        B.read_batches(spark, path, [99])


def test_read_batches_of_named_files(spark, tmp_path):
    path = str(tmp_path / "flat")
    for k in (0, 1):
        S.blocks(spark, D, 700).filter(F.col("block_batch") == k).drop("block_batch").coalesce(1).write.parquet(f"{path}-{k}")
        f = next(x for x in os.listdir(f"{path}-{k}") if x.endswith(".parquet"))
        os.makedirs(path, exist_ok=True)
        os.rename(f"{path}-{k}/{f}", f"{path}/blocks__{k * 700}_to_{k * 700 + 699}.parquet")
    assert B.read_batches(spark, path, [1399]).agg(F.min("block_number"), F.max("block_batch")).first()[:] == (700, 1399)


@pytest.fixture
def folders(spark, tmp_path):
    t, b, out = (str(tmp_path / k) for k in ("txs", "blocks", "out"))
    J.write_batches(S.transactions(spark, D, 300), t)
    J.write_batches(S.blocks(spark, D, 300), b)
    return t, b, out


def test_job_in_commits_equals_one_run(spark, folders):
    from chainlens.operators.extend import rollup_transactions

    t, b, out = folders
    labels = S.sequencer_labels(spark, D)
    done = J.process_new_batches(spark, t, b, labels, out, per_commit=2)
    assert ids(done) == [0, 1, 2, 3, 4] and ids(B.recorded(spark, out)) == ids(done)
    want = rollup_transactions(S.transactions(spark, D, 300), S.blocks(spark, D, 300), labels)
    got = spark.read.parquet(out)
    cols = sorted(want.columns)
    assert got.count() == want.count() and got.select(cols).exceptAll(want.select(cols)).isEmpty()


def test_finished_batches_are_not_opened(spark, folders):
    t, b, out = folders
    labels = S.sequencer_labels(spark, D)
    J.process_new_batches(spark, t, b, labels, out)
    for folder in (t, b):
        put(folder, "block_batch=2/part-bad.parquet")  # opening it would fail
    assert J.process_new_batches(spark, t, b, labels, out).count() == 0
    with pytest.raises(Exception, match="(?i)parquet"):
        J.process_new_batches(spark, t, b, labels, out, refresh=True)


def test_changed_batch_is_written_again(spark, folders):
    t, b, out = folders
    labels = S.sequencer_labels(spark, D)
    J.process_new_batches(spark, t, b, labels, out)
    before = spark.read.parquet(out).filter("block_batch = 1").count()
    late = S.transactions(spark, D, 300).filter("block_batch = 1").withColumn("transaction_index", F.col("transaction_index") + 100)
    late.drop("block_batch").coalesce(1).write.mode("append").parquet(f"{t}/block_batch=1")
    assert J.process_new_batches(spark, t, b, labels, out).count() == 0
    assert ids(J.process_new_batches(spark, t, b, labels, out, refresh=True)) == [1]
    assert spark.read.parquet(out).filter("block_batch = 1").count() == 2 * before
    assert J.process_new_batches(spark, t, b, labels, out, refresh=True).count() == 0


def test_copy_with_nothing_pending_writes_nothing(spark, folders):
    from chainlens.sources.files import list_files

    _, b, out = folders
    assert ids(J.copy_batches(spark, b, out, ["block_number"])) == [0, 1, 2, 3, 4]
    first = sorted(map(tuple, list_files(spark, out).collect()))
    put(b, "block_batch=0/bad.parquet")  # a finished batch is not opened
    assert J.copy_batches(spark, b, out).count() == 0
    assert sorted(map(tuple, list_files(spark, out).collect())) == first
    assert sorted(spark.read.parquet(out).columns) == ["block_batch", "block_number"]
