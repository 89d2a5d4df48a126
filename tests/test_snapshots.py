import shutil
import tempfile
from datetime import datetime, timedelta, timezone
from pathlib import Path
from types import SimpleNamespace
from unittest import mock

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tierstone.sources import snapshots
from tierstone.sources import (
    ConflictingVersions,
    SchemaChanged,
    VersionNotFound,
    all_commits,
    expire_snapshots,
    latest_commit,
    read_commit,
    read_snapshot,
    scratch_path,
    settle_conflicts,
    snapshot_history,
    stage,
    write_snapshot,
)

JAN, FEB, MAR = (datetime(2024, m, 1, 10, 0, 0, 123456, timezone.utc) for m in (1, 2, 3))


@pytest.fixture
def frames(spark):
    return [spark.createDataFrame([(i, f"v{i}")] * (i + 1), "n int, s string") for i in range(3)]


@pytest.fixture
def table(tmp_path, frames):
    path = str(tmp_path / "t")
    for df, moment in zip(frames, (JAN, FEB, MAR)):
        write_snapshot(df, path, committed_at=moment)
    return path


def test_latest_and_earlier_versions(spark, table, frames):
    assert rows(read_snapshot(spark, table)) == rows(frames[2])
    for version, df in enumerate(frames):
        assert rows(read_snapshot(spark, table, version_as_of=version)) == rows(df)


def test_versions_by_time(spark, table, frames):
    def at(moment):
        return rows(read_snapshot(spark, table, timestamp_as_of=moment))

    assert at(JAN) == rows(frames[0])
    assert at(FEB - timedelta(microseconds=1)) == rows(frames[0])
    assert at(FEB) == rows(frames[1])
    assert at("2024-02-15 00:00:00") == rows(frames[1])
    assert at(MAR + timedelta(days=900)) == rows(frames[2])


def test_history_is_newest_first(spark, table):
    log = snapshot_history(spark, table)
    assert log.columns == [
        "version",
        "timestamp",
        "operation",
        "operationParameters",
        "num_rows",
    ]
    assert [(r["version"], r["num_rows"]) for r in log.collect()] == [(2, 3), (1, 2), (0, 1)]
    first = log.collect()[-1]
    assert first["timestamp"].astimezone(timezone.utc) == JAN
    assert first["operation"] == "WRITE"
    assert first["operationParameters"] == {"mode": "Overwrite", "overwriteSchema": "false"}


def test_missing_versions(spark, table, tmp_path):
    with pytest.raises(VersionNotFound):
        read_snapshot(spark, table, version_as_of=3)
    with pytest.raises(VersionNotFound):
        read_snapshot(spark, table, timestamp_as_of=JAN - timedelta(microseconds=1))
    with pytest.raises(VersionNotFound):
        read_snapshot(spark, str(tmp_path / "none"))
    with pytest.raises(VersionNotFound):
        latest_commit(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        read_snapshot(spark, table, version_as_of=0, timestamp_as_of=JAN)


def test_schema_change_must_be_asked_for(spark, table, frames):
    wider = frames[0].withColumn("extra", F.lit(1.5))
    retyped = frames[0].withColumn("n", F.col("n").cast("long"))
    for changed in (wider, retyped, frames[0].drop("s")):
        with pytest.raises(SchemaChanged):
            write_snapshot(changed, table)
    assert latest_commit(spark, table).version == 2
    assert write_snapshot(wider, table, overwrite_schema=True).version == 3
    assert read_snapshot(spark, table).columns == ["n", "s", "extra"]
    assert read_snapshot(spark, table, version_as_of=0).columns == ["n", "s"]
    assert latest_commit(spark, table).schema["extra"].dataType.simpleString() == "double"


def test_nullability_is_no_schema_change(spark, table):
    required = spark.range(1).select(F.lit(1).alias("n"), F.lit("x").alias("s"))
    assert write_snapshot(required, table).version == 3


def test_uncommitted_attempt_is_invisible(spark, table, frames):
    frames[0].write.parquet(f"{table}/v=3-deadbeef0000")
    assert rows(read_snapshot(spark, table)) == rows(frames[2])
    assert write_snapshot(frames[1], table).version == 3
    assert rows(read_snapshot(spark, table)) == rows(frames[1])


def test_failed_write_commits_nothing(spark, table, frames):
    broken = frames[0].withColumn("s", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        write_snapshot(broken, table)
    assert latest_commit(spark, table).version == 2
    assert write_snapshot(frames[0], table).version == 3


def test_rebuilding_a_table_from_itself(spark, table):
    doubled = read_snapshot(spark, table).withColumn("s", F.concat("s", "s"))
    write_snapshot(doubled, table)
    assert rows(read_snapshot(spark, table)) == [(2, "v2v2")] * 3


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    empty = spark.range(5).filter("id > 9")
    commit = write_snapshot(empty, path)
    assert (commit.num_rows, commit.in_memory_bytes) == (0, 0)
    assert read_snapshot(spark, path).count() == 0
    assert read_snapshot(spark, path).columns == ["id"]


def test_commit_reports_rows_and_size(spark, table):
    commit = latest_commit(spark, table)
    assert commit.num_rows == 3 and commit.in_memory_bytes >= 3 * (16 + 2)
    assert rows(read_commit(spark, commit)) == rows(read_snapshot(spark, table))


def test_moved_table_still_reads(spark, table, tmp_path, frames):
    copied = str(tmp_path / "elsewhere")
    shutil.copytree(table, copied)
    assert rows(read_snapshot(spark, copied)) == rows(frames[2])


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared) and b.startswith(shared)
    staged = stage(spark.range(3), "three")
    assert staged.inputFiles()[0].removeprefix("file:").removeprefix("//").startswith(shared)
    assert rows(staged) == [(0,), (1,), (2,)]


def test_cluster_without_a_shared_folder_is_refused():
    def session(**conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, default=None: conf.get(k, default)))

    master, shared = "spark.master", "spark.checkpoint.dir"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session(**{master: "yarn"}), "x")
    on_cluster = scratch_path(session(**{master: "yarn", shared: "hdfs:///shared/"}), "x")
    assert on_cluster.startswith("hdfs:///shared/tierstone/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(session(**{master: "yarn", shared: "file:///tmp/mine"}), "x")
    local = session(**{master: "local[2]", "spark.sql.warehouse.dir": "file:/warehouse"})
    assert scratch_path(local, "x").startswith("file:/warehouse/scratch/tierstone/x-")


class _Standalone:
    """The session, as if on a standalone cluster; ``lost`` files lie on another machine."""

    def __init__(self, spark, lost=0, **conf):
        self.conf = SimpleNamespace(get=lambda k, default=None: {"spark.master": "spark://host:7077", **conf}.get(k, default))
        self.sparkContext, self.range, self._spark, self._lost = spark.sparkContext, spark.range, spark, lost

    @property
    def read(self):
        return self

    def schema(self, ddl):
        return self

    def parquet(self, path):
        for file in list(Path(path.removeprefix("file://")).glob("part-*"))[: self._lost]:
            file.unlink()
        return self._spark.read.schema("id long").parquet(path)


def test_standalone_cluster_may_share_a_mounted_folder(spark, tmp_path):
    """Machines that mount a folder share it, also the warehouse; a first write tells."""
    mounted = _Standalone(spark, **{"spark.checkpoint.dir": f"file://{tmp_path}/mounted/"})
    assert scratch_path(mounted, "x").startswith(f"file://{tmp_path}/mounted/tierstone/x-")
    assert scratch_path(mounted, "x").startswith(f"file://{tmp_path}/mounted/tierstone/x-")
    assert len(list((tmp_path / "mounted/tierstone").iterdir())) == 1  # tried once
    unnamed = _Standalone(spark, **{"spark.sql.warehouse.dir": f"file://{tmp_path}/warehouse"})
    assert scratch_path(unnamed, "x").startswith(f"file://{tmp_path}/warehouse/scratch/tierstone/x-")


def test_standalone_cluster_that_shares_no_folder_is_refused(spark, tmp_path):
    apart = _Standalone(spark, lost=1, **{"spark.checkpoint.dir": f"file://{tmp_path}/apart"})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(apart, "x")


def test_a_version_committed_twice_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(spark.range(2).toDF("n"), path)
    commit = latest_commit(spark, path)
    write_snapshot(spark.range(3).toDF("n"), path)
    # another writer that had read the same history
    line = spark.read.schema(snapshots._HISTORY).json(f"{path}/history").where("version = 1")
    line.write.mode("append").json(f"{path}/history")
    for use in (lambda: read_snapshot(spark, path), lambda: write_snapshot(spark.range(1).toDF("n"), path)):
        with pytest.raises(ConflictingVersions):
            use()
    assert rows(read_snapshot(spark, path, version_as_of=0)) == [(0,), (1,)] and commit.version == 0


def test_two_writers_of_one_version_can_be_settled(spark, tmp_path):
    """The first commit stays current; the other is in the history, and its rows can be read."""
    path = str(tmp_path / "t")
    write_snapshot(spark.range(3), path)
    with mock.patch.object(snapshots, "_current", lambda *_: None):  # a writer that saw no table
        late = write_snapshot(spark.range(9), path)
    with pytest.raises(ConflictingVersions):
        read_snapshot(spark, path)
    losers = settle_conflicts(spark, path)
    assert [x.folder for x in losers] == [late.folder] and read_commit(spark, losers[0]).count() == 9
    assert read_snapshot(spark, path).count() == read_snapshot(spark, path, version_as_of=0).count() == 3
    assert settle_conflicts(spark, path) == []
    assert sorted(r["operation"] for r in snapshot_history(spark, path).collect()) == ["SUPERSEDED", "WRITE", "WRITE"]
    assert write_snapshot(read_commit(spark, late), path).version == 1 and read_snapshot(spark, path).count() == 9


def test_old_versions_expire(spark, table, frames, tmp_path):
    """Their rows go, their lines stay; the current version and the numbering are as before."""
    assert expire_snapshots(spark, table, keep_last=3) == []
    assert [c.version for c in expire_snapshots(spark, table, keep_last=1, older_than=FEB)] == [0]
    assert rows(read_snapshot(spark, table, version_as_of=1)) == rows(frames[1])
    for missing in ({"version_as_of": 0}, {"timestamp_as_of": JAN}):
        with pytest.raises(VersionNotFound, match="expired"):
            read_snapshot(spark, table, **missing)
    assert [c.version for c in expire_snapshots(spark, table)] == [1]
    assert expire_snapshots(spark, table) == []
    assert [c.version for c in all_commits(spark, table)] == [2]
    assert sorted(p.name.split("-")[0] for p in tmp_path.glob("t/v=*")) == ["v=2"]
    assert rows(read_snapshot(spark, table)) == rows(frames[2]) and settle_conflicts(spark, table) == []
    log = [(r["version"], r["operation"]) for r in snapshot_history(spark, table).collect()]
    assert sorted(log) == [(0, "EXPIRED"), (0, "WRITE"), (1, "EXPIRED"), (1, "WRITE"), (2, "WRITE")]
    assert write_snapshot(frames[0], table).version == 3
    with pytest.raises(ValueError, match="keep_last"):
        expire_snapshots(spark, table, keep_last=0)


def test_expiry_that_failed_is_made_good(spark, table, tmp_path):
    kept = {p.name: p for p in tmp_path.glob("t/v=*")}
    expire_snapshots(spark, table)
    [current] = tmp_path.glob("t/v=*")
    gone = next(p for name, p in kept.items() if name != current.name)
    shutil.copytree(current, gone)  # as if its files had not been removed
    assert expire_snapshots(spark, table) == [] and not gone.exists() and current.exists()


def test_versions_that_are_read_together_do_not_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2):
        write_snapshot(spark.range(n), path, adds=True)
    with pytest.raises(ValueError, match="together"):
        expire_snapshots(spark, path)
    assert len(all_commits(spark, path)) == 2


def _files_read(df):
    """Rows, and the files that the scan opened for them."""
    found = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return found, leaves.apply(0).metrics().apply("numFiles").value()


def test_a_day_and_status_read_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    orders = spark.range(6000).select(
        F.col("id").alias("order_id"),
        F.expr("nullif(date_add(date'2024-01-01', cast(id % 20 as int)), date'2024-01-03')").alias("order_date"),
        F.expr("case when id % 3 = 0 then 'completed' when id % 7 > 0 then 'open / new' end").alias("status"),
        F.col("id").cast("double").alias("amount"),
    )
    commit = write_snapshot(orders, path, layout=["order_date", "status"])
    assert commit.num_rows == 6000 and read_snapshot(spark, path).dtypes == orders.dtypes
    every, all_files = _files_read(read_snapshot(spark, path))
    assert sorted(map(repr, every)) == sorted(map(repr, orders.collect()))
    day = "order_date = date'2024-01-05' and status = 'completed'"
    found, few = _files_read(read_snapshot(spark, path).where(day))
    assert sorted(found) == sorted(orders.where(day).collect()) and 0 < few < 0.1 * all_files
    assert write_snapshot(orders, path).version == 1  # the layout is no part of the schema


def test_layouts_that_would_change_values_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="double"):
        write_snapshot(spark.range(3).withColumn("x", F.rand()), path, layout=["x"])
    texts = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "n int, s string")
    with pytest.raises(ValueError, match="empty text"):
        write_snapshot(texts, path, layout=["s"])
    with pytest.raises(VersionNotFound):
        read_snapshot(spark, path)
    write_snapshot(texts.where("s is null or s != ''"), path, layout=["s"])
    assert rows(read_snapshot(spark, path)) == [(1, "a"), (3, None)]
