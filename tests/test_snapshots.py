"""Snapshot tables: what readers see between the steps of writers, and two writers."""

import pytest
from pyspark.sql import functions as F

from aerolake import commitlog, loads, snapshots
from aerolake.session import fresh_path


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _frame(spark, v, ks):
    return spark.createDataFrame([(f"k{k}", k % 3, v) for k in ks], "k string, p int, v string")


def test_commit_numbers_are_taken_once(spark):
    folder = fresh_path(spark, "log")
    assert commitlog.latest(spark, folder) == 0
    assert commitlog.commit(spark, folder, 1, [{"a": "é"}])
    assert not commitlog.commit(spark, folder, 1, [{"a": "other"}])
    assert commitlog.read(spark, folder, 1) == [{"a": "é"}] and commitlog.numbers(spark, folder) == [1]
    assert _rows(commitlog.table(spark, folder, "a string")) == [("é",)]


def test_a_reader_keeps_its_snapshot(spark):
    path = fresh_path(spark, "t")
    snapshots.upsert(spark, path, _frame(spark, "a", range(9)), "k", "p")
    before = snapshots.read(spark, path)
    seen = _rows(before)
    snapshots.upsert(spark, path, _frame(spark, "b", [1, 4, 30]), "k", "p")
    assert _rows(before) == seen == _rows(snapshots.read(spark, path, version=1))
    after = _rows(snapshots.read(spark, path))
    assert len(after) == 10 and {r[0] for r in after if r[2] == "b"} == {"k1", "k4", "k30"}


def test_a_stop_before_the_commit_changes_nothing(spark, monkeypatch):
    path = fresh_path(spark, "t")
    snapshots.upsert(spark, path, _frame(spark, "a", range(9)), "k", "p")
    seen = _rows(snapshots.read(spark, path))

    def lost(*a):
        raise OSError("lost")

    monkeypatch.setattr(commitlog, "commit", lost)
    with pytest.raises(OSError):
        snapshots.upsert(spark, path, _frame(spark, "b", range(9)), "k", "p")
    monkeypatch.undo()
    assert _rows(snapshots.read(spark, path)) == seen
    snapshots.upsert(spark, path, _frame(spark, "b", range(9)), "k", "p")
    assert {r[2] for r in _rows(snapshots.read(spark, path))} == {"b"}
    # what the lost writer left is swept when it is old enough, and not before
    assert snapshots.sweep(spark, path, keep=1) == 1
    assert snapshots.sweep(spark, path, keep=1, orphan_seconds=-1) == 2         # its data and its staged batch
    assert {r[2] for r in _rows(snapshots.read(spark, path))} == {"b"}


@pytest.mark.parametrize("theirs", [[2, 5], [0, 3, 12]])
def test_two_writers_lose_nothing(spark, theirs, monkeypatch):
    """Another upsert commits between this one's merge and its commit, in another
    partition and in the same."""
    path = fresh_path(spark, "t")
    snapshots.upsert(spark, path, _frame(spark, "a", range(9)), "k", "p")
    real, tries = commitlog.commit, []

    def commit(s, folder, number, rows):
        tries.append(number)
        if len(tries) == 1:
            snapshots.upsert(spark, path, _frame(spark, "theirs", theirs), "k", "p")
        return real(s, folder, number, rows)

    monkeypatch.setattr(commitlog, "commit", commit)
    out = snapshots.upsert(spark, path, _frame(spark, "ours", [0, 6, 21]), "k", "p")
    assert out["version"] == 3 and tries == [2, 2, 3]
    got = {k: v for k, _, v in _rows(snapshots.read(spark, path))}
    wanted = {f"k{k}": "a" for k in range(9)} | {f"k{k}": "theirs" for k in theirs} | {f"k{k}": "ours" for k in (0, 6, 21)}
    assert got == wanted


def test_only_touched_partitions_are_read_and_written(spark):
    path = fresh_path(spark, "t")
    snapshots.upsert(spark, path, _frame(spark, "a", range(9)), "k", ["p"])
    first = snapshots.snapshot(spark, path)
    out = snapshots.upsert(spark, path, _frame(spark, "b", [1]), "k", ["p"])
    second = snapshots.snapshot(spark, path)
    assert out["touched"] == ["p=1"]
    assert {p for p in second.folders if second.folders[p] != first.folders[p]} == {"p=1"}
    assert len(snapshots.read(spark, path, partitions=["p=2"]).inputFiles()) == 1
    assert snapshots.read(spark, path, partitions=["p=9"]).count() == 0


def test_partition_names_are_those_of_a_write(spark):
    path = fresh_path(spark, "t")
    odd = spark.createDataFrame([("a", "x=1/y", None), ("b", "é %", 1.5), ("c", None, 2.0), ("d", "", 2.0)], "k string, s string, f double")
    out = snapshots.upsert(spark, path, odd, "k", ["s", "f"])
    assert sorted(snapshots.snapshot(spark, path).folders) == out["touched"]
    again = snapshots.upsert(spark, path, odd.where("k = 'a'").withColumn("k", F.lit("z")), "k", ["s", "f"])
    assert len(again["touched"]) == 1 and snapshots.read(spark, path).count() == 5


def test_replaced_partitions(spark):
    path = fresh_path(spark, "t")
    snapshots.replace_partitions(spark, path, _frame(spark, "a", range(9)), "p")
    snapshots.replace_partitions(spark, path, _frame(spark, "b", [1]), "p", drop=["p=2"])
    assert _rows(snapshots.read(spark, path)) == sorted([("k0", 0, "a"), ("k3", 0, "a"), ("k6", 0, "a"), ("k1", 1, "b")], key=str)


def test_ids_taken_by_another_load_are_not_used_twice(spark, monkeypatch):
    raw, firsts = fresh_path(spark, "raw"), []
    real = commitlog.commit

    def commit(s, folder, number, rows):
        if len(firsts) == 1:
            monkeypatch.undo()
            loads.record(spark, raw, "load_id=other", 10, "t", lambda first: None)
        return real(s, folder, number, rows)

    monkeypatch.setattr(commitlog, "commit", commit)
    entry = loads.record(spark, raw, "load_id=mine", 5, "t", lambda first: firsts.append(first))
    assert firsts == [1, 11] and entry["first_id"] == 11
    assert loads.record(spark, raw, "load_id=mine", 5, "t", lambda first: None)["first_id"] == 11       # as many rows
    assert loads.record(spark, raw, "load_id=mine", 6, "t", lambda first: None)["first_id"] == 16


def test_files_follow_the_bytes_and_not_the_partitions(spark):
    path = fresh_path(spark, "t")
    rows = spark.range(3000).selectExpr("concat('k', id) AS k", "date_add(date'2024-01-01', cast(id % 600 AS int)) AS p", "'a' AS v")
    snapshots.upsert(spark, path, rows, "k", "p")
    assert len(snapshots.snapshot(spark, path).folders) == 600 and len(snapshots.read(spark, path).inputFiles()) <= 8
    out = snapshots.upsert(spark, path, rows.where("p < date'2024-02-01'").withColumn("v", F.lit("b")), "k", "p")
    assert len(out["touched"]) == 31 and len(snapshots.read(spark, path).inputFiles()) <= 16
    count = lambda **k: {r.v: r["count"] for r in snapshots.read(spark, path, **k).groupBy("v").count().collect()}     # noqa: E731
    assert count() == {"a": 3000 - 155, "b": 155} and count(version=1) == {"a": 3000}
    assert count(partitions=["p=2024-01-31", "p=2024-02-01"]) == {"a": 5, "b": 5}
    assert snapshots.read(spark, path).distinct().count() == 3000


def test_names_are_read_back(spark):
    values = ["x=1/y", "é %", "a\"b#c%25'*:?\\{[]^\x01\x7f", "plain", "", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    names = snapshots.partition_names(spark, df, ["s"])
    path_of = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    assert names == sorted({path_of("s", v) for v in values})
    assert {snapshots.partition_values(n)[0] for n in names} == set(values) - {""}


def _many(spark, v, ks, n_parts=300):
    return spark.createDataFrame([(f"k{k}", k % n_parts, v) for k in ks], "k string, p int, v int")


def test_a_writer_need_not_parse_what_it_committed(spark, monkeypatch):
    path = fresh_path(spark, "t")
    parsed, real = [], commitlog.read
    monkeypatch.setattr(commitlog, "read", lambda *a: parsed.append(a[2]) or real(*a))
    for v in (1, 2):
        snapshots.upsert(spark, path, _many(spark, v, range(600)), "k", "p")
        snapshots.sweep(spark, path)
    assert parsed == [] and snapshots.read(spark, path).where("v = 2").count() == 600
    for _ in range(2):                  # what is kept stays as it was committed
        assert snapshots.snapshot(spark, path).schema.fieldNames() == snapshots.read(spark, path).columns == ["k", "p", "v"]
        assert len(snapshots.snapshot(spark, path).schema.fields) == 3
    # one line for the partitions that share their files, and one of each before, is read alike
    monkeypatch.undo()
    head, *rows = commitlog.read(spark, f"{path}/commits", 2)
    assert len(rows) <= 8 and sum(len(r["partitions"]) for r in rows) == 300
    former = [head, *({"partition": p, "write": r["write"], "files": r["files"]} for r in rows for p in r["partitions"])]
    assert commitlog.commit(spark, f"{path}/commits", 3, former)
    old, new = snapshots.snapshot(spark, path, 2), snapshots.snapshot(spark, path)
    assert (old.folders, old.files) == (new.folders, new.files)


def test_a_table_made_anew_at_its_path_is_read_anew(spark):
    from aerolake import storage
    path = fresh_path(spark, "t")
    for v in (1, 2):
        snapshots.upsert(spark, path, _many(spark, v, range(5 * v)), "k", "p")
        assert _rows(snapshots.read(spark, path, 1).select("v").distinct()) == [(v,)]
        storage.delete(spark, path)


@pytest.mark.parametrize("rows, files", [(1_000_000, 4), (0, 4), (1_000_000, 0)])
def test_versions_merged_after_one_shuffle_or_two(spark, rows, files, monkeypatch):
    """A stored batch with one version of each key: newer, older and equal ones, in
    partitions that are small or not."""
    monkeypatch.setattr(snapshots, "SMALL_ROWS", rows)
    monkeypatch.setattr(snapshots, "SMALL_FILES", files)
    path, at = fresh_path(spark, "t"), fresh_path(spark, "batch")
    wanted = {}
    for n, ks in enumerate((range(0, 900), range(450, 1500), range(0, 1500, 7))):
        batch = [(f"k{k}", None if k % 300 == 299 else k % 300, n if k % 3 else 1, n) for k in ks]
        spark.createDataFrame(batch, "k string, p int, o int, n int").write.parquet(f"{at}/{n}")
        stored = spark.read.parquet(f"{at}/{n}")
        out = snapshots.upsert(spark, path, stored, "k", "p", order_by="o", stored=True, one_version=True)
        for k, p, o, m in batch:
            if k not in wanted or o >= wanted[k][1]:
                wanted[k] = (p, o, m)
        assert out["batch_rows"] == len(batch) and stored.count() == len(batch)
        assert _rows(snapshots.read(spark, path)) == sorted(((k, *r) for k, r in wanted.items()), key=str)
        assert not _staged(spark, path)


def _staged(spark, path):
    from aerolake import storage
    return storage.subfolders(spark, f"{path}/staged")
