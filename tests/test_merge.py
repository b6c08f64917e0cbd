import random

import pytest
from pyspark.sql import functions as F

from sharefold.operators.merge import latest_by_key, upsert, with_arrival
from sharefold.sinks import merge_into_table, read_stored, resume
from sharefold.sinks import tables as sink

SCHEMA = "batch int, at int, code string, day date, name string, price double"


def make(spark, rows):
    df = spark.createDataFrame(rows, "batch int, at int, code string, day string, name string, price double")
    return with_arrival(df.withColumn("day", F.col("day").cast("date")), ["batch", "at"]).drop("batch", "at")


def state(df):
    return {(r.code, str(r.day)): (r.name, r.price) for r in df.collect()}


def by_hand(rows):
    """The table after writing the rows one by one in order of arrival."""
    table = {}
    for _, _, code, day, name, price in sorted(rows, key=lambda r: r[:2]):
        first = table.get((code, day), (name, None))[0]
        table[(code, day)] = (first, price)
    return table


def some_rows(seed, n=200):
    pick = random.Random(seed)
    return [
        (b, i, f"c{min(pick.randrange(6), pick.randrange(6))}", f"2018-08-0{pick.randrange(1, 5)}", f"n{pick.randrange(9)}", float(pick.randrange(99)))
        for i in range(n)
        for b in [pick.randrange(3)]
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_upsert_equals_row_by_row_writing(spark, seed):
    rows = some_rows(seed)
    key, sticky = ["code", "day"], ["name"]
    want = by_hand(rows)
    whole = upsert(None, make(spark, rows), key, sticky)
    assert state(whole) == want
    # Any split into batches, in any order, and any repeat of a batch give the same table.
    table = None
    for b in (2, 0, 1, 0):
        batch = make(spark, [r for r in rows if r[0] == b])
        table = upsert(table, batch, key, sticky)
    assert state(table) == want


def test_null_name_that_came_first_stays(spark):
    rows = [(1, 1, "c", "2018-08-01", None, 1.0), (1, 2, "c", "2018-08-01", "late", 2.0)]
    assert state(upsert(None, make(spark, rows), ["code", "day"], ["name"])) == {("c", "2018-08-01"): (None, 2.0)}


def test_null_value_that_came_last_wins(spark):
    rows = [(1, 1, "c", "2018-08-01", "n", 1.0), (1, 2, "c", "2018-08-01", "n", None)]
    assert state(upsert(None, make(spark, rows), ["code", "day"], ["name"])) == {("c", "2018-08-01"): ("n", None)}


def test_latest_by_key_keeps_column_order(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 5), (1, "b", 2.0, 6)], "k int, name string, v double, at int")
    out = latest_by_key(df, ["k"], ["name"], ["at"])
    assert out.columns == ["k", "name", "v", "at"]
    assert tuple(out.head()) == (1, "a", 2.0, 6)


def write(spark, path, rows):
    staged = f"{path}-in"
    make(spark, rows).write.mode("overwrite").parquet(staged)
    merge_into_table(spark.read.parquet(staged), path, ("code", "day"), ("name",), "day")


def test_stored_table_over_batches(spark, tmp_path):
    rows, path = some_rows(7), str(tmp_path / "t")
    for b in (1, 0, 2, 1):
        write(spark, path, [r for r in rows if r[0] == b])
    assert state(read_stored(spark, path)) == by_hand(rows)


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    write(spark, path, [(1, 1, "a", "2018-08-01", "n", 1.0), (1, 2, "a", "2018-08-02", "n", 1.0)])

    def files(day):
        return {f for f in read_stored(spark, path).inputFiles() if f"day={day}" in f}

    first, second = files("2018-08-01"), files("2018-08-02")
    write(spark, path, [(2, 1, "a", "2018-08-02", "m", 5.0)])
    after = read_stored(spark, path)
    assert files("2018-08-01") == first and files("2018-08-02").isdisjoint(second)
    assert state(after)[("a", "2018-08-02")] == ("n", 5.0)


def test_scan_is_pruned_to_the_touched_partitions(spark, tmp_path):
    stored, incoming = str(tmp_path / "s"), spark.createDataFrame([(0,), (19,), (19,)], "p long")
    spark.range(20).select(F.col("id").alias("v"), F.col("id").alias("p")).write.partitionBy("p").parquet(stored)
    listed = sink.touched_partitions(incoming, "p", str(tmp_path / "t"))
    touched = sink.stored_in(spark.read.schema("v long, p long").parquet(stored), listed, "p")
    text = touched._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text and "Cartesian" not in text and "NestedLoop" not in text
    assert sorted(r.v for r in touched.collect()) == [0, 19]


def test_rows_without_a_partition_value_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, code in ((0, "a"), (1, "b"), (2, "a")):
        row = spark.range(1).select(F.lit(code).alias("code"), F.lit(None).cast("string").alias("day"), F.lit("n").alias("name"), F.lit(float(batch)).alias("price"))
        staged = with_arrival(row.withColumn("at", F.lit(batch)), ["at"]).drop("at")
        staged.write.mode("overwrite").parquet(f"{path}-in{batch}")
        merge_into_table(spark.read.parquet(f"{path}-in{batch}"), path, ("code", "day"), ("name",), "day")
    found = {r.code: (r.day, r.price) for r in read_stored(spark, path).collect()}
    assert found == {"a": (None, 2.0), "b": (None, 1.0)}


def test_many_touched_partitions(spark, tmp_path):
    rows, path = some_rows(9), str(tmp_path / "t")
    for b in (0, 1, 2):
        write(spark, path, [r for r in rows if r[0] == b])
    assert state(read_stored(spark, path)) == by_hand(rows)


def test_run_that_dies_between_the_steps_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write(spark, path, [(1, 1, "a", "2018-08-01", "n", 1.0)])

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sink, "_apply", die)
        with pytest.raises(RuntimeError):
            write(spark, path, [(2, 1, "a", "2018-08-01", "m", 2.0)])
    assert state(read_stored(spark, path)) == {("a", "2018-08-01"): ("n", 1.0)}
    assert resume(spark, path, "day") and not resume(spark, path, "day")
    assert state(read_stored(spark, path)) == {("a", "2018-08-01"): ("n", 2.0)}


def test_fold_combines_before_the_shuffle(spark):
    plan = upsert(None, make(spark, some_rows(1)), ["code", "day"], ["name"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "partial_min" in text and "Window" not in text


def test_stored_side_is_shuffled_once_and_not_folded(spark, tmp_path):
    rows = some_rows(1)
    upsert(None, make(spark, rows[:100]), ["code", "day"], ["name"]).write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    plan = upsert(stored, make(spark, rows[100:]), ["code", "day"], ["name"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    left = text.split("FileScan")[0]
    assert "FullOuter" in text and "Cartesian" not in text and "NestedLoop" not in text
    assert left.count("Exchange") == 1 and "Aggregate" not in left


def test_missing_key_part_is_one_key(spark):
    rows = [(1, 1, None, "2018-08-01", "n", 1.0)]
    again = [(2, 1, None, "2018-08-01", "m", 2.0)]
    key, sticky = ["code", "day"], ["name"]
    table = upsert(upsert(None, make(spark, rows), key, sticky), make(spark, again), key, sticky)
    assert state(table) == {(None, "2018-08-01"): ("n", 2.0)}


def test_only_changes_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, i, f"c{i % 5}", f"2018-08-0{i % 7 + 1}", "n", float(i)) for i in range(35)]
    again = [(2, at, code, day, "other", price + (at == 3)) for _, at, code, day, _, price in rows]

    def merge(batch):
        make(spark, batch).write.parquet(f"{path}/in{batch[0][0]}")
        landed = spark.read.parquet(f"{path}/in{batch[0][0]}")
        merge_into_table(landed, path, ("code", "day"), ("name",), "day", only_changes=True)
        files = spark.read.parquet(f"{path}/rows").inputFiles()
        return {f.split("day=")[1].split("/")[0]: f for f in files}

    before, after = merge(rows), merge(again)
    assert [day for day in sorted(before) if before[day] != after[day]] == ["2018-08-04"]
    assert state(read_stored(spark, path)) == by_hand(rows + again)


def test_a_first_load_moves_rows_once_and_equals_row_by_row_writing(spark, tmp_path, monkeypatch):
    rows, path = some_rows(4), str(tmp_path / "t")
    for cell_rows in (1_000_000, 5):  # with the second, most cells are crowded
        monkeypatch.setattr(sink, "CELL_ROWS", cell_rows)
        monkeypatch.setattr(sink, "TASK_ROWS", 20)
        write(spark, f"{path}{cell_rows}", rows)
        assert state(read_stored(spark, f"{path}{cell_rows}")) == by_hand(rows)
    monkeypatch.setattr(sink, "CELL_ROWS", 1_000_000)
    folded = sink.fold_dealt(spark.read.parquet(f"{path}5-in"), ("code", "day"), ("name",), "day", path)
    assert folded._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_merged_rows_are_written_once(spark, tmp_path):
    path = str(tmp_path / "t")
    write(spark, path, some_rows(5))
    assert not list((tmp_path / "t" / "merged").glob("day=*")) and not list((tmp_path / "t" / "merged").glob("*.parquet"))
    assert list((tmp_path / "t" / "rows").glob("day=*/*.parquet"))


def test_a_run_that_dies_while_folders_move_is_finished(spark, tmp_path, monkeypatch):
    rows, path = some_rows(6), str(tmp_path / "t")
    write(spark, path, [r for r in rows if r[0] == 0])
    with monkeypatch.context() as m:
        m.setattr(sink, "_apply", lambda *_: None)
        write(spark, path, [r for r in rows if r[0] > 0])
    # One folder was moved before the run died, and of another the old one was only deleted.
    moved, deleted = sorted((tmp_path / "t" / "merged").glob("day=*"))[:2]
    old = tmp_path / "t" / "rows"
    for day in (moved.name, deleted.name):
        (old / day).rename(tmp_path / f"gone-{day}")
    moved.rename(old / moved.name)
    assert resume(spark, path, "day") and not resume(spark, path, "day")
    assert state(read_stored(spark, path)) == by_hand(rows)
