import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from tillroll.sources.published import Layer, LayerChanged

COLUMNS = "id long, day date, note string"
MONDAY, TUESDAY, SUNDAY = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 7)


def frame(spark, *rows, columns=COLUMNS):
    return spark.createDataFrame(list(rows), columns)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def layer(tmp_path):
    return Layer(str(tmp_path / "gold"))


def test_a_run_that_breaks_off_changes_nothing(spark, layer):
    with layer.next(spark) as draft:
        draft.write("a", frame(spark, (1, MONDAY, "old")))
        draft.write("b", frame(spark, (2, MONDAY, "old")), by="day")
    with pytest.raises(ZeroDivisionError), layer.next(spark) as draft:
        draft.write("a", frame(spark, (1, MONDAY, "new")))
        assert rows(layer.read(spark, "a")) == [(1, MONDAY, "old")]
        raise ZeroDivisionError
    lost = layer.next(spark)  # as after the loss of its driver: neither published nor dropped
    lost.write("b", frame(spark, (2, MONDAY, "lost")), by="day")
    assert rows(layer.read(spark, "a")) == [(1, MONDAY, "old")]
    assert rows(layer.read(spark, "b")) == [(2, MONDAY, "old")]
    assert layer.versions(spark) == [1]


def test_a_failing_write_leaves_the_old_table(spark, layer):
    with layer.next(spark) as draft:
        draft.write("a", frame(spark, (1, MONDAY, "old")))
    with pytest.raises(Exception, match="broken row"), layer.next(spark) as draft:
        draft.write("a", spark.range(100).selectExpr("if(id = 99, raise_error('broken row'), id) as id"))
    assert rows(layer.read(spark, "a")) == [(1, MONDAY, "old")]


def test_of_two_runs_from_one_version_the_first_wins(spark, layer):
    slow = layer.next(spark)
    slow.write("a", frame(spark, (1, MONDAY, "slow")))
    with layer.next(spark) as quick:
        quick.write("a", frame(spark, (1, MONDAY, "quick")))
    with pytest.raises(LayerChanged):
        slow.publish()
    with pytest.raises(LayerChanged), slow:
        pass
    assert rows(layer.read(spark, "a")) == [(1, MONDAY, "quick")]
    assert len(list(Path(layer.root, "_data", "a").iterdir())) == 1
    assert [p.name for p in Path(layer.root, "_versions").iterdir() if not p.name.endswith(".crc")] == [
        "0000000001.json"
    ]


def test_days_are_replaced_and_emptied_and_others_stay(spark, layer):
    with layer.next(spark) as draft:
        draft.write("t", frame(spark, (1, MONDAY, "a"), (2, TUESDAY, "a"), (3, SUNDAY, "a"), (4, None, "a")), by="day")
    with layer.next(spark) as draft:
        draft.write("t", frame(spark, (5, MONDAY, "b"), (5, MONDAY, "b")), by="day", days=[MONDAY, TUESDAY, None])
        stored = draft.read("t")
    expected = [(3, SUNDAY, "a"), (5, MONDAY, "b"), (5, MONDAY, "b")]
    assert rows(stored) == rows(layer.read(spark, "t")) == expected
    assert layer.read(spark, "t").columns == ["id", "day", "note"]
    assert rows(layer.read(spark, "t", version=1))[0] == (1, MONDAY, "a")
    with layer.next(spark) as draft:
        draft.write("t", frame(spark), by="day", days=[MONDAY, SUNDAY])
    assert rows(layer.read(spark, "t")) == []
    assert layer.read(spark, "t").dtypes == [("id", "bigint"), ("day", "date"), ("note", "string")]


def test_undated_rows_come_back_without_a_day(spark, layer):
    with layer.next(spark) as draft:
        draft.write("t", frame(spark, (1, None, "a"), (None, MONDAY, None)), by="day")
    assert rows(layer.read(spark, "t")) == [(1, None, "a"), (None, MONDAY, None)]


def test_a_table_kept_by_a_run_stays_as_it_was(spark, layer):
    with layer.next(spark) as draft:
        draft.write("a", frame(spark, (1, MONDAY, "a")))
    with layer.next(spark) as draft:
        draft.write("b", frame(spark))
    assert rows(layer.read(spark, "a")) == [(1, MONDAY, "a")]
    assert rows(layer.read(spark, "b")) == []
    with pytest.raises(LookupError):
        layer.read(spark, "c")


def test_readers_keep_their_version(spark, layer):
    with layer.next(spark) as draft:
        draft.write("a", frame(spark, (1, MONDAY, "old")))
    open_frame = layer.read(spark, "a")
    with layer.next(spark) as draft:
        draft.write("a", frame(spark, (1, MONDAY, "new")))
    assert rows(open_frame) == [(1, MONDAY, "old")]


def test_a_run_may_read_what_it_replaces(spark, layer):
    with layer.next(spark) as draft:
        draft.write("a", frame(spark, (1, MONDAY, "a")), by="day")
    with layer.next(spark) as draft:
        more = frame(spark, (2, TUESDAY, "b"))
        draft.write("a", layer.read(spark, "a").unionByName(more), by="day")
    assert rows(layer.read(spark, "a")) == [(1, MONDAY, "a"), (2, TUESDAY, "b")]


def test_vacuum_keeps_what_kept_versions_and_open_runs_need(spark, layer):
    for number in range(4):
        with layer.next(spark) as draft:
            draft.write("t", frame(spark, (number, MONDAY, "x")), by="day", days=[MONDAY] if number else None)
            if not number:
                draft.write("once", frame(spark, (9, MONDAY, "x")))
    dead = Layer(layer.root).next(spark)
    dead._base, dead._run = 1, "0000000001-dead"
    dead.write("t", frame(spark, (8, MONDAY, "x")), by="day")
    working = layer.next(spark)
    working.write("t", frame(spark, (7, MONDAY, "x")), by="day")
    assert layer.vacuum(spark, keep=2) == 3
    assert layer.versions(spark) == [3, 4]
    assert rows(layer.read(spark, "t", version=3)) == [(2, MONDAY, "x")]
    assert rows(layer.read(spark, "once")) == [(9, MONDAY, "x")]
    working.publish()
    assert rows(layer.read(spark, "t")) == [(7, MONDAY, "x")]
    with pytest.raises(ValueError):
        layer.vacuum(spark, keep=0)


def test_days_outside_the_scope_and_wrong_uses_are_errors(spark, layer):
    with layer.next(spark) as draft:
        draft.write("t", frame(spark, (1, MONDAY, "a")), by="day")
    for wrong, error in [
        (lambda d: d.write("t", frame(spark, (1, SUNDAY, "a")), by="day", days=[MONDAY]), ValueError),
        (lambda d: d.write("t", frame(spark), by="note"), TypeError),
        (lambda d: d.write("t", frame(spark), days=[MONDAY]), ValueError),
        (lambda d: d.write("t", frame(spark, columns="id int, day date"), by="day", days=[MONDAY]), ValueError),
        (lambda d: [d.write("t", frame(spark)), d.write("t", frame(spark))], ValueError),
    ]:
        with pytest.raises(error), layer.next(spark) as draft:
            wrong(draft)
    assert rows(layer.read(spark, "t")) == [(1, MONDAY, "a")]


def test_some_days_are_read_by_opening_only_those(spark, layer):
    numbers = spark.range(1000).selectExpr("id", "cast(20240101 + id % 10 as int) as date_sk")
    with layer.next(spark) as draft:
        draft.write("f", numbers, by="date_sk")
    with layer.next(spark) as draft:
        draft.write("f", numbers.where("date_sk = 20240104"), by="date_sk", days=[20240104])
    some = layer.read(spark, "f").where("date_sk between 20240103 and 20240104")
    assert len(some.inputFiles()) >= 2 and some.count() == 200
    scan = next(s for s in some._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in s)
    assert "PartitionFilters: [isnotnull(date_sk" in scan
    assert rows(layer.read(spark, "f")) == rows(numbers)


def test_a_plain_read_of_the_folder_mixes_no_runs(spark, layer):
    for note in ("old", "new"):
        with layer.next(spark) as draft:
            draft.write("t", frame(spark, (1, MONDAY, note)))
    with pytest.raises(AnalysisException):
        spark.read.parquet(layer.root)
    version = json.loads(Path(layer.root, "_versions", "0000000002.json").read_text())
    assert list(version) == ["t"]


def test_rows_that_lie_by_day_are_written_without_a_shuffle(spark, tmp_path):
    """Stored by day once, a table goes into its folders as it lies; the result is that of a shuffled write."""
    from tillroll.scratch import pin

    df = spark.range(400).selectExpr("id", "if(id % 50 = 0, null, int(id % 7)) as day").repartition(6)
    stored = pin(df, "by_day", by="day")
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, df.collect()))
    layer = Layer(str(tmp_path / "layer"))
    with layer.next(spark) as draft:
        draft.write("t", stored, by="day", laid_out=True)
    assert sorted(map(repr, layer.read(spark, "t").collect())) == sorted(map(repr, df.collect()))
    with layer.next(spark) as draft:
        draft.write("t", stored.where("day = 3").selectExpr("-id as id", "day"), by="day", days=[3], laid_out=True)
    assert layer.read(spark, "t").where("id < 0").count() == df.where("day = 3").count()
    assert layer.read(spark, "t").count() == 400
