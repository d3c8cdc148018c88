import pytest
from pyspark.sql import functions as F

from viagrid import session
from viagrid.sources.batches import FAN, BatchTable


@pytest.fixture
def rows(spark):
    def make(numbers, days=2):
        return spark.createDataFrame([(n, f"2026-01-{1 + n % days:02d}") for n in numbers], "n long, day string")

    return make


def folders(spark, path):
    return [name for name in session.names_in(spark, path) if "=" in name]


def test_a_file_is_written_once(spark, tmp_path):
    path = f"{tmp_path}/lists/1.json"
    assert session.write_new_text(spark, path, "first ü") and not session.write_new_text(spark, path, "second")
    assert session.read_text(spark, path) == "first ü" and session.names_in(spark, f"{tmp_path}/lists") == ["1.json"]
    assert session.names_in(spark, f"{tmp_path}/none") == []


def test_batches_count_once_and_by_stream(spark, tmp_path, rows, values):
    table = BatchTable(spark, str(tmp_path / "t"), ["day"], mark=F.max("n"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(rows([90]), "a", 0)  # broke off before it counted
    table.add(rows([0, 1]), "a", 0)
    table.add(rows([2]), "b", 0)
    again = table.add(rows([7]), "a", 0)  # counts already
    table.add(rows([]), "a", 1)
    assert values(table.read(), "n") == [(0,), (1,), (2,)] and sorted(again.parts) == ["day=2026-01-01", "day=2026-01-02"]
    assert [(e.mark, e.level) for e in table.listing().live] == [("1", 0), ("2", 0)]
    assert table.listing().holds("a", 1) and not table.listing().holds("b", 1)
    assert values(table.read(parts={"day=2026-01-02"}), "n") == [(1,)]
    assert table.read(parts={"day=none"}).count() == 0


def test_folders_grow_with_the_logarithm_of_the_batches(spark, tmp_path, rows, values):
    table = BatchTable(spark, str(tmp_path / "t"), ["day"])
    most, files = [], []
    for number in range(40):
        table.add(rows([number], days=1).coalesce(1), "log", number)
        table.merge(fan=3)
        most.append(len(table.listing().live))
        files.append(len(table.read().inputFiles()))
    assert values(table.read(), "n") == sorted(((n,) for n in range(40)), key=repr)
    assert max(most) <= 2 * 4 and max(files) <= 2 * 4  # two of each level, 3 ** 4 > 40
    assert {e.level for e in table.listing().live} == {0, 1, 2, 3} and len(folders(spark, table.path)) == 40 + 13 + 4 + 1


def test_merging_beside_another_writer(spark, tmp_path, rows, values, monkeypatch):
    table = BatchTable(spark, str(tmp_path / "t"))
    for number in range(FAN):
        table.add(rows([number]).coalesce(1), "a", number)
    write, other = BatchTable._write, []

    def overtaken(own, df, name, level):
        entry = write(own, df, name, level)
        if level and not other:
            other.append(1)
            BatchTable(spark, own.path).add(rows([99]), "b", 0)
            BatchTable(spark, own.path).merge()
        return entry

    monkeypatch.setattr(BatchTable, "_write", overtaken)
    table.merge()
    assert values(table.read(), "n") == sorted([(n,) for n in range(FAN)] + [(99,)], key=repr)
    assert [e.level for e in table.listing().live] == [1, 0] and table.read().inputFiles()
    assert len([f for f in folders(spark, table.path) if "=m-" in f]) == 1  # the work of the second is dropped


def test_old_folders_go_only_when_no_list_names_them(spark, tmp_path, rows, monkeypatch):
    from viagrid.sources import batches

    monkeypatch.setattr(batches, "KEPT_LISTS", 3)
    table = BatchTable(spark, str(tmp_path / "t"), ["day"])
    for number in range(4):
        table.add(rows([number]), "a", number)
    before = table.read()
    table.merge(fan=4)
    assert before.count() == 4 and table.remove_merged() == 0  # a list that is kept names them
    table.write(rows([50]), "a", 9)  # belongs to a stream that is about to let it count
    table._write(rows([60]), "m-left", 1)
    for number in range(4, 8):
        table.add(rows([number]), "a", number)
    assert table.remove_merged() == 5 and table.read().count() == 8
    assert f"_commit=b-a-{9:010d}" in folders(spark, table.path)
