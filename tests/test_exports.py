"""The CSV scans: faults of lines, and folders of files with differing headers."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation

from postloom import registry
from postloom.sources import exports


def folder_of(tmp_path, files):
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_columns_go_by_name_in_every_file(spark, tmp_path):
    path = folder_of(tmp_path, {
        "a.csv": "id,sex,zan_count\n1,0,5\n", "b.csv": "zan_count,id,sex\n77,2,1\n", "c.csv": "name,id,zan_count\nx,3,8\n", "d.csv": "",
    })
    assert sorted(tuple(r) for r in exports.read_users(spark, path).collect()) == [("1", "0", "5"), ("2", "1", "77"), ("3", None, "8")]


def test_a_log_column_that_a_file_lacks_raises(spark, tmp_path):
    path = folder_of(tmp_path, {
        "a.csv": "id,user_id,event_id,event_data,created_at\n1,2,3,{},4\n", "b.csv": "id,user_id,event_id,created_at\n1,2,3,4\n",
    })
    with pytest.raises(PySparkException):
        exports.read_user_action(spark, path).collect()


@pytest.mark.parametrize("line", ["1,2,3,{},4,5", '1,2,3,{"a": 1, "b": 2},4', "1,2,3,{},4,"])
def test_long_log_lines_raise(spark, tmp_path, line):
    path = folder_of(tmp_path, {"log.csv": f"id,user_id,event_id,event_data,created_at\n1,2,3,{{}},4\n{line}\n"})
    with pytest.raises(PySparkException, match="too many fields"):
        exports.read_user_action(spark, path).collect()


def test_long_user_lines_raise_and_short_ones_are_filled(spark, tmp_path):
    path = folder_of(tmp_path, {"users.csv": "id,sex,zan_count\n1,0\n"})
    assert [tuple(r) for r in exports.read_users(spark, path).collect()] == [("1", "0", None)]
    path = folder_of(tmp_path, {"users.csv": "id,sex,zan_count\n2,0,7,9\n"})
    with pytest.raises(PySparkException, match="too many fields"):
        exports.read_users(spark, path).collect()


def test_left_out_lines_are_counted(spark, tmp_path):
    path = folder_of(tmp_path, {
        "a.csv": "id,title,introduction,genre_id,create_time\n1,t,i,1,5\n2,t,i,1,5,x\n", "b.csv": "title,id,introduction,genre_id,create_time\nt,3,i,1,5,x,\n",
    })
    counts = Observation("topics")
    assert [r["id"] for r in exports.read_topics(spark, path, counts=counts).collect()] == [1]
    assert counts.get == {"lines": 3, "lines_left_out": 2}


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    """500 files of three makes, one with a line break in its header and one with blank lines before it."""
    heads = ["id,sex,zan_count", '"a\nname ""x"", y",zan_count,id,sex', "\n\nsex,id,other,zan_count"]
    cells = [lambda i: f"{i},1,{2 * i}", lambda i: f'"z\nz",{2 * i},{i},1', lambda i: f"1,{i},o,{2 * i}"]

    def jobs_for(files):
        folder = tmp_path / str(files)
        folder.mkdir()
        for i in range(files):
            (folder / f"part {i} [a]%20.csv").write_text(f"{heads[i % 3]}\n{cells[i % 3](i)}\n", encoding="utf-8")
        spark.sparkContext.setJobGroup(f"headers-{files}", "headers")
        try:
            groups = exports._files_by_header(spark, str(folder))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert sorted(map(len, groups.values())) == sorted(len(range(i, files, 3)) for i in range(3))
        if files < 10:
            rows = {tuple(r) for r in exports.read_users(spark, str(folder)).collect()}
            assert rows == {(str(i), "1", str(2 * i)) for i in range(files)}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers-{files}"))

    assert jobs_for(500) == jobs_for(6)


def test_headers_where_files_share_a_task(spark, tmp_path, monkeypatch):
    """Without the settings that give each file a task of its own, no file is lost."""
    from contextlib import nullcontext

    monkeypatch.setattr(exports, "settings", lambda *_, **__: nullcontext())
    path = folder_of(tmp_path, {f"{i}.csv": f"{'id,sex' if i % 2 else 'sex,id'}\n{i},{i}\n" for i in range(9)} | {"empty.csv": "", "blank.csv": "\n\n"})
    assert sorted(map(len, exports._files_by_header(spark, path).values())) == [4, 5]


def test_an_export_has_as_many_files_as_its_table_has_parts(spark, tmp_path):
    """So no task writes a fixed share of the table, whatever its size; each file has its header."""
    path = tmp_path / "users"
    rows = spark.range(0, 900, 1, 9).selectExpr("string(id) AS id", "'1' AS sex", "string(2 * id) AS zan_count")
    registry._write_csv(rows, ["zan_count", "id", "sex"], str(path))
    files = list(path.glob("part-*"))
    assert len(files) == 9 and all(f.read_text().startswith("zan_count,id,sex\n") for f in files)
    assert sorted(tuple(r) for r in exports.read_users(spark, str(path)).collect()) == sorted((str(i), "1", str(2 * i)) for i in range(900))
