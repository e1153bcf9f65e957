"""Round trips through files."""

import os

import pytest

from playbill import session
from playbill.sources import (
    first_columns,
    read_result,
    read_titles_csv,
    write_partitioned,
    write_result,
    write_table,
)


def test_csv_cells_survive(spark, tmp_path):
    rows = [("1", None), ("2", "nan"), ("3", 'say "hi", then\ngo')]
    df = spark.createDataFrame(rows, "id string, text string")
    write_table(df, str(tmp_path / "t"), "csv")
    back = read_titles_csv(spark, str(tmp_path / "t"), df.schema, multiline=True)
    assert sorted(back.collect()) == rows
    split = read_titles_csv(spark, str(tmp_path / "t"), df.schema)
    assert split.count() == 4  # without multiline the quoted line break cuts the row


def test_latin_1_file(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_bytes("id,name\n1,Amélie\n".encode("latin-1"))
    df = read_titles_csv(spark, str(path), "id int, name string", encoding="latin-1")
    assert df.collect() == [(1, "Amélie")]


def test_keyed_result_gets_its_label(spark, tmp_path):
    df = spark.createDataFrame([("x", 3)], "key string, count bigint")
    write_result(df, str(tmp_path / "r"), label="country")
    back = read_result(spark, str(tmp_path / "r"), "country string, count bigint", "csv")
    assert back.collect() == [("x", 3)]
    with pytest.raises(ValueError):
        read_result(spark, str(tmp_path / "r"), fmt="csv")


def test_swapped_header_is_an_error(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("id,name\n1,a\n")
    with pytest.raises(Exception, match="header"):
        read_titles_csv(spark, str(path), "name string, id string").collect()


def test_line_breaks_in_results(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", 1)], "key string, n int")
    write_result(df, str(tmp_path / "r"))
    assert read_result(spark, str(tmp_path / "r"), df.schema, "csv").collect() == [("a\nb", 1)]


def test_shared_folder_is_needed_beyond_one_process():
    class Context:
        master = "local-cluster[2,1,512]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        session.shared_dir(Session())


def test_partition_folders_hold_all_rows(spark, tmp_path):
    rows = [(i, "South Korea" if i % 3 else "Japan") for i in range(300)]
    path = str(tmp_path / "p")
    write_partitioned(spark.createDataFrame(rows, "id int, country string"), path, "country")
    folders = {f for f in os.listdir(path) if f.startswith("country_key=")}
    assert folders == {"country_key=South_Korea", "country_key=Japan"}
    assert sorted((r["id"], r["country"]) for r in read_result(spark, path).collect()) == rows


def test_first_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert first_columns(df, 2).columns == ["a", "b"]


def test_scratch_follows_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    first, second = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert first != second
    if named:
        assert first.startswith(named)
