"""CSV by header: order, unknown and missing columns, cells of the wrong type, malformed rows."""

import pytest

from tastebud.sources import io as SIO


def _file(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_columns_are_found_by_the_header(spark, tmp_path):
    path = _file(tmp_path, "a.csv", "item_id,user_id,rank,score\n1,7,2,0.5\n3,,1,\n")
    got = sorted(map(tuple, SIO.read_csv(spark, path, SIO.recs_schema()).collect()), key=str)
    assert got == sorted([(7, 1, 0.5, 2), (None, 3, None, 1)], key=str)


def test_headers_that_do_not_fit_are_refused(spark, tmp_path):
    schema = SIO.interactions_schema()
    with pytest.raises(ValueError, match="missing columns .'play'"):
        SIO.read_csv(spark, _file(tmp_path, "a.csv", "user_id,item_id\n1,2\n"), schema)
    extra = _file(tmp_path, "b.csv", "user_id,note,item_id,play\n1,x,2,1.0\n")
    with pytest.raises(ValueError, match="unknown columns .'note'"):
        SIO.read_csv(spark, extra, schema)
    assert [tuple(r) for r in SIO.read_csv(spark, extra, schema, ignore_extra=True).collect()] == [(1, 2, 1.0)]
    (tmp_path / "two").mkdir()
    _file(tmp_path / "two", "1.csv", "user_id,item_id,play\n1,2,1.0\n")
    _file(tmp_path / "two", "2.csv", "item_id,user_id,play\n1,2,1.0\n")
    with pytest.raises(Exception):
        SIO.read_csv(spark, str(tmp_path / "two"), schema).collect()


def test_bad_cells_stop_the_read_or_go_to_quarantine(spark, tmp_path):
    path = _file(tmp_path, "a.csv", "score,user_id,item_id,rank\n0.5,1,2,3\nn/a,1,x9,3\n0.1,4,5\n0.1,4,5,6,7\n1e3,9,9,9\n")
    with pytest.raises(Exception, match="score: n/a"):
        SIO.read_csv(spark, path, SIO.recs_schema()).collect()
    good, bad = SIO.read_csv_quarantined(spark, path, SIO.recs_schema())
    assert sorted(map(tuple, good.collect())) == [(1, 2, 0.5, 3), (9, 9, 1000.0, 9)]
    rows = bad.collect()
    assert sorted(r.reason for r in rows) == ["item_id: x9; score: n/a", "malformed record", "malformed record"]
    assert all(r.file.endswith("a.csv") for r in rows) and {r.record for r in rows} >= {"0.1,4,5", "0.1,4,5,6,7"}
    assert good.count() == 2 and bad.count() == 3


def test_column_check(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in SIO.column_check(df, ["b", "c", "a"]).collect()] == [("b", True, 2, 1), ("c", False, 2, None), ("a", True, 2, 0)]
    assert [tuple(r) for r in SIO.column_check(df.where("a > 9"), ["a"]).collect()] == [("a", True, 0, 0)]
