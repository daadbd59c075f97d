"""Matrices as .npy files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastebud.sources import npy


def _got(df):
    rows = sorted(df.collect(), key=lambda r: r.row)
    assert [r.row for r in rows] == list(range(len(rows)))
    return np.array([list(r["values"]) for r in rows])


@pytest.mark.parametrize("dtype", ["float32", "float64"])
@pytest.mark.parametrize("version", [(1, 0), (2, 0)])
def test_files_of_numpy_are_read_in_ranges(spark, tmp_path, dtype, version):
    x = np.random.default_rng(1).normal(size=(1000, 7)).astype(dtype)
    with open(tmp_path / "m.npy", "wb") as f:
        np.lib.format.write_array(f, x, version=version)
    item = np.dtype(dtype).itemsize
    df = npy.read_npy(spark, str(tmp_path / "m.npy"), range_bytes=340 * 7 * item)
    assert df.rdd.getNumPartitions() == 3
    assert dict(df.dtypes)["values"] == ("array<float>" if dtype == "float32" else "array<double>")
    assert np.array_equal(_got(df).astype(dtype), x)


@pytest.mark.parametrize("dtype", ["float32", "float64"])
def test_written_matrices_are_numpys(spark, tmp_path, dtype):
    x = np.random.default_rng(2).normal(size=(300, 5))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, values array<double>").repartition(5)
    path = str(tmp_path / "out")
    npy.write_npy(df.repartitionByRange(4, "id").sortWithinPartitions("id"), path, dtype)
    files = npy.matrix_files(path)
    assert len(files) == 4
    assert np.array_equal(np.concatenate([np.load(f) for f in files]), x.astype(dtype))
    assert np.array_equal(_got(npy.read_npy(spark, path)), x.astype(dtype).astype(np.float64))
    npy.write_npy(df.where("id < 10").orderBy("id"), path, dtype)  # the files before are no longer listed
    assert np.array_equal(_got(npy.read_npy(spark, path)).astype(dtype), x[:10].astype(dtype))
    npy.write_npy(df.where("id < 0"), path, dtype)
    assert npy.read_npy(spark, path).count() == 0


def test_what_is_no_matrix_is_refused(spark, tmp_path):
    def refused(path, why):
        with pytest.raises(Exception, match=why):
            npy.read_npy(spark, str(path)).count()
    np.save(tmp_path / "f.npy", np.asfortranarray(np.arange(6.0).reshape(2, 3)))
    refused(tmp_path / "f.npy", "Fortran")
    np.save(tmp_path / "v.npy", np.arange(6.0))
    refused(tmp_path / "v.npy", "matrix")
    np.save(tmp_path / "i.npy", np.arange(6).reshape(2, 3))
    refused(tmp_path / "i.npy", "dtype")
    (tmp_path / "t.npy").write_bytes(b"text of some length")
    refused(tmp_path / "t.npy", "not an .npy")
    np.save(tmp_path / "s.npy", np.zeros((50, 4)))
    (tmp_path / "s.npy").write_bytes((tmp_path / "s.npy").read_bytes()[:-8])
    refused(tmp_path / "s.npy", "too few")
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id int, v array<double>").coalesce(1)
    with pytest.raises(Exception, match="different lengths"):
        npy.write_npy(rows, str(tmp_path / "w"))
    with pytest.raises(Exception, match="null"):
        npy.write_npy(spark.createDataFrame([(1, None)], "id int, v array<double>"), str(tmp_path / "w2"))
    assert not list((tmp_path).glob("w/part*"))


def test_alignment_by_position(spark, tmp_path):
    x = np.arange(12.0).reshape(4, 3)
    np.save(tmp_path / "m.npy", x)
    meta = spark.createDataFrame([("b", 20), ("a", 10), ("d", 40), ("c", 30)], "item_id string, line int")
    got = npy.align_by_position(npy.read_npy(spark, str(tmp_path / "m.npy")), meta, "line")
    assert {r.item_id: list(r["values"]) for r in got.collect()} == dict(zip("abcd", x.tolist()))
    with pytest.raises(ValueError, match="4 rows, the metadata 3"):
        npy.align_by_position(npy.read_npy(spark, str(tmp_path / "m.npy")), meta.where("line > 10"), "line")
    with pytest.raises(ValueError, match="place of its own"):
        npy.align_by_position(npy.read_npy(spark, str(tmp_path / "m.npy")), meta.withColumn("line", F.lit(1)), "line")
