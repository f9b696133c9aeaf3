import zipfile

import pytest

import codeframe as cf
from codeframe.sources import files


@pytest.fixture
def bundle(tmp_path):
    path = tmp_path / "bundle.zip"
    with zipfile.ZipFile(path, "w") as z:
        for n in ("data_1.csv", "data_2.dat.gz", "sub/shape.zip", "b.shp", "r.tiff", "info.txt", "x.csv.bak"):
            z.writestr(n, "h1,h2\n1,2\n")
    return str(path)


def names(df):
    return sorted(r["file"] for r in df.collect())


def test_zip_listing(spark, bundle):
    got = {(r["type"], r["file"]) for r in cf.list_files(spark, bundle).collect()}
    assert got == {("data", "data_1.csv"), ("data", "data_2.dat.gz"), ("shape", "sub/shape.zip"), ("shape", "b.shp"), ("raster", "r.tiff")}
    assert names(cf.list_data(spark, bundle)) == ["data_1.csv", "data_2.dat.gz"]
    assert names(cf.list_data(spark, bundle, cf.ends_with(".csv"))) == ["data_1.csv"]
    assert names(cf.list_shape(spark, bundle)) == ["b.shp", "sub/shape.zip"]
    assert names(cf.list_raster(spark, bundle)) == ["r.tiff"]
    assert {r["type"] for r in cf.list_files(spark, bundle, ["raster"]).collect()} == {"raster"}


def test_folder_listing(spark, tmp_path):
    for n in ("test1.txt", "test2.txt", "test.csv", "abc.txt"):
        (tmp_path / n).write_text("x")
    folder = str(tmp_path)
    assert names(cf.list_data(spark, folder)) == ["test.csv"]
    assert sorted(cf.find_files(spark, folder, multiple_ok=True)) == ["abc.txt", "test.csv", "test1.txt", "test2.txt"]
    assert cf.find_files(spark, folder, "csv") == ["test.csv"]
    assert sorted(cf.find_files(spark, folder, None, cf.starts_with("test"), True)) == ["test.csv", "test1.txt", "test2.txt"]
    with pytest.raises(ValueError, match="several files"):
        cf.find_files(spark, folder, "txt")
    with pytest.raises(ValueError, match="neither a folder"):
        cf.find_files(spark, folder + "/abc.txt")


def test_many_archives_in_one_pass(spark, bundle, tmp_path):
    rows = files.archive_members(spark, str(tmp_path))
    assert rows.count() == 7 and files.classify(rows).count() == 5


@pytest.mark.parametrize("path,ext", [("a/b.dat.gz", ".dat.gz"), ("b.csv", ".csv"), ("b", ""), ("b.gz", ".gz"), ("x.zip", ".zip")])
def test_ext(path, ext):
    assert files.file_ext(path) == ext


def test_resolve(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_text("x")
    assert files.resolve_data_file(spark, str(tmp_path / "a.dat")) == str(tmp_path / "a.csv.gz")
    (tmp_path / "a.dat.gz").write_text("x")
    assert files.resolve_data_file(spark, str(tmp_path / "a.dat")).endswith("a.dat.gz")
    assert files.resolve_data_file(spark, str(tmp_path / "a.csv.gz")).endswith("a.csv.gz")
    with pytest.raises(FileNotFoundError):
        files.resolve_data_file(spark, str(tmp_path / "zz.dat"))
