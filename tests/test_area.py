import zipfile

import pytest

import codeframe as cf
from codeframe.codebook import Codebook, Variable
from codeframe.sources import area

from test_codebook import TABLES, write_text, write_xml

CSV = """GISJOIN,PMSA,STATEA,D6Z001
GIS Join Match Code,PMSA Name,State Code,1989 to March 1990
G0080,"Akron, OH PMSA",01,10
G0360,Anaheim--Santa Ana,02,20.5
G0440,Do\xf1a Ana,03,
"""


@pytest.fixture
def area_csv(tmp_path):
    (tmp_path / "area.csv").write_bytes(CSV.encode("latin-1"))
    write_text(tmp_path, TABLES)
    return str(tmp_path / "area.csv")


def test_area_table(spark, area_csv):
    df = cf.read_area_table(spark, area_csv)
    rows = df.orderBy("GISJOIN").collect()
    assert len(rows) == 3 and [r["PMSA"] for r in rows] == ["Akron, OH PMSA", "Anaheim--Santa Ana", "Doña Ana"]
    assert [r["STATEA"] for r in rows] == ["01", "02", "03"]
    assert [r["D6Z001"] for r in rows] == [10.0, 20.5, None]
    assert cf.get_meta(df, "D6Z001") == cf.VarMeta("1989 to March 1990", "Year Structure Built (D6Z)")
    assert cf.get_meta(cf.read_area_table(spark, area_csv, var_attrs="var_label"), "D6Z001").var_desc is None


def test_plain_header_and_no_codebook(spark, tmp_path):
    (tmp_path / "p.csv").write_text("a,b\nx,1\ny,2\n")
    df = cf.read_area_table(spark, str(tmp_path / "p.csv"))
    assert df.count() == 2 and dict(df.dtypes) == {"a": "string", "b": "double"}
    assert cf.get_meta(df, "a") == cf.VarMeta()


def test_zip_member(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("t/a.csv", CSV.encode("latin-1"))
        z.writestr("t/b.csv", "q\n1\n")
    path = str(tmp_path / "z.zip")
    df = cf.read_area_table(spark, path, "t/a.csv")
    assert sorted(r["PMSA"] for r in df.collect())[2] == "Doña Ana" and df.count() == 3
    with pytest.raises(ValueError, match="several files"):
        cf.read_area_table(spark, path)


def test_utf8_area(spark, tmp_path):
    (tmp_path / "u.csv").write_text("GEOG_CODE,GEOG_CODE_LABEL,V\n1,Doña,5\n", encoding="utf-8")
    text = Codebook((Variable("V", "from text", "", var_type=""),), project="Text")
    df, book = cf.read_area_utf8(spark, str(tmp_path / "u.csv"), ddi=write_xml(tmp_path), codebook=text)
    assert df.first()["GEOG_CODE_LABEL"] == "Doña" and cf.get_meta(df, "V").label == "from text"
    assert book.project == "Text" and book.citation == "Cite it"
    assert cf.read_area_utf8(spark, str(tmp_path / "u.csv"))[1] is None


def test_mixed(spark, tmp_path):
    (tmp_path / "m.csv").write_text('COUNTRY,INC,AGE,FREE,CODE\n1,"$1,200",30,null,01\n2,null,null,7,02\n')
    book = Codebook((Variable("COUNTRY", "Country", val_labels=((1, "A"),), var_type="integer"), Variable("INC", var_type="numeric"),
                     Variable("INC", var_type="numeric"), Variable("AGE", var_type="integer"), Variable("GONE")))
    df = cf.read_mixed_micro(spark, str(tmp_path / "m.csv"), book)
    assert [tuple(r) for r in df.orderBy("COUNTRY").collect()] == [(1, 1200.0, 30, None, "01"), (2, None, None, 7.0, "02")]
    assert cf.is_labelled(df, "COUNTRY")
    assert cf.read_mixed_micro(spark, str(tmp_path / "m.csv"), book, n_max=1).count() == 1
    assert dict(cf.read_mixed_micro(spark, str(tmp_path / "m.csv")).dtypes)["COUNTRY"] == "double"


def test_line_breaks_in_texts(spark, tmp_path):
    (tmp_path / "m.csv").write_text('a,b\n"x\ny",1\nz,2\n')
    df = cf.read_area_table(spark, str(tmp_path / "m.csv"), csv_options={"multiLine": True})
    assert sorted(map(tuple, df.collect())) == [("x\ny", 1.0), ("z", 2.0)]


def test_given_types_skip_the_guess(spark, tmp_path):
    from pyspark.sql import types as T
    (tmp_path / "p.csv").write_text("a,b\n1,1\n2,2\n")
    df = area._typed(area._text_csv(spark, str(tmp_path / "p.csv"), None, "UTF-8"), {"a": T.IntegerType(), "b": T.StringType()})
    assert dict(df.dtypes) == {"a": "int", "b": "string"}


def test_bundle_brings_its_codebooks(spark, tmp_path):
    import gzip
    text = open(write_text(tmp_path, TABLES), encoding="utf-8").read()
    xml = open(write_xml(tmp_path), encoding="utf-8").read()
    with zipfile.ZipFile(tmp_path / "area.zip", "w") as z:
        z.writestr("t/a.csv", CSV.encode("latin-1"))
        z.writestr("t/a_codebook.txt", text)
        z.writestr("readme_info.txt", "not a codebook")
    df = cf.read_area_table(spark, str(tmp_path / "area.zip"))
    assert cf.get_meta(df, "D6Z001").label == "1989 to March 1990"
    with zipfile.ZipFile(tmp_path / "micro.zip", "w") as z:
        z.writestr("x.csv.gz", gzip.compress(b"YEAR,STATEFIP,MORE\n1962,1,01\n1963,2,02\n"))
        z.writestr("x.xml", xml)
    df = cf.read_mixed_micro(spark, str(tmp_path / "micro.zip"))
    assert [tuple(r) for r in df.orderBy("YEAR").collect()] == [(1962, 1, "01"), (1963, 2, "02")]
    assert cf.get_meta(df, "STATEFIP").val_labels == ((1, "Alabama"), (2, "Alaska"))
    assert cf.read_codebook(spark, str(tmp_path / "micro.zip")).file_name == "data.dat"
    folder = tmp_path / "folder"
    folder.mkdir()
    (folder / "u.csv").write_text("V,D6Z001\n1,2\n")
    (folder / "u.txt").write_text(text, encoding="utf-8")
    (folder / "u.xml").write_text(xml, encoding="utf-8")
    df, book = cf.read_area_utf8(spark, str(folder))
    assert cf.get_meta(df, "D6Z001").var_desc == "Year Structure Built (D6Z)" and book.citation == "Cite it"
