import datetime as dt

import pytest

import codeframe as cf
from codeframe.sources import ddi, textbook

XML = """<?xml version="1.0" encoding="UTF-8"?>
<codeBook xmlns="http://www.icpsr.umich.edu/DDI"><stdyDscr><citation><prodStmt><prodDate date="2018-01-02">x</prodDate></prodStmt>
<serStmt><serName>Survey Project</serName></serStmt></citation>
<dataAccs><useStmt><conditions>Use it well</conditions><citReq>Cite it</citReq></useStmt></dataAccs><notes>n1</notes><notes>n2</notes></stdyDscr>
<fileDscr ID="F1"><fileTxt><fileName>data.dat</fileName><fileStrc type="{kind}">
<recGrp rectype="H" recidvar="RECTYPE" keyvar="YEAR SERIAL"><labl>Household Record</labl></recGrp>
<recGrp rectype="P" recidvar="RECTYPE" keyvar="YEAR SERIAL"><labl>Person Record</labl></recGrp></fileStrc>
<fileType charset="ISO-8859-1">x</fileType></fileTxt></fileDscr>{more}
<dataDscr>
<var name="RECTYPE" dcml="0" intrvl="discrete" rectype="H P"><location StartPos="1" EndPos="1" width="1"/><labl>Type</labl><txt>t</txt><varFormat type="character"/></var>
<var name="YEAR" dcml="0" intrvl="discrete" rectype="H P"><location StartPos="2" EndPos="5" width="4"/><labl>Survey year</labl><txt>YEAR &amp; more</txt><varFormat type="numeric"/></var>
<var name="SERIAL" dcml="0" intrvl="discrete" rectype="H P"><location StartPos="6" EndPos="9" width="4"/><labl>Serial</labl><txt>s</txt><varFormat type="numeric"/></var>
<var name="STATEFIP" dcml="0" intrvl="discrete" rectype="H"><location StartPos="10" EndPos="11" width="2"/><labl>State</labl><txt>d</txt>
<catgry><catValu>02</catValu><labl>Alaska</labl></catgry><catgry><catValu>01</catValu><labl>Alabama</labl></catgry>
<catgry><catValu>19</catValu><labl>19</labl></catgry><catgry><catValu>07</catValu><labl>7</labl></catgry><varFormat type="numeric"/></var>
<var name="HWTSUPP" dcml="2" intrvl="contin" rectype="H"><location StartPos="12" EndPos="21" width="10"/><labl>Weight</labl><txt>w</txt><varFormat type="numeric"/></var>
<var name="INCTOT" dcml="0" intrvl="contin" rectype="P"><location StartPos="10" EndPos="17" width="8"/><labl>Income</labl><txt>i</txt>
<codInstr>Codes
99,999,998 = Missing.
99999999  N.I.U.
no code</codInstr><varFormat type="numeric"/></var>
<var name="NAME" dcml="0" intrvl="discrete" rectype="P"><location StartPos="18" EndPos="22" width="5"/><labl>Name</labl><txt>n</txt>
<catgry><catValu>AA</catValu><labl>AA</labl></catgry><catgry><catValu>BB</catValu><labl>Both</labl></catgry><varFormat type="odd"/></var>
</dataDscr></codeBook>"""


def write_xml(folder, kind="hierarchical", more="", name="book.xml"):
    path = folder / name
    path.write_text(XML.format(kind=kind, more=more), encoding="utf-8")
    return str(path)


@pytest.fixture
def book(spark, tmp_path):
    return cf.read_codebook(spark, write_xml(tmp_path))


def test_file_level(book, tmp_path):
    assert (book.file_name, book.file_type, book.file_encoding, book.project) == ("data.dat", "hierarchical", "ISO-8859-1", "Survey Project")
    assert book.extract_date == dt.date(2018, 1, 2) and book.extract_notes == "n1\n\nn2"
    assert book.file_info("citation") == "Cite it"
    assert list(book.file_info()) == ["project", "extract_date", "extract_notes", "conditions", "citation"]
    assert book.terms() == "Use it well\n\nCite it\n\n"
    assert book.rectype_idvar == "RECTYPE" and book.keyvars == {"H": ("YEAR", "SERIAL"), "P": ("YEAR", "SERIAL")}


def test_variables(book):
    assert book.names == ["RECTYPE", "YEAR", "SERIAL", "STATEFIP", "HWTSUPP", "INCTOT", "NAME"]
    v = book.variable("HWTSUPP")
    assert (v.start, v.end, v.imp_decim, v.var_type, v.rectypes) == (12, 21, 2, "numeric", ("H",))
    assert [x.var_type for x in book.variables] == ["character", "integer", "integer", "integer", "numeric", "numeric", "character"]
    assert book.variable("YEAR").desc == "YEAR & more"


def test_value_labels(book):
    assert book.variable("STATEFIP").val_labels == ((1, "Alabama"), (2, "Alaska"))
    assert book.variable("INCTOT").val_labels == ((99999998, "Missing."), (99999999, "N.I.U."))
    assert book.variable("NAME").val_labels == (("BB", "Both"),)
    assert book.variable("RECTYPE").val_labels == (("H", "Household Record"), ("P", "Person Record"))


def test_rectype_names(book):
    assert book.rectype_names(["H", "P"]) == ["HOUSEHOLD", "PERSON"]
    assert book.rectype_names(["H", "X"]) == ["H", "X"]


def test_lower_names(spark, tmp_path, book):
    low = cf.read_codebook(spark, write_xml(tmp_path), lower_vars=True)
    assert low.names == [n.lower() for n in book.names]
    assert low.rectype_idvar == "rectype" and low.keyvars["H"] == ("year", "serial") and low.has_lower_names
    tables = cf.read_codebook_tables(spark, write_xml(tmp_path), lower_vars=True)
    assert tables.codebook().names == low.names


def test_first_file_only(spark, tmp_path):
    more = '<fileDscr ID="F2"><fileTxt><fileName>other.dat</fileName><fileStrc type="rectangular"/></fileTxt></fileDscr>'
    with pytest.warns(UserWarning, match="several files"):
        book = cf.read_codebook(spark, write_xml(tmp_path, more=more))
    assert book.file_name == "data.dat"


def test_folder_of_codebooks(spark, tmp_path):
    write_xml(tmp_path, name="a.xml")
    write_xml(tmp_path, kind="rectangular", name="b.xml")
    tables = cf.read_codebook_tables(spark, str(tmp_path))
    ids = tables.ids()
    assert len(ids) == 2 and tables.variables.count() == 14
    rect = tables.codebook(ids[1])
    assert rect.file_type == "rectangular" and rect.variables[0].rectypes is None and rect.rectype_idvar is None
    with pytest.raises(ValueError):
        tables.codebook()


def test_tables_round_trip(spark, book):
    again = book.to_tables(spark).codebook()
    assert again.variables == book.variables and again.keyvars == book.keyvars


def test_variable_questions(spark, book):
    info = cf.var_info(book, ["STATEFIP", cf.starts_with("HW")], spark)
    assert [r["var_name"] for r in info.collect()] == ["STATEFIP", "HWTSUPP"]
    assert cf.var_label(book, "YEAR") == "Survey year" and cf.var_desc(book, "STATEFIP") == "d"
    assert cf.val_labels(book, "STATEFIP") == [(1, "Alabama"), (2, "Alaska")]
    with pytest.warns(UserWarning, match="several variables"):
        assert cf.var_label(book, ["YEAR", "SERIAL"]) == "Survey year"
    df = cf.with_meta(spark.createDataFrame([(1, 2)], "a int, b int"), {"a": cf.VarMeta("first")})
    df2 = cf.with_meta(spark.createDataFrame([(1,)], "a int"), {"a": cf.VarMeta("second")})
    assert [(r["var_name"], r["var_label"]) for r in cf.var_info({"x": df, "y": df2}).collect()] == [("a", "first"), ("b", None)]
    assert cf.var_info(book.to_tables(spark), cf.contains("STATE")).first()["val_labels"][0]["lbl"] == "Alabama"
    first = cf.first_by_name(spark.createDataFrame([("a", 1, "p"), ("a", 0, "q")], "var_name string, pos int, t string"))
    assert [r["t"] for r in first.collect()] == ["q"]


def test_instruction_labels(spark):
    num = "\n".join(["1 = x", "2  y", "3 - z", "-4 = a", "abcd", "1962-1975 xyz"])
    chars = "\n".join(["a = x", "abc - y", "ab de = z", "abcd", "1962-1975 xyz"])
    df = spark.createDataFrame([(num, True), (chars, False)], "t string, n boolean")
    got = ddi.labels_from_instructions(df, "t", df["n"]).collect()
    assert [(r["val_num"], r["lbl"]) for r in got if r["n"]] == [(1, "x"), (2, "y"), (3, "z"), (-4, "a")]
    assert [(r["val"], r["lbl"]) for r in got if not r["n"]] == [("a", "x"), ("abc", "y")]


HEAD = ["Codebook for an extract", "Area data extract", "", "-" * 40, "Data Summary", "-" * 40, "Year: 1990", "{series}",
        "-" * 40, "Data Dictionary", "-" * 40, ""]
TABLES = ["Context Fields ", "   GISJOIN:       GIS Join Match Code", "   PMSA:    PMSA Name", " ",
          "Table 1:     Year Structure Built", "Universe:    Housing units", "Source code: H25", "AREA code:   D6Z",
          "   D6Z001:     1989 to March 1990", "   D6Z002:     1985 to 1988", " ",
          "Table 2:     Sex: by Age", "Universe:    Persons", "Source code: P1", "AREA code:   ABC", "   ABC001:     Male: Under 1", " "]
SERIES = ["Context Fields ", "   GISJOIN:       GIS Join Match Code", "   NATION:  Nation Name", " ",
          "Table 1:     (B78) Total Population", "    Time series AA", "        B78AA1980:   1980: Persons: Total", " "]
TAIL = ["-" * 40, "Citation and Use of Area Data", "-" * 40, "Please cite", "", "Thank you", "-" * 40, "End", "-" * 40]


def write_text(folder, body, series="", name="area_codebook.txt"):
    path = folder / name
    path.write_text("\n".join([x.replace("{series}", series) for x in HEAD] + body + TAIL), encoding="utf-8")
    return str(path)


def test_area_text_codebook(spark, tmp_path):
    book = cf.read_text_codebook(spark, write_text(tmp_path, TABLES))
    assert [(v.name, v.label, v.desc) for v in book.variables] == [
        ("GISJOIN", "GIS Join Match Code", ""), ("PMSA", "PMSA Name", ""),
        ("D6Z001", "1989 to March 1990", "Year Structure Built (D6Z)"), ("D6Z002", "1985 to 1988", "Year Structure Built (D6Z)"),
        ("ABC001", "Male: Under 1", "Sex: by Age (ABC)")]
    assert book.conditions == "Please cite\n\nThank you"


def test_time_series_text_codebook(spark, tmp_path):
    book = cf.read_text_codebook(spark, write_text(tmp_path, SERIES, "Time series layout:     Time varies by column"))
    assert [(v.name, v.desc) for v in book.variables] == [("GISJOIN", ""), ("NATION", ""), ("B78AA1980", "Total Population (B78)")]
    assert book.variable("B78AA1980").label == "1980: Persons: Total"


def test_data_file_text_codebook(spark, tmp_path):
    body = ["Data File: a.csv", "  GEOG_CODE:  Code", "  AREA:  Area in km", "", "Data File: b.csv", "  OTHER:  Other"]
    path = write_text(tmp_path, body)
    book = cf.read_text_codebook(spark, path, "a.csv")
    assert [(v.name, v.label) for v in book.variables] == [("GEOG_CODE", "Code"), ("AREA", "Area in km")]
    with pytest.raises(ValueError, match="several data files"):
        cf.read_text_codebook(spark, path)


def test_unknown_text_codebook(spark, tmp_path):
    path = tmp_path / "x.txt"
    path.write_text("a\nb\nc")
    with pytest.raises(ValueError, match="not a known"):
        cf.read_text_codebook(spark, str(path))
    good = write_text(tmp_path, TABLES)
    assert cf.read_text_codebook(spark, good, line2_markers={"Area data": "Areas"}).project == "Areas"
    with pytest.raises(ValueError):
        cf.read_text_codebook(spark, good, line2_markers={"Other": "X"})


def test_sections_of_many_books(spark, tmp_path):
    write_text(tmp_path, TABLES, name="a_codebook.txt")
    write_text(tmp_path, SERIES, "Time series layout:   x", name="b_codebook.txt")
    rows = textbook.textbook_variables(textbook.read_lines(spark, str(tmp_path)))
    assert sorted(r["layout"] for r in rows.select("codebook_id", "layout").distinct().collect()) == ["series", "tables"]
    assert rows.count() == 8


def test_prefixed_and_broken_xml(spark, tmp_path, book):
    import re
    text = open(write_xml(tmp_path), encoding="utf-8").read()
    body = re.sub(r"<(/?)(?=[A-Za-z])", r"<\1ddi:", text).replace("xmlns=", "xmlns:ddi=")
    (tmp_path / "prefixed.xml").write_text(body, encoding="utf-8")
    again = cf.read_codebook(spark, str(tmp_path / "prefixed.xml"))
    assert again.variables == book.variables and again.conditions == book.conditions
    (tmp_path / "broken.xml").write_text(text[: len(text) // 2], encoding="utf-8")
    with pytest.raises(Exception):
        cf.read_codebook(spark, str(tmp_path / "broken.xml")).names


@pytest.mark.parametrize("conditions, citation", [("Use it", "Cite it"), ("Use it", ""), ("Use it", None), (None, "Cite it"), ("", "")])
def test_terms_as_a_table(spark, conditions, citation):
    book = cf.Codebook(variables=(), conditions=conditions, citation=citation)
    assert [tuple(r) for r in book.to_tables(spark, "b").terms().collect()] == [("b", book.terms())]
