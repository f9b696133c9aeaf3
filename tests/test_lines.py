import random

import pytest
from pyspark.sql import functions as F

import codeframe as cf
from codeframe.streaming import lines as L
from test_chunks import book  # noqa: F401


def split(data):
    """Lines as Spark's text source has them."""
    text = data.decode("latin-1").replace("\r\n", "\n").replace("\r", "\n")
    out = text.split("\n")
    return [x.encode("latin-1") for x in (out[:-1] if out[-1] == "" else out)]


def some_files(folder, seed):
    rng = random.Random(seed)
    folder.mkdir()
    contents = [b"", b"one line", b"\n", b"a\rb\r\nc\n\rd"] + [
        b"".join(bytes(rng.choices(b"abc\xe9 ", k=rng.randint(0, 30))) + rng.choice([b"\n", b"\n", b"\r\n", b"\r"]) for _ in range(rng.randint(1, 300))) + rng.choice([b"", b"tail"])
        for _ in range(3)]
    for i, c in enumerate(contents):
        (folder / f"part-{i}.txt").write_bytes(c)
    (folder / "_SUCCESS").write_bytes(b"not data\n")
    return [x for c in contents for x in split(c)]


@pytest.mark.parametrize("step,size", [(1, 5), (7, 64), (50, 1 << 20)])
def test_lines_by_number(spark, tmp_path, step, size, monkeypatch):
    want = some_files(tmp_path / "in", step)
    monkeypatch.setattr(L, "PIECE", 16)
    index = L.build_line_index(spark, str(tmp_path / "in"), str(tmp_path / "index"), step, size)
    assert index.total == len(want) == spark.read.text(str(tmp_path / "in")).count()
    for lo, hi in ((1, len(want)), (1, 1), (len(want), len(want)), (40, 95), (len(want) + 1, len(want) + 5), (0, 3), (9, 8)):
        got = sorted((r.row_no, bytes(r.value)) for r in index.lines(lo, hi).collect())
        assert got == [(i, want[i - 1]) for i in range(max(lo, 1), min(hi, len(want)) + 1)]
    again = L.open_line_index(spark, str(tmp_path / "index"))
    assert again.total == index.total and again.files == index.files
    with open(tmp_path / "in" / "part-1.txt", "ab") as f:
        f.write(b"more")
    with pytest.raises(ValueError, match="changed"):
        L.open_line_index(spark, str(tmp_path / "index"))


@pytest.mark.parametrize("piece", [1, 2, 3, 7])
def test_small_pieces(tmp_path, piece, monkeypatch):
    monkeypatch.setattr(L, "PIECE", piece)
    some_files(tmp_path / "in", piece)
    for path, size in L.files_of(str(tmp_path / "in")):
        data = (tmp_path / "in" / path.rsplit("/", 1)[1]).read_bytes()
        want = split(data)
        batches = list(L.line_batches(path, 0, size, 1, piece))
        assert [x for b in batches for x in b.column(0).to_pylist()] == want and [x for b in batches for x in b.column(1).to_pylist()] == list(range(1, len(want) + 1))
        for cut in (1, max(size // 2, 1), max(size, 1)):
            parts = [L.count_range(path, a, min(a + cut, size), 2) for a in range(0, size, cut)]
            assert sum(n for n, *_ in parts) + bool(parts and not parts[-1][2]) == len(want)
            for n, points, _ in parts:
                assert all(split(data[:o]) == want[: len(split(data[:o]))] for o, _ in points) and len(points) >= (n > 0)


def test_same_numbers_as_the_scan(spark, tmp_path):
    spark.range(20_000).select(F.format_string("%06d", "id").alias("value")).repartition(5).write.text(str(tmp_path / "t"))
    path = str(tmp_path / "t")
    numbered = {r.row_no: r.value for r in cf.with_row_no(spark.read.text(path)).where("row_no BETWEEN 7777 AND 9876").collect()}
    index = cf.build_line_index(spark, path, step=500, size=10_000)
    assert {r.row_no: bytes(r.value).decode() for r in index.lines(7777, 9876).collect()} == numbered
    # a pull in the middle reads its lines and less than a step on either side
    read = sum(end - start for _, start, end, _ in index.ranges(7777, 9876))
    assert read <= 7 * (2100 + 2 * 500) < 7 * 20_000 / 5
    assert len(index.ranges(1, 20_000, 7000)) >= 20  # a large one is dealt out


def test_pulls_by_ranges(spark, book):  # noqa: F811
    index = cf.build_line_index(spark, f"{book.file_path}/{book.file_name}", step=7)
    reader = cf.read_micro_pulled(spark, book, vars=["STATEFIP"], index=index)
    first = reader.pull(30)
    assert first.count() == 30 and reader.position == 30 and cf.is_labelled(first, "STATEFIP")
    stored = cf.read_micro_pulled(spark, book, vars=["STATEFIP"])
    assert sorted(map(str, first.collect())) == sorted(map(str, stored.pull(30).collect()))
    assert sum(d.count() for d in reader) == 50 and reader.is_done() and reader.pull() is None
    reader.seek(79)
    assert reader.pull(9).count() == 1
    with pytest.raises(ValueError):
        reader.seek(81)
    parts = cf.read_micro_list_pulled(spark, book, vars=["NAME"], index=index).pull(50)
    want = cf.read_micro_list_pulled(spark, book, vars=["NAME"]).pull(50)
    assert {t: sorted(map(str, d.collect())) for t, d in parts.items()} == {t: sorted(map(str, d.collect())) for t, d in want.items()}


def test_refusals(spark, tmp_path, book):  # noqa: F811
    (tmp_path / "a.txt.gz").write_bytes(b"")
    with pytest.raises(ValueError, match="compressed"):
        cf.build_line_index(spark, str(tmp_path / "a.txt.gz"))
    with pytest.raises(FileNotFoundError):
        cf.build_line_index(spark, str(tmp_path / "none"))
    (tmp_path / "b.txt").write_bytes(b"x\n")
    with pytest.raises(ValueError, match="other files"):
        cf.read_micro_pulled(spark, book, index=cf.build_line_index(spark, str(tmp_path / "b.txt")))
    (tmp_path / "e.txt").write_bytes(b"")
    empty = cf.build_line_index(spark, str(tmp_path / "e.txt"))
    assert empty.total == 0 and empty.lines(1, 5).count() == 0
