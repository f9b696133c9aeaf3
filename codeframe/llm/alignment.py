"""Alignment of two tokenizers' tokens by an associative composition of fragments.

Both tokenizers cut the same bytes. Where tokens of both end at the same byte the text falls into groups; inside a group every overlap of two tokens is a link.
A text's tokens are dealt into byte ranges by where they end. The tokens of a range form a fragment: an open prefix up to its first common end,
closed groups, and an open suffix after its last one. Two neighbouring fragments compose to one: the suffix of the first and the prefix of the second
close a group between them (``compose``). As that is associative, fragments of very long texts are composed as a tree, in tasks of a few fragments each.

How many documents hold a linked pair of ids is counted over the corpus with map-side combine. The counts go back to the links by hash parts of the pairs;
parts with much-held pairs are split among several tasks.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeframe.llm import text as T
from codeframe.llm.tables import written

#: Bytes of a range; a shorter text is aligned in one go.
RANGE = 1 << 15
#: Fragments that one step of the tree composes.
FAN = 16
#: Link entries that one task looks up, and pairs whose counts it holds for that.
ENTRIES = 1_500_000
PAIRS = 4_000_000
#: Least number of parts of the pairs.
PARTS = 16
#: Texts whose links are packed together.
PACKED = 2048


@dataclass(frozen=True)
class Tokenizer:
    """Ids of texts, and each id's bytes. ``open`` makes the encoder in a worker: a function from texts to lists of ids."""

    open: Callable[[], Callable[[list[str]], list[list[int]]]]
    token_bytes: list[bytes] = field(repr=False)


def byte_level(path: str, pattern: str) -> Tokenizer:
    """A byte-level BPE vocabulary file (``tokenizers`` JSON without normaliser, cut by ``pattern``), for the text behind a blank. Special tokens are plain text."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    # the byte-level alphabet: printable bytes stand for themselves, the others for the characters from U+0100 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    text = {i: bytes(byte[c] for c in t) for t, i in model["vocab"].items()}
    ranks = {t: i for i, t in text.items()}
    for i, merge in enumerate(model["merges"]):  # ids in the order of merges make ranks
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        if model["vocab"][a + b] != 256 + i:
            raise ValueError("the ids of this vocabulary are not in the order of its merges")

    def encoder():
        import tiktoken

        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [encoding.encode_ordinary(" " + t) for t in texts]

    return Tokenizer(encoder, [text.get(i, b"") for i in range(max(text) + 1)])


def pieces(path: str) -> Tokenizer:
    """A sentence-piece model that puts a blank before the text; U+2581 is a blank, <0xHH> a byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    token = lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()

    def encoder():
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: own.encode(texts, num_threads=1)

    return Tokenizer(encoder, [token(i) for i in range(model.get_piece_size())])


class Tables:
    """Both vocabularies as arrays, and the texts of ids."""

    def __init__(self, a: Tokenizer, b: Tokenizer):
        self.a_length, self.b_length = (np.array([len(t) for t in x.token_bytes], np.int64) for x in (a, b))
        self.a_bytes, self.b_bytes = a.token_bytes, b.token_bytes
        self.size = len(b.token_bytes)
        self.marked = [str(i) + mark for i in range(max(len(a.token_bytes), len(b.token_bytes))) for mark in ",|;"]
        self.encode_a, self.encode_b = a.open(), b.open()


def _axis(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, ...]:
    """(cuts, a, b, common): ends of either, which tokens stand before each, and the ends of both. The tokens of both cover the same bytes."""
    base = min(a_end[0], b_end[0])
    is_a, is_b = np.zeros((2, a_end[-1] - base + 1), bool)
    is_a[a_end - base] = True
    is_b[b_end - base] = True
    cuts = np.flatnonzero(is_a | is_b)
    before_a, before_b = np.cumsum(is_a[cuts]), np.cumsum(is_b[cuts])
    return cuts + base, before_a - is_a[cuts], before_b - is_b[cuts], np.flatnonzero(is_a & is_b) + base


def _pieces(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, common: np.ndarray, marked: list[str]) -> list[str]:
    """The ids of both, group by group, each with the mark that follows it: a comma, a bar after the last of A, a semicolon after the last of B."""
    up_to_a, up_to_b = np.searchsorted(a_end, common, "right"), np.searchsorted(b_end, common, "right")
    many_a, many_b = np.diff(up_to_a, prepend=0), np.diff(up_to_b, prepend=0)
    place_a = np.arange(len(a)) + np.repeat(up_to_b - many_b, many_a)
    place_b = np.arange(len(b)) + np.repeat(up_to_a, many_b)
    codes = np.empty(len(a) + len(b), np.int64)
    codes[place_a], codes[place_b] = 3 * a, 3 * b
    codes[place_a[up_to_a - 1]] += 1
    codes[place_b[up_to_b - 1]] += 2
    return list(map(marked.__getitem__, codes.tolist()))


@dataclass
class Fragment:
    """Tokens of a byte range: ``prefix`` and ``suffix`` are (a ids, a ends, b ids, b ends); without any common end (``cut`` false) all of it is prefix.

    ``text`` has the closed groups, each with a semicolon after it; ``pairs`` the distinct links in them, as a * size + b, and ``times`` how often each occurs.
    """

    cut: bool
    prefix: tuple
    text: str
    groups: int
    pairs: np.ndarray
    times: np.ndarray
    suffix: tuple


def _empty() -> np.ndarray:
    return np.zeros(0, np.int64)


def _closed(tokens: tuple, common: np.ndarray, tables: Tables) -> tuple[str, np.ndarray, np.ndarray]:
    """Text and counted links of tokens that make up whole groups, which end at ``common``."""
    a, a_end, b, b_end = tokens
    _, ia, ib, _ = _axis(a_end, b_end)
    return ("".join(_pieces(*tokens, common, tables.marked)), *np.unique(a[ia] * tables.size + b[ib], return_counts=True))


def fragment(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, tables: Tables) -> Fragment:
    """The fragment of the tokens that end in a byte range."""
    none = (_empty(),) * 4
    common = np.intersect1d(a_end, b_end, assume_unique=True)
    if not len(common):
        return Fragment(False, (a, a_end, b, b_end), "", 0, _empty(), _empty(), none)
    (a0, a1), (b0, b1) = (np.searchsorted(x, common[[0, -1]], "right") for x in (a_end, b_end))
    cut = lambda x, y: (a[x[0]: y[0]], a_end[x[0]: y[0]], b[x[1]: y[1]], b_end[x[1]: y[1]])
    closed = _closed(cut((a0, b0), (a1, b1)), common[1:], tables) if len(common) > 1 else ("", _empty(), _empty())
    return Fragment(True, cut((0, 0), (a0, b0)), closed[0], len(common) - 1, *closed[1:], cut((a1, b1), (len(a), len(b))))


def _sum(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    pair, at = np.unique(np.concatenate(pairs), return_inverse=True)
    total = np.zeros(len(pair), np.int64)
    np.add.at(total, at, np.concatenate(times))
    return pair, total


def compose(parts: list[Fragment], tables: Tables) -> Fragment:
    """One fragment of neighbouring ones, in order. Associative: it does not matter how the parts were composed before."""
    join = lambda xs: tuple(np.concatenate(x) for x in zip(*xs))
    none = (_empty(),) * 4
    cut, prefix, rest, text, groups = False, none, [none], [], 0
    pairs, times = [_empty()], [_empty()]
    for part in parts:
        rest.append(part.prefix)
        if not part.cut:
            continue
        middle = join(rest)
        if cut:  # suffixes and prefixes between two common ends: one group
            closed = _closed(middle, middle[1][-1:], tables)
            text.append(closed[0])
            pairs.append(closed[1])
            times.append(closed[2])
            groups += 1
        else:
            cut, prefix = True, middle
        text.append(part.text)
        pairs.append(part.pairs)
        times.append(part.times)
        groups += part.groups
        rest = [part.suffix]
    return Fragment(cut, prefix if cut else join(rest), "".join(text), groups, *_sum(pairs, times), join(rest) if cut else none)


def whole(part: Fragment, tables: Tables) -> Fragment:
    """The fragment of a whole text: its prefix is a group too, as the text begins there; there is no suffix."""
    text, pairs, times = _closed(part.prefix, part.prefix[1][-1:], tables)
    return Fragment(True, (_empty(),) * 4, text + part.text, part.groups + 1, *_sum([pairs, part.pairs], [times, part.times]), (_empty(),) * 4)


def _sha(text: str) -> str:
    return hashlib.sha256(text[:-1].encode()).hexdigest()


_LISTS = ("pa", "pae", "pb", "pbe", "sa", "sae", "sb", "sbe", "pairs", "times")
#: A row is a finished text (ranges = 1) or one of the fragments of a long one.
_ROW = ("key long, doc_id {kind}, n_a long, n_b long, ranges int, no int, n_groups long, groups_sha256 string, cut boolean, body string, "
        + ", ".join(f"{c} array<long>" for c in _LISTS))


def _lists(cells: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in cells])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([_empty(), *cells])))


def _rows(key: list[int], doc_id: pa.Array, n_a: list[int], n_b: list[int], ranges: list[int], no: list[int], sha: list[str | None], parts: list[Fragment]) -> pa.RecordBatch:
    cells = [[(*p.prefix, *p.suffix, p.pairs, p.times)[i] for p in parts] for i in range(10)]
    heads = [pa.array(key, pa.int64()), doc_id, pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(ranges, pa.int32()), pa.array(no, pa.int32()),
             pa.array([p.groups for p in parts], pa.int64()), pa.array(sha, pa.string()), pa.array([p.cut for p in parts], pa.bool_()),
             pa.array(["" if s is not None else p.text for s, p in zip(sha, parts)], pa.string())]
    return pa.RecordBatch.from_arrays([*heads, *map(_lists, cells)], names=["key", "doc_id", "n_a", "n_b", "ranges", "no", "n_groups", "groups_sha256", "cut", "body", *_LISTS])


def _fragments_of(rows: dict) -> list[Fragment]:
    """Fragments of rows as read from Arrow (lists as numpy arrays)."""
    cells = [rows[c] for c in _LISTS]
    return [Fragment(rows["cut"][i], tuple(c[i] for c in cells[:4]), rows["body"][i], rows["n_groups"][i], cells[8][i], cells[9][i], tuple(c[i] for c in cells[4:8]))
            for i in range(len(rows["cut"]))]


def _read(table: pa.Table) -> dict:
    """Columns as lists, the lists of numbers as numpy arrays."""
    out = {}
    for name in table.column_names:
        column = table[name].combine_chunks()
        if name in _LISTS:
            flat, bounds = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
            out[name] = [flat[x:y] for x, y in zip(bounds[:-1], bounds[1:])]
        else:
            out[name] = column.to_pylist()
    return out


def _many(ids_a: list[list[int]], ids_b: list[list[int]], tables: Tables) -> list[tuple[str, Fragment]]:
    """(digest, counted links) of whole short texts, all at once: their bytes lie one after the other, and each text's end is an end of both."""
    if not ids_a:
        return []
    a, b = (np.array([i for x in ids for i in x], np.int64) for ids in (ids_a, ids_b))
    a_end, b_end = np.cumsum(tables.a_length[a]), np.cumsum(tables.b_length[b])
    cuts, ia, ib, common = _axis(a_end, b_end)
    pieces = _pieces(a, a_end, b, b_end, common, tables.marked)
    tokens = np.concatenate([[0], np.cumsum([len(x) + len(y) for x, y in zip(ids_a, ids_b)])])
    ends = a_end[np.cumsum([len(x) for x in ids_a]) - 1]
    groups = np.diff(np.searchsorted(common, ends, "right"), prepend=0)
    space = len(tables.a_bytes) * tables.size
    pair, times = np.unique(np.searchsorted(ends, cuts) * space + a[ia] * tables.size + b[ib], return_counts=True)
    bounds = np.searchsorted(pair, np.arange(len(ids_a) + 1) * space)
    none = (_empty(),) * 4
    return [(_sha("".join(pieces[tokens[i]: tokens[i + 1]])),
             Fragment(True, none, "", int(groups[i]), pair[bounds[i]: bounds[i + 1]] - i * space, times[bounds[i]: bounds[i + 1]], none)) for i in range(len(ids_a))]


_tables: dict[tuple, Tables] = {}


def _opened(a: Tokenizer, b: Tokenizer, name: str) -> Tables:
    """This Python worker's tables; a worker runs many tasks of a stage."""
    if name not in _tables:
        _tables.clear()
        _tables[name] = Tables(a, b)
    return _tables[name]


def _tokenised(docs: DataFrame, a: Tokenizer, b: Tokenizer, name: str, size: int, id_col: str, text_col: str) -> DataFrame:
    """Every text as a finished row, or, if it has more than ``size`` bytes, as fragments of its byte ranges."""
    kind = docs.schema[id_col].dataType.simpleString()
    none = Fragment(True, (_empty(),) * 4, "", 0, _empty(), _empty(), (_empty(),) * 4)

    def block(first: int, ids: pa.Array, column: pa.Array, tables: Tables) -> Iterator[pa.RecordBatch]:
        texts = [t or "" for t in column.to_pylist()]
        ids_a, ids_b = tables.encode_a(texts), tables.encode_b(texts)
        data = [b" " + t.encode() for t in texts]
        fits = [bool(t) and b"".join([tables.a_bytes[i] for i in x]) == d and b"".join([tables.b_bytes[i] for i in y]) == d
                for t, d, x, y in zip(texts, data, ids_a, ids_b)]
        short = [i for i, ok in enumerate(fits) if ok and len(data[i]) <= size]
        done = dict(zip(short, _many([ids_a[i] for i in short], [ids_b[i] for i in short], tables)))
        rows = [(i, ("", none), 0, 0) if not fits[i] else (i, done[i], len(ids_a[i]), len(ids_b[i])) for i in range(len(texts)) if not fits[i] or i in done]
        if rows:
            at, cells, n_a, n_b = zip(*rows)
            ones = [1] * len(rows)
            yield _rows([first + i for i in at], ids.take(pa.array(at)), n_a, n_b, ones, [0] * len(rows), [c[0] for c in cells], [c[1] for c in cells])
        for i in range(len(texts)):
            if not fits[i] or i in done:
                continue
            x, y = np.array(ids_a[i], np.int64), np.array(ids_b[i], np.int64)
            x_end, y_end = np.cumsum(tables.a_length[x]), np.cumsum(tables.b_length[y])
            ranges = -(-len(data[i]) // size)
            edges = np.arange(ranges + 1) * size
            xs, ys = np.searchsorted(x_end, edges, "right"), np.searchsorted(y_end, edges, "right")
            for no in range(ranges):  # a row each: what is open stays small
                p, q = slice(xs[no], xs[no + 1]), slice(ys[no], ys[no + 1])
                part = fragment(x[p], x_end[p], y[q], y_end[q], tables)
                yield _rows([first + i], ids.slice(i, 1), [len(x[p])], [len(y[q])], [ranges], [no], [None], [part])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tables = _opened(a, b, name)
        key = TaskContext.get().partitionId() << 40  # unique in the table that is written, which is all that is used of it
        for batch in batches:
            for start, end, _, _ in T.blocks(batch.column(1)):
                yield from block(key, batch.column(0).slice(start, end - start), batch.column(1).slice(start, end - start), tables)
                key += end - start

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(rows, _ROW.format(kind=kind))


def _reduced(long: DataFrame, a: Tokenizer, b: Tokenizer, name: str, fan: int) -> DataFrame:
    """The finished rows of long texts: their fragments composed ``fan`` at a time, as a tree over tasks."""
    def step(table: pa.Table) -> pa.Table:
        table = table.drop_columns(["up"]).sort_by("no")
        cells = _read(table)
        tables = _opened(a, b, name)
        part = compose(_fragments_of(cells), tables)
        ranges = -(-cells["ranges"][0] // fan)
        sha = None
        if ranges == 1:
            part = whole(part, tables)
            sha = _sha(part.text)
        return pa.Table.from_batches([_rows(cells["key"][:1], table["doc_id"].combine_chunks().slice(0, 1), [sum(cells["n_a"])], [sum(cells["n_b"])], [ranges],
                                            [cells["no"][0] // fan], [sha], [part])])

    schema = long.schema
    most = long.agg(F.max("ranges")).first()[0] or 1
    while most > 1:
        # texts that are done already have one range and are left alone
        open_rows = long.where("ranges > 1").withColumn("up", F.expr(f"no div {fan}"))
        long = written(open_rows.groupBy("key", "up").applyInArrow(step, schema).unionByName(long.where("ranges = 1")), "composed")
        most = -(-most // fan)
    return long


def _pair_counts(rows: DataFrame, size: int) -> DataFrame:
    """(pair, docs, best): how many texts hold each linked pair, and whether no other pair of its A id is held by more."""
    counts = written(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")), "pairs")
    a = F.expr(f"pair div {size}")
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))
    return written(counts.join(most, a == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "counts")


def _looked_up(rows: DataFrame, counts: DataFrame, entries: int) -> DataFrame:
    """(key, n_best, count_sum): the counts of each text's links, summed.

    Links are packed by hash part of the pair, so that a text has one partial sum a part. The number of parts follows from the number of distinct pairs, which the vocabularies
    bound, not from the corpus. A part with more than ``entries`` links is split among tasks, each of which gets the part's counts.
    """
    parts = max(PARTS, -(-counts.count() // PAIRS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(x, PACKED) for whole in batches for x in range(0, whole.num_rows, PACKED)):
            many = batch.column(1).value_lengths().to_numpy()
            pair, times = batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), many)
            part = (T.mix(pair.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((row, part))
            keys, pair, times, part = batch.column(0).to_numpy()[row[order]], pair[order], times[order], part[order]
            cuts = np.concatenate([np.flatnonzero(np.diff(part, prepend=-1)), [len(part)]])
            spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
            blobs = [pa.array([x[p:q].tobytes() for p, q in spans], pa.binary()) for x in (keys, pair, times.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]].astype(np.int32)), *blobs], names=["part", "keys", "pairs", "times"])

    def part_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = (T.mix(batch.column(0).to_numpy().view(np.uint64)) % np.uint64(parts)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), *batch.columns], names=["part", "pair", "docs", "best"])

    known = counts.mapInArrow(part_of, "part int, pair long, docs long, best boolean")
    held = known.groupBy("part").agg(F.ceil(F.sum("docs") / entries).cast("int").alias("tasks"))
    links = rows.where(F.size("pairs") > 0).select("key", "pairs", "times").mapInArrow(pack, "part int, keys binary, pairs binary, times binary")
    # a row's own content chooses its task, so that repeated tasks agree
    links = links.join(held, "part").withColumn("task", F.pmod(F.xxhash64("keys"), F.col("tasks")).cast("int")).drop("tasks")
    known = known.join(held, "part").select("part", "pair", "docs", "best", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"))

    def look_up(_: tuple, links: pa.Table, known: pa.Table) -> pa.Table:
        keys, pair, times = (np.concatenate([np.frombuffer(x, kind) for x in links[c].to_pylist()] or [np.zeros(0, kind)])
                             for c, kind in (("keys", np.int64), ("pairs", np.int64), ("times", np.int32)))
        order = np.argsort(known["pair"].to_numpy())
        at = order[np.searchsorted(known["pair"].to_numpy(), pair, sorter=order)] if len(pair) else np.zeros(0, np.int64)
        key, row = np.unique(keys, return_inverse=True)
        best, count = np.zeros((2, len(key)), np.int64)
        np.add.at(best, row, times * known["best"].to_numpy()[at])
        np.add.at(count, row, times * known["docs"].to_numpy()[at])
        return pa.table({"key": key, "n_best": best, "count_sum": count})

    sums = links.groupBy("part", "task").cogroup(known.groupBy("part", "task")).applyInArrow(look_up, "key long, n_best long, count_sum long")
    return sums.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(docs: DataFrame, a: Tokenizer, b: Tokenizer, size: int = RANGE, fan: int = FAN, entries: int = ENTRIES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for every row of ``docs``.

    ``a`` and ``b`` encode a blank and the text. Numbers of tokens of both, groups between common ends, links (overlaps of tokens), links whose pair of ids is held by as
    many texts as any pair of its A id, and the sum over links of how many texts hold their pair. ``groups_sha256`` digests ``a1,a2|b1;a3|b2,b3``: ids by group.

    Texts that are null or empty, or whose tokens of either side do not join to a blank and the text, have no tokens: zeros and ''. Every row counts as a text, also repeated ones
    and those without an id. Only the two named columns are read, so further columns, whatever their names, do no harm. An empty table gives none.
    ``size`` and ``fan`` change the work, not the result. A text is tokenised whole, in the task that reads it.
    """
    name = hashlib.sha256(b"\0".join([*a.token_bytes, b"\1", *b.token_bytes])).hexdigest()
    rows = written(_tokenised(docs, a, b, name, size, id_col, text_col), "fragments")
    kept = ("key", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times")
    long = _reduced(rows.where("ranges > 1"), a, b, name, fan)
    rows = rows.where("ranges = 1").select(*kept).unionByName(long.select(*kept))
    sums = _looked_up(rows, _pair_counts(rows, len(b.token_bytes)), entries).withColumnRenamed("key", "__key")
    n_links = F.aggregate("times", F.lit(0).cast("long"), lambda x, y: x + y)
    out = rows.select("key", "doc_id", "n_a", "n_b", "n_groups", n_links.alias("n_links"), "groups_sha256").join(sums, F.col("key") == F.col("__key"), "left")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
                      F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256")
