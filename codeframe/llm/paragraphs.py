"""Substring dedup by paragraphs: MinHash bands, exact Jaccard, components.

A paragraph is a line of a text. Its set holds all distinct runs of five lower-cased words. Equal sets are one class; classes
that agree in a whole band of MinHash values are compared on their whole sets, and those with a Jaccard similarity of 3/4 or more
are linked. Of each component of links the first paragraph (smallest document id, then line) stays, the others go.

Passages are runs of 50 words that stand elsewhere too, wherever they lie in the text: inside long lines, over short ones, in texts without
line breaks. They are found exactly, by the hashes of runs of 50 words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from codeframe.llm import text as T
from codeframe.llm.linking import FOUND, GROUP, SETS, found_pairs, held_by_many, pack, settle, with_sketches
from codeframe.llm.tables import dropped, pieces, written

#: Shorter paragraphs are no passages: boilerplate lines, headings.
MIN_WORDS = 20
RECALL = 0.995
#: Words of a passage; a run of ANCHOR words inside it is looked for first.
PASSAGE = 50
ANCHOR = 16
KEYS_PER_TASK = 600_000
#: Runs that a key must have before it counts as much held.
LEAST_HOT = 1000


def tune_bands(threshold: float = 0.75, recall: float = RECALL, most_hashes: int = 64) -> tuple[int, int]:
    """(bands, rows): the longest bands whose number reaches the recall at the threshold within the number of hashes.

    A pair of similarity s agrees in one of b bands of r values with probability 1 - (1 - s**r)**b. Long bands keep unlike
    pairs apart, so the longest that still reach the recall are taken.
    """
    best = None
    for rows in range(1, most_hashes + 1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold ** rows)))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches this recall with so few hashes")
    return best


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets of all lines (a last entry for the end), and the first line of each text."""
    marks = [offsets[:-1], np.flatnonzero(data == 10) + 1]
    starts = np.concatenate(marks)
    # a text's own start comes before a line that begins at the same byte: only an empty text or line shares it
    order = np.lexsort((np.repeat([0, 1], [len(marks[0]), len(marks[1])]), starts))
    row = np.concatenate([np.arange(len(offsets) - 1), np.maximum(np.searchsorted(offsets, np.maximum(marks[1] - 1, 0), "right") - 1, 0)])[order]
    starts = starts[order]
    order = np.argsort(row, kind="stable")
    row, starts = row[order], starts[order]
    return np.append(starts, len(data)), np.searchsorted(row, np.arange(len(offsets)))


def _sets(column: pa.Array, min_words: int) -> Iterator[tuple]:
    """Block by block: (first row, of each long paragraph: row, line, start, end, words; distinct shingles and their bounds)."""
    for a, _, data, offsets in T.blocks(column):
        lines, first_line = _lines(data, offsets)
        starts, ends, _ = T.words(T.LOWER[data], offsets)
        first = np.searchsorted(starts, lines)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first_line))
        line = np.arange(len(row)) - first_line[row]
        many = np.diff(first)
        long = many >= min_words
        values, bounds = T.shingles(T.word_hashes(T.LOWER[data], starts), first)
        kept = np.repeat(long, np.diff(bounds))
        values, bounds = T.distinct_sorted(values[kept], np.concatenate([[0], np.cumsum(np.diff(bounds)[long])]))
        begin, end = starts[first[:-1][long]], ends[first[1:][long] - 1]
        yield a, row[long], line[long], begin - offsets[row[long]], end - offsets[row[long]], many[long], values, bounds


def paragraphs(docs: DataFrame, min_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, start, end, words, n, cls): each long paragraph with its place in bytes, and its set's size and id."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, row, line, start, end, words, values, bounds in _sets(batch.column(1), min_words):
                ids = batch.column(0).take(pa.array(row + a))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(x) for x in (line, start, end, words, np.diff(bounds), T.set_ids(values, bounds)))],
                                                 names=["doc_id", "line", "start", "end", "words", "n", "cls"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
            .mapInArrow(rows, f"doc_id {kind}, line long, start long, end long, words long, n long, cls long"))


def band_keys(values: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key for each band (column) of each set (row); no set may be empty."""
    out = np.empty((len(bounds) - 1, bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            key = np.full(len(bounds) - 1, b + 1, np.uint64)
            for r in range(rows):
                odd, add = T.mix(np.array([2 * (b * rows + r), 2 * (b * rows + r) + 1], np.uint64))
                key = T.mix(key ^ np.minimum.reduceat(values * (odd | np.uint64(1)) + add, bounds[:-1]))
            out[:, b] = key
    return out


def _banded(docs: DataFrame, parts: int, bands: int, rows: int, min_words: int, text_col: str) -> DataFrame:
    def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, values, bounds in _sets(batch.column(0), min_words):
                cls, n = T.set_ids(values, bounds), np.diff(bounds)
                if not len(cls):
                    continue
                keys = band_keys(values, bounds, bands, rows)
                _, once = np.unique(cls, return_index=True)
                row = np.repeat(once, bands)
                yield pack(row, keys[once].ravel(), cls, n, np.zeros((len(cls), 2), np.int64), parts)

    return docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(pack_rows, "part int, runs binary, keys binary")


def _sets_of(asked: DataFrame, docs: DataFrame, members: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """(cls, set, sketch): the whole sets of the classes asked for, read again from the documents of ``members`` (cls, doc_id).

    Only those documents are read again, once each; a document's list of classes is no longer than the document.
    """
    asked = asked.join(members, "cls")
    asked = asked.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list("cls").alias("wanted"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0).to_pylist()
            for a, row, _, _, _, _, values, bounds in _sets(batch.column(1), min_words):
                cls = T.set_ids(values, bounds)
                keep = np.array([c in w for c, w in zip(cls.tolist(), ({*wanted[a + r]} for r in row.tolist()))], bool)
                yield with_sketches(pa.array(cls), values, bounds).filter(pa.array(keep))

    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).cast("string").alias("t"))
    texts = texts.join(asked, F.col("__doc") == F.col("__id")).select("wanted", "t")
    return texts.mapInArrow(rows, SETS).dropDuplicates(["cls"])


def repeated_paragraphs(docs: DataFrame, min_words: int = MIN_WORDS, recall: float = RECALL, group: int = GROUP,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each paragraph of at least ``min_words`` words that occurs again, equal or nearly so: (doc_id, line, start, end, words,
    first_doc_id, first_line, removed).

    ``start`` and ``end`` are bytes of the text in UTF-8; (first_doc_id, first_line) names the paragraph of the component
    that stays; ``removed`` is true for all others. Null and empty texts have no paragraphs. Rows without an id take no
    part. Rows with the same id count as one document: of the same line in them both stay. Only the two named columns are
    read. An empty table gives none. Equal sets are found always, similar ones with the given recall at 0.75 and more above.
    """
    spark = docs.sparkSession
    bands, rows = tune_bands(0.75, recall)
    places = written(paragraphs(docs, min_words, id_col, text_col), "paragraphs")
    classes = places.groupBy("cls").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.countDistinct("doc_id", "line").alias("times"))
    classes = written(classes.select("cls", "first.doc_id", "first.line", "times"), "classes")
    parts = pieces(spark, bands * classes.count(), KEYS_PER_TASK)
    blobs = _banded(docs.where(F.col(id_col).isNotNull()), parts, bands, rows, min_words, text_col)
    found = written(blobs.groupBy("part").applyInArrow(lambda t: found_pairs(t, group), FOUND), "bands")
    likely = found.where("kind = 0").select("a", "b").distinct()
    members = classes.select("cls", "doc_id")
    hot = held_by_many(found).drop("spare")
    labels = settle(likely, hot, lambda asked: _sets_of(asked, docs, members, min_words, id_col, text_col))
    dropped(found)
    named = classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    whole = named.groupBy("component").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.sum("times").alias("times")).where("times > 1")
    of = named.join(whole.drop("times").withColumnRenamed("first", "keeper"), "component").select(F.col("cls").alias("__cls"), "keeper")
    out = places.join(of, F.col("cls") == F.col("__cls"))
    same = (F.col("doc_id") == F.col("keeper.doc_id")) & (F.col("line") == F.col("keeper.line"))
    out = written(out.select("doc_id", "line", "start", "end", "words", F.col("keeper.doc_id").alias("first_doc_id"),
                             F.col("keeper.line").alias("first_line"), (~same).alias("removed")), "repeated")
    dropped(places, classes, labels)
    return out


def without_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the paragraphs that ``repeated_paragraphs`` removes, and a column ``__cut`` that says where lines went."""
    gone = repeated_paragraphs(docs, min_words).where("removed").groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set(F.col("line").cast("int")).alias("__gone"))
    lines = F.split(F.col("text"), "\n")
    text = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("__gone", i)), "\n")
    out = docs.join(gone, F.col("doc_id") == F.col("__id"), "left").withColumn("__cut", F.col("__gone").isNotNull())
    return out.withColumn("text", F.when(F.col("__cut"), text).otherwise(F.col("text"))).drop("__id", "__gone")


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` without the byte spans (doc_id, tid, start, end) of their texts, and the blanks that follow them; ``__cut`` is true where something went.

    A row's spans have its id and the xxhash64 of its text, and do not overlap. All other rows stay as they are.
    """
    gone = spans.groupBy(F.col("doc_id").alias("__id"), F.col("tid").alias("__tid")).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("__gone"))
    raw = F.col("text").cast("binary")
    # what stays lies before the first span, between neighbours, and behind the last
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("__gone", lambda x: x["end"]))
    ends = F.concat(F.transform("__gone", lambda x: x["start"]), F.array(F.octet_length("text").cast("bigint")))
    piece = lambda x: F.substring(raw, (x["a"] + 1).cast("int"), (x["b"] - x["a"]).cast("int")).cast("string")
    pieces = F.transform(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda x: F.when(x["a"] == 0, piece(x)).otherwise(F.regexp_replace(piece(x), r"^[\x20\x09-\x0D]+", "")))
    out = docs.join(gone, (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__tid")), "left")
    fresh = F.col("__gone").isNotNull()
    out = out.withColumn("__cut", fresh | F.col("__cut")) if "__cut" in docs.columns else out.withColumn("__cut", fresh)
    return out.withColumn("text", F.when(fresh, F.array_join(pieces, "")).otherwise(F.col("text"))).drop("__id", "__tid", "__gone")


def without_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without repeated paragraphs, then without the passages that still repeat; documents of which no word is left go. ``n_chars`` is counted anew.

    First the lines that ``repeated_paragraphs`` removes are cut, then, wherever they lie in what is left, the stretches that ``repeated_passages`` finds, with the blanks
    behind them: every run of 50 words in them stood before, by document id. Rows without an id, and null and empty texts, stay as they are; rows equal in id and
    text are cut alike. Columns named ``__cut``, ``__id``, ``__tid`` or ``__gone`` are the function's own and must not be in ``docs``. An empty table gives none.
    """
    left = written(without_lines(docs, min_words), "lines-cut")
    words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    out = without_spans(left, _passages(left)).where(~F.col("__cut") | words)
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("__cut"), count).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def _windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each run of PASSAGE words of a block: text, first word in the text, anchor and its place; with the texts' words (starts, ends, first, hashes).

    The anchor is the smallest hash of the runs of ANCHOR words inside, so equal runs of PASSAGE words have equal anchors.
    """
    starts, ends, first = T.words(T.LOWER[data], offsets)
    hashes = T.word_hashes(T.LOWER[data], starts)
    many = np.maximum(np.diff(first) - PASSAGE + 1, 0)
    row = np.repeat(np.arange(len(many)), many)
    pos = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    if not len(row):
        return row, pos, np.zeros(0, np.uint64), pos, starts, ends, first, hashes
    at = first[row] + pos
    short = T.shingles(hashes, np.array([0, len(hashes)]), ANCHOR)[0]
    inside = np.lib.stride_tricks.sliding_window_view(short, PASSAGE - ANCHOR + 1)
    place = np.concatenate([at[x: x + (1 << 15)] + inside[at[x: x + (1 << 15)]].argmin(1) for x in range(0, len(at), 1 << 15)])
    return row, pos, short[place], place, starts, ends, first, hashes


def _anchors(texts: DataFrame, kind: str) -> DataFrame:
    """(doc_id, tid, key): the anchors of each text, one for each place."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, data, offsets in T.blocks(batch.column(2)):
                row, _, anchor, place, *_ = _windows(data, offsets)
                _, one = np.unique(place, return_index=True)
                at = pa.array(row[one] + a)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(anchor[one].view(np.int64))], names=["doc_id", "tid", "key"])

    return texts.mapInArrow(rows, f"doc_id {kind}, tid long, key long")


def _grams(texts: DataFrame, kind: str) -> DataFrame:
    """(doc_id, tid, pos, line, start, end, n, digest, inside): the runs of PASSAGE words of each text whose anchor is in ``wanted``, those
    of one anchor place as one row.

    ``inside`` holds the n runs' keys, lines, starts and ends in order, ``digest`` is a hash of all their keys; ``start`` is the first one's, ``end`` the last one's.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(3)
            for a, b, data, offsets in T.blocks(batch.column(2)):
                row, pos, anchor, place, starts, ends, first, hashes = _windows(data, offsets)
                # whether an anchor stands twice does not depend on the text that asks
                keep = np.isin(anchor.view(np.int64), wanted.slice(a, b - a).flatten().to_numpy())
                row, pos, place = row[keep], pos[keep], place[keep]
                if not len(row):
                    continue
                at = first[row] + pos
                key = T.shingles(hashes, np.array([0, len(hashes)]), PASSAGE)[0][at]
                breaks = np.concatenate([[0], np.cumsum(data == 10)])
                line, start, end = breaks[starts[at]] - breaks[offsets[row]], starts[at] - offsets[row], ends[at + PASSAGE - 1] - offsets[row]
                heads = np.flatnonzero(np.diff(place, prepend=-1))
                bounds = np.append(heads, len(row))
                n = np.diff(bounds)
                nth = (np.arange(len(row)) - np.repeat(heads, n)).astype(np.uint64)
                with np.errstate(over="ignore"):
                    digest = T.mix(np.add.reduceat(T.mix(key) * (T.mix(nth) | np.uint64(1)), heads) + T.mix(n))
                # plain arrays take half the room of an array of structs
                cuts = pa.array(bounds.astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (key.view(np.int64), *(x.astype(np.int32) for x in (line, start, end)))]
                where = pa.array(row[heads] + a)
                cells = (pos[heads], line[heads], start[heads], end[bounds[1:] - 1], n, digest.view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(where), batch.column(1).take(where), *(pa.array(x.astype(np.int64)) for x in cells),
                                                  pa.StructArray.from_arrays(lists, names=["key", "line", "start", "end"])],
                                                 names=["doc_id", "tid", "pos", "line", "start", "end", "n", "digest", "inside"])

    return texts.mapInArrow(rows, f"doc_id {kind}, tid long, pos long, line long, start long, end long, n long, digest long, "
                                  "inside struct<key: array<long>, line: array<int>, start: array<int>, end: array<int>>")


def _much_held(groups: DataFrame, hot: list, kind: str) -> DataFrame:
    """Pieces (see ``_passages``) of the runs in ``groups`` whose key is one of ``hot`` (rows key, first): neighbours in a text are one piece.

    ``hot`` holds the keys of more than a set share of all runs, so its length is bounded by that share and it can go to every task.
    """
    hot = sorted(hot, key=lambda r: r["key"])
    keys, tids, poss = (np.array(x, np.int64) for x in ([r["key"] for r in hot], [r["first"]["tid"] for r in hot], [r["first"]["pos"] for r in hot]))
    docs, lines = [r["first"]["doc_id"] for r in hot], np.array([r["first"]["line"] for r in hot], np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(3).field(i) for i in range(4)]
            key, line, start, end = (x.flatten().to_numpy() for x in lists)
            n = np.diff(lists[0].offsets.to_numpy())
            row = np.repeat(np.arange(len(n)), n)
            pos = batch.column(2).to_numpy()[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            which = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            keep = keys[which] == key
            first = pa.array(docs, batch.column(0).type)
            # the first place of all is no repeat
            own = np.flatnonzero(keep & (tids[which] == batch.column(1).to_numpy()[row]) & (poss[which] == pos))
            same = [x == y for x, y in zip(batch.column(0).take(pa.array(row[own])).to_pylist(), first.take(pa.array(which[own])).to_pylist())]
            keep[own[np.array(same, bool)]] = False
            at = np.flatnonzero(keep)
            fresh = np.ones(len(at), bool)
            fresh[1:] = (np.diff(at) > 1) | (np.diff(row[at]) > 0)
            head, last = at[fresh], at[np.append(fresh[1:], True)[: len(at)]]
            of, place = pa.array(row[head]), which[head]
            cells = (pos[head], pos[last], line[head], start[head], end[last])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), *(pa.array(x.astype(np.int64)) for x in cells),
                                              first.take(pa.array(place)), pa.array(lines[place])],
                                             names=["doc_id", "tid", "pos", "last", "line", "start", "end", "first_doc_id", "first_line"])

    return groups.select("doc_id", "tid", "pos", "inside").mapInArrow(
        rows, f"doc_id {kind}, tid long, pos long, last long, line long, start long, end long, first_doc_id {kind}, first_line long")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line, start, end, words, first_doc_id, first_line, removed): the longest stretches of words all of which lie in runs of PASSAGE words
    that stood before, by document id, then place.

    Lines play no part: ``line`` is the one in which a stretch begins, ``start`` and ``end`` are its bytes, and (first_doc_id, first_line)
    is where its first PASSAGE words stand for the first time. ``removed`` is true. Words are compared as those of paragraphs. Rows without an id take no part;
    rows equal in id and text count as one document. All repeats are found: anchors only choose the texts and runs to look at.
    """
    return _passages(docs, id_col, text_col).drop("tid")


def _passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``repeated_passages`` with the hash of the text, ``tid``.

    What stood before is gathered as pieces: neighbouring runs of PASSAGE words from ``pos`` to ``last`` as one row.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    texts = texts.select("doc_id", F.xxhash64("t").alias("tid"), "t")
    anchors = written(_anchors(texts, kind), "anchors")
    twice = anchors.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("key")
    asked = written(anchors.join(twice, "key").groupBy("doc_id", "tid").agg(F.collect_set("key").alias("wanted")), "asked")
    dropped(anchors)
    grams = written(_grams(texts.join(asked, ["doc_id", "tid"]).select("doc_id", "tid", "t", "wanted"), kind), "grams")
    dropped(asked)
    place = F.struct("doc_id", "tid", "pos", "line")
    # of equal rows only the first is looked at run by run: all runs of the others stood before
    firsts = grams.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"), F.min_by("inside", place).alias("inside"))
    firsts = written(firsts.select("digest", "first.*", "times", "inside"), "first-grams")
    # ``lead`` names the equal rows whose first run it is
    runs = firsts.select("doc_id", "tid", F.col("pos").alias("head"), F.when(F.col("times") > 1, F.col("digest")).alias("equal"),
                         F.posexplode(F.arrays_zip(*(F.col(f"inside.{c}").alias(c) for c in ("key", "line", "start", "end")))).alias("i", "x")).select(
        "doc_id", "tid", (F.col("head") + F.col("i")).alias("pos"), *(F.col(f"x.{c}").cast("long").alias(c) for c in ("line", "start", "end", "key")),
        F.when(F.col("i") == 0, F.col("equal")).alias("lead"))
    # keys of more than 1 / (4 x partitions) of all runs: there are fewer than 4 x partitions of them
    share = (firsts.agg(F.sum(F.size("inside.key"))).first()[0] or 0) // pieces(spark, 0, 1) // 4
    much = F.col("times") > max(share, LEAST_HOT)
    keys = written(firsts.select(F.explode("inside.key").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("times")).where(much).select("key"), "hot-keys")
    most = written(runs.join(F.broadcast(keys), "key").groupBy("key").agg(F.min(place).alias("first")), "hot-keys")
    hot = most.collect()
    rest = runs.join(F.broadcast(keys), "key", "left_anti") if hot else runs
    # all others meet the first of their key in one pass; a key has no more than that share of the runs
    order = W.partitionBy("key").orderBy("doc_id", "tid", "pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    met = rest.select("*", *(F.first(c).over(order).alias(f"first_{c}") for c in ("doc_id", "tid", "pos", "line")))
    again = place != F.struct(*(F.col(f"first_{c}").alias(c) for c in ("doc_id", "tid", "pos", "line")))
    met = written(met.withColumn("again", again).where("again OR lead IS NOT NULL").drop("key", "first_tid", "first_pos"), "met")
    piece = ["doc_id", "tid", "pos", "last", "line", "start", "end", "first_doc_id", "first_line"]
    again = met.where("again").withColumn("last", F.col("pos")).select(piece)
    named = ["digest", "own", "first_doc_id", "first_line"]
    heads = met.where("lead IS NOT NULL").select(F.col("lead").alias("digest"), place.alias("own"), "first_doc_id", "first_line")
    if hot:
        again = again.unionByName(_much_held(firsts, hot, kind))
        held = firsts.where("times > 1").select("digest", place.alias("own"), F.col("inside.key")[0].alias("key")).join(F.broadcast(most), "key")
        heads = heads.unionByName(held.select("*", F.col("first.doc_id").alias("first_doc_id"), F.col("first.line").alias("first_line")).select(named))
    copies = grams.drop("inside").join(heads, "digest").where(place != F.col("own"))
    again = written(again.unionByName(copies.withColumn("last", F.col("pos") + F.col("n") - 1).select(piece)), "pieces")
    dropped(grams, firsts, keys, most, met)
    # rows equal in id and text give equal places, which fall into one run
    order = W.partitionBy("doc_id", "tid").orderBy("pos", "last")
    before = F.max("last").over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("pos") > before + PASSAGE, F.lit(True)).cast("long")
    out = again.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order)).groupBy("doc_id", "tid", "run").agg(
        F.min("line").alias("line"), F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max("last") + PASSAGE - F.min("pos")).alias("words"), F.min_by(F.struct("first_doc_id", "first_line"), "pos").alias("first"))
    out = written(out.select("doc_id", "tid", "line", "start", "end", "words", "first.first_doc_id", "first.first_line", F.lit(True).alias("removed")), "passages")
    dropped(again)
    return out
