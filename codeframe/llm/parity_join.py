"""N-gram Jaccard join by parity sketches: every pair of texts whose shingle sets have a Jaccard similarity of at least 0.75.

A set's sketch has ``k`` words of 64 bits. Each shingle falls into one word by the top of its hash and is XORed into it, so a
word changes only if a shingle of one set, but not of the other, falls into it: the number of words that differ (the
sketches' Hamming distance in words) never exceeds the symmetric difference. Sets of sizes a <= b that reach 3/4 differ in at most
``(a + b) // 7`` shingles, and b <= 4a/3. Sizes form bands of ratio 4/3; the sketch of band i has more words than the largest such
difference, so a linked pair whose smaller set is in band i shares at least ``k - (a + b) // 7`` words of it. Each set
therefore enters the sketch of its own band and, as a possible larger partner, that of the band below; equal words are
joined, pairs that share too few are dropped, and the rest are verified on the whole sets.

Nothing is capped. What words alone cannot promise has an exact way beside them:
* sets of fewer than 48 shingles (and, to meet them, those of up to 63) enter every shingle as a word of its own;
* sets with so many empty words that the count above proves nothing also enter their ``n // 4 + 1`` smallest shingles as
  one-shingle words (a prefix of a common order, which any linked pair shares);
* a word held by more than ``linking.GROUP`` sets is not listed in pairs. Sets with few such words show their links in
  their other words, by the same count; the rest (as a rule groups of near copies) are settled by ``linking.settle``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codeframe.llm import text as T
from codeframe.llm.linking import FOUND, GROUP, SETS, found_pairs, held_by_many, pack, settle, with_sketches
from codeframe.llm.tables import dropped, pieces, written

#: Sets with fewer shingles use single shingles as words.
SMALL = 48
#: Sketch words that one task of the join holds.
WORDS_PER_TASK = 600_000


def band_edges(largest: int = 1 << 40) -> np.ndarray:
    """The least set size of each band: 48, 64, 86, ... each 4/3 of the one before, rounded up."""
    edges = [SMALL]
    while edges[-1] < largest:
        edges.append(-(-4 * edges[-1] // 3))
    return np.array(edges, np.int64)


EDGES = band_edges()
#: Largest symmetric difference of a linked pair whose smaller set is in the band, and the words of the band's sketch.
_MOST = (EDGES[1:] - 1) // 3
WORDS = _MOST + 1 + 4 + _MOST // 8


def band(n: np.ndarray) -> np.ndarray:
    """The band of set sizes; -1 for small ones."""
    return np.searchsorted(EDGES, n, "right") - 1


def sketch(values: np.ndarray, bounds: np.ndarray, bands: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key of a non-empty word, number of non-empty words by row) for the rows whose band is not negative."""
    rows = np.repeat(np.arange(len(bands)), np.diff(bounds))
    used = bands[rows] >= 0
    rows, values = rows[used], values[used]
    if not len(rows):
        return rows, np.zeros(0, np.uint64), np.zeros(len(bands), np.int64)
    k = WORDS[np.maximum(bands, 0)][rows].astype(np.uint64)
    at = ((values >> np.uint64(32)) * k) >> np.uint64(32)  # grows with the value, so that sorted values come word by word
    head = np.ones(len(rows), bool)
    head[1:] = (rows[1:] != rows[:-1]) | (at[1:] != at[:-1])
    heads = np.flatnonzero(head)
    word = np.bitwise_xor.reduceat(T.mix(values), heads)
    place = T.mix((bands[rows[heads]].astype(np.uint64) << np.uint64(40)) | at[heads])
    return rows[heads], T.mix(word ^ place), np.bincount(rows[heads], minlength=len(bands))


def prefix_keys(values: np.ndarray, bounds: np.ndarray, wanted: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the n // 4 + 1 smallest shingles of the rows wanted."""
    rows = np.flatnonzero(wanted & (np.diff(bounds) > 0))
    take = (bounds[rows + 1] - bounds[rows]) // 4 + 1
    row = np.repeat(rows, take)
    at = bounds[row] + np.arange(len(row)) - np.repeat(np.cumsum(take) - take, take)
    return row, T.mix(values[at] ^ T.mix(salt[row].astype(np.uint64)))


def keys_of(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key) of all sketch words, and for each row the empty words of its own band's sketch and of the one below."""
    n = np.diff(bounds)
    own = band(n)
    out, empty = [], np.zeros((len(n), 2), np.int64)
    for which, bands in ((0, own), (1, own - 1)):
        bands = np.where(own >= 0, bands, -1)
        row, key, full = sketch(values, bounds, bands)
        out.append((row, key))
        used = bands >= 0
        at = np.maximum(bands, 0)
        empty[:, which] = np.where(used, WORDS[at] - full, 0)
        # The most that a linked pair can differ in, seen from this set: as the smaller one, or as the larger one.
        most = n // 3 if which == 0 else np.minimum(_MOST[at], (EDGES[at + 1] - 1 + n) // 7)
        unsure = used & (empty[:, which] >= WORDS[at] - most)
        if unsure.any():
            out.append(prefix_keys(values, bounds, unsure, 1 + bands))
    # A pair across the limit meets here: the larger set has at most 4/3 of 47 shingles.
    rows = np.repeat(np.arange(len(n)), n)
    small = n[rows] < -(-4 * SMALL // 3)
    out.append((rows[small], T.mix(values[small] ^ T.mix(np.array([1 << 20], np.uint64)))))
    return np.concatenate([r for r, _ in out]), np.concatenate([k for _, k in out]), empty


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, cls): size of each row's shingle set and a 64-bit id of it; 0 for an empty set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, values, bounds in T.shingle_sets(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(bounds)),
                                                  pa.array(T.set_ids(values, bounds))], names=["id", "n", "cls"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(rows, f"id {kind}, n long, cls long")


def _entries(docs: DataFrame, parts: int, text_col: str) -> DataFrame:
    """Sketch words of all sets, packed by target partition. Equal sets of a block enter once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, values, bounds in T.shingle_sets(batch.column(0)):
                cls, n = T.set_ids(values, bounds), np.diff(bounds)
                _, first = np.unique(cls, return_index=True)
                once = np.zeros(len(cls), bool)
                once[first] = True
                once &= n > 0
                values, cls, n = values[np.repeat(once, n)], cls[once], n[once]
                row, key, empty = keys_of(values, np.concatenate([[0], np.cumsum(n)]))
                if len(row):
                    yield pack(row, key, cls, n, empty, parts)

    return docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(rows, "part int, runs binary, keys binary")


def _pair_empties(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Empty words that two sets may share in the sketch of the smaller one's band."""
    low = np.minimum(band(a["n"]), band(b["n"]))
    return np.minimum(*(np.where(band(x["n"]) == low, x["own"], x["low"]) for x in (a, b)))


def _spare(runs: np.ndarray) -> np.ndarray:
    """How many of a set's words may be much-held (or cancel each other) while any linked pair still shares another one."""
    n = runs["n"].astype(np.int64)
    own = np.maximum(band(n), 0)
    low = np.maximum(own - 1, 0)
    as_smaller = WORDS[own] - n // 3 - runs["own"]
    as_larger = np.where(own > 0, WORDS[low] - np.minimum(_MOST[low], (EDGES[own] - 1 + n) // 7) - runs["low"], as_smaller)
    in_small = -(-3 * n // 4)  # a linked set shares that many shingles at least
    return np.where(n < SMALL, in_small, np.where(n < -(-4 * SMALL // 3), np.minimum(in_small, as_smaller), np.minimum(as_smaller, as_larger)))


def shared_words(docs: DataFrame, parts: int, text_col: str = "text", group: int = GROUP) -> DataFrame:
    """Pairs of sets that share sketch words, and the holders of words that many share (``linking.FOUND``)."""
    packed = _entries(docs, parts, text_col)
    return packed.groupBy("part").applyInArrow(lambda t: found_pairs(t, group, _pair_empties, _spare), FOUND)


def allowance(n: str) -> F.Column:
    """Words of the sketch of the band in which a set size lies, as an expression; 0 for small sets."""
    out = F.lit(0)
    for edge, k in zip(EDGES.tolist(), WORDS.tolist()):
        if edge > 1 << 24:  # beyond, bands only repeat the rule; their pairs skip this cheap test and are verified all the same
            out = F.when(F.col(n) >= edge, 0).otherwise(out)
            break
        out = F.when(F.col(n) >= edge, k).otherwise(out)
    return out


def with_sets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__n`` and ``__cls``: the size and id of each row's shingle set."""
    names = docs.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "__n long", "__cls long"])
    at = len(names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, values, bounds in T.shingle_sets(batch.column(at)):
                kept = [batch.column(i).slice(a, b - a) for i in range(at)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(bounds)), pa.array(T.set_ids(values, bounds))], names=[*names, "__n", "__cls"])

    return docs.select("*", F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(rows, schema)


def _sets_without_id(asked: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cls, set, sketch) of sets that only rows without an id have; one text of each is read."""
    texts = with_sets(docs.where(F.col(id_col).isNull()).select(F.col(text_col).cast("string").alias("t")), "t")
    texts = texts.join(asked.select(F.col("cls").alias("__cls")), "__cls", "left_semi").groupBy("__cls").agg(F.first("t").alias("t"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, values, bounds in T.shingle_sets(batch.column(0)):
                yield with_sketches(pa.array(T.set_ids(values, bounds)), values, bounds)

    return texts.select("t").mapInArrow(rows, SETS)


def sets_of(asked: DataFrame, docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(cls, set, sketch): the whole sets asked for, read again from the texts of ``members`` (cls, id), one for each id, or from a text of a row without an id."""
    nameless = written(asked.join(members.where("id IS NULL"), "cls", "left_semi"), "nameless")
    if not nameless.isEmpty():
        named = sets_of(asked.join(nameless, "cls", "left_anti"), docs, members.where("id IS NOT NULL"), id_col, text_col)
        return named.unionByName(_sets_without_id(nameless, docs, id_col, text_col))
    wanted = asked.join(members, "cls").select(F.col("id").alias("__id"), "cls")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, values, bounds in T.shingle_sets(batch.column(1)):
                right = T.set_ids(values, bounds) == batch.column(0).slice(a, b - a).to_numpy()  # an id may stand on several texts
                yield with_sketches(batch.column(0).slice(a, b - a), values, bounds).filter(pa.array(right))

    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).cast("string").alias("t"))
    texts = texts.join(wanted, F.col("__doc") == F.col("__id")).select("cls", "t")
    return texts.mapInArrow(rows, SETS)


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``: its set's size and the smallest id reachable by links.

    Texts are lower-cased in A-Z; words are runs of other bytes than blank and 0x09-0x0D; a set holds all distinct runs
    of five words of the whole text (a shorter text: its whole sequence). Null and empty texts have size 0 and link with nothing.
    Repeated rows and equal texts are one set; every row comes back. Rows without an id link as all others do; a component in which no row
    has an id has none to name, so its rows get null. An id that occurs with several texts gets a row for each. Only the two named columns are read, so
    further columns, whatever their names, do no harm. An empty table gives an empty result.
    """
    return _groups(docs, id_col, text_col, group).select("id", "n_shingles", "component_id")


def _groups(docs: DataFrame, id_col: str, text_col: str, group: int) -> DataFrame:
    """``similar_groups`` with each row's set (cls) and the id of its component's sets (component); null for empty sets."""
    spark = docs.sparkSession
    sized = written(classes(docs, id_col, text_col), "sets")
    members = sized.where("n > 0").groupBy("cls").agg(F.min("id").alias("id"))
    total = sized.agg(F.sum("n")).first()[0] or 0
    found = written(shared_words(docs, pieces(spark, 0.75 * total, WORDS_PER_TASK), text_col, group), "words")
    hot = held_by_many(found)
    holds = hot.groupBy("cls").agg(F.count(F.lit(1)).alias("hot"), F.min("spare").alias("least"))
    # the others' links show in words that few share
    unsure = hot.drop("spare").join(holds.where(F.col("hot") >= F.col("least")).select("cls"), "cls", "left_semi")
    pairs = found.where("kind = 0").groupBy("a", "b").agg(*(F.max(c).alias(c) for c in ("na", "nb", "empty")), F.sum("shared").alias("shared"))
    pairs = pairs.withColumn("least", F.least("na", "nb"))
    # shared words, and those that may be hidden among empty and much-held ones, must reach k - (a + b) // 7
    need = F.when(F.col("least") < SMALL, F.ceil(3 * (F.col("na") + F.col("nb")) / 7)).otherwise(
        allowance("least") - F.floor((F.col("na") + F.col("nb")) / 7) - F.col("empty"))
    short = need - F.col("shared")
    likely = (pairs.withColumn("short", short).join(holds.select(F.col("cls").alias("a"), F.col("hot").alias("ha")), "a", "left")
              .join(holds.select(F.col("cls").alias("b"), F.col("hot").alias("hb")), "b", "left")
              .where(F.col("short") <= F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0)))).select("a", "b"))
    parts = settle(likely, unsure, lambda asked: sets_of(asked, docs, members, id_col, text_col))
    dropped(found)
    smallest = (members.join(parts.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "id", F.coalesce("component", "cls").alias("component")))
    names = smallest.groupBy("component").agg(F.min("id").alias("component_id"))
    by_set = smallest.join(names, "component").select(F.col("cls").alias("__cls"), "component_id", "component")
    return sized.join(by_set, F.col("cls") == F.col("__cls"), "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "cls", "component")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """The rows of ``docs`` with exactly one of each component of ``similar_groups``: that of the smallest id, rows without an id last.

    Of rows with one id the one with the smallest set id, then text hash, counts as first; of rows equal in all of that, any one stays. Rows without words all stay, whatever
    their ids. Where ids are unique and not null the decision is by id alone; only other rows have their sets looked at again. Columns named
    ``__id``, ``__n``, ``__cls``, ``__set``, ``__rank`` or ``__text`` are the function's own and must not be in ``docs``. An empty table gives none.
    """
    groups = written(_groups(docs, id_col, text_col, group), "groups")
    odd = written(groups.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1 OR id IS NULL").select(F.col("id").alias("__id")), "odd-ids")
    same = F.col(id_col).eqNullSafe(F.col("__id"))
    gone = groups.where("n_shingles > 0 AND NOT id <=> component_id").select(F.col("id").alias("__id"))
    if odd.isEmpty():
        return docs.join(gone, F.col(id_col) == F.col("__id"), "left_anti")
    plain = docs.join(odd, same, "left_anti").join(gone, F.col(id_col) == F.col("__id"), "left_anti")
    rows = with_sets(docs.join(odd, same, "left_semi"), text_col)
    # components whose smallest id is one of a single row have their keeper already
    parts = groups.where("n_shingles > 0").select(F.col("cls").alias("__set"), "component", "component_id").distinct()
    parts = parts.join(odd, F.col("component_id").eqNullSafe(F.col("__id")), "left_semi")
    order = Window.partitionBy("component").orderBy(F.col(f"`{id_col}`").asc_nulls_last(), "__cls", F.xxhash64(f"`{text_col}`"))
    first = rows.join(parts, F.col("__cls") == F.col("__set")).withColumn("__rank", F.row_number().over(order)).where("__rank = 1")
    kept = first.unionByName(rows.where("__n = 0"), allowMissingColumns=True)
    return plain.unionByName(kept.select(*[F.col(f"`{c}`") for c in docs.columns]))

