"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame functions only.

A mix is a row of slots. Slot ``i`` takes the golden-ratio point ``frac(i * 0.618...)`` through the sources' cumulative
weights to a source; the r-th slot of a source takes the r-th block of the source's shuffled words. Blocks hold equally many
words; only the last one of a source is shorter. So every stretch of the mix has the target weights, up to a few blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from codeframe.llm.tables import running_total, written

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_WORDS = 1024
ROWS_PER_BUCKET = 2_000
#: 2**32 divided by the golden ratio, rounded to an odd number, and the same times 2**31 modulo 2**32.
GOLDEN = 2654435769
_GOLDEN_HIGH = (GOLDEN << 31) % (1 << 32)
#: The weight line is cut into so many cells, in which a point's source is looked up.
CELLS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycling_weights(weights: list[int]) -> Column:
    """Weights for sources in the order of their number ``s``, from 0, repeating."""
    out = F.lit(weights[0])
    for i, w in enumerate(weights):
        out = F.when(F.col("s") % len(weights) == i, w).otherwise(out)
    return out.cast("long")


def sized_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """(doc_id, source, size, shuffle, place): what mixing needs of the documents. ``shuffle`` is a text that orders a source's rows at random."""
    shuffle = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size"),
                       shuffle.alias("shuffle")).withColumn("place", F.shiftright(F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("long"), 1))


def targets(sized: DataFrame, weights: list[int], share_pct: int = 150, most: int = 2) -> DataFrame:
    """(source, s, source_size, target, quota): the words each source is to give.

    Sources are numbered by code point, null last. Their weights share ``share_pct`` percent of all sizes; no target goes
    above ``most`` times the source's size: the excess is shared among the others by weight. Taken in the order of
    ``most * size / weight``, the sources that reach their limit come first, so one pass of running sums finds them. The
    table has one row a source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("s", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    per = per.withColumn("w", cycling_weights(weights)).withColumn("cap", F.lit(most) * F.col("source_size"))
    line = W.orderBy(F.col("cap") / F.col("w"), "s")
    whole = W.partitionBy()
    per = per.select("*", F.coalesce(F.sum("cap").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                     F.sum("w").over(line.rowsBetween(0, W.unboundedFollowing)).alias("open"),
                     F.sum("source_size").over(whole).alias("total"))
    full = F.col("cap") * F.col("open") * 100 <= (F.col("total") * share_pct - F.col("before") * 100) * F.col("w")
    per = per.withColumn("full", full)
    left = F.col("total") * (share_pct / 100.0) - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("w"))).over(whole)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(left / open_weight * F.col("w"))
    return per.select("source", "s", "source_size", target.alias("target"), F.floor(target + 0.5).cast("long").alias("quota"))


def schedule(goals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, s, rank): which source fills a slot, with its rank among the source's slots. Each source has exactly the slots its quota needs.

    Points number as many as slots are needed. A source that draws a few slots too many leaves them out; one that
    draws too few gets the rest behind the last point. Ranks come from counts by stretch of slots, not from one task per source.
    """
    spark = goals.sparkSession
    need = goals.where("quota > 0").select("s", F.ceil(F.col("quota") / block).cast("long").alias("need"))
    need = need.withColumn("hi", F.sum("need").over(W.orderBy("s"))).withColumn("lo", F.col("hi") - F.col("need"))
    slots = need.agg(F.sum("need")).first()[0] or 0
    if not slots:
        return spark.createDataFrame([], "slot long, s int, rank long")
    wide = max(1, -(-slots // CELLS))
    cells = need.select("s", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / wide), F.floor((F.col("hi") - 1) / wide))).alias("cell"))
    i = F.col("id")
    low, high = i % (1 << 31), F.floor(i / (1 << 31)) % (1 << 32)
    turn = ((low * GOLDEN) % (1 << 32) + F.when(high > 0, (high * (_GOLDEN_HIGH % (1 << 31))) % (1 << 32)).otherwise(0)) % (1 << 32)
    points = spark.range(slots).select(i.alias("slot"), F.least(F.floor(turn / float(1 << 32) * slots), F.lit(slots - 1)).alias("at"))
    points = points.withColumn("cell", F.floor(F.col("at") / wide))
    drawn = points.join(cells, "cell").where("at >= lo AND at < hi").select("slot", "s", F.lit(1).alias("one"),
                                                                            F.floor(F.col("slot") * (float(1 << 31) / slots)).alias("place"))
    ranked = running_total(drawn, "s", ["slot"], "one", ROWS_PER_BUCKET, "place").select("slot", "s", F.col("before").alias("rank"))
    ranked = ranked.join(need.select("s", "need"), "s").where("rank < need").select("slot", "s", "rank")
    got = drawn.groupBy("s").agg(F.count(F.lit(1)).alias("got"))
    late = (need.join(got, "s", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < need")
            .select("s", "lo", F.explode(F.sequence("got", F.col("need") - 1)).alias("rank"))
            .select((F.lit(slots) + F.col("lo") + F.col("rank")).alias("slot"), "s", "rank"))
    return ranked.unionByName(late)


def mixture(sized: DataFrame, goals: DataFrame, block: int = BLOCK_WORDS, epochs: int = 2) -> tuple[DataFrame, DataFrame]:
    """The mix itself, and the documents with their places in it.

    First table: (slot, s, doc_id, epoch, first_word, words): the stretches of documents that fill the slots, in the mix's
    order. Second: ``sized`` with (s, before), where ``before`` counts the words of the source's earlier documents in its
    shuffled order. The source's words are read again (epoch 1) where its target exceeds its size.
    """
    numbered = sized.join(goals.select(F.col("source").alias("__source"), "s", "source_size", "target", "quota"),
                          F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    placed = written(running_total(numbered, "s", ["place", "shuffle", "doc_id", "size"], "size", ROWS_PER_BUCKET, "place"), "placed")
    start = F.col("before") + F.col("epoch") * F.col("source_size")
    runs = (placed.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn("start", start)
            .where("start < quota").withColumn("end", F.least(F.col("start") + F.col("size"), F.col("quota"))))
    cut = runs.withColumn("rank", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("end") - 1) / block))))
    first = F.greatest(F.col("start"), F.col("rank") * block)
    words = F.least(F.col("end"), (F.col("rank") + 1) * block) - first
    parts = cut.select("s", "rank", "doc_id", "before", "epoch", (first - F.col("start")).alias("first_word"), words.alias("words"))
    # the schedule is a job of its own: fewer stages and broadcasts are held at once
    return written(schedule(goals, block), "schedule").join(parts, ["s", "rank"]), placed


def mix_sources(docs: DataFrame, weights: list[int], share_pct: int = 150, most: int = 2, block: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): how many of each document's words the mix takes, repeats counted.

    ``docs`` needs doc_id, text and source; other columns are not read. Null or empty texts have size 0 and give nothing. Rows
    without a source form a source of their own, the last. Rows without an id, and repeated rows, are rows like any
    other; they tie in the shuffled order by id and size. Sources of size 0 have target 0. An empty table gives none.
    The order depends on ids alone, so that a rerun takes the same words.
    """
    sized = written(sized_documents(docs), "sized")  # words are counted once
    goals = written(targets(sized, weights, share_pct, most), "targets")
    filled, placed = mixture(sized, goals, block, most)
    taken = filled.groupBy("s", "before").agg(F.sum("words").alias("got")).select(F.col("s").alias("__s"), F.col("before").alias("__b"), "got")
    on = (F.col("s") == F.col("__s")) & (F.col("before") == F.col("__b")) & (F.col("size") > 0)
    return placed.join(taken, on, "left").select("doc_id", "source", "size", "source_size", "target", F.coalesce("got", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: list[int], share_pct: int = 150, most: int = 2, block: int = BLOCK_WORDS) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: each as often as epochs take it, the last of a source cut to the words taken.

    Documents without words take no part in a mix of words and are kept once, as they are.
    """
    sized = written(sized_documents(docs), "sized")  # words are counted once
    goals = written(targets(sized, weights, share_pct, most), "targets")
    filled, placed = mixture(sized, goals, block, most)
    got = written(filled.groupBy("s", "before", "epoch").agg(F.sum("words").alias("got")), "taken")
    # rows equal in id, source and size stand side by side in the shuffled order: an epoch takes the first of them whole, at most one more in part
    kind = f"struct<doc_id:{docs.schema['doc_id'].dataType.simpleString()},source:string,size:bigint>"
    key = lambda size: F.struct("doc_id", F.col("source").cast("string"), size).cast(kind)
    whole = F.col("got") == F.col("size")
    taken = got.join(placed.where("size > 0").select("s", "before", "size", key("size").alias("__k")), ["s", "before"]).groupBy("__k", "epoch").agg(
        F.count(F.when(whole, 1)).alias("__whole"), F.coalesce(F.max(F.when(~whole, F.col("got"))), F.lit(0)).alias("__part"))
    size = word_count(F.col("text").cast("string"))
    rows = docs.withColumn("__size", size)
    # one key for the window and the join: texts are moved once
    full = rows.where("__size > 0").withColumn("__key", key("__size"))
    full = full.withColumn("__turn", F.row_number().over(W.partitionBy("__key").orderBy("__key")))
    fits = (F.col("__turn") <= F.col("__whole")) | ((F.col("__turn") == F.col("__whole") + 1) & (F.col("__part") > 0))
    joined = full.join(taken, (F.col("__key") == F.col("__k")) & fits)
    joined = joined.withColumn("__taken", F.when(F.col("__turn") <= F.col("__whole"), F.col("__size")).otherwise(F.col("__part")))
    pieces = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    text = F.when(F.col("__taken") < F.col("__size"), F.array_join(F.slice(pieces, F.lit(1), F.col("__taken").cast("int")), "")).otherwise(F.col("text"))
    joined = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.select(*docs.columns).unionByName(rows.where("__size = 0").select(*docs.columns))
