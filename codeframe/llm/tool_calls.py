"""Chat formatting: tool calls linked to their results, in dependency order, validated and serialised. DataFrame functions only.

Calls and results are joined by conversation and call id; every call and every result comes out. A call may depend on another one (its parent); its level is one more than its parent's,
so that the order (level, turn) never puts a call before what it depends on. Arguments are checked against the tool's
schema and written as canonical JSON: keys in order, no blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from codeframe.llm.tables import pieces, written

#: A schema's type names and what Spark calls such a value of parsed JSON.
_TYPES = {"integer": r"^BIGINT$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "string": r"^STRING$", "boolean": r"^BOOLEAN$",
          "object": r"^OBJECT<.*", "array": r"^ARRAY<.*"}


def quoted(text: Column) -> Column:
    """A text as JSON: in quotes, escaped; null as null."""
    whole = F.to_json(F.struct(text.cast("string").alias("v")))
    return F.when(text.isNull(), F.lit("null")).otherwise(F.substring(whole, F.lit(6), F.length(whole) - 6))


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and no blanks; null if it is no JSON."""
    return F.to_json(F.try_parse_json(json))


def argument_errors(name: Column, arguments: Column, schemas: dict[str, dict]) -> Column:
    """What is wrong with a call's arguments, as a sorted list of texts; an empty list if nothing is.

    ``schemas`` maps a tool's name to ``{"properties": {argument: {"type", "minimum", "maximum", "enum", "maxLength"}}, "required": [...]}``, of which all
    but the properties' types may be missing. Arguments that the schema does not name are errors too.
    """
    value = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    known = F.lit(False)
    checks: list[Column] = [F.when(value.isNull(), F.lit("arguments are no JSON")).when(keys.isNull(), F.lit("arguments are no object"))]
    for tool, schema in sorted(schemas.items()):
        mine = name.eqNullSafe(F.lit(tool))
        known = known | mine
        properties = schema.get("properties", {})
        extra = F.array_sort(F.array_except(keys, F.array(*map(F.lit, properties)) if properties else F.array().cast("array<string>")))
        checks.append(F.when(mine & (F.size(extra) > 0), F.concat(F.lit("unknown: "), F.array_join(extra, ","))))
        for key, rule in sorted(properties.items()):
            path = "$['" + key.replace("'", "\\'") + "']"
            found = F.try_variant_get(value, path, "variant")
            kind = F.schema_of_variant(found)
            there = mine & keys.isNotNull() & F.array_contains(keys, key)
            if key in schema.get("required", []):
                checks.append(F.when(mine & keys.isNotNull() & ~F.array_contains(keys, key), F.lit(f"missing: {key}")))
            right = kind.rlike(_TYPES[rule["type"]])
            checks.append(F.when(there & ~F.coalesce(right, F.lit(False)), F.lit(f"type of {key}")))
            number, text = F.try_variant_get(value, path, "double"), F.try_variant_get(value, path, "string")
            if "minimum" in rule:
                checks.append(F.when(there & right & (number < rule["minimum"]), F.lit(f"{key} too small")))
            if "maximum" in rule:
                checks.append(F.when(there & right & (number > rule["maximum"]), F.lit(f"{key} too large")))
            if "maxLength" in rule:
                checks.append(F.when(there & right & (F.length(text) > rule["maxLength"]), F.lit(f"{key} too long")))
            if "enum" in rule:
                checks.append(F.when(there & right & ~text.isin(list(rule["enum"])), F.lit(f"{key} not allowed")))
    checks.append(F.when(~known, F.lit("unknown tool")))
    return F.array_sort(F.array_compact(F.array(*checks)))


def levels(calls: DataFrame, rounds: int = 48) -> DataFrame:
    """(conv_id, call_id, level, fault): how many calls stand between a call and its root, by pointer doubling.

    ``calls`` has (conv_id, call_id, parent), one row for each id of a conversation; a parent is a call of the same conversation, and a null
    conversation is one too. After r rounds a call knows its ancestor 2**r steps up, so the rounds are the
    logarithm of the longest chain. A call whose parent does not exist is a root with the fault "missing parent"; one that has no root,
    because parents go in a circle, has no level and the fault "circle".
    """
    ids = calls.select(F.col("conv_id").alias("__conv"), F.col("call_id").alias("__id"), F.lit(True).alias("__there"))
    mine = F.col("conv_id").eqNullSafe(F.col("__conv"))
    state = calls.join(ids, mine & (F.col("parent") == F.col("__id")), "left").select(
        "conv_id", "call_id", F.when(F.col("__there"), F.col("parent")).alias("up"), F.when(F.col("__there"), 1).otherwise(0).cast("long").alias("level"),
        F.when(F.col("parent").isNotNull() & F.col("__there").isNull(), F.lit("missing parent")).alias("fault"))
    state = written(state, "levels")
    limit = max(1, int(state.count()).bit_length() + 1)
    for _ in range(min(rounds, limit)):
        going = state.where("up IS NOT NULL")
        if going.isEmpty():
            break
        above = state.select(F.col("conv_id").alias("__conv"), F.col("call_id").alias("__id"), F.col("up").alias("__up"), F.col("level").alias("__level"))
        moved = going.join(above, mine & (F.col("up") == F.col("__id"))).select(
            "conv_id", "call_id", F.col("__up").alias("up"), (F.col("level") + F.col("__level")).alias("level"), "fault")
        state = written(moved.unionByName(state.where("up IS NULL")), "levels")
    circle = F.col("up").isNotNull()
    return state.select("conv_id", "call_id", F.when(~circle, F.col("level")).alias("level"),
                        F.when(circle, F.lit("circle")).otherwise(F.col("fault")).alias("fault"))


#: Rows of a range of the order in which uses of an id are numbered.
RANGE_ROWS = 200_000


def _same_id(*more: str) -> Column:
    """Do conversation (null is one too) and id agree with (__conv, __id), and the columns ``more`` with those of the same name after "__"?"""
    out = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("call_id") == F.col("__id"))
    for c in more:
        out = out & (F.col(c) == F.col(f"__{c}"))
    return out


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with ``no``, the place of each among those of its conversation and id, from 1; (__conv, __id, uses)). No id may be null.

    Ids that stand more than once are sorted by range over all partitions, so that a much-repeated one is no single task's work; numbers
    within a range are shifted by what the ranges before hold of the id.
    """
    rows = written(rows, "uses")
    uses = written(rows.groupBy(F.col("conv_id").alias("__conv"), F.col("call_id").alias("__id")).agg(F.count(F.lit(1)).alias("uses")), "uses")
    once, many = (rows.join(uses.where(w), _same_id()).drop("__conv", "__id", "uses") for w in ("uses = 1", "uses > 1"))
    repeated = uses.where("uses > 1").agg(F.sum("uses")).first()[0]
    if not repeated:
        return rows.withColumn("no", F.lit(1).cast("long")), uses
    many = written(many.withColumn("__tie", F.monotonically_increasing_id()), "uses")
    ranges = pieces(rows.sparkSession, repeated, RANGE_ROWS)
    many = written(many.repartitionByRange(ranges, "conv_id", "call_id", *order, "__tie").withColumn("__range", F.spark_partition_id()), "uses")
    inside = F.row_number().over(W.partitionBy("conv_id", "call_id", "__range").orderBy(*order, "__tie"))
    held = many.groupBy(F.col("conv_id").alias("__conv"), F.col("call_id").alias("__id"), F.col("__range").alias("____range")).agg(F.count(F.lit(1)).alias("held"))
    before = F.sum("held").over(W.partitionBy("__conv", "__id").orderBy("____range").rowsBetween(W.unboundedPreceding, -1))
    held = held.select("__conv", "__id", "____range", F.coalesce(before, F.lit(0)).alias("before"))
    many = many.withColumn("inside", inside).join(held, _same_id("__range")).withColumn("no", F.col("inside") + F.col("before"))
    return once.withColumn("no", F.lit(1).cast("long")).unionByName(many.select(*once.columns, F.col("no").cast("long"))), uses


def link_every_call(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """(conv_id, call_id, no, turn, level, name, arguments, errors, n_results, result_turn, message, is_call): every call and every result, in one row where they belong together.

    ``calls`` has conv_id, call_id, turn, name, arguments (JSON text), parent (a call id of the conversation, or null); ``results`` has
    conv_id, call_id, turn, content; other columns are not read. If ``results`` has no conv_id, a result belongs to the first conversation that uses its
    id. The calls of an id of a conversation are numbered by turn, name, arguments and parent (nulls first), its results by turn and content; the call
    ``no`` goes with the result ``no``. n_results tells how many results the id has. A parent is the first call of its id. ``errors`` lists what is
    wrong, sorted and joined by "; "; null if nothing is: among others "id used again" for all calls of an id that has several, "no result" if the id has none,
    "result again" and "result without call" for results left over, "no call id" for rows without an id, which are linked to nothing and have no number.
    ``message`` is the canonical JSON of the linked call: arguments that are no JSON are written as null, a missing result too.
    """
    calls = calls.select("conv_id", "call_id", "turn", "name", "arguments", "parent")
    if "conv_id" not in results.columns:
        of = calls.where("call_id IS NOT NULL").groupBy(F.col("call_id").alias("__id")).agg(F.min(F.struct("conv_id")).alias("__c"))
        results = results.join(of, F.col("call_id") == F.col("__id"), "left").withColumn("conv_id", F.col("__c.conv_id"))
    results = results.select("conv_id", "call_id", F.col("turn").alias("result_turn"), "content")
    placed, n_calls = numbered(calls.where("call_id IS NOT NULL"), ["turn", "name", "arguments", "parent"])
    answers, n_results = numbered(results.where("call_id IS NOT NULL"), ["result_turn", "content"])
    placed = written(placed, "calls")
    depth = written(levels(placed.where("no = 1").select("conv_id", "call_id", "parent")), "levels").select(
        F.col("conv_id").alias("__conv"), F.col("call_id").alias("__id"), "level", "fault")
    first = placed.where("no = 1").join(depth, _same_id()).drop("__conv", "__id")
    rest = placed.where("no > 1").unionByName(calls.where("call_id IS NULL"), allowMissingColumns=True)
    rest = rest.join(depth, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("parent") == F.col("__id")), "left")
    found = F.col("__id").isNotNull()
    rest = rest.withColumn("level", F.when(found, F.col("level") + 1).otherwise(F.lit(0).cast("long"))).withColumn("fault", F.when(
        found & F.col("level").isNull(), F.lit("circle")).when(F.col("parent").isNotNull() & ~found, F.lit("missing parent"))).drop("__conv", "__id")
    left = first.unionByName(rest).withColumn("is_call", F.lit(True))
    left = left.join(n_calls.withColumnRenamed("uses", "n_calls"), _same_id(), "left").drop("__conv", "__id")
    left = left.join(n_results.withColumnRenamed("uses", "n_results"), _same_id(), "left").drop("__conv", "__id")
    right = answers.unionByName(results.where("call_id IS NULL"), allowMissingColumns=True).join(
        n_calls.select("__conv", "__id", F.lit(True).alias("called")), _same_id(), "left").drop("__conv", "__id")
    right = right.join(n_results.withColumnRenamed("uses", "__n"), _same_id(), "left").select(
        F.col("conv_id").alias("__conv"), F.col("call_id").alias("__id"), F.col("no").alias("__no"), "result_turn", "content", "called", "__n")
    both = left.join(right, _same_id("no"), "full")
    for c, other in (("conv_id", "__conv"), ("call_id", "__id"), ("no", "__no"), ("n_results", "__n")):
        both = both.withColumn(c, F.when(F.col("is_call"), F.col(c)).otherwise(F.col(other)))
    unnamed = F.when(F.col("call_id").isNull(), F.lit("no call id"))
    wrong = F.when(F.col("is_call"), F.concat(argument_errors(F.col("name"), F.col("arguments"), schemas), F.array_compact(F.array(
        F.col("fault"), unnamed, F.when(F.col("n_calls") > 1, F.lit("id used again")), F.when(F.col("n_results").isNull(), F.lit("no result"))))))
    spare = F.array_compact(F.array(unnamed, F.when(F.col("called"), F.lit("result again")).otherwise(F.lit("result without call"))))
    wrong = F.array_sort(F.coalesce(wrong, spare))
    both = both.withColumn("errors", F.when(F.size(wrong) > 0, F.array_join(wrong, "; "))).withColumn("arguments", canonical(F.col("arguments")))
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    message = F.concat(F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"call_id":'), quoted(F.col("call_id")),
                       F.lit(',"content":'), quoted(F.col("content")), F.lit(',"errors":'), quoted(F.col("errors")), F.lit(',"level":'), number("level"),
                       F.lit(',"name":'), quoted(F.col("name")), F.lit(',"parent":'), quoted(F.col("parent")), F.lit("}"))
    return both.select("conv_id", "call_id", "no", "turn", "level", "name", "arguments", "errors",
                       F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), "result_turn", message.alias("message"),
                       F.coalesce("is_call", F.lit(False)).alias("is_call"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """(conv_id, call_id, turn, level, name, arguments, errors, n_results, message) of ``link_every_call``: a row for every call that has an id, and for each
    conversation and id that only results name the first of them. Rows without an id and further results are in ``link_every_call`` alone.
    """
    rows = link_every_call(calls, results, schemas).where("call_id IS NOT NULL AND (is_call OR (no = 1 AND errors = 'result without call'))")
    return rows.drop("no", "result_turn", "is_call")
