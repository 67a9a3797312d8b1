"""Tool calls of conversations linked to their results, ordered, validated and written as canonical JSON; DataFrame functions only."""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callsift.functions.jsontext import OPTIONS
from callsift.functions.once import pin
from callsift.session import settle

#: What Spark's description of a JSON value begins with, for each type name of a schema.
KINDS = {"number": ["BIGINT", "DOUBLE", "DECIMAL"], "string": ["STRING"], "boolean": ["BOOLEAN"]}
KINDS |= {"object": ["OBJECT"], "array": ["ARRAY"], "null": ["VOID"]}


def json_value(text: Column) -> Column:
    """The text as a variant; null if the whole text is not one JSON value (Spark alone ignores what follows it).

    Strings may have any length up to that of a variant (128 MB); a value with a repeated key is null.
    """
    mark = F.md5(text)
    both = F.from_json(F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')), "array<variant>", OPTIONS)
    last = F.try_variant_get(F.try_element_at(both, F.lit(2)), "$", "string")
    return F.when((F.size(both) == 2) & (last == mark), F.try_element_at(both, F.lit(1)))


def canonical_json(value: Column) -> Column:
    """Compact JSON with the keys of every object in order; numbers as a variant writes them (whole decimals without a point)."""
    return F.to_json(value)


def _is(kind: Column, name: str) -> Column:
    return F.coalesce(F.rlike(kind, F.lit(f"^({'|'.join(KINDS[name])})")), F.lit(False))


def argument_errors(value: Column, schema: dict) -> Column:
    """Array of error codes of an object under a schema: {"properties": {name: rule}, "required": [...], "closed": bool}.

    A rule may have type, minimum, maximum, minLength, maxLength, enum, and for objects a schema of its own.
    """

    def check(value: Column, schema: dict, path: str) -> list[Column]:
        found = []
        for name, rule in schema.get("properties", {}).items():
            inner = F.try_variant_get(value, f"$['{name}']", "variant")
            there, kind = inner.isNotNull(), F.schema_of_variant(inner)
            right = _is(kind, "number" if rule["type"] == "integer" else rule["type"])
            if rule["type"] in ("integer", "number"):  # finite, and whole where that is asked, whatever the spelling
                size = F.when(right, F.try_variant_get(inner, "$", "double"))
                right = right & F.coalesce((F.abs(size) <= sys.float_info.max) & ((size % 1 == 0) if rule["type"] == "integer" else F.lit(True)), F.lit(False))
            if name in schema.get("required", ()):
                found.append(F.when(~there, F.lit(f"missing:{path}{name}")))
            found.append(F.when(there & ~right, F.lit(f"type:{path}{name}")))
            if rule["type"] in ("integer", "number"):
                number = F.when(there & right, F.try_variant_get(inner, "$", "double"))
                outside = F.lit(False)
                if "minimum" in rule:
                    outside = outside | (number < rule["minimum"])
                if "maximum" in rule:
                    outside = outside | (number > rule["maximum"])
                found.append(F.when(outside, F.lit(f"range:{path}{name}")))
            if rule["type"] == "string":
                text = F.when(there & right, F.try_variant_get(inner, "$", "string"))
                if "enum" in rule:
                    found.append(F.when(~text.isin(rule["enum"]), F.lit(f"enum:{path}{name}")))
                size = F.length(text)
                if "minLength" in rule or "maxLength" in rule:
                    outside = (size < rule.get("minLength", 0)) | (size > rule.get("maxLength", 2**31 - 1))
                    found.append(F.when(outside, F.lit(f"length:{path}{name}")))
            if rule["type"] == "object" and "properties" in rule:
                found += [F.when(there & right, x) for x in check(inner, rule, f"{path}{name}.")]
        if schema.get("closed"):
            keys = F.json_object_keys(F.to_json(value))
            extra = F.array_except(keys, F.array(*[F.lit(x) for x in schema.get("properties", {})]).cast("array<string>"))
            found.append(F.when(F.size(extra) > 0, F.concat(F.lit(f"extra:{path}"), F.array_join(F.array_sort(extra), "+"))))
        return found

    return F.array_compact(F.array(F.lit(None).cast("string"), *check(value, schema, "")))


def validate(name: Column, value: Column, schemas: dict[str, dict]) -> Column:
    """Error codes of a call: json (no JSON value), object (not an object), tool (unknown), or those of its schema."""
    found = F.array(F.lit("tool"))
    for tool, schema in schemas.items():
        found = F.when(name == tool, argument_errors(value, schema)).otherwise(found)
    whole = F.when(value.isNull(), F.array(F.lit("json"))).when(~_is(F.schema_of_variant(value), "object"), F.array(F.lit("object")))
    return whole.otherwise(found)


def depths(calls: DataFrame) -> DataFrame:
    """group, call_id, depth: steps to the root of its chain of parents, null for calls on or above a cycle.

    `calls` has unique (group, call_id) and parent_id (null: a root). Every round doubles how far each call has looked up
    its chain, so a chain of n calls takes log2(n) rounds of joins on unique keys. Calls that have reached their root
    leave the join; those still looking after as many rounds as any chain can need hang on a cycle.
    """
    total = calls.count()
    looking = calls.where("parent_id IS NOT NULL").select("group", "call_id", F.col("parent_id").alias("up"), F.lit(1).cast("long").alias("depth"))
    state = settle(calls.where("parent_id IS NULL").select("group", "call_id", F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("depth")).unionByName(looking), "depths")
    for _ in range(max(1, total).bit_length() + 1):
        active = state.where("up IS NOT NULL")
        if active.isEmpty():
            return state.drop("up")
        above = state.select(F.col("group"), F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        moved = active.join(above, ["group", "up"]).select("group", "call_id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        state = settle(state.where("up IS NULL").unionByName(moved), "depths")
    return state.select("group", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def places(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds place: the row's number (from 1) in its group in the given order, without bringing a group into one task.

    Rows are dealt by ranges of (group, order), sorted and written with their number in the partition; sums of partition
    sizes make it a number in the whole, and the group's smallest one is taken off. `order` should tell rows apart.
    """
    sort = [F.col(group).asc_nulls_first(), *[F.col(x).asc_nulls_last() for x in order]]
    low = (1 << 33) - 1
    placed = settle(rows.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_id", F.monotonically_increasing_id()), "sorted")
    numbered = placed.withColumns({"_part": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit(low))})
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = settle(sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base")), "bases")
    whole = numbered.join(bases, "_part").withColumn("_n", F.col("_base") + F.col("_at"))
    first = settle(whole.groupBy(group).agg(F.min("_n").alias("_first")), "firsts").withColumnRenamed(group, "_group")
    return (
        whole.join(first, F.col(group).eqNullSafe(F.col("_group")))
        .withColumn("place", F.col("_n") - F.col("_first") + 1)
        .drop("_id", "_part", "_at", "_base", "_n", "_first", "_group")
    )


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per (group, call id): the call, its first result, its checks and its place in a topological order.

    calls: group, call_id, parent_id, name, arguments (JSON text), turn. results: group, call_id, content, turn. Other
    columns are dropped. Returns group, call_id, parent_id, name, turn, arguments (canonical JSON, null if not JSON),
    errors (array), content, result_turn, n_calls, n_results, depth, status, place and json (the linked call as canonical
    JSON).

    A call follows its parent: place orders a group by depth, then turn, then call id. Status is the first that fits of
    orphan (a result without a call), cycle, unknown_parent (taken as a root), early_result (it came before its call),
    no_result, linked. Repeated ids are one call, the first by turn, name and arguments, counted in n_calls; likewise
    results. Rows with a null group or call id are kept the same way, as a group or id of their own.
    """
    keys = ["group", "call_id"]
    one_call = calls.groupBy(*keys).agg(F.min(F.struct("turn", "name", "arguments", "parent_id")).alias("c"), F.count("*").alias("n_calls"))
    one_call = settle(one_call.select(*keys, "c.*", "n_calls"), "calls")
    one_result = results.groupBy(*keys).agg(F.min(F.struct(F.col("turn"), F.col("content"))).alias("r"), F.count("*").alias("n_results"))
    one_result = one_result.select(F.col("group").alias("_g"), F.col("call_id").alias("_c"), F.col("r.turn").alias("result_turn"), F.col("r.content").alias("content"), "n_results")
    known = one_call.select(F.col("group").alias("_g"), F.col("call_id").alias("_p"), F.lit(True).alias("known"))
    parents = one_call.select(*keys, "parent_id").where("parent_id IS NOT NULL")
    parents = settle(parents.join(known, F.col("group").eqNullSafe(F.col("_g")) & (F.col("parent_id") == F.col("_p"))).select(*keys, F.col("parent_id").alias("found")), "parents")
    matched = lambda a, b: F.col("group").eqNullSafe(F.col(a)) & F.col("call_id").eqNullSafe(F.col(b))
    chained = one_call.join(parents.withColumnsRenamed({"group": "_g", "call_id": "_c"}), matched("_g", "_c"), "left").drop("_g", "_c")
    chained = settle(chained, "chained")
    deep = depths(chained.where("group IS NOT NULL AND call_id IS NOT NULL").select(*keys, F.col("found").alias("parent_id")))
    deep = deep.withColumnsRenamed({"group": "_g", "call_id": "_c"}).withColumn("deep", F.lit(True))
    full = chained.join(deep, matched("_g", "_c"), "left").drop("_g", "_c")
    linked = full.join(one_result, matched("_g", "_c"), "full")
    status = (
        F.when(F.col("n_calls").isNull(), "orphan")
        .when(F.col("deep") & F.col("depth").isNull(), "cycle")
        .when(F.col("parent_id").isNotNull() & F.col("found").isNull(), "unknown_parent")
        .when(F.col("n_results").isNull(), "no_result")
        .when(F.col("result_turn") < F.col("turn"), "early_result")
        .otherwise("linked")
    )
    # parsed once, in a column that the checks and the writer read
    parsed = pin(linked.withColumnRenamed("arguments", "text"), "value", json_value(F.col("text")))
    value, lone = F.col("value"), F.col("n_calls").isNull()
    rows = parsed.select(
        F.coalesce("group", "_g").alias("group"),
        F.coalesce("call_id", "_c").alias("call_id"),
        "parent_id", "name", "turn",
        canonical_json(value).alias("arguments"),
        F.when(~lone, validate(F.col("name"), value, schemas)).alias("errors"),
        "content", "result_turn",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.when(~lone & ~F.coalesce("deep", F.lit(False)), 0).otherwise(F.col("depth")).alias("depth"),
        status.alias("status"),
        F.when(~lone, F.to_json(F.struct(value.alias("arguments"), F.col("call_id").alias("id"), "name", F.col("content").alias("result")))).alias("json"),
    )
    return places(settle(rows, "linked"), "group", ["depth", "turn", "result_turn", "call_id"])
