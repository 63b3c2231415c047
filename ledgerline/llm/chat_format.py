"""Chat formatting: tool calls linked to their results, DataFrame functions only.

Calls and results are joined by conversation and identifier, calls are put in
an order in which every call comes after those it depends on, their arguments
are validated against the tool's schema, and each linked call is serialised as
canonical JSON (keys sorted at every depth, no blanks).

Rows stay one per call: a conversation that holds a third of all rows is never
gathered. Its order is made from counts per stretch of turns and a running
number inside each stretch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.staging import stage

STRETCH = 256      # turns that are numbered together

#: Schemas by tool: field -> (JSON type, required). Types: string, integer, number,
#: boolean, array, object. Fields that aren't named are errors.
SCHEMAS = {"reply": {"prompt": ("string", True), "turn": ("integer", True)}}

_TYPE_PATTERNS = {"string": "STRING", "integer": "BIGINT", "number": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)",
                  "boolean": "BOOLEAN", "array": "ARRAY<.*", "object": "OBJECT<.*"}


def tool_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of messages that carry them as JSON: an assistant's
    ``{"tool_calls": [{"id", "name", "arguments", "depends_on"}]}`` and a tool's
    ``{"tool_call_id", "content"}``. Texts that are no such JSON give none."""
    kind = "tool_calls array<struct<id string, name string, arguments string, depends_on array<string>>>"
    calls = (messages.where("role = 'assistant'")
             .select("conv_id", "turn", F.explode(F.from_json("text", kind)["tool_calls"]).alias("c"))
             .select("conv_id", "turn", F.col("c.id").alias("call_id"), "c.name", "c.arguments",
                     "c.depends_on"))
    told = F.from_json("text", "tool_call_id string, content string")
    results = (messages.where("role = 'tool'").select("conv_id", "turn", told.alias("r"))
               .select("conv_id", "turn", F.col("r.tool_call_id").alias("call_id"), "r.content"))
    return calls, results


def plain_turns(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of plain chat: a user's turn calls ``reply`` under an
    identifier made of its turn, the assistant's next turn is the result, and
    each call depends on the one two turns before."""
    user = messages.where("role = 'user'")
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), "turn"), {"ignoreNullFields": "false"})
    name = lambda turn: F.concat(F.lit("t"), turn.cast("string"))
    calls = user.select("conv_id", "turn", name(F.col("turn")).alias("call_id"),
                        F.lit("reply").alias("name"), arguments.alias("arguments"),
                        F.array(name(F.col("turn") - 2)).alias("depends_on"))
    results = messages.where("role = 'assistant'").select(
        "conv_id", "turn", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def validation_errors(arguments: str, name: str, schemas: dict) -> Column:
    """Sorted array of errors: not_json, unknown_tool, missing:f, type:f, extra:f."""
    parsed = F.try_parse_json(F.col(arguments))
    keys = F.coalesce(F.json_object_keys(F.col(arguments)), F.array().cast("array<string>"))
    none = F.lit(None).cast("string")
    per_tool = F.array(F.lit("unknown_tool"))
    for tool, fields in schemas.items():
        checks = []
        for field, (kind, required) in fields.items():
            found = F.schema_of_variant(F.try_variant_get(parsed, f"$['{field}']", "variant"))
            absent = ~F.array_contains(keys, field) | found.isNull()
            checks.append(F.when(absent, F.lit(f"missing:{field}") if required else none)
                          .when(~found.rlike(f"^{_TYPE_PATTERNS[kind]}$"), F.lit(f"type:{field}")))
        extra = F.transform(F.array_except(keys, F.array(*map(F.lit, fields))),
                            lambda k: F.concat(F.lit("extra:"), k))
        found_errors = F.array_sort(F.concat(F.filter(F.array(*checks), lambda e: e.isNotNull()), extra))
        per_tool = F.when(F.col(name) == tool, found_errors).otherwise(per_tool)
    return F.when(parsed.isNull(), F.array(F.lit("not_json"))).otherwise(per_tool)


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls with the result of their identifier, and results without a call.

    Of calls that share an identifier in a conversation the first (by turn,
    then content) stays, likewise of results. Rows without a conversation or
    an identifier link to nothing: calls are unanswered, results are orphans.
    """
    usable = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    bare = lambda df: df.where(~usable)
    body = F.struct(F.coalesce("turn", F.lit(2**62)).alias("o"), "turn", "name", "arguments", "depends_on")
    asked = (calls.where(usable).groupBy("conv_id", "call_id").agg(F.min(body).alias("c"))
             .select("conv_id", "call_id", "c.turn", "c.name", "c.arguments", "c.depends_on"))
    reply = F.struct(F.coalesce("turn", F.lit(2**62)).alias("o"), "turn", "content")
    told = (results.where(usable).groupBy("conv_id", "call_id").agg(F.min(reply).alias("r"))
            .select("conv_id", "call_id", F.struct("r.turn", "r.content").alias("r")))
    status = (F.when(F.col("asked").isNull(), "orphan").when(F.col("r").isNull(), "unanswered")
              .otherwise("linked"))
    columns = ["conv_id", "call_id", "turn", "name", "arguments", "depends_on"]
    linked = (asked.withColumn("asked", F.lit(True)).join(told, ["conv_id", "call_id"], "full")
              .select(*columns[:2], F.coalesce("turn", "r.turn").alias("turn"), *columns[3:],
                      F.col("r.content").alias("result"), status.alias("status")))
    alone = bare(calls).select(*columns, F.lit(None).cast("string").alias("result"),
                               F.lit("unanswered").alias("status"))
    lost = bare(results).select("conv_id", "call_id", "turn", *[
        F.lit(None).cast(calls.schema[c].dataType).alias(c) for c in columns[3:]],
        F.col("content").alias("result"), F.lit("orphan").alias("status"))
    return linked.unionByName(alone).unionByName(lost)


def _rounds(linked: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) for calls of conversations in which some call comes
    before one it depends on: Kahn's rounds, level null on a cycle."""
    nodes = linked.where("status <> 'orphan' AND conv_id IS NOT NULL AND call_id IS NOT NULL")
    edges = (nodes.select("conv_id", "call_id", "turn", F.explode(F.array_distinct("depends_on")).alias("dep"))
             .alias("e").join(nodes.select("conv_id", F.col("call_id").alias("dep"),
                                           F.col("turn").alias("dep_turn")).alias("n"), ["conv_id", "dep"]))
    early = (edges.where("NOT coalesce(struct(dep_turn, dep) < struct(turn, call_id), false)")
             .select("conv_id").distinct())
    early = stage(early, "out-of-order")
    left = stage(nodes.join(early, "conv_id", "left_semi").select("conv_id", "call_id"), "calls-left")
    waits = stage(edges.join(early, "conv_id", "left_semi").select("conv_id", "call_id", "dep"), "waits")
    done = left.withColumn("level", F.lit(None).cast("int")).limit(0)
    level = 0
    while True:
        ready = stage(left.join(waits, ["conv_id", "call_id"], "left_anti"), "calls-ready")
        if ready.isEmpty():
            break
        done = done.unionByName(ready.withColumn("level", F.lit(level)))
        left = stage(left.join(ready, ["conv_id", "call_id"], "left_anti"), "calls-left")
        waits = stage(waits.join(ready.withColumnRenamed("call_id", "dep"), ["conv_id", "dep"], "left_anti")
                      .select("conv_id", "call_id", "dep"), "waits")
        level += 1
    return done.unionByName(left.withColumn("level", F.lit(None).cast("int")))


def ordered(linked: DataFrame) -> DataFrame:
    """``linked`` with ``position`` (0, 1, ... in each conversation, dependencies
    first, then by turn and identifier) and ``cyclic``. Calls on a cycle come
    last. Orphans, and calls without a conversation, have no position."""
    rounds = _rounds(linked)
    placed = (linked.join(rounds.withColumn("ranked", F.lit(True)), ["conv_id", "call_id"], "left")
              .withColumn("cyclic", F.col("ranked").isNotNull() & F.col("level").isNull()
                          & (F.col("status") != "orphan"))
              .withColumn("level", F.when(F.col("cyclic"), 2**31 - 1).otherwise(F.coalesce("level", F.lit(0)))))
    calls = placed.where("status <> 'orphan' AND conv_id IS NOT NULL")
    calls = calls.withColumn("stretch", F.floor(F.col("turn") / STRETCH))
    order = ["level", F.asc_nulls_last("stretch")]
    before = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = (calls.groupBy("conv_id", "level", "stretch").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))))
    inside = Window.partitionBy("conv_id", "level", "stretch").orderBy(
        F.asc_nulls_last("turn"), F.asc_nulls_last("call_id"), "name", "arguments")
    numbered = (calls.withColumn("number", F.row_number().over(inside)).alias("c")
                .join(starts.alias("s"), F.expr(
                    "c.conv_id = s.conv_id AND c.level = s.level AND c.stretch <=> s.stretch"))
                .select("c.*", (F.col("s.start") + F.col("c.number") - 1).alias("position")))
    rest = placed.where("status = 'orphan' OR conv_id IS NULL").withColumn(
        "position", F.lit(None).cast("long"))
    keep = [*linked.columns, "position", "cyclic"]
    return numbered.select(keep).unionByName(rest.select(keep))


def format_calls(calls: DataFrame, results: DataFrame, schemas: dict | None = None) -> DataFrame:
    """One row per call and per orphan result: conv_id, turn, call_id, name,
    position, status (linked, unanswered, orphan), cyclic, errors, valid and json.

    ``valid``: linked, off any cycle and without errors. In the JSON absent
    values are null, and arguments that are no JSON are null. Empty tables give
    no rows; repeated rows are one call.
    """
    schemas = SCHEMAS if schemas is None else schemas
    rows = ordered(stage(link(calls, results), "linked-calls"))
    call = F.col("status") != "orphan"
    errors = F.when(call, validation_errors("arguments", "name", schemas)).otherwise(
        F.array().cast("array<string>"))
    deps = F.array_sort(F.array_distinct("depends_on"))
    body = F.struct(F.try_parse_json(F.col("arguments")).alias("arguments"), "call_id", "conv_id",
                    deps.alias("depends_on"), "name", "position", "result", "status")
    return rows.select(
        "conv_id", "turn", "call_id", "name", "position", "status", "cyclic",
        errors.alias("errors"),
        ((F.col("status") == "linked") & ~F.col("cyclic") & (F.size(errors) == 0)).alias("valid"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))
