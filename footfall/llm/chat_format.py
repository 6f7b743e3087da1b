"""Chat formatting: tool calls linked with their results, in DataFrame functions only.

A message is a call or a result. JSON texts name them: {"tool_calls": [{"id", "name", "arguments", "after":
[ids]}]} and {"tool_call_id", "content"}; a text with both is the calls and the result. For all other turns the
conversation itself is the protocol: a turn of anyone but the assistant calls the tool `reply` under the id
conversation:turn, and an assistant's turn is the result of the turn before it. So is a `content` that is not
null beside calls, if no tool_call_id claims it; an empty list of calls makes no message of its own.

Calls and results meet in a hash join on conversation and id; `after` names ids of the same conversation. Arguments are checked against schemas (tool, field, type,
required), joined by tool name: a missing required field, a field of another type and an unknown field are
an error each; an unknown tool is one error. The order is topological: a call comes before its result and
after the results of the calls it names in `after`. It is given by (order_turn, phase), not by a running
number, so no conversation is gathered in one task: order_turn starts as the later of the own and the linked
turn and is raised along `after`, in rounds of joins of which a chain takes the logarithm of its length; calls
that wait for a cycle have none. JSON is
canonical: keys sorted, no blanks, UTF-8.

Defined results: a null text is a call without the argument `prompt` or a result with null content; rows
without conversation are not linked, and turns without conversation or turn have no id; repeated calls and results of an id are each kept
and linked; columns other than conv_id, turn, role and text are ignored; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.tables import stored

#: The schema of the implicit tool: tool, field, type, required.
REPLY = (("reply", "prompt", "STRING", True), ("reply", "role", "STRING", True))

_KEYS = ("conv_id", "turn", "role")
_ID = ["conv_id", "call_id"]
_ARGS = "array<struct<key:string,type:string,json:string>>"


def reply_schemas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(REPLY), "tool string, field string, type string, required boolean")


def _quoted(text: Column) -> Column:
    """A JSON string; null stays null."""
    listed = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substring(listed, 2, F.length(listed) - 2))


def _kind_of(value: Column) -> Column:
    """STRING, INTEGER, NUMBER, BOOLEAN, ARRAY, OBJECT or VOID."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.when(name.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "INTEGER").when(name.isin("DECIMAL", "DOUBLE", "FLOAT"), "NUMBER").otherwise(name)


def messages(conversations: DataFrame) -> DataFrame:
    """One row per call or result: conv_id, turn, role, kind, call_id, tool, args (key, type, json), content, after."""
    said = conversations.select(*_KEYS, "text").withColumn("v", F.when(F.col("text").rlike(r"^\s*\{"), F.try_parse_json("text")))
    calls = F.try_variant_get("v", F.lit("$.tool_calls"), "array<variant>")
    said = said.withColumn("calls", F.when(F.size(calls) > 0, calls))
    said = said.withColumn("answers", F.try_variant_get("v", F.lit("$.tool_call_id"), "string"))
    said = said.withColumn("words", F.try_variant_get("v", F.lit("$.content"), "variant"))
    no_text, no_args, no_refs = F.lit(None).cast("string"), F.lit(None).cast(_ARGS), F.expr("cast(array() as array<string>)")

    call = F.col("call")
    args = F.map_entries(F.try_variant_get(call, F.lit("$.arguments"), "map<string,variant>"))
    args = F.transform(args, lambda e: F.struct(e["key"].alias("key"), _kind_of(e["value"]).alias("type"), F.to_json(e["value"]).alias("json")))
    explicit = said.select(*_KEYS, F.explode("calls").alias("call")).select(
        *_KEYS,
        F.lit("call").alias("kind"),
        F.try_variant_get(call, F.lit("$.id"), "string").alias("call_id"),
        F.try_variant_get(call, F.lit("$.name"), "string").alias("tool"),
        F.coalesce(args, F.expr(f"cast(array() as {_ARGS})")).alias("args"),
        no_text.alias("content"),
        F.coalesce(F.try_variant_get(call, F.lit("$.after"), "array<string>"), no_refs).alias("after"),
    )
    results = said.where("answers is not null").select(
        *_KEYS,
        F.lit("result").alias("kind"),
        F.col("answers").alias("call_id"),
        no_text.alias("tool"),
        no_args.alias("args"),
        F.to_json("words").alias("content"),
        no_refs.alias("after"),
    )
    by_assistant = F.col("role").eqNullSafe("assistant")
    own_id = F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - by_assistant.cast("int")).cast("string"))
    beside = F.col("calls").isNotNull()
    prompt = F.when(beside, F.to_json("words")).otherwise(_quoted(F.col("text")))
    kind = F.when(beside, _kind_of(F.col("words"))).otherwise("STRING")
    spoken = F.array(
        F.struct(F.lit("prompt").alias("key"), kind.alias("type"), prompt.alias("json")),
        F.struct(F.lit("role").alias("key"), F.lit("STRING").alias("type"), _quoted(F.col("role")).alias("json")),
    )
    turns = said.where("answers is null and (calls is null or words is not null and not is_variant_null(words))").select(
        *_KEYS,
        F.when(by_assistant, "result").otherwise("call").alias("kind"),
        F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), own_id).alias("call_id"),
        F.when(~by_assistant, "reply").alias("tool"),
        F.when(~by_assistant, F.filter(spoken, lambda a: a["json"].isNotNull())).alias("args"),
        F.when(by_assistant, prompt).alias("content"),
        no_refs.alias("after"),
    )
    return explicit.unionByName(results).unionByName(turns)


def _errors(args: Column, fields: Column) -> Column:
    """Number of faults of arguments against the fields of their tool; a tool without fields is unknown."""

    def fits(a: Column, f: Column) -> Column:
        return (a["key"] == f["field"]) & ((a["type"] == f["type"]) | ((f["type"] == "NUMBER") & (a["type"] == "INTEGER")))

    missing = F.filter(fields, lambda f: f["required"] & ~F.exists(args, lambda a: a["key"] == f["field"]))
    wrong = F.filter(args, lambda a: ~F.exists(fields, lambda f: fits(a, f)))
    return F.when(fields.isNull(), 1).otherwise(F.size(missing) + F.size(wrong)).cast("long")


def _chains(picked: DataFrame, most: int) -> DataFrame:
    """What each call learns along the chain of its picked references: conv_id, call_id, best (the turn it cannot
    come before), bad (the chain never ends, or meets a call that waits for a cycle).

    picked: conv_id, call_id, ref, best, bad, one row a call. Pointers double: after k rounds a call has seen 2^k
    calls of its chain."""
    jumps = stored(picked.withColumn("hops", F.lit(1).cast("long")), "chains")
    seen = 1
    while seen <= most and jumps.where("ref is not null").limit(1).count():
        ahead = jumps.select("conv_id", F.col("call_id").alias("ref"), F.col("ref").alias("next"), F.col("best").alias("far"), F.col("bad").alias("far_bad"), F.col("hops").alias("more"))
        jumps = stored(
            jumps.join(ahead, ["conv_id", "ref"], "left").select(
                *_ID,
                F.col("next").alias("ref"),
                F.greatest("best", F.col("far") + F.col("hops")).alias("best"),
                (F.col("bad") | F.coalesce("far_bad", F.lit(False))).alias("bad"),
                (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"),
            ),
            "chains",
        )
        seen *= 2
    # A chain without a cycle has no more links than its conversation has references.
    return jumps.select(*_ID, "best", (F.col("bad") | F.col("ref").isNotNull()).alias("bad"))


def _raised(calls: DataFrame, results: DataFrame) -> DataFrame | None:
    """conv_id, call_id and order_turn where `after` references raise it (null in or behind a cycle); None without
    references.

    Each call picks the reference that ends last, the chains of picked references are followed by pointer doubling,
    and this repeats until no reference asks for more: one such step for each time that the longest way to a call
    leaves the picked chains, which for plain chains, and for calls that name several or all before them, is one."""
    waits = calls.where((F.size("after") > 0) & F.col("conv_id").isNotNull()).select(*_ID, F.explode("after").alias("ref"))
    most = waits.groupBy("conv_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    if most is None:
        return None
    answered = results.groupBy(*_ID).agg(F.max("turn").alias("result_turn"))
    own = calls.groupBy(*_ID).agg(F.min("turn").alias("call_turn"))
    base = stored(own.join(answered, _ID, "left"), "order")
    links = stored(waits.select(*_ID, "ref").distinct(), "waits")
    now = base.select(*_ID, F.col("call_turn").alias("at"), F.lit(False).alias("endless"))
    step = 0
    while True:
        ends = now.join(base, _ID).select("conv_id", F.col("call_id").alias("ref"), F.greatest("at", "result_turn").alias("end"), "endless")
        last = F.max(F.struct(F.coalesce("end", F.lit(-1)).alias("end"), "ref"))
        picked = links.join(ends, ["conv_id", "ref"]).groupBy(*_ID).agg(last.alias("last"), (F.max("end") + 1).alias("best"), F.bool_or("endless").alias("bad"))
        picked = stored(now.join(picked, _ID).select(*_ID, F.col("last.ref").alias("ref"), "best", "bad", "at", "endless"), "picked")
        # Another step is due where a reference asks for more than its call has.
        if not picked.where("not endless and (bad or best > at or (at is null and best is not null))").limit(1).count():
            return now.select(*_ID, F.when(~F.col("endless"), F.col("at")).alias("order_turn"))
        chains = _chains(picked.drop("at", "endless"), most)
        # What still moves after as many steps as a chain can have links is in or behind a cycle.
        moved = F.lit(step > most) & (F.col("best") > F.col("at"))
        raised = now.join(chains, _ID, "left").select(
            *_ID, F.greatest("at", "best").alias("at"), (F.col("endless") | F.coalesce(F.col("bad") | moved, F.lit(False))).alias("endless")
        )
        now, step = stored(raised, "order"), step + 1


def format_calls(conversations: DataFrame, schemas: DataFrame | None = None) -> DataFrame:
    """Per call or result: conv_id, turn, kind, call_id, linked, n_errors (null for results), order_turn, phase,
    json. schemas: tool, field, type, required; by default those of `reply` alone."""
    spark = conversations.sparkSession
    said = messages(conversations)
    calls, results = said.where("kind = 'call'"), said.where("kind = 'result'")
    tools = (schemas if schemas is not None else reply_schemas(spark)).groupBy("tool")
    tools = tools.agg(F.collect_set(F.struct("field", "type", "required")).alias("fields"))

    called = calls.groupBy(*_ID).agg(F.min("turn").alias("call_turn"))
    answered = results.groupBy(*_ID).agg(F.count("*").alias("n_results"))
    order = _raised(calls, results)
    calls = calls.join(answered, _ID, "left").join(tools, "tool", "left")
    results = results.join(called, _ID, "left")
    if order is None:
        calls, results = calls.withColumn("order_turn", F.col("turn")), results.withColumn("order_turn", F.greatest("turn", "call_turn"))
    else:
        no_id = F.col("conv_id").isNull() | F.col("call_id").isNull()
        calls = calls.join(order, _ID, "left").withColumn("order_turn", F.when(no_id, F.col("turn")).otherwise(F.col("order_turn")))
        late = results.join(order, _ID, "left")
        results = late.withColumn("order_turn", F.when(F.col("call_turn").isNotNull(), F.greatest("turn", "order_turn")).otherwise(F.col("turn")))

    def text(name: str) -> Column:
        return F.coalesce(_quoted(F.col(name)), F.lit("null"))

    pairs = F.transform(F.array_sort("args"), lambda a: F.concat(_quoted(a["key"]), F.lit(":"), a["json"]))
    call_json = F.concat(
        F.lit('{"arguments":{'), F.array_join(pairs, ","), F.lit('},"id":'), text("call_id"), F.lit(',"kind":"call","name":'), text("tool"), F.lit("}")
    )
    result_json = F.concat(F.lit('{"content":'), F.coalesce("content", F.lit("null")), F.lit(',"id":'), text("call_id"), F.lit(',"kind":"result"}'))
    first = calls.select(
        "conv_id",
        "turn",
        "kind",
        "call_id",
        F.col("n_results").isNotNull().alias("linked"),
        _errors(F.col("args"), F.col("fields")).alias("n_errors"),
        "order_turn",
        F.lit(0).alias("phase"),
        call_json.alias("json"),
    )
    second = results.select(
        "conv_id",
        "turn",
        "kind",
        "call_id",
        F.col("call_turn").isNotNull().alias("linked"),
        F.lit(None).cast("long").alias("n_errors"),
        "order_turn",
        F.lit(1).alias("phase"),
        result_json.alias("json"),
    )
    return first.unionByName(second)
