"""Tool-call linking for chat transcripts, in DataFrame operations only.

Messages are rows. Calls and results meet in a hash join on conversation and
identifier, arguments are validated against the tools' schemas, and each message
becomes a line of canonical JSON (keys sorted, no spaces). A call whose arguments
hold {"$ref": id} depends on the result of the call of that identifier. Nothing
gathers a conversation in one place: a row's order is (conv_id, anchor, step,
turn). A call without dependencies is anchored at its turn, step 0; one with
them comes no earlier than the last of them, a step after its result; a result
comes a step after its call, whatever turn it came in. The dependencies are
followed by joins, all calls of one depth at once, so the order is topological.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidy

#: tool -> argument -> (JSON type, required)
Schemas = dict[str, dict[str, tuple[str, bool]]]
#: JSON type -> how Spark names the type of such a value.
TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": "^BOOLEAN$", "object": "^OBJECT.*", "array": "^ARRAY.*"}
MESSAGE, CALL, RESULT = "message", "call", "result"
#: A reference to the result of another call, in a call's arguments.
REFERENCE = r'"\$ref"\s*:\s*"([^"\\]*)"'
#: The tools that a plain dialogue is read as using.
TOOLS: Schemas = {"reply": {"after": ("object", False), "prompt": ("string", True)}, "search": {"limit": ("integer", False), "query": ("string", True)}}
_CALLS = "tool_calls array<struct<id:string,name:string,arguments:string>>, tool_call_id string, content string"


def _rows(kind: str, call_id: Column, tool: Column, arguments: Column, content: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), call_id.cast("string").alias("call_id"), tool.cast("string").alias("tool"), arguments.cast("string").alias("arguments"), content.cast("string").alias("content"))


def parse(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, kind, call_id, tool, arguments, content) from transcripts whose tool turns are JSON.

    An assistant's {"tool_calls": [{"id", "name", "arguments"}], "content"} gives
    a row for each call, after one for its content if it has any; a text
    {"tool_call_id", "content"} of role tool gives a result. Any other text is a
    message. arguments may be an object or a string that holds one.
    """
    none = F.lit(None)
    looks = F.coalesce(F.ltrim("text").startswith("{"), F.lit(False))
    t = conversations.select("conv_id", "turn", "role", "text", F.when(looks, F.from_json("text", _CALLS)).alias("j"))
    calls = F.transform("j.tool_calls", lambda c: _rows(CALL, c["id"], c["name"], c["arguments"], none))
    said = F.when(F.length("j.content") > 0, F.array(_rows(MESSAGE, none, none, none, F.col("j.content")))).otherwise(F.array().cast(f"array<{_KIND}>"))
    rows = (
        F.when((F.col("role") == "tool") & F.col("j.tool_call_id").isNotNull(), F.array(_rows(RESULT, F.col("j.tool_call_id"), none, none, F.col("j.content"))))
        .when((F.col("role") == "assistant") & (F.size("j.tool_calls") > 0), F.concat(said, calls))
        .otherwise(F.array(_rows(MESSAGE, none, none, none, F.col("text"))))
    )
    return t.select("conv_id", "turn", "role", F.explode(rows).alias("r")).select("conv_id", "turn", "role", "r.*")


_KIND = "struct<kind:string,call_id:string,tool:string,arguments:string,content:string>"


def dialogue(conversations: DataFrame) -> DataFrame:
    """The rows of parse() for transcripts without tools: a user's turn is a call, the next turn of an assistant its result.

    By turns of two the call is a ``search`` for the text, whose limit is the
    text's length (as a string, which is wrong, if that is a multiple of five),
    or a ``reply`` to it that refers to the call two turns before.
    """
    name = lambda turn: F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))
    user, assistant, text = F.col("role") == "user", F.col("role") == "assistant", F.col("text")
    asks = F.floor(F.col("turn") / 2) % 2 == 0
    length, turn = F.length(text), F.col("turn")
    wrong = F.to_json(F.struct(length.cast("string").alias("limit"), text.alias("query")))
    search = F.when(length % 5 == 0, wrong).otherwise(F.to_json(F.struct(length.alias("limit"), text.alias("query"))))  # {} if the text is null
    reply = F.to_json(F.struct(F.struct(name(turn - 2).alias("$ref")).alias("after"), text.alias("prompt")))
    return conversations.select(
        "conv_id", "turn", "role",
        F.when(user, CALL).when(assistant, RESULT).otherwise(MESSAGE).alias("kind"),
        F.when(user, name(turn)).when(assistant, name(turn - 1)).alias("call_id"),
        F.when(user & asks, "search").when(user, "reply").alias("tool"),
        F.when(user & asks, search).when(user, reply).alias("arguments"),
        F.when(~F.coalesce(user, F.lit(False)), text).alias("content"),
    )


def validate(tool: Column, arguments: Column, schemas: Schemas) -> Column:
    """"ok", or the first thing wrong with a call's arguments."""
    parsed = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    out = F.when(parsed.isNull(), "bad_json").when(~is_object, "not_an_object")
    for name, fields in sorted(schemas.items()):
        mine = tool == name
        keys = F.json_object_keys(F.when(is_object, arguments))
        unknown = F.size(F.array_except(keys, F.array(*map(F.lit, fields)).cast("array<string>"))) > 0
        for field, (kind, required) in sorted(fields.items()):
            value = F.try_variant_get(F.when(is_object, parsed), f"$.{field}", "variant")
            there = F.coalesce(F.array_contains(keys, field), F.lit(False))
            if required:
                out = out.when(mine & ~there, f"missing:{field}")
            fits = F.coalesce(F.regexp_like(F.schema_of_variant(value), F.lit(TYPES[kind])), F.lit(False))
            out = out.when(mine & there & ~fits, f"type:{field}")
        out = out.when(mine & F.coalesce(unknown, F.lit(False)), "unknown_argument")
    known = reduce(lambda a, b: a | b, [tool == name for name in schemas], F.lit(False))
    return out.when(~F.coalesce(known, F.lit(False)), "unknown_tool").otherwise("ok")


def order(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, called, anchor, step, depth, wrong) of the first calls (conv_id, call_id, called, arguments).

    depth is the number of calls on the longest chain of references that ends
    here, less one; wrong is unknown_ref if a reference has no call (it then
    doesn't count), cycle if the call depends on itself (it then stands at its
    own turn). One round a depth, each a hash join of what waits with what the
    round before has placed.
    """
    ids = ["conv_id", "call_id"]
    calls = materialize(calls)
    refs = calls.select(*ids, F.explode(F.array_distinct(F.regexp_extract_all("arguments", F.lit(REFERENCE), 1))).alias("ref"))
    known = calls.select("conv_id", F.col("call_id").alias("ref"), F.lit(True).alias("known"))
    refs = materialize(refs.join(known.hint("shuffle_hash"), ["conv_id", "ref"], "left"))
    unknown = refs.where("known is null").select(*ids).distinct().withColumn("unknown", F.lit(True))
    needs = refs.where("known").groupBy(*ids).agg(F.count("*").alias("needs"))
    state = calls.select(*ids, "called").join(needs.hint("shuffle_hash"), ids, "left").join(unknown.hint("shuffle_hash"), ids, "left")
    state = materialize(state.select(*ids, "called", F.coalesce("needs", F.lit(0)).alias("needs"), F.when(F.col("unknown"), "unknown_ref").alias("wrong")))
    place = [F.col("called").alias("anchor"), F.lit(0).alias("step"), F.lit(0).alias("depth")]
    placed = [state.where("needs = 0").select(*ids, "called", *place, "wrong")]
    waiting = state.where("needs > 0")
    edges, new = refs.where("known").select(*ids, "ref"), placed[0]
    met = None
    while not waiting.isEmpty():
        # The last of the dependencies placed so far, and how many there are.
        front = edges.join(new.select("conv_id", F.col("call_id").alias("ref"), F.struct("anchor", "step").alias("at"), "depth").hint("shuffle_hash"), ["conv_id", "ref"])
        front = front.groupBy(*ids).agg(F.count("*").alias("n"), F.max("at").alias("at"), F.max("depth").alias("depth"))
        if met is not None:
            front = met.unionByName(front).groupBy(*ids).agg(F.sum("n").alias("n"), F.max("at").alias("at"), F.max("depth").alias("depth"))
        met = materialize(front)
        after = F.coalesce(F.col("at.anchor") >= F.col("called"), F.lit(False))
        ready = waiting.join(met.hint("shuffle_hash"), ids).where("n = needs")
        new = materialize(ready.select(*ids, "called", F.when(after, F.col("at.anchor")).otherwise(F.col("called")).alias("anchor"), F.when(after, F.col("at.step") + 2).otherwise(0).alias("step"), (F.col("depth") + 1).alias("depth"), "wrong"))
        if new.isEmpty():
            placed.append(waiting.select(*ids, "called", *place, F.lit("cycle").alias("wrong")))
            break
        placed.append(new)
        waiting = materialize(waiting.join(new.select(*ids).hint("shuffle_hash"), ids, "left_anti"))
    return reduce(DataFrame.unionByName, placed)


@tidy
def link(rows: DataFrame, schemas: Schemas) -> DataFrame:
    """(conv_id, anchor, step, depth, turn, role, kind, call_id, status, line) for rows of parse() or dialogue().

    status: of a call what validate() says, or what order() finds wrong, or
    duplicate_id if an earlier turn of the conversation used the identifier, or
    no_id; of a result linked or orphan; "ok" for messages. depth: of calls and
    their results, else null. line is canonical JSON of the message. Null turns,
    roles and texts are kept; repeated rows stay repeated; calls that share
    identifier and turn are all first, and their references are those of the
    first by its arguments. An empty table gives no rows.
    """
    ids = ["conv_id", "call_id"]
    linked = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    calls = rows.where((F.col("kind") == CALL) & linked).groupBy(*ids).agg(F.min("turn").alias("called"), F.min(F.struct("turn", "arguments"))["arguments"].alias("arguments"))
    first = order(calls).withColumn("known", F.lit(True))
    asks = rows.where((F.col("kind") != MESSAGE) & linked).join(first.hint("shuffle_hash"), ids, "left")
    extra = [c for c in asks.columns if c not in rows.columns]
    alone = rows.where((F.col("kind") == MESSAGE) | ~linked).select("*", *[F.lit(None).cast(asks.schema[c].dataType).alias(c) for c in extra])
    both = asks.select(*alone.columns).unionByName(alone)
    is_call, is_result = F.col("kind") == CALL, F.col("kind") == RESULT
    again = is_call & F.coalesce(F.col("turn") > F.col("called"), F.lit(False))
    valid = validate(F.col("tool"), F.col("arguments"), schemas)
    status = (
        F.when(is_call & F.col("call_id").isNull(), "no_id")
        .when(again, "duplicate_id")
        .when(is_call, F.when(valid == "ok", F.coalesce("wrong", F.lit("ok"))).otherwise(valid))
        .when(is_result & F.col("known"), "linked")
        .when(is_result, "orphan")
        .otherwise("ok")
    )
    mine = F.coalesce(F.col("known") & ~again, F.lit(False))
    # Fields by name, so that keys come sorted; null fields are left out.
    arguments = F.coalesce(F.try_parse_json("arguments"), F.col("arguments").cast("variant"))
    line = F.to_json(F.struct(arguments.alias("arguments"), "call_id", "content", "kind", "role", "tool"))
    return both.select(
        "conv_id",
        F.when(mine, F.coalesce("anchor", "turn")).otherwise(F.col("turn")).alias("anchor"),
        (F.when(mine, F.col("step")).otherwise(0) + F.when(is_result, 1).otherwise(0)).alias("step"),
        F.when(mine, F.col("depth")).alias("depth"),
        "turn", "role", "kind", "call_id", status.alias("status"), line.alias("line"),
    )
