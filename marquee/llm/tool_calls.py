"""Tool-call linking: results joined to calls by identifier, calls ordered, arguments validated.

A call has an id within its conversation, a tool, JSON arguments, and may build on
other calls, ``after``: one id, or an array of them. Results are hash-joined by (conversation, id). Of several calls or results of one id
the first by turn are linked; the others are rows of their own content, with their rank within the id.
The order is topological: a call's depth is the number of calls on the longest way it builds on, one on another. Calls that build on one
other find the nearest call that builds on none or on several by pointer doubling, so a chain of n calls takes log2(n) rounds however long the conversation is;
calls that build on several are then settled in rounds, as many as such calls follow one another.
Positions within a conversation come from a range-partitioned numbering, so one
conversation may hold any share of all calls. Each call is one row of canonical JSON: keys sorted, no
white space, no escapes beyond those JSON asks for.

Status, the first that holds: ``orphan_result`` (no such call), ``further_result`` (not the first of its call), ``no_id``, ``duplicate_call`` (not the first by
turn, then arguments), ``cyclic`` (builds on itself), ``dangling`` (builds on a call that is not there), ``invalid_arguments``,
``no_result``, ``ok``. Turns of a conversation that are neither calls nor results are ``unlinked``; their JSON
holds their role, and their text as the result. Rows: null conversation or id cannot be linked; null or malformed
arguments are invalid; null content is a result whose text is null; repeated rows are duplicates.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import numbered, written

Schema = dict[str, Any]
KEYS = ["conv_id", "call_id"]
# Nesting and digits of arguments that have a canonical form.
MAX_DEPTH = 200
MAX_DIGITS = 1000
_BRACKETS = re.compile(r'"(?:[^"\\]|\\.)*+"?|[\[\]{}]', re.DOTALL)
_SURROGATE = re.compile("[\ud800-\udfff]")
KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list}


class Refused(ValueError):
    """JSON that has no canonical form here; the message says why."""


def parse(text: str) -> Any:
    """The value of a JSON text that has a canonical form, or :class:`Refused`.

    Refused are keys that repeat, halves of surrogate pairs, numbers beyond a double, whole numbers of more than
    ``MAX_DIGITS`` digits, ``NaN`` and the like, and nesting deeper than ``MAX_DEPTH``.
    """
    depth = deepest = 0
    for sign in _BRACKETS.findall(text):
        depth += (sign in "[{") - (sign in "]}")
        deepest = max(deepest, depth)
    if deepest > MAX_DEPTH:
        raise Refused("nested too deep")
    try:
        value = json.loads(text, parse_constant=_bare, parse_int=_whole, parse_float=_double, object_pairs_hook=_object)
    except Refused:
        raise
    except ValueError:
        raise Refused("not JSON") from None
    if "\\u" in text and _SURROGATE.search(canonical(value)):
        raise Refused("half a character")
    return value


def _bare(token: str) -> None:
    raise Refused("not JSON")


def _whole(digits: str) -> int:
    if len(digits) > MAX_DIGITS:
        raise Refused("number out of range")
    return int(digits)


def _double(digits: str) -> float | int:
    value = float(digits)
    if math.isinf(value):
        raise Refused("number out of range")
    # 1.0 and 1 are one number, to the schema too
    return int(value) if value.is_integer() and abs(value) <= 2**53 else value


def _object(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise Refused("repeated key")
    return out


def _number(value: float) -> str:
    """A double in its shortest form, as ECMAScript writes it; whole ones without a fraction."""
    if value == 0:
        return "0"
    mantissa, _, exponent = f"{value!r}e0".partition("e")
    whole, _, fraction = mantissa.removeprefix("-").partition(".")
    fraction = "" if fraction == "0" else fraction
    point = len(whole) + int(exponent.removesuffix("e0"))  # digits before the point
    digits = whole + fraction
    bare = digits.lstrip("0")
    point -= len(digits) - len(bare)
    digits = bare.rstrip("0")
    if 0 < point <= 21:
        shown = digits.ljust(point, "0") if len(digits) <= point else f"{digits[:point]}.{digits[point:]}"
    elif -6 < point <= 0:
        shown = f"0.{'0' * -point}{digits}"
    else:
        shown = f"{digits[0]}{'.' * (len(digits) > 1)}{digits[1:]}e{point - 1:+d}"
    return "-" * (value < 0) + shown


def canonical(value: Any) -> str:
    """JSON without white space, keys in the order of their UTF-16 units, no escapes beyond those JSON asks for, equal numbers written alike."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    return _number(value) if isinstance(value, float) else json.dumps(value, ensure_ascii=False)


def violations(value: Any, schema: Schema, at: str = "$") -> list[str]:
    """What the value breaks of a schema of type, enum, properties, required, additionalProperties, items, minimum and maximum."""
    kind = schema.get("type")
    if kind and (not isinstance(value, KINDS[kind]) or kind != "boolean" and isinstance(value, bool)):
        return [f"{at}: not {kind}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not listed")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            found.append(f"{at}: out of range")
    if isinstance(value, dict):
        own = schema.get("properties", {})
        found += [f"{at}.{name}: missing" for name in schema.get("required", []) if name not in value]
        for name in sorted(value):
            if name in own:
                found += violations(value[name], own[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{name}: not known")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += violations(item, schema["items"], f"{at}[{i}]")
    return found


def depths(nodes: DataFrame) -> DataFrame:
    """``conv_id, call_id, depth, missing`` of ``conv_id, call_id, after`` (an array); depth is null on and behind a cycle, ``missing`` says that a call of ``after`` is not there."""
    target = [F.col("conv_id").alias("t_conv"), F.col("call_id").alias("t_call")]
    edges = nodes.select(*KEYS, F.explode(F.array_distinct(F.array_compact("after"))).alias("to"))
    there = nodes.select(*target)
    found = edges.join(there, (F.col("conv_id") == F.col("t_conv")) & (F.col("to") == F.col("t_call")), "left")
    found = written(found.select(*KEYS, "to", F.col("t_call").isNotNull().alias("known")), "edges")
    of_call = found.groupBy(*KEYS).agg(F.count_if("known").alias("n"), F.max(F.when(F.col("known"), F.col("to"))).alias("to"), F.max(~F.col("known")).alias("missing"))
    state = nodes.select(*KEYS).join(of_call, KEYS, "left").select(
        *KEYS, F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("missing", F.lit(False)).alias("missing"), "to"
    )
    state = written(state, "degrees")
    anchors = _anchors(state)
    several = state.where("n > 1").select(*KEYS)
    ways = found.where("known").join(several, KEYS).select(*KEYS, F.col("to").alias("p_call")).join(
        anchors.select(F.col("conv_id"), F.col("call_id").alias("p_call"), "anchor", "steps"), ["conv_id", "p_call"]
    )
    ways = written(ways.select(*KEYS, "anchor", (F.col("steps") + 1).alias("steps")), "ways")
    settled = written(state.where("n = 0").select(*KEYS, F.lit(0).cast("long").alias("depth")), "settled")
    left = state.where("n > 1").count()
    while left:
        known = settled.select("conv_id", F.col("call_id").alias("anchor"), F.col("depth").alias("up"))
        open_ways = ways.join(settled.select(*KEYS), KEYS, "left_anti").join(known, ["conv_id", "anchor"], "left")
        ready = open_ways.groupBy(*KEYS).agg(F.max(F.col("up") + F.col("steps")).alias("depth"), F.count_if(F.col("up").isNull()).alias("waiting"))
        more = written(ready.where("waiting = 0").select(*KEYS, "depth"), "settled")
        if more.isEmpty():
            break
        settled = written(settled.union(more), "settled")
        left -= more.count()
    up = settled.select("conv_id", F.col("call_id").alias("anchor"), F.col("depth").alias("up"))
    depth = anchors.join(up, ["conv_id", "anchor"], "left").select(*KEYS, (F.col("up") + F.col("steps")).alias("depth"))
    return state.select(*KEYS, "missing").join(depth, KEYS, "left").select(*KEYS, "depth", "missing")


def _anchors(state: DataFrame) -> DataFrame:
    """``anchor, steps`` of each call: the nearest call, itself or on its way, that does not build on exactly one, and how far it is; null where a cycle comes first."""
    one = F.col("n") == 1
    chain = written(state.select(*KEYS, F.when(one, F.col("to")).alias("to"), F.when(one, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("steps")), "chains")
    chain = chain.withColumn("anchor", F.coalesce("to", "call_id"))
    for _ in range(math.ceil(math.log2(chain.count() + 2)) + 1):
        if chain.where("to is not null").isEmpty():
            break
        ahead = chain.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("t_to"), F.col("steps").alias("t_steps"), F.col("anchor").alias("t_anchor"))
        both = chain.join(ahead, ["conv_id", "to"], "left")
        moved = F.col("to").isNotNull()
        chain = written(
            both.select(
                *KEYS,
                F.col("t_to").alias("to"),
                F.when(moved, F.col("steps") + F.col("t_steps")).otherwise(F.col("steps")).alias("steps"),
                F.when(moved, F.col("t_anchor")).otherwise(F.col("anchor")).alias("anchor"),
            ),
            "chains",
        )
    # what still points on after so many rounds is on or behind a cycle
    return chain.select(*KEYS, F.when(F.col("to").isNull(), F.col("anchor")).alias("anchor"), "steps")


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with ``rank``, the place in ``order`` among the ``n`` rows of their id; equal rows are numbered too, wherever they lie."""
    placed = numbered(rows.withColumn("tie", F.rand(0)), [F.col(c) for c in [*KEYS, *order, "tie"]], "number")
    of_id = placed.groupBy(*KEYS).agg(F.min("number").alias("least"), F.count("*").alias("n"))
    rank = (F.col("number") - F.col("least") + 1).alias("rank")
    return written(placed.join(of_id, KEYS).select(*rows.columns, rank, "n"), "ranked")


def link_all(calls: DataFrame, results: DataFrame, schemas: dict[str, Schema]) -> DataFrame:
    """``conv_id, call_id, turn, name, position, depth, rank, n_results, status, errors, json`` of every call, and of every result that is not its call's first.

    ``calls``: conv_id, call_id, turn, name, arguments, after. ``results``: conv_id, call_id, turn, content.
    """
    listed = calls.schema["after"].dataType.typeName() == "array"
    after = F.col("after") if listed else F.when(F.col("after").isNotNull(), F.array("after"))
    calls = calls.select("conv_id", "call_id", "turn", "name", "arguments", after.alias("after"))
    results = results.select("conv_id", "call_id", "turn", F.col("content").alias("result"))
    has_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    called = _ranked(calls.where(has_id), ["turn", "arguments", "name", "after"]).withColumnRenamed("n", "n_calls")
    own = called.where("rank = 1")
    answered = _ranked(results.where(has_id), ["turn", "result"]).withColumnRenamed("n", "n_results")
    answers = answered.where("rank = 1").select(*KEYS, "result", "n_results", F.col("turn").alias("result_turn"))
    joined = own.drop("rank").join(answers.hint("shuffle_hash"), KEYS, "full").join(depths(own.select(*KEYS, "after")), KEYS, "left")
    joined = written(joined.withColumn("turn", F.when(F.col("n_calls").isNull(), F.col("result_turn")).otherwise(F.col("turn"))).drop("result_turn"), "linked")
    behind = F.coalesce("depth", F.lit(2**62)).alias("depth")  # calls of a cycle come last
    placed = joined.where("n_calls is not null").select("conv_id", behind, "turn", "call_id")
    placed = numbered(placed, [F.col(c) for c in ("conv_id", "depth", "turn", "call_id")], "number")
    first = placed.groupBy("conv_id").agg(F.min("number").alias("first"))
    position = placed.join(first, "conv_id").select(*KEYS, (F.col("number") - F.col("first")).alias("position"))
    linked = joined.join(position, KEYS, "left").withColumns({"seen": F.lit("own"), "rank": F.lit(1).cast("long")})
    # calls and results that are not the first of their id, and those without one
    extra = called.where("rank > 1").withColumn("seen", F.lit("duplicate_call"))
    seen = F.when(F.col("there"), F.lit("further_result")).otherwise(F.lit("orphan_result")).alias("seen")
    there = own.select(*KEYS, F.lit(True).alias("there"))
    further = answered.where("rank > 1").join(there, KEYS, "left").select(*KEYS, "turn", "result", "rank", "n_results", seen)
    bare = calls.where(~has_id).withColumn("seen", F.lit("no_id"))
    lost = results.where(~has_id).withColumn("seen", F.lit("orphan_result"))
    rows = linked
    for more in (extra, further, bare, lost):
        rows = rows.unionByName(more, allowMissingColumns=True)
    return _finished(rows, schemas, listed)


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, Schema]) -> DataFrame:
    """:func:`link_all` without the further results of calls, which ``n_results`` counts."""
    return link_all(calls, results, schemas).where("status != 'further_result'")


def _finished(rows: DataFrame, schemas: dict[str, Schema], listed: bool = False) -> DataFrame:
    """The rows judged and written as JSON, ``after`` as one id or ``listed``; columns that they lack are null."""
    rows = rows.select(*(F.col(n) if n in rows.columns else F.lit(None).cast(t).alias(n) for n, t in _FIELDS.items()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([_row(r, schemas, listed) for r in batch.to_pylist()], _ROW)

    return rows.mapInArrow(
        run,
        "conv_id long, call_id string, turn long, name string, position long, depth long, rank long, n_results long, status string, errors array<string>, json string",
    )


_FIELDS = {
    "conv_id": "long", "call_id": "string", "turn": "long", "name": "string", "arguments": "string", "after": "array<string>", "n_calls": "long",
    "result": "string", "n_results": "long", "depth": "long", "missing": "boolean", "position": "long", "rank": "long", "seen": "string", "role": "string",
}
_ROW = pa.schema(
    [
        ("conv_id", pa.int64()), ("call_id", pa.string()), ("turn", pa.int64()), ("name", pa.string()), ("position", pa.int64()),
        ("depth", pa.int64()), ("rank", pa.int64()), ("n_results", pa.int64()), ("status", pa.string()), ("errors", pa.list_(pa.string())), ("json", pa.string()),
    ]
)


def _row(row: dict[str, Any], schemas: dict[str, Schema], listed: bool) -> dict[str, Any]:
    errors: list[str] = []
    arguments = None
    is_call = row["n_calls"] is not None
    if is_call or row["seen"] in ("no_id", "duplicate_call"):
        try:
            arguments = parse(row["arguments"] or "")
        except Refused as refused:
            errors = [f"$: {refused}"]
        else:
            schema = schemas.get(row["name"])
            errors = ["$: no such tool"] if schema is None else violations(arguments, schema)
    if row["seen"] != "own":
        status = row["seen"]
    elif not is_call:
        status = "orphan_result"
    elif row["depth"] is None:
        status = "cyclic"
    elif row["missing"]:
        status = "dangling"
    elif errors:
        status = "invalid_arguments"
    else:
        status = "ok" if row["n_results"] else "no_result"
    after = row["after"] if listed or not row["after"] else row["after"][0]
    shown = {k: row[k] for k in ("conv_id", "call_id", "name", "position")} | {
        "after": after,
        "arguments": arguments,
        "result": row["result"],
        "status": status,
    }
    if status == "unlinked":
        shown["role"] = row["role"]
    kept = {k: row[k] for k in ("conv_id", "call_id", "turn", "name", "position", "depth", "rank")}
    return kept | {"n_results": row["n_results"] or 0, "status": status, "errors": errors, "json": canonical(shown)}


# The tools that conversations are read as traffic of.
TOOLS: dict[str, Schema] = {
    name: {
        "type": "object",
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1}},
        "required": ["query", "limit"],
        "additionalProperties": False,
    }
    for name in ("search", "summarise", "translate")
}


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")


def traffic(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read from plain conversations.

    A user turn is a call that asks for its whole text, its tool and its faults picked by a checksum of its text: a tenth states
    the limit as text and a tenth leaves out the query. It builds on the call two turns before. An
    assistant turn is the result of the call one turn before.
    """
    rows = _turns(conversations)

    def named(turn: Column) -> Column:
        return F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"), turn)

    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    pick = F.crc32(text)
    limit = F.to_json(F.struct(F.size(words).alias("limit")))
    as_text = F.to_json(F.struct(text.alias("query"), F.size(words).cast("string").alias("limit")))
    whole = F.to_json(F.struct(text.alias("query"), F.size(words).alias("limit")))
    calls = rows.where("role = 'user'").select(
        "conv_id",
        named(F.col("turn")).alias("call_id"),
        "turn",
        F.element_at(F.array(*(F.lit(t) for t in TOOLS)), (pick % len(TOOLS) + 1).cast("int")).alias("name"),
        F.when(pick % 10 == 0, as_text).when(pick % 10 == 1, limit).otherwise(whole).alias("arguments"),
        F.when(F.col("turn") >= 2, named(F.col("turn") - 2)).alias("after"),
    )
    results = rows.where("role = 'assistant'").select(
        "conv_id", named(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return calls, results


def unlinked(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, result`` of turns that are neither calls nor results; ``result`` is their text."""
    other = ~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))
    return _turns(conversations).where(other).select("conv_id", "turn", "role", F.col("text").alias("result"), F.lit("unlinked").alias("seen"))


def digest(conversations: DataFrame) -> DataFrame:
    """The calls and results of :func:`traffic`, linked."""
    return link_all(*traffic(conversations), TOOLS)


def every_turn(conversations: DataFrame) -> DataFrame:
    """:func:`digest` and the turns of every other or null role, as ``unlinked``."""
    return digest(conversations).unionByName(_finished(unlinked(conversations), TOOLS))
