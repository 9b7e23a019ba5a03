"""Chat formatting: tool calls linked to their results, ordered, validated, and written as canonical JSON."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.scale import materialise, running_total
from tillwise.llm.tables import discard

KEY = ["conv_id", "call_id"]
NO_CALL = "no call"
KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict,
         "null": type(None)}


def _plain(value):
    """Whole floats become integers, so that equal numbers are written alike."""
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("not a number")
        return int(value) if value == int(value) and abs(value) < 2 ** 53 else value
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def canonical(value) -> str:
    """One text for equal values: sorted keys, no blanks, characters as they are."""
    return json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _is(value, kind: str) -> bool:
    if kind == "integer" and isinstance(value, float):
        return value == int(value) if math.isfinite(value) else False
    return isinstance(value, KINDS[kind]) and not (isinstance(value, bool) and kind in ("integer", "number"))


def problems(value, schema: dict, at: str = "") -> list[str]:
    """Where a value breaks a schema with type, enum, minimum, maximum, properties, required, items and
    additionalProperties."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at or '/'}: type"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at or '/'}: enum")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            found.append(f"{at or '/'}: range")
    if isinstance(value, dict):
        own = schema.get("properties", {})
        found += [f"{at}/{k}: missing" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in own:
                found += problems(v, own[k], f"{at}/{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}/{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            found += problems(v, schema["items"], f"{at}/{i}")
    return sorted(found)


def _written(schemas: dict[str, dict]):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors, texts = [], []
            for r in batch.itertuples():
                wrong = [] if r.note is None else [r.note]
                if r.note is not None and r.note.startswith(NO_CALL):
                    errors.append(r.note)
                    texts.append(canonical({"id": r.call_id, "result": r.content}))
                    continue
                try:
                    arguments = _plain(json.loads(r.arguments or "", parse_constant=lambda _: float("nan")))
                    wrong += problems(arguments, schemas[r.name]) if r.name in schemas else ["unknown tool"]
                except (ValueError, RecursionError):
                    arguments, wrong = r.arguments, [*wrong, "arguments are not JSON"]
                errors.append("; ".join(wrong))
                texts.append(canonical({"id": r.call_id, "name": r.name, "arguments": arguments,
                                        "after": sorted(x for x in (r.after if r.after is not None else []) if x),
                                        "result": r.content}))
            out = batch.drop(columns=["arguments", "after", "content", "note"])
            yield out.assign(errors=errors, json=texts)
    return write


def _ordered(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, call_id, key, depth): sorting by key and depth is a topological order of the references; and the
    calls for which there is none.

    A call stands at its turn, or right behind the last of the calls it refers to if that stands later. Only
    references to later calls move anything, so this ends after as many joins as such references follow one another.
    In a conversation of n calls nothing stands behind n others, so a call that gets deeper is part of a circle, or
    would have to stand behind one; it moves no further and has no order. Other conversations and other calls are not touched by it.
    """
    refs = materialise(calls.select(*KEY, F.explode("after").alias("dep")).where("dep is not null").distinct())
    n = calls.groupBy("conv_id").agg(F.count("*").alias("n"))
    state = materialise(calls.select(*KEY, F.col("turn").alias("key"), F.lit(0).cast("long").alias("depth")).join(n, "conv_id"))
    while True:
        deps = state.select("conv_id", F.col("call_id").alias("dep"), F.struct("key", "depth").alias("_at"))
        last = refs.join(deps, ["conv_id", "dep"]).groupBy(*KEY).agg(F.max("_at").alias("_at"))
        moved = F.coalesce((F.col("_at") >= F.struct("key", "depth")) & (F.col("depth") <= F.col("n")), F.lit(False))
        new = materialise(state.join(last, KEY, "left").select(
            *KEY, F.when(moved, F.col("_at.key")).otherwise(F.col("key")).alias("key"),
            F.when(moved, F.col("_at.depth") + 1).otherwise(F.col("depth")).alias("depth"), "n", moved.alias("moved")))
        discard(state)
        state = new.drop("moved")
        if new.where("moved").isEmpty():
            return state.drop("n"), state.where("depth > n").select(*KEY)


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call, and one for results without a call: conv_id, call_id, position, turn, name, n_results,
    result_turn, errors, json.

    ``calls`` has (conv_id, turn, call_id, name, arguments, after), ``after`` the ids of calls it refers to;
    ``results`` has (conv_id, turn, call_id, content). Calls and results meet in a hash join on (conv_id, call_id); a
    call takes its earliest result. ``position`` counts a conversation's calls from 0 in topological order, by turn
    where the references leave it open. ``errors`` lists what is wrong, empty if nothing is: broken schemas, unknown
    tools or references, no result, repeated ids. ``json`` is canonical.

    Equal rows count once. Of the calls with one id the earliest is the call, the others stand at their turn and get
    no result. References in a circle are named in ``errors`` and the call stands at its turn; chains of any
    length are ordered. Calls without conv_id, call_id or turn are kept without position.
    Extra columns are ignored; empty tables give an empty result. No window or group holds a whole conversation.
    """
    calls = materialise(calls.select(*KEY, "turn", "name", "arguments", "after").distinct())
    complete = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull() & F.col("turn").isNotNull()
    row = F.struct("turn", "name", "arguments", "after")
    first = calls.where(complete).groupBy(*KEY).agg(F.min(row).alias("_first"))
    whole = first.select(*KEY, "_first.*")
    others = (calls.where(complete).join(first, KEY).where(~row.eqNullSafe(F.col("_first"))).select(calls.columns)
              .withColumn("note", F.lit("repeated id")))
    loose = calls.where(~complete).withColumn("note", F.lit("no conversation, id or turn"))

    got = (results.where("conv_id is not null and call_id is not null").distinct().groupBy(*KEY)
           .agg(F.count("*").alias("n_results"), F.min(F.struct("turn", "content")).alias("_result")))
    state, stuck = _ordered(whole)
    known = whole.select("conv_id", F.col("call_id").alias("dep"), F.lit(1).alias("_known"))
    lost = (whole.select(*KEY, F.explode("after").alias("dep")).where("dep is not null")
            .join(known, ["conv_id", "dep"], "left").where("_known is null")
            .groupBy(*KEY).agg(F.lit("unknown reference").alias("_lost")))
    linked = (whole.withColumn("_call", F.lit(1)).join(got, KEY, "full").join(state, KEY, "left").join(lost, KEY, "left")
              .join(stuck.withColumn("_stuck", F.lit("circular reference")), KEY, "left"))
    notes = F.concat_ws("; ", F.when(F.col("_call").isNull(), NO_CALL), F.when(F.col("n_results").isNull(), "no result"),
                        "_lost", "_stuck")
    at = [F.when(F.col("_stuck").isNull(), F.col("key")).otherwise(F.col("turn")).alias("key"),
          F.when(F.col("_stuck").isNull(), F.col("depth")).otherwise(F.lit(0)).alias("depth")]
    columns = [*calls.columns, "n_results", F.col("_result.turn").alias("result_turn"),
               F.col("_result.content").alias("content"), *at, F.when(notes != "", notes).alias("note")]
    linked = linked.select(*columns)
    placed = linked.where("turn is not null").unionByName(
        others.withColumn("key", F.col("turn")).withColumn("depth", F.lit(0)), allowMissingColumns=True)
    lined = running_total(placed.withColumn("_one", F.lit(1)), [F.col(c).asc() for c in (
        "conv_id", "key", "depth", "turn", "call_id", "name", "arguments")], "_one", "_upto")
    begin = lined.groupBy("conv_id").agg(F.min("_upto").alias("_begin"))
    placed = lined.join(begin, "conv_id").withColumn("position", F.col("_upto") - F.col("_begin"))
    rest = linked.where("turn is null").unionByName(loose, allowMissingColumns=True)
    both = placed.unionByName(rest, allowMissingColumns=True).select(
        *KEY, "position", "turn", "name", F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), "result_turn",
        "arguments", "after", "content", "note")
    kind = {f.name: f.dataType.simpleString() for f in both.schema}
    out = [c for c in both.columns if c not in ("arguments", "after", "content", "note")]
    return both.mapInPandas(_written(schemas), ", ".join(f"{c} {kind[c]}" for c in out) + ", errors string, json string")
