"""Nested values: JSON answers of a model, contracts made from a schema, and expressions made by walking a schema."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from quillmine.functions import text as T

_INTEGERS = {S.ByteType: 8, S.ShortType: 16, S.IntegerType: 32, S.LongType: 64}


# ---- contracts


def type_contract(kind: S.DataType) -> dict[str, Any]:
    """The JSON contract of a type."""
    if isinstance(kind, S.StructType):
        return struct_contract(kind)
    if isinstance(kind, S.ArrayType):
        item = type_contract(kind.elementType)
        return {"type": "array", "items": _nullable(item) if kind.containsNull else item}
    for types, name in (((S.StringType,), "string"), ((S.BooleanType,), "boolean"), (tuple(_INTEGERS), "integer"), ((S.FloatType, S.DoubleType), "number")):
        if isinstance(kind, types):
            return {"type": name}
    raise TypeError(f"no contract for {kind.simpleString()}")


def _nullable(contract: dict[str, Any]) -> dict[str, Any]:
    return contract | {"type": [contract["type"], "null"]}


def struct_contract(kind: S.StructType) -> dict[str, Any]:
    fields = {f.name: _nullable(type_contract(f.dataType)) if f.nullable else type_contract(f.dataType) for f in kind}
    return {"type": "object", "properties": fields, "required": [f.name for f in kind if not f.nullable], "additionalProperties": False}


def observation_schema(section: S.StructType, name: str) -> S.StructType:
    """What a map call returns for a section."""
    item = S.StructType([
        S.StructField("paragraph_index", S.IntegerType(), False), S.StructField("source_quote", S.StringType(), False),
        S.StructField("extraction", S.StructType([S.StructField(name, section, False)]), False), S.StructField("conviction_law_articles", S.ArrayType(S.StringType())),
    ])
    return S.StructType([S.StructField("observations", S.ArrayType(item, False), False)])


# ---- JSON answers


def generated_text(response: Column) -> Column:
    """The text of a model's answer, which is text itself, or JSON: a list whose first item (or an object) has
    generated_text, that being text or messages, of which the last assistant's counts; a message's content is text or pieces."""
    first = F.coalesce(F.get_json_object(response, "$[0].generated_text"), F.get_json_object(response, "$.generated_text"))
    messages = F.from_json(first, "array<struct<role:string,content:string>>")
    said = F.try_element_at(F.filter(messages, lambda m: m["role"] == "assistant"), F.lit(-1))["content"]
    pieces = F.from_json(said, "array<struct<type:string,text:string>>")
    joined = F.array_join(F.transform(F.filter(pieces, lambda p: p["type"] == "text"), lambda p: p["text"]), "")
    return F.coalesce(F.when(F.startswith(said, F.lit("[")), joined), said, first, response)


def json_body(answer: Column) -> Column:
    """The answer without white space around it and without a code fence that encloses all of it."""
    bare = T.strip(answer)
    fence = r"(?is)\A```(?:json)?\s*(.*?)\s*```\z"
    # most answers have no fence, and then no pattern is tried
    return F.when(bare.startswith("```") & bare.rlike(fence), F.regexp_extract(bare, fence, 1)).otherwise(bare)


def _one_value(body: Column) -> Column:
    """Whether a text is one JSON value and nothing behind it."""
    return F.coalesce(F.size(F.try_parse_json(F.concat(F.lit("["), body, F.lit("]"))).cast("array<variant>")) == 1, F.lit(False))


def parsed_object(answer: Column, schema: str, repair: Callable[[str], str | None] | None = None) -> Column:
    """struct(value, error): the object under the schema, or why there is none. A broken text that ends as an object does
    goes through repair first (repair_object if none is given); one that is cut off is never mended.

    Each body is parsed once to judge it: that a text ending in a brace did not go to the repair says that it is sound."""
    plain = json_body(answer)
    mended = repaired_or_empty(plain, repair or repair_object)
    body = F.when(mended.isNull() | (mended == ""), plain).otherwise(mended)
    ends = body.endswith("}")
    valid = F.when(mended == "", F.lit(False)).when(mended.isNull() & ends, F.lit(True)).otherwise(_one_value(body)) & (~body.startswith("{") | ends)
    error = F.when(~valid & ends, F.lit("broken object")).when(~valid, F.lit("not JSON or cut off")).when(~body.startswith("{"), F.lit("not an object"))
    return F.struct(F.when(error.isNull(), F.from_json(body, schema, {"mode": "PERMISSIVE"})).alias("value"), error.alias("error"))


def repair_object(body: str) -> str | None:
    """A small repair for objects that end as one: trailing commas, single quotes around keys, and raw line feeds in strings."""
    if not body.rstrip().endswith("}"):
        return None
    for fix in (lambda s: s, lambda s: re.sub(r",(\s*[}\]])", r"\1", s), lambda s: re.sub(r"'([^'\n]*)'\s*:", r'"\1":', re.sub(r",(\s*[}\]])", r"\1", s))):
        try:
            value = json.loads(fix(body), strict=False)
        except ValueError:
            continue
        return json.dumps(value, ensure_ascii=False) if isinstance(value, dict) else None
    return None


def repaired_or_empty(body: Column, repair=repair_object) -> Column:
    """The repair step of N2: what a broken text that ends with } is mended to, empty if it cannot be; null for all others,
    which don't go through Python."""

    @F.pandas_udf("string")
    def mend(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: repair(t) or "", na_action="ignore")

    return mend(F.when(body.endswith("}") & ~_one_value(body), body))


def repaired(body: Column, repair=repair_object) -> Column:
    """The text mended where it is broken and can be mended, else as it is."""
    mended = repaired_or_empty(body, repair)
    return F.when(mended.isNull() | (mended == ""), body).otherwise(mended)


def text_of_list(value: Column) -> Column:
    """N5 for a text field given as a list: non-blank items, trimmed, joined by `; `; null if none."""
    items = F.filter(F.transform(value, T.strip), lambda x: x.isNotNull() & (x != ""))
    return F.nullif(F.array_join(items, "; "), F.lit(""))


def text_field(raw: Column) -> Column:
    """N5 for a text field as raw JSON: a list of texts is joined, else the text itself."""
    items = F.from_json(F.when(F.startswith(raw, F.lit("[")), raw), "array<string>")
    return F.when(items.isNotNull(), text_of_list(items)).otherwise(raw)


def hoisted(parent: Column, misplaced: Column) -> tuple[Column, Column]:
    """(value, conflict): the parent's own value or the one misplaced below it; a conflict if both are there and differ."""
    conflict = parent.isNotNull() & misplaced.isNotNull() & ~parent.eqNullSafe(misplaced)
    return F.coalesce(parent, misplaced), conflict


def compact_json(value: Column) -> Column:
    """N8 for structs, arrays and maps of any depth, as JSON: without nulls, blank strings and empty containers."""

    @F.pandas_udf("string")
    def compact(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: json.dumps(compacted(json.loads(t)), ensure_ascii=False, sort_keys=True, separators=(",", ":")), na_action="ignore")

    return compact(F.to_json(value))


def compacted(value: Any) -> Any:
    if isinstance(value, dict):
        return {k: v for k, v in ((k, compacted(v)) for k, v in value.items()) if v is not None and v != [] and v != {}}
    if isinstance(value, list):
        return [v for v in map(compacted, value) if v is not None and v != [] and v != {}]
    return None if isinstance(value, str) and not value.strip() else value


# ---- walking a schema


def populated(value: Column, kind: S.DataType) -> Column:
    """F9, shallow: not null; not blank for text; not empty for containers."""
    if isinstance(kind, S.StringType):
        return F.coalesce(T.strip(value) != "", F.lit(False))
    if isinstance(kind, (S.ArrayType, S.MapType)):
        return F.coalesce(F.size(value) > 0, F.lit(False))
    return value.isNotNull()


def has_content(value: Column, kind: S.DataType) -> Column:
    """F9, deep: some leaf is populated."""
    if isinstance(kind, S.StructType):
        parts = [has_content(value[f.name], f.dataType) for f in kind]
        some = parts[0] if parts else F.lit(False)
        for p in parts[1:]:
            some = some | p
        return F.coalesce(value.isNotNull() & some, F.lit(False))
    if isinstance(kind, S.ArrayType):
        return F.coalesce(F.exists(value, lambda x: has_content(x, kind.elementType)), F.lit(False))
    return populated(value, kind)


def leaves(kind: S.StructType, path: str = "") -> list[tuple[str, list[tuple[str, bool]], S.DataType]]:
    """(path, steps as (field, whether its parent is an item of a list), type) of every field at every depth."""
    found = []

    def visit(kind: S.StructType, path: str, steps: list[tuple[str, bool]], listed: bool):
        for f in kind:
            own = [*steps, (f.name, listed)]
            name = f"{path}{'[]' if listed else ''}.{f.name}" if path else f.name
            found.append((name, own, f.dataType))
            if isinstance(f.dataType, S.StructType):
                visit(f.dataType, name, own, False)
            elif isinstance(f.dataType, S.ArrayType) and isinstance(f.dataType.elementType, S.StructType):
                visit(f.dataType.elementType, name, own, True)

    visit(kind, path, [], False)
    return found


def values_at(steps: list[tuple[str, bool]]) -> Column:
    """All values of a field of a row as an array: one for each observed parent."""
    current = F.array(F.col(steps[0][0]))
    for name, listed in steps[1:]:
        parents = F.filter(F.flatten(F.filter(current, lambda x: x.isNotNull())) if listed else current, lambda x: x.isNotNull())
        current = _pick(parents, name)
    return current


def _pick(parents: Column, name: str) -> Column:
    return F.transform(parents, lambda x: x[name])


def population_report(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """For every field of the rows' schema: path, populated, populated_values, observed_values, over all rows. Nested
    values are counted in place; nothing is exploded."""
    names = columns or rows.columns
    fields = leaves(S.StructType([rows.schema[c] for c in names]))
    aggregates = []
    for k, (_, steps, kind) in enumerate(fields):
        values = values_at(steps)
        aggregates += [F.sum(F.size(values)).alias(f"o{k}"), F.sum(F.size(F.filter(values, _is_populated(kind)))).alias(f"p{k}")]
    one = rows.agg(*aggregates)
    each = F.array(*[F.struct(F.lit(path).alias("path"), F.coalesce(f"p{k}", F.lit(0).cast("long")).alias("populated_values"), F.coalesce(f"o{k}", F.lit(0).cast("long")).alias("observed_values")) for k, (path, *_) in enumerate(fields)])
    return one.select(F.inline(each)).withColumn("populated", F.col("populated_values") > 0).orderBy("path")


def _is_populated(kind: S.DataType):
    return lambda x: populated(x, kind)


def merged(current: Column, incoming: Column, kind: S.DataType) -> Column:
    """Null gives way; lists are joined without incoming repeats; structs merge field by field; of two texts the longer
    stays; of other values the current one."""
    both = current.isNotNull() & incoming.isNotNull()
    if isinstance(kind, S.StructType):
        inner = F.struct(*[merged(current[f.name], incoming[f.name], f.dataType).alias(f.name) for f in kind])
    elif isinstance(kind, S.ArrayType):
        inner = F.concat(current, F.array_distinct(F.array_except(incoming, current)))  # U4: repeats inside current stay
    elif isinstance(kind, S.StringType):
        inner = F.when(F.length(incoming) > F.length(current), incoming).otherwise(current)
    else:
        inner = current
    return F.when(both, inner).otherwise(F.coalesce(current, incoming))


def merge_conflicts(current: Column, incoming: Column, kind: S.DataType, path: str) -> Column:
    """Paths at which A9 had to choose."""
    if isinstance(kind, S.StructType):
        parts = [merge_conflicts(current[f.name], incoming[f.name], f.dataType, f"{path}.{f.name}") for f in kind]
        return F.concat(*parts) if parts else F.array().cast("array<string>")
    if isinstance(kind, S.ArrayType):
        return F.array().cast("array<string>")
    clash = current.isNotNull() & incoming.isNotNull() & (current != incoming)
    return F.when(clash, F.array(F.lit(path))).otherwise(F.array().cast("array<string>"))


def merged_all(rows: DataFrame, keys: list[str], order: str, value: str, block: int = 256) -> DataFrame:
    """The fold of all values of a key in the order of a column: keys, value, conflicts (the paths at which values differ,
    sorted). Rows of one order go by the value's own order.

    What a merge keeps does not depend on where a sequence is cut: the longest text and the first other value are the same
    either way, as are lists without repeats. So stretches of `block` orders are folded on their own, in one pass each, and
    then their results, and a key of very many rows is not one task's; order must be a whole number."""
    kind = rows.schema[value].dataType
    part = F.floor(F.col(order) / block)
    firsts = rows.groupBy(*keys, part.alias("_part")).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.col(value).alias("value")))).alias("all"))
    folded = firsts.select(*keys, "_part", fold_values(F.transform("all", lambda x: x["value"]), kind).alias("fold"))
    parts = folded.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_part", "fold"))).alias("all"))
    whole = fold_values(F.transform("all", lambda x: x["fold"]["value"]), kind)
    paths = F.array_sort(F.array_distinct(F.concat(F.flatten(F.transform("all", lambda x: x["fold"]["conflicts"])), F.col("whole.conflicts"))))
    return parts.withColumn("whole", whole).select(*keys, F.col("whole.value").alias(value), paths.alias("conflicts"))


def fold_values(values: Column, kind: S.DataType) -> Column:
    """value and conflicts (distinct paths) of an array's values merged from first to last."""
    empty = F.array().cast("array<string>")
    start = F.struct(F.lit(None).cast(kind).alias("value"), empty.alias("conflicts"))
    step = lambda s, x: F.struct(merged(s["value"], x, kind).alias("value"), F.array_union(s["conflicts"], F.coalesce(merge_conflicts(s["value"], x, kind, "$"), empty)).alias("conflicts"))
    return F.aggregate(values, start, step)


def paragraph_indexes(value: Column, kind: S.StructType) -> Column:
    """A10: the distinct paragraph_index values at any depth, ascending."""

    def collect(value: Column, kind: S.DataType) -> list[Column]:
        if isinstance(kind, S.StructType):
            own = [F.when(value.isNotNull(), F.array(value[f.name].cast("int"))).otherwise(F.array().cast("array<int>")) for f in kind if f.name == "paragraph_index" and isinstance(f.dataType, tuple(_INTEGERS))]
            return own + [c for f in kind for c in collect(value[f.name], f.dataType)]
        if isinstance(kind, S.ArrayType) and isinstance(kind.elementType, S.StructType):
            per_item = lambda x: F.concat(F.array().cast("array<int>"), *[F.coalesce(c, F.array().cast("array<int>")) for c in collect(x, kind.elementType)])
            return [F.coalesce(F.flatten(F.transform(value, per_item)), F.array().cast("array<int>"))]
        return []

    found = F.concat(F.array().cast("array<int>"), *[F.coalesce(c, F.array().cast("array<int>")) for c in collect(value, kind)])
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull())))


CITATION = "array<struct<path:string,paragraph_index:int,source_quote:string>>"


def citations(value: Column, kind: S.DataType, path: Column) -> Column:
    """Every record with a paragraph_index at any depth of a value, in the order of the schema, with its path and quote
    (null where the record has no such field)."""
    none = F.array().cast(CITATION)

    def walk(value: Column, kind: S.DataType, path: Column) -> Column:
        if isinstance(kind, S.StructType):
            parts = []
            if "paragraph_index" in kind.names:
                quote = value["source_quote"].cast("string") if "source_quote" in kind.names else F.lit(None).cast("string")
                parts.append(F.array(F.struct(path.alias("path"), value["paragraph_index"].cast("int").alias("paragraph_index"), quote.alias("source_quote"))))
            parts += [walk(value[f.name], f.dataType, F.concat(path, F.lit(f".{f.name}"))) for f in kind if isinstance(f.dataType, (S.StructType, S.ArrayType))]
            return F.when(value.isNotNull(), F.concat(none, *parts)).otherwise(none)
        if isinstance(kind, S.ArrayType) and isinstance(kind.elementType, (S.StructType, S.ArrayType)):
            items = F.transform(value, lambda x, i: walk(x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
            return F.coalesce(F.flatten(items), none)
        return none

    return walk(value, kind, path)


def at_path(value: Column, kind: S.DataType, path: str) -> tuple[Column, S.DataType]:
    """The field at a dotted path of a struct, and its type; null where a parent is null. An unknown name is an error."""
    for name in path.split("."):
        if not isinstance(kind, S.StructType) or name not in kind.names:
            raise KeyError(f"no field {name!r} on the way to {path!r}")
        value, kind = value[name], kind[name].dataType
    return value, kind


def has_equal(value: Column, kind: S.DataType, field: str, wanted: Column) -> Column:
    """Whether some field of that name at any depth equals the wanted text."""
    if isinstance(kind, S.StructType):
        hit = F.lit(False)
        for f in kind:
            if f.name == field and not isinstance(f.dataType, (S.StructType, S.ArrayType, S.MapType)):
                hit = hit | F.coalesce(value[f.name].cast("string") == wanted, F.lit(False))
            else:
                hit = hit | has_equal(value[f.name], f.dataType, field, wanted)
        return F.coalesce(value.isNotNull() & hit, F.lit(False))
    if isinstance(kind, S.ArrayType) and isinstance(kind.elementType, (S.StructType, S.ArrayType)):
        return F.coalesce(F.exists(value, lambda x: has_equal(x, kind.elementType, field, wanted)), F.lit(False))
    return F.lit(False)


# ---- validation of JSON text against a schema


def normalized(value: Any, kind: S.DataType, nullable: bool, path: str) -> Any:
    """N5 over plain values: missing nullable fields become null, unknown keys of objects go, lists for texts are joined."""
    if value is None:
        if not nullable:
            raise ValueError(f"{path} cannot be null")
        return None
    if isinstance(kind, S.StructType):
        if not isinstance(value, dict):
            raise TypeError(f"{path} must be an object")
        out = {}
        for f in kind:
            if f.name not in value and not f.nullable:
                raise ValueError(f"{path}.{f.name} is required")
            out[f.name] = normalized(value.get(f.name), f.dataType, True if f.name not in value else f.nullable, f"{path}.{f.name}")
        return out
    if isinstance(kind, S.ArrayType):
        if not isinstance(value, list):
            raise TypeError(f"{path} must be a list")
        return [normalized(x, kind.elementType, kind.containsNull, f"{path}[{k}]") for k, x in enumerate(value)]
    if isinstance(kind, S.StringType) and isinstance(value, list) and all(x is None or isinstance(x, str) for x in value):
        return "; ".join(x.strip() for x in value if x and x.strip()) or None
    return value


def violations(value: Any, kind: S.DataType, nullable: bool, path: str) -> list[str]:
    """What in a plain value breaks the schema, with paths."""
    if value is None:
        return [] if nullable else [f"{path} cannot be null"]
    if isinstance(kind, S.StructType):
        if not isinstance(value, dict):
            return [f"{path} must be an object"]
        names = {f.name for f in kind}
        wrong = [f"{path} has unexpected fields: {sorted(set(value) - names)}"] if set(value) - names else []
        wrong += [f"{path}.{n} is missing" for n in sorted(names - set(value))]
        return wrong + [e for f in kind if f.name in value for e in violations(value[f.name], f.dataType, f.nullable, f"{path}.{f.name}")]
    if isinstance(kind, S.ArrayType):
        if not isinstance(value, list):
            return [f"{path} must be a list"]
        return [e for k, x in enumerate(value) for e in violations(x, kind.elementType, kind.containsNull, f"{path}[{k}]")]
    if isinstance(kind, S.StringType):
        return [] if isinstance(value, str) else [f"{path} must be a string"]
    if isinstance(kind, S.BooleanType):
        return [] if isinstance(value, bool) else [f"{path} must be a boolean"]
    bits = _INTEGERS.get(type(kind))
    if bits:
        if not isinstance(value, int) or isinstance(value, bool):
            return [f"{path} must be an integer"]
        return [] if -(1 << bits - 1) <= value < 1 << bits - 1 else [f"{path} is out of range"]
    if isinstance(kind, (S.FloatType, S.DoubleType)):
        return [] if isinstance(value, (int, float)) and not isinstance(value, bool) else [f"{path} must be a number"]
    raise TypeError(f"no check for {kind.simpleString()}")


def checked_payload(body: Column, schema: S.StructType) -> Column:
    """struct(payload JSON, errors) of a JSON object: unknown top-level fields are an error, then N5, then N4."""

    @F.pandas_udf("payload string, errors array<string>")
    def check(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            try:
                value = json.loads(t) if t is not None else None
                if not isinstance(value, dict):
                    raise TypeError("the payload must be an object")
                unknown = set(value) - set(schema.names)
                if unknown:
                    raise ValueError(f"unexpected fields: {sorted(unknown)}")
                value = normalized(value, schema, False, "payload")
                errors = violations(value, schema, False, "payload")
                out.append((json.dumps(value, ensure_ascii=False), errors))
            except (TypeError, ValueError) as error:
                out.append((None, [str(error)]))
        return pd.DataFrame(out, columns=["payload", "errors"])

    return check(body)
