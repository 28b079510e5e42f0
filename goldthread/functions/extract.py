"""Reading values at nested paths of documents, many paths per parse.

Paths of one document column are merged into a tree and every document text is parsed once per
tree level, whatever the number of paths. A leaf is read as text, or as VARIANT where its JSON type
matters.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldthread.functions.text import WHITE_SPACE, col, leaf_text, variant_scalar, variant_text

STAGED = "__doc_"
# Documents are strict JSON: a single-quoted string makes the document invalid.
STRICT_JSON = {"allowSingleQuotes": "false"}
#: What a JSON text is put between to see that it is one value.
OPEN, CLOSE = '[{"v":', "}]"


@dataclass
class _Step:
    """One key of the path tree: the targets that end here and the keys below."""

    targets: list[str] = field(default_factory=list)
    below: dict[str, _Step] = field(default_factory=dict)

    def add(self, path: Sequence[str], target: str) -> None:
        step = self
        for key in path:
            step = step.below.setdefault(key, _Step())
        step.targets.append(target)


def extract_paths(
    df: DataFrame,
    targets: Mapping[str, Sequence[str]],
    *,
    keep: Sequence[str] = (),
    parse_embedded: bool = True,
    typed: Collection[str] = (),
    filtered: Collection[str] = (),
) -> DataFrame:
    """Project ``df`` to ``keep`` plus one column per target, read at the target's path.

    The first step names a column exactly (case matters); later steps go through structs, maps,
    variants and JSON text. A missing key, a non-object on the way or an invalid document gives
    null. With ``parse_embedded`` a JSON string met on the way is parsed as well; without it only
    the column itself is a document. JSON values come as text, or as VARIANT for the targets in
    ``typed``; values of typed columns keep their type. Name the targets that later steps filter,
    join or rank on in ``filtered``: see ``once``.
    """
    found: dict[str, Column] = {}
    documents: dict[tuple[str, ...], tuple[Column, _Step]] = {}
    for target, path in targets.items():
        value, dtype, walked = _walk_typed(df, path)
        rest = path[walked:]
        if value is None or (rest and not isinstance(dtype, (T.StringType, T.VariantType))):
            found[target] = F.lit(None).cast("variant" if target in typed else "string")
        elif not rest:
            as_is = target in typed or not isinstance(dtype, T.VariantType)
            found[target] = value if as_is else variant_text(value)
        else:
            text = variant_text(value) if isinstance(dtype, T.VariantType) else value
            documents.setdefault(tuple(path[:walked]), (text, _Step()))[1].add(rest, target)

    staged = df
    pending = [(text, tree) for text, tree in documents.values()]
    count = 0
    while pending:
        parsed: dict[str, Column] = {}
        following: list[tuple[Column, _Step]] = []
        for text, tree in pending:
            layouts = _embedded_layouts(tree, typed) if parse_embedded else _nested_layouts(tree, typed)
            for schema, reads in layouts:
                name = f"{STAGED}{count}"
                count += 1
                parsed[name] = whole_object(text, schema)
                for keys, outcome in reads:
                    value = _at(F.col(name), keys)
                    if isinstance(outcome, _Step):
                        following.append((value, outcome))
                        continue
                    for target in outcome:
                        found[target] = value if target in typed else leaf_text(value, _json_leaf(text, keys))
        staged = staged.withColumns(parsed)
        pending = following
    guarded = [target for target in targets if target in filtered]
    plain = [found[target].alias(target) for target in targets if target not in filtered]
    ready = staged.select(*[col(c) for c in keep], *plain, *once({t: found[t] for t in guarded}))
    return ready.select(*[col(c) for c in (*keep, *targets)]) if guarded else ready


def once(values: Mapping[str, Column]) -> list[Column]:
    """Columns, for one ``select``, that are computed once per row.

    The planner moves a filter on a projected column below the projection and repeats the column's
    expression there, so a filter on a value of a document would parse the document again. It does
    not move a filter below a generator; this one makes one row of one row.
    """
    return [F.stack(F.lit(1), *values.values()).alias(*values)] if values else []


def whole_object(text: Column, schema: T.DataType) -> Column:
    """Text that is one JSON object as a struct, else null.

    The reader stops behind the first value and overlooks what follows. Inside an object in an array nothing may
    follow but their ends, so two objects in a row, or one with a bracket too many, are no object.
    """
    inside = T.ArrayType(T.StructType([T.StructField("v", schema)]))
    return F.get(F.from_json(F.concat(F.lit(OPEN), object_text(text), F.lit(CLOSE)), inside, STRICT_JSON), F.lit(0)).getField("v")


def whole_json(text: Column) -> Column:
    """Text that is one JSON value as VARIANT, else null; see ``whole_object``."""
    # What is neither an object nor an array is one quoted text, or has none of the signs that divide values.
    one = text.rlike(r"^\s*[\[{]") | text.rlike(r'^\s*(?:"(?:[^"\\]|\\.)*"|[^",:{}\[\]]*)\s*$')
    inside = F.try_parse_json(F.concat(F.lit(OPEN), F.when(one, text), F.lit(CLOSE)))
    return F.try_variant_get(inside, "$[0].v", "variant")


def object_text(text: Column) -> Column:
    """Text that may be a JSON object by its first and last character, else null.

    Parsing anything else would throw and catch an exception.
    """
    opens = text.startswith("{") | text.rlike(r"^\s+\{")
    return F.when(opens & F.rtrim(text, F.lit(WHITE_SPACE)).endswith("}"), text)


def _at(value: Column, keys: Sequence[str]) -> Column:
    for key in keys:
        value = value.getField(key)
    return value


def _json_leaf(document: Column, keys: Sequence[str]) -> Column:
    """One leaf of a JSON text as VARIANT, by a parse of its own."""
    return _at(whole_object(document, _leaf_schema(keys)), keys)


def _leaf_schema(keys: Sequence[str]) -> T.DataType:
    schema: T.DataType = T.VariantType()
    for key in reversed(keys):
        schema = T.StructType([T.StructField(key, schema)])
    return schema


def with_json_value(
    df: DataFrame, name: str, document: Column, path: Sequence[str], scalar: bool = True,
) -> DataFrame:
    """Add the text of the value at ``path`` of a JSON text.

    Missing keys and invalid documents give null, and so do objects and arrays unless ``scalar``
    is off. JSON strings met on the way are not parsed.
    """
    staged = f"{STAGED}{name}"
    value = _at(F.col(staged), path)
    text = variant_scalar(value) if scalar else variant_text(value)
    others = [col(c) for c in df.columns if c != name]
    return (df.withColumn(staged, whole_object(document, _leaf_schema(path)))
            .select(*others, *once({name: text})))


def _walk_typed(df: DataFrame, path: Sequence[str]) -> tuple[Column | None, T.DataType | None, int]:
    """Follow ``path`` through columns, structs and maps; stop where the static type ends."""
    dtype: T.DataType = df.schema
    value: Column | None = None
    for walked, key in enumerate(path):
        if isinstance(dtype, T.StructType):
            if key not in dtype.fieldNames():
                return None, None, walked
            value = col(key) if value is None else value.getField(key)
            dtype = dtype[key].dataType
        elif isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
            value = F.try_element_at(value, F.lit(key))
            dtype = dtype.valueType
        else:
            return value, dtype, walked
    return value, dtype, len(path)


def _kinds(step: _Step, typed: Collection[str]) -> list[tuple[T.DataType, list[str]]]:
    """The targets of a leaf by the type they are read as."""
    variants = [t for t in step.targets if t in typed]
    texts = [t for t in step.targets if t not in typed]
    return [(dtype, targets) for dtype, targets in ((T.VariantType(), variants), (T.StringType(), texts)) if targets]


def _embedded_layouts(tree: _Step, typed: Collection[str]):
    """Flat one-level schemas: inner keys as text for the next level, leaves as text or VARIANT."""
    fields: list[tuple[str, T.DataType, object]] = []
    for key, step in tree.below.items():
        if step.below:
            fields.append((key, T.StringType(), step))
        fields.extend((key, dtype, targets) for dtype, targets in _kinds(step, typed))
    # Struct fields are found without regard to case, so keys that differ only by case, or that
    # are read in two ways, go to a parse of their own.
    batches: list[dict[str, tuple[str, T.DataType, object]]] = []
    for entry in fields:
        slot = next((b for b in batches if entry[0].lower() not in b), None)
        if slot is None:
            slot = {}
            batches.append(slot)
        slot[entry[0].lower()] = entry
    for batch in batches:
        schema = T.StructType([T.StructField(key, dtype) for key, dtype, _ in batch.values()])
        yield schema, [([key], outcome) for key, _, outcome in batch.values()]


def _nested_layouts(tree: _Step, typed: Collection[str]):
    """Nested struct schemas: a string where an object is expected gives null."""
    leaves: list[tuple[list[str], T.DataType, list[str]]] = []

    def gather(step: _Step, keys: list[str]) -> None:
        leaves.extend((keys, dtype, targets) for dtype, targets in _kinds(step, typed))
        for key, child in step.below.items():
            gather(child, [*keys, key])

    gather(tree, [])
    batches: list[list[tuple[list[str], T.DataType, list[str]]]] = []
    for leaf in leaves:
        slot = next((b for b in batches if all(_compatible(leaf[0], other) for other, _, _ in b)), None)
        if slot is None:
            batches.append([leaf])
        else:
            slot.append(leaf)
    for batch in batches:
        schema: dict = {}
        for keys, dtype, _ in batch:
            level = schema
            for key in keys[:-1]:
                level = level.setdefault(key, {})
            level[keys[-1]] = dtype
        yield _struct_of(schema), [(keys, targets) for keys, _, targets in batch]


def _compatible(left: Sequence[str], right: Sequence[str]) -> bool:
    """Whether two leaves fit in one schema: neither is above the other, and no keys clash by case."""
    for a, b in zip(left, right):
        if a != b:
            return a.lower() != b.lower()
    return False


def _struct_of(level: dict) -> T.StructType:
    return T.StructType([
        T.StructField(key, _struct_of(below) if isinstance(below, dict) else below) for key, below in level.items()])
