"""JSON path projection (PROJ-1..6, SCAL-1..7).

The reference reads documents with ``payload->'a'->'b'->>'c'`` followed by a
cast. Here a projection is a *spec*: a list of ``(output name, path, type)``.
All paths of one spec are merged into one nested schema whose leaves are
STRING, so the payload is parsed once per row (``from_json``) and each leaf is
then cast under ANSI rules, mirroring ``->>`` (text) followed by ``::type``.

A STRING leaf receives numbers and booleans as their JSON text and nested
objects/arrays as raw JSON text; JSON ``null`` becomes SQL NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Spec = list  # list[tuple[str, tuple[str, ...], str | None]]


def _insert(tree: dict, path: tuple, leaf):
    node = tree
    for p in path[:-1]:
        nxt = node.setdefault(p, {})
        if not isinstance(nxt, dict):
            raise ValueError(f"path {path} goes through a leaf")
        node = nxt
    last = path[-1]
    if last in node and isinstance(node[last], dict) and not isinstance(leaf, dict):
        raise ValueError(f"path {path} is both a leaf and an object")
    node.setdefault(last, leaf)


def _to_struct(tree: dict) -> T.StructType:
    fields = []
    for name, sub in tree.items():
        if isinstance(sub, dict):
            fields.append(T.StructField(name, _to_struct(sub), True))
        else:
            fields.append(T.StructField(name, sub, True))
    return T.StructType(fields)


def leaf_schema(paths, arrays: dict | None = None) -> T.StructType:
    """Nested schema with STRING leaves for ``paths``.

    ``arrays`` maps a path to an element schema (a StructType) or to
    ``("array", element_schema)`` for an array of arrays; those nodes become
    ``ARRAY<elem>`` / ``ARRAY<ARRAY<elem>>`` so unnesting needs no re-parse.
    """
    tree: dict = {}
    for p in paths:
        _insert(tree, tuple(p), T.StringType())
    for p, elem in (arrays or {}).items():
        if isinstance(elem, tuple) and elem[0] == "array":
            dt = T.ArrayType(T.ArrayType(elem[1], True), True)
        else:
            dt = T.ArrayType(elem, True)
        _insert(tree, tuple(p), dt)
    return _to_struct(tree)


def spec_schema(spec: Spec) -> T.StructType:
    return leaf_schema([path for _, path, _ in spec])


def parse_payload(payload, schema: T.StructType) -> Column:
    """One ``from_json`` for the whole document (PERMISSIVE)."""
    c = F.col(payload) if isinstance(payload, str) else payload
    return F.from_json(c, schema, {"mode": "PERMISSIVE"})


def path_col(base: Column, path) -> Column:
    c = base
    for p in path:
        c = c.getField(p)
    return c


def project_spec(parsed: Column, spec: Spec) -> list:
    """Typed columns of ``spec`` read from the parsed struct column."""
    out = []
    for name, path, typ in spec:
        c = path_col(parsed, path)
        out.append((c.cast(typ) if typ else c).alias(name))
    return out


def project(df: DataFrame, payload_col: str, spec: Spec, keep=()) -> DataFrame:
    """PROJ-1..4: parse once, project ``spec`` plus pass-through ``keep``."""
    parsed = df.select(*keep, parse_payload(payload_col, spec_schema(spec)).alias("_doc"))
    return parsed.select(*keep, *project_spec(F.col("_doc"), spec))
