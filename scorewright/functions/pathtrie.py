"""Many JSON paths in one read of a message: a trie compiled into a schema.

The paths of all columns form a trie (keys, indexes, wildcards).  It becomes
one nested ``from_json`` schema, and every path is then read by its place in
the record:

* a key is a struct field (renamed by place, so keys that differ only in case
  stay apart),
* indexes that end a path read an array of texts,
* anything below an index, a wildcard, and a node with keys and indexes is
  read as a variant, since elements of one array may differ in kind where a
  typed array would lose all of them,
* a path that ends where others go on would need both text and structure;
  that one keeps a JSONPath of its own.

As with a JSONPath, a wildcard gives the JSON array of what it matches, the
bare value if that is one, and null if it is nothing.  Differences to
``get_json_object`` on odd input: of a repeated key the last value counts, a
null in an array is null (not the text ``null``); in a variant the text of an
object has its keys sorted, that of a number no trailing zeros but all other
digits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, StringType, StructField, StructType, VariantType

_STEP = re.compile(r"\.([^.\[\]*'\"?]+)|\[(\d+)\]|\[(\*)\]|\['([^'?]+)'\]|\[\"([^\"?]+)\"\]")
STAR = "*"

Step = str | int


def steps(path: str) -> list[tuple[str, Step]] | None:
    """``("key", name)``, ``("at", index)`` and ``("star", "*")`` steps of a
    full JSONPath that starts with a key; None for any other form."""
    out: list[tuple[str, Step]] = []
    at = 1
    while at < len(path):
        m = _STEP.match(path, at)
        if m is None:
            return None
        name, index, star, quoted, double = m.groups()
        if index is not None:
            out.append(("at", int(index)))
        elif star:
            out.append(("star", STAR))
        else:
            out.append(("key", name or quoted or double))
        at = m.end()
    return out if path.startswith("$") and out and out[0][0] == "key" else None


class Node:
    """A place in the messages: what is below it, and the types of the
    columns that end here."""

    def __init__(self) -> None:
        self.keys: dict[str, Node] = {}
        self.items: dict[int, Node] = {}
        self.star: Node | None = None
        self.types: set[DataType] = set()

    def below(self) -> Iterator[Node]:
        yield from self.keys.values()
        yield from self.items.values()
        if self.star is not None:
            yield self.star

    def inner(self) -> bool:
        return bool(self.keys or self.items or self.star)

    def kind(self) -> str:
        if self.star or (self.items and (self.keys or any(n.inner() for n in self.items.values()))):
            return "variant"
        if self.items:
            return "array"
        return "struct" if self.keys else "leaf"


class PathTrie:
    """Add paths, then read: ``schema`` for ``from_json``, ``placed`` to cast
    its result to, and ``read`` for the value of a path."""

    def __init__(self) -> None:
        self.root = Node()

    def add(self, path: list[tuple[str, Step]], target: DataType) -> None:
        node = self.root
        for kind, step in path:
            if kind == "key":
                node = node.keys.setdefault(step, Node())
            elif kind == "at":
                node = node.items.setdefault(step, Node())
            else:
                node.star = node = node.star or Node()
        node.types.add(target)

    def _type(self, node: Node, placed: bool) -> DataType:
        kind = node.kind()
        if kind == "variant":
            return VariantType()
        if kind == "array":
            return ArrayType(StringType())
        if kind == "struct":
            return StructType([StructField(f"k{i}" if placed else key, self._type(child, placed), True)
                               for i, (key, child) in enumerate(node.keys.items())])
        # a place read only as one decimal type is read as that decimal: the
        # reader keeps every digit, where text passes through a double first
        only = next(iter(node.types)) if len(node.types) == 1 else None
        return only if isinstance(only, DecimalType) else StringType()

    @property
    def schema(self) -> StructType:
        return self._type(self.root, placed=False)

    @property
    def placed(self) -> StructType:
        return self._type(self.root, placed=True)

    def nested(self) -> bool:
        """Whether a message can fit the schema in part only."""
        return any(n.inner() for n in self.root.keys.values())

    def decimal(self, path: list[tuple[str, Step]]) -> bool:
        """Whether the reader itself makes this path's value a decimal."""
        node = self._find(path)
        return node is not None and node.kind() == "leaf" and isinstance(self._type(node, False), DecimalType)

    def _find(self, path) -> Node | None:
        """The node of a path that is read by place; None below a variant."""
        node = self.root
        for kind, step in path:
            if node.kind() == "variant" or kind == "star":
                return None
            node = node.keys[step] if kind == "key" else node.items[step]
        return node

    def read(self, record: Column, path: list[tuple[str, Step]]) -> Column | None:
        """The value in a record cast to ``placed``; None for a path that
        ends where others go on.  For a path with a wildcard, the array of
        all that it matches (see :func:`matched_text`)."""
        node, value = self.root, record
        for n, (kind, step) in enumerate(path):
            if node.kind() == "variant":
                return _from_variant(value, path[n:])
            if kind == "key":
                value, node = value.getField(f"k{list(node.keys).index(step)}"), node.keys[step]
            else:
                value, node = F.get(value, F.lit(step)), node.items[step]
        return None if node.inner() else value


def _variant_path(path: list[tuple[str, Step]]) -> str:
    return "$" + "".join(f"[{step}]" if kind == "at" else f"['{step}']" if "'" not in step else f'["{step}"]' for kind, step in path)


def _from_variant(value: Column, path: list[tuple[str, Step]]) -> Column:
    """The text of a path inside a variant; with a wildcard, its matches."""
    stars = [n for n, (kind, _) in enumerate(path) if kind == "star"]
    if not stars:
        return F.try_variant_get(value, _variant_path(path), "string") if path else value.try_cast("string")
    first = stars[0]
    base = F.try_variant_get(value, _variant_path(path[:first]), "variant") if first else value
    return _matches(base.try_cast("array<variant>"), path[first + 1:])


def matched_text(matched: Column) -> Column:
    """The text of a wildcard's matches.  ``matched`` appears four times, so
    pass a column reference: its lambdas are no common subexpressions."""
    # as Hive does: one match stands alone
    return F.when(F.size(matched) > 1, F.to_json(matched)).when(F.size(matched) == 1, F.to_json(F.get(matched, F.lit(0))))


def _matches(elements: Column, rest: list[tuple[str, Step]]) -> Column:
    found = F.transform(elements, lambda e: F.try_variant_get(e, _variant_path(rest), "variant")) if rest else elements
    return F.filter(found, lambda v: v.isNotNull())


def has_star(path: list[tuple[str, Step]]) -> bool:
    return any(kind == "star" for kind, _ in path)


def single_star(path: list[tuple[str, Step]]) -> bool:
    """Whether the trie covers the path's wildcards (one at most)."""
    return sum(kind == "star" for kind, _ in path) <= 1
