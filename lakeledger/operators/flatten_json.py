"""Records with differing nested keys to one flat table of text columns.

The set of columns is data: the union of the leaf paths of all records. It is
found level by level with paths as rows. After that, every record unfolds its
own cells, which are laid over the columns: the plan is as long as the input
is deep, and the work follows the cells, not records times columns.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.functions import unnest
from lakeledger.sources.json import is_object

Path = tuple[str, ...]
# Leaves up to which a plan has an expression for each.
NARROW = 100


@dataclass(frozen=True)
class Leaf:
    path: Path
    # Some records hold an object at this path, which has leaves of its own.
    mixed: bool

    def name(self, sep: str) -> str:
        return sep.join(self.path)


def _json_path(path: Path) -> str:
    def part(key: str) -> str:
        return f'["{key}"]' if "'" in key else f"['{key}']"

    return "$" + "".join(part(key) for key in path)


def _at(record: str | Column, path: Path) -> Column:
    return F.variant_get(record, _json_path(path), "variant") if path else F.col(record)


def _children(text: Column) -> Column:
    """Members of a JSON object in written order: key, JSON text of the value, whether it is an object.

    A repeated key counts once, with its last value. Kinds are looked at only
    where some text could be an object.
    """
    return _let(F.from_json(text, "map<string,string>"), lambda texts: _members(text, texts))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside lambdas nothing else keeps it from being repeated."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _members(text: Column, texts: Column) -> Column:
    keys = F.map_keys(texts)
    plain = F.transform(
        F.map_entries(texts),
        lambda e: F.struct(e["key"].alias("key"), e["value"].alias("text"), F.lit(False).alias("is_object")),
    )
    told = F.arrays_zip(
        keys.alias("key"),
        F.map_values(texts).alias("text"),
        F.transform(
            F.map_values(F.from_json(text, "map<string,variant>")), lambda v: F.coalesce(is_object(v), F.lit(False))
        ).alias("is_object"),
    )
    may_be_object = F.exists(F.map_values(texts), lambda v: v.startswith("{"))
    members = F.when(may_be_object, told).otherwise(plain)
    last = F.filter(members, lambda m, at: ~F.array_contains(F.slice(keys, at + 2, F.size(keys)), m["key"]))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), last).otherwise(members)


def find_leaves(records: DataFrame, order: str = "first_seen") -> list[Leaf]:
    """Leaf paths that some usable record has, by first appearance or by name.

    Paths are rows: each round unfolds the objects of one level and reduces
    (record, path) to different paths, so a plan is as long as the input is
    deep, whatever the number of columns. The driver gets one row per column.
    """
    if order not in ("first_seen", "sorted"):
        raise ValueError("order is 'first_seen' or 'sorted'")
    level = records.filter(~F.col("is_broken")).select(
        "file",
        "block",
        "position",
        F.array().cast("array<string>").alias("path"),
        F.array().cast("array<int>").alias("keys"),
        "text",
    )
    found: list[tuple[tuple, Leaf]] = []
    while True:
        members = unnest(
            level.withColumn("members", _children(F.col("text"))),
            "members",
            ["file", "block", "position", "path", "keys"],
            "m",
        ).select(
            "file",
            "block",
            "position",
            F.array_append("path", F.col("m.key")).alias("path"),
            F.array_append("keys", F.col("pos").cast("int")).alias("keys"),
            F.col("m.text").alias("text"),
            F.col("m.is_object").alias("is_object"),
        )
        where = F.when(~F.col("is_object"), F.struct("file", "block", "position", "keys"))
        paths = (
            members.groupBy("path")
            .agg(F.bool_or("is_object").alias("has_object"), F.min(where).alias("first"))
            .collect()
        )
        for row in paths:
            if row["first"] is not None:
                found.append((tuple(row["first"]), Leaf(tuple(row["path"]), row["has_object"])))
        if not any(row["has_object"] for row in paths):
            break
        level = members.filter("is_object").drop("is_object")
    if order == "sorted":
        return sorted((leaf for _, leaf in found), key=lambda leaf: leaf.path)
    return [leaf for _, leaf in sorted(found, key=lambda s: (s[0], s[1].path))]


def record_cells(records: DataFrame, depth: int, sep: str = "_") -> DataFrame:
    """``records`` with ``cells``: an array of (path, name, text) of the leaves of each record.

    Objects are unfolded inside the row, one level after the other, so the
    plan is as long as the input is deep and the work follows the cells that a
    record has. ``path`` is unambiguous text of the keys (see ``path_text``).
    """
    nothing = F.lit("")
    level = F.array(F.struct(nothing.alias("path"), F.lit(None).cast("string").alias("name"), F.col("text").alias("text"), F.lit(True).alias("is_object")))

    def unfold(entry: Column) -> Column:
        def member(m: Column) -> Column:
            name = F.concat_ws(sep, entry["name"], m["key"])
            path = F.concat(entry["path"], F.length(m["key"]).cast("string"), F.lit(":"), m["key"])
            return F.struct(path.alias("path"), name.alias("name"), m["text"].alias("text"), m["is_object"].alias("is_object"))

        below = F.coalesce(F.transform(_children(entry["text"]), member), F.array().cast(_LEVEL))
        return F.when(entry["is_object"], below).otherwise(F.array(entry))

    found = records.withColumn("cells", level)
    for _ in range(depth):
        found = found.withColumn("cells", F.flatten(F.transform("cells", unfold)))
    leaves = F.filter("cells", lambda c: ~c["is_object"])
    return found.withColumn("cells", F.transform(leaves, lambda c: F.struct(c["path"].alias("path"), c["name"].alias("name"), c["text"].alias("text"))))


_LEVEL = "array<struct<path: string, name: string, text: string, is_object: boolean>>"


def path_text(path: Path) -> str:
    return "".join(f"{len(key)}:{key}" for key in path)


def column_names(leaves: list[Leaf], sep: str = "_", on_collision: str = "raise") -> tuple[list[str], dict[str, int]]:
    """(column names in order, rank of each path whose name other paths have too).

    When two paths give the same name, ``raise`` stops.
    """
    by_name: dict[str, list[Leaf]] = {}
    for leaf in leaves:
        by_name.setdefault(leaf.name(sep), []).append(leaf)
    twice = sorted(name for name, found in by_name.items() if len(found) > 1)
    if twice and on_collision == "raise":
        raise ValueError(f"flattened names collide: {twice}")
    return list(by_name), {path_text(leaf.path): n for name in twice for n, leaf in enumerate(by_name[name])}


def _constant(values: dict, kind: str) -> Column:
    """A map as one literal of the plan, whatever its size."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _named_cells(records: DataFrame, leaves: list[Leaf], sep: str, rank: dict[str, int]) -> DataFrame:
    """``records`` with ``cells``, a map of column name to text. Of paths with one name the last that is not null counts."""
    found = record_cells(records, max((len(leaf.path) for leaf in leaves), default=0), sep)
    if rank:
        ranks = _constant(rank, "map<string,int>")

        def beaten(c: Column) -> Column:
            return F.exists(
                "cells",
                lambda o: (o["name"] == c["name"]) & (ranks[o["path"]] > ranks[c["path"]]) & o["text"].isNotNull(),
            )

        kept = F.filter("cells", lambda c: ranks[c["path"]].isNull() | (c["text"].isNotNull() & ~beaten(c)))
        found = found.withColumn("cells", kept)
    entries = F.transform("cells", lambda c: F.struct(c["name"].alias("key"), c["text"].alias("value")))
    return found.withColumn("cells", F.map_from_entries(entries))


def _schema(paths: list[Path], depth: int = 0) -> T.StructType:
    """Nested type with a text field per path; a path that is also a parent stays text."""
    groups: dict[str, list[Path]] = {}
    for path in paths:
        groups.setdefault(path[depth], []).append(path)
    return T.StructType(
        [
            T.StructField(
                key,
                T.StringType()
                if any(len(path) == depth + 1 for path in below)
                else _schema(below, depth + 1),
            )
            for key, below in groups.items()
        ]
    )


def _with_leaf_values(
    records: DataFrame, leaves: list[Leaf]
) -> tuple[DataFrame, dict[Path, Column]]:
    """(records with their parsed text, value of each leaf in it).

    The parse takes every leaf as text, which keeps numbers and the key order
    of objects in lists as they were written. A path that is an object in some
    records and something else in others has its text parsed on. Each parse is
    a column of its own: fields taken directly from a parse expression would
    make the optimizer repeat it for each of them.
    """
    values: dict[Path, Column] = {}
    todo: list[tuple[Column, list[Leaf], int]] = [(F.col("text"), leaves, 0)]
    for number, (text, part, depth) in enumerate(todo):
        name = f"_parsed_{number}"
        own = {leaf.path: leaf for leaf in part}
        records = records.withColumn(name, F.from_json(text, _schema(list(own), depth)))
        deeper: dict[Path, list[Leaf]] = {}
        for path, leaf in own.items():
            node = F.col(name)
            for length in range(depth + 1, len(path) + 1):
                node = node.getField(path[length - 1])
                shorter = path[:length]
                if shorter != path and shorter in own:
                    if shorter not in deeper:
                        deeper[shorter] = []
                        inner = F.when(is_object(_at("record", shorter)), node)
                        todo.append((inner, deeper[shorter], length))
                    deeper[shorter].append(leaf)
                    break
            else:
                mixed = ~is_object(_at("record", path))
                values[path] = F.when(mixed, node) if leaf.mixed else node
    return records, values


def flatten_records(
    records: DataFrame,
    leaves: list[Leaf],
    sep: str = "_",
    on_collision: str = "raise",
    narrow: int = NARROW,
) -> DataFrame:
    """One text column per leaf; lists as JSON text, missing keys and nulls as null.

    When two paths give the same name, ``raise`` stops and ``last`` keeps the
    later one where a record has both.

    Up to ``narrow`` leaves, one typed parse with an expression per column is
    the fastest plan. Beyond, a record's cells become one flat JSON object,
    which one parse lays out by column: no expression is made for a column.
    Both give the same rows.
    """
    names, rank = column_names(leaves, sep, on_collision)
    if not names:
        return records.select()
    if len(leaves) <= narrow:
        parsed, values = _with_leaf_values(records, leaves)
        columns: dict[str, list[Column]] = {}
        for leaf in leaves:
            columns.setdefault(leaf.name(sep), []).append(values[leaf.path])
        return parsed.select(*[F.coalesce(*reversed(found)).alias(name) for name, found in columns.items()])
    flat = T.StructType([T.StructField(name, T.StringType()) for name in names])
    cells = _named_cells(records, leaves, sep, rank)
    return cells.select(F.from_json(F.to_json("cells"), flat).alias("row")).select("row.*")


def sparse_records(
    records: DataFrame, leaves: list[Leaf], sep: str = "_", on_collision: str = "raise"
) -> DataFrame:
    """The rows of ``flatten_records`` with their filled columns in one map, ``cells``: column name to text.

    For tables whose columns grow with the records: laid out, their empty
    cells would be the product of the two. Here the work follows the filled ones.
    """
    _, rank = column_names(leaves, sep, on_collision)
    cells = _named_cells(records, leaves, sep, rank)
    return cells.select(F.map_filter("cells", lambda _, text: text.isNotNull()).alias("cells"))


# A cell is quoted where it holds one of these (fixed values of the format).
_QUOTED = r'[,"\r\n]'


def _csv_cell(text: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike(_QUOTED), quoted).otherwise(F.coalesce(text, F.lit("")))


def _csv_line(cells: Column, columns: int) -> Column:
    line = F.array_join(F.transform(cells, _csv_cell), ",")
    # A blank line is no record.
    return F.when(line == "", F.lit('""')).otherwise(line) if columns == 1 else line


def csv_lines(
    records: DataFrame, leaves: list[Leaf], sep: str = "_", on_collision: str = "raise"
) -> tuple[str, DataFrame]:
    """(header, one ``line`` of CSV per record, with file, block and position).

    The columns are one literal of the plan: a record's cells are laid over a
    map of all of them, by hash, and come out in their order.
    """
    names, rank = column_names(leaves, sep, on_collision)
    cells = _named_cells(records, leaves, sep, rank)
    every = _constant(dict.fromkeys(names), "map<string,string>")
    row = F.map_values(F.map_zip_with(every, F.col("cells"), lambda _, blank, text: text))
    header = ",".join('"' + n.replace('"', '""') + '"' if re.search(_QUOTED, n) else n for n in names)
    lines = cells.select("file", "block", "position", _csv_line(row, len(names)).alias("line"))
    return header or '""', lines
