"""Reading one captured post-detail payload: a JSON array ``[post listing, comment listing]``.

A comment's ``replies`` is either ``""`` or another listing, so the payload is held as VARIANT. The
first levels are cast in one go to nested structs (a cast that does not fit, such as ``""``, gives
null) and walked level by level; threads that go on below them are walked with ``aggregate``, whose
state is the current level and the comments emitted so far. Everything happens inside the row, so a
walk needs no shuffle and no recursion over datasets, and Catalyst drops it when no comment column
is used.

The JSON parser rejects more than 1,000 nested brackets, and a comment level takes five of them, so
a payload that parses has at most 199 levels: a limit of the data, not a cut-off.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARSER_LEVELS = 200
_STRUCT_LEVELS = 5

_COMMENTS = "array<struct<path:array<int>,author:string,body:string,score:bigint>>"


@dataclass(frozen=True)
class _Kind:
    """What a walk takes from a level of comments, and how levels add up."""

    fields: str
    none: Callable[[], Column]
    emitted: Callable[[Column], Column]
    plus: Callable[[Column, Column], Column]

    def listing(self, levels: int) -> str:
        """Children of a listing with ``levels`` more levels as structs and the rest as VARIANT."""
        replies = f"struct<data:struct<children:{self.listing(levels - 1)}>>" if levels else "variant"
        return f"array<struct<kind:string,data:struct<{self.fields}replies:{replies}>>>"


def readable_threads(payload: Column) -> Column:
    """Array with the payload as VARIANT; empty when the JSON is broken or lacks one of the two listings.

    Meant for ``explode``: behind it the payload is parsed once, however often the result is used.
    """

    def has_both(doc: Column) -> Column:
        title = F.try_variant_get(doc, "$[0].data.children[0].data.title", "variant")
        listing = F.try_variant_get(doc, "$[1].data.children", "variant")
        return title.isNotNull() & listing.isNotNull()

    return F.filter(F.array(F.try_parse_json(payload)), has_both)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: a lambda holds it."""
    return F.transform(F.array(value), use)[0]


def _comments_under(listing: Column, path: Callable[[Column], Column]) -> Column:
    """Comments of a listing; nodes of other kinds go, and with them all that hangs below them."""
    placed = F.transform(
        listing, lambda n, i: F.struct(path(i).alias("path"), n["kind"].alias("kind"), n["data"].alias("data"))
    )
    return F.filter(placed, lambda c: c["kind"] == "t1")


def _children(kind: _Kind, level: Column, listing: Callable[[Column], Column], levels: int) -> Column:
    def replies(parent: Column) -> Column:
        children = F.coalesce(listing(parent["data"]["replies"]), F.array().cast(kind.listing(levels)))
        return _comments_under(children, lambda i: F.array_append(parent["path"], i))

    return F.flatten(F.transform(level, replies))


def _replies_as_structs(replies: Column) -> Column:
    return replies["data"]["children"]


def _emitted(level: Column) -> Column:
    def row(c: Column) -> Column:
        data = c["data"]
        return F.struct(
            c["path"].alias("path"),
            F.coalesce(data["author"], F.lit("")).alias("author"),
            F.coalesce(data["body"], F.lit("")).alias("body"),
            data["score"].alias("score"),
        )

    return F.transform(level, row)


_NODES = _Kind(
    "author:string,body:string,score:bigint,", lambda: F.array().cast(_COMMENTS), _emitted, lambda a, b: F.concat(a, b)
)
_COUNT = _Kind("", lambda: F.lit(0).cast("bigint"), lambda level: F.size(level).cast("bigint"), lambda a, b: a + b)


def _deeper(kind: _Kind, level: Column) -> Column:
    """The next level of one held as VARIANT."""
    as_variant = lambda replies: F.try_variant_get(replies, "$.data.children", kind.listing(0))
    return _children(kind, level, as_variant, 0)


def _walk_deep(kind: _Kind, level: Column) -> Column:
    """What a level held as VARIANT and all levels below it emit."""

    def step(state: Column, _: Column) -> Column:
        seen = kind.plus(state["seen"], kind.emitted(state["level"]))
        deeper = F.struct(_deeper(kind, state["level"]).alias("level"), seen.alias("seen"))
        return F.when(F.size(state["level"]) == 0, state).otherwise(deeper)

    start = F.struct(level.alias("level"), kind.none().alias("seen"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_PARSER_LEVELS)), start, step)["seen"]


def _walk(kind: _Kind, level: Column, levels: int) -> Column:
    """What a level that has ``levels`` more levels as structs, and all levels below it, emit."""

    def found(here: Column) -> Column:
        if levels:
            below = _walk(kind, _children(kind, here, _replies_as_structs, levels - 1), levels - 1)
        else:
            below = _bound(_deeper(kind, here), lambda rest: _if_any(kind, rest, _walk_deep(kind, rest)))
        return _if_any(kind, here, kind.plus(kind.emitted(here), below))

    return _bound(level, found)


def _if_any(kind: _Kind, level: Column, found: Column) -> Column:
    return F.when(F.size(level) > 0, found).otherwise(kind.none())


def _walk_thread(kind: _Kind, thread: Column) -> Column:
    listing = kind.listing(_STRUCT_LEVELS)
    top = F.coalesce(F.try_variant_get(thread, "$[1].data.children", listing), F.array().cast(listing))
    return _walk(kind, _comments_under(top, lambda i: F.array(i)), _STRUCT_LEVELS)


def comment_count(thread: Column) -> Column:
    """The number of comments, from kinds and replies alone."""
    return _walk_thread(_COUNT, thread)


def comment_nodes(thread: Column) -> Column:
    """``array<struct<path, author, body, score>>`` of all comments, level by level.

    ``path`` holds the position of the comment and of its ancestors among their siblings, so sorting
    by it gives reading order and its size is the depth.
    """
    return _walk_thread(_NODES, thread)


def comments_json(nodes: Column) -> Column:
    """Nested ``[{author, body, score, replies: [...]}]`` text of the comments of one post.

    In reading order a comment is followed either by its first reply (one level down) or by a comment
    at its own level or above, which closes the levels in between; depths alone give the brackets.
    """

    def written(ordered: Column, c: Column, i: Column) -> Column:
        depth = F.size(c["path"])
        following = F.coalesce(F.size(F.get(ordered, i + 1)["path"]), F.lit(-1))
        last = following < 0
        closing = F.when(last, depth).when(following > depth, 0).otherwise(depth - following + 1)
        fields = F.to_json(
            F.struct(c["author"].alias("author"), c["body"].alias("body"), c["score"].alias("score")),
            {"ignoreNullFields": "false"},
        )
        return F.concat(
            F.substring(fields, F.lit(1), F.length(fields) - 1),
            F.lit(',"replies":['),
            F.repeat(F.lit("]}"), closing),
            F.when(~last & (following <= depth), ",").otherwise(""),
        )

    def document(ordered: Column) -> Column:
        texts = F.transform(ordered, lambda c, i: written(ordered, c, i))
        return F.concat(F.lit("["), F.array_join(texts, ""), F.lit("]"))

    return _bound(F.array_sort(nodes), document)
