"""The two ordered folds of the chunker, as JVM expressions over arrays.

*Sections to groups*: carry headings down the document, start a group where a heading
changes, gather the group's texts and page range. *Texts to chunks*: pack texts greedily,
each new chunk starting with the tail of the one before.

They are written as SQL expressions over named columns. The state an ``aggregate`` carries is
copied at every element, so it must stay small: a fold only marks the positions at which
something begins, as text, and groups and chunks are cut out of the array afterwards. That
keeps the elements out of the state. The marks would grow with the array, so it is cut into segments
of :data:`SEGMENT` elements: a first fold finds the state before each segment, then each
segment is folded from there with marks of its own. The work grows with the length.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from nestweave.functions.text import SQL_WHITESPACE, section_level, section_path

# Default chunk size and overlap, in characters.
CHUNK_MAX = 2000
CHUNK_OVERLAP = 200

GROUP_TYPE = (
    "struct<no:bigint,h1:string,h2:string,h3:string,"
    "pageStart:int,pageEnd:int,rows:bigint,texts:array<string>>"
)
#: Elements of a segment, and segments that are carried on together.
SEGMENT = 256

FOLD_TYPE = "struct<h1:string,h2:string,h3:string,i:int,i1:int,i2:int>"
EFFECT_TYPE = (
    "struct<h1:string,h2:string,h3:string,u1:boolean,u2:boolean,u3:boolean,changes:bigint>"
)
PACK_TYPE = "struct<i:int,size:int,cut:int,body:int,from:int>"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


# Headings of state s after a row r that changes them: h1 stays if the row has none; h2
# stays only if the row has neither h1 nor h2; h3 is always the row's own.
_NEXT_H1 = "if(r.h1 <> '', r.h1, s.h1)"
_NEXT_H2 = "if(r.h1 <> '' OR r.h2 <> '', r.h2, s.h2)"
_NEXT_H3 = "r.h3"

# A row changes the headings if one of its own, not empty, differs from the carried one.
_CHANGED = " OR ".join(f"(r.h{i} <> '' AND NOT r.h{i} <=> s.h{i})" for i in (1, 2, 3))

_DEEPEST = "coalesce(nullif(r.h3, ''), nullif(r.h2, ''), nullif(r.h1, ''))"
_TEXT = "coalesce(r.content, '')"

# The text of a row that changes the headings: below the deepest of them, unless the text
# starts with it already.
_OPENING_TEXT = (
    f"if(startswith(ltrim({SQL_WHITESPACE}, {_TEXT}), {_DEEPEST}),"
    f" {_TEXT}, concat({_DEEPEST}, '\\n', {_TEXT}))"
)

def _in_segments(items: str) -> str:
    """The array as an array of arrays of at most ``SEGMENT`` elements."""
    starts = f"sequence(0, size({items}) - 1, {SEGMENT})"
    return f"if(size({items}) = 0, array(), transform({starts}, k -> slice({items}, k + 1, {SEGMENT})))"


class Fold:
    """A fold over an array that marks elements.

    ``fields`` of the state ``s`` after an element ``r`` are given as two expressions each, where ``marks``
    holds for state and element, and elsewhere; an element marked leaves the ints ``mark``. The names
    ``a`` to ``c``, ``g``, ``k`` and ``m`` belong to the fold, and so does what begins with ``seg``.
    """

    def __init__(self, kind: str, marks: str, fields: dict[str, tuple[str, str]], mark: dict[str, str]):
        self.kind, self.marks, self.fields, self.mark = kind, marks, fields, mark

    def _step(self, more: tuple[str, str] = ("", "")) -> str:
        there, elsewhere = (
            "named_struct(" + ", ".join(f"'{name}', {pair[k]}" for name, pair in self.fields.items()) + more[k] + ")"
            for k in (0, 1)
        )
        return f"(s, r) -> if({self.marks}, {there}, {elsewhere})"

    def _states(self, segments: str, start: str) -> str:
        """The state before each segment. Those found so far are copied at every further one, so
        that they too are gathered a number at a time."""
        none, nones = (f"cast(array() AS {kind})" for kind in (f"array<{self.kind}>", f"array<array<{self.kind}>>"))
        carried = f"aggregate(g, b.state, {self._step()})"
        of_some = f"""aggregate(c, named_struct('state', a.state, 'before', {none}), (b, g) ->
            named_struct('state', {carried}, 'before', concat(b.before, array(b.state))))"""
        more = let("m", of_some, "named_struct('state', m.state, 'before', concat(a.before, array(m.before)))")
        return f"""aggregate({_in_segments(segments)},
            named_struct('state', cast({start} AS {self.kind}), 'before', {nones}), (a, c) -> {more},
            a -> flatten(a.before))"""

    def marked(self, items: str, start: str) -> str:
        """The marks of an array, in order, folded from the state ``start``."""
        text = ", ':', ".join(self.mark.values())
        step = self._step((f", 'marks', concat(s.marks, {text}, ',')", ", 'marks', s.marks"))
        own = ", ".join(f"'{name}', a.{name}" for name in self.fields)
        ints = ", ".join(f"'{n}', cast(split(m, ':')[{k}] AS int)" for k, n in enumerate(self.mark))

        name = items if re.fullmatch(r"[\w.]+", items) else "segitems"

        def parsed(some: str) -> str:
            marks = f"aggregate({some}, named_struct({own}, 'marks', ''), {step}, s -> s.marks)"
            return f"transform(filter(split({marks}, ','), m -> m <> ''), m -> named_struct({ints}))"

        short = let("a", f"cast({start} AS {self.kind})", parsed(name))
        long = f"flatten(zip_with(segs, {self._states('segs', start)}, (g, a) -> {parsed('g')}))"
        long = let("segs", _in_segments(name), long)
        marks = f"if(size({name}) <= {SEGMENT}, {short}, {long})"
        return marks if name == items else let(name, items, marks)

    def end(self, items: str, start: str) -> str:
        """The state after the array."""
        return f"aggregate({items}, cast({start} AS {self.kind}), {self._step()})"


_NO_HEADINGS = "named_struct('h1', null, 'h2', null, 'h3', null, 'changes', 0L)"


# A mark: the row that starts a group, and the rows its h1 and h2 come from, or -1.
_FROM_H1 = "if(r.h1 <> '', s.i, s.i1)"
_FROM_H2 = "if(r.h1 <> '' OR r.h2 <> '', s.i, s.i2)"
_GROUPS = Fold(
    FOLD_TYPE,
    _CHANGED,
    {
        "h1": (_NEXT_H1, "s.h1"),
        "h2": (_NEXT_H2, "s.h2"),
        "h3": (_NEXT_H3, "s.h3"),
        "i": ("s.i + 1", "s.i + 1"),
        "i1": (_FROM_H1, "s.i1"),
        "i2": (_FROM_H2, "s.i2"),
    },
    {"at": "s.i", "i1": _FROM_H1, "i2": _FROM_H2},
)


def fold_sections(rows: str, start: str = _NO_HEADINGS) -> str:
    """Groups of an ordered array of ``(content, h1, h2, h3, pageNumber)`` structs.

    ``start`` has the headings ``h1, h2, h3`` and ``changes`` before the array. A group holds
    its texts, the first and last page that is not null, in order, and its number.
    """
    first = "named_struct('at', 0, 'i1', -1, 'i2', -1)"
    marks = _GROUPS.marked(rows, "struct(o.h1, o.h2, o.h3, 0, -1, -1)")
    begins = f"concat(array({first}), {marks})"
    end = f"coalesce(get(bs, j + 1).at, size({rows}))"
    pages = let(
        "ps",
        "filter(g.pageNumber, p -> p IS NOT NULL)",
        f"""named_struct(
          'no', o.changes + j,
          'h1', if(b.i1 < 0, o.h1, get({rows}, b.i1).h1),
          'h2', if(b.i2 < 0, o.h2, get({rows}, b.i2).h2),
          'h3', if(j = 0, o.h3, get({rows}, b.at).h3),
          'pageStart', get(ps, 0),
          'pageEnd', get(ps, size(ps) - 1),
          'rows', cast(size(g) AS bigint),
          'texts', transform(g, (r, k) -> if(j > 0 AND k = 0, {_OPENING_TEXT}, {_TEXT})))""",
    )
    group = let("g", f"slice({rows}, b.at + 1, {end} - b.at)", pages)
    groups = f"filter(transform(bs, (b, j) -> {group}), g -> g.rows > 0)"
    return let("o", start, let("bs", begins, groups))


def heading_effect(rows: str, start: str) -> str:
    """Headings after an array of ``(h1, h2, h3)`` structs, and the number of changes.

    ``u1`` to ``u3`` of ``start`` say that a carried heading is not known, but differs from
    any it will be compared with; in the result they say that it is still the same.
    """
    changed = " OR ".join(
        f"(r.h{i} <> '' AND (s.u{i} OR NOT r.h{i} <=> s.h{i}))" for i in (1, 2, 3)
    )
    return f"""aggregate({rows}, cast({start} AS {EFFECT_TYPE}), (s, r) -> if({changed},
        named_struct(
          'h1', {_NEXT_H1}, 'h2', {_NEXT_H2}, 'h3', {_NEXT_H3},
          'u1', s.u1 AND NOT coalesce(r.h1 <> '', false),
          'u2', s.u2 AND NOT coalesce(r.h1 <> '' OR r.h2 <> '', false),
          'u3', false,
          'changes', s.changes + 1L),
        s))"""


def pack_texts(
    texts: str,
    max_length: int = CHUNK_MAX,
    overlap: int = CHUNK_OVERLAP,
    drop_empty: bool = False,
    open_texts: str = "0",
    ends: str = "true",
) -> str:
    """Chunk texts of an array of texts.

    A text that would overflow the buffer closes it and starts the next one after the last
    ``overlap`` characters. Texts are never split, so a chunk can exceed ``max_length``, and
    a first text that is too long gives an empty chunk before it, unless ``drop_empty``.
    With ``overlap`` 0 nothing is repeated.

    The first ``open_texts`` texts, 0 or 1, are in the buffer from the start. Where the texts
    do not end with the array (``ends`` is false), the last buffer is only a chunk if it is
    full already.
    """
    max_length, overlap = int(max_length), int(overlap)
    added = "length(r) + 1"
    # A mark: the first text of a new buffer, a text at or before which what it keeps of the
    # old one begins, and how many characters that is.
    kept = f"least(s.size, {overlap})"
    kept_from = f"if(s.body >= {kept}, s.cut, s.from)"
    cutting = Fold(
        PACK_TYPE,
        f"s.size + {added} > {max_length}",
        {
            "i": ("s.i + 1", "s.i + 1"),
            "size": (f"{kept} + {added}", f"s.size + {added}"),
            "cut": ("s.i", "s.cut"),
            "body": (added, f"s.body + {added}"),
            "from": (kept_from, "s.from"),
        },
        {"at": "s.i", "from": kept_from, "kept": kept},
    )
    rest = texts if open_texts == "0" else f"slice({texts}, {open_texts} + 1, size({texts}))"
    opened = f"if({open_texts} = 0, 0, length(get({texts}, 0)) + 1)"
    start = let("n", opened, f"struct({open_texts}, n, 0, n, 0)")
    first = "named_struct('at', 0, 'from', 0, 'kept', 0)"
    cuts = f"concat(array({first}), {cutting.marked(rest, start)})"
    before = f"concat(array_join(slice({texts}, c.from + 1, c.at - c.from), '\\n'), '\\n')"
    body = f"slice({texts}, c.at + 1, coalesce(get(cs, i + 1).at, size({texts})) - c.at)"
    chunk = (
        f"btrim(concat(if(c.kept = 0, '', right({before}, c.kept)), array_join({body}, '\\n')),"
        f" {SQL_WHITESPACE})"
    )
    full = f"{cutting.end(rest, start)}.size >= {max_length}"
    is_chunk = f"i < size(cs) - 1 OR if({ends}, c <> '', {full})"
    if drop_empty:
        is_chunk = f"c <> '' AND ({is_chunk})"
    chunks = f"filter(transform(cs, (c, i) -> {chunk}), (c, i) -> {is_chunk})"
    chunks = let("cs", cuts, chunks)
    if (open_texts, ends) != ("0", "true"):
        return chunks
    # Most groups fit into one chunk, which is then all there is.
    only = f"filter(array(btrim(w, {SQL_WHITESPACE})), c -> c <> '')"
    return let(
        "w", f"array_join({texts}, '\\n')", f"if(length(w) < {max_length}, {only}, {chunks})"
    )


def chunk_struct(content: Column, group: Column) -> Column:
    """A chunk with the headings and the page range of its group."""
    h1, h2, h3 = group["h1"], group["h2"], group["h3"]
    return F.struct(
        content.alias("content"),
        h1.alias("h1"),
        h2.alias("h2"),
        h3.alias("h3"),
        section_path(h1, h2, h3).alias("sectionPath"),
        section_level(h1, h2, h3).alias("sectionLevel"),
        group["pageStart"].alias("pageStart"),
        group["pageEnd"].alias("pageEnd"),
    )


def group_chunks(
    groups: str,
    max_length: int = CHUNK_MAX,
    overlap: int = CHUNK_OVERLAP,
    drop_empty: bool = False,
) -> Column:
    """All chunks of an array column of groups, in order."""
    packed = pack_texts("g.texts", max_length, overlap, drop_empty)
    with_texts = F.expr(f"transform({groups}, g -> struct(g AS group, {packed} AS texts))")
    return F.flatten(
        F.transform(
            with_texts,
            lambda g: F.transform(g["texts"], lambda text: chunk_struct(text, g["group"])),
        )
    )
