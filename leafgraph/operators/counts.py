"""What gates and checks count of whole documents, in one pass over the texts: no token, block or element is a row.

A document is read a piece at a time: a piece ends at an empty line behind which nothing is open that the next line could go on
with.  Blocks, elements, what contains what and what overlaps lie inside a piece, and many documents hold equal pieces.  Of a
document as a whole only its link definitions matter: a link by reference is an element if there is one for it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from leafgraph.operators import sweeps
from leafgraph.operators.parser import layer_type, walk
from leafgraph.plans import relations, rules
from leafgraph.session import ship_package

COUNTS = (*sweeps.COUNTS, "n_nodes", "n_instances", "n_crossing")

#: Where a piece may end, and how a line begins that may go on with a list across it.
_CUT = re.compile(r"\n\n(?=\S)")
_MARKERS = "-+*0123456789"
_FRONT_END = re.compile(r"\n---(?=\n|\Z)")

_INLINE = frozenset(("paragraph", "heading", "table", "footnote"))
_DETECTOR = {kind: i for i, kind in enumerate(relations._DETECTORS)}
_MAY_HOLD = {kind: frozenset(children) for kind, (children, _) in rules.NESTING.items() if children}
#: Java's white space and its dot, which stops at other ends of lines too.
_MARKS = re.compile(relations._MARKS.replace(r"\s", r"[ \t\n\x0B\f\r]").replace(".+?", r"[^\n\r\x85\u2028\u2029]+?"))
_TAG = re.compile(r"</?([a-zA-Z0-9]+)")
_EMPHASIS = [(kind, marker, re.compile(f"{relations._ITEM}|{relations._CODE}|{pattern}")) for kind, (marker, pattern) in relations._EMPHASIS.items()]
_BY_REFERENCE = re.compile(r"\]\[([^\]]*)\]\Z")
_LABEL = re.compile(r"\[([^\]]+)\]")
_DEFINED = re.compile(r"\[([^\]]+)\]:")

#: Pieces that a worker keeps, and the characters of the longest.
_KEPT, _KEPT_CHARS = 1 << 13, 1 << 12

#: An element: where it begins, where it ends (negative, as what reaches further comes first), block, detector, type, and the
#: definition that it needs.  In this order they are numbered.
_Element = tuple[int, int, int, int, str, str]


class _Piece:
    """``goes_on``: a leaf is open behind the end; ``holds``: containers are.  ``elements`` are kept if links by reference are among them."""

    __slots__ = ("crossing", "defined", "elements", "goes_on", "holds", "n_elements", "n_nodes")

    def __init__(self, text: str) -> None:
        nodes, leaf, self.holds = walk(text, False)
        self.goes_on = not self.holds and leaf is not None and (leaf.kind == "fence" or leaf.kind == "html_block" and leaf.attrs["end"] is not None)
        starts = [0, *accumulate(len(line) + 1 for line in text.split("\n"))]
        found: list[_Element] = []
        self.defined, self.n_nodes = [], 0
        for block, node in enumerate(nodes):
            at, end = starts[node.first], starts[node.last + 1] - 1
            raw = text[at:end]
            kind = layer_type(node, raw)
            if kind == "definition":
                label = _DEFINED.match(raw)
                self.defined.append(label[1].lower() if label else "")
            elif kind != "list_item":
                self.n_nodes += 1
                found.append((at, -end, block, _DETECTOR[kind], kind, ""))
                if kind in _INLINE:
                    found += _marks(raw, at, block, kind)
                    found += _emphasis(raw, at, block)
        found.sort()
        by_reference = sum(1 for e in found if e[5])
        self.n_elements = len(found) - by_reference
        self.elements = found if by_reference else None
        self.crossing = 0 if by_reference else _crossing(found)


def _marks(raw: str, at: int, block: int, block_type: str) -> Iterator[_Element]:
    for m in _MARKS.finditer(raw):
        hit, definition = m[0], ""
        if hit[0] == "`":
            kind = "inline_code"
        elif hit[0] == "!":
            kind = "figure"
        elif hit[:2] == "[^":
            kind = "footnote_ref"
            if block_type == "footnote" and m.start() == 0:
                continue
        elif hit[0] == "[":
            kind = "link"
            if hit[-1] == "]":
                definition = (_LABEL.match(hit) if hit.endswith("[]") else _BY_REFERENCE.search(hit))[1].lower()
        elif hit.startswith(("<http://", "<https://")):
            kind = "link"
        else:
            kind = "html_inline"
            if _TAG.match(hit)[1].lower() in rules.INLINE_SKIP:
                continue
        yield at + m.start(), -at - m.end(), block, _DETECTOR[kind], kind, definition


def _emphasis(raw: str, at: int, block: int) -> Iterator[_Element]:
    if "*" not in raw and "~~" not in raw:
        return
    body = f"\n{raw}"
    for kind, marker, pattern in _EMPHASIS:
        if marker in raw:
            masked = body.replace("\1", " ").replace("**", "\1\1").replace("\1*", "\1\1") if kind == "italic" else body
            for m in pattern.finditer(masked):
                if m.end() - m.start() > 2 * len(marker) and masked.startswith(marker, m.start()):
                    yield at + m.start() - 1, 1 - at - m.end(), block, _DETECTOR["emphasis"], "emphasis", ""


def _crossing(found: list[_Element]) -> int:
    """The rows of ``span_overlaps``: elements that begin before an earlier one under the same parent ends.

    Tokens tile a text, so the tokens of two elements meet where their characters do.
    """
    above: list[tuple[int, int, int, str]] = []  # what may hold what comes: end, size, number and type
    reach: dict[int, int] = {}
    n = 0
    for ix, (start, back, _, _, kind, _) in enumerate(found):
        end = -back
        while above and above[-1][0] <= start:
            above.pop()
        parent, least = -1, None
        for p_end, size, p_ix, p_kind in reversed(above):
            if p_end >= end and (least is None or size < least) and kind in _MAY_HOLD[p_kind]:
                parent, least = p_ix, size
        if reach.get(parent, start) > start:
            n += 1
        reach[parent] = max(end, reach.get(parent, end))
        if kind in _MAY_HOLD:
            above.append((end, end - start, ix, kind))
    return n


_kept_piece = lru_cache(_KEPT)(_Piece)


def _pieces(text: str) -> Iterator[_Piece]:
    at = 0
    if text.startswith("---\n") and (end := _FRONT_END.search(text, 3)):
        at = end.end() + 1
    bounds = [m.end() for m in _CUT.finditer(text, at)] + [len(text)]
    k, last = 0, len(bounds) - 1
    while at < len(text):
        step = 1
        while True:
            part = text[at : bounds[k]]
            piece = _kept_piece(part) if len(part) <= _KEPT_CHARS else _Piece(part)
            if k == last or not (piece.goes_on or piece.holds and text[bounds[k]] in _MARKERS):
                break
            k, step = min(k + step, last), 2 * step
        yield piece
        at, k = bounds[k], min(k + 1, last)


def count_document(text: str) -> tuple[int, int, int]:
    """Blocks, elements, and elements that cross an earlier one."""
    front = text.startswith("---\n") and _FRONT_END.search(text, 3) is not None
    nodes = elements = int(front)
    crossing, defined, open_ended = 0, set(), []
    for piece in _pieces(text):
        nodes += piece.n_nodes
        elements += piece.n_elements
        crossing += piece.crossing
        defined.update(piece.defined)
        if piece.elements:
            open_ended.append(piece)
    for piece in open_ended:
        found = [e for e in piece.elements if not e[5] or e[5] in defined]
        elements += len(found) - piece.n_elements
        crossing += _crossing(found)
    return nodes, elements, crossing


#: Of ASCII characters: 0 in words, 1 white space, 2 others, each a token by itself.
_ASCII = np.array([0 if chr(c).isalnum() or chr(c) == "_" else 1 if chr(c) in "\t\n\x0b\f\r " else 2 for c in range(128)], np.int8)


def ascii_sizes(text: pa.StringArray) -> pa.ListArray:
    """Sizes of the tokens of texts of ASCII characters alone, negative for white space."""
    text = pc.fill_null(text, "")
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
    width = int(offsets[-1] - offsets[0])
    if not width:
        return pa.array([[]] * len(text), pa.list_(pa.int32()))
    kind = _ASCII[np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    begins = np.ones(width + 1, bool)
    begins[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    begins[offsets - offsets[0]] = True
    at = np.flatnonzero(begins)
    size = np.diff(at)
    size[kind[at[:-1]] == 1] *= -1
    first = np.searchsorted(at, offsets - offsets[0]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(first), pa.array(size.astype(np.int32)))


def _count(batch: pa.RecordBatch, s: sweeps._Swept) -> pa.RecordBatch:
    tokens = sweeps._count(batch, s)
    found = np.array([count_document(text or "") for text in batch.column("text").to_pylist()], np.int64).reshape(-1, 3)
    return pa.record_batch([*tokens.columns, *(pa.array(found[:, k]) for k in range(3))], names=["doc_id", *COUNTS])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents whose tokens Spark has found, and the others with theirs, some at a time."""
    for batch in batches:
        found = pc.is_valid(batch.column("sizes"))
        yield batch.filter(found)
        rest = batch.filter(pc.invert(found))
        held, at = 0, 0
        for i, n in enumerate(pc.fill_null(rest.column("n_chars"), 0).to_pylist()):
            held += n
            if held >= sweeps._AT_ONCE or i + 1 == len(rest):
                part = rest.slice(at, i + 1 - at)
                yield part.set_column(part.schema.get_field_index("sizes"), "sizes", ascii_sizes(part.column("text")))
                held, at = 0, i + 1


def document_counts(documents: DataFrame) -> DataFrame:
    """A row for each text: ``COUNTS``.  Spark cuts texts into tokens where they hold more than ASCII, whose classes are its own."""
    ship_package(documents.sparkSession)
    sizes = sweeps._SIZES.removesuffix(" as sizes")
    found = documents.selectExpr(
        "cast(doc_id as bigint) as doc_id", "text", "length(text) as n_chars", f"case when octet_length(text) > length(text) then {sizes} end as sizes"
    )
    return found.mapInArrow(lambda b: sweeps._swept(_parts(b), _count), f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}")


def step_gates(counts: DataFrame) -> DataFrame:
    """The relation of that name.

    Hierarchy, components, spans and correlations have a row for each instance: their joins look up at most one row, and each
    instance holds characters, so that it has tokens.  A token begins in a component or in none, so coverage adds up.
    """
    rows = {"tokens": "n_tokens", "parse": "n_nodes", "topology": "least(n_instances, 1)"}
    steps = [(step, rows.get(step, "n_instances")) for step, _ in relations.STEPS] + [("coverage", "n_tokens")]
    gates = ", ".join(f"struct({i} as step_ix, '{step}' as step, cast({n} as bigint) as output_rows, {n} > 0 as passed)" for i, (step, n) in enumerate(steps))
    return counts.selectExpr("doc_id", f"inline(array({gates}))").where("step <> 'coverage' or output_rows > 0")


def validation_report(counts: DataFrame, keeps_space: bool) -> DataFrame:
    """The relation of that name.

    Ids are made of the types, and a parent comes before its children and may hold them, so that of the checks of components
    only V2.3 can fail.
    """
    critical = "not_sequential + is_empty + incomplete + overlapping + bad_gaps + n_crossing" + " + apart" * keeps_space
    failures = critical if keeps_space else f"{critical} + blank_gaps"
    return counts.selectExpr("doc_id", f"{failures} = 0 as all_passed", f"{critical} = 0 as critical_passed", f"{failures} as failures")
