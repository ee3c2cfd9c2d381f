"""Vocabularies and rules that are fixed values of the document model."""

from __future__ import annotations

# Layer types.
LAYER_TYPES = (
    "paragraph list table diagram heading code_block footnote metadata figure blockquote inline_code emphasis link html_block"
    " html_inline task_list horizontal_rule indented_code_block footnote_ref"
).split()

# What may stand directly inside what, and how deep (-1: any depth, 0: a leaf).
INLINE = "inline_code emphasis link html_inline footnote_ref".split()
_BLOCKS = "paragraph list task_list table code_block indented_code_block blockquote figure diagram horizontal_rule".split()
_NESTED = [*_BLOCKS, "heading", *INLINE]
NESTING: dict[str, tuple[list[str], int]] = {
    "heading": ([*_BLOCKS, *INLINE], 1),
    "paragraph": (["figure", "horizontal_rule", *INLINE], 1),
    "list": (_NESTED, -1),
    "table": (_NESTED, 1),
    "blockquote": ([x for x in _NESTED if x != "diagram"] + ["html_block"], -1),
    "footnote": (["paragraph", "figure", "task_list", "horizontal_rule", *INLINE], 1),
    "task_list": (_NESTED, -1),
    "horizontal_rule": ([], 0),
}
LEAVES = "code_block indented_code_block diagram figure metadata inline_code emphasis link html_block html_inline footnote_ref".split()

# Code points that count as white space between tokens.
SPACES = r"\x{9}-\x{d}\x{20}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
TOKEN = rf"[\p{{L}}\p{{N}}\p{{M}}_]+|[{SPACES}]+|[^{SPACES}\p{{L}}\p{{N}}\p{{M}}_]"

# A list item that is a task, and first words of diagrams that name no language.
TASK = r"^\s*(?:[*+-]|[0-9]+[.])\s+\[\s*([xX ])\s*\]\s+(.*)$"
DIAGRAM_WORDS = "graph flowchart sequencediagram digraph gantt".split()

# Languages of diagrams, HTML tags that carry meaning, HTML tags that open blocks, tags that are never inline,
# void tags.
DIAGRAMS = ["mermaid", "graphviz", "plantuml", "dot"]
SEMANTIC_TAGS = "div section article aside nav header footer main figure figcaption details summary".split()
BLOCK_TAGS = (
    "address article aside base basefont blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html iframe legend li link main menu"
    " menuitem nav noframes ol optgroup option p param search section summary table tbody td tfoot th thead title tr track ul"
).split()
INLINE_SKIP = (
    "div section article aside nav header footer main table form ul ol li p blockquote pre details summary figure figcaption"
).split()
VOID_TAGS = "br hr img input meta link".split()


def nesting_pairs() -> list[tuple[str, str]]:
    return [(parent, child) for parent, (children, _) in NESTING.items() for child in children]


def nesting_depths() -> list[tuple[str, int]]:
    return [(parent, depth) for parent, (_, depth) in NESTING.items()] + [(leaf, 0) for leaf in LEAVES]
