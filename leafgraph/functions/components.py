"""Component builders: a struct column for each layer type, and which fields make it valid."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafgraph.plans.rules import LAYER_TYPES, NESTING

# Fields of each layer type beside the common ones; ``!`` marks those that must not be empty.
FIELDS: dict[str, str] = {
    "heading": "level! text! anchor_id heading_style", "paragraph": "word_count", "code_block": "language has_lines",
    "indented_code_block": "line_count", "blockquote": "quote_level! style attribution", "footnote_ref": "ref_id!",
    "footnote": "footnote_id! label has_url", "metadata": "format keys", "figure": "image_url! alt_text caption width height",
    "diagram": "diagram_type! title", "inline_code": "content! language_hint syntax_category", "emphasis": "emphasis_type marker!",
    "link": "link_type text! url! is_external domain", "html_block": "tag_name! attributes is_semantic",
    "html_inline": "tag_name! attributes is_self_closing", "horizontal_rule": "style length", "table": "rows num_cols has_header",
    "list": "items style", "task_list": "items style",
}

Build = Callable[..., Column]
_builders: dict[str, Build] = {}


def register(layer_type: str, build: Build) -> None:
    """Use another builder for a layer type."""
    if layer_type not in LAYER_TYPES:
        raise KeyError(layer_type)
    _builders[layer_type] = build


def registered() -> list[str]:
    return sorted(_builders)


def has(layer_type: str) -> bool:
    return layer_type in _builders


def builder(layer_type: str) -> Build:
    if layer_type not in _builders:
        raise KeyError(f"no builder for {layer_type!r}; there are {', '.join(registered())}")
    return _builders[layer_type]


def clear() -> None:
    """Forget all builders; ``register_defaults`` brings the library's own back."""
    _builders.clear()


def register_defaults() -> None:
    for layer_type in LAYER_TYPES:
        register(layer_type, _default(layer_type))


def create(
    layer_type: str, raw: Column, start: Column | None = None, end: Column | None = None, ordinal: Column | None = None, identifier: Column | None = None,
    **fields: Column,
) -> Column:
    """A component: ``component_id, layer_type, raw_content, char_start, char_end, children`` and the type's own fields.

    Without an end, or with 0, it ends ``length(raw)`` after its start.  The id is the type and ``identifier``, or else the
    place and ``ordinal``.  Fields that are not given (or null) are derived from the raw text as far as they can be.
    """
    start = F.lit(0) if start is None else start
    length = start + F.length(raw)
    end = length if end is None else F.when(end == 0, length).otherwise(F.coalesce(end, length))
    return builder(layer_type)(raw, start, end, ordinal, identifier=identifier, **fields)


def _first(*values: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v.cast("string"), F.lit("")) for v in values))


def _clipped(value: Column, least: int, most: int) -> Column:
    return F.greatest(F.least(value, F.lit(most)), F.lit(least))


def _heading(raw: Column, name: Column, given: dict[str, Column]) -> dict[str, Column]:
    style = F.coalesce(given["heading_style"].cast("string"), F.lit("atx"))
    setext, marks = style == "setext", F.length(F.regexp_extract(raw, "^#*", 0))
    level = F.when(setext, F.when(F.contains(raw, F.lit("=")), 1).otherwise(2)).otherwise(_clipped(marks, 1, 6))
    text = F.when(setext, F.trim(F.split_part(F.trim(raw), F.lit("\n"), F.lit(1)))).otherwise(F.trim(F.regexp_replace(raw, "^#+", "")))
    return {"heading_style": style, "level": F.coalesce(given["level"], level), "text": _first(F.coalesce(given["text"], text), F.trim(raw))}


def _footnote(raw: Column, name: Column, given: dict[str, Column]) -> dict[str, Column]:
    found = _first(given["footnote_id"], given["label"], F.regexp_extract(raw, r"\[\^?(\w+)\]?", 1), name)
    return {"footnote_id": found, "label": _first(given["label"], found), "has_url": F.coalesce(given["has_url"].cast("boolean"), F.lit(False))}


def _figure(raw: Column, name: Column, given: dict[str, Column]) -> dict[str, Column]:
    image = r"!\[([^\]]*)\]\(([^)]+)\)"
    alt = _first(given["alt_text"], given["caption"], F.regexp_extract(raw, image, 1), F.substring(F.trim(raw), 1, 80))
    return {"image_url": _first(given["image_url"], F.regexp_extract(raw, image, 2), name), "alt_text": alt}


def _diagram(raw: Column, name: Column, given: dict[str, Column]) -> dict[str, Column]:
    lower = F.lower(raw)
    kind = (
        F.when(lower.rlike("mermaid|graph td|graph lr") | raw.contains("sequenceDiagram"), "mermaid")
        .when(lower.rlike(r"digraph|graph \{"), "graphviz").when(raw.rlike("[-+|]"), "ascii").otherwise("unknown")
    )
    return {"diagram_type": _first(given["diagram_type"], kind)}


def _link(raw: Column, name: Column, given: dict[str, Column]) -> dict[str, Column]:
    url = F.coalesce(given["url"].cast("string"), F.lit(""))
    return {
        "link_type": _first(given["link_type"], F.lit("inline")), "text": F.coalesce(given["text"].cast("string"), F.lit("")), "url": url,
        "is_external": F.coalesce(given["is_external"].cast("boolean"), url.startswith("http")),
        "domain": _first(given["domain"], F.regexp_extract(url, "://([^/:]*)", 1)),
    }


def _html(raw: Column, name: Column, given: dict[str, Column]) -> dict[str, Column]:
    attributes = F.coalesce(given["attributes"].cast("map<string,string>"), F.create_map().cast("map<string,string>"))
    return {"tag_name": F.coalesce(given["tag_name"].cast("string"), F.lit("")), "attributes": attributes}


def _lines(raw: Column) -> Column:
    whole = F.regexp_replace(raw, r"\n+$", "")
    return F.when(F.length(raw) > 0, F.size(F.split(whole, "\n", -1))).otherwise(0)


def _flag(name: str) -> Callable[[Column, Column, dict[str, Column]], dict[str, Column]]:
    return lambda raw, _, given: {name: F.coalesce(given[name].cast("boolean"), F.lit(False))}


#: What is derived, by layer type: from the raw text, the component's own name and what is given.
DERIVED: dict[str, Callable[[Column, Column, dict[str, Column]], dict[str, Column]]] = {
    "heading": _heading,
    "paragraph": lambda raw, _, given: {},
    "code_block": _flag("has_lines"),
    "indented_code_block": lambda raw, _, given: {"line_count": F.coalesce(given["line_count"].cast("int"), _lines(raw))},
    "blockquote": lambda raw, _, given: {"quote_level": F.coalesce(given["quote_level"].cast("int"), F.lit(1)), "style": _first(given["style"], F.lit("blockquote"))},
    "footnote_ref": lambda raw, name, given: {"ref_id": _first(given["ref_id"], F.regexp_extract(raw, r"\[\^([^\]]+)\]", 1), name)},
    "footnote": _footnote,
    "metadata": lambda raw, _, given: {
        "format": _first(given["format"], F.lit("yaml")), "keys": F.coalesce(given["keys"].cast("array<string>"), F.array().cast("array<string>"))},
    "figure": _figure,
    "diagram": _diagram,
    "inline_code": lambda raw, _, given: {"content": _first(given["content"], F.regexp_replace(raw, "^`+|`+$", ""))},
    "emphasis": lambda raw, _, given: {"emphasis_type": _first(given["emphasis_type"], F.lit("bold")), "marker": _first(given["marker"], F.lit("**"))},
    "link": _link,
    "html_block": lambda raw, name, given: _html(raw, name, given) | _flag("is_semantic")(raw, name, given),
    "html_inline": lambda raw, name, given: _html(raw, name, given) | _flag("is_self_closing")(raw, name, given),
    "horizontal_rule": lambda raw, _, given: {
        "style": _first(given["style"], rule_style(raw)), "length": F.coalesce(F.nullif(given["length"].cast("int"), F.lit(0)), F.length(F.regexp_replace(raw, r"\s", "")))},
    "table": lambda raw, name, given: {"num_cols": F.coalesce(given["num_cols"].cast("int"), F.lit(0))} | _flag("has_header")(raw, name, given),
    "list": lambda raw, _, given: {"style": _first(given["style"], F.lit("unordered"))},
    "task_list": lambda raw, _, given: {"style": _first(given["style"], F.lit("unordered"))},
}


def _default(layer_type: str) -> Build:
    def build(raw: Column, start: Column, end: Column, ordinal: Column | None = None, identifier: Column | None = None, **fields: Column) -> Column:
        own = [name.rstrip("!") for name in FIELDS[layer_type].split()]
        if unknown := set(fields) - set(own):
            raise ValueError(f"{layer_type} has no field {', '.join(sorted(unknown))}")
        name = F.concat(start.cast("string"), F.lit("-"), end.cast("string")) if identifier is None else identifier.cast("string")
        if ordinal is not None:
            name = F.concat(name, F.lit("_"), ordinal.cast("string"))
        given = {f: fields.get(f, F.lit(None)) for f in own}
        given |= DERIVED[layer_type](raw, name, given)
        return F.struct(
            F.concat(F.lit(layer_type + ":"), name).alias("component_id"), F.lit(layer_type).alias("layer_type"), raw.alias("raw_content"),
            start.alias("char_start"), end.alias("char_end"), F.lit(None).cast("string").alias("parent_id"), F.array().cast("array<string>").alias("children"),
            *(given[f].alias(f) for f in own),
        )

    return build


def is_valid(layer_type: str, component: Column) -> Column:
    """Whether offsets are in order, the id carries the type, and the fields that must be there are."""
    checks = (component["char_end"] >= component["char_start"]) & component["component_id"].startswith(layer_type + ":")
    for name in FIELDS[layer_type].split():
        if name.endswith("!"):
            checks &= F.coalesce(F.length(component[name[:-1]].cast("string")) > 0, F.lit(False))
    if layer_type == "heading":
        checks &= component["level"].between(1, 6)
    return checks


def can_contain(parent_type: Column, child_type: Column) -> Column:
    """Whether the nesting rules allow the pair."""
    allowed = F.create_map(*(x for p, (c, _) in NESTING.items() for x in (F.lit(p), F.array(*map(F.lit, c)).cast("array<string>"))))
    return F.coalesce(F.array_contains(F.element_at(allowed, parent_type), child_type), F.lit(False))


def rule_style(raw: Column) -> Column:
    """Style of a horizontal rule by its first mark."""
    first = F.substring(F.ltrim(raw), 1, 1)
    return F.when(first == "*", "star").when(first == "_", "underscore").otherwise("dash")


def is_image_link(component: Column) -> Column:
    return component["link_type"] == "image"


register_defaults()
