"""Edits as array expressions.  An edit that is not allowed leaves its column as it is; ``can_*`` says whether it is.

Items are ``array<struct<item_index, children, ...>>``, rows ``array<struct<row_index, cells: array<struct<col, is_header,
children, ...>>>>``.  Indices count from 0 and stay without gaps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafgraph.functions.components import can_contain


def _column(value: Column | int | str | None) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


# ---- children and spans ----------------------------------------------------------------------------------------------


def can_add_child(children: Column, child_id: Column, parent_type: Column, child_type: Column) -> Column:
    return can_contain(parent_type, child_type) & ~F.array_contains(children, child_id)


def add_child(children: Column, child_id: Column, parent_type: Column, child_type: Column) -> Column:
    allowed = can_add_child(children, child_id, parent_type, child_type)
    return F.when(allowed, F.array_append(children, child_id)).otherwise(children)


def can_remove_child(children: Column, child_id: Column) -> Column:
    return F.array_contains(children, child_id)


def remove_child(children: Column, child_id: Column) -> Column:
    return F.array_remove(children, child_id)


def token_span(start: Column, end: Column) -> Column:
    """An inclusive span; null if it ends before it starts."""
    return F.when(end >= start, F.struct(start.alias("start"), end.alias("end")))


def get_children(component: Column) -> Column:
    return component["children"]


def set_parent(component: Column, parent_id: Column, parent_type: Column) -> Column:
    """The component under another parent, or as it is where the nesting rules forbid that."""
    allowed = can_contain(parent_type, component["layer_type"])
    return F.when(allowed, component.withField("parent_id", parent_id)).otherwise(component)


# ---- fields of one component -----------------------------------------------------------------------------------------


def set_level(heading: Column, level: Column | int) -> Column:
    """The heading with another level, or as it is if that is not from 1 to 6."""
    level = _column(level)
    return F.when(level.between(1, 6), heading.withField("level", level)).otherwise(heading)


def set_language(code_block: Column, language: Column | str | None) -> Column:
    return code_block.withField("language", _column(language))


#: Styles that a component can have.
STYLES = {"horizontal_rule": ("dash", "star", "underscore"), "list": ("ordered", "unordered"), "task_list": ("ordered", "unordered")}


def set_style(component: Column, layer_type: str, style: Column | str) -> Column:
    """A rule, list or task list in another style, or as it is if there is no such style."""
    style = F.lower(_column(style))
    return F.when(style.isin(*STYLES[layer_type]), component.withField("style", style)).otherwise(component)


# ---- lists and task lists --------------------------------------------------------------------------------------------


def reindex(items: Column, field: str = "item_index") -> Column:
    return F.transform(items, lambda x, i: x.withField(field, i))


def add_item(items: Column, item: Column) -> Column:
    return reindex(F.array_append(items, item))


def can_insert_item(items: Column, position: Column | int) -> Column:
    return _column(position).between(0, F.size(items))


def insert_item(items: Column, position: Column | int, item: Column) -> Column:
    position = _column(position)
    at = (F.greatest(F.least(position, F.size(items)), F.lit(0)) + 1).cast("int")
    return F.when(can_insert_item(items, position), reindex(F.array_insert(items, at, item))).otherwise(items)


def has_item(items: Column, index: Column | int) -> Column:
    return F.exists(items, lambda x: x["item_index"] == _column(index))


def get_item(items: Column, index: Column | int) -> Column:
    """The item with that index, or null."""
    return F.try_element_at(F.filter(items, lambda x: x["item_index"] == _column(index)), F.lit(1))


def remove_item(items: Column, index: Column | int) -> Column:
    return reindex(F.filter(items, lambda x: x["item_index"] != _column(index)))


def can_reorder_item(items: Column, first: Column | int, to: Column | int) -> Column:
    return _column(first).between(0, F.size(items) - 1) & _column(to).between(0, F.size(items) - 1)


def reorder_item(items: Column, first: Column | int, to: Column | int) -> Column:
    rest = F.filter(items, lambda x, i: i != _column(first))
    moved = F.array_insert(rest, (F.greatest(F.least(_column(to), F.size(rest)), F.lit(0)) + 1).cast("int"), get_item(items, first))
    return F.when(can_reorder_item(items, first, to), reindex(moved)).otherwise(items)


def _update(items: Column, index: Column | int, change) -> Column:
    return F.transform(items, lambda x: F.when(x["item_index"] == _column(index), change(x)).otherwise(x))


def add_child_to_item(items: Column, index: Column | int, child_id: Column) -> Column:
    """Also nests a sublist into an item."""
    return _update(items, index, lambda x: x.withField("children", F.array_append(F.array_remove(x["children"], child_id), child_id)))


def remove_child_from_item(items: Column, index: Column | int, child_id: Column) -> Column:
    return _update(items, index, lambda x: x.withField("children", F.array_remove(x["children"], child_id)))


def set_item_char_range(items: Column, index: Column | int, start: Column, end: Column) -> Column:
    return _update(items, index, lambda x: x.withField("char_start", start).withField("char_end", end))


def toggle_item(items: Column, index: Column | int) -> Column:
    return _update(items, index, lambda x: x.withField("is_checked", ~x["is_checked"]))


def check_item(items: Column, index: Column | int, checked: bool = True) -> Column:
    return _update(items, index, lambda x: x.withField("is_checked", F.lit(checked)))


def all_children(items: Column) -> Column:
    return F.flatten(F.transform(items, lambda x: x["children"]))


def completion_rate(items: Column) -> Column:
    """Share of checked items; 0 without items."""
    checked = F.size(F.filter(items, lambda x: x["is_checked"]))
    return F.when(F.size(items) > 0, checked / F.size(items)).otherwise(F.lit(0.0))


# ---- tables ----------------------------------------------------------------------------------------------------------


def has_row(rows: Column, index: Column | int) -> Column:
    return F.exists(rows, lambda r: r["row_index"] == _column(index))


def add_row(rows: Column, row: Column) -> Column:
    """Rows stay in the order of their index; a row with an index that is taken is not added."""
    return F.when(has_row(rows, row["row_index"]), rows).otherwise(F.array_sort(F.array_append(rows, row)))


def remove_row(rows: Column, index: Column | int) -> Column:
    return F.filter(rows, lambda r: r["row_index"] != _column(index))


def get_row(rows: Column, index: Column | int) -> Column:
    return F.try_element_at(F.filter(rows, lambda r: r["row_index"] == _column(index)), F.lit(1))


def get_cell(rows: Column, row: Column | int, col: Column | int) -> Column:
    return F.try_element_at(F.filter(get_row(rows, row)["cells"], lambda c: c["col"] == _column(col)), F.lit(1))


def _cells(rows: Column, row: Column | int, change) -> Column:
    return F.transform(rows, lambda r: F.when(r["row_index"] == _column(row), r.withField("cells", change(r["cells"]))).otherwise(r))


def add_cell(rows: Column, row: Column | int, cell: Column) -> Column:
    return _cells(
        rows, row, lambda cells: F.when(F.exists(cells, lambda c: c["col"] == cell["col"]), cells).otherwise(F.array_sort(F.array_append(cells, cell)))
    )


def remove_cell(rows: Column, row: Column | int, col: Column | int) -> Column:
    return _cells(rows, row, lambda cells: F.filter(cells, lambda c: c["col"] != _column(col)))


def add_child_to_cell(rows: Column, row: Column | int, col: Column | int, child_id: Column) -> Column:
    def change(cells: Column) -> Column:
        added = lambda c: c.withField("children", F.array_append(c["children"], child_id))
        return F.transform(cells, lambda c: F.when((c["col"] == _column(col)) & ~F.array_contains(c["children"], child_id), added(c)).otherwise(c))

    return _cells(rows, row, change)


def remove_child_from_cell(rows: Column, row: Column | int, col: Column | int, child_id: Column) -> Column:
    gone = lambda c: c.withField("children", F.array_remove(c["children"], child_id))
    return _cells(rows, row, lambda cells: F.transform(cells, lambda c: F.when(c["col"] == _column(col), gone(c)).otherwise(c)))


def set_header(rows: Column, has_header: bool = True) -> Column:
    """Mark or unmark the cells of the first row."""
    return F.transform(
        rows,
        lambda r, i: F.when(i == 0, r.withField("cells", F.transform(r["cells"], lambda c: c.withField("is_header", F.lit(has_header))))).otherwise(r),
    )


def row_count(rows: Column) -> Column:
    return F.size(rows)


def col_count(rows: Column) -> Column:
    """Cells of the widest row."""
    return F.coalesce(F.array_max(F.transform(rows, lambda r: F.size(r["cells"]))), F.lit(0))


def all_cell_children(rows: Column) -> Column:
    return F.flatten(F.flatten(F.transform(rows, lambda r: F.transform(r["cells"], lambda c: c["children"]))))
