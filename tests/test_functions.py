"""Positions, builders, edits, loaders and streams."""

import pandas as pd
import pytest
from leafgraph.config import TopologyConfig, load_config
from leafgraph.functions import components, edits, models, positions
from leafgraph.sources import load_documents, validate_documents
from leafgraph.sources.files import text_length
from leafgraph.streaming import stream_documents, token_counts, write_relations
from pyspark.sql import functions as F

TEXT = "ab\ncdé\n\nf"


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_positions(spark):
    t = F.lit(TEXT)
    assert [value(spark, positions.line_to_char_offset(t, n)) for n in (0, 1, 2, 3, 4, 5)] == [0, 0, 3, 7, 8, 9]
    assert tuple(value(spark, positions.line_range(t, 2))) == (3, 6)
    assert tuple(value(spark, positions.line_range(t, 2, "x"))) == (3, 4)
    assert tuple(value(spark, positions.line_range(t, 9))) == (9, 9)
    assert tuple(value(spark, positions.line_segment_range(t, 2, 1, 2))) == (4, 5)
    assert value(spark, positions.line_col_to_char_offset(t, 2, 2)) == 5
    assert [value(spark, positions.char_offset_to_line(t, n)) for n in (-1, 0, 2, 3, 8)] == [0, 0, 0, 1, 3]


def test_cosine(spark):
    a, b = F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0))
    assert abs(value(spark, positions.cosine(a, b)) - 0.5**0.5) < 1e-12
    assert value(spark, positions.cosine(a, F.array(F.lit(0.0), F.lit(0.0)))) == 0.0


def test_numeric_ids(spark):
    assert [value(spark, positions.numeric_id(F.lit(x))) for x in ("T5", "token_12", "7", "x1", "T")] == [5, 12, 7, None, None]


def test_builders(spark):
    made = components.create("heading", F.lit("# T"), F.lit(0), F.lit(3), level=F.lit(1), text=F.lit("T"))
    assert value(spark, made).component_id == "heading:0-3" and value(spark, components.is_valid("heading", made))
    assert not value(spark, components.is_valid("link", components.create("link", F.lit("x"), F.lit(0), F.lit(1))))
    assert len(components.registered()) == 19
    with pytest.raises(ValueError):
        components.create("table", F.lit(""), F.lit(0), F.lit(0), level=F.lit(1))
    with pytest.raises(KeyError):
        components.register("sentence", lambda *a: None)
    assert [value(spark, components.rule_style(F.lit(x))) for x in ("***", " ___", "---")] == ["star", "underscore", "dash"]


def test_children(spark):
    c = F.array(F.lit("a"))
    para, link, table = F.lit("paragraph"), F.lit("link"), F.lit("table")
    assert value(spark, edits.add_child(c, F.lit("b"), para, link)) == ["a", "b"]
    assert value(spark, edits.add_child(c, F.lit("b"), para, table)) == ["a"]
    assert value(spark, edits.add_child(c, F.lit("a"), para, link)) == ["a"]
    assert value(spark, edits.remove_child(c, F.lit("a"))) == []
    assert value(spark, edits.token_span(F.lit(3), F.lit(2))) is None


def items(n):
    return F.expr(
        f"transform(sequence(0, {n - 1}), i -> named_struct('item_index', i, 'children', array(concat('c', i)), 'is_checked', i = 1, 'char_start', 0, 'char_end', 0))"
    )


def test_items(spark):
    def names(column):
        return [(x.item_index, x.children) for x in value(spark, column)]

    new = F.expr("named_struct('item_index', 9, 'children', array('n'), 'is_checked', false, 'char_start', 0, 'char_end', 0)")
    assert names(edits.add_item(items(2), new)) == [(0, ["c0"]), (1, ["c1"]), (2, ["n"])]
    assert names(edits.insert_item(items(2), 0, new)) == [(0, ["n"]), (1, ["c0"]), (2, ["c1"])]
    assert names(edits.insert_item(items(2), 5, new)) == [(0, ["c0"]), (1, ["c1"])]
    assert names(edits.remove_item(items(3), 1)) == [(0, ["c0"]), (1, ["c2"])]
    assert names(edits.reorder_item(items(3), 0, 2)) == [(0, ["c1"]), (1, ["c2"]), (2, ["c0"])]
    assert names(edits.reorder_item(items(3), 0, 3)) == [(0, ["c0"]), (1, ["c1"]), (2, ["c2"])]
    assert names(edits.add_child_to_item(items(1), 0, F.lit("z"))) == [(0, ["c0", "z"])]
    assert names(edits.remove_child_from_item(items(1), 0, F.lit("c0"))) == [(0, [])]
    assert value(spark, edits.get_item(items(2), 7)) is None and value(spark, edits.all_children(items(2))) == ["c0", "c1"]
    assert [x.is_checked for x in value(spark, edits.toggle_item(items(2), 0))] == [True, True]
    assert value(spark, edits.completion_rate(items(2))) == 0.5


def test_tables(spark):
    grid = F.expr(
        "transform(sequence(0, 1), r -> named_struct('row_index', r, 'cells', transform(sequence(0, 1), c -> named_struct('col', c, 'is_header', false,"
        " 'children', array(concat(r, c))))))"
    )
    assert value(spark, edits.get_cell(grid, 1, 0)).children == ["10"]
    assert [c.is_header for r in value(spark, edits.set_header(grid)) for c in r.cells] == [True, True, False, False]
    assert value(spark, edits.row_count(edits.remove_row(grid, 0))) == 1
    assert value(spark, edits.col_count(edits.remove_cell(edits.remove_row(grid, 0), 1, 0))) == 1
    assert value(spark, edits.all_cell_children(edits.add_child_to_cell(grid, 0, 0, F.lit("n")))) == ["00", "n", "01", "10", "11"]
    assert value(spark, edits.all_cell_children(edits.remove_child_from_cell(grid, 0, 0, F.lit("00")))) == ["01", "10", "11"]
    assert value(spark, edits.row_count(edits.add_row(grid, edits.get_row(grid, 1)))) == 2


def test_files(spark, tmp_path):
    (tmp_path / "a.md").write_bytes(b"\xef\xbb\xbf# T\n")
    (tmp_path / "b.md").write_text(" \n")
    docs = load_documents(spark, str(tmp_path))
    assert sorted(r.text for r in docs.collect()) == [" \n", "# T\n"]
    assert sorted(r.rejected for r in validate_documents(docs).collect()) == [False, True]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_documents(spark, str(tmp_path / "none"))


def test_stream(spark, tmp_path):
    spark.createDataFrame([(1, "# T\n\nab cd"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "in"))
    stream = stream_documents(spark, str(tmp_path / "in"))
    query = write_relations(stream, ["nodes"], str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out" / "nodes")).count() == 2
    counted = token_counts(spark.read.parquet(str(tmp_path / "in")))
    assert sorted(tuple(r) for r in counted.collect()) == [(1, 7, 4), (2, 0, 0)]


def test_derived_fields(spark):
    def made(layer_type, raw, **fields):
        return value(spark, components.create(layer_type, F.lit(raw), identifier=F.lit("x1"), **fields))

    h = made("heading", "### Deep")
    assert (h.component_id, h.level, h.text, h.heading_style, h.char_end) == ("heading:x1", 3, "Deep", "atx", 8)
    h = made("heading", "Big\n===", heading_style=F.lit("setext"))
    assert (h.level, h.text) == (1, "Big") and made("heading", "###").text == "###" and made("heading", "plain").level == 1
    assert (made("footnote", "[^n1]: x").footnote_id, made("footnote", "x").footnote_id, made("footnote", "x", label=F.lit("L")).label) == ("n1", "x1", "L")
    f = made("figure", "![Alt](img.png)")
    assert (f.image_url, f.alt_text) == ("img.png", "Alt") and made("figure", "text").image_url == "x1" and made("figure", "y" * 100).alt_text == "y" * 80
    kinds = [made("diagram", raw).diagram_type for raw in ("Graph TD", "sequenceDiagram", "digraph {", "graph { a }", "+-+", "words")]
    assert kinds == ["mermaid", "mermaid", "graphviz", "graphviz", "ascii", "unknown"]
    assert made("inline_code", "``a`b``").content == "a`b" and made("footnote_ref", "see [^q]").ref_id == "q" and made("footnote_ref", "z").ref_id == "x1"
    assert (made("emphasis", "**b**").emphasis_type, made("emphasis", "**b**").marker) == ("bold", "**")
    link = made("link", "[a](https://b.org/c)", url=F.lit("https://b.org:8/c"))
    assert (link.link_type, link.is_external, link.domain) == ("inline", True, "b.org")
    rule = made("horizontal_rule", " * * *")
    assert (rule.style, rule.length) == ("star", 3) and made("horizontal_rule", "").style == "dash"
    assert [made("indented_code_block", raw).line_count for raw in ("    a\n    b\n", "    a", "")] == [2, 1, 0]
    assert (made("blockquote", "> q").quote_level, made("blockquote", "> q").style) == (1, "blockquote")
    assert (made("metadata", "---").format, made("metadata", "---").keys) == ("yaml", [])
    assert made("html_block", "<div>").attributes == {} and made("html_inline", "<b>").is_self_closing is False and made("html_block", "x").is_semantic is False
    assert made("list", "- a").style == made("task_list", "- [ ] a").style == "unordered" and made("code_block", "x").has_lines is False
    assert (made("table", "| a |").num_cols, made("table", "| a |").has_header) == (0, False) and made("paragraph", "p").char_end == 1


def test_registry():
    assert components.has("table")
    components.clear()
    try:
        assert not components.has("table") and components.registered() == []
        with pytest.raises(KeyError):
            components.builder("table")
    finally:
        components.register_defaults()
    assert len(components.registered()) == 19


def test_setters(spark):
    heading = components.create("heading", F.lit("# T"))
    assert value(spark, edits.set_level(heading, 4)).level == 4 and value(spark, edits.set_level(heading, 9)).level == 1
    assert value(spark, edits.set_language(components.create("code_block", F.lit("x")), "py")).language == "py"
    rule = components.create("horizontal_rule", F.lit("---"))
    assert value(spark, edits.set_style(rule, "horizontal_rule", "STAR")).style == "star" and value(spark, edits.set_style(rule, "horizontal_rule", "wavy")).style == "dash"
    assert value(spark, edits.set_style(components.create("list", F.lit("- a")), "list", "ordered")).style == "ordered"
    link = components.create("link", F.lit("[a](b)"))
    assert value(spark, edits.set_parent(link, F.lit("paragraph:1"), F.lit("paragraph"))).parent_id == "paragraph:1"
    assert value(spark, edits.set_parent(link, F.lit("code_block:1"), F.lit("code_block"))).parent_id is None
    assert value(spark, edits.get_children(link)) == [] and value(spark, components.is_image_link(components.create("link", F.lit("x"), link_type=F.lit("image"))))
    span = edits.token_span(F.lit(1), F.lit(2))
    assert tuple(value(spark, positions.token_range(span))) == (1, 2)
    with pytest.raises(Exception, match="no token span"):
        value(spark, positions.token_range(edits.token_span(F.lit(3), F.lit(2))))


def test_columns_of_a_model(spark):
    tokens = spark.createDataFrame([(1, "Cats"), (2, "ran")], "token_ix int, text string")
    assert [tuple(r) for r in models.with_model_columns(tokens).collect()] == [(1, "Cats", None, None, None), (2, "ran", None, None, None)]
    known = models.with_model_columns(tokens, lambda texts: pd.DataFrame({"lemma": texts.str.lower(), "pos": "X"}))
    assert [(r.lemma, r.pos, r.ner_label) for r in known.collect()] == [("cats", "X", None), ("ran", "X", None)]
    assert [r.lemma for r in models.with_model_columns(tokens, lambda texts: 1 / 0).collect()] == [None, None]


def test_settings(tmp_path):
    assert load_config(str(_written(tmp_path / "a.json", '{"topology": {"nesting_depth_limit": 3, "layer_types_to_detect": ["table"]}}'))).topology == TopologyConfig(("table",), 3)
    got = load_config(str(_written(tmp_path / "a.toml", '[correlation]\nproximity = 20\n[tokenization]\ninclude_whitespace = true\n')))
    assert got.correlation.proximity == 20 and got.tokenization.include_whitespace and got.as_dict()["semantic"]["segmentation_threshold_words"] == 150
    for bad in ('{"topology": {"nesting_depth_limit": 0}}', '{"colour": 1}', '{"semantic": {"segmentation_threshold_words": 10}}', '{"correlation": {"vectors": "x"}}'):
        with pytest.raises(ValueError):
            load_config(str(_written(tmp_path / "b.json", bad)))


def _written(path, text):
    path.write_text(text)
    return path


def test_length_of_a_text(spark):
    assert [value(spark, text_length(F.lit(x).cast("string"))) for x in ("é\U0001f642", "", None)] == [2, 0, 0]
