"""The document model on literal documents with results worked out by hand."""

import json
import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from leafgraph.config import Config, CorrelationConfig, TokenizationConfig, TopologyConfig
from leafgraph.operators import StepError, analyse, check_schema, classify, nesting_tables, node_by_id, relation
from leafgraph.operators.parser import tree_rows
from leafgraph.plans.dialect import DUCKDB
from leafgraph.plans.relations import RELATIONS
from leafgraph.sources import corpus_tree_sql, markdown_corpus_sql
from leafgraph.plans.rules import NESTING, nesting_depths, nesting_pairs


def documents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


CONTRACT = "# Title\n\nHello world.\n\n- Item 1\n- Item 2\n"
COMPLEX = (
    "---\ntitle: x\n---\n\n# Main\n\nIntro with **bold**, `code` and [site](https://a.org/p).\n\n## Part\n\nTable 1: Summary of results\n\n"
    "| Name | Age |\n| --- | --- |\n| Ann | 3 |\n| Bo | 4 |\n\n### Deep\n\n- [ ] Task A\n- [x] Task B\n- [ ] Task C\n\n"
    "```python\ndef f():\n    return 1\n```\n\n> quoted *text*\n> again\n\n---\n\n```mermaid\ngraph TD\n```\n\nText[^1].\n\n[^1]: Note\n"
)


def test_tokens(spark):
    got = relation("tokens", documents(spark, "AB\nCD", "\t\t  hello", ""))
    assert rows(got, "doc_id", "token_ix", "text", "char_start", "char_end", "source_line", "token_type") == [
        (0, 0, "AB", 0, 2, 1, "semantic"), (0, 1, "\n", 2, 3, 1, "structural"), (0, 2, "CD", 3, 5, 2, "semantic"),
        (1, 0, "\t\t  ", 0, 4, 1, "structural"), (1, 1, "hello", 4, 9, 1, "semantic"),
    ]


def test_coverage_holds_for_odd_texts(spark):
    got = relation("token_coverage", documents(spark, "", "a b", "é \U0001f642x　y", "\n\n")).collect()
    assert all(r.is_full_coverage and r.slices_agree for r in got) and len(got) == 4


def test_gaps_between_semantic_tokens(spark):
    got = relation("token_gaps", documents(spark, "ab  cd\n"))
    assert rows(got, "gap_start", "gap_end", "is_whitespace") == [(2, 4, True), (6, 7, True)]


def test_nodes_of_the_contract_document(spark):
    got = relation("nodes", documents(spark, CONTRACT))
    assert rows(got, "char_start", "char_end", "layer_type", "raw") == [
        (0, 7, "heading", "# Title"), (9, 21, "paragraph", "Hello world."), (23, 31, "paragraph", "- Item 1"), (23, 40, "list", "- Item 1\n- Item 2"),
        (32, 40, "paragraph", "- Item 2"),
    ]


def test_layers_of_a_document_with_everything(spark):
    got = {r.layer_type: r.n for r in relation("layer_counts", documents(spark, COMPLEX)).collect()}
    assert got == {
        "metadata": 1, "heading": 3, "paragraph": 7, "emphasis": 2, "inline_code": 1, "link": 1, "table": 1, "task_list": 1, "code_block": 1,
        "blockquote": 1, "horizontal_rule": 1, "diagram": 1, "footnote_ref": 1, "footnote": 1,
    }


def test_every_offset_is_a_slice(spark):
    for r in relation("instances", documents(spark, COMPLEX)).collect():
        assert COMPLEX[r.char_start : r.char_end] == r.raw_content


def test_parents_and_depth(spark):
    got = relation("components", documents(spark, COMPLEX)).collect()
    kind = {r.inst_ix: r.layer_type for r in got}
    assert {(r.layer_type, kind[r.parent_ix]) for r in got if r.parent_ix is not None} == {
        ("emphasis", "paragraph"), ("inline_code", "paragraph"), ("link", "paragraph"), ("footnote_ref", "paragraph"), ("paragraph", "task_list"),
        ("paragraph", "blockquote"),
    }
    assert {r.depth for r in relation("nesting_depth", documents(spark, COMPLEX)).collect()} == {0, 1, 2}


def test_setext_headings_and_rules(spark):
    got = relation("headings", documents(spark, "Big\n===\n\nSmall\n---\n\n***\n\n## Closed ##\n\n# C#\n\n- # In # item #\n\n#\n\n> ## Q"))
    assert rows(got, "heading_ix", "level", "heading_style", "text") == [
        (0, 1, "setext", "Big"), (1, 2, "setext", "Small"), (2, 2, "atx", "Closed"), (3, 1, "atx", "C#"), (4, 1, "atx", "In # item"), (5, 1, "atx", ""),
        (6, 2, "atx", "Q"),
    ]


#: Texts and their trees: depth, type and text of each block, as CommonMark nests them.
TREES = {
    "````\n```\ninner\n```\n````\n": [(0, "code_block", "````\n```\ninner\n```\n````")],
    "~~~\n```\nx\n~~~\ny": [(0, "code_block", "~~~\n```\nx\n~~~"), (0, "paragraph", "y")],
    "- item\n\n  second paragraph\n\n- two": [
        (0, "list", "- item\n\n  second paragraph\n\n- two"), (1, "list_item", "- item\n\n  second paragraph"), (2, "paragraph", "- item"),
        (2, "paragraph", "  second paragraph"), (1, "list_item", "- two"), (2, "paragraph", "- two"),
    ],
    "- a\n  - b\n- c\n\n      code\n\n  ```py\n  x\n  ```\n1. x\n2) y": [
        (0, "list", "- a\n  - b\n- c\n\n      code\n\n  ```py\n  x\n  ```"), (1, "list_item", "- a\n  - b"), (2, "paragraph", "- a"), (2, "list", "  - b"),
        (3, "list_item", "  - b"), (4, "paragraph", "  - b"), (1, "list_item", "- c\n\n      code\n\n  ```py\n  x\n  ```"), (2, "paragraph", "- c"),
        (2, "indented_code_block", "      code"), (2, "code_block", "  ```py\n  x\n  ```"), (0, "list", "1. x"), (1, "list_item", "1. x"),
        (2, "paragraph", "1. x"), (0, "list", "2) y"), (1, "list_item", "2) y"), (2, "paragraph", "2) y"),
    ],
    "> quote\nlazy\n> - a\n>   > deep\n\nafter": [
        (0, "blockquote", "> quote\nlazy\n> - a\n>   > deep"), (1, "paragraph", "> quote\nlazy"), (1, "list", "> - a\n>   > deep"),
        (2, "list_item", "> - a\n>   > deep"), (3, "paragraph", "> - a"), (3, "blockquote", ">   > deep"), (4, "paragraph", ">   > deep"), (0, "paragraph", "after"),
    ],
    "para\n1. one\n\npara\n2. two\n\n---\n* * *": [
        (0, "paragraph", "para"), (0, "list", "1. one"), (1, "list_item", "1. one"), (2, "paragraph", "1. one"), (0, "paragraph", "para\n2. two"),
        (0, "horizontal_rule", "---"), (0, "horizontal_rule", "* * *"),
    ],
    "| a | b |\n|---|---|\n| 1 | 2 |\nno pipe\n\n> | q |\n> |---|\n\na | b\n--- | --- | ---": [
        (0, "table", "| a | b |\n|---|---|\n| 1 | 2 |\nno pipe"), (0, "blockquote", "> | q |\n> |---|"), (1, "table", "> | q |\n> |---|"),
        (0, "paragraph", "a | b\n--- | --- | ---"),
    ],
    "<!-- a\n\nb -->\n<div>\nx\n</div>\ntext\n<b>\n\n<b>\nc\n\n<script>\n\n</script>\nz": [
        (0, "html_block", "<!-- a\n\nb -->"), (0, "html_block", "<div>\nx\n</div>"), (0, "paragraph", "text\n<b>"), (0, "html_block", "<b>\nc"),
        (0, "html_block", "<script>\n\n</script>"), (0, "paragraph", "z"),
    ],
    "\tcode\n\n\tmore\n\n-\ttab\n\n\tpara\n- - x\n-\n  late": [
        (0, "indented_code_block", "\tcode\n\n\tmore"), (0, "list", "-\ttab\n\n\tpara\n- - x\n-\n  late"), (1, "list_item", "-\ttab\n\n\tpara"),
        (2, "paragraph", "-\ttab"), (2, "paragraph", "\tpara"), (1, "list_item", "- - x"), (2, "list", "- - x"), (3, "list_item", "- - x"),
        (4, "paragraph", "- - x"), (1, "list_item", "-\n  late"), (2, "paragraph", "  late"),
    ],
    "---\na: b\n---\n[^1]: n\n[x]: y\n\n```": [(0, "metadata", "---\na: b\n---"), (0, "footnote", "[^1]: n"), (0, "definition", "[x]: y"), (0, "code_block", "```")],
    "": [], "\n \n": [],
}


@pytest.mark.parametrize("text", TREES)
def test_trees(text):
    got = tree_rows(1, text)
    assert [(r[3], r[5], r[10]) for r in got] == TREES[text]
    for i, r in enumerate(got):
        assert text[r[8] : r[9]] == r[10] and r[1] == i and r[6] == text[: r[8]].count("\n") and r[7] == r[6] + r[10].count("\n") + 1
        assert r[2] is None or got[r[2]][8] <= r[8] and got[r[2]][9] >= r[9]


@given(st.text(alphabet="-*>#`~|1. \n\ta[]^:<b!", max_size=60))
@settings(max_examples=400, deadline=None)
def test_trees_of_any_text(text):
    """Blocks nest, cover every line that is not blank, and are slices of the text."""
    got = tree_rows(1, text)
    for r in got:
        assert text[r[8] : r[9]] == r[10] and (r[2] is None) == (r[3] == 0)
        if r[2] is not None:
            p = got[r[2]]
            assert r[2] < r[1] and p[3] + 1 == r[3] and p[6] <= r[6] and p[7] >= r[7] and p[5] in ("list", "task_list", "list_item", "blockquote")
            assert (p[5] in ("list", "task_list")) == (r[5] == "list_item")
    inside = {n for r in got for n in range(r[6], r[7])}
    assert all(n in inside or not line.strip() for n, line in enumerate(text.split("\n")))


def test_a_long_document_is_parsed_in_one_pass():
    text = "- item `x`\n  > quoted\n\n```\ncode\n```\n\n" * 20_000
    assert len(tree_rows(1, text)) == 6 * 20_000


def test_items_as_json(spark):
    docs = documents(spark, '- [ ] a\tb "q" \\ é\n  - [x] c')
    got = {r.block_id: json.loads(r.task_items) for r in relation("task_items_json", docs).collect()}
    assert got[0] == [{"index": 0, "checked": False, "text": 'a\tb "q" \\ é'}, {"index": 1, "checked": True, "text": "c"}]


def test_the_depth_limit_can_be_broken(spark):
    deep = documents(spark, "> " * 11 + "x", "> " * 10 + "x")
    assert rows(relation("tree_totals", deep), "doc_id", "max_depth", "within_limit") == [(0, 11, False), (1, 10, True)]


def test_elements_of_a_long_document_meet_in_cells(spark):
    """Instances that reach over many cells, and no more pairs than there are."""
    text = "> " + "word **bold** and `code`\n> " * 60 + "end\n\n" + "# Head\n\npara *x*\n\n" * 30
    docs = documents(spark, text)
    got = {r.inst_ix: r for r in relation("components", docs).collect()}
    for r in got.values():
        assert text[r.char_start : r.char_end] == r.raw_content
        if r.layer_type in ("emphasis", "inline_code"):
            assert got[r.parent_ix].layer_type == "paragraph" and got[r.parent_ix].char_start <= r.char_start < r.char_end <= got[r.parent_ix].char_end
    spans = {r.component_id: (r.token_min, r.token_max) for r in relation("component_tokens", docs).collect()}
    tokens = relation("tokens", docs).collect()
    owner = {r.token_ix: r.component_id for r in relation("token_owner", docs).collect()}
    for c in got.values():
        inside = [t.token_ix for t in tokens if t.char_end > c.char_start and t.char_start < c.char_end]
        assert spans[c.component_id] == (inside[0], inside[-1])
    for t in tokens:
        holders = [(c.char_end - c.char_start, -c.inst_ix, c.component_id) for c in got.values() if c.char_start <= t.char_start < c.char_end]
        assert owner.get(t.token_ix) == (min(holders)[2] if holders else None)


@pytest.mark.parametrize(
    ("levels", "violations"),
    [([1, 2, 2, 3], []), ([1, 3], [("skip", 2, 2)]), ([1, 4, 2], [("jump_back", 2, 3), ("skip", 2, 3)])],
)
def test_heading_violations(spark, levels, violations):
    text = "\n\n".join("#" * n + " h" for n in levels)
    assert rows(relation("heading_violations", documents(spark, text)), "violation", "expected_from", "expected_to") == violations
    report = relation("heading_report", documents(spark, text)).first()
    assert report.is_valid == (not violations) and report.max_level == max(levels) and report.total == len(levels)


def test_indentation(spark):
    docs = documents(spark, "# a\n\n  ## b\n\n   ### c", "# a\n\n ## b\n\n  ### c\n\n## d", "# a")
    assert rows(relation("indentation", docs), "doc_id", "pattern") == [(0, "mixed"), (1, "indented"), (2, "standard")]
    assert rows(relation("indentation_anomalies", docs.where("doc_id = 1")), "heading_ix", "expected", "indent") == [(3, 1, 0)]


def test_table(spark):
    docs = documents(spark, COMPLEX)
    assert rows(relation("table_index", docs), "has_header", "data_rows", "num_cols", "header") == [(True, 2, 2, "Name,Age")]
    assert rows(relation("table_captions", docs), "distance", "confidence") == [(2, 1.0)]


def test_task_list(spark):
    docs = documents(spark, "- [ ] Task A\n- [x] Task B\n- [ ] Task C", "1. [ ] First\n2. [x] Second", "- [ ] Do\n- Normal")
    assert rows(relation("task_list_stats", docs), "doc_id", "task_count", "checked_count") == [(0, 3, 1), (1, 2, 1), (2, 1, 0)]
    assert rows(relation("list_index", docs), "doc_id", "is_ordered", "total_items") == [(0, False, 3), (1, True, 2), (2, False, 2)]


def test_code_lines(spark):
    docs = documents(spark, "```\nline1\n\nline3\n```", "```py\n1 | def foo():\n2 | pass\n```", "text\n\n    indented\n    more\n")
    got = rows(relation("code_index", docs), "doc_id", "language", "n_lines", "non_empty", "has_line_numbers")
    assert got == [(0, "", 3, 2, False), (1, "py", 2, 2, True), (2, "", 2, 2, False)]


def test_links(spark):
    docs = documents(spark, "See [a](https://x.org:8/p), <https://y.org>, [b][R], [r][] and [lost][q], `[no](n)`.\n\n[r]: /local\n")
    got = rows(relation("links", docs), "link_type", "text", "url", "is_external", "domain")
    assert got == [
        ("auto", "https://y.org", "https://y.org", True, "y.org"), ("inline", "a", "https://x.org:8/p", True, "x.org"),
        ("reference", "b", "/local", False, ""), ("reference", "r", "/local", False, ""),
    ]


def test_footnotes(spark):
    docs = documents(spark, "One[^1].\n\nTwo[^2].\n\nThree[^1] again.\n\n[^1]: note\n[^3]: unused")
    assert rows(relation("footnotes", docs), "label", "reference_count", "has_references") == [("1", 2, True), ("3", 0, False)]


def test_html(spark):
    docs = documents(spark, '<div class="a" id="b">\ninside\n</div>\n\nPress <kbd>x</kbd> or <br/>.\n')
    assert rows(relation("html_blocks", docs), "tag_name", "is_semantic") == [("div", True)]
    assert rows(relation("html_attributes", docs), "name", "value") == [("class", "a"), ("id", "b")]
    assert rows(relation("html_inline", docs), "tag_name", "is_self_closing") == [("br", True), ("kbd", False), ("kbd", False)]


def test_attributes_of_inline_tags(spark):
    text = 'Press <kbd class="k" id=\'c\'>Ctrl</kbd>, <br/>, <p class="no">x</p> and `<b id="q">`.\n\n<div id="d">\ntext\n</div>'
    got = rows(relation("html_attributes", documents(spark, text)), "char_start", "attr_ix", "name", "value")
    assert got == [(6, 0, "class", "k"), (6, 1, "id", "c"), (text.index("<div"), 0, "id", "d")]


def test_emphasis_in_lists(spark):
    texts = (
        "- first item\n  - nested item\n- second **bold** item\n\n1. one\n2. *two*",
        "* star *it* one\n  * inner **b**\n* plain\n* ~~gone~~ end",
        "- [ ] do *this*\n- [x] ***done***\n\n> * quoted *q*\n> * again",
    )
    docs = documents(spark, *texts)
    got = relation("emphasis", docs).collect()
    assert all(texts[r.doc_id][r.char_start : r.char_end] == r.hit for r in got)
    found = {(r.doc_id, r.emphasis_type, r.hit) for r in got}
    assert found >= {
        (0, "bold", "**bold**"), (0, "italic", "*two*"), (1, "italic", "*it*"), (1, "bold", "**b**"), (1, "strikethrough", "~~gone~~"),
        (2, "italic", "*this*"), (2, "bold_italic", "***done***"), (2, "italic", "*q*"),
    }
    assert sorted(r.hit for r in got if r.emphasis_type == "italic") == ["*it*", "*q*", "*this*", "*two*"]
    parents = {(r.doc_id, r.inst_ix): r for r in relation("components", docs).collect()}
    bold = next(r for r in parents.values() if r.raw_content == "**bold**")
    assert parents[0, bold.parent_ix].layer_type == "paragraph"
    assert parents[0, parents[0, bold.parent_ix].parent_ix].layer_type == "list"


#: The four scans of the reference.
SCANS = {
    "bold_italic": r"\*\*\*(.+?)\*\*\*",
    "bold": r"\*\*(.+?)\*\*",
    "italic": r"(?<!\*)\*(?!\*)(.+?)(?<!\*)\*(?!\*)",
    "strikethrough": r"~~(.+?)~~",
}


def test_emphasis_is_four_scans(spark):
    draw = random.Random(5)
    texts = ["**bold with *it* inside**", "***now***", "*a **b** c*", "~~*x* **y**~~", "\x01*a* \x01**b**", "*a `b* c`"]
    texts += ["x" + "".join(draw.choices("***~~ab \x01", k=draw.randint(1, 24))) + "z" for _ in range(400)]
    want = {(i, t, m.start(), m.end(), m[0], m[1]) for i, x in enumerate(texts) for t, p in SCANS.items() for m in re.finditer(p, x)}
    columns = "doc_id, emphasis_type, char_start, char_end, hit, text"
    got = [tuple(r) for r in relation("emphasis", documents(spark, *texts)).select(*columns.split(", ")).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert {(0, "bold", "**bold with *it* inside**"), (0, "italic", "*it*")} == {(g[0], g[1], g[4]) for g in got if g[0] == 0}
    duck = duckdb.connect()
    # each of these texts is a paragraph
    duck.execute("create table nodes (doc_id bigint, block_id int, char_start int, layer_type varchar, raw varchar)")
    duck.executemany("insert into nodes values (?, 0, 0, 'paragraph', ?)", list(enumerate(texts)))
    assert set(duck.sql(f"select {columns} from ({RELATIONS['emphasis'](DUCKDB)}) q").fetchall()) == want


def test_token_owner_and_coverage(spark):
    docs = documents(spark, "# Title\n\nHello world.\n")
    got = relation("coverage_stats", docs).first()
    assert (got.total, got.assigned) == (9, 7) and got.coverage == 77.78
    assert relation("unassigned_tokens", docs).count() == 2


def test_conflicts_know_nesting(spark):
    got = relation("conflicts", documents(spark, "A **b** c")).collect()
    assert [(r.first_type, r.second_type, r.overlap_percent, r.is_nesting_allowed) for r in got] == [("paragraph", "emphasis", 100.0, True)]


def test_validation_passes(spark):
    docs = documents(spark, CONTRACT, COMPLEX, "word", "")
    got = relation("validation_report", docs).collect()
    assert all(r.critical_passed for r in got) and len(got) == 4
    assert {r.doc_id for r in got if r.all_passed} == {2, 3}
    # all that fails is the warning about white space between the tokens
    gaps = relation("validation_v1", docs).where("not passed")
    assert rows(gaps.where("doc_id = 0"), "check_id", "severity", "failures") == [("V1.5.space", "warning", 10)]
    kept = Config(tokenization=TokenizationConfig(include_whitespace=True))
    assert all(r.all_passed for r in relation("validation_report", docs, config=kept).collect())


def test_typed_relations_of_small_documents(spark):
    docs = documents(
        spark,
        "***\n\n_ _ _\n\n---\n\n```py\nx = 1\n\n  y\n```\n\n1. one\n2. two\n\n[a]: http://a.b/c\n\n[see][A] and ![cap](img.png)\n",
        "# A\n\n## B\n\n### C\n\n## D\n\n# E\n",
        "---\ntitle: My doc\nx-y:  2 \n---\n\n```mermaid\ngraph TD\n```\n",
    )
    assert rows(relation("horizontal_rules", docs), "char_start", "style", "length") == [(0, "star", 3), (5, "underscore", 3), (12, "dash", 3)]
    code = relation("code_index", docs).where("doc_id = 0")
    assert rows(code, "language", "n_lines", "non_empty", "max_indent", "has_line_numbers") == [("py", 3, 2, 2, False)]
    assert rows(relation("list_index", docs), "doc_id", "is_ordered", "total_items", "max_depth") == [(0, True, 2, 1)]
    assert rows(relation("link_definitions", docs), "doc_id", "ref_id", "url") == [(0, "a", "http://a.b/c")]
    link = relation("links", docs)
    assert rows(link, "text", "link_type", "ref_id", "url", "is_external", "domain") == [("see", "reference", "a", "http://a.b/c", True, "a.b")]
    assert rows(relation("figures", docs), "caption", "src") == [("cap", "img.png")]
    assert rows(relation("heading_groups", docs), "heading_ix", "level", "root_ix", "sub_root_ix") == [
        (0, 1, 0, None), (1, 2, 0, None), (2, 3, 0, 1), (3, 2, 0, None), (4, 1, 4, None),
    ]
    assert rows(relation("metadata_keys", docs), "line_ix", "key", "value") == [(1, "title", "My doc"), (2, "x-y", "2")]
    assert rows(relation("diagram_correlations", docs), "doc_id", "diagram_type", "confidence") == [(2, "mermaid", 0.8)]


def test_gaps_of_tokens_that_do_not_cover(spark):
    """Tokens of a unit of one's own may leave letters out: gaps that hold some are critical."""
    docs = documents(spark, " a bc\n\nd ", "", "xy")
    without = {"tokens": lambda found: found.where("text not in ('bc', 'xy')")}
    assert rows(relation("token_gaps", docs, units=without), "doc_id", "gap_start", "gap_end", "is_whitespace") == [
        (0, 0, 1, True), (0, 2, 7, False), (0, 8, 9, True), (2, 0, 2, False),
    ]
    assert rows(relation("token_gaps", docs), "doc_id", "gap_start", "gap_end", "is_whitespace") == [
        (0, 0, 1, True), (0, 2, 3, True), (0, 5, 7, True), (0, 8, 9, True),
    ]
    failed = rows(relation("validation_v1", docs, units=without).where("not passed and severity = 'critical'"), "doc_id", "check_id", "failures")
    assert failed == [(0, "V1.1", 3), (0, "V1.5", 1), (2, "V1.5", 1)]


def test_depths_where_numbers_are_missing(spark):
    docs = documents(spark, "")
    found = spark.createDataFrame([(0, i, "list", i, 90 - i, "x") for i in (0, 3, 4, 9)], relation("instances", docs).schema)
    above = spark.createDataFrame([(0, 3, 0), (0, 4, 3), (0, 9, 4)], "doc_id long, inst_ix int, parent_ix int")
    given_tables = {"instances": found, "parents": above}
    got = rows(relation("nesting_depth", docs, given=given_tables), "inst_ix", "depth", "in_cycle")
    assert got == [(0, 0, False), (3, 1, False), (4, 2, False), (9, 3, False)]
    ring = above.union(spark.createDataFrame([(0, 0, 9)], above.schema))
    got = rows(relation("nesting_depth", docs, given=given_tables | {"parents": ring}), "inst_ix", "in_cycle")
    assert got == [(0, True), (3, True), (4, True), (9, True)]


def test_forward_spans(spark):
    """Tokens that begin in a component; one that a component begins inside of is left out, and a component may hold none."""
    docs = documents(spark, "ab cd ef")
    kinds = [(0, 0, "paragraph:0-8_0", 0, 8), (0, 1, "link:1-4_1", 1, 4), (0, 2, "link:4-5_2", 4, 5), (0, 3, "link:3-3_3", 3, 3)]
    held = spark.createDataFrame(kinds, "doc_id long, inst_ix int, component_id string, char_start int, char_end int")
    got = rows(relation("component_tokens_forward", docs, given={"components": held}), "component_id", "token_min", "token_max")
    assert got == [("link:1-4_1", 1, 2), ("paragraph:0-8_0", 0, 4)]


def test_overlapping_spans_fail(spark):
    texts = ["*a `b* c`", "*a* `b` and **c**", "one  \n\n    code", "**bold with *it* inside**", "- x *a `b* c`", "# A *b*\n\n> `c` [d](e)"]
    docs = documents(spark, *texts)
    rows_of = relation("validation_v2", docs).where("check_id = 'V2.3'")
    assert rows(rows_of, "doc_id", "passed", "failures") == [(0, False, 1), (1, True, 0), (2, True, 0), (3, False, 1), (4, False, 1), (5, True, 0)]


def test_strict_analysis_rejects_blank_documents(spark):
    assert set(analyse(documents(spark, CONTRACT), strict=True)) > {"tokens", "components"}
    with pytest.raises(ValueError):
        analyse(documents(spark, " \n"), strict=True)


def test_layer_filter(spark):
    assert {r.layer_type for r in classify(documents(spark, COMPLEX), ["table"]).collect()} == {"table"}
    with pytest.raises(ValueError):
        classify(documents(spark, COMPLEX), ["sentence"])
    with pytest.raises(KeyError):
        relation("nothing", documents(spark, COMPLEX))


def test_nesting_rules():
    assert len(nesting_pairs()) == 95 and len(nesting_depths()) == 19
    assert {p for p, c in nesting_pairs() if c == "html_block"} == {"blockquote"}
    assert not {"metadata", "footnote"} & {c for _, c in nesting_pairs()} and "diagram" not in NESTING["blockquote"][0]


def test_topics_and_item_tree(spark):
    docs = documents(spark, "intro\n\n# A\n\ntext\n\n- one\n  - two\n    - three\n- four\n")
    under = {(r.layer_type, r.heading_block is None) for r in relation("topics", docs).collect()}
    assert under == {("paragraph", True), ("heading", False), ("paragraph", False), ("list", False)}
    got = rows(relation("item_tree", docs).where("block_id = 3"), "item_ix", "parent_item_ix")
    assert got == [(0, None), (1, 0), (2, 1), (3, None)]


def test_gates(spark):
    got = rows(relation("validation_v0", documents(spark, "x", " \n", "\ufeffy")), "doc_id", "is_not_blank", "has_no_byte_order_mark")
    assert got == [(0, True, True), (1, False, True), (2, True, False)]
    docs = documents(spark, COMPLEX)
    assert all(relation(n, docs).count() == 0 for n in ("v13_keys", "v24_orphans", "v24_cycles"))
    total = relation("tree_totals", docs).first()
    assert total.total_nodes == 23 and total.max_depth == 2 and relation("hierarchy_flat", docs).count() == 23


def test_empty_table(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert relation("components", nothing).count() == 0 and relation("validation_report", nothing).count() == 0


def test_settings_reach_the_relations(spark):
    docs = documents(spark, "Table 1: x\n\n| a | b |\n|---|---|\n| 1 | 2 |\n\n> > > deep\n\n![rose](d)\n\nclose words\n\nA **b** c")
    assert relation("table_captions", docs).count() == 1
    none = Config(correlation=CorrelationConfig(proximity=1, conflict_percent=100.0), topology=TopologyConfig(("table",), 2))
    assert relation("table_captions", docs, config=none).count() == 0 and relation("conflicts", docs, config=none).count() == 0
    assert relation("tree_totals", docs, config=none).first().within_limit is False and relation("tree_totals", docs).first().within_limit
    assert {r.layer_type for r in classify(docs, config=none).collect()} == {"table"}
    # without vectors a caption of a figure is not sure enough
    assert relation("figure_captions", docs).count() == 0
    vectors = spark.createDataFrame([(0, r.block_id, [1.0, 0.0]) for r in relation("nodes", docs).collect()], "doc_id long, block_id int, vector array<double>")
    got = relation("figure_captions", docs, given={"block_vectors": vectors}).collect()
    assert [(r.distance, r.confidence) for r in got] == [(2, 0.8)]
    assert relation("table_captions", docs, given={"block_vectors": vectors}).first().confidence == 1.0
    assert relation("figure_captions", docs, config=Config(correlation=CorrelationConfig(vectors="letters"))).count() == 1
    with_spaces = Config(tokenization=TokenizationConfig(include_whitespace=True))
    assert relation("config_tokens", docs, config=with_spaces).count() == relation("tokens", docs).count() > relation("config_tokens", docs).count()
    assert relation("config_coverage", docs).first().is_config_full_coverage


def test_units_and_rules_of_ones_own(spark):
    docs = documents(spark, "A TODO here.\n\n`code`")
    todo = lambda found: found.unionByName(
        spark.createDataFrame([(0, 99, "emphasis", 2, 6, "TODO")], found.schema)
    )
    got = relation("layer_counts", docs, units={"instances": todo}).collect()
    assert {r.layer_type: r.n for r in got} == {"paragraph": 2, "inline_code": 1, "emphasis": 1}
    other_parser = lambda d: spark.createDataFrame([], relation("node_tree", d).schema)
    assert relation("instances", docs, units={"node_tree": other_parser}).count() == 0
    strict = nesting_tables(spark, {"paragraph": (["emphasis"], 1)}, leaves=["emphasis"])
    assert relation("parents", docs).count() == 1 and relation("parents", docs, given=strict).count() == 0
    with pytest.raises(KeyError):
        relation("parents", docs, given={"nonsense": docs})


def test_steps_and_their_gates(spark):
    docs = documents(spark, CONTRACT, " \n", "[x]: y")
    stopped = {r.doc_id: r.step for r in relation("first_failures", docs).collect()}
    assert stopped == {1: "parse", 2: "parse"}
    gates = relation("step_gates", docs.where("doc_id = 0")).collect()
    assert all(r.passed for r in gates) and max(gates, key=lambda r: r.step_ix).step == "coverage" and len(gates) == 9
    with pytest.raises(StepError, match="parse"):
        analyse(docs.where("doc_id <> 1"), strict=True)
    with pytest.raises(StepError, match="V1.0"):
        analyse(docs.selectExpr("cast(doc_id as string) as doc_id", "text"), strict=True)
    assert check_schema(docs) is None and check_schema(docs.drop("text")) == "column text is missing"
    checks = {(r.doc_id, r.check_id): r.passed for r in relation("validation_v2", docs).collect()}
    assert all(checks.values()) and (2, "V2.empty") in checks


def test_first_broken_rules(spark):
    text = "- a\n\n  <div>\n\n| `x` | b |\n|---|---|\n| 1 | 2 |"
    docs = documents(spark, text)
    assert relation("nesting_failures", docs).count() == 0
    loose = nesting_tables(spark, {"list": (["paragraph"], 0), "table": (["inline_code"], 1)}, ["paragraph"])
    narrow = loose | {"parents": spark.createDataFrame([(0, 0, 1), (0, 2, 0)], "doc_id long, parent_ix int, inst_ix int").select("doc_id", "inst_ix", "parent_ix")}
    got = relation("nesting_failures", docs, given=narrow)
    assert {r.reason for r in got.collect()} <= {"leaf", "forbidden", "depth"} and got.count() >= 1


def test_node_by_id(spark):
    docs = documents(spark, CONTRACT)
    one = relation("components", docs).where("layer_type = 'heading'").first()
    assert node_by_id(docs, one.component_id).collect() == [one] and node_by_id(docs, "heading:9-9_9").count() == 0


def test_topics_segments_and_grids(spark):
    long = " ".join(["word"] * 100) + ". However, " + " ".join(["other"] * 80)
    docs = documents(spark, f"{long}\n\nshort However it is", "# Head\n\ntext\n\n| a | b |\n|---|---|\n| 1 |")
    parts = [(r.block_id, r.segment_ix, r.text) for r in relation("semantic_segments", docs.where("doc_id = 0")).collect()]
    assert sorted(parts) == [(0, 0, long[: long.index("However")]), (0, 1, long[long.index("However") :]), (1, 0, "short However it is")]
    labels = {(r.doc_id, r.label, r.from_heading) for r in relation("topic_labels", docs).collect()}
    assert labels == {(0, "other", False), (1, "Head", True)}
    assert rows(relation("table_grid", docs), "row_ix", "col_ix", "text", "is_padding") == [
        (0, 0, "a", False), (0, 1, "b", False), (1, 0, "1", False), (1, 1, "", True),
    ]


def test_the_corpus_is_parsed_as_it_is_made():
    """The blocks of the Markdown corpus are known from its parts; the parser finds just those."""
    duck = duckdb.connect()
    for name in ("customer", "orders", "nation"):
        duck.execute(f"create view {name} as select * from '/root/testdata/sf0.001/{name}.parquet'")
    texts = duck.execute(markdown_corpus_sql(DUCKDB)).fetchall()
    want = sorted(duck.execute(corpus_tree_sql(DUCKDB)).fetchall(), key=lambda r: r[:2])
    assert sorted((r for doc, text in texts for r in tree_rows(doc, text)), key=lambda r: r[:2]) == want and len(want) > 5000
