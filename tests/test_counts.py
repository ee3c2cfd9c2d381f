"""Gates and checks counted in one pass over whole documents, against the relations' SQL over rows."""

import pytest
from leafgraph.operators import counts, relation
from leafgraph.operators.parser import tree_rows

from tests.test_sweeps import AS_ROWS, TEXTS, documents, plan_of, rows

#: Pieces that do not end at an empty line, and links whose definition stands elsewhere or nowhere.
MORE = [
    "```\n\nx\n\n# no\n", "<!-- a\n\nb -->\n\nc\n\n# d", "- a\n\n- b\n\n  c\n\n1. d\n\n2. e\n\ntext", "> a\n\n> b\n\nc", "    x\n\n    y\n\nz", "---\na: b\n\n---\n# x\n\n---\n\n---\n",
    "---\n\nno front", "- ```\n\nx\n\n- y", "*a [b*][x] [c][] `d`\n\n[x]: u", "*a [b*][y] [x][]\n\n> [x]: u", "``a\x85b`` `` c\xa0`` <b\xa0c>", "[^1]: n [^1]\n\nsee [^1]", "a\r\n\r\n# b\r\n",
]
NAMES = ["step_gates", "first_failures", "validation_report"]


@pytest.mark.parametrize("name", NAMES)
def test_counts_are_those_of_the_relations(spark, name, monkeypatch):
    from leafgraph.operators import sweeps

    docs = documents(spark, *TEXTS, *MORE, None)
    want = rows(relation(name, docs, **AS_ROWS))
    assert want and rows(relation(name, docs)) == want
    monkeypatch.setattr(sweeps, "_AT_ONCE", 5)  # documents go in several parts
    assert rows(relation(name, docs)) == want


@pytest.mark.parametrize("name", NAMES)
def test_no_block_or_element_is_a_row(spark, name):
    """All that is written is a row of counts for each text."""
    from leafgraph import session

    before = set(session._staged)
    plan = plan_of(relation(name, documents(spark, *TEXTS)))
    (path,) = set(session._staged) - before
    assert spark.read.parquet(path).count() == len(TEXTS)
    assert "Join" not in plan and "Window" not in plan and "MapInArrow" not in plan


@pytest.mark.parametrize("name", NAMES)
def test_missing_and_repeated_ids(spark, name):
    """They go through the relations, and the other documents do not."""
    odd = [(1, "# again"), (1, ""), (None, "a"), (None, "# b\n\n*c*"), (4, " ")]
    docs = documents(spark, *TEXTS).union(spark.createDataFrame(odd, "doc_id long, text string"))
    by_rows = {"share": False} if name == "validation_report" else AS_ROWS
    want = rows(relation(name, docs, **by_rows))
    assert rows(relation(name, docs)) == want and any(None in row for row in want)


def test_pieces_have_the_blocks_of_the_whole():
    for text in [x for x in TEXTS + MORE if x]:
        layers = [r for r in tree_rows(0, text) if r[5] not in ("list_item", "definition")]
        assert counts.count_document(text)[0] == len(layers), text
