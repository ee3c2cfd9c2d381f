"""Passes over the texts against the relations' SQL over the same tokens, and what they shuffle."""

import duckdb
import pytest
from leafgraph.operators import relation
from leafgraph.plans.queries import ORACLE_SQL, QUERIES

TEXTS = [
    "# A **b**\n\n> `c` [d](e) *f*\n\n- x\n  - y `z`\n", "", " \n", " a bc\n\nd ", "no end\t", "|a|b|\n|-|-|\n|1|2|", "é́x ﷺ　\U0001f600y*z*", "[x]: y",
    "***now*** ~~[a](b)~~\n\n```py\nx\n```\n", "x" * 3000, "a " * 2000 + "**b**", "﻿ a",
]


def documents(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


#: A unit of one's own that changes nothing, so that the relation reads the tokens as rows.
AS_ROWS = {"units": {"tokens": lambda found: found}}


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def same(spark, name, monkeypatch):
    from leafgraph.operators import sweeps

    docs = documents(spark, *TEXTS)
    want = rows(relation(name, docs, **AS_ROWS))
    assert want and rows(relation(name, docs)) == want
    monkeypatch.setattr(sweeps, "_AT_ONCE", 5)  # documents go in several parts
    assert rows(relation(name, docs)) == want


@pytest.mark.parametrize("name", ["token_counts", "token_failures", "validation_v1"])
def test_token_checks(spark, name, monkeypatch):
    same(spark, name, monkeypatch)


@pytest.mark.parametrize("name", ["token_failures", "validation_v1", "prose_validation"])
def test_token_checks_make_no_rows_of_tokens(spark, name):
    """No token is a row, and no text is dealt once more."""
    plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "posexplode" not in plan and "Window" not in plan and "RepartitionByExpression [doc_id" not in plan


def test_documents_without_ids_and_repeated_ones(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "c d"), (2, None)], "doc_id long, text string")
    got = {(r.doc_id, r.check_id): r.failures for r in relation("validation_v1", docs).collect()}
    assert len(got) == 18 and got[1, "V1.5.space"] == 1 and got[2, "V1.5.space"] == 0
    twice = relation("validation_v1", docs.union(docs).where("doc_id = 1"))
    assert twice.count() == 6


def test_texts_of_one_id_are_no_sequence(spark, tmp_path):
    """Of the tokens of an id only the first is where its number says.  Checks that read an order which the SQL leaves open are left out."""
    more = [(0, "c d"), (0, None), (1, ""), (3, TEXTS[3]), (None, "e"), (None, "f g")]
    docs = documents(spark, *TEXTS).union(spark.createDataFrame(more, "doc_id long, text string"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.check_id, r.failures, r.documents) for r in QUERIES["prose_validation"](spark, str(tmp_path)).collect()}
    with duckdb.connect() as duck:
        duck.sql(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        want = set(duck.sql(f"select * from ({ORACLE_SQL['prose_validation']}) v where check_id in ('V1.1', 'V1.2', 'V1.3')").fetchall())
    assert len(want) == 3 and want <= got and max(failures for _, failures, _ in want) > 0
    failures = relation("token_failures", docs).select("doc_id", "not_sequential")
    assert rows(failures) == rows(relation("token_failures", docs, **AS_ROWS).select("doc_id", "not_sequential"))


@pytest.mark.parametrize("name", ["token_owner", "token_cover", "coverage_stats", "component_tokens"])
def test_tokens_of_components(spark, name, monkeypatch):
    same(spark, name, monkeypatch)


def test_token_owner_makes_no_rows_of_tokens(spark):
    plan = plan_of(relation("token_owner", documents(spark, *TEXTS)))
    assert "posexplode" not in plan and "explode(sequence" not in plan


def test_owners_of_components_that_are_given(spark):
    """Places outside the text and empty ones, equal places, and a document that has no components."""
    docs = documents(spark, "ab cd", "x", "")
    kinds = [(0, 0, "a", 0, 99), (0, 1, "b", 1, 5), (0, 2, "c", 3, 5), (0, 3, "d", 3, 5), (0, 4, "e", 0, 0), (0, 5, "f", 50, 60), (2, 0, "g", 0, 3)]
    held = spark.createDataFrame(kinds, "doc_id long, inst_ix int, component_id string, char_start int, char_end int")
    for name, want in (
        ("token_owner", [("a", 0, 0), ("b", 0, 1), ("d", 0, 2)]),
        ("token_cover", [(3, 0, 3, 0), (0, 1, 1, 1)]),
        ("component_tokens", [("a", 0, 3, 2, 0), ("b", 0, 3, 2, 0), ("c", 0, 1, 2, 2), ("d", 0, 1, 2, 2), ("f", 0, 1, 2, 2)]),
    ):
        assert rows(relation(name, docs, given={"components": held})) == sorted(want, key=repr)
        assert rows(relation(name, docs, given={"components": held}, **AS_ROWS)) == sorted(want, key=repr)


@pytest.mark.parametrize("name", ["token_owner", "step_gates", "first_failures", "validation_report"])
def test_slices_of_documents(spark, name, monkeypatch):
    """Slices give what the documents give at once, and leave one table: what a slice wrote is gone when it ends."""
    from leafgraph import operators, session

    docs = documents(spark, *TEXTS)
    want = rows(relation(name, docs))
    monkeypatch.setattr(operators, "SLICE_CHARS", 2000)
    before = set(session._staged)
    found = relation(name, docs)
    left = set(session._staged) - before
    assert [p.rpartition("-")[2] for p in left] == [operators.SLICED[name][0]]
    assert rows(found) == want and want
