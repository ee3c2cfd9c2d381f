"""Registered queries of the document model and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafgraph.config import Config, CorrelationConfig
from leafgraph.operators import classify, relation
from leafgraph.plans import graph
from leafgraph.plans.dialect import DUCKDB, DuckDb
from leafgraph.plans.relations import RELATIONS, compile_sql
from leafgraph.sources import corpus_tree_sql, load_table, markdown_corpus, markdown_corpus_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Relations of prose that are asked of ``documents``; all others are asked of the Markdown corpus.
_PROSE = ("token_coverage",)
_DOCUMENTS = "select cast(doc_id as bigint) as doc_id, coalesce(text, '') as text from documents"
_PAGES = "select cast(page_id as bigint) as doc_id, coalesce(html, '') as text from pages"
_TURNS = """select cast(conv_id as bigint) as doc_id, string_agg(coalesce(text, ''), chr(10) order by turn, role, text) as text
    from conversations group by conv_id"""


def _add(name: str, query: Callable[[SparkSession, str], DataFrame], sql: str) -> None:
    QUERIES[name], ORACLE_SQL[name] = query, sql


#: The corpus has no vectors of a model, so captions are compared by letters.
_CONFIG = Config(correlation=CorrelationConfig(vectors="letters"))


def _over_corpus(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: relation(name, markdown_corpus(spark, sf_dir), config=_CONFIG)


def corpus_oracle(name: str) -> str:
    """A relation of the Markdown corpus in DuckDB: its blocks are known from how the corpus is made, not parsed."""
    return compile_sql(name, DuckDb(_CONFIG), markdown_corpus_sql(DUCKDB), {"node_tree": corpus_tree_sql(DUCKDB)})


#: The blocks of the pages: all begin with a declaration that ends on their first line, and what follows is prose.
_PAGE_TREE = f"""
    select doc_id, block_id, cast(null as int) as parent_block, 0 as depth, block_id as sibling_ix, node_type, block_id as line_start,
           case block_id when 0 then 1 else 1 + len(string_split(raw, chr(10))) end as line_end, char_start,
           cast(char_start + length(raw) as int) as char_end, raw, '' as language, cast(null as int) as heading_level,
           cast(null as varchar) as heading_style, cast(null as varchar) as list_style, cast(null as int) as list_level
    from (select doc_id, 0 as block_id, 'html_block' as node_type, 0 as char_start, string_split(text, chr(10))[1] as raw from ({_PAGES}) p
          union all select doc_id, 1, 'paragraph', cast(position(chr(10) in text) as int), substring(text, position(chr(10) in text) + 1) from ({_PAGES}) q
          where position(chr(10) in text) > 0) b"""


def page_oracle(name: str) -> str:
    """A relation of the pages in DuckDB, from what is known of how they begin."""
    return compile_sql(name, DUCKDB, _PAGES, {"node_tree": _PAGE_TREE})


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "html")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("text"))))
    joined = F.array_join(F.transform(ordered, lambda t: t["text"]), "\n")
    return load_table(turns.groupBy("conv_id").agg(joined.alias("text")), "conv_id", "text")


for _name in RELATIONS:
    if _name in _PROSE:
        _add(_name, lambda s, d, n=_name: relation(n, _documents(s, d)), compile_sql(_name, DUCKDB, _DOCUMENTS))
    else:
        _add(_name, _over_corpus(_name), corpus_oracle(_name))

_add("load_documents", _documents, _DOCUMENTS)
_add("markdown_corpus", markdown_corpus, markdown_corpus_sql(DUCKDB))
_add("conversation_documents", _turns, _TURNS)
_add("conversation_coverage", lambda s, d: relation("token_coverage", _turns(s, d)), compile_sql("token_coverage", DUCKDB, _TURNS))
_add("page_html_blocks", lambda s, d: relation("html_blocks", _pages(s, d)), page_oracle("html_blocks"))
_add("page_html_inline", lambda s, d: relation("html_inline", _pages(s, d)), page_oracle("html_inline"))
_add("page_html_attributes", lambda s, d: relation("html_attributes", _pages(s, d)), page_oracle("html_attributes"))
_add(
    "layer_filter",
    lambda s, d: classify(markdown_corpus(s, d), ["table", "heading"]),
    corpus_oracle("instances") + " where layer_type in ('table', 'heading')",
)
_add(
    "prose_validation",
    lambda s, d: relation("validation_v1", _documents(s, d)).groupBy("check_id").agg(F.sum("failures").alias("failures"), F.count("*").alias("documents")),
    "select check_id, cast(sum(failures) as bigint) as failures, count(*) as documents from ("
    + compile_sql("validation_v1", DUCKDB, _DOCUMENTS) + ") v group by check_id",
)
for _name, (_query, _sql) in graph.QUERIES.items():
    _add(_name, _query, _sql)
