"""A Markdown corpus made from the star schema: one document a customer, the same text in Spark and DuckDB.

A document is a sequence of parts.  Each part says what it writes and which blocks that is, so the blocks of a document
are known by construction, without a parser: ``corpus_tree_sql`` adds up lengths and is what parsing is held against.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from leafgraph.plans.dialect import SPARK, Spark

#: Stands for a line feed inside the SQL literals below.
_BREAK = "¶"
_KEY = "cast(c_custkey as string)"


def _literal(text: str) -> str:
    return "'" + text.replace("\n", _BREAK).replace("'", "''") + "'"


@dataclass
class Block:
    """A block of a part: its type, how deep it is, its text, and the text of the part in front of it (both as SQL)."""

    kind: str
    raw: str
    before: str = "''"
    depth: int = 0
    language: str = "''"
    level: str = "null"
    style: str = "null"


@dataclass
class Part:
    """What a document holds between two blank lines; ``when`` says which documents hold it."""

    text: str
    blocks: list[Block] = field(default_factory=list)
    when: str = "true"


def _one(kind: str, text: str, when: str = "true", **attrs: str) -> Part:
    return Part(text, [Block(kind, text, **attrs)], when)


def _known(text: str, blocks: list[tuple[str, int, str]], when: str = "true") -> Part:
    """A part that is the same in all documents; each block is given by type, depth and its text, which occurs in order."""
    found, at = [], 0
    for kind, depth, raw in blocks:
        at = text.index(raw, at)
        found.append(Block(kind, _literal(raw), _literal(text[:at]), depth))
    return Part(_literal(text), found, when)


def _fence(rest: int, opening: str, body: str, close: str, language: str, kind: str) -> Part:
    text = f"concat({_literal(opening + chr(10) + body)}, {_KEY}, {_literal(chr(10) * 2 + 'last' + chr(10) + close)})"
    return _one(kind, text, f"c_custkey % 6 = {rest}", language=f"'{language}'")


_NESTED = "- first item\n  - nested item\n    - deeper item\n- second **bold** item"
_LOOSE = "* one\n\n  still *one*\n\n  ```js\n  var x = `1`;\n  ```\n* > quoted **item**\n  > - [ ] inner"
_DEEP = "> Outer\ngoes on\n> - a `b`\n> - c\n>\n> > inner *q*"
_LONG_FENCE = "````md\n```\n- no list\n```\n````"

PARTS = [
    _one("metadata", f"concat({_literal('---' + chr(10) + 'segment: ')}, c_mktsegment, {_literal(chr(10) + 'key: ')}, {_KEY}, {_literal(chr(10) + '---')})",
         "c_custkey % 3 = 0"),
    _one("heading", "concat('# ', c_name)", level="1", style="'atx'"),
    _one("paragraph", "concat('The customer **', c_name, '** lives in *', n_name, '* and has `', cast(cast(c_acctbal as decimal(18, 2)) as string),"
         " '` on ~~hold~~ account[^1], ***now***.')"),
    _one("heading", "concat(case when c_custkey % 4 = 1 then '### ' else '## ' end, 'Orders')",
         level="case when c_custkey % 4 = 1 then 3 else 2 end", style="'atx'"),
    _one("paragraph", "case when c_custkey % 5 = 4 then 'An overview follows.' else concat('Table 1: Orders of ', c_name) end"),
    _one("table", f"concat({_literal('| Order | Date | Total |' + chr(10) + '| --- | --- | --- |' + chr(10))},"
         " coalesce(table_rows, '| none | none | none |'))"),
    _one("heading", "concat(case when c_custkey % 8 = 0 then '  ' else '' end, '## Tasks')", "c_custkey % 2 = 0", level="2", style="'atx'"),
    Part("coalesce(tasks, '- [ ] nothing')", [Block("task_list", "coalesce(tasks, '- [ ] nothing')")], "c_custkey % 2 = 0"),
    _one("paragraph", "'More of it.'", "c_custkey % 2 = 0"),
    _known(_NESTED, [
        ("list", 0, _NESTED), ("list_item", 1, "- first item\n  - nested item\n    - deeper item"), ("paragraph", 2, "- first item"),
        ("list", 2, "  - nested item\n    - deeper item"), ("list_item", 3, "  - nested item\n    - deeper item"), ("paragraph", 4, "  - nested item"),
        ("list", 4, "    - deeper item"), ("list_item", 5, "    - deeper item"), ("paragraph", 6, "    - deeper item"),
        ("list_item", 1, "- second **bold** item"), ("paragraph", 2, "- second **bold** item"),
    ]),
    _known("1. one\n2. two", [
        ("list", 0, "1. one\n2. two"), ("list_item", 1, "1. one"), ("paragraph", 2, "1. one"), ("list_item", 1, "2. two"), ("paragraph", 2, "2. two"),
    ]),
    _fence(0, "```python", "def total(x):\n    return x  # ", "```", "python", "code_block"),
    _fence(1, "```mermaid", "graph TD; A-->B; %% ", "```", "mermaid", "diagram"),
    _fence(2, "~~~", "```\n1 | plain ", "~~~", "", "code_block"),
    _fence(3, "```sql", "select 1 -- ", "```", "sql", "code_block"),
    _fence(4, "```", "flowchart of ", "```", "", "diagram"),
    _fence(5, "```dot", "digraph ", "```", "dot", "diagram"),
    Part(f"concat({_literal('> A quote about ')}, n_name, {_literal(chr(10) + '> with *two* lines.')})", [
        Block("blockquote", f"concat({_literal('> A quote about ')}, n_name, {_literal(chr(10) + '> with *two* lines.')})"),
        Block("paragraph", f"concat({_literal('> A quote about ')}, n_name, {_literal(chr(10) + '> with *two* lines.')})", depth=1),
    ]),
    _one("horizontal_rule", "case c_custkey % 3 when 0 then '---' when 1 then '***' else '___' end"),
    _one("paragraph", f"concat('See [site](https://example.com/c/', {_KEY}, ') or <https://example.org/x>, [ref][R1], [r2][]',"
         " case when c_custkey % 7 = 0 then ' and [lost][r9]' else '' end, '.')"),
    _one("paragraph", f"concat('![Chart of ', n_name, '](img/', {_KEY}, '.png)')"),
    _one("paragraph", "'Totals by year.'"),
    _known("[r1]: https://docs.example.com:80/a\n[r2]: /local", [
        ("definition", 0, "[r1]: https://docs.example.com:80/a"), ("definition", 0, "[r2]: /local"),
    ]),
    _one("html_block", f"concat({_literal('<div class=' + chr(34) + 'box' + chr(34) + ' id=' + chr(34) + 'c')}, {_KEY},"
         f" {_literal(chr(34) + '>' + chr(10) + 'content' + chr(10) + '</div>')})", "c_custkey % 2 = 1"),
    _one("html_block", "'<span>block</span>'", "c_custkey % 2 = 0"),
    _one("html_block", _literal("<!-- a remark\n\nwith # gaps -->"), "c_custkey % 4 = 2"),
    _one("paragraph", "'Press <kbd class=\"k\">Ctrl</kbd> now<br/> and `<b>` too.'"),
    _known("    x = 1\n\n    y = 2", [("indented_code_block", 0, "    x = 1\n\n    y = 2")]),
    _one("heading", _literal("Closing\n-------"), level="2", style="'setext'"),
    _one("heading", "'#### Deep. ####'", "c_custkey % 5 = 0", level="4", style="'atx'"),
    _one("heading", "'### On C#'", "c_custkey % 5 = 1", level="3", style="'atx'"),
    _known(_LOOSE, [
        ("list", 0, _LOOSE), ("list_item", 1, _LOOSE[: _LOOSE.index("\n* >")]), ("paragraph", 2, "* one"), ("paragraph", 2, "  still *one*"),
        ("code_block", 2, "  ```js\n  var x = `1`;\n  ```"), ("list_item", 1, "* > quoted **item**\n  > - [ ] inner"),
        ("blockquote", 2, "* > quoted **item**\n  > - [ ] inner"), ("paragraph", 3, "* > quoted **item**"), ("list", 3, "  > - [ ] inner"),
        ("list_item", 4, "  > - [ ] inner"), ("paragraph", 5, "  > - [ ] inner"),
    ], "c_custkey % 3 = 2"),
    _known("Between.", [("paragraph", 0, "Between.")], "c_custkey % 3 = 2"),
    _known(_DEEP, [
        ("blockquote", 0, _DEEP), ("paragraph", 1, "> Outer\ngoes on"), ("list", 1, "> - a `b`\n> - c"), ("list_item", 2, "> - a `b`"),
        ("paragraph", 3, "> - a `b`"), ("list_item", 2, "> - c"), ("paragraph", 3, "> - c"), ("blockquote", 1, "> > inner *q*"),
        ("paragraph", 2, "> > inner *q*"),
    ], "c_custkey % 4 = 3"),
    _known(_LONG_FENCE, [("code_block", 0, _LONG_FENCE)], "c_custkey % 4 = 0"),
    _known("**a *b* c** and `x *y*`, <b>\nover lines", [("paragraph", 0, "**a *b* c** and `x *y*`, <b>\nover lines")], "c_custkey % 5 = 2"),
    _one("footnote", f"concat('[^1]: Note about ', {_KEY})"),
    _one("footnote", "'[^2]: Never used'", "c_custkey % 3 = 1"),
]
#: Languages of the fences in parts that are the same in all documents.
_LANGUAGES = {"  ```js\n  var x = `1`;\n  ```": "js", _LONG_FENCE: "md"}
_TASKS = next(i for i, part in enumerate(PARTS) if part.blocks[0].kind == "task_list")

_ROW = (
    "concat('| ', cast(o_orderkey as string), ' | ', cast(cast(o_orderdate as date) as string), ' | ',"
    " cast(cast(o_totalprice as decimal(18, 2)) as string), ' |')"
)
_TASK = (
    "concat('- [', case when o_orderstatus = 'F' then 'x' else ' ' end, '] ship ', lower(o_orderpriority), ' order ',"
    " cast(o_orderkey as string))"
)


def _customers(d: Spark, customer: str, orders: str, nation: str) -> str:
    orders_of = f"""select o_custkey, {d.joined(_ROW, f"'{_BREAK}'", "o_orderkey")} as table_rows,
        {d.joined(_TASK, f"'{_BREAK}'", "o_orderkey")} as tasks from {orders} group by o_custkey"""
    return f"{customer} join {nation} on n_nationkey = c_nationkey left join ({orders_of}) o on o_custkey = c_custkey"


def markdown_corpus_sql(dialect: Spark, customer: str = "customer", orders: str = "orders", nation: str = "nation") -> str:
    """``doc_id, text`` over the given table names."""
    end = f"'{_BREAK * 2}'"
    texts = [f"concat({p.text}, {end})" if p.when == "true" else f"case when {p.when} then concat({p.text}, {end}) else '' end" for p in PARTS]
    return f"""select cast(c_custkey as bigint) as doc_id, replace(concat({", ".join(texts)}), '{_BREAK}', chr(10)) as text
        from {_customers(dialect, customer, orders, nation)}"""


def corpus_tree_sql(d: Spark, customer: str = "customer", orders: str = "orders", nation: str = "nation") -> str:
    """The parsed tree of the corpus (``leafgraph.operators.parser.TREE``), from what its parts are known to hold."""
    size = lambda x: f"length({x})"
    feeds = lambda x: f"(length({x}) - length(replace({x}, '{_BREAK}', '')))"
    chars, lines, blocks = [], [], []
    for i, part in enumerate(PARTS):
        held = f"case when {part.when} then"
        before = (" + ".join(chars) or "0", " + ".join(lines) or "0")
        for j, b in enumerate(part.blocks):
            language = f"'{_LANGUAGES[k]}'" if (k := _raw_of(b)) in _LANGUAGES else b.language
            blocks.append(f"""select c_custkey, {i} as part, {j} as block, 0 as piece, '{b.kind}' as node_type, {b.depth} as depth, {before[0]} + {size(b.before)} as place,
                {before[1]} + {feeds(b.before)} as line, {b.raw} as raw, {language} as language, {b.level} as heading_level, {b.style} as heading_style
                from held where {part.when}""")
        if i == _TASKS:  # an item and its paragraph for each task
            items = f"""select o_custkey, {_TASK} as raw, sum(length({_TASK}) + 1) over w - length({_TASK}) - 1 as place, row_number() over w as n
                from {orders} window w as (partition by o_custkey order by o_orderkey rows between unbounded preceding and current row)"""
            for j, (kind, depth) in enumerate([("list_item", 1), ("paragraph", 2)]):
                blocks.append(f"""select c_custkey, {i}, 1, coalesce(2 * t.n, 0) + {j}, '{kind}', {depth}, {before[0]} + coalesce(t.place, 0), {before[1]} + coalesce(t.n, 1) - 1,
                    coalesce(t.raw, '- [ ] nothing'), '', null, null from held left join ({items}) t on t.o_custkey = c_custkey where {part.when}""")
        chars.append(f"{held} {size(part.text)} + 2 else 0 end")
        lines.append(f"{held} {feeds(part.text)} + 2 else 0 end")
    above = "case when depth > 0 then max(case when depth = {k} then block_id end) over before end"
    deepest = max(b.depth for p in PARTS for b in p.blocks)
    known = ", ".join(f"{above.format(k=k)} as last_{k}" for k in range(deepest))
    parent = " ".join(f"when {k + 1} then last_{k}" for k in range(deepest))
    return f"""
    select doc_id, block_id, parent_block, depth, cast(row_number() over (partition by doc_id, parent_block order by block_id) - 1 as int) as sibling_ix,
           node_type, line_start, line_end, char_start, char_end, raw, language, heading_level, heading_style,
           case when node_type in ('list', 'task_list') then case when {d.matches("raw", "^ *[0-9]")} then 'ordered' else 'unordered' end end as list_style,
           case when node_type in ('list', 'task_list') then lists end as list_level
    from (
      select q.*, cast(case depth {parent} end as int) as parent_block,
             cast(case when depth = 0 then 1 when node_type not in ('list', 'task_list') then 0 else 1 + ({" + ".join(
                 f"case when depth > {k} and kind_{k} in ('list', 'task_list') then 1 else 0 end" for k in range(deepest))}) end as int) as lists
      from (
        select b.*, {known}, {", ".join(f"{d.last_known(f'case when depth = {k} then node_type end', 'partition by doc_id order by block_id')} as kind_{k}" for k in range(deepest))}
        from (
          select cast(c_custkey as bigint) as doc_id, cast(row_number() over (partition by c_custkey order by part, block, piece) - 1 as int) as block_id,
                 cast(depth as int) as depth, node_type, cast(line as int) as line_start,
                 cast(line + length(raw) - length(replace(raw, '{_BREAK}', '')) + 1 as int) as line_end, cast(place as int) as char_start,
                 cast(place + length(raw) as int) as char_end, replace(raw, '{_BREAK}', chr(10)) as raw, language,
                 cast(heading_level as int) as heading_level, cast(heading_style as string) as heading_style
          from (with held as (select * from {_customers(d, customer, orders, nation)}) {" union all ".join(blocks)}) u) b
        window before as (partition by doc_id order by block_id rows between unbounded preceding and 1 preceding)) q) r"""


def _raw_of(block: Block) -> str:
    return block.raw[1:-1].replace(_BREAK, "\n").replace("''", "'")


def markdown_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus, dealt by document: its texts are far larger than the rows they are made of, so these are dealt and not the texts."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "orders", "nation")}
    tables["customer"] = tables["customer"].select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").repartition(n, "c_custkey")
    tables["orders"] = tables["orders"].select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority"
    ).repartition(n, "o_custkey")
    return spark.sql(markdown_corpus_sql(SPARK, "{customer}", "{orders}", "{nation}"), **tables)
