"""The few places where Spark SQL and DuckDB spell the same relation differently."""

from __future__ import annotations

from collections.abc import Iterable

from leafgraph.config import Config


class Spark:
    name = "spark"
    size = "array_size"
    doubles = "array<double>"
    group_1 = "$1"

    def __init__(self, config: Config | None = None, replaced: Iterable[str] = (), given: Iterable[str] = ()) -> None:
        #: What relations read their limits and thresholds from.
        self.config = config or Config()
        #: Relations that the caller gives; those that read them can't take a pass over the texts instead.
        self.replaced = frozenset(replaced)
        #: Of these the tables: nothing that they were made of is needed.
        self.given = frozenset(given)

    def sweeps(self, *read: str) -> bool:
        """Whether a pass over the texts may stand for a relation that reads ``read``."""
        return self.name == "spark" and not self.replaced & set(read)

    def array(self, *values: str) -> str:
        return f"array({', '.join(values)})"

    def rx(self, pattern: str) -> str:
        return "r'" + pattern + "'"

    def matches(self, value: str, pattern: str) -> str:
        return f"({value} rlike {self.rx(pattern)})"

    def all_matches(self, value: str, pattern: str) -> str:
        return f"regexp_extract_all({value}, {self.rx(pattern)}, 0)"

    def extract(self, value: str, pattern: str, group: int = 1) -> str:
        return f"regexp_extract({value}, {self.rx(pattern)}, {group})"

    def replace(self, value: str, pattern: str, by: str) -> str:
        return f"regexp_replace({value}, {self.rx(pattern)}, '{by}')"

    def split(self, value: str, separator: str) -> str:
        return f"split({value}, {separator}, -1)"

    def explode(self, source: str, keep: str, array: str, pos: str, val: str, where: str = "true") -> str:
        return f"select {keep}, {pos}, {val} from {source} lateral view posexplode({array}) as {pos}, {val} where {where}"

    def sequence(self, first: str, last: str) -> str:
        return f"sequence({first}, {last})"

    def json_text(self, value: str) -> str:
        """A string as a JSON string."""
        return f"substring(to_json(named_struct('t', {value})), 6, length(to_json(named_struct('t', {value}))) - 6)"

    def joined(self, value: str, separator: str, *order: str, when: str = "true") -> str:
        keys = ", ".join(f"{k} as k{i}" for i, k in enumerate(order))
        return (
            f"array_join(transform(array_sort(collect_list(struct({keys}, {value} as v)) filter (where {when})), x -> x.v), {separator})"
        )

    def last_known(self, value: str, over: str) -> str:
        return f"last_value({value}) ignore nulls over ({over})"

    def dot(self, a: str, b: str) -> str:
        return f"aggregate(zip_with({a}, {b}, (x, y) -> cast(x as double) * cast(y as double)), 0D, (s, x) -> s + x)"

    def cosine(self, a: str, b: str) -> str:
        """Cosine of two vectors; 0 where one is missing or zero."""
        return f"coalesce({self.dot(a, b)} / nullif(sqrt({self.dot(a, a)}) * sqrt({self.dot(b, b)}), 0), 0)"

    def values(self, rows: str, name: str, columns: str) -> str:
        return f"select * from values {rows} as {name}({columns})"


class DuckDb(Spark):
    name = "duckdb"
    size = "len"
    doubles = "double[]"
    group_1 = r"\1"

    def array(self, *values: str) -> str:
        return f"[{', '.join(values)}]"

    def rx(self, pattern: str) -> str:
        return "'" + pattern + "'"

    def matches(self, value: str, pattern: str) -> str:
        return f"regexp_matches({value}, {self.rx(pattern)})"

    def all_matches(self, value: str, pattern: str) -> str:
        return f"regexp_extract_all({value}, {self.rx(pattern)})"

    def replace(self, value: str, pattern: str, by: str) -> str:
        return f"regexp_replace({value}, {self.rx(pattern)}, '{by}', 'g')"

    def split(self, value: str, separator: str) -> str:
        return f"string_split({value}, {separator.replace(chr(92) + chr(92), '')})"

    def explode(self, source: str, keep: str, array: str, pos: str, val: str, where: str = "true") -> str:
        inner = f"select *, {array} as __l from {source} where {where}"
        return f"select {keep}, generate_subscripts(__l, 1) - 1 as {pos}, unnest(__l) as {val} from ({inner})"

    def joined(self, value: str, separator: str, *order: str, when: str = "true") -> str:
        return f"coalesce(string_agg({value}, {separator} order by {', '.join(order)}) filter (where {when}), '')"

    def sequence(self, first: str, last: str) -> str:
        return f"range({first.replace(' div ', ' // ')}, {last.replace(' div ', ' // ')} + 1)"

    def json_text(self, value: str) -> str:
        return f"cast(to_json({value}) as varchar)"

    def last_known(self, value: str, over: str) -> str:
        return f"last_value({value} ignore nulls) over ({over})"

    def dot(self, a: str, b: str) -> str:
        return f"list_dot_product({a}::double[], {b}::double[])"

    def values(self, rows: str, name: str, columns: str) -> str:
        return f"select * from (values {rows}) as {name}({columns})"


SPARK, DUCKDB = Spark(), DuckDb()
