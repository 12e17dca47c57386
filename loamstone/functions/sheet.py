"""Layers of named expressions over a table, stated once and rendered for Spark SQL and for DuckDB.

Arithmetic is plain SQL that both engines read alike. What they spell
differently (patterns, arrays, lambdas) goes through the small vocabulary of a
dialect. Every layer becomes one projection; a column that later layers name
several times is computed once, as Catalyst does not merge such projections.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from loamstone.functions.needed import guard

ONE = re.compile(r"\[(?:[^\\\[\]&]|\\.)+\]|\\[pP]\{\w+\}")  # patterns of one sign
WHOLE = ("text", "t", "lower(text)", "flat")  # long columns, for which strings are looked for before a pattern
WS = r"[ \t\n\f\r\x0b\p{Z}\x{85}]"
TOKEN = r"[^ \t\n\f\r\x0b\p{Z}\x{85}]+"
WORD = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_\x27]*[\p{L}\p{N}_])?"


class SparkDialect:
    def lit(self, p: str) -> str:
        return "r'" + p + "'"

    def n(self, c: str, p: str) -> str:
        if ONE.fullmatch(p):  # runs taken out shorten a text by their signs, and no array of single signs is made
            return f"CAST(length({c}) - length(regexp_replace({c}, {self.lit(p + '+')}, '')) AS DOUBLE)"
        found = f"CAST(regexp_count({c}, {self.lit(p)}) AS DOUBLE)"
        may = c in WHOLE and guard(c, p)
        return f"(CASE WHEN NOT ({may}) THEN 0D ELSE {found} END)" if may else found

    def has(self, c: str, p: str) -> str:
        found = f"regexp_like({c}, {self.lit(p)})"
        may = c in WHOLE and guard(c, p)
        return f"(CASE WHEN NOT ({may}) THEN false ELSE {found} END)" if may else found

    def all(self, c: str, p: str) -> str:
        return f"regexp_extract_all({c}, {self.lit(p)}, 0)"

    def replace(self, c: str, p: str, by: str) -> str:
        return f"regexp_replace({c}, {self.lit(p)}, '{by}')"

    def split(self, c: str, p: str) -> str:
        return f"split({c}, {self.lit(p)}, -1)"

    def size(self, a: str) -> str:
        return f"CAST(size({a}) AS DOUBLE)"

    def filter(self, a: str, cond: str) -> str:
        return f"filter({a}, x -> {cond})"

    def map(self, a: str, e: str) -> str:
        return f"transform({a}, x -> {e})"

    def sum(self, a: str, e: str) -> str:
        return f"aggregate({a}, CAST(0 AS DOUBLE), (s, x) -> s + {e})"

    def distinct(self, a: str) -> str:
        return f"array_distinct({a})"

    def first(self, a: str, k: int) -> str:
        return f"slice({a}, 1, {k})"

    def last(self, a: str) -> str:
        return f"coalesce(try_element_at({a}, -1), '')"

    def top(self, a: str) -> str:
        """Uses of the most frequent element, by the runs of the sorted array; 0 for an empty one."""
        step = "named_struct('p', x, 'r', if(x = s.p, s.r + 1, 1D), 'b', greatest(s.b, if(x = s.p, s.r + 1, 1D)))"
        return f"aggregate(sort_array({a}), named_struct('p', CAST('' AS STRING), 'r', 0D, 'b', 0D), (s, x) -> {step}, s -> s.b)"

    def pairs(self, a: str) -> str:
        return f"zip_with(slice({a}, 1, greatest(size({a}) - 1, 0)), slice({a}, 2, greatest(size({a}) - 1, 0)), (x, y) -> concat(x, ' ', y))"

    def grams(self, c: str, size: int, stride: int) -> str:
        """Stretches of `size` signs at every stride of a text."""
        parts = ", ".join(f"element_at(x, i + {k})" for k in range(1, size + 1))
        return f"element_at(transform(array({self.split(c, '')}), x -> if(size(x) >= {size}, transform(sequence(0, size(x) - {size}, {stride}), i -> concat({parts})), array())), 1)"

    def max_of(self, named: dict[str, str]) -> str:
        """Name of the greatest value; of equal ones the first."""
        k = len(named)
        return f"array_max(array({', '.join(f'named_struct({chr(39)}v{chr(39)}, {e}, {chr(39)}o{chr(39)}, {k - i}, {chr(39)}k{chr(39)}, {chr(39)}{name}{chr(39)})' for i, (name, e) in enumerate(named.items()))})).k"

    def sha(self, c: str) -> str:
        return f"sha2({c}, 256)"

    def text_of(self, a: str, sep: str) -> str:
        return f"array_join({a}, '{sep}')"

    def entropy(self, c: str) -> str:
        """Bits of a sign. The count of a sign is the bytes that go with it, over its own; long texts count runs of their sorted signs instead."""
        bind = "named_struct('t', coalesce({c}, ''), 'n', greatest(CAST(length(coalesce({c}, '')) AS DOUBLE), 1D), 'b', octet_length(coalesce({c}, '')))".format(c=c)
        counts = "transform(filter(array_distinct(split(v.t, '', -1)), x -> x <> ''), x -> (v.b - octet_length(replace(v.t, x, ''))) / octet_length(x))"
        few = f"aggregate({counts}, 0D, (s, k) -> s - (k / v.n) * log2(k / v.n))"
        add = "if(s.r > 0, s.h - (s.r / v.n) * log2(s.r / v.n), s.h)"
        step = f"named_struct('p', x, 'r', if(x = s.p, s.r + 1, 1D), 'h', if(x = s.p, s.h, {add}))"
        many = f"aggregate(sort_array(filter(split(v.t, '', -1), x -> x <> '')), named_struct('p', CAST('' AS STRING), 'r', 0D, 'h', 0D), (s, x) -> {step}, s -> {add})"
        return f"element_at(transform(array({bind}), v -> CASE WHEN v.b <= 32768 THEN {few} ELSE {many} END), 1)"

    def outside(self, c: str, e: str) -> str:
        """A text with e, an expression of x, in place of every stretch outside fences."""
        return f"array_join(transform({self.split(c, '```')}, (x, i) -> CASE WHEN i % 2 = 0 THEN {e} ELSE x END), '```')"

    def lines(self, c: str, cond: str) -> str:
        """A text without the lines that meet a condition on x."""
        return f"array_join(filter({self.split(c, chr(92) + 'n')}, x -> NOT ({cond})), '\\n')"

    def once(self, a: str) -> str:
        """Pieces of a text, each at its first place, by blank lines."""
        return f"array_join(array_distinct({a}), '\\n\\n')"

    def join(self, parts: list[str]) -> str:
        """The non-null ones of some strings, by commas."""
        return f"concat_ws(',', {', '.join(parts)})"


class DuckDialect(SparkDialect):
    def lit(self, p: str) -> str:
        return "'" + p + "'"

    def n(self, c: str, p: str) -> str:
        return f"CAST(len(regexp_extract_all({c}, {self.lit(p)})) AS DOUBLE)"

    def has(self, c: str, p: str) -> str:
        return f"regexp_matches({c}, {self.lit(p)})"

    def all(self, c: str, p: str) -> str:
        return f"regexp_extract_all({c}, {self.lit(p)})"

    def replace(self, c: str, p: str, by: str) -> str:
        return f"regexp_replace({c}, {self.lit(p)}, '{by}', 'g')"

    def split(self, c: str, p: str) -> str:
        return f"string_split({c}, '')" if p == "" else f"regexp_split_to_array({c}, {self.lit(p)})"

    def size(self, a: str) -> str:
        return f"CAST(len({a}) AS DOUBLE)"

    def filter(self, a: str, cond: str) -> str:
        return f"list_filter({a}, lambda x: {cond})"

    def map(self, a: str, e: str) -> str:
        return f"list_transform({a}, lambda x: {e})"

    def sum(self, a: str, e: str) -> str:
        return f"coalesce(list_sum(list_transform({a}, lambda x: CAST({e} AS DOUBLE))), 0)"

    def distinct(self, a: str) -> str:
        return f"list_distinct({a})"

    def first(self, a: str, k: int) -> str:
        return f"({a})[1:{k}]"

    def last(self, a: str) -> str:
        return f"coalesce(({a})[-1], '')"

    def top(self, a: str) -> str:
        return f"CAST(coalesce(list_max(map_values(list_aggregate({a}, 'histogram'))), 0) AS DOUBLE)"

    def pairs(self, a: str) -> str:
        return f"list_transform(range(1, greatest(len({a}), 1)), lambda i: ({a})[i] || ' ' || ({a})[i + 1])"

    def grams(self, c: str, size: int, stride: int) -> str:
        return f"list_transform(range(0, greatest(length({c}) - {size - 1}, 0), {stride}), lambda i: substr({c}, i + 1, {size}))"

    def max_of(self, named: dict[str, str]) -> str:
        rest = [f"WHEN {e} >= greatest({', '.join(named.values())}) THEN '{name}'" for name, e in named.items()]
        return f"CASE {' '.join(rest)} END"

    def sha(self, c: str) -> str:
        return f"sha256({c})"

    def text_of(self, a: str, sep: str) -> str:
        return f"array_to_string({a}, '{sep}')"

    def entropy(self, c: str) -> str:
        return f"coalesce(list_sum(list_transform(map_values(list_aggregate(list_filter(string_split({c}, ''), lambda x: x <> ''), 'histogram')), lambda k: -(k / length({c})) * log2(k / length({c})))), 0.0)"

    def outside(self, c: str, e: str) -> str:
        return f"array_to_string(list_transform({self.split(c, '```')}, lambda x, i: CASE WHEN i % 2 = 1 THEN {e} ELSE x END), '```')"

    def lines(self, c: str, cond: str) -> str:
        return f"array_to_string(list_filter({self.split(c, chr(92) + 'n')}, lambda x: NOT ({cond})), chr(10))"

    def once(self, a: str) -> str:
        return f"array_to_string([({a})[i] FOR i IN range(1, len({a}) + 1) IF list_position({a}, ({a})[i]) = i], chr(10) || chr(10))"

    def join(self, parts: list[str]) -> str:
        return f"array_to_string(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL), ',')"


SPARK, DUCK = SparkDialect(), DuckDialect()
Expr = str | Callable[[SparkDialect], str]


class Sheet:
    """Layers of name -> expression; an expression is SQL, or a function of the dialect that gives it."""

    def __init__(self, layers: list[dict[str, Expr]] | None = None):
        self.layers = list(layers or [])

    def then(self, **columns: Expr) -> Sheet:
        return Sheet([*self.layers, columns])

    def __add__(self, other: Sheet) -> Sheet:
        return Sheet([*self.layers, *other.layers])

    def spark(self, df: DataFrame) -> DataFrame:
        for layer in self.layers:
            df = df.selectExpr("*", *[f"{_sql(e, SPARK)} AS {k}" for k, e in layer.items()])
        return df

    def duck(self, source: str) -> str:
        for layer in self.layers:
            source = f"(SELECT *, {', '.join(f'{_sql(e, DUCK)} AS {k}' for k, e in layer.items())} FROM {source})"
        return source


def _sql(e: Expr, d: SparkDialect) -> str:
    return e if isinstance(e, str) else e(d)


# --- arithmetic that both engines read alike -----------------------------------
def mean(values: list[str]) -> str:
    return f"(({' + '.join(values)}) / {len(values)}.0)"


def sat(v: str, peers: list[str]) -> str:
    """v against the mean of its peers, at least a quarter of v."""
    return f"(CASE WHEN ({v}) <= 0 THEN 0.0 ELSE greatest(0.0, least(1.0, ({v}) / (({v}) + greatest({mean(peers)}, ({v}) * 0.25)))) END)"


def spread(values: list[str]) -> str:
    high, low = f"greatest({', '.join(values)})", f"least({', '.join(values)})"
    return f"(CASE WHEN {high} <> {low} THEN {high} - {low} ELSE {mean(values)} END)"


def base(values: list[str]) -> str:
    """Strength of evidence among itself: the greatest saturation, 0.85 of a value that stands alone among several."""
    if len(values) == 1:
        return f"(CASE WHEN {values[0]} > 0 THEN least(1.0, {values[0]}) ELSE 0.0 END)"
    positive = " + ".join(f"(CASE WHEN {v} > 0 THEN 1 ELSE 0 END)" for v in values)
    # the greatest value has the greatest saturation, as all share one mean
    high = f"greatest({', '.join(values)})"
    return f"(CASE WHEN ({positive}) = 0 THEN 0.0 WHEN ({positive}) = 1 THEN least(1.0, {high} * 0.85) ELSE {sat(high, values)} END)"


def rate(count: str, *totals: str) -> str:
    """A count against its rates over several totals."""
    return sat(count, [f"({count}) / greatest({t}, 1.0)" for t in totals])


def clip(e: str) -> str:
    return f"greatest(0.0, least(1.0, {e}))"
