"""Integrity of several tables that belong together, in one scan of each table and one shuffle of all.

Every row becomes facts: the rules it breaks, the values that must be unique, the keys that somebody asks for, the numbers
that it adds to totals, and its part in each pair of tables. The facts of all tables are aggregated by what they are about,
with partial sums before the shuffle, and rules on repeated values, on missing keys and on both sides of a pair are decided
on the aggregates. A pair of tables is thus compared as by a full outer join, but no table is read or shuffled twice, and a
key that many rows share makes no large group. Rules on totals see one row that holds all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expect import Rule

FINDING = "struct<severity:string,code:string,key:string,message:string,n:bigint>"
_FACT = "struct<kind:string,code:string,key:string,message:string,severity:string,n:bigint,t:array<bigint>,v:array<string>,l:array<string>,r:array<string>>"


@dataclass(frozen=True)
class Table:
    """rules: on one row. unique: code to the value that one row only may have; null and blank values are left out.
    required: code to the keys that must be there and the condition under which a row counts. totals: name to the number that
    a row adds. values: name to the text of a table of one row; of several rows the largest counts."""

    rows: DataFrame
    key: Column
    rules: Sequence[Rule] = ()
    unique: Mapping[str, Column] = field(default_factory=dict)
    required: Mapping[str, tuple[Sequence[str], Column]] = field(default_factory=dict)
    totals: Mapping[str, Column] = field(default_factory=dict)
    values: Mapping[str, Column] = field(default_factory=dict)


@dataclass(frozen=True)
class Side:
    """A table's part in a pair: its key there, what the rules read, and which rows take part."""

    table: str
    key: Column
    fields: Mapping[str, Column] = field(default_factory=dict)
    where: Column | None = None


class Seen:
    """What a rule of a pair sees of one side: texts by name, and whether the key is there."""

    def __init__(self, column: str, names: Sequence[str]):
        self._column, self._names = column, list(names)

    def __call__(self, name: str) -> Column:
        return F.get(F.col(self._column), F.lit(self._names.index(name) + 1))

    @property
    def there(self) -> Column:
        return F.col(self._column).isNotNull()


@dataclass(frozen=True)
class Pair:
    """Two tables by key. Of rows that share a key on one side, the largest by its fields is compared."""

    name: str
    left: Side
    right: Side
    rules: Callable[[Seen, Seen], Sequence[Rule]]


class Totals:
    """What rules on totals see: numbers and texts by name; a name that no table gives is null."""

    def n(self, name: str) -> Column:
        return F.try_element_at(F.col("totals"), F.lit(name)).cast("long")

    def text(self, name: str) -> Column:
        return F.try_element_at(F.col("totals"), F.lit(name))


def _text(x: Column | str) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _fact(kind: str, code: str, key: Column, *, message: Column | str = "", severity: str = "", n: Column | int = 1, **more: Column) -> Column:
    parts = {"kind": F.lit(kind), "code": F.lit(code), "key": F.coalesce(key.cast("string"), F.lit("")), "message": F.coalesce(_text(message).cast("string"), F.lit("")), "severity": F.lit(severity), "n": F.lit(n) if isinstance(n, int) else n}
    parts |= {c: more.get(c, F.lit(None)) for c in ("t", "v", "l", "r")}
    return F.struct(*[v.alias(k) for k, v in parts.items()]).cast(_FACT)


def _given(c: Column) -> Column:
    return F.coalesce(c.cast("string") != "", F.lit(False))


def _facts(name: str, t: Table, pairs: Sequence[Pair], part: Column) -> DataFrame:
    out = [F.when(F.coalesce(r.bad, F.lit(False)), _fact("rule", r.code, t.key, message=r.message, severity=r.severity)) for r in t.rules]
    out += [F.when(_given(v), _fact("unique", code, v, message=f"given again in {name}")) for code, v in t.unique.items()]
    for code, (keys, condition) in t.required.items():
        out.append(F.when(t.key.cast("string").isin(list(keys)) & F.coalesce(condition, F.lit(False)), _fact("required", code, t.key, message=f"missing in {name}")))
    numbers = F.array(*[F.coalesce(c.cast("long"), F.lit(0)) for c in t.totals.values()]) if t.totals else F.lit(None)
    texts = F.array(*[c.cast("string") for c in t.values.values()]) if t.values else F.lit(None)
    if t.totals or t.values:
        out.append(_fact("total", f"total {name}", F.lit(""), t=numbers, v=texts))
    for p in pairs:
        for side, column in ((p.left, "l"), (p.right, "r")):
            if side.table == name:
                held = F.array(F.lit(""), *[c.cast("string") for c in side.fields.values()])
                takes = _given(side.key) & (F.lit(True) if side.where is None else F.coalesce(side.where, F.lit(False)))
                out.append(F.when(takes, _fact("pair", f"pair {p.name}", side.key, **{column: held})))
    return t.rows.select(part.alias("part"), F.inline(F.filter(F.array(*out), lambda x: x.isNotNull())))


def findings(tables: Mapping[str, Table], pairs: Sequence[Pair] = (), totals: Callable[[Totals], Sequence[Rule]] | None = None, parts: DataFrame | None = None) -> DataFrame:
    """severity, code, key, message, n: what is wrong in the tables, in their pairs and in their totals; n rows say the same.

    A condition that is null does not hold. Blank keys take no part in pairs. Empty tables add 0 to their totals, and the
    keys required of them are missing. A name of a total must be given by one table only.

    parts: a table with a column part, one row for each, where the tables hold several releases (of offices, of days) side by
    side in a column part. Each part is then judged by itself, in the same scans and shuffle, and the result has its name.
    """
    spark = next(iter(tables.values())).rows.sparkSession
    # what holds without any row: zeros for all totals, and the keys that are asked for
    given = []
    for name, t in tables.items():
        if t.totals or t.values:
            given.append(_fact("total", f"total {name}", F.lit(""), t=F.array(*[F.lit(0)] * len(t.totals)) if t.totals else F.lit(None)))
        given += [_fact("required", code, F.lit(k), message=f"missing in {name}", n=0) for code, (keys, _) in t.required.items() for k in keys]
    part = F.lit("") if parts is None else F.col("part").cast("string")
    everywhere = spark.range(1) if parts is None else parts
    facts = everywhere.select(part.alias("part"), F.inline(F.array(*given) if given else F.array().cast(f"array<{_FACT}>")))
    for name, t in tables.items():
        facts = facts.unionByName(_facts(name, t, pairs, part))

    n_numbers = max((len(t.totals) for t in tables.values()), default=0)
    n_texts = max((len(t.values) for t in tables.values()), default=0)
    about = facts.groupBy("part", "kind", "code", "key", "message", "severity").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.get("t", F.lit(i))) for i in range(n_numbers)]).cast("array<bigint>").alias("t"),
        F.array(*[F.max(F.get("v", F.lit(i))) for i in range(n_texts)]).cast("array<string>").alias("v"),
        F.max("l").alias("l"),
        F.max("r").alias("r"),
    )

    def told(severity: Column, code: Column | str, key: Column, message: Column | str, n: Column) -> Column:
        return F.struct(severity.alias("severity"), _text(code).alias("code"), key.alias("key"), _text(message).alias("message"), n.alias("n")).cast(FINDING)

    kind, own = F.col("kind"), told(F.col("severity"), F.col("code"), F.col("key"), F.col("message"), F.col("n"))
    found = [
        F.when(kind == "rule", own),
        F.when((kind == "unique") & (F.col("n") > 1), told(F.lit("error"), F.col("code"), F.col("key"), F.col("message"), F.col("n"))),
        F.when((kind == "required") & (F.col("n") == 0), told(F.lit("error"), F.col("code"), F.col("key"), F.col("message"), F.lit(1))),
    ]
    for p in pairs:
        for r in p.rules(Seen("l", list(p.left.fields)), Seen("r", list(p.right.fields))):
            broken = (F.col("code") == f"pair {p.name}") & F.coalesce(r.bad, F.lit(False))
            found.append(F.when(broken, told(F.lit(r.severity), r.code, F.col("key"), F.coalesce(_text(r.message), F.lit("")), F.lit(1))))
    named = []
    for name, t in tables.items():
        numbers = [F.struct(F.lit(x).alias("name"), F.get("t", F.lit(i)).cast("string").alias("value")) for i, x in enumerate(t.totals)]
        texts = [F.struct(F.lit(x).alias("name"), F.get("v", F.lit(i)).alias("value")) for i, x in enumerate(t.values)]
        if numbers or texts:
            named.append(F.when(F.col("code") == f"total {name}", F.array(*numbers, *texts)))
    none = F.array().cast("array<struct<name:string,value:string>>")
    columns = [*(["part"] if parts is not None else []), "severity", "code", "key", "message", "n"]
    step = about.select("part", F.filter(F.array(*found), lambda x: x.isNotNull()).alias("found"), (F.coalesce(*named, none) if named else none).alias("named"), (kind == "total").alias("is_total"))
    if totals is None:
        return step.select("part", F.inline("found")).select(*columns)
    # one more aggregate brings the few rows of totals together; findings pass through it, equal ones of several pairs as one
    rows = step.select("part", F.explode(F.when(F.col("is_total"), F.array(F.lit(None).cast(FINDING))).otherwise(F.col("found"))).alias("f"), "named")
    said = F.when(F.col("f").isNotNull(), F.struct("f.severity", "f.code", "f.key", "f.message"))
    rows = rows.groupBy("part", said.alias("said")).agg(F.sum("f.n").alias("n"), F.flatten(F.collect_list(F.when(F.col("f").isNull(), F.col("named")))).alias("named"))
    rows = rows.withColumn("totals", F.map_from_entries("named"))
    f = F.when(F.col("said").isNotNull(), told(F.col("said.severity"), F.col("said.code"), F.col("said.key"), F.col("said.message"), F.col("n")))
    by_total = [F.when(F.coalesce(r.bad, F.lit(False)), told(F.lit(r.severity), r.code, F.lit(""), F.coalesce(_text(r.message), F.lit("")), F.lit(1))) for r in totals(Totals())]
    out = F.when(F.col("said").isNull(), F.array(*by_total)).otherwise(F.array(f))
    return rows.select("part", F.inline(F.filter(out, lambda x: x.isNotNull()))).select(*columns)
