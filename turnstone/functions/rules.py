"""Rule tables: facts computed once per row as bits of one number, rules that name the facts they need.

A rule is one test of that number under a mask.  The rules of a table pick one number per row and the labels are looked up by it.
Written as a CASE over text columns the same rules repeat every comparison; large
tables then compile into a method the JVM refuses to optimise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.functions.scalars import last_match


def words_of(rules: Sequence[tuple]) -> set[str]:
    return {w.removeprefix("not ") for rule in rules for w in rule[-1]}


def apply_rules(
    df: DataFrame, facts: Mapping[str, Column], tables: Mapping[str, Sequence[tuple]], defaults: Mapping[str, tuple]
) -> DataFrame:
    """Add the columns of each rule table.

    A table maps a prefix-free name to rules ``(value, ..., [facts])``; its
    columns are the keys of ``defaults[name]`` in order with their default values.
    "not x" asks that a fact is missing.  The last rule that fits stays.
    """
    asked = sorted(set().union(*[words_of(t) for t in tables.values()]))
    bit = {fact: 1 << i for i, fact in enumerate(asked)}  # at most 63 facts
    mask = reduce(Column.bitwiseOR, [F.when(facts[f], F.lit(bit[f]).cast("long")).otherwise(0) for f in asked])
    out = df.withColumn("_facts", mask)

    def fits(words: Sequence[str]) -> Column:
        asked_for = sum(bit[w.removeprefix("not ")] for w in words)
        needed = sum(bit[w] for w in words if not w.startswith("not "))
        return F.col("_facts").bitwiseAND(F.lit(asked_for).cast("long")) == F.lit(needed).cast("long")

    out = out.withColumns({
        f"_rule_{t}": last_match([(fits(rule[-1]), i) for i, rule in enumerate(rules, 1)], 0) for t, rules in tables.items()})
    values = {}
    for table, rules in tables.items():
        for place, (column, default) in enumerate(defaults[table]):
            options = F.array(F.lit(default), *[F.lit(rule[place]) for rule in rules])
            values[column] = F.get(options, F.col(f"_rule_{table}"))
    return out.withColumns(values).drop("_facts", *[f"_rule_{t}" for t in tables])
