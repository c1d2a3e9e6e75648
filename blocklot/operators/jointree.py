"""Sums over the rows of an acyclic chain of joins, without building the rows.

A ``JoinTree`` is a table with the trees that are joined to it, each by equal keys and as
a left or an inner join. The joined rows of such a tree multiply: a job of a community with
17 councils, three schools and 30 buildings stands in 1,530 of them. Sums and counts
by group need none of them. Every table sends one *message* to its parent, from the leaves
up: per join key (and per value of its own group columns) the number of joined rows
below it, and for each measure its sum over them. A parent row multiplies:

* its number of rows is the product of its children's numbers (1 for a left join
  that meets nothing);
* a measure of its own is repeated so many times, and a measure that came from one child
  as often as the others' numbers say.

Each table is reduced to its keys, groups and sums before it meets another (partial
aggregates, combined before the shuffle), so nothing larger than the tables themselves is shuffled.
Hot keys that are left are split (``skew.salted_join``).

Group columns may stand in any table of the tree; those of a left join that meets
nothing are NULL. A sum of no value is 0. The tables may share column names: group columns
and measures are named by the output.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import HOT_KEY_ROWS, salted_join

LEFT, INNER = "left", "inner"


@dataclass
class JoinTree:
    """A table, what is wanted of it, and the trees joined to it.

    ``groups`` and ``sums`` map names of the output to columns of ``table``.
    """

    table: DataFrame
    groups: dict[str, str] = field(default_factory=dict)
    sums: dict[str, str] = field(default_factory=dict)
    children: list[Branch] = field(default_factory=list)

    def join(self, child: JoinTree, on: dict[str, str], how: str = LEFT, null_safe: bool = False) -> JoinTree:
        """This tree with ``child`` joined by ``on`` (column of this table: column of the child's)."""
        if how not in (LEFT, INNER):
            raise ValueError(f"a join tree has left and inner joins, not {how}")
        if not on:
            raise ValueError("a join needs keys")
        return JoinTree(self.table, self.groups, self.sums, [*self.children, Branch(child, on, how, null_safe)])

    def names(self) -> list[str]:
        own = [*self.groups, *self.sums]
        return own + [n for b in self.children for n in b.child.names()]


@dataclass
class Branch:
    child: JoinTree
    on: dict[str, str]
    how: str
    null_safe: bool


def _zero_sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def _message(tree: JoinTree, keys: list[str], rows_per_task: int) -> tuple[DataFrame, list[str], list[str]]:
    """(k0.., groups, n, sums) of the rows of ``tree`` by ``keys`` (of its table) and group columns; the groups; the sums."""
    own_groups, own_sums = list(tree.groups), list(tree.sums)
    needed = [*keys, *[k for b in tree.children for k in b.on]]
    names = {c: f"__k{i}" for i, c in enumerate(dict.fromkeys(needed))}
    table = tree.table.select(
        *[F.col(f"`{c}`").alias(n) for c, n in names.items()],
        *[F.col(f"`{c}`").alias(f"__g_{g}") for g, c in tree.groups.items()],
        *[F.col(f"`{c}`").alias(f"__s_{s}") for s, c in tree.sums.items()])
    # The table itself, reduced to what the joins can tell apart.
    rows = table.groupBy(*names.values(), *[f"__g_{g}" for g in own_groups]).agg(
        F.count(F.lit(1)).alias("__n"), *[_zero_sum(F.col(f"__s_{s}")).alias(f"__s_{s}") for s in own_sums])
    groups, sums = own_groups[:], own_sums[:]
    for b in tree.children:
        below, child_groups, child_sums = _message(b.child, list(b.on.values()), rows_per_task)
        on = [names[c] for c in b.on]
        below = below.select(*[F.col(f"__m{i}").alias(k) for i, k in enumerate(on)], *[f"__g_{g}" for g in child_groups],
                             F.col("__n").alias("__below"), *[f"__s_{s}" for s in child_sums])
        met = salted_join(rows, below, on, how=b.how, null_safe=b.null_safe, rows_per_task=rows_per_task,
                          other_unique=not child_groups)
        times = F.coalesce(F.col("__below"), F.lit(1))
        rows = met.select(
            *names.values(), *[f"__g_{g}" for g in [*groups, *child_groups]], (F.col("__n") * times).alias("__n"),
            *[(F.col(f"__s_{s}") * times).alias(f"__s_{s}") for s in sums],
            *[(F.coalesce(F.col(f"__s_{s}"), F.lit(0)) * F.col("__n")).alias(f"__s_{s}") for s in child_sums])
        groups, sums = groups + child_groups, sums + child_sums
    by = [F.col(names[c]).alias(f"__m{i}") for i, c in enumerate(keys)]
    if tree.children or len(names) > len(dict.fromkeys(keys)) or len(keys) != len(set(keys)):
        out = rows.groupBy(*by, *[f"__g_{g}" for g in groups]).agg(
            F.sum("__n").alias("__n"), *[F.sum(f"__s_{s}").alias(f"__s_{s}") for s in sums])
    else:
        out = rows.select(*by, *[f"__g_{g}" for g in groups], "__n", *[f"__s_{s}" for s in sums])
    return out, groups, sums


def joined_sums(tree: JoinTree, count: str = "joined_rows", rows_per_task: int = HOT_KEY_ROWS) -> DataFrame:
    """The tree's groups, ``count`` (of joined rows) and sums: one row per group, or one in all without groups."""
    names = [*tree.names(), count]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"names of groups, sums and count repeat: {names}")
    out, groups, sums = _message(tree, [], rows_per_task)
    wanted = [F.coalesce(F.col("__n"), F.lit(0)).alias(count), *[F.coalesce(F.col(f"__s_{s}"), F.lit(0)).alias(s) for s in sums]]
    if not groups:
        out = out.agg(F.sum("__n").alias("__n"), *[F.sum(f"__s_{s}").alias(f"__s_{s}") for s in sums])
    return out.select(*[F.col(f"__g_{g}").alias(g) for g in groups], *wanted)
