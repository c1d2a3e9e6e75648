"""Merkle dataset manifest with incremental witnesses (operator 13).

Every row is a leaf: H, the lowercase hex SHA-256, of its fields, each written as its
UTF-8 byte count, ``:`` and its value (null: ``-``). Per group (``lang``) the leaves stand
in the order of doc_id; while several nodes remain, every two consecutive ones become
the H of their hex digests, a last one alone the H of its own. What remains is the
group's *subroot*. The subroots, in the order of the group (null first, bytewise), give
the *root* in the same way.

*Incremental witnesses.* ``Appender`` takes leaves one by one. It keeps the open subtrees,
at most one of each height, like the digits of a binary counter. Each has the *partial witnesses* of
its leaves: the sibling digests from the leaf up to the subtree's root. When a sibling
is completed the two become one, and every witness in them gets the digest of the other half.

*Distributed.* Leaves are cut into aligned blocks of ``2**BLOCK_LEVELS``. A block is appended
by one task; its root is a node at that height, and a further append to the appender of
the next height, whose blocks are again spread over tasks, until one block is left per group; then the same
for the subroots. A block's witness extends those of all its leaves: it is sent down to the
block, level by level, by equi-joins on (group, block). A group of any size is so many
blocks, and no task sees more than a block at a time.

*Order.* The place of a leaf in its group comes from a range sort of (group, doc_id, leaf)
and the counts of each (partition, group), which are summed up per group by a window over one row per partition.

Defined results: null fields are ``-``, a null doc_id comes first. Rows that repeat a doc_id stand
in the order of their leaves, so equal rows are interchangeable. A group of one row has its
leaf as subroot, an only group its subroot as root. An empty table gives an empty result.
Other columns are not read; a column that is missing counts as null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, crc32_of_id, drop_caches, materialise, read_table, ship_package

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_LEVELS = 10
#: Sides a sibling can stand on.
LEFT, RIGHT, NONE = -1, 1, 0


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values: Sequence[Column]) -> Column:
    """H of the fields of a row."""
    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[written(v) for v in values]).cast("binary"), 256)


class Appender:
    """Streaming append of nodes to a tree of at most ``levels`` levels, with the witness of each.

    ``levels`` None: as many as the nodes need. Otherwise the tree is lifted to that height,
    as it is where the nodes are a block of a larger tree.
    """

    def __init__(self, levels: int | None, witnesses: bool = True):
        self.levels, self.keep = levels, witnesses
        self.open: list[tuple[int, str, int, int]] = []  # height, digest, first node, end
        self.count = 0
        #: Of each node: (side, sibling digest) from below; the side is where the sibling stands.
        self.witness: list[list[tuple[int, str]]] = []

    def _extend(self, first: int, end: int, side: int, sibling: str) -> None:
        if self.keep:
            for k in range(first, end):
                self.witness[k].append((side, sibling))

    def _join(self, last: int) -> None:
        """Joins the two smallest open subtrees, of equal height."""
        height, right, a, b = self.open.pop()
        _, left, first, _ = self.open.pop()
        self._extend(first, a, RIGHT, right)
        self._extend(a, b, LEFT, left)
        self.open.append((height + 1, digest(left, right), first, b))

    def append(self, node: str) -> None:
        self.witness.append([])
        self.open.append((0, node, self.count, self.count + 1))
        self.count += 1
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._join(self.count)

    def close(self) -> str:
        """The root; subtrees that never got a sibling are lifted alone."""
        while len(self.open) > 1 or (self.levels is not None and self.open[0][0] < self.levels):
            height, node, a, b = self.open.pop()
            if self.open and self.open[-1][0] == height:
                self.open.append((height, node, a, b))
                self._join(self.count)
            else:
                self._extend(a, b, NONE, "")
                self.open.append((height + 1, digest(node), a, b))
        return self.open[0][1]


def fold(node: str, witness: Sequence[tuple[int, str]]) -> str:
    """The root that ``node`` and its witness give."""
    for side, sibling in witness:
        node = digest(sibling, node) if side == LEFT else digest(node, sibling)
    return node


def positions(nodes: DataFrame, order: Sequence[Column], kept: Sequence[str]) -> DataFrame:
    """(group, at, n, *kept): the place of each row of ``nodes`` in its group, and the group's size."""
    ship_package(nodes.sparkSession)
    by = [F.col("group"), *order]
    dealt = materialise(nodes.repartitionByRange(*by).withColumn("part", F.spark_partition_id()).select(
        "part", "group", *kept), "merkle-dealt")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        mark, at = None, 0
        for batch in batches:
            out = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                mark, at = (key, 0) if key != mark else (mark, at + 1)
                out.append(at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], [*batch.schema.names, "within"])

    parts = 1 + (dealt.select(F.max("part")).first()[0] or 0)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema) + ", within bigint"
    numbered = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions(
        "part", "group", *order).mapInArrow(number, schema)
    counts = dealt.groupBy("group", "part").agg(F.count(F.lit(1)).alias("own"))  # one row per partition and group in it
    group = Window.partitionBy("group")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialise(counts.select("group", "part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("base"),
                                      F.sum("own").over(group).alias("n")), "merkle-bases")
    return numbered.join(bases, ["group", "part"]).select(
        "group", (F.col("base") + F.col("within")).alias("at"), "n", *kept)


def _level(nodes: DataFrame, levels: int) -> DataFrame:
    """(group, at, n, node) of the blocks of ``nodes`` (group, at, n, node), n the blocks of the group."""
    size = 1 << levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        key, tree = None, None
        for batch in batches:
            done = []
            for group, at, n, node in zip(*(c.to_pylist() for c in batch.columns)):
                if (group, at // size) != key:
                    if tree is not None:
                        done.append((*key, blocks, tree.close()))
                    key, blocks, tree = (group, at // size), -(-n // size), Appender(None if n <= size else levels, False)
                tree.append(node)
            if done:
                yield _nodes(done)
        if tree is not None:
            yield _nodes([(*key, blocks, tree.close())])

    return nodes.select("group", "at", "n", "node").repartition(F.col("group"), F.floor(F.col("at") / size)).sortWithinPartitions(
        "group", "at").mapInArrow(run, "group string, at bigint, n bigint, node string")


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], ["group", "at", "n", "node"])


#: A witness: sides and digests of the siblings, from below.
WITNESS = "array<struct<side:int,digest:string>>"


def _witnesses(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """(group, at, node, *rest, witness, top): the witness of each of ``nodes`` in its block and, from ``above``, on from there.

    ``nodes`` (group, at, n, node, *rest); ``above`` (group, block, upper, top): the witness of each
    block's root, and the root it leads to.
    """
    size = 1 << levels
    rest = [c for c in nodes.columns if c not in ("group", "at", "n", "node")]
    kinds = "".join(f", `{c}` {nodes.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        upper, top, waiting, key, n = None, None, [], None, 0

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(waiting).combine_chunks()
            tree = Appender(None if n <= size else levels)
            for node in rows["node"].to_pylist():
                tree.append(node)
            tree.close()
            full = [w + upper for w in tree.witness]
            ends = [0]
            for w in full:
                ends.append(ends[-1] + len(w))
            entries = pa.StructArray.from_arrays(
                [pa.array([s for w in full for s, _ in w], pa.int32()), pa.array([d for w in full for _, d in w], pa.string())],
                ["side", "digest"])
            columns = [rows[c].combine_chunks() for c in ("group", "at", "node", *rest)]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries), pa.array([top] * len(full), pa.string())],
                ["group", "at", "node", *rest, "witness", "top"])

        for batch in batches:
            keys = list(zip(batch.column("group").to_pylist(), batch.column("block").to_pylist()))
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
            for a, b in zip(starts, starts[1:]):
                if keys[a] != key:
                    if waiting:
                        yield block()
                        waiting.clear()
                    # The row of the block's root comes first.
                    key, top = keys[a], batch.column("top")[a].as_py()
                    upper = [(w["side"], w["digest"]) for w in batch.column("upper")[a].as_py()]
                    a += 1
                if a < b:
                    n = batch.column("n")[a].as_py()
                    waiting.append(batch.slice(a, b - a))
        if waiting:
            yield block()

    own = nodes.withColumn("block", F.floor(F.col("at") / size).cast("bigint"))
    both = own.unionByName(above, allowMissingColumns=True)
    return both.repartition("group", "block").sortWithinPartitions(
        "group", "block", F.col("at").asc_nulls_first()).select(
        "group", "block", "at", "n", "node", *rest, "upper", "top").mapInArrow(
        run, f"group string, at bigint, node string{kinds}, witness {WITNESS}, top string")


class Tree:
    """The nodes of every height that blocks have, in written tables."""

    def __init__(self, nodes: DataFrame, levels: int = BLOCK_LEVELS):
        """``nodes``: (group, at, n, node, *rest)."""
        self.levels, self.steps = levels, []
        current = materialise(nodes, "merkle-nodes")
        while True:
            self.steps.append(current)
            current = materialise(_level(current, levels), "merkle-level")
            if current.where("n > 1").isEmpty():
                break
        #: (group, node): what remains of each group.
        self.roots = current.select("group", "node")

    def witnesses(self, top: DataFrame) -> DataFrame:
        """(group, at, node, *rest, witness, top) of every node; ``top`` (group, upper, top) is where each group's root leads."""
        above = top.select("group", F.lit(0).cast("bigint").alias("block"), "upper", "top")
        for step in reversed(self.steps[1:]):
            found = materialise(_witnesses(step, above, self.levels), "merkle-witness")
            above = found.select("group", F.col("at").alias("block"), F.col("witness").alias("upper"), "top")
        return _witnesses(self.steps[0], above, self.levels)


def manifest(leaves: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """(lang, node, *rest, subroot, root, witness) of ``leaves`` (lang, doc_id, node, *rest).

    ``witness`` has the siblings of each leaf up to the root, from below.
    """
    rest = [c for c in leaves.columns if c not in ("lang", "node")]
    keyed = leaves.withColumn("group", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")))  # null first, then bytewise
    lower = Tree(positions(keyed.drop("lang"), [F.col("doc_id").asc_nulls_first(), F.col("node")], ["node", *rest]), levels)
    subroots = lower.roots.select(F.lit("").alias("group"), F.col("group").alias("name"), "node")
    upper = Tree(positions(subroots, [F.col("name")], ["node", "name"]), levels)
    found = upper.witnesses(upper.roots.select("group", F.array().cast(WITNESS).alias("upper"), F.col("node").alias("top")))
    tops = materialise(found.select(F.col("name").alias("group"), F.col("node").alias("top"), F.col("witness").alias("upper")),
                       "merkle-subroots")
    root = upper.roots.first()  # one row, or none of an empty table
    return lower.witnesses(tops).select(
        F.when(F.col("group") != "", F.expr("substring(group, 2)")).alias("lang"), "node", *rest, F.col("top").alias("subroot"),
        F.lit(root.node if root else None).cast("string").alias("root"), "witness")


def folded(node: Column, witness: Column) -> Column:
    """The root that a node and its witness give, as a DataFrame expression."""
    def step(acc: Column, w: Column) -> Column:
        both = F.when(w.side == LEFT, F.concat(w.digest, acc)).otherwise(F.concat(acc, w.digest))
        return F.sha2(both.cast("binary"), 256)
    return F.aggregate(witness, node, step)


def proof_digest(witness: Column) -> Column:
    """H of the siblings, from below."""
    return F.sha2(F.array_join(F.transform(witness, lambda w: w.digest), "").cast("binary"), 256)


def document_leaves(docs: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """(lang, doc_id, node, *extra) of each row of ``docs``."""
    values = fields(docs)
    return docs.select(values["lang"].alias("lang"), values["doc_id"].alias("doc_id"), leaf(list(values.values())).alias("node"),
                       *[c.alias(name) for name, c in (extra or {}).items()])


def fields(docs: DataFrame) -> dict[str, Column]:
    return {c: col(docs, c) if c in docs.columns else F.lit(None).cast("string") for c in FIELDS}


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    values = fields(docs)
    tampered = leaf(list((values | {"n_chars": values["n_chars"] + 1}).values()))
    hit = F.pmod(crc32_of_id(values["doc_id"]), F.lit(7)) == 0
    found = manifest(document_leaves(docs, {"changed": F.when(hit, tampered)}))
    out = found.select("doc_id", F.col("node").alias("leaf"), "subroot", "root", proof_digest(F.col("witness")).alias("proof_sha256"),
                       folded(F.coalesce("changed", "node"), F.col("witness")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {"op13_merkle": op13_merkle}
ORACLE_SQL = {"op13_merkle": """
with recursive
d as (select *, list_reduce(
    flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(doc_id::varchar, '')]),
    lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end,
    4294967295::bigint) as crc from documents),
f as (select doc_id, lang, coalesce(xor(crc, 4294967295) % 7 = 0, false) as hit, coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as c,
    coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') as c1,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') as a, coalesce(strlen(text) || ':' || text, '-') as b from d),
l as (select doc_id, lang, sha256(a || c || b) as leaf, case when hit then sha256(a || c1 || b) else sha256(a || c || b) end as changed,
    row_number() over (partition by lang order by doc_id nulls first, sha256(a || c || b)) - 1 as place,
    count(*) over (partition by lang) as n from f),
t as (
  select lang, 0 as lvl, place, n, leaf as node from l
  union all
  select x.lang, x.lvl + 1, x.place // 2, (x.n + 1) // 2, sha256(x.node || coalesce(y.node, ''))
  from t x left join t y on x.lang is not distinct from y.lang and y.place = x.place + 1 where x.n > 1 and x.place % 2 = 0),
s as (select lang, node as subroot, row_number() over (order by lang nulls first) - 1 as place, count(*) over () as n from t where n = 1),
u as (
  select 0 as lvl, place, n, subroot as node from s
  union all
  select x.lvl + 1, x.place // 2, (x.n + 1) // 2, sha256(x.node || coalesce(y.node, ''))
  from u x left join u y on y.place = x.place + 1 where x.n > 1 and x.place % 2 = 0),
p as (
  select doc_id, lang, leaf, 0 as lvl, place, n, '' as proof, changed as folded from l
  union all
  select p.doc_id, p.lang, p.leaf, p.lvl + 1, p.place // 2, (p.n + 1) // 2, p.proof || coalesce(t.node, ''),
    case when p.place % 2 = 1 then sha256(t.node || p.folded) else sha256(p.folded || coalesce(t.node, '')) end
  from p left join t on t.lang is not distinct from p.lang and t.lvl = p.lvl and t.place = xor(p.place, 1) where p.n > 1),
q as (
  select p.doc_id, p.leaf, s.subroot, 0 as lvl, s.place, s.n, p.proof, p.folded
  from p join s on p.lang is not distinct from s.lang where p.n = 1
  union all
  select q.doc_id, q.leaf, q.subroot, q.lvl + 1, q.place // 2, (q.n + 1) // 2, q.proof || coalesce(u.node, ''),
    case when q.place % 2 = 1 then sha256(u.node || q.folded) else sha256(q.folded || coalesce(u.node, '')) end
  from q left join u on u.lvl = q.lvl and u.place = xor(q.place, 1) where q.n > 1),
r as (select node as root from u where n = 1)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded as folded_root, folded = root as verified
from q, r where q.n = 1
"""}
