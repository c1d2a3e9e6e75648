"""Hard-negative mining with anchor spanning-tree bounds (operator 11).

Rows are integer vectors with a label; a row's score for an anchor is the inner
product of the two. The *positives* of an anchor are its best ``positives`` other rows
of the same label. For each of them the *negatives* are the best ``negatives`` rows of
another label whose score lies in the window [``low``, ``high``] hundredths of the
positive's score. Higher scores come first, equal ones by smaller id.

*Tree.* Anchors stand in blocks of at most ``BLOCK`` rows, and each block gets a
minimum spanning tree. If a candidate x scores s at the parent anchor, then at a child
a distance d away it scores between s - d|x| and s + d|x|. The bounds of a
candidate that was not scored at the parent are widened in the same way. Only candidates whose
bounds overlap what is searched for are scored at the child: at or above the
lowest bound that five rows of the label are known to reach, or inside the
widest window. Bounds are rounded outwards, scores are exact, so pruning loses nothing.

*Plan.* All rows are dealt by a hash to stripes of about ``STRIPE_ROWS`` rows (at least one
for each shuffle partition). The anchors, a stated query set, are sent to every
stripe, ordered by block; a task holds its stripe and one block at a time. Each
stripe reports its best rows for each anchor, which are combined by a ranking per
anchor. The pass is made twice, for the positives and for the negatives. Nothing
goes through the driver but the number of rows.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part. Rows that repeat id, label and vector count once; "other" rows
are those of another id. Vectors of unequal length are filled up with zeros, an
empty one scores 0. A window of a negative score is empty. Scores must fit a
64-bit integer. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, drop_caches, materialise, read_table, ship_package

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
#: Rows of an anchor block, and of a stripe of candidates (on average).
BLOCK, STRIPE_ROWS = 512, 8192
#: Bounds of that many anchors are kept for their children; a child that finds none left is scored against every row.
KEPT = 64
#: Up to this norm all sums of products are exact in double precision.
EXACT_NORM = float(1 << 26)


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(id, label, q) of the rows of ``vectors`` (vec_id, embedding, label) that take part."""
    vector, identity, label = (col(vectors, c) for c in ("embedding", "vec_id", "label"))
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return vectors.where(identity.isNotNull() & label.isNotNull() & vector.isNotNull() & finite).select(
        identity.cast("bigint").alias("id"), label.cast("bigint").alias("label"), whole.alias("q"))


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """The vectors of an Arrow list column as rows of 64-bit integers, at least ``width`` wide."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    sizes = np.diff(offsets)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def norms(q: np.ndarray) -> np.ndarray:
    return np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))


def spanning_tree(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning tree of the rows: (rows, each before its children; place of each one's parent, -1 first; edges)."""
    x = q.astype(np.float64)
    n = len(x)
    near, parent, todo = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    children: list[list[int]] = [[] for _ in range(n)]
    edge = np.zeros(n)
    for step in range(n):
        at = int(np.where(todo, near, np.inf).argmin()) if step else 0
        if not todo[at]:  # distances beyond double precision: any row that is left
            at = int(todo.argmax())
        todo[at] = False
        if step:
            parent[at] = max(parent[at], 0)
            edge[at] = np.sqrt(((x[at] - x[parent[at]]) ** 2).sum())
            children[parent[at]].append(at)
        distance = ((x - x[at]) ** 2).sum(axis=1)
        closer = todo & (distance < near)
        near[closer], parent[closer] = distance[closer], at
    order, stack = [], [0] if n else []
    while stack:
        at = stack.pop()
        order.append(at)
        stack += reversed(children[at])
    rows = np.array(order, np.int64)
    place = np.empty(n, np.int64)
    place[rows] = np.arange(n)
    return rows, np.where(parent[rows] < 0, -1, place[np.maximum(parent[rows], 0)]), edge[rows]


class Stripe:
    """Candidates in the order of (label, id), and what was scored of them."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, q: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.q = ids[order], labels[order], q[order]
        self.norm = norms(self.q)
        self.exact = self.norm.max(initial=0) <= EXACT_NORM
        self.x = self.q.astype(np.float64) if self.exact else self.q
        self.scored = 0

    def widen(self, width: int) -> None:
        if width > self.x.shape[1]:
            self.q = np.pad(self.q, ((0, 0), (0, width - self.q.shape[1])))
            self.x = self.q.astype(np.float64) if self.exact else self.q

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]))

    def score(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact scores of ``rows`` for one anchor."""
        self.scored += len(rows)
        whole = len(rows) == len(self.ids)
        if self.exact and norms(q[None])[0] <= EXACT_NORM:
            return (self.x if whole else self.x[rows]) @ q.astype(np.float64)
        return self.q[rows] @ q


class Block:
    """Anchors of one block, parents first, with the windows of their positives."""

    def __init__(self, rows: pa.Table):
        self.ids, self.labels, self.place, self.parent = (
            rows[c].to_numpy() for c in ("id", "label", "place", "parent"))
        self.edge, self.q = rows["edge"].to_numpy(), matrix(rows["q"])
        self.norm = norms(self.q)
        self.number = rows["block"][0].as_py()
        self.windows = rows["windows"].to_pylist()

    def walk(self, stripe: Stripe) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, lower bounds, upper bounds) of every anchor; the caller puts in the scores that it finds."""
        if stripe.x.shape[1] < self.q.shape[1]:
            stripe.widen(self.q.shape[1])
        elif self.q.shape[1] < stripe.x.shape[1]:
            self.q = np.pad(self.q, ((0, 0), (0, stripe.x.shape[1] - self.q.shape[1])))
        n = len(stripe.ids)
        left = np.bincount(self.parent[self.parent >= 0], minlength=len(self.ids))
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i, p in enumerate(self.parent.tolist()):
            if p in kept:
                # A little more than the edge says: above what rounding can make of it.
                reach = stripe.norm * (self.edge[i] * (1 + 1e-9) + self.norm[p] * 1e-12) + 1e-3
                low, high = kept[p][0] - reach, kept[p][1] + reach
            else:
                low, high = np.full(n, -np.inf), np.full(n, np.inf)
            if p >= 0:
                left[p] -= 1
                if not left[p]:
                    kept.pop(p, None)
            yield i, low, high
            if left[i]:
                if len(kept) >= KEPT:
                    del kept[next(iter(kept))]
                kept[i] = (low, high)

    def best_positives(self, stripe: Stripe, count: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, ids, scores) of the best rows of the anchor's label in the stripe, best first."""
        for i, low, high in self.walk(stripe):
            own = stripe.of_label(int(self.labels[i]))
            rows = np.arange(own.start, own.stop)
            rows = rows[stripe.ids[own] != self.ids[i]]
            if len(rows) > count:  # so many rows reach this at least
                floor = np.partition(low[rows], len(rows) - count)[len(rows) - count]
                rows = rows[high[rows] >= floor]
            if not len(rows):
                continue
            scores = stripe.score(self.q[i], rows)
            low[rows] = high[rows] = scores
            best = np.argsort(-scores, kind="stable")[:count]  # rows of a label are in the order of their ids
            yield i, stripe.ids[rows[best]], scores[best].astype(np.int64)

    def best_negatives(self, stripe: Stripe, count: int, lowest: int, highest: int):
        """(anchor, positive, ids, scores) of the best rows in the window of each positive."""
        for i, low, high in self.walk(stripe):
            windows = [w for w in self.windows[i] or [] if w["score"] >= 0]
            if not windows:
                continue
            other = np.ones(len(stripe.ids), bool)
            other[stripe.of_label(int(self.labels[i]))] = False
            least, most = min(w["score"] for w in windows), max(w["score"] for w in windows)
            rows = np.flatnonzero(other & (high >= least * lowest / 100 - 1) & (low <= most * highest / 100 + 1))
            if not len(rows):
                continue
            scores = stripe.score(self.q[i], rows)
            low[rows] = high[rows] = scores
            whole = scores.astype(np.int64)
            order = np.lexsort((stripe.ids[rows], -whole))
            whole, ids = whole[order], stripe.ids[rows[order]]
            for w in windows:
                # Whole scores s with score * lowest <= 100 s <= score * highest.
                top, bottom = w["score"] * highest // 100, -(-w["score"] * lowest // 100)
                a, b = np.searchsorted(-whole, [-top, -bottom + 1])
                if a < b:
                    yield i, w, ids[a:min(b, a + count)], whole[a:min(b, a + count)]


def _blocks(anchors: DataFrame, block_rows: int) -> DataFrame:
    """(block, place, id, label, q, parent, edge): anchors in blocks of rows that point the same way."""
    # The signs of the first components, which put many near neighbours into one block; any order gives right results.
    way = F.concat_ws("", F.transform(F.slice("q", 1, 16), lambda x: F.when(x < 0, "-").otherwise("+")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, made, waiting = TaskContext.get().partitionId(), 0, None

        def tree(table: pa.Table) -> pa.RecordBatch:
            nonlocal made
            order, parent, edge = spanning_tree(matrix(table["q"]))
            taken = table.take(pa.array(order)).combine_chunks().to_batches()[0]
            n = len(order)
            number = pa.array([part << 32 | made] * n, pa.int64())
            made += 1
            return pa.RecordBatch.from_arrays(
                [number, pa.array(range(n), pa.int32()), *taken.columns, pa.array(parent, pa.int32()), pa.array(edge)],
                ["block", "place", "id", "label", "q", "parent", "edge"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            waiting = rows if waiting is None else pa.concat_tables([waiting, rows])
            while len(waiting) >= block_rows:
                yield tree(waiting.slice(0, block_rows))
                waiting = waiting.slice(block_rows)
        if waiting is not None and len(waiting):
            yield tree(waiting)

    rows = anchors.withColumn("way", way)
    n = max(1, -(-anchors.count() // block_rows))
    return materialise(rows.repartitionByRange(n, "way", "id").sortWithinPartitions("way", "id").select(
        "id", "label", "q").mapInArrow(
        run, "block bigint, place int, id bigint, label bigint, q array<bigint>, parent int, edge double"), "anchors")


def _search(rows: DataFrame, blocks: DataFrame, stripes: int, report, schema: str) -> DataFrame:
    """``report(block, stripe)`` of every anchor block on every stripe of ``rows``."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        gathered: list[pa.RecordBatch] = []
        stripe = None
        number = None

        def ready() -> pa.Table:
            table = pa.Table.from_batches(gathered)
            gathered.clear()
            return table

        for batch in batches:
            marks = batch.column("block").fill_null(-1).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(marks)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                mark = int(marks[a])
                if mark != number and gathered:
                    if number == -1:
                        t = ready()
                        stripe = Stripe(t["id"].to_numpy(), t["label"].to_numpy(), matrix(t["q"]))
                    elif stripe is not None:
                        yield from report(Block(ready()), stripe)
                    gathered.clear()
                number = mark
                gathered.append(batch.slice(a, b - a))
        if gathered and number != -1 and stripe is not None:
            yield from report(Block(ready()), stripe)

    stripe = F.pmod(F.xxhash64("id", "label", "q"), F.lit(stripes)).cast("int")
    own = rows.select(stripe.alias("stripe"), F.lit(None).cast("bigint").alias("block"), "id", "label", "q")
    sent = blocks.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    both = own.unionByName(sent, allowMissingColumns=True)
    return both.repartitionById(stripes, F.col("stripe")).sortWithinPartitions(
        F.col("block").asc_nulls_first(), "place").drop("stripe").mapInArrow(run, schema)


def _ranked(df: DataFrame, keys: list[str], score: str, identity: str, count: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(identity))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, stripe_rows: int = STRIPE_ROWS, block_rows: int = BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``rows`` (id, label, q).

    ``anchor`` is a condition on ``rows`` that marks the anchors.
    """
    spark = rows.sparkSession
    rows = materialise(rows.select("id", "label", "q").distinct(), "vectors")
    ship_package(spark)
    blocks = _blocks(rows.where(anchor), block_rows)
    stripes = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // stripe_rows))
    windows = "array<struct<nth:int,id:bigint,score:bigint>>"

    def report_positives(block: Block, stripe: Stripe) -> Iterator[pa.RecordBatch]:
        found = list(block.best_positives(stripe, positives))
        many = [len(ids) for _, ids, _ in found]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.number] * sum(many), pa.int64()),
                 pa.array(np.repeat(block.place[[i for i, _, _ in found]], many), pa.int32()),
                 pa.array(np.concatenate([ids for _, ids, _ in found]), pa.int64()),
                 pa.array(np.concatenate([s for _, _, s in found]), pa.int64())], ["block", "place", "pos", "score"])

    def report_negatives(block: Block, stripe: Stripe) -> Iterator[pa.RecordBatch]:
        found = list(block.best_negatives(stripe, negatives, low, high))
        many = [len(ids) for _, _, ids, _ in found]
        if found:
            each = [(block.number, block.place[i], block.ids[i], w["nth"], w["id"], w["score"]) for i, w, _, _ in found]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(x, np.int64), many), t) for x, t in zip(zip(*each), kinds)]
                + [pa.array(np.concatenate([x[k] for x in found]), pa.int64()) for k in (2, 3)],
                ["block", "place", "anchor_id", "nth", "positive_id", "positive_score", "negative_id", "negative_score"])

    empty = blocks.withColumn("windows", F.lit(None).cast(windows))
    near = _search(rows, empty, stripes, report_positives, "block bigint, place int, pos bigint, score bigint")
    best = _ranked(near, ["block", "place"], "score", "pos", positives).groupBy("block", "place").agg(
        F.collect_list(F.struct(F.col("rank").alias("nth"), F.col("pos").alias("id"), "score")).alias("windows"))  # at most ``positives``
    windowed = materialise(blocks.join(best, ["block", "place"], "left"), "windows")
    found = _search(rows, windowed, stripes, report_negatives, (
        "block bigint, place int, anchor_id bigint, nth int, positive_id bigint, positive_score bigint, "
        "negative_id bigint, negative_score bigint"))
    ranked = _ranked(found, ["block", "place", "nth"], "negative_score", "negative_id", negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantised(read_table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("id") % 50 == 0)


QUERIES = {"op11_hard_negatives": op11_hard_negatives}
ORACLE_SQL = {"op11_hard_negatives": """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * x::double) for x in embedding] as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as other_id,
    list_inner_product(a.q, b.q)::bigint as score
  from v a, v b where a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
p as (
  select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, p.positive_id,
  (row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id))::int as rank,
  s.other_id as negative_id, p.positive_score, s.score as negative_score
from p join s on p.anchor_id = s.anchor_id and not s.same
where 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score
qualify rank <= 3
"""}
