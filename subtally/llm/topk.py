"""Exact top-k by inner product: M-trees of paged nodes, searched best first, batched over queries.

Inner products become distances by one more coordinate: with m the greatest norm, x -> (x, sqrt(m^2 - |x|^2)) and
q -> (q, 0), so |q' - x'|^2 = |q|^2 + m^2 - 2 qx. Every page has a centre and the radius that covers its entries, every
entry its distance to the centre, every page the distance of its centre to the tree's. By the triangle inequality these
stored distances rule out pages and entries before anything is computed for them. Scores are exact integers.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subtally.llm.common import first_by_hash, stored

# Vectors of a tree and of a page; cells that the vectors are dealt to before trees are made; queries searched at once.
TREE, PAGE, CELLS, BLOCK = 8192, 128, 512, 8192
EXACT = 2**53
LIMIT = 2**63 - 1


def integers(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(id, x): components floor(scale * c) as doubles. Rows with a null id, and vectors that are null or hold
    nulls or non-finite components, are left out."""
    whole = F.transform(F.col(vector_column).cast("array<double>"), lambda c: F.floor(c * scale).cast("double"))
    sound = F.forall(F.col(vector_column).cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0**52 / scale))
    large = F.transform(F.col(vector_column).cast("array<double>"), lambda c: c * scale)  # beyond 2^52 every double is whole
    finite = F.forall(F.col(vector_column).cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= 1.7e308 / scale))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.when(sound, whole).when(finite, large).alias("x"))
    return rows.filter("id IS NOT NULL AND x IS NOT NULL")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Shorter vectors are filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products; what a long can't hold becomes its nearest value."""
    if x.size and q.size and np.abs(q).max() * np.abs(x).max() * x.shape[1] >= EXACT:
        whole = np.vectorize(int, otypes=[object])
        return np.clip(whole(q).dot(whole(x).T), -LIMIT, LIMIT).astype(np.int64)
    return np.rint(q @ x.T).astype(np.int64)


@dataclass
class Tree:
    ids: np.ndarray
    x: np.ndarray
    to_centre: np.ndarray  # of each entry to its page's centre
    starts: np.ndarray  # of each page, one entry more
    centres: np.ndarray  # entry that is the page's centre
    radii: np.ndarray
    to_root: np.ndarray  # of each page's centre to the first page's


@dataclass(frozen=True)
class Space:
    """What distances are taken in: components over the largest one, so that no square overflows."""

    width: int
    unit: float
    most: float  # the greatest square norm in that unit

    def points(self, x: np.ndarray) -> np.ndarray:
        own = x / self.unit
        return np.column_stack([own, np.sqrt(np.maximum(self.most - (own * own).sum(1), 0))])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def build(ids: np.ndarray, x: np.ndarray, space: Space) -> Tree:
    """Pages from nearest-centre splits, again and again, down to the page size; what can't be told apart is cut evenly."""
    points = space.points(x)
    rng = np.random.default_rng(len(ids))
    pages, waiting = [], [np.arange(len(ids))]
    while waiting:
        own = waiting.pop()
        if len(own) <= PAGE:
            pages.append(own)
            continue
        seeds = own[rng.choice(len(own), min(16, len(own) // PAGE + 1), replace=False)]
        nearest = distances(points[own], points[seeds]).argmin(1)
        groups = [own[nearest == k] for k in range(len(seeds)) if (nearest == k).any()]
        waiting += np.array_split(own, -(-len(own) // PAGE)) if len(groups) == 1 else groups
    order, starts = np.concatenate(pages), np.cumsum([0] + [len(p) for p in pages])
    points = points[order]
    centres, radii, to_centre = [], [], np.zeros(len(order))
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        middle = points[a:b].mean(0, keepdims=True)
        centre = a + int(distances(middle, points[a:b])[0].argmin())
        to_centre[a:b] = distances(points[centre : centre + 1], points[a:b])[0]
        centres.append(centre)
        radii.append(to_centre[a:b].max())
    to_root = distances(points[centres[:1]], points[centres])[0]
    return Tree(ids[order], x[order], to_centre, starts, np.array(centres), np.array(radii), to_root)


def grow(rows: DataFrame, space: Space) -> DataFrame:
    """(tree): pickled trees of at most about TREE vectors each, near vectors in one tree.

    Vectors go to the nearest of a bounded number of cells; a cell of any size is dealt over as many trees as it fills.
    """
    seeds = first_by_hash(rows, CELLS, "id", "x").select("x").toArrow().combine_chunks()
    column = seeds.column("x").combine_chunks() if seeds.num_rows else None
    cells = space.points(matrix(column, space.width) if column is not None else np.zeros((1, space.width)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = space.points(matrix(batch.column("x"), space.width))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), pa.array(distances(points, cells).argmin(1), pa.int32())], ["id", "x", "cell"])

    placed = rows.select("id", "x").mapInArrow(place, "id bigint, x array<double>, cell int")
    sizes = placed.groupBy("cell").count().collect()  # CELLS rows at most
    # Small cells share a tree, large ones are dealt over several.
    trees, room, first = {}, 0, 0
    for row in sorted(sizes, key=lambda r: r["cell"]):
        parts = -(-row["count"] // TREE)
        if parts > 1 or room < row["count"]:
            first, room = first + 1000, TREE
        trees[row["cell"]] = (first, parts)
        first, room = (first + parts, 0) if parts > 1 else (first, room - row["count"])
    numbers = F.create_map(*(F.lit(v) for cell, (start, _) in trees.items() for v in (cell, start))) if trees else None
    parts = F.create_map(*(F.lit(v) for cell, (_, n) in trees.items() for v in (cell, n))) if trees else None
    if not trees:
        return rows.sparkSession.createDataFrame([], "tree binary")
    named = placed.withColumn("key", numbers[F.col("cell")] + F.pmod(F.monotonically_increasing_id(), parts[F.col("cell")]).cast("int"))

    def one(table: pa.Table) -> pa.Table:
        tree = build(table.column("id").to_numpy(), matrix(table.column("x").combine_chunks(), space.width), space)
        return pa.table({"tree": pa.array([pickle.dumps(astuple(tree))], pa.binary())})

    return named.groupBy("key").applyInArrow(one, "tree binary")


class Best:
    """The k best of each query so far: highest score first, then smallest id."""

    def __init__(self, queries: int, k: int):
        self.scores = np.full((queries, k), -LIMIT - 1, np.int64)
        self.ids = np.full((queries, k), LIMIT, np.int64)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        every = np.concatenate([self.scores[rows], scores], axis=1)
        names = np.concatenate([self.ids[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        k = self.scores.shape[1]
        order = np.lexsort((names, -np.maximum(every, -LIMIT)), axis=1)[:, :k]
        self.scores[rows] = np.take_along_axis(every, order, 1)
        self.ids[rows] = np.take_along_axis(names, order, 1)


def search(tree: Tree, query_ids: np.ndarray, q: np.ndarray, space: Space, best: Best) -> None:
    """Every query takes the page with the least possible distance next, until that exceeds its k-th best."""
    own, near = q / space.unit, tree.x / space.unit
    norms = (own * own).sum(1)
    slack = 1e-6 * np.sqrt(norms + space.most) + 1e-9

    def reach(rows: np.ndarray) -> np.ndarray:
        worst = best.scores[rows, -1]
        limit = np.sqrt(np.maximum(norms[rows] + space.most - 2 * (worst / space.unit / space.unit), 0)) + slack[rows]
        return np.where(worst <= -LIMIT, np.inf, limit)

    def away(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(norms[rows][:, None] + space.most - 2 * (own[rows] @ near[entries].T), 0))

    everyone = np.arange(len(q))
    to_root = away(everyone, tree.centres[:1])[:, 0]
    # Pages that the stored distances to the root rule out: their centres' distances aren't computed.
    bound = np.abs(to_root[:, None] - tree.to_root[None, :]) - tree.radii[None, :]
    centre = np.full(bound.shape, np.inf)
    needed = bound <= reach(everyone)[:, None]
    for page in np.flatnonzero(needed.any(0)):
        rows = np.flatnonzero(needed[:, page])
        centre[rows, page] = away(rows, tree.centres[page : page + 1])[:, 0]
    bound = np.where(needed, np.maximum(bound, centre - tree.radii[None, :]), np.inf)
    order = np.argsort(bound, axis=1)
    active = everyone
    for turn in range(len(tree.radii)):
        pages = order[active, turn]
        go = bound[active, pages] <= reach(active)
        go &= np.isfinite(bound[active, pages])
        active, pages = active[go], pages[go]
        if not len(active):
            break
        for page in np.unique(pages):
            rows = active[pages == page]
            entries = np.arange(tree.starts[page], tree.starts[page + 1])
            gap = np.abs(centre[rows, page][:, None] - tree.to_centre[entries][None, :])
            entries = entries[(gap <= reach(rows)[:, None]).any(0)]
            scores = products(q[rows], tree.x[entries])
            itself = tree.ids[entries][None, :] == query_ids[rows][:, None]
            best.add(rows, np.where(itself, -LIMIT - 1, scores), np.where(itself, LIMIT, tree.ids[entries][None, :]))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, the k other rows with the highest
    inner products of floor(scale * components); all if there are fewer; ties go to smaller ids.

    Vectors that are null or hold null or non-finite components, and rows with a null id, take no part. Shorter vectors
    count as filled up with zeros. Rows with the query's own id are not its candidates; an id that several different
    queries share gets ranks for each vector, and equal rows are one query. Other columns are left out.
    """
    spark = vectors.sparkSession
    rows = stored(integers(vectors, id_column, vector_column, scale), "vectors")
    whole = rows.agg(F.max(F.array_max(F.transform("x", F.abs))).alias("unit"), F.max(F.size("x")).alias("width")).first()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if whole["width"] is None:
        return spark.createDataFrame([], schema)
    unit = whole["unit"] or 1.0
    square = F.aggregate(F.transform("x", lambda c: c / F.lit(unit)), F.lit(0.0), lambda s, c: s + c * c)
    space = Space(max(whole["width"], 1), unit, rows.agg(F.max(square)).first()[0])
    width = space.width
    trees = stored(grow(rows, space), "trees")
    asked = stored(rows.filter(F.col("id") % every == 0).select("id", "x").distinct(), "queries")
    blocks = max(1, -(-asked.count() // BLOCK))
    found = None
    for block in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("id", "x"), F.lit(blocks)) == block).toArrow().combine_chunks()
        if not part.num_rows:
            continue
        ids, q = part.column("id").to_numpy(), matrix(part.column("x").combine_chunks(), width)

        def run(batches: Iterator[pa.RecordBatch], ids=ids, q=q) -> Iterator[pa.RecordBatch]:
            best = Best(len(ids), k)
            for batch in batches:
                for tree in batch.column("tree"):
                    search(Tree(*pickle.loads(tree.as_py())), ids, q, space, best)
            query, place = np.nonzero(best.scores > -LIMIT - 1)
            columns = [query, ids[query], best.ids[query, place], best.scores[query, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "query_id", "vec_id", "score"])

        own = trees.mapInArrow(run, "query bigint, query_id bigint, vec_id bigint, score bigint")
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        ranked = own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked = ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        # Several blocks are answered one after another, so that the driver and the plan hold the queries of one at a time.
        ranked = ranked if blocks == 1 else stored(ranked, "answers")
        found = ranked if found is None else found.unionByName(ranked)
    return found if found is not None else spark.createDataFrame([], schema)
