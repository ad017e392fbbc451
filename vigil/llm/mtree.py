"""Exact top-k search by inner product in a forest of M-trees.

The inner product becomes a metric by one more dimension: a candidate x gets sqrt(M^2 - |x|^2),
a query gets 0, where M is the largest norm. Then |q - x|^2 = |q|^2 + M^2 - 2 <q, x>, so the
nearest candidates have the highest products, and distances between candidates obey the
triangle inequality.

Candidates go to the nearest of ``PIVOTS`` vectors (a fixed number, chosen by hash) and, in a
region of more than ``TREE`` vectors, to one of several trees by a hash, so copies of one vector
can't fill a task. Every tree is bulk-loaded into pages, one row each: inner entries have a
routing vector, a covering radius and the distance to the parent's routing vector; leaf entries a
vector and that distance. The pages are written to the shared folder. A query is compared with
the pivots first: their products bound the k-th best score from below and rule out regions. In
each tree that is left the pages are visited in the order of their lowest possible distance;
entries whose stored distance already rules them out are skipped without computing theirs.
Products are whole numbers and exact, bounds have a slack for rounding, so results are exact.

Vectors that are null or have null or non-finite components, and rows without an id, take no
part; shorter vectors count as filled with zeros; repeated rows are separate candidates, and
repeated equal queries are one. Exact while squared norms fit in a long (components below 2^28).
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import ship, table
from vigil.session import write_table

SCALE = 256                 # fixed by the contract
EVERY = 50                  # fixed by the contract: queries are the ids divisible by it
K = 5                       # fixed by the contract
PIVOTS = 32
TREE = 16_384               # vectors in a tree, about
LEAF = 256                  # entries of a leaf page at most
FAN = 32                    # entries of an inner page at most
QUERIES = 4096              # queries that meet a tree in one task
SLACK = 1e-6                # relative, on distances


def scaled_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(id, v)`` with ``v`` the components floor(scale * x) as longs; unusable rows are left out."""
    sound = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(sound).select(
        F.col(id_col).alias("id"), F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as whole numbers, filled with zeros up to ``width``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else []
    for i, (s, n) in enumerate(zip(starts, lengths, strict=True)):
        out[i, :n] = flat[s:s + n]
    return out


@dataclass
class Space:
    """Distances in the extended space: ``most`` is the largest squared norm."""

    width: int
    most: int

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact inner products of whole numbers."""
        if self.most < 1 << 50:         # sums stay below 2^53: doubles are exact
            return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        return a @ b.T

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances between candidates ``a`` and ``b``."""
        na, nb = (a * a).sum(axis=1), (b * b).sum(axis=1)
        plain = na[:, None] + nb[None, :] - 2 * self.products(a, b)
        lift = np.sqrt(np.maximum(self.most - na, 0).astype(np.float64))[:, None] - np.sqrt(np.maximum(self.most - nb, 0).astype(np.float64))[None, :]
        return np.sqrt(np.maximum(plain + lift * lift, 0.0))

    def of_score(self, norm: int | np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance of a query with squared norm ``norm`` from a candidate with this product."""
        return np.sqrt(np.maximum(np.asarray(norm, np.float64) + self.most - 2.0 * score, 0.0))


PAGE_SHAPE = "region int, tree int, page int, leaf boolean, ids array<long>, vectors binary, radii array<double>, parents array<double>"


def build_pages(ids: np.ndarray, v: np.ndarray, center: np.ndarray, space: Space) -> list[tuple]:
    """Bulk-load one tree: ``(page, leaf, ids, vectors, radii, parent distances)``; page 0 is the root, its parent is ``center``."""
    pages: list[tuple] = []
    work = [(0, np.arange(len(ids)), center)]
    made = 1
    while work:
        page, rows, parent = work.pop()
        far = space.between(v[rows], parent[None, :])[:, 0]
        if len(rows) <= LEAF:
            order = rows[np.argsort(far, kind="stable")]
            pages.append((page, True, ids[order], v[order], np.zeros(len(order)), np.sort(far, kind="stable")))
            continue
        k = min(FAN, max(2, -(-len(rows) // (LEAF // 2))))
        routes = rows[np.argsort(far, kind="stable")[np.linspace(0, len(rows) - 1, k).astype(int)]]
        near = space.between(v[rows], v[routes])
        own = near.argmin(axis=1)
        if np.bincount(own).max() > 0.9 * len(rows):        # copies, or nearly: deal them out evenly
            own = np.arange(len(rows)) % k
        parts = [(routes[j], rows[own == j], near[own == j, j]) for j in range(k) if (own == j).any()]
        route = np.array([p[0] for p in parts])
        children = range(made, made := made + len(parts))
        pages.append((page, False, np.array(children), v[route], np.array([p[2].max() for p in parts]),
                      space.between(v[route], parent[None, :])[:, 0]))
        work += [(c, part, v[r]) for c, (r, part, _) in zip(children, parts, strict=True)]
    return pages


NONE, LAST = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max     # no score yet, and an id after all others


def search_tree(pages: dict[int, tuple], center: np.ndarray, q: np.ndarray, q_ids: np.ndarray, floors: np.ndarray, k: int,
                space: Space) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every query the ``k`` best of one tree with a score of its floor at least (``NONE``: any), ties to the smaller id, as
    ``(query position, score, id)``. Best-first for each query: it goes on with its page of the lowest possible distance.
    Queries that are at the same page are compared with its entries together."""
    norms = (q * q).sum(axis=1)
    slack = SLACK * np.sqrt(norms.astype(np.float64) + space.most + 1.0)
    reach = np.where(floors == NONE, np.inf, space.of_score(norms, floors) + slack)
    best, best_ids = np.full((len(q), k), NONE), np.full((len(q), k), LAST)
    center_far = space.of_score(norms, space.products(q, center[None, :])[:, 0])
    waiting: list[list[tuple[float, int, float]]] = [[(0.0, 0, far)] for far in center_far.tolist()]
    active = list(range(len(q)))
    while active:
        at: dict[int, list[tuple[int, float]]] = {}
        for i in active:
            if waiting[i]:
                low, page, far = heapq.heappop(waiting[i])
                if low <= reach[i]:
                    at.setdefault(page, []).append((i, far))
        active = [i for who in at.values() for i, _ in who]
        for page, who in at.items():
            leaf, ids, vectors, radii, parents = pages[page]
            rows, far = np.array([i for i, _ in who]), np.array([f for _, f in who])
            limit = reach[rows][:, None]
            open_ = np.abs(far[:, None] - parents) - radii <= limit          # the rest is ruled out without its distance
            held = np.flatnonzero(open_.any(axis=0))
            if not len(held):
                continue
            open_, ids, radii = open_[:, held], ids[held], radii[held]
            scores = space.products(q[rows], vectors[held])
            away = space.of_score(norms[rows][:, None], scores)
            if not leaf:
                lowest = np.maximum(away - radii, 0.0)
                for x, y in zip(*np.nonzero(open_ & (lowest <= limit)), strict=True):
                    heapq.heappush(waiting[rows[x]], (float(lowest[x, y]), int(ids[y]), float(away[x, y])))
                continue
            good = open_ & (away <= limit) & (scores >= floors[rows][:, None]) & (ids != q_ids[rows][:, None])
            some = good.any(axis=1)
            rows, good = rows[some], good[some]
            s = np.concatenate([best[rows], np.where(good, scores[some], NONE)], axis=1)
            c = np.concatenate([best_ids[rows], np.where(good, ids, LAST)], axis=1)
            order = np.lexsort((c, -s), axis=-1)[:, :k]
            best[rows], best_ids[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(c, order, 1)
            full = rows[best[rows, k - 1] != NONE]
            reach[full] = np.minimum(reach[full], space.of_score(norms[full], best[full, k - 1]) + slack[full])
    i, j = np.nonzero(best != NONE)
    return i, best[i, j], best_ids[i, j]


def mtree_top_k(vectors: DataFrame, queries: DataFrame, k: int = K, pivots: int = PIVOTS) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` candidates (``vectors``: ``id``, ``v``) with the highest products for
    every query (same columns), without its own id; ties go to the smaller id."""
    spark = vectors.sparkSession
    ship(spark)
    shape = "query_id long, rank int, id long, score long"
    stored = write_table(vectors.withColumn("n2", F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x * x)), "vectors")
    asked = write_table(queries.select("id", "v").distinct(), "queries")
    most, width = stored.agg(F.max("n2"), F.max(F.size("v"))).first()
    n_asked, q_width = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    if most is None or not n_asked:
        return spark.createDataFrame([], shape)
    space = Space(max(width, q_width, 1), most)
    chosen = stored.groupBy("v").agg(F.min("id").alias("id")).orderBy(F.xxhash64("id"), "id").limit(pivots).collect()   # a fixed number
    roots = np.zeros((len(chosen), space.width), np.int64)
    for row, r in zip(roots, chosen, strict=True):
        row[:len(r.v)] = r.v
    root_ids = np.array([r.id for r in chosen])

    def to_region(batches):
        for batch in batches:
            near = space.between(_matrix(batch.column("v"), space.width), roots)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(near.argmin(axis=1), pa.int32()),
                                              pa.array(near.min(axis=1))], names=["id", "v", "region", "far"])

    placed = write_table(stored.select("id", "v").mapInArrow(to_region, "id long, v array<long>, region int, far double"), "regions")
    regions = {r.region: (r.n, r.far) for r in placed.groupBy("region").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    trees = [-(-regions.get(j, (0, 0))[0] // TREE) for j in range(len(roots))]
    n_trees = F.array(*map(F.lit, trees))
    blocks = -(-n_asked // QUERIES)

    def build(group: pa.Table) -> pa.Table:
        region, tree = group.column("region")[0].as_py(), group.column("tree")[0].as_py()
        group = group.sort_by("id")
        made = build_pages(group.column("id").to_numpy(), _matrix(group.column("v"), space.width), roots[region], space)
        page, leaf, ids, v, radii, parents = zip(*made, strict=True)
        same = [pa.array([x] * len(made), pa.int32()) for x in (region, tree)]
        return pa.Table.from_arrays([*same, pa.array(page, pa.int32()), pa.array(leaf), pa.array(ids, pa.list_(pa.int64())),
                                     pa.array([x.tobytes() for x in v], pa.binary()), pa.array(radii, pa.list_(pa.float64())),
                                     pa.array(parents, pa.list_(pa.float64()))], names=PAGE_SHAPE.replace(",", "").split()[::2])

    pages = write_table(placed.withColumn("tree", F.pmod(F.xxhash64("id"), F.get(n_trees, F.col("region"))).cast("int"))
                        .select("id", "v", "region", "tree").groupBy("region", "tree").applyInArrow(build, PAGE_SHAPE), "pages")

    def aim(batches):
        """Each query with the regions that may hold one of its results and the score they have to reach."""
        for batch in batches:
            q, ids = _matrix(batch.column("v"), space.width), batch.column("id").to_numpy()
            scores = space.products(q, roots)
            rows, region, floors = [], [], []
            for i in range(len(q)):
                norm = int((q[i] * q[i]).sum())
                known = np.sort(scores[i][root_ids != ids[i]])[::-1]
                floor = int(known[k - 1]) if len(known) >= k else None
                far = space.of_score(norm, scores[i])
                slack = SLACK * np.sqrt(float(norm) + space.most + 1.0)
                reach = space.of_score(norm, np.float64(floor)) + slack if floor is not None else np.inf
                for j, (_, radius) in regions.items():
                    if far[j] - radius <= reach:
                        rows.append(i)
                        region.append(j)
                        floors.append(floor)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("v").take(at), pa.array(region, pa.int32()),
                                              pa.array(floors, pa.int64())], names=["id", "v", "region", "floor"])

    aimed = asked.mapInArrow(aim, "id long, v array<long>, region int, floor long")
    aimed = aimed.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")).withColumn(
        "tree", F.explode(F.sequence(F.lit(0), F.get(n_trees, F.col("region")) - 1)))
    spread = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(tree: pa.Table, ask: pa.Table) -> pa.Table:
        i = score = found = np.zeros(0, np.int64)
        if tree.num_rows and ask.num_rows:
            ids, v, radii, parents = (tree.column(c).combine_chunks() for c in ("ids", "vectors", "radii", "parents"))
            own = {p: (leaf, ids[n].values.to_numpy(), np.frombuffer(v[n].as_buffer(), np.int64).reshape(-1, space.width),
                       radii[n].values.to_numpy(), parents[n].values.to_numpy())
                   for n, (p, leaf) in enumerate(zip(tree.column("page").to_pylist(), tree.column("leaf").to_pylist(), strict=True))}
            floors = pc.fill_null(ask.column("floor"), int(NONE)).to_numpy()
            i, score, found = search_tree(own, roots[tree.column("region")[0].as_py()], _matrix(ask.column("v"), space.width),
                                          ask.column("id").to_numpy(), floors, k, space)
        return pa.Table.from_arrays([ask.column("id").take(pa.array(i)), ask.column("v").take(pa.array(i)), pa.array(found), pa.array(score)],
                                    names=["query_id", "v", "id", "score"])

    key = ["region", "tree", "block"]
    found = spread.groupBy(*key).cogroup(aimed.groupBy(*key)).applyInArrow(search, "query_id long, v array<long>, id long, score long")
    order = Window.partitionBy("query_id", "v").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def is_query(vec_id: Column, every: int = EVERY) -> Column:
    return vec_id % every == 0


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaled_vectors(table(spark, sf_dir, "embeddings"))
    return mtree_top_k(vectors, vectors.where(is_query(F.col("id")))).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


#: Every query against every other row, in whole numbers.
TOP_K_SQL = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as q
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id as vec_id,
    cast(list_sum(list_transform(list_zip(a.q, b.q), lambda z: coalesce(z[1] * z[2], 0))) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id
  where a.vec_id % {EVERY} = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= {K}
"""
