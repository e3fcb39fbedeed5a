"""Operator 9, exact top-k search by inner product over norm-sorted blocks.

Vectors become integers (floor(scale * x)), so scores are exact. They are dealt into
blocks by descending length (ties by id), each packed into one row of the narrowest
integers that hold it; queries are packed the same way. Queries go through the blocks in
rounds of growing size; after each round every query keeps its k best, whose last score
is its threshold. A round pairs packed rows only (query blocks x blocks), straight from
where they are stored: no vector is copied for a query, and what a task sends on are the
k best of its queries at most. By Cauchy-Schwarz a block is skipped when for all queries
of a query block |q| * (longest vector of the block) is below the threshold.

Inside a tile (query block x block) vectors are taken in the same order: the rotation by
the singular vectors of the corpus (from the d x d Gram matrix, summed over all vectors)
puts most of the length in the first components, so the partial product over those plus
|rest of q| * |rest of x| bounds the score. How many components are worth it is tried on
some pairs of the tile; with all of them the bound is the score but for rounding. Pairs
below the threshold are dropped, and those that can at most equal it with a larger id;
the rest are scored exactly in integers. The bounds are single precision, with a slack
above the rounding error of such a sum, so nothing is lost.

The driver sees only the Gram matrix (d x d), and one row per block (its longest
length). Tiles bound the memory of a task; blocks keep equal vectors apart by id, so a
vector that a third of all rows share is spread like any other. Distinct directions
leave nothing to prune: the work is then queries x vectors x d, as of any exact search.

Defined cases: null vectors and vectors with null or non-finite components take no part;
shorter vectors count as padded with zeros; ties go to the smaller id; a query never
meets rows of its own id; repeated rows of another id count each; fewer than k
candidates give fewer rows; no queries or an empty table give an empty result.
"""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelmart.session import scratch_path

from .arrowmap import visible

SCALE = 256
BLOCK_ROWS, QUERY_ROWS, STEP_ROWS = 8192, 1024, 512
#: Query blocks packed into one row, packed rows of a side that a task holds, bytes of vectors in one row at most.
PACKED, HELD, PACK_BYTES = 4, 8, 1 << 22
_EXACT = 2.0**53
_NO_ID = np.iinfo(np.int64).max
_KINDS = {"smallint": np.int16, "int": np.int32, "bigint": np.int64}


def quantise(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v, norm): integer vectors that take part, and their lengths."""
    visible(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("x").isNotNull())

    def run(batches):
        for b in batches:
            x = b.column(1)
            flat, sizes = x.flatten(), np.diff(x.offsets.to_numpy())
            fine = np.isfinite(flat.to_numpy(zero_copy_only=False)) & flat.is_valid().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            faults = np.concatenate([[0], np.cumsum(~fine)])
            takes = faults[ends] == faults[ends - sizes]
            y = np.floor(flat.to_numpy(zero_copy_only=False)[np.repeat(takes, sizes)] * float(scale))
            # as a cast does: what no long holds becomes the nearest one
            v = np.where(y >= 2.0**63, np.iinfo(np.int64).max, np.clip(y, -2.0**63, np.nextafter(2.0**63, 0)).astype(np.int64))
            first = np.concatenate([[0], np.cumsum(sizes[takes])])
            sums = np.add.reduceat(np.append(v.astype(np.float64) ** 2, 0.0), first[:-1]) if takes.any() else np.zeros(0)
            sums[sizes[takes] == 0] = 0
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(takes)), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(v)), pa.array(np.sqrt(sums))], names=["id", "v", "norm"])

    return rows.mapInArrow(run, "id long, v array<long>, norm double")


def _matrix(col: pa.ChunkedArray, d: int, kind: type = np.int64) -> np.ndarray:
    """n x d integers of a list column, padded with zeros."""
    a = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    sizes = np.diff(a.offsets.to_numpy())
    flat = a.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if (sizes == d).all():
        return flat.reshape(len(sizes), d)
    out = np.zeros((len(sizes), d), kind)
    inside = np.arange(d)[None, :] < sizes[:, None]
    out[inside] = flat
    return out


def rotation(vectors: DataFrame, d: int) -> np.ndarray:
    """Orthogonal d x d matrix whose first columns carry most of the corpus' length."""
    visible(vectors.sparkSession)

    def partial(batches):
        total = np.zeros((d, d))
        for b in batches:
            x = _matrix(b.column(0), d).astype(np.float64)
            total += x.T @ x
        i, j = np.divmod(np.arange(d * d), d)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "s"])

    rows = vectors.select("v").mapInArrow(partial, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    gram = np.zeros((d, d))
    for r in rows:
        gram[r.i, r.j] = r.s
    if not np.isfinite(gram).all():
        return np.eye(d)
    _, vectors_ = np.linalg.eigh((gram + gram.T) / 2)
    return np.ascontiguousarray(vectors_[:, ::-1])


class _Side:
    """The vectors of a packed row: integers, rotated, and lengths of what the first components leave."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, turn: np.ndarray):
        f = x.astype(np.float64)
        norm = np.sqrt((f * f).sum(1))
        order = np.argsort(-norm, kind="stable")
        self.order, self.ids, self.x, self.norm = order, ids[order], x[order], norm[order]
        self.most = float(np.abs(f).max(initial=0))
        self.turned = f[order] @ turn
        # squares of single-precision products overflow beyond this
        if self.norm.max(initial=0) < 1e15:
            self.turned = self.turned.astype(np.float32)
        self._upto: dict[int, np.ndarray] = {}

    def part(self, head: int, rows: slice = slice(None)) -> np.ndarray:
        """The first ``head`` components and the length of the others."""
        t = self.turned[rows]
        if head == t.shape[1]:
            return t
        rest = np.sqrt((t[:, head:].astype(np.float64) ** 2).sum(1)).astype(t.dtype)
        return np.ascontiguousarray(np.c_[t[:, :head], rest])

    def upto(self, head: int) -> np.ndarray:
        if head not in self._upto:
            if len(self._upto) > 2:
                self._upto.clear()
            self._upto[head] = self.part(head)
        return self._upto[head]


class _Best:
    """The k best pairs so far of each query of a side, and the last of k that are known from before or by now."""

    def __init__(self, side: _Side, k: int, known: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None):
        n = len(side.ids)
        self.of, self.k, self.count = side.ids, k, np.zeros(n, np.int64)
        self.ids, self.score = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.head, self.tried = 0, 0
        self.full, self.low, self.low_id = np.zeros(n, bool), np.zeros(n, np.int64), np.full(n, _NO_ID)
        if known is not None and len(known[0]):
            at = np.minimum(np.searchsorted(known[0], side.ids), len(known[0]) - 1)
            self.full = known[0][at] == side.ids
            self.low, self.low_id = np.where(self.full, known[1][at], 0), np.where(self.full, known[2][at], _NO_ID)

    def thr(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        return np.where(self.full[at], self.low[at].astype(np.float64), -math.inf)

    def take(self, rows: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        enters = ~self.full[rows] | (score > self.low[rows]) | ((score == self.low[rows]) & (ids < self.low_id[rows]))
        rows, ids, score = rows[enters], ids[enters], score[enters]
        if not len(rows):
            return
        met = np.unique(rows)
        had = np.arange(self.k) < self.count[met][:, None]
        rows = np.concatenate([rows, np.repeat(met, self.count[met])])
        ids, score = np.concatenate([ids, self.ids[met][had]]), np.concatenate([score, self.score[met][had]])
        order = np.lexsort((ids, -score, rows))
        rows, ids, score = rows[order], ids[order], score[order]
        first = np.searchsorted(rows, met)
        sizes = np.diff(np.append(first, len(rows)))
        place = np.arange(len(rows)) - np.repeat(first, sizes)
        top = place < self.k
        self.ids[rows[top], place[top]], self.score[rows[top], place[top]] = ids[top], score[top]
        self.count[met] = np.minimum(sizes, self.k)
        met = met[sizes >= self.k]
        last, last_id = self.score[met, -1], self.ids[met, -1]
        up = ~self.full[met] | (last > self.low[met]) | ((last == self.low[met]) & (last_id < self.low_id[met]))
        self.full[met], self.low[met[up]], self.low_id[met[up]] = True, last[up], last_id[up]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        had = np.arange(self.k) < self.count[:, None]
        return np.repeat(self.of, self.count), self.ids[had], self.score[had]


def _eps(q: _Side, c: _Side) -> float:
    """Of |q| * |x|: more than the rounding error of a bound, that of d + 1 products and of their factors."""
    return (q.turned.shape[1] + 8) * 2.0**-24 if q.turned.dtype == c.turned.dtype == np.float32 else 1e-6


def _below(limit: np.ndarray, like: np.ndarray) -> np.ndarray:
    """``limit`` in the type of the bounds, rounded down."""
    return np.nextafter(limit.astype(like.dtype), like.dtype.type(-math.inf))


def _head(q: _Side, best: _Best, c: _Side) -> int:
    """Leading components that settle the pairs of a tile at the least cost, by trial on some of them, anew every few tiles."""
    d = c.turned.shape[1]
    if d < 8 or best.full.mean() < 0.9:
        return d
    best.tried += 1
    if best.tried % 8 == 1:
        some, few = slice(None, None, max(1, len(q.ids) // 64)), slice(None, None, max(1, len(c.ids) // 256))
        limit = best.thr(some)[:, None] - _eps(q, c) * q.norm[some, None] * c.norm[None, few] - 1e-6
        cost = {}  # ns of a pair: of a component, of a row of pairs with some to be scored, of a pair to be scored
        for h in (d // 8, d // 4, d // 2, 5 * d // 8, 3 * d // 4, d):
            left = (q.part(h, some) @ c.part(h, few).T >= limit).mean()
            cost[h] = 0.03 * h + min(1.0, STEP_ROWS * left) + 300 * left
        best.head = min(cost, key=cost.get)
    return best.head


def _exact(q: _Side, rows: np.ndarray, c: _Side, cols: np.ndarray) -> np.ndarray:
    kind = np.float64 if q.most * c.most * q.x.shape[1] < _EXACT else np.int64
    out = [np.einsum("ij,ij->i", q.x[rows[s:s + 4096]].astype(kind), c.x[cols[s:s + 4096]].astype(kind)) for s in range(0, len(rows), 4096)]
    return np.concatenate([np.zeros(0, np.int64), *out]).astype(np.int64) if kind is np.int64 else np.rint(np.concatenate([np.zeros(0), *out])).astype(np.int64)


def _opened(bound: np.ndarray, q_ids: np.ndarray, c_ids: np.ndarray, thr: np.ndarray, slack: np.ndarray, k: int) -> np.ndarray:
    """``thr``, for queries that have none what the k best of these scores are at least."""
    new = np.flatnonzero(np.isneginf(thr))
    if not len(new) or bound.shape[1] < k:
        return thr
    others = np.where(q_ids[new, None] == c_ids[None, :], -math.inf, bound[new])
    out = thr.copy()
    out[new] = np.partition(others, -k, axis=1)[:, -k] - slack[new]
    return out


def _scan(q: _Side, best: _Best, c: _Side) -> None:
    """Take the pairs of a tile into the best of their queries."""
    d, eps = c.turned.shape[1], _eps(q, c)
    head = _head(q, best, c)
    for a in range(0, len(c.ids), STEP_ROWS):
        z, found = slice(a, a + STEP_ROWS), []
        for b in range(0, len(q.ids), QUERY_ROWS):
            at = np.arange(b, min(b + QUERY_ROWS, len(q.ids)))
            thr, slack = best.thr(at), eps * q.norm[at] * c.norm[a] + 1e-6
            live = q.norm[at] * c.norm[a] + slack >= thr
            if not live.any():
                continue
            at, thr, slack = at[live], thr[live], slack[live]
            known = np.isfinite(thr).all()
            h = head if known else d
            bound = (q.upto(h)[b:b + QUERY_ROWS] if live.all() else q.upto(h)[at]) @ c.upto(h)[z].T
            if not known:
                thr = _opened(bound, q.ids[at], c.ids[z], thr, slack, best.k)
            limit = _below(thr - slack, bound)
            some = np.flatnonzero(bound.max(1) >= limit)
            if not len(some):
                continue
            at, thr, slack, bound = at[some], thr[some], slack[some], bound[some]
            rows, cols = np.divmod(np.flatnonzero(bound >= limit[some, None]), bound.shape[1])
            n, ids = at[rows], c.ids[z][cols]
            enters = (q.ids[n] != ids) & (~best.full[n] | (ids < best.low_id[n]) | (bound[rows, cols] >= _below(thr + 1 - slack, bound)[rows]))
            rows, cols, n = rows[enters], cols[enters], n[enters]
            if len(rows) > 0.05 * bound.size and q.most * c.most * d < _EXACT:
                score = np.rint(q.x[at].astype(np.float64) @ c.x[z].astype(np.float64).T).astype(np.int64)[rows, cols]
            else:
                score = _exact(q, n, c, cols + a)
            found.append((n, c.ids[z][cols], score))
        if found:
            best.take(*(np.concatenate(x) for x in zip(*found)))


def _tile(q_ids, q, thr, c_ids, c, turn: np.ndarray, k: int):
    """Rows (query, id, score) that may enter the k best of their query."""
    a, b = _Side(q_ids, q, turn), _Side(c_ids, c, turn)
    best = _Best(a, k)
    low = thr[a.order]
    best.full = np.isfinite(low)
    best.low = np.where(best.full, np.ceil(np.where(best.full, low, 0)), 0).astype(np.int64)
    _scan(a, best, b)
    return best.rows()


def _packed(df: DataFrame, path: str, rows: int, n: int, d: int, kind: str, *order) -> DataFrame:
    """Vectors in the order given, up to ``rows`` packed into one row: (block, n, longest, ids, norms, v)."""
    spark, x_type = df.sparkSession, _KINDS[kind]
    rows = max(1, min(rows, PACK_BYTES // (d * np.dtype(x_type).itemsize)))
    blocks = math.ceil(n / rows)
    parts = max(1, math.ceil(blocks / HELD), min(blocks, spark.sparkContext.defaultParallelism))
    dealt = df.repartitionByRange(parts, *order) if parts > 1 else df.coalesce(1)
    dealt = dealt.sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "id", F.col("v").cast(f"array<{kind}>").alias("v"), "norm")

    def pack(batches):
        held, size, number = [], 0, 0

        def row():
            t = pa.Table.from_batches(held).combine_chunks()
            x, norm = _matrix(t["v"], d, x_type), t["norm"].to_numpy()
            block = (t["part"][0].as_py() << 32) + number
            cols = [pa.array([block]), pa.array([len(norm)]), pa.array([norm.max()]), pa.array([t["id"].to_numpy()], pa.list_(pa.int64())),
                    pa.array([norm], pa.list_(pa.float64())), pa.array([x.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, names=["block", "n", "longest", "ids", "norms", "v"])

        for b in batches:
            while b.num_rows:
                held.append(b.slice(0, rows - size))
                b, size = b.slice(rows - size), size + held[-1].num_rows
                if size == rows:
                    yield row()
                    held, size, number = [], 0, number + 1
        if held:
            yield row()

    dealt.mapInArrow(pack, "block long, n long, longest double, ids array<long>, norms array<double>, v binary").write.parquet(path)
    return spark.read.parquet(path)


def _shares(left: int, right: int, cores: int) -> tuple[int, int]:
    """Into how many parts to deal so many packed rows of two sides, so that their pairs keep the cores busy."""
    a, b = math.ceil(left / HELD), math.ceil(right / HELD)
    while a * b < 3 * cores and (a < left or b < right):
        if left / a >= right / b:
            a = min(left, 2 * a)
        else:
            b = min(right, 2 * b)
    return a, b


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, vec_id, score) of each query's k best; both inputs as ``quantise`` gives them."""
    spark = vectors.sparkSession
    visible(spark)
    path = scratch_path(spark, "topk")
    empty = spark.createDataFrame([], "query_id long, vec_id long, score long")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.select("id", "v", "norm").write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    vectors, queries = stored(vectors, "vectors"), stored(queries, "queries")
    sizes = [F.count("*").alias("n"), F.max(F.size("v")).alias("d"), F.max("norm").alias("norm")]
    stats, asked = vectors.agg(*sizes).first(), queries.agg(*sizes).first()
    if not stats.n or not asked.n:
        return empty
    d = max(1, stats.d, asked.d)
    turn = rotation(vectors, d)
    longest = max(stats.norm, asked.norm) * (1 + 1e-6)
    kind = next(name for name, x_type in _KINDS.items() if longest < np.iinfo(x_type).max or x_type is np.int64)
    c = _packed(vectors, f"{path}/blocks", block_rows, stats.n, d, kind, F.col("norm").desc(), F.col("id"))
    q = _packed(queries, f"{path}/asked", query_rows * PACKED, asked.n, d, kind, F.col("id"))
    blocks = sorted(tuple(r) for r in c.select("block", "n").collect())
    q_blocks = sorted(r.block for r in q.select("block").collect())
    members = q.select("block", F.explode(F.arrays_zip("ids", "norms")).alias("m")).select("block", F.col("m.ids").alias("id"), F.col("m.norms").alias("norm"))
    members = members.groupBy("block", "id").agg(F.max("norm").alias("norm"))

    def tiles(batches):
        sides: dict[str, OrderedDict] = {"q": OrderedDict(), "c": OrderedDict()}
        bests = {}

        def side(name: str, b: pa.RecordBatch, i: int) -> _Side:
            held, key = sides[name], b[f"{name}_block"][i].as_py()
            if key not in held:
                ids = b[f"{name}_ids"][i].values.to_numpy()
                held[key] = _Side(ids, np.frombuffer(b[f"{name}_v"][i].as_buffer(), _KINDS[kind]).reshape(len(ids), d), turn)
                if len(held) > (HELD if name == "q" else 2):  # a block stays for all query blocks of a task
                    held.popitem(last=False)
            held.move_to_end(key)
            return held[key]

        for b in batches:
            for i in range(b.num_rows):
                key, left, right = b["q_block"][i].as_py(), side("q", b, i), side("c", b, i)
                if key not in bests:
                    known = b["known"][i].values
                    bests[key] = _Best(left, k, [known.field(x).to_numpy() for x in ("id", "score", "vec_id")] if known is not None else None)
                _scan(left, bests[key], right)
            del b  # before the next batch is read
        for best in bests.values():
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in best.rows()], names=["query_id", "vec_id", "score"])

    def dealt(df: DataFrame, keys: list[int], parts: int) -> DataFrame:
        """The packed rows of ``keys``, in ``parts`` partitions of neighbours."""
        at = spark.createDataFrame([(key, i * parts // len(keys)) for i, key in enumerate(keys)], "block long, part int")
        return df.join(F.broadcast(at), "block").repartitionById(parts, F.col("part")).drop("part")

    kept, done, step, number = None, 0, 1, 0
    while done < len(blocks):
        todo, rows = [], 0
        while done < len(blocks) and rows < step * block_rows:
            todo.append(blocks[done][0])
            rows, done = rows + blocks[done][1], done + 1
        asked_parts, parts = _shares(len(q_blocks), len(todo), spark.sparkContext.defaultParallelism)
        if kept is None:
            known = q.withColumn("known", F.lit(None).cast("array<struct<id:bigint,score:bigint,vec_id:bigint>>")).withColumn("reach", F.lit(-math.inf))
        else:
            last = kept.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), "score", "vec_id")
            thr = F.col("score").cast("double") * (1 - F.signum("score") * 1e-9) - 1e-6
            # |q| * longest is below the threshold for all shorter vectors; a query that is not full needs every block
            reach = F.when(F.col("score").isNull() | (thr <= 0), -math.inf).when(F.col("norm") == 0, math.inf).otherwise(thr / (F.col("norm") * (1 + 1e-6)))
            last = members.join(last, "id", "left").withColumn("reach", reach).groupBy("block").agg(
                F.sort_array(F.collect_list(F.when(F.col("score").isNotNull(), F.struct("id", "score", "vec_id")))).alias("known"), F.min("reach").alias("reach"))
            known = q.join(last, "block")
        left = dealt(c.filter(F.col("block").between(todo[0], todo[-1])).select("block", "longest", "ids", "v"), todo, parts)
        right = dealt(known.select("block", "ids", "v", "known", "reach"), q_blocks, asked_parts)
        left = left.select(F.col("block").alias("c_block"), "longest", F.col("ids").alias("c_ids"), F.col("v").alias("c_v"))
        right = right.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("v").alias("q_v"), "known", "reach")
        pairs = left.join(right, F.col("longest") >= F.col("reach")).drop("longest", "reach")
        found = pairs.mapInArrow(tiles, "query_id long, vec_id long, score long")
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        ranked = (found if kept is None else kept.drop("rank").unionByName(found)).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked.write.parquet(f"{path}/round-{number}")
        kept = spark.read.parquet(f"{path}/round-{number}")
        step, number = step * 4, number + 1
    return kept.drop("rank")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: ids divisible by 50 against every other row, five best."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    best = top_k(quantise(rows), quantise(rows.filter(F.col("vec_id").cast("long") % 50 == 0)), k=5)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.select("query_id", F.row_number().over(order).cast("int").alias("rank"), "vec_id", "score")


OP9_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0
)
select query_id, cast(row_number() over w as integer) as rank, vec_id, score from s
window w as (partition by query_id order by score desc, vec_id)
qualify row_number() over w <= 5
"""
