"""Approximate nearest neighbours: NN-descent by joins of neighbours of neighbours, then greedy graph search.

Nodes are distinct vectors. Work goes by blocks of nodes (a hash of their ids): a block gets the ids it needs from its own
rows and each vector that these name once, and sends lists of better neighbours to the blocks of those whom they concern.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, tidy


@dataclass(frozen=True)
class Setting:
    """degree: neighbours kept of each node. The first graph is of trees random orders, cut into leaves of so many nodes, then come rounds of NN-descent with sample new neighbours (and reverse ones) of each node at a time, until less than settled of all neighbours are new. A search keeps its beam best nodes (ten for each doubling of the nodes, where that is more) and ends when all are expanded. values: vector components of a block's nodes."""

    degree: int = 32
    trees: int = 4
    leaf: int = 512
    settled: float = 0.01
    sample: int = 16
    reverse: int = 64
    beam: int = 160
    values: int = 8192 * 64


EDGES = "u long, v array<long>, s array<float>"
GRAPH = f"{EDGES}, old array<boolean>, pick array<boolean>"


def matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype(np.int32)), pa.array(values, kind))


def flat(t: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, one after another, and the row of each."""
    col = t.column(name).combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    sizes = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return col.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(col)), sizes)


def best(u: np.ndarray, v: np.ndarray, s: np.ndarray, most: int, extra: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Of each u its most best v by s (of equal ones the smaller v), each v once; extra, if any, is the greatest of equal v's."""
    x = np.zeros(len(u), bool) if extra is None else extra
    o = np.lexsort((~x, v, u))
    u, v, s, x = u[o], v[o], s[o], x[o]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    u, v, s, x = u[new], v[new], s[new], x[new]
    o = np.lexsort((v, -s, u))
    u, v, s, x = u[o], v[o], s[o], x[o]
    first = np.flatnonzero(np.append(True, u[1:] != u[:-1])) if len(u) else np.zeros(0, np.int64)
    rank = np.arange(len(u)) - np.repeat(first, np.diff(np.append(first, len(u))))
    keep = rank < most
    return u[keep], v[keep], s[keep], x[keep]


def edge_table(u: np.ndarray, v: np.ndarray, s: np.ndarray) -> pa.Table:
    """Rows of lists from edges that are sorted by u."""
    first = np.flatnonzero(np.append(True, u[1:] != u[:-1])) if len(u) else np.zeros(0, np.int64)
    return pa.table({"u": pa.array(u[first], pa.int64()), "v": lists(v, first, pa.int64()), "s": lists(s.astype(np.float32), first, pa.float32())})


PACKED = "b int, u array<long>, v array<long>, s array<float>"


def packed(block: np.ndarray, u: np.ndarray, v: np.ndarray, s: np.ndarray) -> pa.Table:
    """One row of edges for each block."""
    o = np.argsort(block, kind="stable")
    block, u, v, s = block[o], u[o], v[o], s[o]
    first = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
    return pa.table({"b": pa.array(block[first], pa.int32()), "u": lists(u, first, pa.int64()), "v": lists(v, first, pa.int64()), "s": lists(s.astype(np.float32), first, pa.float32())})


def block_of(c: Column | str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")


def first_graph(vecs: DataFrame, dim: int, setting: Setting, n: int) -> DataFrame:
    """Edges among nodes that lie together in random orders: by the signs along some random directions, then along one more."""
    bits = max(0, int(np.ceil(np.log2(max(1, n / setting.leaf)))))
    parts = max(1, n // (8 * setting.leaf))
    out = None
    for tree in range(setting.trees):
        def project(it: Iterator[pa.RecordBatch], tree: int = tree) -> Iterator[pa.RecordBatch]:
            w = np.random.default_rng(tree).normal(size=(dim, bits + 1)).astype(np.float32)
            for b in it:
                x = matrix(b.column("vec"), dim) @ w if b.num_rows else np.zeros((0, bits + 1))
                code = ((x[:, :bits] > 0) << np.arange(bits)).sum(1) if bits else np.zeros(b.num_rows, np.int64)
                yield pa.RecordBatch.from_arrays([b.column("u"), b.column("vec"), pa.array(code.astype(np.int64)), pa.array(x[:, bits].astype(np.float64))], names=["u", "vec", "code", "along"])

        def leaves(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for b in it:
                held.append(b)
                if sum(x.num_rows for x in held) >= 3 * setting.leaf:
                    t = pa.Table.from_batches(held)
                    while t.num_rows >= 2 * setting.leaf:
                        yield from leaf(t.slice(0, setting.leaf))
                        t = t.slice(setting.leaf)
                    held = t.to_batches()
            if held:
                t = pa.Table.from_batches(held)
                half = t.num_rows if t.num_rows <= setting.leaf else t.num_rows // 2
                for i in range(0, t.num_rows, max(1, half)):
                    yield from leaf(t.slice(i, half))

        def leaf(t: pa.Table) -> list[pa.RecordBatch]:
            u, x = t.column("u").to_numpy(), matrix(t.column("vec"), dim)
            if len(u) < 2:
                return []
            m = x @ x.T
            np.fill_diagonal(m, -np.inf)
            k = min(setting.degree, len(u) - 1)
            at = np.argpartition(-m, k - 1, axis=1)[:, :k]
            return edge_table(*best(np.repeat(u, k), u[at].ravel(), np.take_along_axis(m, at, 1).ravel(), k)[:3]).to_batches()

        rows = vecs.select("u", "vec").mapInArrow(tidy(project), "u long, vec array<float>, code long, along double").repartitionByRange(parts, "code", "along").sortWithinPartitions("code", "along").mapInArrow(tidy(leaves), EDGES)
        out = rows if out is None else out.union(rows)
    return out


def merge(graph: DataFrame | None, found: DataFrame, blocks: int, setting: Setting, salt: int) -> DataFrame:
    """Each node's best neighbours of the graph's and those found (rows by node, or, besides a graph, packed by block); picks new ones for the next round."""

    def kept(u: np.ndarray, v: np.ndarray, s: np.ndarray, x: np.ndarray) -> pa.Table:
        u, v, s, x = best(u, v, s, setting.degree, x)
        # of the new ones a sample: those with the least hashed ends
        h = (u.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ v.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93 + 2 * salt)
        o = np.lexsort((h ^ (h >> np.uint64(32)), x, u))
        first = np.flatnonzero(np.append(True, u[1:] != u[:-1])) if len(u) else np.zeros(0, np.int64)
        rank = np.arange(len(u)) - np.repeat(first, np.diff(np.append(first, len(u))))
        pick = np.zeros(len(u), bool)
        pick[o] = (rank < setting.sample) & ~x[o]
        out = edge_table(u, v, s)
        return out.append_column("old", lists(x | pick, first, pa.bool_())).append_column("pick", lists(pick, first, pa.bool_()))

    def edges(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v, row = flat(t, "v")
        return t.column("u").to_numpy()[row], v, flat(t, "s")[0]

    def first(key: tuple, t: pa.Table) -> pa.Table:
        u, v, s = edges(t)
        return kept(u, v, s, np.zeros(len(u), bool))

    def more(key: tuple, g: pa.Table, t: pa.Table) -> pa.Table:
        u, v, s = edges(g)
        x = flat(g, "old")[0].astype(bool)
        u2, v2, s2 = flat(t, "u")[0], flat(t, "v")[0], flat(t, "s")[0]
        return kept(np.concatenate((u, u2)), np.concatenate((v, v2)), np.concatenate((s, s2)), np.concatenate((x, np.zeros(len(u2), bool))))

    if graph is None:
        return cut(found.groupBy(block_of("u", blocks).alias("b")).applyInArrow(first, GRAPH), "graph")
    return cut(graph.groupBy(block_of("u", blocks).alias("at")).cogroup(found.groupBy("b")).applyInArrow(more, GRAPH), "graph")


def descend(graph: DataFrame, vecs: DataFrame, dim: int, blocks: int, setting: Setting, salt: int) -> DataFrame:
    """One round: the neighbours of each node, either way, meet there; better ones are found for each of them."""
    # neighbours that are neither old nor picked wait for a later round
    e = graph.select("u", F.explode(F.arrays_zip("v", "old", "pick")).alias("e")).where("e.old").select("u", F.col("e.v").alias("v"), F.col("e.pick").alias("new"))
    w = Window.partitionBy("node", "new").orderBy(F.xxhash64("member", F.lit(salt)))
    back = e.select(F.col("v").alias("node"), F.col("u").alias("member"), "new").withColumn("r", F.row_number().over(w)).where(F.col("r") <= setting.sample).drop("r")
    members = cut(e.select(F.col("u").alias("node"), F.col("v").alias("member"), "new").union(back).withColumn("b", block_of("node", blocks)), "members")
    worst = graph.select("u", F.when(F.size("s") >= setting.degree, F.element_at("s", -1)).otherwise(F.lit(float("-inf"))).cast("float").alias("worst"))
    known = vecs.select("u", "vec").join(worst, "u")
    wanted = members.select(F.col("b").alias("at"), F.col("member").alias("u")).distinct().withColumn("home", block_of("u", blocks))
    here = known.select("u", "vec", "worst", block_of("u", blocks).alias("own"))

    def send(key: tuple, w: pa.Table, x: pa.Table) -> pa.Table:
        """For each block that wants some of this block's vectors, one row of them."""
        ids = x.column("u").to_numpy()
        o = np.argsort(ids)
        ids, vec, worst = ids[o], matrix(x.column("vec"), dim)[o], x.column("worst").to_numpy()[o]
        at, place = w.column("at").to_numpy(), np.searchsorted(ids, w.column("u").to_numpy())
        o = np.argsort(at, kind="stable")
        at, place = at[o], place[o]
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.zeros(0, np.int64)
        return pa.table({"at": pa.array(at[first], pa.int32()), "home": pa.array([key[0].as_py()] * len(first), pa.int32()), "u": lists(ids[place], first, pa.int64()), "vec": lists(vec[place].ravel(), first * dim, pa.float32()), "worst": lists(worst[place].astype(np.float32), first, pa.float32())})

    asked = wanted.groupBy("home").cogroup(here.groupBy("own")).applyInArrow(send, "at int, home int, u array<long>, vec array<float>, worst array<float>")

    def meet(key: tuple, m: pa.Table, x: pa.Table) -> pa.Table:
        ids, row = flat(x, "u")
        o = np.argsort(ids)
        ids, home, worst = ids[o], x.column("home").to_numpy()[row][o], flat(x, "worst")[0][o]
        vec = flat(x, "vec")[0].reshape(-1, dim)[o]
        node, member, new = (m.column(c).to_numpy() for c in ("node", "member", "new"))
        at = np.searchsorted(ids, member)
        o = np.lexsort((at, ~new, node))
        node, at, new = node[o], at[o], new[o]
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, np.int64)
        us, vs, ss = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
        size = 0
        for a, z in zip(first, np.append(first[1:], len(node)), strict=True):
            k = int(new[a:z].sum())
            if not k:
                continue
            fresh = np.unique(at[a : a + k])
            every = np.concatenate((fresh, np.setdiff1d(at[a + k : z], fresh)))
            sim = vec[fresh] @ vec[every].T
            i, j = np.nonzero((sim > worst[fresh][:, None]) | (sim > worst[every][None, :]))
            x1, y1, sv = fresh[i], every[j], sim[i, j]
            for p, q in ((x1, y1), (y1, x1)):
                ok = (p != q) & (sv > worst[p])
                us.append(p[ok])
                vs.append(q[ok])
                ss.append(sv[ok])
                size += int(ok.sum())
            if size > 4_000_000:
                got = best(np.concatenate(us), np.concatenate(vs), np.concatenate(ss), setting.degree)
                us, vs, ss, size = [got[0]], [got[1]], [got[2]], 0
        u, v, s, _ = best(np.concatenate(us), np.concatenate(vs), np.concatenate(ss), setting.degree)
        return packed(home[u], ids[u], ids[v], s)

    found = members.groupBy("b").cogroup(asked.groupBy("at")).applyInArrow(meet, PACKED)
    return merge(graph, found, blocks, setting, salt)


def unsettled(graph: DataFrame, setting: Setting) -> bool:
    """Whether enough neighbours are new since the round before, or wait for a round that takes them."""
    new = F.size(F.filter(F.arrays_zip("old", "pick"), lambda e: ~e["old"] | e["pick"]))
    told = graph.agg(F.sum(new).alias("new"), F.sum(F.size("old")).alias("all")).first()
    return (told["new"] or 0) > setting.settled * (told["all"] or 0)


def adjacency(graph: DataFrame, setting: Setting) -> DataFrame:
    """u and its neighbours either way; of very many reverse ones those with the least hashed ids."""
    e = graph.select("u", F.explode("v").alias("v"))
    w = Window.partitionBy("v").orderBy(F.xxhash64("u"))
    back = e.withColumn("r", F.row_number().over(w)).where(F.col("r") <= setting.reverse).select(F.col("v").alias("u"), F.col("u").alias("v"))
    return e.union(back).groupBy("u").agg(F.collect_set("v").alias("near"))


def dots(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed alike wherever its row stands."""
    return (x.astype(np.float64) * q.astype(np.float64)).sum(1)


STATE = "q long, vec array<float>, c array<long>, s array<double>, done array<boolean>"


def search(queries: DataFrame, vecs: DataFrame, graph: DataFrame, dim: int, blocks: int, setting: Setting) -> DataFrame:
    """q and its beam (c, s) of nodes by inner product, found from the nodes themselves (queries: q, a node, and vec) through the graph."""
    near = cut(adjacency(graph, setting).withColumn("b", block_of("u", blocks)), "adjacency")
    places = vecs.select(block_of("u", blocks).alias("b"), "u", "raw")
    state = queries.select("q", "vec", F.array("q").alias("c"), F.array(F.lit(float("-inf"))).alias("s"), F.array(F.lit(False)).alias("done"))
    state = cut(state, "beams")

    def frontier(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for q, vec, c, s, done in zip(*(b.column(x).to_pylist() for x in ("q", "vec", "c", "s", "done")), strict=True):
                at = [x for x, d in zip(c, done, strict=True) if not d]
                if at:
                    worst = s[-1] if len(s) >= setting.beam else float("-inf")
                    yield pa.RecordBatch.from_arrays([pa.array([q] * len(at)), pa.array([vec] * len(at), pa.list_(pa.float32())), pa.array([worst] * len(at), pa.float64()), pa.array(at)], names=["q", "vec", "worst", "f"])

    def expand(key: tuple, f: pa.Table, a: pa.Table) -> pa.Table:
        """For each query and block, the ids of that block that the frontier names."""
        near_ids, row = flat(a, "near")
        us = a.column("u").to_numpy()
        o = np.argsort(us)
        place = {int(u): i for i, u in enumerate(us)}
        starts = np.searchsorted(row, np.arange(len(us) + 1))
        del o
        by_q: dict[int, list] = {}
        vec = f.column("vec").combine_chunks()
        for i, (q, x) in enumerate(zip(f.column("q").to_pylist(), f.column("f").to_pylist(), strict=True)):
            k = place.get(x)
            got = by_q.setdefault(q, [i, []])
            got[1].append(np.array([x]))
            if k is not None:
                got[1].append(near_ids[starts[k] : starts[k + 1]])
        qs, at, ids = [], [], []
        for q, (i, parts) in by_q.items():
            qs.append(q)
            at.append(i)
            ids.append(np.unique(np.concatenate(parts)))
        first = np.cumsum([0, *map(len, ids)])[:-1]
        return pa.table({"q": pa.array(qs, pa.int64()), "vec": vec.take(pa.array(at, pa.int64())), "worst": f.column("worst").take(pa.array(at, pa.int64())), "w": lists(np.concatenate(ids) if ids else np.zeros(0, np.int64), first, pa.int64())})

    def score(key: tuple, m: pa.Table, x: pa.Table) -> pa.Table:
        ids = x.column("u").to_numpy()
        o = np.argsort(ids)
        ids, raw = ids[o], matrix(x.column("raw"), dim)[o]
        by_q: dict[int, list] = {}
        for i, q in enumerate(m.column("q").to_pylist()):
            by_q.setdefault(q, []).append(i)
        vec, worst, w = matrix(m.column("vec"), dim), m.column("worst").to_numpy(), m.column("w").to_pylist()
        qs, cs, ss = [], [], []
        for q, rows in by_q.items():
            c = np.unique(np.concatenate([np.array(w[i], np.int64) for i in rows]))
            at = np.searchsorted(ids, c)
            s = dots(raw[at], vec[rows[0]])
            keep = s >= worst[rows[0]]
            c, s = c[keep], s[keep]
            o = np.lexsort((c, -s))[: setting.beam]
            qs.append(q)
            cs.append(c[o])
            ss.append(s[o])
        first = np.cumsum([0, *map(len, cs)])[:-1]
        return pa.table({"q": pa.array(qs, pa.int64()), "c": lists(np.concatenate(cs) if cs else np.zeros(0, np.int64), first, pa.int64()), "s": lists(np.concatenate(ss) if ss else np.zeros(0), first, pa.float64())})

    def keep(key: tuple, st: pa.Table, m: pa.Table) -> pa.Table:
        """Each query's beam of what it had, which is expanded now, and what was found."""
        place = {q: i for i, q in enumerate(st.column("q").to_pylist())}
        c0, r0 = flat(st, "c")
        s0, _ = flat(st, "s")
        c1, r1 = flat(m, "c")
        s1, _ = flat(m, "s")
        mq = np.array([place[q] for q in m.column("q").to_pylist()], np.int64)
        u = np.concatenate((r0, mq[r1])) if len(mq) else r0
        v, s = np.concatenate((c0, c1)), np.concatenate((s0, s1))
        done = np.concatenate((np.ones(len(c0), bool), np.zeros(len(c1), bool)))
        scored = s > -np.inf  # the first round's own node comes back with its score
        was = np.zeros(len(u), bool) | done
        if not scored.all():
            start = {(a, b) for a, b in zip(u[~scored].tolist(), v[~scored].tolist(), strict=True)}
            was |= np.fromiter(((a, b) in start for a, b in zip(u.tolist(), v.tolist(), strict=True)), bool, len(u))
        u, v, s, x = best(u[scored], v[scored], s[scored], setting.beam, was[scored])
        first = np.searchsorted(u, np.arange(st.num_rows))
        return pa.table({"q": st.column("q"), "vec": st.column("vec"), "c": lists(v, first, pa.int64()), "s": lists(s, first, pa.float64()), "done": lists(x, first, pa.bool_())})

    # ends: a beam only gets better, and no node that left it comes back
    while state.where(F.exists("done", lambda x: ~x)).limit(1).count():
        f = state.mapInArrow(tidy(frontier), "q long, vec array<float>, worst double, f long").withColumn("b", block_of("f", blocks))
        named = f.groupBy("b").cogroup(near.groupBy("b")).applyInArrow(expand, "q long, vec array<float>, worst double, w array<long>")
        named = named.select("q", "vec", "worst", F.explode("w").alias("w")).withColumn("b", block_of("w", blocks)).groupBy("b", "q").agg(F.first("vec").alias("vec"), F.first("worst").alias("worst"), F.collect_set("w").alias("w"))
        found = named.groupBy("b").cogroup(places.groupBy("b")).applyInArrow(score, "q long, c array<long>, s array<double>")
        qb = block_of("q", blocks).alias("b")
        state = cut(state.groupBy(qb).cogroup(found.groupBy(block_of("q", blocks).alias("b"))).applyInArrow(keep, STATE), "beams")
    return state.select("q", "c", "s")


def nearest(rows: DataFrame, is_query: Column, k: int = 20, setting: Setting = Setting()) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found for each query row of rows (vec_id, embedding), nearest first.

    is_query tells queries by vec_id; candidates are all rows but the query's own. Nearness is the inner product in double
    precision, greater first, of equal ones the smaller vec_id. Vectors that are null, zero, hold null or non-finite
    components, or have another length than most, take no part, nor do null ids. Repeated rows count once; of one id
    with different vectors the least vector counts. Fewer candidates than k: all. No query or no vector: no rows.

    Equal vectors are one node, however many rows have them; its k + 1 smallest ids stand for them, which is all that a
    result can show. The graph's nearness is the inner product with one component more that makes all lengths equal, so
    it is a distance even where lengths differ; scores are of the vectors themselves.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    d = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("raw"))
    size = d.groupBy(F.size("raw").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if size is None:
        return empty
    dim = size["n"]
    d = d.where(F.size("raw") == dim).groupBy("vec_id").agg(F.min("raw").alias("raw"))
    ids = cut(d.withColumn("ask", is_query), "vectors")
    # each task keeps its own k + 1 least ids of a vector before they meet, however many rows have it
    first = F.row_number().over(Window.partitionBy("raw").orderBy("vec_id"))
    copies = cut(ids.withColumn("r", first).where(F.col("r") <= k + 1).select("vec_id", "raw", "r"), "copies")
    nodes = copies.where("r = 1").select(F.col("vec_id").alias("u"), "raw")
    told = nodes.agg(F.count("*").alias("n"), F.max(F.aggregate("raw", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("m")).first()
    n, longest = told["n"], told["m"]
    rest = F.sqrt(F.greatest(F.lit(0.0), F.lit(longest) - F.aggregate("raw", F.lit(0.0), lambda a, x: a + x.cast("double") * x))).cast("float")
    vecs = cut(nodes.select("u", "raw", F.concat("raw", F.array(rest)).alias("vec")), "nodes")
    blocks = max(1, -(-n * dim // setting.values))
    setting = replace(setting, beam=max(setting.beam, 10 * n.bit_length()))
    graph, i = merge(None, first_graph(vecs, dim + 1, setting, n), blocks, setting, 0), 0
    while n > setting.leaf and unsettled(graph, setting):
        i += 1
        graph = descend(graph, vecs, dim + 1, blocks, setting, i)
    node = nodes.select(F.col("u").alias("node"), "raw")
    stand = cut(copies.join(node, "raw").select("vec_id", "node"), "stand-ins")
    asks = cut(ids.where("ask").join(node, "raw").select("vec_id", "node", "raw"), "asks")
    asked = asks.groupBy(F.col("node").alias("q")).agg(F.first("raw").alias("vec"))
    found = search(asked, vecs, graph, dim, blocks, setting)
    found = found.select("q", F.explode(F.slice(F.arrays_zip("c", "s"), 1, k + 1)).alias("e")).select("q", F.col("e.c").alias("node"), F.col("e.s").alias("score"))
    named = found.join(stand, "node").select("q", "vec_id", "score")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    named = named.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)
    out = asks.select(F.col("vec_id").alias("query_id"), F.col("node").alias("q")).join(named, "q").where("query_id != vec_id")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
