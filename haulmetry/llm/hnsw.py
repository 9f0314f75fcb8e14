"""Embedding near-duplicates: a navigable small-world graph per shard, audited beams, exact cosines, components.

Equal vectors are one node. Nodes are dealt to shards of bounded size, and each shard gets a hierarchical
graph. A node within half the linking angle of a graph node found for it joins that node's ball and not
the graph, so a crowd of near copies neither traps the walk nor is walked member by member.

Each shard audits itself: vectors turned away from members by exactly the linking angle are looked up, and
the beam is widened until nearly all members that brute force finds for them are found. Then every node
queries every shard. Where a whole beam still is within reach, that query's beam is widened too. Balls in
reach are compared member by member in double precision, but for those that angles put inside or outside
for certain. Links within a crowd are counted, never written: components need one edge a pair of balls.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetry.llm.common import dropped, file_system, mix, new_path, parts_for, staged
from haulmetry.llm.minhash import components

NEAR = 0.9
#: A task builds one shard, and holds two when it searches: so many numbers each, on average (64 MB).
#: A larger graph costs a query less than one more graph, so there are no more shards than that asks
#: for, but so many at least, which are built side by side.
SHARD_NUMBERS, SHARDS = 8_000_000, 8
#: Links of a node on upper levels (twice as many on the lowest), beam while building, first beam of an audit.
LINKS, BUILD_BEAM, FIRST_BEAM = 16, 48, 32
#: Audit: so many turned vectors a shard, and the share of their true links that must be found.
AUDITED, AUDIT_SHARE = 256, 0.995
#: Shards that a task searches for one shard of queries.
SHARDS_A_TASK = 2
#: Beam entries expanded in a step; numbers held by a step of a search; error of single precision.
_STEP, _HELD, _LOOSE = 4, 8_000_000, 1e-5


class Graph:
    """Hierarchical graph over the ball centres among ``vectors`` (unit length, in double precision)."""

    def __init__(self, vectors: np.ndarray, seeds: np.ndarray, near: float = NEAR):
        draw = (mix(seeds.astype(np.uint64)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        heights = np.floor(-np.log(1.0 - draw) / np.log(LINKS)).astype(np.int64)
        # Tallest first: the first node is where every walk starts.
        self.order = np.lexsort((draw, -heights))
        self.vectors, heights = vectors[self.order], heights[self.order]
        n, self.near = len(vectors), near
        self.ball = float(np.cos(np.arccos(near) / 2))
        self.centre_of = np.full(n, -1, np.int64)
        self.centres = np.zeros(0, np.int64)
        self.x = np.zeros((0, vectors.shape[1]), np.float32)
        self.links = [np.full((0, 2 * LINKS if not k else LINKS), -1, np.int32) for k in range(int(heights[0]) + 1 if n else 1)]
        at = 0
        while at < n:
            size = min(max(32, len(self.centres)), 256, n - at)
            self._insert(np.arange(at, at + size), heights[at : at + size])
            at += size
        self._close()
        self.beam, self.recall = FIRST_BEAM, 1.0

    # Building

    def _insert(self, rows: np.ndarray, heights: np.ndarray) -> None:
        exact, known = self.vectors[rows], len(self.centres)
        found = self._descend(exact.astype(np.float32), [BUILD_BEAM] * len(self.links)) if known else None
        fresh = np.ones(len(rows), bool)
        if known:
            best = found[0][0][:, 0]
            cos = np.einsum("ij,ij->i", self.vectors[self.centres[best]], exact)
            fresh = cos < self.ball
            self.centre_of[rows[~fresh]] = best[~fresh]
        # Nodes of this batch may lie in each other's balls: earlier ones are the centres.
        among = exact @ exact.T
        close = np.tril(among >= self.ball, -1) & fresh & fresh[:, None]
        taken = np.zeros(len(rows), bool)
        for k in np.flatnonzero(close.any(axis=1)):
            near = np.flatnonzero(close[k] & ~taken)
            if len(near):
                taken[k] = True
                self.centre_of[rows[k]] = -2 - near[np.argmax(among[k, near])]
        new = np.flatnonzero(fresh & ~taken)
        number = np.full(len(rows), -1)
        number[new] = known + np.arange(len(new))
        joins = rows[taken]
        self.centre_of[joins] = number[-2 - self.centre_of[joins]]
        self.centre_of[rows[new]] = number[new]
        self.centres = np.concatenate((self.centres, rows[new]))
        self.x = np.concatenate((self.x, exact[new].astype(np.float32)))
        among, heights = among[np.ix_(new, new)].astype(np.float32), heights[new]
        np.fill_diagonal(among, -np.inf)
        for level in range(len(self.links)):
            old = self.links[level]
            self.links[level] = np.concatenate((old, np.full((len(new), old.shape[1]), -1, np.int32)))
            on = np.flatnonzero(heights >= level)
            if not len(on):
                continue
            ids, sims = np.broadcast_to(known + on, (len(on), len(on))), among[np.ix_(on, on)]
            if known:
                ids = np.concatenate((found[level][0][new[on]], ids), axis=1)
                sims = np.concatenate((found[level][1][new[on]], sims), axis=1)
            width = self.links[level].shape[1]
            ids, sims = _top(ids, sims, 2 * width)
            picked = self._diverse(ids, sims, LINKS)
            self.links[level][known + on, : picked.shape[1]] = picked
            self._back(level, known + on, picked)

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Of candidates in descending order: those nearer to the node than to any chosen one, then the nearest."""
        valid = (ids >= 0) & (sims > -np.inf)
        x = self.x[np.maximum(ids, 0)]
        pairs = x @ x.transpose(0, 2, 1)
        chosen, nearest = np.zeros(ids.shape, bool), np.full(ids.shape, -np.inf, np.float32)
        for c in range(ids.shape[1]):
            ok = valid[:, c] & (sims[:, c] > nearest[:, c]) & (chosen.sum(axis=1) < width)
            chosen[:, c] = ok
            nearest[ok] = np.maximum(nearest[ok], pairs[ok, c])
        order = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :width]
        return np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(ids, order, 1), -1).astype(np.int32)

    def _back(self, level: int, rows: np.ndarray, picked: np.ndarray) -> None:
        """Link the picked nodes back, and thin lists that grow too long."""
        source, target = np.repeat(rows, picked.shape[1]), picked.ravel()
        source, target = source[target >= 0], target[target >= 0]
        if not len(target):
            return
        sims = np.einsum("ij,ij->i", self.x[source], self.x[target])
        order = np.lexsort((-sims, target))
        source, target = source[order], target[order]
        nodes, first = np.unique(target, return_index=True)
        place = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
        width = self.links[level].shape[1]
        keep = place < width
        coming = np.full((len(nodes), int(place[keep].max()) + 1), -1, np.int64)
        coming[np.searchsorted(nodes, target[keep]), place[keep]] = source[keep]
        for at in range(0, len(nodes), 256):
            some, more = nodes[at : at + 256], coming[at : at + 256]
            have = self.links[level][some]
            more = np.where((more[:, :, None] == have[:, None, :]).any(axis=2), -1, more)
            ids = np.concatenate((have, more), axis=1)
            sims = np.einsum("ikd,id->ik", self.x[np.maximum(ids, 0)], self.x[some])
            sims[ids < 0] = -np.inf
            thinned = self._diverse(*_top(ids, sims, ids.shape[1]), width)
            self.links[level][some] = -1
            self.links[level][some, : thinned.shape[1]] = thinned

    def _close(self) -> None:
        """Members by ball, and how near a query must be to a centre to be within reach of its ball."""
        self.members = np.argsort(self.centre_of, kind="stable")
        self.first = np.searchsorted(self.centre_of[self.members], np.arange(len(self.centres) + 1))
        cos = np.einsum("ij,ij->i", self.vectors, self.vectors[self.centres[self.centre_of]]) if len(self.centres) else np.zeros(0)
        self.radius = np.zeros(len(self.centres))
        np.maximum.at(self.radius, self.centre_of, np.where(self.centres[self.centre_of] == np.arange(len(cos)), 0.0, np.arccos(np.clip(cos, -1, 1)) + 1e-7))
        self.least = np.cos(np.minimum(np.arccos(self.near) + self.radius, np.pi)) - _LOOSE
        self.floor = float(self.least.min()) if len(self.least) else 1.0

    # Searching

    def _beams(self, level: int, q: np.ndarray, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes that a best-first walk from ``start`` meets, nearest first."""
        m, lists = len(q), self.links[level]
        row = np.arange(m)[:, None]
        seen = np.zeros((m, len(self.x) + 1), bool)  # the last column takes what is no node
        seen[row, start] = True
        seen[:, -1] = True
        sims = np.einsum("ikd,id->ik", self.x[np.maximum(start, 0)], q)
        sims[start < 0] = -np.inf
        short = ((0, 0), (0, max(0, beam - start.shape[1])))
        ids, sims = _top(np.pad(start, short, constant_values=-1), np.pad(sims, short, constant_values=-np.inf), beam)
        fresh = ids >= 0
        live = np.arange(m)
        while len(live):
            ahead = np.where(fresh[live], sims[live], -np.inf)
            step = min(_STEP, ahead.shape[1])
            pick = np.argpartition(-ahead, step - 1, axis=1)[:, :step]
            some = np.take_along_axis(ahead, pick, 1) > -np.inf
            live, pick, some = live[some.any(axis=1)], pick[some.any(axis=1)], some[some.any(axis=1)]
            if not len(live):
                break
            fresh[live[:, None], pick] = False
            near = np.where(some[:, :, None], lists[np.maximum(ids[live[:, None], pick], 0)], -1).reshape(len(live), -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near = np.where(seen[live[:, None], near], -1, near)
            seen[live[:, None], near] = True
            sim = np.matmul(self.x[np.maximum(near, 0)], q[live][:, :, None])[:, :, 0]
            sim[near < 0] = -np.inf
            every = np.concatenate((sims[live], sim), axis=1)
            part = np.argpartition(-every, beam - 1, axis=1)[:, :beam]
            got = np.concatenate((ids[live], near), axis=1)
            new = np.concatenate((fresh[live], near >= 0), axis=1)
            ids[live], sims[live], fresh[live] = (np.take_along_axis(v, part, 1) for v in (got, every, new))
        return _top(ids, sims, beam)

    def _descend(self, q: np.ndarray, beams: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """What the walk finds on each level, from the top to the lowest."""
        found: list = [None] * len(self.links)
        start = np.zeros((len(q), 1), np.int64)
        for level in reversed(range(len(self.links))):
            found[level] = self._beams(level, q, start, beams[level])
            start = found[level][0]
        return found

    def reach(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, centre) with the centre's ball in reach of the query, by beams of that width at least.

        A beam that is within reach as a whole is doubled. One as wide as the graph is all of it.
        """
        found, waiting = [], np.arange(len(q))
        while len(waiting) and len(self.x):
            wide = min(beam, len(self.x))
            again = []
            share = max(16, min(1024, _HELD // (_STEP * self.links[0].shape[1] * q.shape[1]), 4 * _HELD // (len(self.x) + wide)))
            for at in range(0, len(waiting), share):
                rows = waiting[at : at + share]
                one = q[rows].astype(np.float32)
                if wide == len(self.x):
                    ids, sims = np.broadcast_to(np.arange(wide), (len(rows), wide)), one @ self.x.T
                else:
                    ids, sims = self._descend(one, [wide, *[8] * (len(self.links) - 1)])[0]
                    full = (ids[:, -1] >= 0) & (sims[:, -1] >= self.floor)
                    again.append(rows[full])
                    rows, ids, sims = rows[~full], ids[~full], sims[~full]
                r, c = np.nonzero((ids >= 0) & (sims >= self.least[ids]))
                found.append((rows[r], ids[r, c]))
            waiting = np.concatenate(again) if again else np.zeros(0, np.int64)
            beam = 2 * wide
        empty = np.zeros(0, np.int64)
        return tuple(np.concatenate([f[k] for f in found] or [empty]).astype(np.int64) for k in range(2))

    def linked(self, q: np.ndarray, copies: np.ndarray, own: bool, beam: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many vectors each query links to, and the pairs (query, centre) of balls that hold one.

        ``copies`` is how many vectors each node stands for. With ``own`` the queries are the nodes
        themselves in their order, and a node is not linked to itself.
        """
        query, ball = self.reach(q, beam or self.beam)
        # From the angle to the centre and the ball's radius: all members are linked for certain.
        cos = np.concatenate([np.einsum("ij,ij->i", q[query[s]], self.vectors[self.centres[ball[s]]]) for s in _chunks(len(query), q.shape[1])] or [np.zeros(0)])
        within = np.arccos(np.clip(cos, -1, 1)) + self.radius[ball] + 1e-7 <= np.arccos(self.near)
        counts, held = np.zeros(len(q), np.int64), np.add.reduceat(np.append(copies[self.members], 0), self.first[:-1]) if len(self.centres) else np.zeros(0, np.int64)
        np.add.at(counts, query[within], held[ball[within]])
        hit = within.copy()
        if own:
            self_in = within & (self.centre_of[query] == ball)
            counts[query[self_in]] -= copies[query[self_in]]
        rest = np.flatnonzero(~within)
        size = self.first[ball[rest] + 1] - self.first[ball[rest]]
        upto = np.cumsum(size)
        at = 0
        while at < len(rest):
            done = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, done + max(1, _HELD // (4 * q.shape[1])), side="right")))
            some = np.repeat(rest[at:to], size[at:to])
            member = self.members[np.arange(len(some)) + np.repeat(self.first[ball[rest[at:to]]] - (upto[at:to] - size[at:to] - done), size[at:to])]
            asked = query[some]
            for s in _chunks(len(some), q.shape[1]):
                ok = np.einsum("ij,ij->i", q[asked[s]], self.vectors[member[s]]) >= self.near
                if own:
                    ok &= asked[s] != member[s]
                np.add.at(counts, asked[s][ok], copies[member[s][ok]])
                hit[some[s][ok]] = True
            at = to
        return counts, query[hit], ball[hit]

    def audit(self, least: float = AUDIT_SHARE, size: int = AUDITED) -> None:
        """Widen the beam until that share of the links of turned vectors is found."""
        rng = np.random.default_rng(len(self.vectors))
        some = rng.choice(len(self.vectors), min(size, len(self.vectors)), replace=False)
        side = rng.standard_normal((len(some), self.vectors.shape[1]))
        side -= np.einsum("ij,ij->i", side, self.vectors[some])[:, None] * self.vectors[some]
        norm = np.linalg.norm(side, axis=1, keepdims=True)
        angle = np.arccos(self.near) - 1e-6
        turned = np.where(norm > 1e-9, np.cos(angle) * self.vectors[some] + np.sin(angle) * side / np.maximum(norm, 1e-9), self.vectors[some])
        true = int((turned @ self.vectors.T >= self.near).sum())
        one = np.ones(len(self.vectors), np.int64)
        while True:
            self.recall = int(self.linked(turned, one, False)[0].sum()) / max(1, true)
            if self.recall >= least or self.beam >= len(self.x):
                return
            self.beam *= 2

    # Files

    def saved(self, uids: np.ndarray, copies: np.ndarray) -> bytes:
        out = io.BytesIO()
        parts = {f"links{k}": links for k, links in enumerate(self.links)}
        np.savez(out, vectors=self.vectors, centre_of=self.centre_of, centres=self.centres, beam=self.beam, near=self.near, uids=uids[self.order], copies=copies[self.order], **parts)
        return out.getvalue()

    @classmethod
    def read(cls, data: bytes) -> tuple[Graph, np.ndarray, np.ndarray]:
        """A graph, and the ids and copies of its nodes in their order."""
        held = np.load(io.BytesIO(data))
        graph = cls.__new__(cls)
        graph.vectors, graph.centre_of, graph.centres = held["vectors"], held["centre_of"], held["centres"]
        graph.beam, graph.near = int(held["beam"]), float(held["near"])
        graph.links = [held[f"links{k}"] for k in range(sum(n.startswith("links") for n in held.files))]
        graph.x = graph.vectors[graph.centres].astype(np.float32)
        graph._close()
        return graph, held["uids"], held["copies"]


def _top(ids: np.ndarray, sims: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of each row, nearest first."""
    order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    return np.take_along_axis(ids, order, 1).astype(np.int64), np.take_along_axis(sims, order, 1)


def _chunks(rows: int, columns: int) -> Iterator[slice]:
    each = max(1, _HELD // (4 * columns))
    return (slice(at, at + each) for at in range(0, rows, each))


def _unit(v: np.ndarray) -> np.ndarray:
    """Unit vectors, safe for components of any size."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _built(folder: str, near: float, table: pa.Table) -> pa.Table:
    """Index one shard, write it to the shared folder under a name of this attempt, and return where."""
    dim, shard = table.column("dim")[0].as_py(), table.column("shard")[0].as_py()
    vectors = np.concatenate([c.flatten().to_numpy() for c in table.column("v").chunks]).reshape(-1, dim)
    uids, copies = (table.column(c).to_numpy() for c in ("uid", "copies"))
    graph = Graph(_unit(vectors), uids, near)
    graph.audit()
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    name = f"{dim}-{shard}-{uuid.uuid4().hex}.npz"
    with system.open_output_stream(f"{path}/{name}") as out:
        out.write(graph.saved(uids, copies))
    return pa.table({"dim": [dim], "shard": pa.array([shard], pa.int64()), "name": [name], "beam": pa.array([graph.beam], pa.int64()), "recall": [graph.recall], "nodes": pa.array([len(uids)], pa.int64())}, schema=pa.schema([("dim", pa.int32()), ("shard", pa.int64()), ("name", pa.string()), ("beam", pa.int64()), ("recall", pa.float64()), ("nodes", pa.int64())]))


def _searched(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Query shards with the nodes of another: links counted (``a``, ``links``), and edges (``a``, ``b``)."""
    system, path = file_system(folder)

    def load(name: str):
        with system.open_input_stream(f"{path}/{name}") as file:
            return Graph.read(file.read())

    for batch in batches:
        for asking, names in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            queries, uids, copies = load(asking)
            total = np.zeros(len(uids), np.int64)
            for name in names:
                own = name == asking
                graph, ids, many = (queries, uids, copies) if own else load(name)
                counts, query, ball = graph.linked(queries.vectors, many, own)
                total += counts
                # Members are linked to their centres, so one edge stands for all links of two balls.
                edges = np.stack((uids[queries.centres[queries.centre_of[query]]], ids[graph.centres[ball]]), axis=1)
                if own:
                    edges = np.concatenate((edges, np.stack((uids, uids[queries.centres[queries.centre_of]]), axis=1)))
                edges = np.unique(edges[edges[:, 0] != edges[:, 1]], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1]), pa.nulls(len(edges), pa.int64())], ["a", "b", "links"])
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(uids[some]), pa.nulls(len(some), pa.int64()), pa.array(total[some])], ["a", "b", "links"])


def indexed(nodes: DataFrame, folder: str, near: float = NEAR, shards: int = SHARDS, shard_numbers: int = SHARD_NUMBERS) -> DataFrame:
    """One audited graph a shard over ``uid``, ``v``, ``copies``: where it lies, its beam and its recall."""
    numbers = nodes.agg(F.sum(F.size("v"))).first()[0] or 0
    shards = max(shards, -(-numbers // shard_numbers))
    dealt = nodes.select("uid", "v", "copies", F.size("v").alias("dim"), F.pmod(F.xxhash64("uid"), F.lit(shards)).alias("shard"))
    schema = "dim int, shard bigint, name string, beam bigint, recall double, nodes bigint"

    def build(table: pa.Table) -> pa.Table:
        return _built(folder, near, table)

    return staged(dealt.groupBy("dim", "shard").applyInArrow(build, schema), "shards")


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    near: float = NEAR,
    shards: int = SHARDS,
    shard_numbers: int = SHARD_NUMBERS,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``: one row per row.

    Vectors of a cosine of ``near`` or more are linked; ``n_links`` counts other rows, equal vectors
    included. Vectors that are null, empty, zero or hold a null or non-finite component link with
    nothing, nor do vectors of different lengths. A component's id is its smallest vec_id and the row
    of that id is kept. Rows without id link like others; where nothing they link to has an id, their
    component is null and they are kept. Rows that share an id are vectors of their own. An empty
    table gives no rows. Other columns play no part.
    """
    spark = vectors.sparkSession
    made = vectors.select(vectors[vec_id].cast("bigint").alias("vec_id"), vectors[embedding].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    made = made.withColumn("v", F.when(sound, F.transform("v", lambda x: x + F.lit(0.0))))  # -0.0 is 0.0
    rows = staged(made.withColumn("key", F.sha2(F.array_join("v", ","), 256)), "vectors")
    held = rows.where("key is not null").groupBy("key").agg(F.first("v").alias("v"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    nodes = staged(held.withColumn("uid", F.monotonically_increasing_id()), "nodes")

    folder = new_path(spark, "graphs")
    graphs = indexed(nodes, folder, near, shards, shard_numbers)
    count = (graphs.agg(F.max("shard")).first()[0] or 0) + 1
    groups = graphs.groupBy("dim", F.floor(F.col("shard") / SHARDS_A_TASK).alias("group")).agg(F.sort_array(F.collect_list("name")).alias("names"))
    asked = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<bigint>")))
    work = asked.join(graphs.select("dim", "shard", F.col("name").alias("asking")), ["dim", "shard"]).select("asking", "names")
    work = staged(work, "work")
    tasks = parts_for(spark, 32.0 * min(work.count(), 10_000))
    found = staged(work.repartition(tasks).mapInArrow(partial(_searched, folder), "a bigint, b bigint, links bigint"), "found")

    counts = found.where("links is not null").groupBy(F.col("a").alias("uid")).agg(F.sum("links").alias("links"))
    placed = nodes.join(components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "uid"), "uid", "left")
    placed = placed.select("uid", "key", "copies", "least", F.coalesce("root", "uid").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    told = staged(placed.join(smallest, "root").join(counts, "uid", "left").select("key", links, "component_id"), "told")
    for done in (found, work, nodes):
        dropped(done)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept")
    alone = rows.where("key is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = rows.where("key is not null").select("vec_id", "key").join(told, "key").select("vec_id", "n_links", "component_id")
    return every.union(alone).select("*", kept)
