"""Embedding near-duplicates: a hierarchical navigable small-world graph per shard.

1. Vectors count when their label is not null and they are not null, not zero and hold finite numbers only. They
   are compared within a group: equal label, equal length. Equal vectors become one representative with a weight.
2. A group is dealt by hash over shards of about ``shard_rows`` vectors. Each shard builds a graph: a vector is
   on layer l with probability ``m**-l``, keeps at most ``m`` neighbours (twice that on layer 0), chosen so that
   none is nearer to a kept one than to the vector, and is found from the top layer down with a beam.
3. Audit: ``AUDIT`` members of the shard that have links are compared with all of it; the beam of the shard is
   doubled until at least ``RECALL`` of their links, without themselves, come back. The graph, its beam and the
   recall measured are stored.
4. Every representative queries every shard of its group, in blocks of ``block_rows``. If all that a beam holds is
   linked there may be more, and the query is compared with the whole shard. What comes back is verified: cosine
   in double precision of the stored numbers, at least ``threshold``. A block sends on only as many links as
   connect what it found; the components of all are united by stars.
5. Links live inside components only, so the links of a vector are counted there, in blocks, exactly: each pair
   of blocks of a component is a task of its own. Copies count with their weight.

The graph is stored and its rows are sent to the tasks that query it, so a lost executor costs one shard or block.
Vectors that do not count have no links and stand alone. Null ids: such a vector counts as a neighbour, but a
component is named by the least id that is not null. Other columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Cut, components, ship

SHARD_ROWS, BLOCK_ROWS, COUNT_ROWS, BUCKETS = 20_000, 4096, 2048, 256
AUDIT, RECALL, BEAM = 64, 0.95, 48


class Graph:
    """The graph of one shard over unit vectors (float32), searched and built for many vectors at once."""

    def __init__(self, vectors: np.ndarray, m: int = 12, beam: int = BEAM, seed: int = 11):
        self.x = np.ascontiguousarray(vectors, np.float32)
        self.m, self.beam = m, beam
        n = len(self.x)
        random = np.random.default_rng(seed)
        levels = np.minimum((-np.log(random.random(n) + 1e-12) / np.log(m)).astype(int), 6)
        self.top = int(levels.max(initial=0))
        self.links = [np.full((n, 2 * m if level == 0 else m), -1, np.int32) for level in range(self.top + 1)]
        order = random.permutation(n)
        self.entry = int(order[np.argmax(levels[order] == self.top)]) if n else -1
        # The entry goes in first, so every later vector finds it.
        order = np.concatenate([[self.entry], order[order != self.entry]]) if n else order
        self._insert(order, levels)

    def _insert(self, order: np.ndarray, levels: np.ndarray) -> None:
        at = min(len(order), 64)
        self._connect(order[:at], levels, fresh=True)
        while at < len(order):
            size = min(384, at, len(order) - at)
            self._connect(order[at : at + size], levels, fresh=False)
            at += size

    def _connect(self, batch: np.ndarray, levels: np.ndarray, fresh: bool) -> None:
        start = np.full((len(batch), 1), self.entry, np.int32)
        for level in range(self.top, -1, -1):
            here = np.flatnonzero(levels[batch] >= level)
            if fresh:
                found = np.full((len(batch), 0), -1, np.int32)
            else:
                found, _ = self.search(self.x[batch], start, self.beam, level)
                start = found[:, :4]
            if not len(here):
                continue
            new = batch[here]
            # What lies in the batch itself is compared in full.
            inner = self.x[new] @ self.x[new].T
            np.fill_diagonal(inner, -2.0)
            k = min(len(new) - 1, self.beam)
            peers = np.argpartition(-inner, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(new), 0), int)
            candidates = np.concatenate([found[here], new[peers].astype(np.int32)], axis=1)
            width = self.links[level].shape[1]
            self.links[level][new] = self._choose(new, candidates, self.m, width)
            self._back(new, level)

    def _choose(self, nodes: np.ndarray, candidates: np.ndarray, most: int, width: int) -> np.ndarray:
        """Neighbours none of which is nearer to a chosen one than to the node; free places are filled
        with the nearest of the others."""
        out = np.full((len(nodes), width), -1, np.int32)
        for at in range(0, len(nodes), 128):
            own, c = nodes[at : at + 128], candidates[at : at + 128]
            c = np.where(c == own[:, None], -1, c)
            near = np.einsum("qd,qkd->qk", self.x[own], self.x[c]).astype(np.float32)
            near[c < 0] = -3.0
            rank = np.argsort(-near, axis=1, kind="stable")[:, : 3 * most + 16]
            c, near = np.take_along_axis(c, rank, 1), np.take_along_axis(near, rank, 1)
            rows = self.x[c]
            between = np.einsum("qid,qjd->qij", rows, rows)
            valid = near > -2.5
            chosen = np.zeros(c.shape, bool)
            for j in range(c.shape[1]):
                same = (c[:, :j] == c[:, j : j + 1]).any(axis=1)
                worst = np.where(chosen[:, :j], between[:, j, :j], -2.0).max(axis=1, initial=-2.0)
                valid[:, j] &= ~same
                chosen[:, j] = valid[:, j] & (worst < near[:, j]) & (chosen.sum(axis=1) < most)
            spare = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
            picked = np.where(np.take_along_axis(valid, spare, 1), np.take_along_axis(c, spare, 1), -1)
            out[at : at + 128, : picked.shape[1]] = picked
        return out

    def _back(self, new: np.ndarray, level: int) -> None:
        """Enter new vectors with their neighbours, which keep their best."""
        links = self.links[level]
        to = links[new]
        source = np.repeat(new, to.shape[1])[to.ravel() >= 0]
        target = to.ravel()[to.ravel() >= 0]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        width = links.shape[1]
        free = (links[nodes] < 0).sum(axis=1)
        easy = count <= free
        for node, f, k in zip(nodes[easy], first[easy], count[easy], strict=True):
            row = links[node]
            used = int((row >= 0).sum())
            row[used : used + k] = source[f : f + k]
        hard = np.flatnonzero(~easy)
        if len(hard):
            most = int(count[hard].max())
            fresh = np.full((len(hard), most), -1, np.int32)
            for i, h in enumerate(hard):
                fresh[i, : count[h]] = source[first[h] : first[h] + count[h]]
            links[nodes[hard]] = self._choose(nodes[hard], np.concatenate([links[nodes[hard]], fresh], axis=1), width, width)

    def search(self, queries: np.ndarray, start: np.ndarray, beam: int, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Nearest vectors on a layer, best first, and their cosines; -1 fills what is missing."""
        ids = np.empty((len(queries), beam), np.int32)
        near = np.empty((len(queries), beam), np.float32)
        for at in range(0, len(queries), 256):
            ids[at : at + 256], near[at : at + 256] = self._search(queries[at : at + 256], start[at : at + 256], beam, level)
        return ids, near

    def _search(self, queries: np.ndarray, start: np.ndarray, beam: int, level: int) -> tuple[np.ndarray, np.ndarray]:
        q, links, together = len(queries), self.links[level], 4
        seen = np.zeros((q, len(self.x) + 1), bool)
        ids = np.full((q, beam), -1, np.int32)
        near = np.full((q, beam), -3.0, np.float32)
        done = np.ones((q, beam), bool)
        width = min(start.shape[1], beam)
        ids[:, :width] = start[:, :width]
        for j in range(1, width):
            ids[:, j][(ids[:, :j] == ids[:, j : j + 1]).any(axis=1)] = -1
        have = ids >= 0
        near[have] = np.einsum("kd,kd->k", queries[np.nonzero(have)[0]], self.x[ids[have]])
        done[have] = False
        np.put_along_axis(seen, np.where(have, ids, len(self.x)), True, axis=1)
        live = np.arange(q)
        while len(live):
            waiting = np.where(done[live], -9.0, near[live])
            pick = np.argpartition(-waiting, min(together, beam) - 1, axis=1)[:, :together]
            open_ = ~np.take_along_axis(done[live], pick, 1)
            some = open_.any(axis=1)
            live, pick, open_ = live[some], pick[some], open_[some]
            if not len(live):
                break
            rows = np.take_along_axis(ids[live], pick, 1)
            done[live[:, None], pick] = True
            next_ = np.where(open_[:, :, None], links[rows], -1).reshape(len(live), -1)
            known = np.take_along_axis(seen[live], np.where(next_ < 0, len(self.x), next_), 1)
            next_ = np.where(known, -1, next_)
            next_.sort(axis=1)
            next_[:, 1:][next_[:, 1:] == next_[:, :-1]] = -1
            seen[live[:, None], np.where(next_ < 0, len(self.x), next_)] = True
            score = np.full(next_.shape, -3.0, np.float32)
            r, c = np.nonzero(next_ >= 0)
            score[r, c] = np.einsum("kd,kd->k", queries[live[r]], self.x[next_[r, c]])
            all_ids = np.concatenate([ids[live], next_], axis=1)
            all_near = np.concatenate([near[live], score], axis=1)
            all_done = np.concatenate([done[live], next_ < 0], axis=1)
            best = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
            ids[live], near[live], done[live] = (np.take_along_axis(a, best, 1) for a in (all_ids, all_near, all_done))
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)

    def query(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        start = np.full((len(queries), 1), self.entry, np.int32)
        for level in range(self.top, 0, -1):
            start, _ = self.search(queries, start, 4, level)
        return self.search(queries, start, beam, 0)

    def audit(self, threshold: float, sample: int = AUDIT, wanted: float = RECALL, seed: int = 5) -> tuple[int, float]:
        """The beam that finds ``wanted`` of the linked neighbours of ``sample`` members that have any, and the recall."""
        n = len(self.x)
        order = np.random.default_rng(seed).permutation(n)
        picked, true = [], []
        for at in range(0, n, 256):
            near = self.x[order[at : at + 256]] @ self.x.T >= threshold
            near[np.arange(len(near)), order[at : at + 256]] = False
            for i in np.flatnonzero(near.any(axis=1)).tolist():
                picked.append(order[at + i])
                true.append(np.flatnonzero(near[i]))
            if len(picked) >= sample:
                break
        picked, true = picked[:sample], true[:sample]
        beam, links = self.beam, sum(map(len, true))
        while links:
            found, near = self.query(self.x[picked], min(beam, n))
            # Who fills the beam with links is compared with all of the shard.
            full = near[:, -1] >= threshold
            hits = sum(len(t) if f else len(np.intersect1d(t, o)) for t, f, o in zip(true, full, found, strict=True))
            if hits >= wanted * links or beam >= n:
                return min(beam, n), hits / links
            beam *= 2
        return min(beam, n), 1.0

    def linked(self, queries: np.ndarray, beam: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Members of cosine ``least`` or more and their cosines, for each query. A query whose beam holds nothing
        else may have more: it is compared with every member."""
        found, near = self.query(queries, beam)
        good = (found >= 0) & (near >= least)
        full = good[:, -1]
        for at in range(0, len(queries), 256):
            more = np.flatnonzero(full[at : at + 256]) + at
            every = iter(queries[more] @ self.x.T)
            for i in range(at, min(at + 256, len(queries))):
                if full[i]:
                    row = next(every)
                    members = np.flatnonzero(row >= least)
                    yield members, row[members]
                else:
                    yield found[i][good[i]], near[i][good[i]]

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, x=self.x, meta=np.array([self.m, self.beam, self.top, self.entry]), **{f"l{i}": v for i, v in enumerate(self.links)})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Graph:
        held = np.load(io.BytesIO(data))
        graph = cls.__new__(cls)
        graph.x = held["x"]
        graph.m, graph.beam, graph.top, graph.entry = (int(v) for v in held["meta"])
        graph.links = [held[f"l{i}"] for i in range(graph.top + 1)]
        return graph


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in column])


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by their largest entry first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, size, vector`` of the vectors that count, in double precision."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists(vector, lambda v: v != 0.0)
    return embeddings.filter(F.coalesce(good, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.size("embedding").alias("size"), vector.alias("vector")
    )


_GROUP = ["label", "size"]
_INDEX = "label long, size int, shard int, ids binary, graph binary, beam int, recall double"


def index(reps: DataFrame, threshold: float) -> DataFrame:
    """One row per shard: its ids, its graph, the beam its audit asks for and the recall measured."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        graph = Graph(_unit(_matrix(pdf["vector"])))
        beam, recall = graph.audit(threshold)
        row = [pdf["label"].iloc[0], pdf["size"].iloc[0], pdf["shard"].iloc[0], pdf["id"].to_numpy(np.int64).tobytes(), graph.pack(), beam, recall]
        return pd.DataFrame([row], columns=[p.split()[0] for p in _INDEX.split(", ")])

    return Cut(reps.select(*_GROUP, "shard", "id", "vector").groupBy(*_GROUP, "shard").applyInPandas(build, _INDEX), "index").df


def _query(graphs: DataFrame, queries: DataFrame, threshold: float) -> DataFrame:
    """Verified links ``a, b`` that connect what each block found in each shard."""

    def ask(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        row = left.iloc[0]
        graph, ids = Graph.unpack(row["graph"]), np.frombuffer(row["ids"], np.int64)
        own, unit = right["id"].to_numpy(np.int64), _unit(_matrix(right["vector"]))
        # float32 finds; the stored vectors decide below. Beyond the slack of float32 a link is sure.
        slack = 1e-5 + 1.2e-7 * unit.shape[1]
        a, b, unsure = [], [], []
        label = np.arange(len(ids))
        for id_, (members, near) in zip(own, graph.linked(unit.astype(np.float32), int(row["beam"]), threshold - slack), strict=True):
            sure = near >= threshold + slack
            if not sure.all():
                unsure += [(id_, m) for m in members[~sure] if ids[m] != id_]
                members = members[sure]
            if not len(members):
                continue
            labels = label[members]
            if (labels == labels[0]).all():
                first = members[:2] if ids[members[0]] == id_ else members[:1]
            else:
                # One link for each of the parts that this vector joins.
                kinds, at = np.unique(labels, return_index=True)
                first = np.append(members[at], members[:1])
                label[np.isin(label, kinds)] = kinds[0]
            first = first[ids[first] != id_]
            a += [id_] * len(first)
            b += ids[first].tolist()
        a += [id_ for id_, _ in unsure]
        b += [ids[m] for _, m in unsure]
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    on = [*_GROUP, "shard", "block"]
    return graphs.groupBy(*on).cogroup(queries.groupBy(*on)).applyInPandas(ask, "a long, b long")


def _verified(links: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Links whose cosine in double precision reaches the threshold."""
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    x = reps.select(F.col("id").alias("a"), F.col("vector").alias("x"))
    y = reps.select(F.col("id").alias("b"), F.col("vector").alias("y"))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                cosine = (_unit(_matrix(pdf["x"])) * _unit(_matrix(pdf["y"]))).sum(axis=1)
                yield pdf.loc[cosine >= threshold, ["a", "b"]]

    return pairs.join(x, "a").join(y, "b").mapInPandas(check, "a long, b long")


def _counts(reps: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """``id, near``: summed weights of the other representatives linked with each one."""
    own = reps.select("id", "weight", "vector")
    named = own.join(labels.select(F.col("node").alias("id"), F.col("label").alias("component")), "id")
    sizes = named.groupBy("component").agg(F.ceil(F.count("*") / F.lit(COUNT_ROWS)).cast("int").alias("blocks"))
    joined = named.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    # Small components share tasks: a bucket of them is one group, and there are more of these where there are more rows.
    buckets = max(BUCKETS, -(-reps.count() // COUNT_ROWS))
    bucket = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(buckets))).otherwise(F.col("component"))
    spread = joined.withColumn("other", other).select(
        bucket.alias("bucket"),
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "blocks", "component", "id", "weight", "own", "vector",
    )

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, near = [], []
        for _, part in pdf.groupby("component", sort=False):
            low, high = part["low"].iloc[0], part["high"].iloc[0]
            p, q = part[part["own"] == low], part[part["own"] == high]
            u, v = _unit(_matrix(p["vector"])) if len(p) else None, _unit(_matrix(q["vector"])) if len(q) else None
            if u is None or v is None:
                continue
            linked = u @ v.T >= threshold
            if low == high:
                np.fill_diagonal(linked, False)
            ids.append(p["id"].to_numpy())
            near.append(linked @ q["weight"].to_numpy())
            if low != high:
                ids.append(q["id"].to_numpy())
                near.append(linked.T @ p["weight"].to_numpy())
        flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pd.DataFrame({"id": flat(ids), "near": flat(near)})

    return spread.groupBy("bucket", "low", "high", "blocks").applyInPandas(count, "id long, near long").groupBy("id").agg(F.sum("near").alias("near"))


def classes(embeddings: DataFrame, threshold: float = 0.98, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``embeddings`` (vec_id, embedding, label)."""
    ship(embeddings.sparkSession)
    counted = usable(embeddings)
    grouped = counted.groupBy(*_GROUP, "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    # Representatives get an id of their own, since vec_id may be null or repeat.
    keyed = grouped.withColumn("id", F.xxhash64(*_GROUP, "vector"))
    sizes = keyed.groupBy(*_GROUP).agg(F.count("*").alias("n"))
    per = keyed.join(sizes, _GROUP).select(
        *_GROUP, "id", "least", "weight", "vector",
        F.ceil(F.col("n") / F.lit(shard_rows)).cast("int").alias("shards"),
        F.ceil(F.col("n") / F.lit(block_rows)).cast("int").alias("blocks"),
    )
    dealt = per.withColumn("shard", F.pmod("id", F.col("shards")).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int")
    )
    reps = Cut(dealt, "reps").df
    graphs = index(reps, threshold)
    # New names for the columns, so that the cogroup below can tell its two sides apart.
    blocks = reps.select(*[F.col(c).alias(c) for c in (*_GROUP, "block")]).distinct()
    queries = reps.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select(*_GROUP, "shard", "block", "id", "vector")
    found = Cut(_query(graphs.join(blocks, _GROUP), queries, threshold), "found")
    links = Cut(_verified(found.df, reps, threshold), "links")
    labels = Cut(components(links.df), "labels").df
    near = _counts(reps, labels, threshold)
    # Components are named by the least id of a vector.
    named = reps.select("id", "least", "weight").join(labels.withColumnRenamed("node", "id"), "id", "left")
    named = named.withColumn("label", F.coalesce("label", "id"))
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    known = named.join(names, "label").join(near, "id", "left").select("id", "component_id", (F.coalesce("near", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", F.xxhash64(F.col("label").cast("long"), F.size("embedding"), vector).alias("id"), F.col("label").isNotNull().alias("labelled"))
    joined = rows.join(known.withColumn("labelled", F.lit(True)), ["id", "labelled"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
