"""Embedding near-duplicates on a robust-pruned flat graph.

Vectors of one label (and length) are compared by cosine.  Equal vectors are one
point; their copies are counted, never paired.  Per label, centroids are fitted
on a bounded sample and every point joins the shards of its ``OVERLAP`` nearest
centroids.  In each shard a graph is built by robust pruning (of a point's
nearest candidates one is kept unless a kept one is closer to it, by the factor
``ALPHA``, than the point is); the adjacency lists of all shards are united.
Every shard then searches the united lists for each of its points: best-first
from the shard's medoid and the point itself, ``BEAM`` steps, then range
expansion from everything at the threshold until nothing new turns up.  What is
linked is decided by the cosine in double precision.

The search then leaves its shards, in rounds: a point visits every shard that a
point it is linked with belongs to, is compared with the points whose nearest
centroid is that shard's, and the links found there say where to go next, until
no point has a shard left to visit.

A group of vectors that are all within the threshold has as many links as
pairs, so links are never listed: a task counts them per point and returns the
connected parts of its shard as one row per point; the parts are joined to
components over all shards.  A pair that meets in several shards counts in the
first of them, a pair of a visit in one of the two directions.  A shard of more
than ``MAX_SHARD`` points is cut; its parts are searched in pairs, and visitors
come in groups of as many, so no task holds more.

``audit_recall`` measures recall against brute force for a stated query set.

Defined results: a null label, and a vector that is null, zero, empty or holds
null or non-finite components, links with nothing and is its own component;
repeated rows are copies; a null vec_id is never a component's name (a component
of null ids only has none), but its row and links count; rows that repeat an id with
another vector are vectors of their own; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import top_k_per_group
from .common import table, written
from .components import components

THRESHOLD = 0.93
SHARD = 400                 # points per centroid
MAX_SHARD = 1_600
OVERLAP = 2
SAMPLE = 20_000             # points of a label the centroids are fitted on, at most
CENTROIDS = 1_000           # of a label, at most
LLOYD = 6
ASSIGN_ROWS = 20_000        # points assigned to shards by one task
CANDIDATES, DEGREE, ALPHA, BEAM = 64, 24, 1.2, 24
QUERY_EVERY = 50


def _matrix(col) -> np.ndarray:
    """A list column of equal lengths as a float64 matrix, a row each."""
    flat = pa.chunked_array([col]) if isinstance(col, pa.Array) else col
    values = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    rows = len(values)
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


# ---------------------------------------------------------------- in one shard

def pruned_graph(x: np.ndarray) -> np.ndarray:
    """Robust-pruned out-neighbours of unit vectors: rows of row numbers,
    padded with -1."""
    n = len(x)
    sim = x @ x.T
    np.fill_diagonal(sim, -3.0)
    c = min(CANDIDATES, n - 1)
    out = np.full((n, DEGREE), -1, dtype=np.int64)
    if c < 1:
        return out
    near = np.argpartition(-sim, c - 1, axis=1)[:, :c]
    row = np.arange(n)[:, None]
    near = np.take_along_axis(near, np.argsort(-sim[row, near], axis=1, kind="stable"), axis=1)
    own = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * sim[row, near]))          # distance to the candidates
    alive = np.ones((n, c), dtype=bool)
    for k in range(DEGREE):
        some = alive.any(axis=1)
        if not some.any():
            break
        pick = near[np.arange(n), alive.argmax(axis=1)]
        out[some, k] = pick[some]
        between = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.where(near == pick[:, None], 1.0, sim[pick[:, None], near])))
        alive &= ALPHA * between > own
        alive[near == pick[:, None]] = False
        alive[~some] = False
    return out


def range_search(x: np.ndarray, graph: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """For every point, the points that a search of the graph finds at the
    threshold (boolean matrix, symmetric, without the diagonal).  ``graph``:
    boolean adjacency."""
    n = len(x)
    sim = x @ x.T
    graph = graph | graph.T
    medoid = int((x @ x.mean(axis=0)).argmax())
    me = np.arange(n)
    seen = np.zeros((n, n), dtype=bool)
    seen[me, me] = True
    seen[:, medoid] = True
    done = np.zeros((n, n), dtype=bool)
    for _ in range(min(BEAM, n)):                       # best-first, every query at once
        best = np.where(seen & ~done, sim, -3.0).argmax(axis=1)
        done[me, best] = True
        seen |= graph[best]
    steps = graph.astype(np.float32)
    while True:                                         # range expansion
        front = seen & ~done & (sim >= threshold)
        if not front.any():
            break
        done |= front
        rows = np.flatnonzero(front.any(axis=1))
        seen[rows] |= (front[rows].astype(np.float32) @ steps) > 0
    found = seen & (sim >= threshold)
    found |= found.T
    found[me, me] = False
    return found


def local_parts(found: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Per point the smallest id of its connected part."""
    low = ids.copy()
    while True:
        near = np.where(found, low[None, :], np.iinfo(np.int64).max).min(axis=1)
        new = np.minimum(low, near)
        new = np.minimum(new, low[np.searchsorted(ids, new)])
        if (new == low).all():
            return low
        low = new


# ---------------------------------------------------------------- points, centroids, shards

def _usable(c: str = "embedding"):
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists(c, lambda v: v != 0)
    return F.coalesce(F.col("label").isNotNull() & F.col(c).isNotNull() & finite & some, F.lit(False))


def _fit(batch: pa.Table) -> pa.Table:
    """Centroids of one label's sample."""
    points = _unit(_matrix(batch.column("embedding")))
    order = np.lexsort(points.T[::-1])
    points = points[order]
    k = min(int(batch.column("k")[0].as_py()), len(points))
    rng = np.random.default_rng(11)
    centres = points[np.sort(rng.choice(len(points), k, replace=False))]
    for _ in range(LLOYD):
        own = np.concatenate([(points[i:i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(points), 4096)])
        total = np.zeros_like(centres)
        np.add.at(total, own, points)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centres = np.where(size > 0, total / np.maximum(size, 1e-300), centres)
    return pa.table({"label": pa.array([batch.column("label")[0].as_py()] * k, pa.int64()),
                     "dim": pa.array([batch.column("dim")[0].as_py()] * k, pa.int32()),
                     "centre": pa.array(list(centres), pa.list_(pa.float64()))})


def _assign(points: pa.Table, centres: pa.Table) -> pa.Table:
    """Points with the shards of their nearest centroids."""
    if not points.num_rows:
        return pa.table({"label": pa.array([], pa.int64()), "dim": pa.array([], pa.int32()), "id": pa.array([], pa.int64()),
                         "copies": pa.array([], pa.int64()), "embedding": pa.array([], pa.list_(pa.float32())),
                         "shards": pa.array([], pa.list_(pa.int32()))})
    x, c = _unit(_matrix(points.column("embedding"))), _matrix(centres.column("centre"))
    take = min(OVERLAP, len(c))
    near = []
    for i in range(0, len(x), 2048):
        near.append(np.argsort(-(x[i:i + 2048] @ c.T), axis=1, kind="stable")[:, :take])
    near = np.concatenate(near)
    return pa.table({k: points.column(k) for k in ("label", "dim", "id", "copies", "embedding")}
                    | {"shards": pa.array(list(near.astype(np.int32)), pa.list_(pa.int32()))})


def points_and_members(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                       label: str = "label") -> tuple[DataFrame, DataFrame]:
    """(points, members): one row per distinct vector of a label (a written ``id`` of
    its own, and ``name``, its smallest vec_id, if any), and every usable row with
    its point's id."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<float>").alias("embedding"),
                          F.col(label).cast("long").alias("label"))
    usable = rows.where(_usable()).withColumn("dim", F.size("embedding"))
    same = usable.groupBy("label", "dim", "embedding").agg(F.min("vec_id").alias("name"), F.count(F.lit(1)).alias("copies"))
    points = written(same.withColumn("id", F.monotonically_increasing_id()), "vec-points")
    keyed = points.select(F.col("label").alias("l"), F.col("embedding").alias("e"), "id", "copies")
    members = usable.join(keyed, (usable["label"] == keyed["l"]) & (usable["embedding"] == keyed["e"])).select("vec_id", "id", "copies")
    return points, members


def sharded(points: DataFrame) -> DataFrame:
    """Written table: label, dim, shard, shards (all of the point's), id,
    copies, embedding."""
    sizes = points.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    k = F.least(F.lit(CENTROIDS), F.ceil(F.col("n") / SHARD)).cast("int")
    sizes = written(sizes.withColumn("k", k).withColumn("salts", F.ceil(F.col("n") / ASSIGN_ROWS).cast("int")), "vec-sizes")
    keyed = points.join(sizes, ["label", "dim"])
    sample = top_k_per_group(keyed, ["label", "dim"], [F.xxhash64("id"), F.col("id")], SAMPLE)
    centres = (sample.select("label", "dim", "k", "embedding").groupBy("label", "dim")
               .applyInArrow(_fit, "label long, dim int, centre array<double>"))
    centres = written(centres, "vec-centres")
    spread = (centres.join(sizes, ["label", "dim"])
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select("label", "dim", "salt", "centre"))
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")).select(
        "label", "dim", "salt", "id", "copies", "embedding")
    assigned = (salted.groupBy("label", "dim", "salt").cogroup(spread.orderBy("label", "dim", "salt", "centre")
                                                               .groupBy("label", "dim", "salt"))
                .applyInArrow(_assign, "label long, dim int, id long, copies long, embedding array<float>, shards array<int>"))
    return written(assigned.withColumn("shard", F.explode("shards")), "vec-shards")


def _parts(shards: DataFrame) -> DataFrame:
    """Shards over MAX_SHARD are cut: a row for each pair of parts (x, y) its
    part belongs to."""
    size = shards.groupBy("label", "dim", "shard").agg(F.count(F.lit(1)).alias("n"))
    parts = size.withColumn("parts", F.when(F.col("n") <= MAX_SHARD, 1)
                            .otherwise(F.ceil(F.col("n") * 2 / MAX_SHARD)).cast("int")).drop("n")
    rows = shards.join(parts, ["label", "dim", "shard"])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return (rows.withColumn("x", F.least("part", "other")).withColumn("y", F.greatest("part", "other"))
            .drop("other", "parts"))


TASK = ["label", "dim", "shard", "x", "y"]


def _build(batch: pa.Table) -> pa.Table:
    ids = batch.column("id").to_numpy()
    graph = pruned_graph(_unit(_matrix(batch.column("embedding"))))
    lists = [ids[g[g >= 0]] for g in graph]
    return pa.table({"id": pa.array(ids), "next": pa.array(lists, pa.list_(pa.int64()))})


def _searcher(threshold: float):
    def search(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by("id")
        ids, copies, part = (batch.column(c).to_numpy() for c in ("id", "copies", "part"))
        n = len(ids)
        x = _unit(_matrix(batch.column("embedding")))
        graph = np.zeros((n, n), dtype=bool)
        for i, own in enumerate(batch.column("next")):
            own = np.asarray(own.as_py() or [], dtype=np.int64)
            at = np.minimum(np.searchsorted(ids, own), n - 1)
            graph[i, at[ids[at] == own]] = True
        found = range_search(x, graph, threshold)
        one, other = batch.column("x")[0].as_py(), batch.column("y")[0].as_py()
        if one != other:
            found &= part[:, None] != part[None, :]     # pairs of one part are its own task's
        # count a pair in the first shard that both points are in
        this, shards = batch.column("shard")[0].as_py(), batch.column("shards").to_pylist()
        fresh = found.copy()
        for s in {s for own in shards for s in own if s < this}:
            there = np.array([s in own for own in shards])
            fresh &= ~(there[:, None] & there[None, :])
        links = fresh.astype(np.int64) @ copies
        of = _matrix(batch.column("shards")).astype(np.int64)
        return pa.table({"id": pa.array(ids), "links": pa.array(links), "low": pa.array(local_parts(found, ids)),
                         "asks": _asks(found, of, of)})
    return search


# ---------------------------------------------------------------- beyond a point's own shards

FOUND = "id long, links long, low long, asks array<int>"


def _asks(found: np.ndarray, own: np.ndarray, theirs: np.ndarray) -> pa.Array:
    """Per row of ``found`` (points with the shards ``own``) the shards of the
    linked points that are not its own."""
    names, at = np.unique(theirs, return_inverse=True)
    into = np.zeros((len(theirs), len(names)), dtype=np.float32)
    into[np.arange(len(theirs))[:, None], at.reshape(theirs.shape)] = 1
    asked = found.astype(np.float32) @ into > 0
    for column in own.T:
        asked &= names[None, :] != column[:, None]
    return pa.array([names[row].astype(np.int32) for row in asked], pa.list_(pa.int32()))


def _meeting(threshold: float):
    def meet(batch: pa.Table) -> pa.Table:
        """Visitors of a shard against the points that live there."""
        visits = batch.column("visits").to_numpy()
        guests, hosts = batch.filter(pa.array(visits)), batch.filter(pa.array(~visits))
        if not guests.num_rows or not hosts.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "low": pa.array([], pa.int64()),
                             "asks": pa.array([], pa.list_(pa.int32()))})
        ids, copies, home = ([t.column(c).to_numpy() for t in (guests, hosts)] for c in ("id", "copies", "home"))
        of = [_matrix(t.column("shards")).astype(np.int64) for t in (guests, hosts)]
        found = _unit(_matrix(guests.column("embedding"))) @ _unit(_matrix(hosts.column("embedding"))).T >= threshold
        for one in of[0].T:                             # pairs of one shard have met there
            for other in of[1].T:
                found &= one[:, None] != other[None, :]
        # a host that has visited the guest's home has met it, and of two visits in one round the lower home's counts
        homes, at = np.unique(home[0], return_inverse=True)
        met = np.zeros((len(ids[1]), len(homes)), dtype=bool)
        for i, (before, now) in enumerate(zip(hosts.column("before").to_pylist(), hosts.column("now").to_pylist())):
            met[i] = np.isin(homes, before) | (np.isin(homes, now) & (homes < home[1][i]))
        found &= ~met[:, at].T
        low, none = list(ids), np.iinfo(np.int64).max
        while True:
            new = np.minimum(low[0], np.where(found, low[1][None, :], none).min(axis=1))
            far = np.minimum(low[1], np.where(found, new[:, None], none).min(axis=0))
            if (new == low[0]).all() and (far == low[1]).all():
                break
            low = [new, far]
        out = []
        for side, f in ((0, found), (1, found.T)):
            some = f.any(axis=1)
            f = f[some]
            out.append(pa.table({"id": pa.array(ids[side][some]), "links": pa.array(f.astype(np.int64) @ copies[1 - side]),
                                 "low": pa.array(low[side][some]), "asks": _asks(f, of[side][some], of[1 - side])}))
        return pa.concat_tables(out)
    return meet


def _beyond(shards: DataFrame, first: DataFrame, threshold: float) -> list[DataFrame]:
    """What the points find outside their own shards, a written table a round."""
    homes = shards.where("shard = shards[0]").select("label", "dim", "id", "copies", "embedding", "shards",
                                                     F.col("shard").alias("home"))
    none, rounds = F.array().cast("array<int>"), []
    asked = lambda df: df.select("id", F.explode("asks").alias("t")).groupBy("id").agg(F.collect_set("t").alias("asked"))
    trips = written(asked(first).select("id", none.alias("before"), F.col("asked").alias("now")), "vec-trips")
    while trips.where(F.size("now") > 0).limit(1).count():
        at = homes.join(trips, "id", "left").withColumns({c: F.coalesce(c, none) for c in ("before", "now")})
        guests = at.withColumn("t", F.explode("now")).withColumn("visits", F.lit(True))
        hosts = at.withColumn("t", F.col("home")).withColumn("visits", F.lit(False))
        group = lambda c: F.ceil(F.count(F.lit(1)) / MAX_SHARD).cast("int").alias(c)
        both = (guests.groupBy("label", "dim", "t").agg(group("groups"))
                .join(homes.groupBy("label", "dim", F.col("home").alias("t")).agg(group("cuts")), ["label", "dim", "t"]))
        both = written(both, "vec-visited")

        def dealt(df: DataFrame, own: str, every: str, mine: str, other: str) -> DataFrame:
            df = df.join(both, ["label", "dim", "t"]).withColumn(mine, F.pmod(F.xxhash64("id", F.lit(2)), F.col(own)).cast("int"))
            df = df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(every) - 1)))
            return df.select("label", "dim", "t", "g", "h", "visits", "id", "copies", "home", "shards", "before", "now", "embedding")

        met = dealt(guests, "groups", "cuts", "g", "h").unionByName(dealt(hosts, "cuts", "groups", "h", "g"))
        rounds.append(written(met.groupBy("label", "dim", "t", "g", "h").applyInArrow(_meeting(threshold), FOUND), "vec-met"))
        trips = trips.select("id", F.concat("before", "now").alias("before"))
        trips = trips.join(asked(rounds[-1]), "id", "full_outer").withColumns({c: F.coalesce(c, none) for c in ("before", "asked")})
        trips = written(trips.select("id", "before", F.array_except("asked", "before").alias("now")), "vec-trips")
    return rounds


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding",
                    label: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    points, members = points_and_members(vectors, vec_id, embedding, label)
    shards = sharded(points)
    tasks = written(_parts(shards), "vec-tasks")
    lists = (tasks.select(*TASK, "id", "embedding").groupBy(*TASK).applyInArrow(_build, "id long, next array<long>")
             .groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("next"))).alias("next")))   # bounded lists, united
    found = written(tasks.join(written(lists, "vec-lists"), "id", "left").groupBy(*TASK)
                    .applyInArrow(_searcher(threshold), FOUND), "vec-found")
    for more in _beyond(shards, found, threshold):
        found = found.unionByName(more)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    comp = components(written(found.select(F.col("id").alias("a"), F.col("low").alias("b")).where("a <> b"), "vec-links"))
    grouped = written(links.join(comp, "id", "left").select("id", "links", F.coalesce("component", "id").alias("component")),
                      "vec-grouped")
    names = (grouped.join(points.select("id", "name"), "id").groupBy("component").agg(F.min("name").alias("component_id")))
    named = written(grouped.join(names, "component").select("id", "links", "component_id"), "vec-named")
    usable = members.join(named, "id").select("vec_id", (F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"),
                                              "component_id")
    rest = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<float>").alias("embedding"),
                          F.col(label).cast("long").alias("label"))
    rest = rest.where(~_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = usable.unionByName(rest)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _exact(queries: pa.Table, points: pa.Table, threshold: float) -> pa.Table:
    if not queries.num_rows or not points.num_rows:
        return pa.table({"id": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
    q, x = _unit(_matrix(queries.column("embedding"))), _unit(_matrix(points.column("embedding")))
    copies = points.column("copies").to_numpy()
    links = np.concatenate([(q[i:i + 512] @ x.T >= threshold).astype(np.int64) @ copies for i in range(0, len(q), 512)])
    return pa.table({"id": queries.column("id"), "links": pa.array(links)})


def audit_recall(vectors: DataFrame, result: DataFrame, threshold: float = THRESHOLD, every: int = QUERY_EVERY) -> float:
    """Links found over links there are, for the vectors whose id is divisible
    by ``every`` against all vectors (brute force in blocks)."""
    points, members = points_and_members(vectors)
    sizes = points.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / ASSIGN_ROWS).cast("int").alias("salts"))
    keyed = points.join(sizes, ["label", "dim"])
    asked = members.where((F.col("vec_id") % every == 0) & (F.col("copies") > 0)).select("vec_id", "id")
    queries = (keyed.join(asked.select("id").distinct(), "id")
               .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))))
    blocks = keyed.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    cols = ["label", "dim", "salt", "id", "copies", "embedding"]
    asking, against = (df.select(*cols).toDF(*cols).groupBy("label", "dim", "salt") for df in (queries, blocks))
    exact = (asking.cogroup(against).applyInArrow(lambda a, b: _exact(a, b, threshold), "id long, links long")
             .groupBy("id").agg((F.sum("links") - 1).alias("links")))
    there = asked.join(exact, "id").agg(F.sum("links")).first()[0] or 0
    got = result.where(F.col("vec_id") % every == 0).agg(F.sum("n_links")).first()[0] or 0
    return 1.0 if there == 0 else got / there


def op10(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
