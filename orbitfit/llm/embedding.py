"""Embedding near-dedup with an inverted multi-index.

Unit vectors are cut into two halves, and each half gets a codebook of its own
(k-means on a bounded sample of ``MAX_FIT`` vectors). A pair of codewords is a
cell of the product grid; every vector is indexed in its nearest cell and
visits its nearest cells in multi-sequence order (smallest sum of the two
squared distances first). How many cells it visits is set by measurement:
``PROBES`` sampled vectors are compared with all vectors in blocks, the place
of each true partner's cell in the sequence is noted, and so is that of
``DRAWN`` partners of each probe drawn exactly at the cosine, as true pairs may
be few or absent in a sample. The number of cells is the smallest that reaches
``RECALL`` of either kind, on the mean over the probes. A visited vector is then verified by its cosine in
double precision.

Equal vectors are one class and are compared once. A cell returns per class
the number of linked vectors, and links that connect what its pairs connect,
not its pairs. A pair counts at both ends exactly once: at the visitor, and at
the visited one only if it does not visit the visitor's cell itself. A cell of
many residents or visitors is cut into chunks (``RESIDENTS``, ``VISITORS``)
and every pair of chunks is a task's group of its own; a task holds one chunk
of residents and streams the visitors past it.

Cases: a vector that is null, empty, zero, or holds a null or a non-finite
component links with nothing and stays; vectors of different lengths never
link; repeated rows count as each other's links; a null identifier is returned
and is nobody's component; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbitfit.llm.base import bounded_sample, written
from orbitfit.llm.components import components

COSINE = 0.95
RECALL = 0.98
MAX_FIT = 20_000      # vectors the codebooks are fitted on
PROBES = 400          # vectors whose partners are searched by brute force
DRAWN = 20            # partners drawn at the cosine for each of them
CODES = 256           # codewords per half, at most
PER_CELL = 16         # vectors a cell holds on average, while the codebooks may grow
RESIDENTS = 2048
VISITORS = 32_768


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision."""
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a binary column of float64 values."""
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def codebook(x: np.ndarray, k: int, steps: int = 8) -> np.ndarray:
    """k-means centres of the rows of ``x`` (seeded draw of distinct rows)."""
    rng = np.random.default_rng(11)
    distinct = np.unique(x, axis=0)
    c = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(steps):
        near = distances(x, c).argmin(axis=1)
        n = np.bincount(near, minlength=len(c))
        order = np.argsort(near, kind="stable")
        used = np.flatnonzero(n)
        if x.shape[1]:
            c[used] = np.add.reduceat(x[order], np.concatenate(([0], np.cumsum(n[used])[:-1])), axis=0) / n[used, None]
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)[None, :]


class Grid:
    """Two codebooks and the cells of their product."""

    def __init__(self, sample: np.ndarray, k: int):
        self.half = sample.shape[1] // 2
        self.left = codebook(sample[:, :self.half], k)
        self.right = codebook(sample[:, self.half:], k)

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return distances(x[:, :self.half], self.left), distances(x[:, self.half:], self.right)

    def sequence(self, x: np.ndarray, visits: int) -> np.ndarray:
        """(rows, visits) cells in multi-sequence order; -1 where the grid has no more."""
        one, two = self.halves(x)
        a, b = np.argsort(one, axis=1, kind="stable")[:, :visits], np.argsort(two, axis=1, kind="stable")[:, :visits]
        # The visits nearest cells lie under the hyperbola (i + 1)(j + 1) <= visits of the sorted halves.
        ij = [(i, j) for i in range(a.shape[1]) for j in range(b.shape[1]) if (i + 1) * (j + 1) <= visits]
        i, j = np.array(ij).T
        total = np.take_along_axis(one, a, 1)[:, i] + np.take_along_axis(two, b, 1)[:, j]
        order = np.argsort(total, axis=1, kind="stable")[:, :visits]
        cell = a[:, i].astype(np.int64) * len(self.right) + b[:, j]
        cell = np.take_along_axis(cell, order, 1)
        return np.pad(cell, ((0, 0), (0, visits - cell.shape[1])), constant_values=-1)

    def rank(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """How many cells come before ``cell[i]`` in the sequence of ``x[i]``."""
        one, two = self.halves(x)
        rows = np.arange(len(x))
        own = one[rows, cell // len(self.right)] + two[rows, cell % len(self.right)]
        two = np.sort(two, axis=1)
        return np.array([np.searchsorted(two[r], own[r] - one[r] - 1e-12).sum() for r in rows], np.int64)

    def home(self, x: np.ndarray) -> np.ndarray:
        return self.sequence(x, 1)[:, 0]


def threshold_partners(x: np.ndarray, cosine: float, each: int) -> np.ndarray:
    """``each`` unit vectors per row of ``x``, exactly at the cosine, in seeded directions (row by row)."""
    x = np.repeat(x, each, axis=0)
    u = np.random.default_rng(5).normal(size=x.shape)
    u -= (u * x).sum(axis=1, keepdims=True) * x
    size = np.sqrt((u * u).sum(axis=1, keepdims=True))
    # In one dimension nothing is at right angles to a vector.
    u = np.divide(u, size, out=np.zeros_like(u), where=size > 1e-9)
    return cosine * x + np.sqrt(max(0.0, 1 - cosine * cosine)) * u


def reached(weight: dict[int, float], recall: float) -> tuple[int, float]:
    """Cells to visit for the recall, and the recall there, of the weight found at each rank."""
    ranks = sorted(weight)
    share = np.cumsum([weight[r] for r in ranks]) / sum(weight.values())
    at = min(len(ranks) - 1, int(np.searchsorted(share, recall - 1e-12)))
    return ranks[at] + 1, min(1.0, float(share[at]))


def visits_needed(classes: DataFrame, grid: Grid, dim: int, cosine: float, recall: float) -> tuple[int, float | None, float]:
    """Cells to visit for the recall; the recall there of the probes' true partners (None without any) and of drawn ones."""
    sample = bounded_sample(classes, F.col("cid"), PROBES).select("cid", "v").collect()
    own = np.array([r["cid"] for r in sample])
    probes = matrix(pa.array([bytes(r["v"]) for r in sample]), dim)
    most = len(grid.left) * len(grid.right)
    home = grid.home(probes)

    def ranked(x: np.ndarray, row: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """``grid.rank`` of each (row of x, cell), once per distinct one and in pieces."""
        pair, back = np.unique(row * most + cell, return_inverse=True)
        parts = [pair[a:a + 4096] for a in range(0, len(pair), 4096)]
        return np.concatenate([grid.rank(x[p // most], p % most) for p in parts])[back]

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 2048):
                x, cid = matrix(batch.column(0).slice(s, 2048), dim), batch.column(1).slice(s, 2048).to_numpy()
                # Every partner of a probe counts; a probe is not its own.
                i, j = np.nonzero((x @ probes.T >= cosine) & (cid[:, None] != own[None, :]))
                if not len(i):
                    continue
                rows, at = np.unique(i, return_inverse=True)
                both = ranked(probes, j, grid.home(x[rows])[at])
                away = np.flatnonzero(both)   # the others lie in the probe's own cell
                if len(away):
                    both[away] = np.minimum(both[away], ranked(x, i[away], home[j[away]]))
                pair, n = np.unique(j * most + np.minimum(both, most - 1), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair // most), pa.array(pair % most), pa.array(n)], ["probe", "rank", "n"])

    # Each probe with a partner weighs the same, however many it has.
    each = classes.select("v", "cid").mapInArrow(ranks, "probe long, rank long, n long").groupBy("probe", "rank").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("probe"))
    got = (each.select("rank", share.alias("n")).groupBy("rank").agg(F.sum("n"))
           .orderBy("rank").collect())   # at most one row per cell of the grid
    # Few probes, or none, may have a partner: partners drawn at the cosine itself stand for pairs the sample lacks.
    drawn: dict[int, float] = {}
    for s in range(0, len(probes), 50):
        x = np.repeat(probes[s:s + 50], DRAWN, axis=0)
        y = threshold_partners(probes[s:s + 50], cosine, DRAWN)
        both = np.minimum(grid.rank(y, np.repeat(home[s:s + 50], DRAWN)), grid.rank(x, grid.home(y)))
        for r, n in zip(*np.unique(np.minimum(both, most - 1), return_counts=True)):
            drawn[int(r)] = drawn.get(int(r), 0) + int(n)
    true = {r[0]: r[1] for r in got}
    visits = max(reached(w, recall)[0] for w in (true, drawn) if w)
    found, synthetic = (sum(n for r, n in w.items() if r < visits) / sum(w.values()) if w else None for w in (true, drawn))
    return visits, found, synthetic


def placements(grid: Grid, dim: int, visits: int):
    """Arrow function (cid, copies, v) -> a row per visited cell; the first visit is home."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 1024):
                part = batch.slice(s, 1024)
                seq = grid.sequence(matrix(part.column(2), dim), visits)
                row, k = np.nonzero(seq >= 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array(seq[row, k]), pa.array(k == 0), pa.array(seq[row, 0]),
                    part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                    part.column(2).take(pa.array(row)),
                    # Only a resident needs its own visits, to know which pairs come back to it.
                    pa.array([r.tobytes() if h else None for r, h in zip(seq[row], k == 0)], pa.binary())],
                    ["cell", "resident", "home", "cid", "copies", "v", "visits"])
    return place


def matches(dim: int, visits: int, cosine: float):
    """Arrow function over rows sorted by group, residents first -> credits and links."""
    class Chunk:
        def __init__(self, key):
            self.key, self.parts = key, []

        def close(self):
            """Residents are complete: cid, copies, unit vectors, visits, component labels."""
            if self.parts is not None:
                p = self.parts
                self.cid = np.concatenate([a for a, *_ in p]) if p else np.empty(0, np.int64)
                self.copies = np.concatenate([a for _, a, *_ in p]) if p else np.empty(0, np.int64)
                self.x = np.concatenate([a for *_, a, _ in p]) if p else np.empty((0, dim))
                self.visits = np.concatenate([a for *_, a in p]) if p else np.empty((0, visits), np.int64)
                self.label, self.parts = np.arange(len(self.cid)), None

        def visit(self, cid, copies, home, x):
            """(class, linked vectors) credits and (a, b) links of a block of visitors."""
            self.close()
            hit = (x @ self.x.T >= cosine) & (cid[:, None] != self.cid[None, :])
            i, j = np.nonzero(hit)
            if not len(i):
                return None
            credit = [(cid, (hit * self.copies[None, :]).sum(axis=1))]
            alone = ~(self.visits[j] == home[i][:, None]).any(axis=1)
            credit.append((self.cid, np.bincount(j[alone], copies[i[alone]], len(self.cid)).astype(np.int64)))
            links = []
            for r in np.unique(i):
                near = np.flatnonzero(hit[r])
                groups, first = np.unique(self.label[near], return_index=True)
                links += [(cid[r], self.cid[near[f]]) for f in first]
                if len(groups) > 1:
                    self.label[np.isin(self.label, groups)] = groups[0]
            a, n = np.concatenate([c for c, _ in credit]), np.concatenate([m for _, m in credit])
            keep = n > 0
            return a[keep], n[keep], np.array(links, np.int64).reshape(-1, 2)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(None)
        for batch in batches:
            cell, i, j, resident, home, cid, copies = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(7))
            x = matrix(batch.column(7), dim)
            key = np.stack([cell, i, j], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1) | (resident[1:] != resident[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(key)]):
                if b == a:
                    continue
                if chunk.key != tuple(key[a]):
                    chunk = Chunk(tuple(key[a]))
                if resident[a]:
                    own = np.frombuffer(b"".join(batch.column(8).slice(a, b - a).to_pylist()), np.int64)
                    chunk.parts.append((cid[a:b], copies[a:b], x[a:b], own.reshape(-1, visits)))
                    continue
                for s in range(a, b, 512):
                    e = min(b, s + 512)
                    got = chunk.visit(cid[s:e], copies[s:e], home[s:e], x[s:e])
                    if got:
                        c, n, links = got
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.concatenate((c, links[:, 0]))),
                            pa.array(np.concatenate((n, np.zeros(len(links), np.int64)))),
                            pa.array(np.concatenate((np.full(len(c), -1), links[:, 1])))], ["cid", "n", "other"])
    return match


def search(classes: DataFrame, dim: int, cosine: float = COSINE, recall: float = RECALL,
           residents: int = RESIDENTS, visitors: int = VISITORS) -> tuple[DataFrame, dict]:
    """(cid, n, other): credits (other -1) and links (n 0) between classes; and what was measured."""
    rows = classes.count()
    sample = bounded_sample(classes, F.col("cid"), MAX_FIT).select("v").collect()
    sample = matrix(pa.array(sorted(bytes(r["v"]) for r in sample)), dim)
    k = max(1, min(CODES, int(np.ceil(np.sqrt(rows / PER_CELL)))))
    grid = Grid(sample, k)
    visits, measured, drawn = visits_needed(classes, grid, dim, cosine, recall)
    placed = written(classes.select("cid", "copies", "v").mapInArrow(
        placements(grid, dim, visits),
        "cell long, resident boolean, home long, cid long, copies long, v binary, visits binary"), "placed")
    # One row per used cell, at most CODES * CODES: a bounded broadcast.
    counts = placed.groupBy("cell").agg(
        F.ceil(F.sum(F.col("resident").cast("int")) / residents).cast("int").alias("many"),
        F.ceil(F.count("*") / visitors).cast("int").alias("rounds")).filter("many > 0")
    # A resident also visits its own cell.
    sized = placed.join(F.broadcast(counts), "cell")
    chunk = F.pmod(F.xxhash64("cid", F.lit("resident")), F.col("many")).cast("int")
    part = F.pmod(F.xxhash64("cid", F.lit("visitor")), F.col("rounds")).cast("int")
    columns = ["cell", "i", "j", "resident", "home", "cid", "copies", "v", "visits"]
    living = (sized.filter("resident").withColumn("i", chunk)
              .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1))))
    visiting = (sized.withColumn("resident", F.lit(False)).withColumn("visits", F.lit(None).cast("binary"))
                .withColumn("j", part).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("many") - 1))))
    grouped = (living.select(*columns).unionByName(visiting.select(*columns))
               .repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", F.desc("resident"), "cid"))
    found = grouped.mapInArrow(matches(dim, visits, cosine), "cid long, n long, other long")
    return found, {"rows": rows, "codes": k, "visits": visits, "recall": measured, "drawn_recall": drawn}


def vector_classes(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows: id, key) and (classes: key, cid, first, copies, dim, v); key is null for what links with nothing."""
    key = F.col(vec_col).cast("array<double>")
    sound = (F.col(vec_col).isNotNull() & F.forall(key, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
             & F.exists(key, lambda x: x != 0))
    rows = vectors.select(F.col(id_col).alias("id"), F.when(sound, key).alias("key"))
    grouped = rows.filter("key is not null").groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("copies"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0)
            v = [unit(np.array([x]))[0].tobytes() for x in values.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(b) // 8 for b in v], pa.int32()),
                                              pa.array(v, pa.binary())], ["key", "first", "copies", "dim", "v"])

    kind = dict(vectors.dtypes)[id_col]
    classes = written(grouped.mapInArrow(packed, f"key array<double>, first {kind}, copies long, dim int, v binary")
                      .withColumn("cid", F.monotonically_increasing_id()), "classes")
    return rows, classes


def near_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE,
               recall: float = RECALL, residents: int = RESIDENTS, visitors: int = VISITORS,
               measured: list | None = None) -> DataFrame:
    """Per row: id, n_links, component_id, kept. ``measured`` receives the figures of each index."""
    rows, classes = vector_classes(vectors, id_col, vec_col)
    found = None
    for (dim,) in sorted(classes.select("dim").distinct().collect()):   # the lengths that occur
        one, figures = search(classes.filter(F.col("dim") == dim), dim, cosine, recall, residents, visitors)
        if measured is not None:
            measured.append(figures)
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = classes.select("cid", F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("other"))
    found = written(found, "found")
    credits = found.filter("other < 0").groupBy("cid").agg(F.sum("n").alias("n"))
    label = F.struct(F.col("first").isNull().alias("none"), "first", "cid")
    linked = components(found.filter("other >= 0").select(F.col("cid").alias("a"), F.col("other").alias("b")),
                        classes.select(F.col("cid").alias("node"), label.alias("label")))
    result = (classes.join(credits, "cid", "left").join(linked.withColumnRenamed("node", "cid"), "cid", "left")
              .select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce(F.col("component.first"), F.col("first")).alias("component_id")))
    joined = (rows.filter("key is not null").join(result, "key").select("id", "n_links", "component_id")
              .unionByName(rows.filter("key is null").select("id", F.lit(0).cast("long").alias("n_links"),
                                                             F.col("id").alias("component_id"))))
    return joined.select(F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id",
                         F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
