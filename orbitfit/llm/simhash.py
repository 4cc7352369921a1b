"""SimHash near-dedup through a segment-popcount embedding.

A fingerprint has 64 bits; bit i is set if over half of the document's
shingle hashes have it. The fingerprint is cut into 32 segments of two bits,
and the bit count of every segment gives a point in {0, 1, 2}^32. Moving one
bit moves one coordinate by one, so the Manhattan distance of two points is a
lower bound of their Hamming distance, and the join of all fingerprints
within ``distance`` bits is a range join of points under the Manhattan
distance followed by an exact check.

The grid for the range join: the 32 coordinates are dealt into ``distance + 3``
blocks. Two points within Manhattan distance ``distance`` agree on at least
three blocks, as every other block holds at least one of the differences.
Each fingerprint is therefore placed in one grid cell for each choice of three
blocks, keyed by its coordinates there, and every qualifying pair meets in at
least one cell. Inside a cell the whole points are compared first and the
fingerprints last.

Only distinct fingerprints enter the grid. A cell returns links that connect
what its pairs connect, not its pairs: a fingerprint linked already is not
compared again with its own component, so a cell of n near copies costs about
n comparisons and n links. A cell of over ``cell_limit`` fingerprints is cut
into chunks and every pair of chunks is a task of its own, so no task holds an
unbounded cell and no pair is lost.

Cases: null and empty texts (and texts of white space only) have fingerprint
0, which links like any other; a text of fewer words than a shingle is one
shingle; texts of any length are hashed whole; repeated rows are in one
component; a null identifier is returned and is never the smallest unless
all are null; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitfit.llm.base import fresh, written
from orbitfit.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
CELL_LIMIT = 20_000   # fingerprints a task holds of one cell
PAIRWISE = 16         # cells up to this size are compared in one vectorised pass
LOW = np.uint64(0x5555555555555555)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest

    # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1).tolist()
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1:] if len(words) >= shingle else [ends[-1]]
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, last)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 4096):
        bits = np.unpackbits(hashes[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE,
                 hashes: bool = False) -> DataFrame:
    """(id, fp) with fp as a signed long holding the 64 bits; with ``hashes`` also text_hash."""
    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], np.uint64).view(np.int64))

    return docs.select(F.col(id_col).alias("id"), fp(F.col(text_col)).alias("fp"),
                       *([F.xxhash64(F.col(text_col)).alias("text_hash")] if hashes else []))


def popcounts(fps: np.ndarray) -> np.ndarray:
    """Segment counts of uint64 fingerprints, two bits each, as packed two-bit digits."""
    return (fps & LOW) + ((fps >> np.uint64(1)) & LOW)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of packed segment counts (digits 0, 1, 2)."""
    # Unary code of the digits (0, 1, 3): the differing bits are the distance.
    one, two = np.uint64(1), LOW
    ua = ((a | (a >> one)) & two) | (a & ~two)
    ub = ((b | (b >> one)) & two) | (b & ~two)
    return np.bitwise_count(ua ^ ub)


def block_masks(distance: int) -> list[int]:
    """Masks of the packed digits of each choice of three blocks out of ``distance + 3``."""
    blocks = [0] * (distance + 3)
    for s in range(32):
        blocks[s % len(blocks)] |= 3 << (2 * s)
    return [a | b | c for a, b, c in combinations(blocks, 3)]


def cells_of(distance: int):
    masks = np.array(block_masks(distance), np.uint64)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.asarray(batch.column(0)).astype(np.int64).view(np.uint64)
            for i in range(0, len(fps), 20_000):
                part = fps[i:i + 20_000]
                keys = popcounts(part)[:, None] & masks[None, :]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.tile(np.arange(len(masks), dtype=np.int16), len(part))),
                    pa.array(keys.ravel().view(np.int64)),
                    pa.array(np.repeat(part, len(masks)).view(np.int64))], ["choice", "cell", "fp"])
    return cells


def close(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs of fingerprints differ in at most ``distance`` bits, the bound first."""
    near = manhattan(popcounts(a), popcounts(b)) <= distance
    near[near] = np.bitwise_count(np.broadcast_to(a, near.shape)[near] ^ b[near]) <= distance
    return near


def spanning(left: np.ndarray, right: np.ndarray | None, distance: int) -> list[tuple[int, int]]:
    """Links that connect what the qualifying pairs of a cell connect.

    ``right`` None: pairs inside ``left``; else pairs between the two chunks.
    Grows one component at a time; what it has reached is out of the search.
    """
    sides = [left, left if right is None else right]
    rest = [np.ones(len(s), bool) for s in sides]
    if right is None:
        rest[1] = rest[0]
    links = []
    for first in range(len(left)):
        if not rest[0][first]:
            continue
        rest[0][first] = False
        front = [(0, first)]
        while front:
            side, i = front.pop()
            other = 1 - side if right is not None else 0
            open_ = np.flatnonzero(rest[other])
            if not len(open_):
                continue
            hit = open_[close(sides[side][i], sides[other][open_], distance)]
            rest[other][hit] = False
            links += [(sides[side][i], x) for x in sides[other][hit]]
            front += [(other, j) for j in hit.tolist()]
    return links


def cell_links(distance: int):
    """Arrow function over rows sorted by cell (choice, cell, left chunk, right chunk)."""
    def out(pairs_a, pairs_b):
        a, b = np.asarray(pairs_a, np.uint64), np.asarray(pairs_b, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def solve(key: np.ndarray, fp: np.ndarray, side: np.ndarray):
        starts = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
        size = np.diff(np.concatenate((starts, [len(fp)])))
        # Small uncut cells: compare rows d apart, all cells at once.
        small = np.repeat(size <= PAIRWISE, size) & (side < 0)
        group = np.repeat(np.arange(len(size)), size)
        for d in range(1, min(PAIRWISE, int(size.max(initial=0)))):
            i = np.flatnonzero((group[d:] == group[:-d]) & small[d:])
            if len(i):
                i = i[close(fp[i], fp[i + d], distance)]
                yield out(fp[i], fp[i + d])
        for g in np.flatnonzero((size > PAIRWISE) | ~small[starts]):
            rows = slice(starts[g], starts[g] + size[g])
            s = side[rows]
            parts = (fp[rows], None) if s[0] < 0 else (fp[rows][s == 0], fp[rows][s == 1])
            if parts[1] is not None and not len(parts[1]):
                continue
            found = spanning(*parts, distance)
            if found:
                yield out([x for x, _ in found], [x for _, x in found])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = np.empty((0, 4), np.int64)
        fp, side = np.empty(0, np.uint64), np.empty(0, np.int8)
        for batch in batches:
            c = [np.asarray(x).astype(np.int64) for x in batch.columns]
            key = np.concatenate((key, np.stack(c[:4], axis=1)))
            fp = np.concatenate((fp, c[4].view(np.uint64)))
            side = np.concatenate((side, c[5].astype(np.int8)))
            # The last cell may go on in the next batch.
            tail = np.flatnonzero((key != key[-1]).any(axis=1)) if len(key) else []
            cut = int(tail[-1]) + 1 if len(tail) else 0
            if cut:
                yield from solve(key[:cut], fp[:cut], side[:cut])
                key, fp, side = key[cut:], fp[cut:], side[cut:]
        if len(key):
            yield from solve(key, fp, side)
    return links


def near_links(distinct: DataFrame, distance: int = DISTANCE, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, distinct) within ``distance`` bits."""
    placed = distinct.select("fp").mapInArrow(cells_of(distance), "choice short, cell long, fp long")
    # Only cells with company are kept; large ones get chunks.
    counts = placed.groupBy("choice", "cell").agg(F.count("*").alias("n"))
    crowded = written(counts.filter(F.col("n") > cell_limit), "crowded")
    if crowded.isEmpty():
        keyed = placed.select("choice", "cell", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp",
                              F.lit(-1).alias("side"))
    else:
        chunks = F.ceil(F.col("n") / cell_limit)
        mine = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.coalesce(chunks, F.lit(1))).cast("int")
        cut = placed.join(crowded, ["choice", "cell"], "left").withColumn("mine", mine)
        other = F.explode(F.sequence(F.lit(0), (F.coalesce(chunks, F.lit(1)) - 1).cast("int")))
        keyed = cut.withColumn("with", other).select(
            "choice", "cell", F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j"), "fp",
            F.when(F.col("mine") == F.col("with"), -1)
            .otherwise((F.col("mine") > F.col("with")).cast("int")).alias("side"))
    key = ["choice", "cell", "i", "j"]
    return (keyed.repartition(*key).sortWithinPartitions(*key)
            .mapInArrow(cell_links(distance), "a long, b long"))


def classed(docs: DataFrame, id_col: str, text_col: str, shingle: int, distance: int, cell_limit: int,
            hashes: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows (see ``fingerprints``) and one row per distinct fingerprint: fp, first (its smallest id), component.

    ``component`` (none, first, fp) is the smallest label the fingerprint reaches, its own if it has no link.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle, hashes), "fingerprints")
    # A fingerprint's label is its smallest id; the fingerprint itself keeps labels apart when ids repeat.
    classes = written(rows.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    label = F.struct(F.col("first").isNull().alias("none"), "first", "fp")
    found = components(near_links(classes, distance, cell_limit),
                       classes.select(F.col("fp").alias("node"), label.alias("label")))
    return rows, classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("component", label).alias("component"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               distance: int = DISTANCE, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """Per row: id, fp (signed long), fingerprint (16 hex digits), component_id."""
    rows, classes = classed(docs, id_col, text_col, shingle, distance, cell_limit)
    labels = classes.select("fp", F.col("component.first").alias("component_id"))
    return rows.join(labels, "fp").select(
        F.col("id").alias(id_col), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             distance: int = DISTANCE) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    A null identifier stays only where its whole component has none. Of rows
    that share the identifier the smallest fingerprint, then text hash, stays,
    so rows without an identifier, or with one used twice, are told apart.
    """
    rows, classes = classed(docs, id_col, text_col, shingle, distance, CELL_LIMIT, hashes=True)
    heads = classes.filter(F.col("component.fp") == F.col("fp")).select("fp", "first")
    text, own, hashed = fresh(docs, "__text", "__id", "__hash")
    kept = (rows.join(heads, "fp").filter(F.col("id").eqNullSafe(F.col("first")))
            .groupBy("fp", F.col("id").alias(own)).agg(F.min("text_hash").alias(hashed)).drop("fp"))
    marked = docs.withColumn(text, F.xxhash64(F.col(text_col)))
    joined = marked.join(kept, (F.col(text) == F.col(hashed)) & F.col(id_col).eqNullSafe(F.col(own)), "left_semi")
    return joined.dropDuplicates([id_col, text]).select(*[F.col(f"`{c}`") for c in docs.columns])
