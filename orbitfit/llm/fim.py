"""Fill-in-middle transformation over a piecewise-linear learned rank index.

A text is cut at unit boundaries (a unit is a run of ASCII letters or one other
code point). Boundary number r of n + 1 lies at some code point offset; the
curve rank -> offset is almost straight, so it is indexed by line segments with
a bounded error. A segment starts as a whole text and is halved while the
offsets leave the band of ``ERROR`` code points around its line; what remains
is one signed byte per boundary, the distance from the line. A cut is found by
predicting its offset from its segment and adding the stored byte, which makes
it exact. Texts are indexed many at a time in numpy, in slices of about
``SLICE`` bytes; Spark then cuts, joins and hashes the texts in the JVM.

The draws come from the SHA-256 of ``seed`` and the identifier, so a row's
result does not depend on other rows, on their order or on the partitioning.

Cases: null text counts as empty; a null identifier draws like an empty one;
repeated rows give equal results; a text that is empty or holds a marker stays
as it is (``plain``); texts are never shortened; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR = 127          # residuals fit a signed byte
SHIFT = 20           # slopes are fixed-point numbers with so many binary places
SLICE = 1 << 20      # bytes of text indexed at a time
MARKERS = ("<P>", "<S>", "<M>")


class RankIndex:
    """Offsets of many sequences of boundaries, as error-bounded line segments and residual bytes."""

    def __init__(self, offsets: np.ndarray, starts: np.ndarray, error: int = ERROR):
        """``offsets``: the boundaries of all sequences, each sequence non-decreasing;
        ``starts``: the place of each sequence's first boundary, and the end of the last."""
        self.starts = np.asarray(starts, np.int64)
        self.residual = np.zeros(len(offsets), np.int8)
        lo, hi = self.starts[:-1], self.starts[1:]
        first, base, slope = [], [], []
        while len(lo):
            size = hi - lo
            at, within = ranges(lo, size)
            line = ((offsets[hi - 1] - offsets[lo]) << SHIFT) // np.maximum(size - 1, 1)
            miss = offsets[at] - np.repeat(offsets[lo], size) - (np.repeat(line, size) * within >> SHIFT)
            edge = np.cumsum(size) - size
            top, low = np.maximum.reduceat(miss, edge), np.minimum.reduceat(miss, edge)
            centre = (top + low) >> 1
            fits = top - low <= 2 * error
            rows = np.repeat(fits, size)
            self.residual[at[rows]] = (miss - np.repeat(centre, size))[rows]
            first.append(lo[fits])
            base.append((offsets[lo] + centre)[fits])
            slope.append(line[fits])
            lo, hi = lo[~fits], hi[~fits]
            half = lo + (hi - lo) // 2
            lo, hi = np.concatenate((lo, half)), np.concatenate((half, hi))
        order = np.argsort(np.concatenate(first)) if first else np.empty(0, np.int64)
        self.first, self.base, self.slope = (np.concatenate(c)[order] if c else np.empty(0, np.int64)
                                             for c in (first, base, slope))

    def select(self, sequence: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Exact offset of boundary ``rank`` of each ``sequence``: predicted, then corrected."""
        at = self.starts[sequence] + rank
        segment = np.searchsorted(self.first, at, side="right") - 1
        predicted = self.base[segment] + (self.slope[segment] * (at - self.first[segment]) >> SHIFT)
        return predicted + self.residual[at]


def ranges(lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges ``lo .. lo + size``, and their places within their range."""
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(lo, size) + within, within


def unit_boundaries(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit boundaries of UTF-8 texts that lie end to end in ``data``.

    ``ends`` are the byte offsets of the texts, one more than texts. Returns
    the flat boundary offsets in code points (a text of n units has n + 1) and
    the place of each text's first one.
    """
    head = (data & 0xC0) != 0x80
    letter = ((data | 0x20) - np.uint8(97)) < 26
    opens = head.copy()
    opens[1:] &= ~(letter[1:] & letter[:-1])
    begins = ends[:-1][ends[:-1] < ends[1:]]
    opens[begins] = True
    at = np.flatnonzero(opens)
    chars = np.concatenate(([0], np.cumsum(head)))
    units = np.diff(np.searchsorted(at, ends))
    starts = np.concatenate(([0], np.cumsum(units + 1)))
    text = np.repeat(np.arange(len(units)), units)
    offsets = np.empty(int(starts[-1]), np.int64)
    offsets[np.arange(len(at)) + text] = chars[at] - chars[ends[:-1]][text]
    offsets[starts[1:] - 1] = chars[ends[1:]] - chars[ends[:-1]]
    return offsets, starts


def cuts(texts: pa.Array, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units n of each text, and the code point offsets of boundaries ``one % (n + 1)`` and
    ``two % (n + 1)``, the smaller first."""
    out = np.zeros((3, len(texts)), np.int64)
    if not len(texts):
        return tuple(out)
    wide = pa.types.is_large_string(texts.type)
    _, place, data = texts.buffers()
    place = np.frombuffer(place, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    place = place.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(place, place[a] + SLICE, side="right")) - 1)
        offsets, starts = unit_boundaries(data[place[a]:place[b]], place[a:b + 1] - place[a])
        index = RankIndex(offsets, starts)
        n = np.diff(starts) - 1
        every = np.arange(b - a)
        rank = np.sort(np.stack((one[a:b] % (n + 1), two[a:b] % (n + 1))), axis=0)
        out[:, a:b] = n, index.select(every, rank[0]), index.select(every, rank[1])
        a = b
    return tuple(out)


def _cutter():
    @F.arrow_udf("struct<n: bigint, a: bigint, b: bigint>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, one, two in batches:
            found = cuts(texts, np.asarray(one, np.int64), np.asarray(two, np.int64))
            yield pa.StructArray.from_arrays([pa.array(f) for f in found], ["n", "a", "b"])
    return cut


def draws(key: Column, seed: str) -> list[Column]:
    """The first four 8-digit groups of the hex SHA-256 of seed and key, as longs."""
    h = F.sha2(F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 90,
              spm_percent: int = 20, markers: tuple[str, str, str] = MARKERS, seed: str = "1:") -> DataFrame:
    """Per row: id, n (units), form, prefix_chars, middle_chars (null if plain), output.

    ``percent`` of the texts are cut; of these ``spm_percent`` take the suffix first.
    """
    p, s, m = (F.lit(x) for x in markers)
    key = F.col(f"`{id_col}`")
    one, two, rate, order = draws(key, seed)
    rows = docs.select(key.alias("key"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("t"),
                       one.alias("one"), two.alias("two"), rate.alias("rate"), order.alias("order"))
    rows = rows.withColumn("c", _cutter()("t", "one", "two"))
    marked = F.contains("t", p) | F.contains("t", s) | F.contains("t", m)
    form = (F.when((F.col("t") == "") | marked | (F.col("rate") % 100 >= percent), "plain")
            .when(F.col("order") % 100 < spm_percent, "spm").otherwise("psm"))
    rows = rows.select("key", "t", "c", form.alias("form"))
    a, b = F.col("c.a").cast("int"), F.col("c.b").cast("int")
    prefix, middle = F.substring("t", F.lit(1), a), F.substring("t", a + 1, b - a)
    suffix = F.substring("t", b + 1, F.length("t"))
    output = (F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
              .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.col("t")))
    cut = F.col("form") != "plain"
    return rows.select(F.col("key").alias(id_col), F.col("c.n").alias("n"), "form",
                       F.when(cut, F.col("c.a")).alias("prefix_chars"),
                       F.when(cut, F.col("c.b") - F.col("c.a")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that was transformed. Each marker stands once in a cut text, so the parts are certain."""
    p, s, m = (F.lit(x) for x in markers)
    middle = F.split_part(output, m, F.lit(2))
    rest = F.split_part(output, m, F.lit(1))
    psm = F.substring(rest, F.length(p) + 1, F.length(rest))
    spm = F.substring(rest, F.length(s) + 1, F.length(rest))
    return (F.when(form == "psm", F.concat(F.split_part(psm, s, F.lit(1)), middle, F.split_part(psm, s, F.lit(2))))
            .when(form == "spm", F.concat(F.split_part(spm, p, F.lit(2)), middle, F.split_part(spm, p, F.lit(1))))
            .otherwise(output))
