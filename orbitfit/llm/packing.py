"""Packing by vector bin packing: tokens, segments and loss-bearing tokens at once.

Examples (token ids, the first ``prompt`` of them without loss) are placed into
sequences that each hold at most ``tokens`` ids, ``segments`` pieces and
``loss`` ids that bear loss. A sequence is filled by the dot-product heuristic:
of the waiting examples that fit what is left in every dimension, it takes the
one whose demand vector has the largest inner product with the vector of what
is left, each dimension in shares of its limit and weighted by the mean demand
of the waiting examples. Once none fits whole, the best head piece that fits is
cut off and its rest goes on waiting, so a sequence ends short of ids only where
another limit is used up. A head that fills an empty sequence alone (a long
text) is placed at once.

Every map task packs the examples of its own partition from a pool of ``POOL``
waiting ones: no row crosses the network, no group of rows is gathered, and a
task that is repeated on another executor gives the same sequences. Sequence ids
hold the partition in their high bits. The last sequence of a task, which
nothing is left to fill, is cut at powers of two, lengths that need no padding.

Ids come from the vocabulary and merges of a byte-level BPE file. Its merges
run in the order of their ids, so a rank-based encoder of the same pattern
gives the same ids (compared over all code points) four times as fast; files
whose merges do not, and texts that the encoder refuses, go through the file's
own library.

Cases: null text and null prompt count as empty, such an example is its closing
id alone; a null identifier is kept; repeated rows are examples of their own;
a text of any length is cut, never shortened; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import json
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENS = 1024
SEGMENTS = 64
POOL = 512           # waiting examples of a task
OUT_ROWS = 4096      # pieces in a batch of results
MODEL = public_tokenizers.path("byte_bpe_50k.json")


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold."""
    tokens: int = TOKENS
    segments: int = SEGMENTS
    loss: int = TOKENS

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("every limit must be at least 1")


class Ids:
    """Token ids of texts by a byte-level BPE file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.own = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.fast = rank_encoder(json.load(f))

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:   # its pattern gave up, as on millions of line feeds
                pass
        return np.array(self.own.encode(text, add_special_tokens=False).ids, np.uint32)


def rank_encoder(spec: dict):
    """A rank-based encoder with the ids of the file, or None where it would not give them."""
    import tiktoken
    model, pre, added = spec["model"], spec["pre_tokenizer"] or {}, spec["added_tokens"]
    plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space") and spec["normalizer"] is None and not model.get("ignore_merges")
             and not any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in added))
    if not plain:
        return None
    vocab, pairs = model["vocab"], [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    made = [vocab[a + b] for a, b in pairs]
    if made != sorted(made) or len(vocab) != 256 + len(set(made)):
        return None
    # Byte-level files write printable bytes as themselves and the others as the code points from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*shown}))}
    ranks = {bytes(byte[c] for c in word): i for word, i in vocab.items()}
    return tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={a["content"]: a["id"] for a in added})


def worker_ids(path: str) -> Ids:
    """One encoder per worker process and file."""
    kept = sys.modules.setdefault("_orbitfit_ids", types.ModuleType("_orbitfit_ids"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.ids = path, Ids(path)
    return kept.ids


class Packer:
    """Places examples into sequences. ``place`` takes the next one and ``finish`` the rest; both
    yield (example, start, length, sequence, offset, loss-bearing ids), an example when it is cut or placed."""

    def __init__(self, limits: Limits, pool: int = POOL):
        self.limits = limits
        self.full = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
        self.examples: list = [None] * pool
        self.start = np.zeros(pool, np.int64)    # ids already placed
        self.left = np.zeros(pool, np.int64)     # ids still waiting; 0: a free slot
        self.bare = np.zeros(pool, np.int64)     # of these the first ones, without loss
        self.sequence = -1

    def place(self, example, size: int, prompt: int):
        start, left, bare = 0, size, min(prompt, size)
        while left >= self.limits.tokens and self.limits.tokens - min(bare, self.limits.tokens) <= self.limits.loss:
            self.sequence += 1
            n = self.limits.tokens
            yield example, start, n, self.sequence, 0, n - min(bare, n)
            start, left, bare = start + n, left - n, max(0, bare - n)
        if left:
            k = int((self.left == 0).argmax())
            self.examples[k], self.start[k], self.left[k], self.bare[k] = example, start, left, bare
            while self.left.all():
                yield from self.fill()

    def waiting(self, example) -> int:
        """How many ids of an example that still waits are placed."""
        return int(self.start[self.examples.index(example)])

    def finish(self):
        while self.left.any():
            rows = list(self.fill())
            size = sum(r[2] for r in rows)
            if not self.left.any() and size & (size - 1):
                rows = cut_at_powers(rows, size)
                self.sequence = rows[-1][3]
            yield from rows

    def fill(self):
        """One sequence from the waiting examples."""
        self.sequence += 1
        tokens, segments, loss = self.limits.tokens, self.limits.segments, self.limits.loss
        waiting = self.left > 0
        demand = np.array([self.left[waiting].mean(), 1.0, (self.left - self.bare)[waiting].mean()])
        weight = demand / self.full ** 3   # mean demand, demand and what is left, each in shares of the limit
        offset = 0
        while tokens and segments:
            whole = (self.left > 0) & (self.left <= tokens) & (self.left - self.bare <= loss)
            if whole.any():
                head = self.left
            else:
                head = np.minimum(np.minimum(self.left, tokens), self.bare + loss)
                whole = head > 0
                if not whole.any():
                    break
            bearing = np.maximum(head - self.bare, 0)
            near = (weight[0] * tokens) * head + (weight[2] * loss) * bearing + weight[1] * segments
            k = int(np.where(whole, near, -1.0).argmax())
            n, bears = int(head[k]), int(bearing[k])
            yield self.examples[k], int(self.start[k]), n, self.sequence, offset, bears
            self.start[k] += n
            self.left[k] -= n
            self.bare[k] = max(0, self.bare[k] - n)
            if not self.left[k]:
                self.examples[k] = None
            offset += n
            tokens, segments, loss = tokens - n, segments - 1, loss - bears


def cut_at_powers(rows: list[tuple], size: int) -> list[tuple]:
    """One sequence of ``size`` ids as sequences of the powers of two that make up ``size``, largest first."""
    sequence, room, offset, out = rows[0][3], 1 << size.bit_length() - 1, 0, []
    for example, start, length, _, _, bears in rows:
        while length:
            n = min(length, room - offset)
            bare = min(n, length - bears)   # ids without loss come first in an example
            out.append((example, start, n, sequence, offset, n - bare))
            start, length, bears, offset = start + n, length - n, bears - (n - bare), offset + n
            if offset == room:
                size -= room
                sequence, room, offset = sequence + 1, 1 << max(size.bit_length() - 1, 0), 0
    return out


def pack(examples: DataFrame, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
         limits: Limits = Limits(), closing: int = 0, model: str = MODEL) -> DataFrame:
    """Per piece: id, start, length, ids, doc_tokens, sequence_id, offset, loss_tokens.

    An example's ids are those of its prompt (without loss), of its text and the id ``closing``;
    ``ids`` holds those of the piece as little-endian unsigned 32-bit numbers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = worker_ids(model), Packer(limits)
        base = TaskContext.get().partitionId() << 33
        held: dict[int, tuple] = {}   # key, ids not yet placed and the number of those before them, all ids
        out: list[tuple] = []

        def take(placed) -> None:
            for example, start, length, sequence, offset, bears in placed:
                key, ids, before, total = held[example]
                own = ids[start - before:start - before + length]
                out.append((key, start, length, own.tobytes(), total, base + sequence, offset, bears))
                if start + length == total:
                    del held[example]

        number = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for key, text, prompt in zip(*(c.to_pylist() for c in part.columns)):
                    bare = encode(prompt) if prompt else np.empty(0, np.uint32)
                    ids = np.concatenate((bare, encode(text or ""), [closing])).astype("<u4")
                    held[number] = key, ids, 0, len(ids)
                    take(packer.place(number, len(ids), len(bare)))
                    if number in held:
                        rest = packer.waiting(number)
                        held[number] = key, ids[rest:].copy(), rest, len(ids)
                    number += 1
                if len(out) >= OUT_ROWS:
                    yield result(out, batch.schema.field(0).type, names)
                    out.clear()
        take(packer.finish())
        if out:
            yield result(out, batch.schema.field(0).type, names)

    text, prompt = F.col(f"`{text_col}`").cast("string"), F.lit(None).cast("string")
    if prompt_col:
        prompt = F.col(f"`{prompt_col}`").cast("string")
    rows = examples.select(F.col(f"`{id_col}`").alias("key"), text.alias("t"), prompt.alias("p"))
    names = [id_col, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
                                "sequence_id bigint, offset bigint, loss_tokens bigint")


def result(out: list[tuple], key_type: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [key_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
