"""SentencePiece encoding and decoding of a BPE piece model by batched Viterbi.

A text gets a leading space, spaces become the piece mark, and is cut into
words before each mark (no piece has a mark behind another character). Each
distinct word of a batch is encoded once. Words advance together, the longest
first so that those still going on are a prefix, one end position at a time: the
hashes of all substrings that end there probe the sorted piece keys at once, the
pieces found compete, and the maximum is stored as back pointer.

The models at hand are byte-pair models: their encoding is what greedy merging
by score gives, which a best sum of scores would not reproduce. It has an
equivalent form over back pointers: a cut of a word into pieces is the greedy
one exactly if every two neighbours stay apart when merged on their own. So a
piece that ends at a position scores 1 if it stays apart from the last piece of
the prefix before it, else 0; one piece per position scores 1. Whether two
pieces stay apart follows from the merges at their facing edges (an edge
symbol lives from the rank that formed it to the rank that consumed it, and a
merge across is possible if its rank lies before both ends). This rule
needs pieces whose merges run in rank order; words with any other piece, or
over ``LONG`` characters or of a length that few words of the batch reach
(``FEW``), are merged greedily with a heap instead. Results are
those of the public library on the same model file.

Characters without a piece become their UTF-8 byte pieces. Runs of marks have
pieces of the lowest score, merged last from the left.

Cases: null and empty texts encode to no pieces (decoded: empty); texts of any
length are encoded whole; a literal mark decodes to a space, and byte pieces
that form no valid UTF-8 decode to U+FFFD; repeated rows get equal results; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitfit.llm.base import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
LONG = 200            # longer words are merged with a heap
FEW = 24              # so are words of a length that fewer new words reach
TOGETHER = 8192       # words that advance together
MEMO = 250_000        # distinct words a worker remembers
SLICE = 1_000_000     # characters encoded at once
BASE = 0x9E3779B97F4A7C15
NEVER = 1 << 30
PAIRS = 20            # log2 slots of the pair memo


def hash_of(points: list[int]) -> int:
    h = 0
    for p in points:
        h = (h * BASE + p + 1) & (2**64 - 1)
    return h


class Pieces:
    """Vocabulary arrays of a piece model: keys, ranks, merge edges, output bytes."""

    def __init__(self, texts: list[str], scores: list[float], byte_of: dict[int, int], control: set[int], unknown: int):
        normal = {t: i for i, t in enumerate(texts) if i not in byte_of and i not in control and i != unknown}
        floor = min(scores)
        runs = {len(t): i for t, i in normal.items() if len(t) > 1 and set(t) == {MARK} and scores[i] == floor}
        for i in runs.values():
            del normal[texts[i]]
        if any(MARK in t[1:] for t in normal):
            raise ValueError("a piece has a mark behind another character")
        self.runs = runs
        self.byte_ids = np.zeros(256, np.int32)
        for i, b in byte_of.items():
            self.byte_ids[b] = i
        # Merges are tried by falling score, ties by id never meet (scores differ).
        order = sorted(normal.values(), key=lambda i: -scores[i])
        self.rank = {texts[i]: r for r, i in enumerate(order)}
        self.id_of = normal
        self.longest = max(map(len, normal))
        keys = np.array([hash_of([ord(c) for c in t]) for t in normal], np.uint64)
        ids = np.array(list(normal.values()), np.int32)
        by = np.argsort(keys)
        self.keys, self.key_ids = keys[by], ids[by]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a hash")
        self.filter = np.zeros(1 << 19, bool)
        self.filter[(self.keys >> np.uint64(45)).astype(np.int64)] = True
        n = len(texts)
        self.hash = np.zeros(n, np.uint64)
        self.hash[self.key_ids] = self.keys
        self.size = np.zeros(n, np.int64)
        self.time = np.full(n, NEVER, np.int64)
        self.plain = np.zeros(n, bool)
        left, right = {}, {}
        for t, i in normal.items():
            self.size[i] = len(t)
            self.time[i] = self.rank[t] if len(t) > 1 else -1
            made, ranks, last = self._derive(t)
            if made:
                self.plain[i] = all(a < b for a, b in zip(ranks, ranks[1:]))
                left[i], right[i] = (normal[last[0]], normal[last[1]]) if last else (-1, -1)
        self.made = np.zeros(n, bool)
        self.made[list(left)] = True
        # Edge symbols from the whole piece inwards, and the rank that consumes each.
        self.right_edge, self.right_end = self._edges(right, n)
        self.left_edge, self.left_end = self._edges(left, n)
        out = [b"" if i in control else bytes([byte_of[i]]) if i in byte_of
               else " ⁇ ".encode() if i == unknown else t.replace(MARK, " ").encode() for i, t in enumerate(texts)]
        self.out_len = np.array([len(b) for b in out], np.int64)
        self.out_at = np.concatenate(([0], np.cumsum(self.out_len)[:-1]))
        self.out = np.frombuffer(b"".join(out), np.uint8)

    def _derive(self, text: str):
        """Greedy merging of a piece's own text: whether it gives the piece, ranks in order, last two symbols."""
        s, ranks, last = list(text), [], None
        while len(s) > 1:
            best = min(((self.rank.get(a + b, NEVER), k) for k, (a, b) in enumerate(zip(s, s[1:]))))
            if best[0] == NEVER:
                return False, ranks, None
            k = best[1]
            last = (s[k], s[k + 1])
            ranks.append(best[0])
            s[k:k + 2] = [s[k] + s[k + 1]]
        return all(c in self.id_of for c in text) or len(text) == 1, ranks, last

    def _edges(self, child: dict[int, int], n: int):
        chains = {}
        for i in child:
            chain, ends, x, end = [], [], i, NEVER
            while x >= 0:
                chain.append(x)
                ends.append(end)
                end, x = int(self.time[x]), child.get(x, -1)
            chains[i] = chain, ends
        depth = max(len(c) for c, _ in chains.values())
        edge, stop = np.full((n, depth), -1, np.int32), np.zeros((n, depth), np.int64)
        for i, (c, e) in chains.items():
            edge[i, :len(c)], stop[i, :len(e)] = c, e
        return edge, stop

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, -1 where there is no piece."""
        got = np.full(h.shape, -1, np.int32)
        maybe = np.flatnonzero(self.filter[(h >> np.uint64(45)).astype(np.int64)])
        at = np.searchsorted(self.keys, h[maybe])
        at[at == len(self.keys)] = 0
        same = self.keys[at] == h[maybe]
        got[maybe[same]] = self.key_ids[at[same]]
        return got

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether greedy merging keeps the neighbouring pieces ``a`` and ``b`` apart."""
        ok = np.ones(len(a), bool)
        for i in range(self.right_edge.shape[1]):
            x = self.right_edge[a, i]
            rows = np.flatnonzero(ok & (x >= 0))
            if not len(rows):
                break
            for j in range(self.left_edge.shape[1]):
                y = self.left_edge[b[rows], j]
                rows, y = rows[y >= 0], y[y >= 0]
                if not len(rows):
                    break
                p, end_x, end_y = x[rows], self.right_end[a[rows], i], self.left_end[b[rows], j]
                # Equal ranks: the merge further left comes first.
                meet = (self.time[p] <= end_y) & (self.time[y] < end_x)
                near = np.flatnonzero(meet)
                power = POWERS[self.size[y[near]]]
                with np.errstate(over="ignore"):
                    joined = self.find(self.hash[p[near]] * power + self.hash[y[near]])
                r = np.where(joined >= 0, self.time[joined], NEVER)
                bad = (r < end_x[near]) & (r <= end_y[near]) & (joined >= 0)
                ok[rows[near[bad]]] = False
                rows = rows[ok[rows]]
        return ok


POWERS = np.array([pow(BASE, k, 2**64) for k in range(64)], np.uint64)


def load(path: str = MODEL) -> Pieces:
    """Read a SentencePiece BPE model file on the driver."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.vocab_size()
    return Pieces([sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)],
                  {i: int(sp.id_to_piece(i)[1:-1], 16) for i in range(n) if sp.is_byte(i)},
                  {i for i in range(n) if sp.is_control(i) or sp.is_unused(i)}, sp.unk_id())


class Encoder:
    """Encodes and decodes texts; remembers the words it has seen."""

    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.mark = pieces.id_of.get(MARK, -1)
        self.pair_key = np.full(1 << PAIRS, -1, np.int64)
        self.pair_ok = np.zeros(1 << PAIRS, bool)
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.starts, self.sizes, self.pool = [np.empty(0, np.int64) for _ in range(2)] + [np.empty(0, np.int32)]

    def stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``Pieces.apart`` through a memo; a character without piece (-1) always stays apart."""
        ok = np.ones(len(a), bool)
        both = np.flatnonzero((a >= 0) & (b >= 0))
        key = a[both].astype(np.int64) << 32 | b[both]
        slot = (key.view(np.uint64) * np.uint64(BASE) >> np.uint64(64 - PAIRS)).astype(np.int64)
        miss = np.flatnonzero(self.pair_key[slot] != key)
        ok[both] = self.pair_ok[slot]
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            good = self.p.apart((new >> 32).astype(np.int64), (new & 0xFFFFFFFF).astype(np.int64))
            ok[both[miss]] = good[back]
            at = (new.view(np.uint64) * np.uint64(BASE) >> np.uint64(64 - PAIRS)).astype(np.int64)
            self.pair_key[at] = new
            # Two new pairs may share a slot: the flag must belong to the key that stayed.
            mine = self.pair_key[at] == new
            self.pair_ok[at[mine]] = good[mine]
        return ok

    def greedy(self, word: str) -> list[int]:
        """Merge by rank, leftmost first, with a heap."""
        s = list(word)
        nxt, prv = [*range(1, len(s)), -1], [-1, *range(len(s) - 1)]
        rank = self.p.rank
        heap = [(rank[a + b], k, a, b) for k, (a, b) in enumerate(zip(s, s[1:])) if a + b in rank]
        heapify(heap)
        while heap:
            _, k, a, b = heappop(heap)
            j = nxt[k]
            if s[k] != a or j < 0 or s[j] != b:
                continue
            s[k], s[j], nxt[k] = a + b, "", nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = k
            for u, v in ((prv[k], k), (k, nxt[k])):
                if u >= 0 and v >= 0 and s[u] + s[v] in rank:
                    heappush(heap, (rank[s[u] + s[v]], u, s[u], s[v]))
        out = []
        for t in s:
            if t:
                out += [self.p.id_of[t]] if t in self.p.id_of else self.p.byte_ids[list(t.encode("utf-8", "surrogatepass"))].tolist()
        return out

    def viterbi(self, words: list[str]) -> list:
        """Piece ids of words, the longest first, advancing together; None where the rule does not apply."""
        n, top = len(words), len(words[0])
        sizes = np.fromiter(map(len, words), np.int64, n)
        reach = np.searchsorted(-sizes, -np.arange(top + 1), side="right")   # words of at least so many characters
        points = np.zeros((n, top), np.uint32)
        points[np.arange(top) < sizes[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        h = np.zeros((top + 1, n), np.uint64)
        with np.errstate(over="ignore"):
            for e in range(top):
                m = reach[e + 1]
                h[e + 1, :m] = h[e, :m] * np.uint64(BASE) + points[:m, e] + np.uint64(1)
            last, back = np.full((top + 1, n), -1, np.int32), np.zeros((top + 1, n), np.int16)
            failed = np.zeros(n, bool)
            for e in range(1, top + 1):
                m = reach[e]
                ks = np.arange(min(e, self.p.longest), 0, -1)
                ids = self.p.find((h[e, :m] - h[e - ks, :m] * POWERS[ks][:, None]).ravel())
                fits = (ids >= 0) & self.p.made[ids]
                fits[-m:] = True                             # one character, with a piece or without
                at = np.flatnonzero(fits)
                k, row = ks[at // m], at % m
                # 1 for a piece that stays apart, else 0; the shortest that scores comes last and is kept.
                won = self.stay(last[e - k, row], ids[at])
                row = row[won]
                last[e, row], back[e, row] = ids[at[won]], k[won]
                none = np.flatnonzero(back[e, :m] == 0)
                failed[none] = True
                back[e, none] = 1
        pos = sizes.copy()
        path = []
        while True:
            on = np.flatnonzero(pos > 0)
            if not len(on):
                break
            ids = last[pos[on], on]
            failed[on[(ids >= 0) & ~self.p.plain[ids]]] = True
            path.append((on, pos[on].copy(), ids))
            pos[on] -= back[pos[on], on]
        row, at, ids = (np.concatenate(c) for c in zip(*path))
        order = np.lexsort((at, row))
        row, at, ids = row[order], at[order], ids[order]
        cuts = np.searchsorted(row, np.arange(n + 1))
        bare = np.zeros(n, bool)
        bare[row[ids < 0]] = True
        flat = ids.tolist()
        out = []
        for r in range(n):
            a, b = cuts[r], cuts[r + 1]
            if failed[r]:
                out.append(None)
            elif not bare[r]:
                out.append(flat[a:b])
            else:
                word: list[int] = []
                for i in range(a, b):
                    word += [flat[i]] if flat[i] >= 0 else self.p.byte_ids[
                        list(words[r][at[i] - 1].encode("utf-8", "surrogatepass"))].tolist()
                out.append(word)
        return out

    def learn(self, words: set[str]) -> None:
        """Encode new words (without their mark) and remember them."""
        if len(self.code) + len(words) > MEMO:
            self.forget()
        done = sorted(words, key=len, reverse=True)
        heaped = next((i for i, w in enumerate(done) if len(w) < LONG), len(done))
        if len(done) - heaped < FEW:
            heaped = len(done)
        else:                                                # lengths that few words reach
            usual = len(done[heaped + FEW - 1])
            heaped = next(i for i in range(heaped, len(done)) if len(done[i]) <= usual)
        ids = [self.greedy(MARK + w) for w in done[:heaped]]
        for i in range(heaped, len(done), TOGETHER):
            part = [MARK + w for w in done[i:i + TOGETHER]]
            ids += [g if g is not None else self.greedy(w) for g, w in zip(self.viterbi(part), part)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum()))
        starts = len(self.pool) + np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(ids) else np.empty(0, np.int64)
        first = len(self.sizes)
        self.code.update(zip(done, range(first, first + len(done))))
        self.starts = np.concatenate((self.starts, starts.astype(np.int64)))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.pool = np.concatenate((self.pool, flat))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat piece ids and the offsets of each text."""
        split = [t.replace(MARK, " ").split(" ") if t else [] for t in texts]
        every = [w for s in split for w in s]
        new = set(every)
        if len(self.code) + len(new) > MEMO:
            self.forget()
        self.learn(new - self.code.keys())
        code = np.fromiter(map(self.code.__getitem__, every), np.int64, len(every))
        size = self.sizes[code]
        ids = gather(self.pool, self.starts[code], size)
        ends = np.concatenate(([0], np.cumsum(size)))
        offsets = ends[np.concatenate(([0], np.cumsum([len(s) for s in split])))] if split else np.zeros(1, np.int64)
        if "" in new and self.p.runs:
            ids, offsets = self.join_marks(ids, offsets)
        return ids, offsets

    def join_marks(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge runs of lone marks inside a text, from the left, as far as pieces of that length go."""
        lone = ids == self.mark
        starts = np.zeros(len(ids) + 1, bool)
        starts[offsets] = True
        begins = np.flatnonzero(lone & ~(np.concatenate(([False], lone[:-1])) & ~starts[:-1]))
        brk = np.flatnonzero(~lone | starts[:-1])
        edge = np.append(brk, len(ids))
        ends = edge[np.searchsorted(edge, begins, side="right")]
        keep, out = np.ones(len(ids), bool), ids.copy()
        for a, b in zip(begins.tolist(), ends.tolist()):
            for k in self.mark_run(b - a) if b - a > 1 else ():
                if k > 1:
                    out[a] = self.p.runs[k]
                    keep[a + 1:a + k] = False
                a += k
        kept = np.concatenate(([0], np.cumsum(keep)))
        return out[keep], kept[offsets]

    def mark_run(self, n: int) -> list[int]:
        """Lengths that ``n`` lone marks merge to: equal scores, so the leftmost possible pair first."""
        sizes, rest = [], n
        while rest or (len(sizes) > 1 and sizes[-2] + sizes[-1] in self.p.runs):
            if len(sizes) > 1 and sizes[-2] + sizes[-1] in self.p.runs:
                sizes[-2:] = [sizes[-2] + sizes[-1]]
            else:
                sizes.append(1)
                rest -= 1
        return sizes

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of flat piece ids; the leading space that encoding adds is taken off."""
        size = self.p.out_len[ids]
        flat = gather(self.p.out, self.p.out_at[ids], size).tobytes()
        at = np.concatenate(([0], np.cumsum(size)))[offsets].tolist()
        texts = [flat[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]
        return [t[1:] if t[:1] == " " else t for t in texts]


def gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenate ``pool[start:start + size]`` of all rows."""
    before = np.cumsum(sizes) - sizes
    return pool[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def worker_encoder(pieces: Pieces, tag: str) -> Encoder:
    """One encoder per worker process and model, so that later tasks know earlier words."""
    kept = sys.modules.setdefault("_orbitfit_encoders", types.ModuleType("_orbitfit_encoders"))
    if getattr(kept, "tag", None) != tag:
        kept.tag, kept.encoder = tag, Encoder(pieces)
    return kept.encoder


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL,
           check: bool = False) -> DataFrame:
    """Per row: id, n_pieces, ids; with ``check`` also whether decoding gives the text back."""
    pieces = load(model)   # travels with the function; its size is fixed by the model file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(pieces, model)
        for batch in batches:
            sizes = pc.utf8_length(batch.column(1)).fill_null(0).to_pylist()
            for a, b in slices([range(n) for n in sizes], SLICE):
                texts = batch.column(1).slice(a, b - a).to_pylist()
                ids, offsets = encoder.encode(texts)
                columns = [batch.column(0).slice(a, b - a), pa.array(np.diff(offsets).astype(np.int32)),
                           pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
                names = [id_col, "n_pieces", "ids"]
                if check:
                    back = encoder.decode(ids, offsets)
                    columns.append(pa.array([(t or "").replace(MARK, " ") == d for t, d in zip(texts, back)]))
                    names.append("round_trip")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_pieces int, ids array<int>" + (", round_trip boolean" if check else "")
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def decode(rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """Per row: id, text. Null or empty ids decode to the empty text."""
    pieces = load(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(pieces, model)
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                lists = [np.asarray(x or [], np.int32) for x in part.column(1).to_pylist()]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
                texts = encoder.decode(np.concatenate(lists), offsets)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    kind = rows.select(id_col).schema[0].dataType.simpleString()
    return rows.select(F.col(id_col), F.col(ids_col)).mapInArrow(run, f"`{id_col}` {kind}, text string")
