"""Secret scan: three fixed patterns plus a linear-chain conditional random field.

Tokens are runs of letters, digits and ``_ + / -``, and single other
characters. Each is described by its shape (kinds and number of characters,
case, changes between letters and digits) and, for a few words and signs, its
identity. The field tags tokens as begin, inside or outside of a secret from
these descriptions of the token, its two left and one right neighbours, and
the share of mixed tokens in the file; Viterbi decoding gives the best tags of
a chain (a line, cut after sentence ends). A chain in which no token's gain
over "outside" can outweigh the best transitions is outside as a whole, which
a bound shows exactly; only the others are decoded step by step.

The field is trained here on bounded samples (``MAX_TRAIN`` each) of the documents
that hold a fixed match, searched for in the whole table, and of all documents.
The values that the fixed patterns find are the secrets. So that the field does
not merely repeat the patterns, each match also teaches in changed surroundings
(``changed``): another cue and link before the value, another random value, a long
random value without any cue; and as what is no secret, a cue with a plain
word and random-looking things that are none (dates, addresses, numbers, names).
A part of the chains without a secret is held out: "outside" is raised until at
most ``MAX_FALSE`` of them get a span. Fixed matches always stay; a tagged span is
added (kind ``crf``) where it overlaps none of them.

Cases: null text counts as empty; empty texts have no spans; texts of any
length are scanned whole; without a fixed match in the table nothing is
added; repeated rows get equal results; an empty table gives an empty result;
other columns are not inputs. Positions are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbitfit.llm.base import drawn, slices, written

KINDS = ("assign", "access", "hex", "crf")
# Fixed patterns (values given by the contract).
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
# Words and signs whose identity is a feature.
KNOWN = ("password", "passwd", "pwd", "pass", "secret", "token", "key", "apikey", "api_key", "api-key", "api", "auth",
         "bearer", "access", "access_key", "secret_key", "private", "credential", "credentials", "login", "client_secret",
         ":", "=", "\"", "'", ".", ",", "@", "(", ")", "|")

MAX_TRAIN = 20_000     # documents of either kind looked at for training chains
MAX_CHAINS = 1_500     # of each kind of training chain
VARIED = 4             # matches of a document that also teach in changed surroundings
ROUNDS = 100           # most changes of one match; fewer where matches are many
MAX_FALSE = 0.001      # share of the held-out chains without a secret that may get a span
WINDOW = 32            # tokens of a training chain
LEAST = 8              # characters of an added span
STRONG = 16            # characters of a value that is a secret without a cue
CONTEXT = 120          # characters kept on either side of a changed match
# What may stand before a secret value: cues, and what links them to the value.
CUES = ("password", "passwd", "pwd", "pass", "secret", "token", "api_key", "api-key", "auth", "bearer", "access_key",
        "secret_key", "private key", "credential", "client_secret", "login")
LINKS = (" = ", "=", ": ", ":", " ", " is ", " uses ", ' = "', " was ", " | ")
ALNUM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
STEPS = 60
BITS = 16
SLICE = 1_000_000
O, B, I = 0, 1, 2
PLAIN, MATCH, CHANGED, NONE = range(4)   # kinds of training chains
SPACE_CLASS, LOWER, UPPER, DIGIT, JOIN, OTHER = range(6)


def character_classes() -> np.ndarray:
    """Class of each code point of the basic plane."""
    table = np.full(1 << 16, OTHER, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c.isspace():
            table[i] = SPACE_CLASS
        elif c.isalpha():
            table[i] = UPPER if c.isupper() else LOWER
        elif c.isdigit():
            table[i] = DIGIT
    table[[ord(c) for c in "_+/-"]] = JOIN
    return table


class Tokens:
    """Arrays over the tokens of some texts: bounds, text number, chain, description."""

    def __init__(self, texts: list[str], classes: np.ndarray):
        joined = "\n".join(texts) + "\n"
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = classes[np.minimum(cp, 0xFFFF)]
        word = (kind >= LOWER) & (kind <= JOIN)
        before = np.concatenate(([False], word[:-1]))
        self.start = np.flatnonzero((word & ~before) | (kind == OTHER))
        n = len(self.start)
        self.base = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        self.text = np.searchsorted(self.base, self.start, side="right") - 1
        if not n:
            self.end = self.chain = self.shape = np.empty(0, np.int64)
            return
        stop = np.append(np.flatnonzero(~word), len(cp))
        self.end = np.where(word[self.start], stop[np.searchsorted(stop, self.start)], self.start + 1)
        self.shape = self._shapes(cp, kind, n)
        lines = np.cumsum(cp == 10)
        first = np.ones(n, bool)
        ended = np.isin(cp[self.start[:-1]], (46, 33, 63)) & (self.start[1:] > self.end[:-1])
        first[1:] = (lines[self.start[1:]] != lines[self.start[:-1]]) | ended
        self.chain = np.cumsum(first) - 1
        mixed = (self.shape & 7) == 3
        per = np.bincount(self.text, minlength=len(texts))
        share = np.bincount(self.text, mixed, len(texts)) / np.maximum(per, 1)
        self.file = np.digitize(share, (1e-9, 0.005, 0.05))[self.text]

    def _shapes(self, cp: np.ndarray, kind: np.ndarray, n: int) -> np.ndarray:
        """16-bit description: kind 3, case 2, length 3, hex 1, changes 2, identity 5."""
        size = self.end - self.start

        def count(mask):
            total = np.concatenate(([0], np.cumsum(mask, dtype=np.int32)))
            return total[self.end] - total[self.start]

        lower, upper, digit, join = (count(kind == k) for k in (LOWER, UPPER, DIGIT, JOIN))
        other = kind[self.start] == OTHER
        letters = lower + upper
        what = np.select([other, (digit > 0) & (letters > 0), join > 0, digit > 0], [0, 3, 2, 1], 4)
        case = np.select([upper == 0, lower == 0, (upper == 1) & (kind[self.start] == UPPER)], [0, 1, 2], 3)
        length = np.digitize(size, (2, 4, 8, 12, 16, 24, 32))
        hexed = count((cp >= 97) & (cp <= 102) | (cp >= 48) & (cp <= 57)) == size
        digits = kind == DIGIT
        change = np.concatenate(([False], digits[1:] != digits[:-1]))
        changes = np.digitize(count(change), (1, 3, 6))
        folded = np.where((cp >= 65) & (cp <= 90), cp + 32, cp).astype(np.uint64) + np.uint64(1)
        identity = np.zeros(n, np.int64)
        for k, w in enumerate(KNOWN):
            same = np.flatnonzero((size == len(w)) & (folded[self.start] == ord(w[0]) + 1))
            for j, c in enumerate(w[1:], 1):
                same = same[folded[self.start[same] + j] == ord(c) + 1]
            identity[same] = k + 1
        return what | case << 3 | length << 5 | hexed.astype(np.int64) << 8 | changes << 9 | identity << 11

    def features(self) -> np.ndarray:
        """(features, tokens) hashed feature numbers."""
        return hashed(self.shape, self.text, self.file)


def hashed(shape: np.ndarray, text: np.ndarray, file: np.ndarray) -> np.ndarray:
    def shifted(k: int) -> np.ndarray:
        out = np.full(len(shape), 0xFFFF, np.int64)
        if k > 0 and len(shape) > k:
            out[k:] = np.where(text[k:] == text[:-k], shape[:-k], 0xFFFF)
        elif k < 0 and len(shape) > -k:
            out[:k] = np.where(text[:k] == text[-k:], shape[-k:], 0xFFFF)
        return out

    one, two, after = shifted(1), shifted(2), shifted(-1)
    coarse = shape & 7 | (shape >> 5 & 7) << 3 | (shape >> 9 & 3) << 6   # kind, length, changes
    near, far, then = (s & 7 | (s >> 11) << 3 for s in (one, two, after))   # kind, identity
    parts = (shape, near, far << 8 | near, then << 8 | coarse, near << 8 | coarse, (far << 8 | near) << 8 | coarse,
             coarse << 2 | file)
    with np.errstate(over="ignore"):
        return np.stack([((p.astype(np.uint64) + np.uint64(k << 40)) * np.uint64(0x9E3779B97F4A7C15)
                          >> np.uint64(64 - BITS)).astype(np.int64) for k, p in enumerate(parts)])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed matches."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if len(text) >= HEX_LEAST:
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        stop = np.concatenate(([-1], np.flatnonzero(~((cp >= 97) & (cp <= 102) | (cp >= 48) & (cp <= 57))), [len(cp)]))
        runs = np.flatnonzero(np.diff(stop) > HEX_LEAST)
        found += [(int(stop[r]) + 1, 2, int(stop[r + 1])) for r in runs]
    return sorted(found)


def values(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The secret values of fixed matches: of an assignment the part behind the sign."""
    return [(ASSIGN.match(text, a).start(2) if k == 0 else a, b) for a, k, b in spans]


def strong(value: str) -> bool:
    """Long and mixed enough to be a secret without a cue."""
    return len(value) >= STRONG and sum(c.isdigit() for c in value) >= 3 and sum(c.isalpha() for c in value) >= 3


def random_value(rng: random.Random, least: int, most: int, mixed: int) -> str:
    """A value with ``mixed`` letters and digits each at least, at times with a short prefix or a padding sign."""
    alphabet = rng.choice((ALNUM, ALNUM, ALNUM[:26] + ALNUM[52:], ALNUM + "_-"))
    n = rng.randint(least, most)
    at = rng.sample(range(n), 2 * mixed)
    value = [rng.choice(alphabet) for _ in range(n)]
    for k, i in enumerate(at):   # both letters and digits
        value[i] = rng.choice(ALNUM[52:] if k % 2 else ALNUM[:26])
    head = rng.choice(("", "", "".join(rng.choice(ALNUM[:26]) for _ in range(rng.randint(2, 4))) + rng.choice("_-")))
    return head + "".join(value) + rng.choice(("", "", "", "=="))


def lookalike(rng: random.Random) -> str:
    """Something with digits that is no secret where no cue stands before it."""
    def some(alphabet: str, n: int) -> str:
        return "".join(rng.choice(alphabet) for _ in range(n))

    low, digits = ALNUM[:26], ALNUM[52:]
    return rng.choice((
        lambda: f"{some('12', 1)}{some(digits, 3)}-{some(digits, 2)}-{some(digits, 2)}T{some(digits, 2)}:{some(digits, 2)}",
        lambda: "-".join(some("0123456789abcdef", n) for n in (8, 4, 4, 4, 12)),
        lambda: f"{some(low, 7)}{some(digits, 2)}@{some(low, 5)}{some(digits, 1)}.example.com",
        lambda: f"v{some(digits, 1)}.{some(digits, 2)}.{some(digits, 1)}-{some(low, 4)}{some(digits, 1)}",
        lambda: some(digits, 16),
        lambda: f"{some(digits, 3)}-{some(digits, 3)}-{some(digits, 4)}",
        lambda: some(low, rng.randint(3, 6)) + some(low, rng.randint(4, 8)).capitalize() + some(digits, 1),
        lambda: f"{some(low, 6)}_{some(low, 7)}_{some(low, 5)}{some(digits, 1)}",
        lambda: f"/{some(low, 5)}/{some(low, 6)}{some(digits, 2)}/{some(low, 8)}",
        lambda: some(low, rng.randint(12, 24)),
        lambda: some(ALNUM[26:52], 3) + "-" + some(digits, 5),
    ))()


def changed(before: str, value: str, after: str, seed: int) -> Iterator[tuple[int, str, int, int]]:
    """(kind, text, start, end of the value) of the surroundings that one match also teaches in.

    ``before`` and ``after`` are cut at a word, or left out, so that the value has changing neighbours.
    """
    rng = random.Random(seed)
    lead, rest = before.split(" "), after.split(" ")
    word = rng.choice([w for w in lead if w.isalpha()] or ["word"])
    before = " ".join(lead[:rng.randint(0, len(lead))])
    after = rng.choice(("", " ", " ", " ", '"', ", ", " | ")) + " ".join(rest[rng.randint(0, len(rest)):])
    before += " " if before and rng.random() < 0.9 else ""

    def cue() -> str:
        name = rng.choice(CUES)
        return rng.choice((name, name, name.capitalize(), name.upper()))

    cased = cue() + rng.choice(LINKS)
    for kind, lead, body in ((CHANGED, cased, value),
                             (CHANGED, cue() + rng.choice(LINKS), random_value(rng, 8, 40, 1)),
                             (CHANGED, rng.choice(("", word + " ")), value if strong(value) and rng.random() < 0.3
                              else random_value(rng, 20, 44, 3)),
                             (NONE, cue() + rng.choice(LINKS), word),
                             (NONE, rng.choice(("", word + " ")), lookalike(rng))):
        yield kind, before + lead + body + after, len(before) + len(lead), len(before) + len(lead) + len(body)


class Field:
    """Weights (2**BITS, 3), transitions (3, 3) and what "outside" is raised by; tag order O, B, I."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, bias: float = 0.0):
        self.weights, self.moves, self.bias = weights, moves, bias

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((features.shape[1], 3), np.float32)
        for f in features:
            out += self.weights[f]
        out[:, O] += self.bias
        return out

    def tags(self, e: np.ndarray, chain: np.ndarray) -> np.ndarray:
        """Best tags of every token; chains are runs of equal ``chain``."""
        tags = np.zeros(len(e), np.int8)
        if not len(e):
            return tags
        starts = np.flatnonzero(np.concatenate(([True], chain[1:] != chain[:-1])))
        size = np.diff(np.append(starts, len(e)))
        # Leaving "outside" at a token changes at most two moves, each by at most ``gain``.
        gain = max(0.0, float((self.moves[np.isfinite(self.moves)] - self.moves[O, O]).max()))
        best = np.maximum.reduceat(e[:, 1:].max(axis=1) - e[:, O], starts)
        todo = np.flatnonzero(best + 2 * gain >= 0)
        todo = todo[np.argsort(-size[todo], kind="stable")]
        if not len(todo):
            return tags
        at, left = starts[todo], size[todo]
        score = e[at].astype(np.float64)
        score[:, I] = -np.inf
        back = []
        for t in range(1, int(left[0])):
            on = int(np.searchsorted(-left, -t, side="left"))
            step = score[:on, :, None] + self.moves[None]
            back.append(step.argmax(axis=1).astype(np.int8))
            score[:on] = step.max(axis=1) + e[at[:on] + t]
        tag = score.argmax(axis=1)
        for t in range(int(left[0]) - 1, -1, -1):
            on = int(np.searchsorted(-left, -t, side="left"))
            tags[at[:on] + t] = tag[:on]
            if t:
                tag[:on] = back[t - 1][np.arange(on), tag[:on]]
        return tags


def train(feats: np.ndarray, labels: np.ndarray) -> Field:
    """Maximum likelihood by Adam steps; (features, chains, WINDOW) numbers, labels -1 beyond a chain's end."""
    n = labels.shape[0]
    weights, moves = np.zeros((1 << BITS, 3)), np.zeros((3, 3))
    live = labels >= 0
    gold = np.zeros((*labels.shape, 3))
    gold[live, labels[live]] = 1
    shut = np.zeros((3, 3), bool)
    shut[O, I] = True
    pairs = np.zeros((3, 3))
    both = live[:, 1:] & live[:, :-1]
    np.add.at(pairs, (labels[:, :-1][both], labels[:, 1:][both]), 1)
    m1, m2, v1, v2 = np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(weights), np.zeros_like(moves)
    for k in range(1, STEPS + 1):
        e = weights[feats].sum(axis=0)
        move = np.where(shut, -1e9, moves)
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        alpha[:, 0, I] = -1e9
        for t in range(1, WINDOW):
            step = np.logaddexp.reduce(alpha[:, t - 1, :, None] + move, axis=1) + e[:, t]
            alpha[:, t] = np.where(live[:, t, None], step, alpha[:, t - 1])
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        for t in range(WINDOW - 2, -1, -1):
            step = np.logaddexp.reduce(move[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(live[:, t + 1, None], step, 0)
        p = np.exp(np.minimum(alpha + beta - total[:, None, None], 0)) * live[..., None]
        q = np.zeros((3, 3))
        for t in range(1, WINDOW):
            x = np.exp(np.minimum(alpha[:, t - 1, :, None] + move + (e[:, t] + beta[:, t])[:, None, :]
                                  - total[:, None, None], 0))
            q += (x * live[:, t, None, None]).sum(axis=0)
        err = (p - gold).reshape(-1, 3)
        g1 = np.stack([np.bincount(feats.reshape(-1), np.tile(err[:, c], len(feats)), 1 << BITS) for c in range(3)], axis=1)
        g1, g2 = g1 / n + 1e-4 * weights, np.where(shut, 0, (q - pairs) / n)
        for x, g, m, v in ((weights, g1, m1, v1), (moves, g2, m2, v2)):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            x -= 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return Field(weights.astype(np.float32), np.where(shut, -np.inf, moves))


def calibrate(field: Field, feats: np.ndarray, labels: np.ndarray) -> Field:
    """Raise "outside" until at most MAX_FALSE of these chains without a secret get a span."""
    chain = np.nonzero(labels >= 0)[0]
    flat = feats[:, labels >= 0]
    while len(chain) and field.bias < 16:
        false = len(np.unique(chain[field.tags(field.emissions(flat), chain) != O]))
        if false <= MAX_FALSE * len(labels):
            break
        field.bias += 0.5
    return field


def chains(texts: list[str], plain: list[bool], classes: np.ndarray, rounds: int) -> list[tuple[int, bytes, bytes]]:
    """(kind, feature numbers, tags) of the training chains of some texts."""
    tok = Tokens(texts, classes)
    if not len(tok.start):
        return []
    rows, more, origin = [], [], []
    label, feats = np.zeros(len(tok.start), np.int8), tok.features()

    def mark(tokens: Tokens, tags: np.ndarray, i: int, s: int, e: int) -> None:
        a, b = np.searchsorted(tokens.end, tokens.base[i] + s, "right"), np.searchsorted(tokens.start, tokens.base[i] + e)
        tags[a:b] = I
        tags[a:a + (b > a)] = B

    def add(kind: int, x: np.ndarray, y: np.ndarray) -> None:
        at = int(np.argmax(y == B))   # the window holds the first secret of the chain
        part = slice(max(0, at - WINDOW // 2), max(0, at - WINDOW // 2) + WINDOW)
        rows.append((kind, x[:, part].astype(np.uint16).tobytes(), y[part].tobytes()))

    for i, text in enumerate(texts):
        spans = base_spans(text)
        for k, (s, e) in enumerate(values(text, spans)):
            mark(tok, label, i, s, e)
            if k < VARIED:
                before, after = (re.sub(r"[\n.!?]", " ", x) for x in
                                 (text[max(0, spans[k][0] - CONTEXT):spans[k][0]], text[e:e + CONTEXT]))
                seed = zlib.crc32(f"{k} {text[s:e]} {before}".encode("utf-8", "replace"))
                found = [x for r in range(rounds) for x in changed(before, text[s:e], after, seed + r)]
                more += found
                origin += [i] * len(found)
    heads = np.flatnonzero(np.concatenate(([True], tok.chain[1:] != tok.chain[:-1])))
    stops = np.append(heads[1:], len(label))
    secret = np.unique(np.searchsorted(heads, np.flatnonzero(label == B), side="right") - 1)
    outside = np.setdiff1d(np.arange(len(heads)), secret)[::37]
    for c in secret.tolist():
        add(MATCH, feats[:, heads[c]:stops[c]], label[heads[c]:stops[c]])
    for c in outside[np.array(plain, bool)[tok.text[heads[outside]]]].tolist():
        add(PLAIN, feats[:, heads[c]:stops[c]], label[heads[c]:stops[c]])
    if more:
        files = np.zeros(len(texts), np.int64)
        files[tok.text] = tok.file
        tok = Tokens([m[1] for m in more], classes)
        tok.file = np.maximum(files[np.array(origin)], 1)[tok.text]   # as in the whole text, with a mixed token
        label, feats = np.zeros(len(tok.start), np.int8), tok.features()
        bounds = np.searchsorted(tok.text, np.arange(len(more) + 1))
        for i, (kind, _, s, e) in enumerate(more):
            a, b = bounds[i], bounds[i + 1]
            if a == b:
                continue
            mark(tok, label, i, s, e)
            if kind == CHANGED:
                add(kind, feats[:, a:b], label[a:b])
            else:   # the window of a secret at that place, and outside throughout
                at = a + max(0, int(np.argmax(label[a:b] == B)) - WINDOW // 2)
                add(kind, feats[:, at:b], np.zeros(b - at, np.int8))
    return rows


def fit(docs: DataFrame, id_col: str, text_col: str) -> Field | None:
    """Field from chains with a fixed match, changed ones and chains without one, of bounded samples.

    Two reads of the table: one counts the documents with a match, so that rare
    matches are found wherever they are, the other one cuts the chains.
    """
    classes = character_classes()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = held = 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            rows += len(texts)
            held += sum(bool(t and base_spans(t)) for t in texts)
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([held])], ["n", "held"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, plain, teach = ([x or empty for x in c.to_pylist()] for c, empty in zip(batch.columns, ("", False, False)))
            used = [i for i, t in enumerate(texts) if plain[i] or teach[i] and base_spans(t)]
            texts, plain = [texts[i] for i in used], [plain[i] for i in used]
            rows = []
            for a, b in slices(texts, SLICE):
                rows += chains(texts[a:b], plain[a:b], classes, rounds)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                              pa.array([r[1] for r in rows], pa.binary()),
                                              pa.array([r[2] for r in rows], pa.binary())], ["kind", "x", "y"])

    rows = docs.select(F.col(id_col).cast("string").alias("k"), F.col(text_col).cast("string").alias("text"))
    size, held = rows.select("text").mapInArrow(counted, "n long, held long").agg(F.sum("n"), F.sum("held")).first()
    if not held:
        return None
    rounds = min(ROUNDS, max(1, MAX_CHAINS // held))
    # Drawn by identifier and text, so rows that share an identifier are told apart.
    key = F.concat_ws(" ", "k", F.xxhash64("text").cast("string"))

    def sampled(share: bool) -> DataFrame:
        plain = drawn(key, MAX_TRAIN, size) if share else F.lit(True)
        teach = drawn(key, MAX_TRAIN, held) if share else F.lit(True)
        picked = rows.select("text", plain.alias("plain"), teach.alias("teach")).filter("plain or teach")
        # Equal chains are one, so copies of a text add nothing; few partitions, so that few candidates reach the driver.
        return written(picked.mapInArrow(windows, "kind int, x binary, y binary").distinct(), "chains")

    found = sampled(True)
    if found.filter(F.col("kind") == MATCH).isEmpty():   # few distinct rows, none of them drawn
        found = sampled(False)
    got = []
    for kind in (PLAIN, MATCH, CHANGED, NONE):
        few = found.filter(F.col("kind") == kind).withColumn("h", F.xxhash64("x", "y"))
        n = few.count()
        # Twice the share by hash, then exactly the smallest ones.
        few = few.filter(F.col("h") < F.lit(MAX_CHAINS * 2**65 // n - 2**63)) if n > 4 * MAX_CHAINS else few
        got += few.coalesce(8).orderBy("h", "x", "y").limit(MAX_CHAINS).collect()
    if not any(r["kind"] == MATCH for r in got):
        return None
    kinds = np.array([r["kind"] for r in got])
    labels = np.full((len(got), WINDOW), -1, np.int8)
    feats = np.zeros((7, len(got), WINDOW), np.int64)
    for i, r in enumerate(got):
        y = np.frombuffer(r["y"], np.int8)
        labels[i, :len(y)] = y
        feats[:, i, :len(y)] = np.frombuffer(r["x"], np.uint16).reshape(7, len(y))
    held_out = (kinds == PLAIN) & (np.arange(len(got)) % 4 == 0)
    return calibrate(train(feats[:, ~held_out], labels[~held_out]), feats[:, held_out], labels[held_out])


def find(texts: list[str], field: Field | None, classes: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Sorted (start, kind number, end) spans of each text: fixed ones and added ones."""
    spans = [base_spans(t) for t in texts]
    if field is None:
        return spans
    tok = Tokens(texts, classes)
    if not len(tok.start):
        return spans
    tags = field.tags(field.emissions(tok.features()), tok.chain)
    begins = np.flatnonzero(tags == B)
    for i in begins.tolist():
        j = i + 1
        while j < len(tags) and tags[j] == I and tok.chain[j] == tok.chain[i]:
            j += 1
        doc = int(tok.text[i])
        a, b = int(tok.start[i] - tok.base[doc]), int(tok.end[j - 1] - tok.base[doc])
        if b - a >= LEAST and all(b <= s or a >= e for s, k, e in spans[doc] if k < 3):
            spans[doc].append((a, 3, b))
    return [sorted(s) for s in spans]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, n_added, base_sha256, spans."""
    field, classes = fit(docs, id_col, text_col), character_classes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            out = []
            for a, b in slices(texts, SLICE):
                out += find(texts[a:b], field, classes)
            count = [[sum(k == kind for _, k, _ in s) for s in out] for kind in range(4)]
            base = [hashlib.sha256(joined([x for x in s if x[1] < 3]).encode()).hexdigest() for s in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in count), pa.array(base, pa.string()),
                 pa.array([joined(s) for s in out], pa.string())],
                [id_col, "n_assign", "n_access", "n_hex", "n_added", "base_sha256", "spans"])

    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, n_added long, base_sha256 string, spans string")
