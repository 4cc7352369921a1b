"""Fill-in-middle, packing and whitening against plain versions."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orbitfit.llm import fim, packing, queries, whitening
from tests_llm_common import SF

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain_fim(key, text):
    """The contract, unit by unit."""
    units = UNIT.findall(text or "")
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    r = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in r[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or r[2] % 100 >= 90:
        return len(units), "plain", None, None, text or ""
    if r[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TRICKY = ["a<S>b", "<", "<<M", "S> <P x", "<P", ">", "<P><S><M>", "\n\n", "é́a b", "a" * 3000 + "1" * 3000,
          "日本語abc🙂d", "x y" * 4000]


def test_fim_equals_the_plain_version(spark, edges):
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    rows += [(100 + 50 * i + j, t) for i, t in enumerate(TRICKY) for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, fim.transform(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")))
                     .collect()), key=repr)
    want = sorted(((k, *plain_fim(k, t), t or "") for k, t in rows), key=repr)
    assert got == want
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_fim_whole_table_and_empty(spark, edges, nothing):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op11_fim(spark, SF).collect()}
    for r in docs.collect():
        n, form, prefix, middle, out = plain_fim(r["doc_id"], r["text"])
        g = got[r["doc_id"]]
        assert (g["n"], g["form"], g["prefix_chars"], g["middle_chars"]) == (n, form, prefix, middle)
        assert g["output_sha256"] == hashlib.sha256(out.encode()).hexdigest()
        assert g["restored_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert fim.transform(nothing).collect() == []


@pytest.mark.parametrize("error", [1, 5, 127])
def test_rank_index_is_exact(error):
    rng = np.random.default_rng(error)
    sizes = [1, 2, 3, 5000, 1, 20000, 7]
    parts = [np.cumsum(rng.integers(0, 2 if i % 2 else 400, n)) for i, n in enumerate(sizes)]
    parts[3][2500:] += 10 ** 9           # a jump that no line follows
    starts = np.concatenate(([0], np.cumsum(sizes)))
    flat = np.concatenate(parts)
    index = fim.RankIndex(flat, starts, error)
    which = np.repeat(np.arange(len(sizes)), sizes)
    assert (index.select(which, np.arange(len(flat)) - starts[which]) == flat).all()
    assert np.abs(index.residual.astype(int)).max() <= error
    assert len(index.first) < len(flat) or error == 1


def test_unit_boundaries_of_slices():
    """Arrow slices with an offset, nulls excluded by the caller, and many small slices."""
    texts = ["", "a", "é", *TRICKY]
    whole = pa.array(["skip", *texts])
    one, two = np.arange(len(texts)), np.arange(len(texts)) * 7
    got = fim.cuts(whole.slice(1), one, two)
    for i, t in enumerate(texts):
        units = UNIT.findall(t)
        a, b = sorted((one[i] % (len(units) + 1), two[i] % (len(units) + 1)))
        assert (got[0][i], got[1][i], got[2][i]) == (len(units), len("".join(units[:a])), len("".join(units[:b])))


def sequences(rows):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    return by


def check_packing(rows, wanted, limits):
    """Every id once, limits kept, offsets gapless; returns ids of padding over all ids."""
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by.keys() == wanted.keys()
    for key, ids in wanted.items():
        at = 0
        for r in sorted(by[key], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids[at:at + r["length"]]
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for rows in sequences(rows).values():
        rows.sort(key=lambda r: r["offset"])
        size = sum(r["length"] for r in rows)
        assert [r["offset"] for r in rows] == np.cumsum([0, *(r["length"] for r in rows)])[:-1].tolist()
        assert size <= limits.tokens and len(rows) <= limits.segments
        assert sum(r["loss_tokens"] for r in rows) <= limits.loss
        padding += limits.tokens - size if size & (size - 1) else 0
    return padding / sum(map(len, wanted.values()))


@pytest.fixture(scope="module")
def tokens():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(tokens):
    encode = packing.Ids(packing.MODEL)
    assert encode.fast is not None
    texts = ["", " ", "<|endoftext|>a<|endoftext|>", "'S it's  \t\n x", "日本語 ½ ²", "\n" * 3000, "ab" * 5000,
             "​ ́ İ ǅ", "\n" * 1_200_000 + "x"]
    for t in texts:
        assert encode(t).tolist() == tokens(t)


def test_packing_of_documents(spark, tokens):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wanted = {r["doc_id"]: [*tokens(r["text"]), 0] for r in docs.collect()}
    got = packing.pack(docs.repartition(3, "doc_id")).collect()
    assert check_packing(got, wanted, packing.Limits()) == 0.0
    short = [s for s in sequences(got).values() if sum(r["length"] for r in s) < packing.TOKENS]
    assert len(short) <= 3 * 10
    query = queries.op12_packing(spark, SF).collect()
    assert sum(r["length"] for r in query) == sum(map(len, wanted.values()))


def test_packing_of_instruction_data(spark, tokens):
    """Prompts bear no loss; all three limits hold and none is wasted while the others allow more."""
    rng = random.Random(4)
    words = "the answer of a question is often shorter than it seems to be".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.choice((0, 3, 40, 300)))), " ".join(rng.choices(words, k=rng.randrange(60))))
            for i in range(900)]
    data = spark.createDataFrame(rows, "doc_id long, prompt string, text string").coalesce(1)
    wanted = {k: [*tokens(p), *tokens(t), 0] for k, p, t in rows}
    limits = packing.Limits(tokens=512, segments=12, loss=256)
    got = packing.pack(data, prompt_col="prompt", limits=limits).collect()
    check_packing(got, wanted, limits)
    bare = {k: len(tokens(p)) for k, p, _ in rows}
    for r in got:
        assert r["loss_tokens"] == max(0, r["start"] + r["length"] - max(r["start"], bare[r["doc_id"]]))
    loss = sum(r["loss_tokens"] for r in got)
    total = sum(map(len, wanted.values()))
    least = max(total / limits.tokens, loss / limits.loss, len(rows) / limits.segments)
    assert len(sequences(got)) <= 1.1 * least + 10


def test_packing_limits_below_a_long_text(spark, tokens):
    """Loss limit below the token limit: a text longer than both is spread, nothing is dropped."""
    data = spark.createDataFrame([(1, "word " * 9000), (2, ""), (3, None), (None, "no identifier")],
                                 "doc_id long, text string")
    limits = packing.Limits(tokens=64, segments=2, loss=30)
    wanted = {1: [*tokens("word " * 9000), 0], 2: [0], 3: [0], None: [*tokens("no identifier"), 0]}
    check_packing(packing.pack(data, limits=limits).collect(), wanted, limits)
    with pytest.raises(ValueError):
        packing.Limits(segments=0)


def test_packing_edges(spark, edges, nothing, tokens):
    rows = packing.pack(edges).collect()
    assert sum(r["length"] for r in rows) == sum(len(tokens(r["text"])) + 1 for r in edges.collect())
    assert packing.pack(nothing).collect() == []


def plain_whitening(vectors, k=16):
    x = np.floor(64 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    c = u - u.mean(axis=0)
    e, q = np.linalg.eigh(c.T @ c / len(u))
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    dev = [sum((len(u) * int(a) - int(s)) ** 2 for a, s in zip(r, u.sum(axis=0))) for r in x]
    return len(u), dev, (x - u.mean(axis=0)) @ q / np.sqrt(e), e / (c * c).sum() * len(u)


def test_whitening_equals_a_dense_solver(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    n, dev, white, explained = plain_whitening([r["embedding"] for r in rows])
    got = {(r["vec_id"], r["component"]): r for r in queries.op13_whitening(spark, SF).collect()}
    assert len(got) == 16 * len(rows)
    m = np.array([[got[r["vec_id"], j + 1]["whitened"] for j in range(16)] for r in rows])
    assert np.abs(m * np.sign((m * white).sum(axis=0)) - white).max() < 1e-9
    one = next(iter(got.values()))
    assert one["n"] == n and one["identity_error"] < 1e-10
    assert [got[r["vec_id"], 1]["deviation"] for r in rows] == dev
    assert np.allclose([got[rows[0]["vec_id"], j + 1]["explained"] for j in range(16)], explained, rtol=1e-9)


def test_whitening_edges(spark, nothing):
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [float("nan"), 0.0, 1.0]),
           (94, [float("inf"), 0.0, 1.0]), (95, [1.0, 2.0])]
    rng = np.random.default_rng(2)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(12)]
    good += [(7, good[7][1]), (None, good[3][1])]      # a repeated row, a null identifier with an equal vector
    kind = "vec_id long, embedding array<double>, x string, key string, rows string"
    rows = spark.createDataFrame([(*r, "?", "?", "?") for r in bad + good], kind)
    got = whitening.whiten(rows).collect()
    assert sorted(repr(r["vec_id"]) for r in got) == sorted(repr(k) for k, _ in good)
    assert {r["n"] for r in got} == {12} and {len(r["whitened"]) for r in got} == {3}
    assert max(r["identity_error"] for r in got) < 1e-10
    one = whitening.whiten(rows.filter("vec_id = 3")).collect()    # one distinct vector: no component
    assert [(r["deviation"], r["whitened"]) for r in one] == [(0, [])]
    assert whitening.whiten(rows.filter("vec_id between 90 and 94")).collect() == []
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)], "vec_id long, embedding array<double>")
    assert {len(r["whitened"]) for r in whitening.whiten(flat).collect()} == {1}


def test_whitening_of_large_entries(spark):
    """Exact deviations near the end of a long, and an error beyond it."""
    rows = [(i, [1e6 * i, -3e5]) for i in range(4)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    _, dev, _, _ = plain_whitening([v for _, v in rows], 1)
    assert {r["vec_id"]: r["deviation"] for r in got} == dict(enumerate(dev))
    huge = spark.createDataFrame([(i, [1e9 * i]) for i in range(4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="(?i)too large|overflow|too big"):
        whitening.whiten(huge).collect()


@pytest.mark.parametrize("shape", ["flat", "repeated", "steep"])
def test_filtered_iteration_finds_the_leading_vectors(shape):
    rng = np.random.default_rng(8)
    e = {"flat": np.linspace(2, 1, 120), "repeated": np.repeat([3.0, 2.0, 1.0], 40),
         "steep": 0.7 ** np.arange(120)}[shape]
    q = np.linalg.qr(rng.standard_normal((120, 120)))[0]
    v = q * e @ q.T
    values, vectors, residual = whitening.leading(lambda b: v @ b, 120, 16)
    assert np.abs(values - e[:16]).max() < 1e-12 * e[0]
    assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * e[0] and residual < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-13
