"""Pieces, the alignment of two tokenizers, and whitening, each against the library or brute force."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rasterloom.llm import alignment, pieces, queries, whitening

from ..conftest import SF_DIR

MODEL, WORDS = queries.vocabulary("piece_bpe_32k.model"), queries.vocabulary("byte_bpe_50k.json")
DOCS = "doc_id long, text string, id int, a string, pair string, `row.x` int"
ODD = [
    None, "", " ", "   ", "\n", "a", "a b", "a  b", " a", "a ", "one\ntwo\n\n three", "▁", "x ▁▁ y", "日本語 テキスト 😀", "é é", "<s> </s> <0x41>", "<|endoftext|> b",
    "a\x00 b", "1,234.5! end.", "word " * 3000, "z" * 5000, " " * 77, "Ünï ßcode…", "same text", "same text",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "q", "p", 0) for i, t in enumerate(ODD)] + [(None, "no id", 1, "q", "p", 0), (3, "again", 1, "q", "p", 0)]
    return spark.createDataFrame(rows, DOCS)


def test_pieces_equal_the_library(library):
    rng, encoder = random.Random(4), pieces.PieceEncoder(MODEL, memory=5000)
    known = [p for p in encoder.pieces if p]
    texts = [t or "" for t in ODD] + ["".join(rng.choices("abcde ", k=rng.randint(1, 60))) for _ in range(2000)]
    texts += ["".join(rng.choices("etaoin shr,.'\n012-_=AÉé▁", k=rng.randint(1, 80))) for _ in range(3000)]
    texts += ["".join(rng.choices(known, k=rng.randint(1, 9))).replace("▁", " ") for _ in range(5000)]
    texts += ["".join(rng.choices(known, k=2000)).replace("▁", ""), "ab" * 20_000, "=" * 20_000]
    ids, counts = encoder.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library.encode(texts)


def test_neighbours_fit_exactly_where_merging_keeps_them(library):
    """A sequence is the encoding just when all its neighbours fit."""
    encoder, rng = pieces.PieceEncoder(MODEL), random.Random(2)
    short = [i for i, t in enumerate(encoder.pieces) if t and t.isascii() and t.isalpha() and len(t) < 4]
    for _ in range(2000):
        pair = rng.choices(short, k=2)
        text = "".join(encoder.pieces[i] for i in pair)
        assert encoder.fits(*pair) == (encoder.merged(text) == [encoder.pieces[i] for i in pair])
        assert [encoder.pieces[i] for i in encoder.part(text)] == encoder.merged(text)


def test_neighbours_of_any_length_fit_where_merging_keeps_them():
    """What two pieces' own merges tell about their border is what merging both again gives, without doing so."""
    encoder, rng = pieces.PieceEncoder(MODEL), random.Random(5)
    every = [i for i, t in enumerate(encoder.pieces) if t]
    pairs = [(-1, i) for i in rng.choices(every, k=2000)] + [tuple(rng.choices(every, k=2)) for _ in range(5000)]
    want = [encoder.merged("".join(encoder.pieces[i] for i in p if i >= 0)) == [encoder.pieces[i] for i in p if i >= 0] for p in pairs]
    encoder.merged = None
    assert [encoder.fits(*p) for p in pairs] == want and any(want) and not all(want)


def test_piece_query(spark, library):
    got = {r["doc_id"]: r for r in queries.op11_piece_round_trip(spark, SF_DIR).collect()}
    for r in queries.table(spark, SF_DIR, "documents").collect():
        ids = library.encode(r["text"] or "")
        want = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids))]
        mine = got.pop(r["doc_id"])
        assert [mine["n_tokens"], mine["ids_sha256"], mine["decoded_sha256"]] == [len(ids), *want]
    assert not got


def test_pieces_of_odd_rows(docs, library):
    out = pieces.decode_pieces(pieces.encode_pieces(docs, MODEL), MODEL)
    assert out.columns == ["doc_id", "ids", "decoded"] and out.count() == len(ODD) + 2
    for r, s in zip(docs.collect(), out.collect()):
        assert r["doc_id"] == s["doc_id"] and s["ids"] == library.encode(r["text"] or "") and s["decoded"] == library.decode(s["ids"])
    assert pieces.encode_pieces(docs.limit(0), MODEL).count() == 0


def test_decoding_makes_no_object_of_arrows_for_each_id(spark, library, monkeypatch):
    """an object of Arrow's for each id once cost more than decoding does."""
    rng = random.Random(6)
    known = [i for i in range(library.get_piece_size()) if not library.is_control(i)]
    rows = [None, [], *(rng.choices(known, k=300) for _ in range(2000)), [], None, [known[-1]]]
    tokens = spark.createDataFrame([], "doc_id long, ids array<int>")
    monkeypatch.setattr(type(tokens), "mapInArrow", lambda self, run, schema: run)
    run = pieces.decode_pieces(tokens, MODEL)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "ids"])
    began = time.process_time()
    batch.column(1).to_pylist()
    plain = time.process_time() - began
    took = []
    for some in (batch, batch.slice(1, len(rows) - 2), batch.slice(1)):
        began = time.process_time()
        got = list(run(iter([some])))
        took.append(time.process_time() - began)
        assert [t for b in got for t in b.column(2).to_pylist()] == [library.decode(x or []) for x in some.column(1).to_pylist()]
        assert [x for b in got for x in b.column(1).to_pylist()] == some.column(1).to_pylist()
    assert min(took) < 0.6 * plain


def brute_alignment(pairs: list[tuple]) -> list[tuple]:
    words, model = Tokenizer.from_file(WORDS), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    words.encode_special_tokens = True
    table = alignment._byte_alphabet()
    rows, counts = [], Counter()
    for key, text in pairs:
        full = (" " + (text or "")).encode()
        a = words.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        one = [bytes(table[c] for c in words.id_to_token(i)) for i in a]
        two = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, model.id_to_piece(i)) for i in b)]
        if b"".join(one) != full or b"".join(two) != full:
            a, b, one, two = [], [], [], []
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (one, two)]
        links = [(i, j) for i, x in enumerate(ends[0]) for j, y in enumerate(ends[1]) if x == y] if len(a) < 400 else [(ends[0].index(y), j) for j, y in enumerate(ends[1]) if y in set(ends[0])]
        groups, last = [], (-1, -1)
        for i, j in links:
            groups.append(",".join(map(str, a[last[0] + 1 : i + 1])) + "|" + ",".join(map(str, b[last[1] + 1 : j + 1])))
            last = (i, j)
        linked = [(a[i], b[j]) for i, j in links]
        counts.update(linked)
        rows.append((key, len(a), len(b), groups, linked))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return [
        (k, na, nb, len(g), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for k, na, nb, g, x in rows
    ]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_query(spark):
    got = queries.op12_token_alignment(spark, SF_DIR).select("doc_id", *COLUMNS).collect()
    source = queries.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == sorted(brute_alignment([tuple(r) for r in source]))


def test_groups_come_from_the_tasks_arrays(docs):
    """Groups and pairs leave the tasks as such; no higher-order function runs over them in rows."""
    some = docs.where("text is null or text = '' or length(text) < 30")
    out = alignment.align(some, WORDS, MODEL)
    assert out.columns == ["id", "n_a", "n_b", "groups", "pairs"] and "lambda" not in out._jdf.queryExecution().toString()
    got = sorted(((r["id"], r["n_a"], r["n_b"], len(r["pairs"]), hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in out.collect()), key=repr)
    assert got == sorted(((k, na, nb, n, digest) for k, na, nb, _, n, _, _, digest in brute_alignment([(r["doc_id"], r["text"]) for r in some.collect()])), key=repr)
    assert [tuple(r) for r in alignment.align(docs.where("text is null"), WORDS, MODEL).collect()] == [(0, 0, 0, "", [])]


def test_alignment_of_odd_rows(docs):
    out = alignment.align_documents(docs, WORDS, MODEL)
    order = lambda rows: sorted(rows, key=repr)
    assert order(map(tuple, out.select("doc_id", *COLUMNS).collect())) == order(brute_alignment([(r["doc_id"], r["text"]) for r in docs.collect()]))
    assert alignment.align_documents(docs.limit(0), WORDS, MODEL).count() == 0


@pytest.mark.parametrize("most", [0, 3, 1000])
def test_links_that_are_not_broadcast(spark, most):
    """Counts are the same wherever the line between frequent and rare pairs is drawn."""
    rng = np.random.default_rng(3)
    lists = [[int(a) << 32 | int(b) for a, b in zip(rng.zipf(1.6, n) % 50, rng.zipf(1.6, n) % 20)] for n in rng.integers(0, 40, 60)]
    counts = Counter(p for x in lists for p in x)
    best = {}
    for p, n in counts.items():
        best[p & 0xFFFFFFFF] = max(n, best.get(p & 0xFFFFFFFF, 0))
    got = alignment.score_links(spark.createDataFrame(list(enumerate(lists)), "row long, pairs array<long>"), broadcast_pairs=most).collect()
    assert {r["row"]: (r["n_best"], r["count_sum"]) for r in got} == {
        i: (sum(counts[p] == best[p & 0xFFFFFFFF] for p in x), sum(counts[p] for p in x)) for i, x in enumerate(lists) if x
    }


def brute_whitening(vectors: list, components: int = 16) -> tuple:
    x = [[int(np.floor(64.0 * float(c))) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), dtype=object)
    n, sums = len(fit), fit.sum(0)
    mean = np.array([s / n for s in sums], float)
    centre = fit.astype(float) - mean
    v = centre.T @ centre / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    deviation = [sum((n * a - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, (np.array(x, float) - mean) @ (axes / np.sqrt(values)), values / np.trace(v)


def test_whitening_query(spark):
    source = [r for r in queries.table(spark, SF_DIR, "embeddings").collect() if r["embedding"] is not None and all(c is not None and np.isfinite(c) for c in r["embedding"])]
    n, deviation, white, explained = brute_whitening([r["embedding"] for r in source])
    got = queries.op13_whitening(spark, SF_DIR).collect()
    assert len(got) == 16 * len(source)
    mine = {(r["vec_id"], r["component"]): r for r in got}
    table = np.array([[mine[r["vec_id"], k + 1]["whitened"] for k in range(16)] for r in source])
    assert np.abs(np.abs(table) - np.abs(white)).max() < 1e-6
    assert (np.sign(table[:, :]) * np.sign(white)).mean(0).__abs__().min() > 0.999  # one sign a component
    for r, d in zip(source, deviation):
        assert {(mine[r["vec_id"], k]["n"], mine[r["vec_id"], k]["deviation"]) for k in range(1, 17)} == {(n, d)}
    assert np.allclose([mine[source[0]["vec_id"], k + 1]["explained"] for k in range(16)], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [[float(c) for c in v] for v in rng.normal(size=(30, 3))]
    odd = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, 0, "n") for i, v in enumerate(good + odd)] + [(None, good[0], 0, "n"), (1, good[1], 0, "n"), *[(99, good[2], 0, "n")] * 50]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x int, `n.n` string")
    got = whitening.whiten(table).collect()
    assert len(got) == 3 * (30 + 52) and {r["n"] for r in got} == {30} and got[0]["identity_error"] < 1e-9
    as_stored = np.array(good, np.float32).tolist()
    n, deviation, white, _ = brute_whitening(as_stored)
    mine = {(r["vec_id"], r["component"]): r["whitened"] for r in got}
    table_of = np.array([[mine[i, k + 1] for k in range(3)] for i in range(30)])
    assert np.abs(np.abs(table_of) - np.abs(white)).max() < 1e-8
    assert whitening.whiten(table.limit(0)).count() == 0
    one = whitening.whiten(table.where("vec_id = 99")).collect()
    assert len(one) == 150 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0 for r in one)


def test_deviations_that_need_many_bits():
    big = np.array([[3_000_000_000, 1], [4_000_000_000, 0]])
    assert whitening._deviations(big) == [9 * 10**18 + 1, None]
