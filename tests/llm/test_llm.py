"""Training-data operators: SQL where it can express them, else brute force on small tables.

Every operator also gets nulls, empty texts, repeated rows, empty tables and clashing columns.
"""

from __future__ import annotations

import gzip
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rasterloom.llm import ann, dedup, jaccard, licenses, mixing, orc_tokens, packing, queries, quotes, tokens, toxicity, warc
from rasterloom.scratch import shared_dir

from ..conftest import SF_DIR, rows

ORACLE = queries.oracle_sql()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "a b c d e f g h", "en", "s1", 1), (2, "A b c d e f g h", "en", "s1", 1), (2, "A b c d e f g h", "en", "s1", 1), (3, None, None, None, None), (4, "", "de", "", 0),
    (None, "a b c d e f g h i", "en", "s2", 1), (5, "x " * 30_000, "fr", "s1", 1), (6, "one two", None, "s1", 1), (7, "one two", "es", "s3", 1), (8, "Über, İx. 1.5! it's", "en", "s1", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd rows with extra columns whose names operators might use."""
    return spark.createDataFrame(ODD, DOCS).withColumns({c: F.lit(0) for c in ("id", "t", "h", "p", "cls", "n", "copies", "whole", "start")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, same):
    same(queries.queries()[name], ORACLE[name])


def words(text: str | None) -> list[str]:
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def shingles(text: str | None) -> set:
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(pairs: list[tuple[int, str | None]]) -> dict[int, int]:
    up = {i: i for i, _ in pairs}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    sets = {i: shingles(t) for i, t in pairs}
    for a, b in combinations(sorted(up), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            one, two = root(a), root(b)
            up[max(one, two)] = min(one, two)
    return {i: root(i) for i in up}


@pytest.mark.parametrize("chunk", [2, 256])
def test_jaccard_against_brute_force(spark, chunk):
    rng = np.random.default_rng(0)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(vocabulary, 60))
    texts = []
    for _ in range(12):
        base = list(rng.choice(vocabulary, int(rng.integers(40, 200))))
        for _ in range(int(rng.integers(1, 8))):
            edit = base.copy()
            for at in rng.integers(0, len(edit), int(rng.integers(0, 5))):
                edit[at] = str(rng.choice(vocabulary))
            texts.append(" ".join(edit + (passage if rng.random() < 0.5 else [])))
    pairs = list(enumerate([*texts, "a b c", "A B  c", "", None]))
    got = jaccard.jaccard_components(spark.createDataFrame(pairs, "doc_id long, text string"), chunk_classes=chunk).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(pairs)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(shingles(t)) for i, t in pairs}


def test_jaccard_when_many_meet(spark, monkeypatch):
    """Keys with more members than sketches are compared for lose nothing."""
    monkeypatch.setattr(jaccard, "SKETCH_RUN", 3)
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(60)]
    pairs = []
    for i in range(30):
        edit = base.copy()
        for at in rng.integers(0, 60, int(rng.integers(0, 4))):
            edit[at] = f"x{rng.integers(0, 9)}"
        pairs.append((i, " ".join(edit)))
    got = jaccard.jaccard_components(spark.createDataFrame(pairs, "doc_id long, text string"), chunk_classes=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(pairs)


def test_jaccard_links_across_sketch_widths(spark):
    """Of three nested sets the middle one links with both others, the widest by another sketch width."""
    pairs, prefix = [], "abcdefghijklmnopqrstuvwxyz"
    for family in range(40):
        base = [f"{prefix[family % 26]}{family}x{k}" for k in range(79)]
        pairs += [(3 * family + k, " ".join(base[:n])) for k, n in enumerate((54, 64, 79))]
    sets = [np.sort(np.random.default_rng(s).integers(0, 2**63, 75).astype(np.uint64)) for s in range(20)]
    for s in sets:
        nested = [s[:50], s[:60], s]
        assert jaccard._may_link([jaccard._sketch(x) for x in nested], np.array([50, 60, 75]), 75).all()
    got = jaccard.jaccard_components(spark.createDataFrame(pairs, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(pairs)


def test_jaccard_of_frequent_shingles(spark):
    """Texts of little else than a passage that all have: what they share are frequent shingles only."""
    rng = np.random.default_rng(2)
    passage = [f"p{i}" for i in range(90)]
    pairs = []
    for i in range(80):
        a, b = sorted(rng.integers(0, 91, 2).tolist())
        pairs.append((i, " ".join(passage[a:b] + [f"own{i}x{k}" for k in range(int(rng.integers(0, 4)))])))
    pairs += [(100 + i, " ".join(passage)) for i in range(30)]
    table = spark.createDataFrame(pairs, "doc_id long, text string").repartition(7)
    heavy = jaccard.frequent_shingles(table.select(F.col("text").alias("t")), 5)
    scanned = jaccard._scan(table.select(F.col("doc_id").alias("id"), F.col("text").alias("t")), heavy, shared_dir(spark), 5, 75)
    assert scanned.where("size(late) > 0").count() > 30
    late = scanned.select(F.explode("late").alias("token"), "n", "cls").persist()
    assert rows(jaccard._meeting(late)) == rows(jaccard._meeting_often(late))
    got = jaccard.jaccard_components(table).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(pairs)


def test_jaccard_odd_rows(docs, none):
    got = {r["doc_id"]: r for r in jaccard.jaccard_components(docs).collect()}
    assert len(got) == 9 and got[3]["component_id"] == 3 and got[4]["n_shingles"] == 0
    assert got[2]["component_id"] == 1 and got[7]["component_id"] == 6 and got[5]["n_shingles"] == 1
    assert jaccard.jaccard_components(none).count() == 0
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5, 6, 8]
    assert jaccard.one_of_each(none).count() == 0


def test_one_row_of_each_component_stays(spark):
    """Rows are told apart where identifiers repeat or are missing: no text is lost, no copy stays."""
    a, b, c = ("one two three four five six", "red blue green black white", "lone words")
    table = spark.createDataFrame([(1, a, 0), (5, b, 1), (5, a, 2), (None, a, 3), (None, c, 4), (7, c, 5), (7, c, 6), (8, "", 7), (8, "", 8), (9, None, 9)], "doc_id long, text string, _row long")
    kept = jaccard.one_of_each(table)
    assert kept.columns == table.columns
    got = sorted((r["text"] or "", r["doc_id"]) for r in kept.collect())
    assert got == [("", 8), ("", 8), ("", 9), (c, 7), (a, 1), (b, 5)]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_dedup_odd_rows(docs, none, keep):
    got = dedup.exact_duplicates(docs, keep=keep).collect()
    assert len(got) == 10 and sum(r["kept"] for r in got) == 7
    one = next(r for r in got if r["doc_id"] == 6)
    assert (one["keep_id"], one["group_size"], one["kept"]) == ((6, 2, True) if keep == "smallest" else (7, 2, False))
    assert dedup.exact_duplicates(none).count() == 0
    kept = dedup.distinct_texts(docs, keep=keep)
    assert kept.columns == docs.columns and kept.count() == 7
    dotted = dedup.distinct_texts(docs.withColumnRenamed("p", "a.b"), keep=keep)
    assert "a.b" in dotted.columns and dotted.count() == 7


def test_dedup_hot_text(spark):
    many = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    got = dedup.exact_duplicates(many, keep="largest")
    assert got.where("kept").count() == 5000 - 1667 + 1
    assert [tuple(r) for r in got.where("doc_id % 3 = 0").select("keep_id", "group_size").distinct().collect()] == [(4998, 1667)]


def test_tokens_equal_the_library(spark):
    from tokenizers import Tokenizer
    import pyarrow as pa

    odd = ["", "a", "A.", "Über.", "x  y", "it's. don't, 'tis", "1.5, 2.", "end.. a.", "<|endoftext|>. <|startoftext|>", "hello <|endoftext|> world", "a<|endoftext|>b\n<|ENDOFTEXT|>", "<|startoftext|>", "<|endof text|>", "a\n b.\nc,", "q.!", "word.\x01", " a.", "ab;c:", "a  b."]
    texts = odd + [r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        plain = Tokenizer.from_file(queries.vocabulary(name))
        want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
        ids, counts = tokens.WordEncoder(queries.vocabulary(name), memory=3000).encode(pa.array(texts))
        assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_words_of_letters_are_merged_by_the_model():
    """Plain words skip the normaliser and the pre-tokenizer; their ids are the library's."""
    import pyarrow as pa

    words = ["a", "I", "word", "Unseenly", "tokenizations", "zq" * 40, "don't", "Über", "x1", "s"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = tokens.WordEncoder(queries.vocabulary(name))
        want = [encoder._plain([f"q {w} q"])[0] for w in words]
        through, whole = [], encoder._plain
        encoder._plain = lambda texts: through.extend(texts) or whole(texts)
        ids, counts = encoder.encode(pa.array([f"q {w} q" for w in words]))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
        assert not any("nseenly" in t for t in through) and any("don't" in t for t in through)


def check_packing(got, expected: dict, capacity: int) -> int:
    """Whole documents, right checksums, gapless sequences within capacity; the number of sequences."""
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(expected)
    for d, ids in expected.items():
        at = 0
        for k, r in enumerate(sorted(by_doc[d], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at)
            at += r["length"]
            assert zlib.crc32(np.array(ids[r["start"] : at], "<u4").tobytes()) == r["ids_crc32"]
        assert at == len(ids) and (len(ids) > capacity or len(by_doc[d]) == 1)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_seq)


def ids_of(name: str, pairs, end: int) -> dict:
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.vocabulary(name))
    return {i: plain.encode(t or "", add_special_tokens=False).ids + [end] for i, t in pairs}


def test_packing_query(spark):
    expected = ids_of("byte_bpe_50k.json", [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()], 2)
    used = check_packing(queries.op2_best_fit_packing(spark, SF_DIR).collect(), expected, 1024)
    assert used <= 1.02 * -(-sum(map(len, expected.values())) // 1024) + 1


def test_packing_odd_rows(docs, none):
    one = docs.where("doc_id <> 2 and doc_id is not null")
    expected = ids_of("byte_bpe_50k.json", [(r["doc_id"], r["text"]) for r in one.collect()], 2)
    check_packing(packing.pack_documents(one, queries.vocabulary("byte_bpe_50k.json"), 2, 64, block_items=20).collect(), expected, 64)
    assert packing.pack_documents(docs, queries.vocabulary("byte_bpe_50k.json"), 2, 1024).select("doc_id").distinct().count() == 9
    assert packing.pack_documents(none, queries.vocabulary("byte_bpe_50k.json"), 2, 1024).count() == 0


def test_crossover_beats_best_fit():
    """Sizes of about three items a bin, where decreasing best fit leaves room in many bins."""
    rng = np.random.default_rng(0)
    won = 0
    for _ in range(5):
        lengths = np.sort(rng.integers(200, 520, 240))[::-1].astype(np.int64)
        plain = np.full(len(lengths), -1, np.int64)
        packing._best_fit(lengths.tolist(), list(range(len(lengths))), plain, [], 1024)
        evolved = packing._evolve(lengths, [], 1024, 60, 8, rng)[0]
        assert np.bincount(evolved, lengths).max() <= 1024 and len(np.unique(evolved)) == evolved.max() + 1
        assert evolved.max() <= plain.max()
        won += int(plain.max() - evolved.max())
    assert won > 0


def test_packing_by_default_beats_best_fit(spark):
    """What ``pack`` does unless told otherwise is enough of a search to save sequences."""
    won = 0
    for seed in range(3):
        lengths = np.sort(np.random.default_rng(seed).integers(200, 520, 240))[::-1].astype(np.int64)
        plain = np.full(len(lengths), -1, np.int64)
        packing._best_fit(lengths.tolist(), list(range(len(lengths))), plain, [], 1024)
        got = packing.pack(spark.createDataFrame(list(enumerate(lengths.tolist())), "uid long, length long"), 1024).collect()
        assert sorted(r["uid"] for r in got) == list(range(240))
        won += int(plain.max()) + 1 - len({r["sequence_id"] for r in got})
    assert won > 2  # five generations of four packings win two


def test_orc_round_trip(spark, docs, none):
    expected = ids_of("word_bpe_49k.json", [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()], 1)
    at = 0
    for r in queries.op10_orc_tokens(spark, SF_DIR).orderBy("doc_id").collect():
        ids = expected.pop(r["doc_id"])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert not expected
    for table, n in ((docs, 10), (none, 0)):
        path = shared_dir(spark)
        orc_tokens.write_tokens(table, path, queries.vocabulary("word_bpe_49k.json"), 1)
        assert orc_tokens.read_tokens(spark, path).count() == n


def test_orc_layout(spark):
    """Stripes, run-length encoded ids, row indexes and Bloom filters on identifiers are in the files."""
    path = f"{shared_dir(spark)}/tokens"
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select((F.col("doc_id") * 100).alias("doc_id"), "text")
    many = table.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(99)))).select((F.col("doc_id") + F.col("k")).alias("doc_id"), "text")
    orc_tokens.write_tokens(many, path, queries.vocabulary("word_bpe_49k.json"), 1, stripe_bytes=1 << 16)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = [x.getPath() for x in folder.getFileSystem(conf).listStatus(folder) if x.getPath().getName().startswith("part-")]
    spans, stripes = [], 0
    for file in files:
        reader = jvm.org.apache.orc.OrcFile.createReader(file, jvm.org.apache.orc.OrcFile.readerOptions(conf))
        assert reader.getRowIndexStride() == 1000
        found = reader.rows()
        for stripe in reader.getStripes():
            footer = found.readStripeFooter(stripe)
            kinds = {(s.getColumn(), s.getKind().toString()) for s in footer.getStreamsList()}
            assert (1, "BLOOM_FILTER_UTF8") in kinds and (1, "ROW_INDEX") in kinds
            # columns: the row, doc_id, part_start, n_tokens, ids and the ids' elements
            assert {footer.getColumns(c).getKind().toString() for c in (1, 2, 3, 5)} == {"DIRECT_V2"}
        for s in reader.getStripeStatistics():
            ids = s.getColumnStatistics()[1]
            spans.append((ids.getMinimum(), ids.getMaximum()))
        stripes += reader.getStripes().size()
        found.close()
    assert stripes > len(files)
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])), "stripes' identifiers don't overlap"
    one = orc_tokens.read_tokens(spark, path).where("doc_id = 12345")
    assert one.count() == 1
    assert "EqualTo(doc_id,12345)" in one._jdf.queryExecution().executedPlan().toString()


def test_orc_texts_of_one_identifier(spark):
    """Texts that share an identifier are dealt to several files and keep their places."""
    path = f"{shared_dir(spark)}/tokens"
    table = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small parts stay apart
    try:
        orc_tokens.write_tokens(table, path, queries.vocabulary("word_bpe_49k.json"), 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = orc_tokens.read_tokens(spark, path)
    assert got.count() == 4000
    assert spark.read.orc(path).select(F.input_file_name().alias("f")).distinct().count() > 1
    places = got.orderBy("start").select("start", "n_tokens").collect()
    assert [r["start"] for r in places] == [0, *np.cumsum([r["n_tokens"] for r in places])[:-1].tolist()]


def test_toxicity_on_held_out_rows(spark, docs, none):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = queries.op4_toxicity(spark, SF_DIR)
    assert found.where("score is null or score < 0 or score > 1 or predicted <> int(score >= 0.5)").count() == 0
    judged = found.join(labels, "doc_id").where("held_out and toxic is not null").collect()
    assert judged
    assert np.mean([r["predicted"] == r["toxic"] for r in judged]) >= 0.8
    model = toxicity.fit(docs, spark.createDataFrame([(1, 1), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int"))
    assert toxicity.score(docs, model).count() == 10 and toxicity.score(none, model).count() == 0
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    assert toxicity.fit(none, labels.limit(0)).bias < 0


def test_toxicity_learns_a_pair(spark):
    """Neither term alone is toxic, both together are."""
    rng = np.random.default_rng(2)
    pairs = [(i, " ".join(["plain", "words"] + ["insult"] * (a := int(rng.random() < 0.5)) + ["group"] * (b := int(rng.random() < 0.5))), a & b) for i in range(800)]
    table = spark.createDataFrame(pairs, "doc_id long, text string, toxic int")
    model = toxicity.fit(table, table.select("doc_id", "toxic"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(table, model).collect()}
    assert np.mean([(scores[i] >= 0.5) == y for i, _, y in pairs]) > 0.98


def test_toxicity_learns_exclusive_or(spark):
    """Each term alone is toxic, both together or none are not: no sum of two weights tells that."""
    rng = np.random.default_rng(4)
    draws = rng.random((1200, 2)) < 0.5
    pairs = [(i, " ".join(["plain"] + ["insult"] * a + ["group"] * b), a ^ b) for i, (a, b) in enumerate(draws.astype(int).tolist())]
    table = spark.createDataFrame(pairs, "doc_id long, text string, toxic int")
    right = {}
    for k in (0, 4):
        model = toxicity.fit(table, table.select("doc_id", "toxic"), k=k, min_chi2=0.0, epochs=400)
        scores = {r["doc_id"]: r["score"] for r in toxicity.score(table, model).collect()}
        right[k] = np.mean([(scores[i] >= 0.5) == y for i, _, y in pairs])
    assert right[4] > 0.98 and right[0] < 0.8, right


def test_toxicity_does_not_depend_on_the_sample(spark):
    """A text that is toxic one time in three is clean, however much of a class is drawn."""
    rng = np.random.default_rng(3)
    rate = {"calm": 0.02, "rude": 0.33, "vile": 0.95}
    pairs = [(i, f"plain {w}", int(rng.random() < rate[w])) for i, w in enumerate(rng.choice(list(rate), 4000, p=[0.8, 0.15, 0.05]).tolist())]
    table = spark.createDataFrame(pairs, "doc_id long, text string, toxic int")
    found = []
    for max_rows in (500, 12_000):
        model = toxicity.fit(table, table.select("doc_id", "toxic"), max_rows=max_rows)
        found.append({r["text"]: r["score"] for r in toxicity.score(table.select("text").distinct(), model, id_col="text").collect()})
    few, all_ = found
    assert {w: s >= 0.5 for w, s in few.items()} == {w: s >= 0.5 for w, s in all_.items()} == {"plain calm": False, "plain rude": False, "plain vile": True}


def test_nearest_against_brute_force(spark):
    found = queries.op5_nearest_vectors(spark, SF_DIR).collect()
    table = [(r["vec_id"], np.array(r["embedding"], float)) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    m, ids = np.stack([v for _, v in table]), np.array([i for i, _ in table])
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for i, v in table:
        if i % 20 == 0:
            s = m @ v
            order = [k for k in np.lexsort((ids, -s)) if ids[k] != i][:20]
            mine = sorted(got[i])
            assert [r for r, _, _ in mine] == list(range(1, 21))
            assert all(abs(x - float(m[np.flatnonzero(ids == j)[0]] @ v)) < 1e-9 for _, j, x in mine)
            hits += len({j for _, j, _ in mine} & set(ids[order].tolist()))
    assert hits >= 0.9 * 20 * len(got)


def test_nearest_of_clusters(spark, monkeypatch):
    """Where vectors have structure the windows are narrow, and a block asked by many is dealt in parts."""
    monkeypatch.setattr(ann, "CHUNK", 5)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(120, 32))
    m = np.repeat(centres, 50, 0) + rng.normal(0, 0.1, (6000, 32))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    settings = []
    calibrate = ann._calibrate
    monkeypatch.setattr(ann, "_calibrate", lambda *a: settings.append(calibrate(*a)) or settings[0])
    got = {}
    for r in ann.nearest(table, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q, mine in got.items():
        s = m @ m[q]
        s[q] = -np.inf
        hits += len(mine & set(np.argsort(-s)[:20].tolist()))
    used, reach = settings[0]
    assert len(got) == 300 and hits >= 0.9 * 20 * 300
    assert used * (2 * reach + 1) <= 16, f"{used} curves, {reach} blocks to each side of 32"


def test_nearest_odd_rows(spark):
    vectors = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [0.5, 0.5]), (7, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("x", F.lit(1))
    found = ann.nearest(df, F.col("vec_id") % 20 == 0, k=5).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in found] == [(0, 1), (0, 6)]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_licenses(spark, docs, none):
    notice = licenses.TEMPLATES["mit-notice"]
    changed = notice.replace("free of charge, ", "").replace("the Software", "this Program", 1)
    table = spark.createDataFrame([(1, f"über x. {notice} y"), (2, changed), (3, "no notice here"), (4, None)], "doc_id long, text string")
    found = {(r["doc_id"], r["license"]): r for r in licenses.scan_licenses(table).collect()}
    whole = found[1, "mit-notice"]
    assert whole["coverage"] == 1.0 and f"über x. {notice} y"[whole["start_char"] : whole["end_char"]] == notice.rstrip(".")
    assert 0.8 < found[2, "mit-notice"]["coverage"] < 1.0 and not [k for k in found if k[0] > 2]
    assert licenses.scan_licenses(docs).count() == 0 and licenses.scan_licenses(none).count() == 0


def test_licenses_in_a_row(spark):
    """Notices that follow each other closely are found one by one, changed short lines too."""
    lines = {n: t for n, t in licenses.TEMPLATES.items() if n.endswith("-line")}
    pairs = [(i, " ".join([t] * 100)) for i, t in enumerate(lines.values())]
    notice = licenses.TEMPLATES["isc-notice"]
    pairs += [(10, "with or without fee is hereby granted, " * 40 + notice + " with or without fee is hereby granted" * 40), (11, "a Released under this MIT License. b")]
    found = licenses.scan_licenses(spark.createDataFrame(pairs, "doc_id long, text string")).collect()
    for i, (name, line) in enumerate(lines.items()):
        mine = sorted((r["start_word"], r["end_word"], r["coverage"]) for r in found if (r["doc_id"], r["license"]) == (i, name))
        n = mine[0][1]
        assert mine == [(k * n, k * n + n, 1.0) for k in range(100)], name
    whole = [r for r in found if r["doc_id"] == 10 and r["coverage"] == 1.0]
    assert [(r["license"], pairs[4][1][r["start_char"] : r["end_char"]]) for r in whole] == [("isc-notice", notice.rstrip("."))]
    assert [(r["license"], r["coverage"]) for r in found if r["doc_id"] == 11] == [("mit-line", 0.8)]


def test_quotes_build_a_thread(spark):
    turns = [
        (1, 0, "a", "first line\nsecond thought"), (1, 1, "b", "another matter"), (1, 2, "c", "A wrote:\n> First  line\nI agree"), (1, 3, "a", "> I agree\n>> first line\nthanks"),
        (1, 4, "b", None), (1, 4, "b", ""), (2, 5, "a", ">>> never said\nx"), (None, 1, "a", "x"), (2, None, "a", "x"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({"c": F.lit(1), "t": F.lit(2), "h": F.lit(3)})
    found = [(r["conv_id"], r["turn"], r["reply_to"], r["linked_by"], r["quoted_lines"], r["depth"], r["text"]) for r in quotes.link_quotes(df).orderBy("conv_id", "turn").collect()]
    assert found == [
        (1, 0, None, "start", 0, 0, "first line\nsecond thought"), (1, 1, 0, "previous", 0, 1, "another matter"), (1, 2, 0, "quote", 1, 1, "I agree"),
        (1, 3, 2, "quote", 1, 2, "thanks"), (1, 4, 3, "previous", 0, 3, ""), (1, 4, 3, "previous", 0, 3, ""), (2, 5, None, "start", 0, 0, "x"),
    ]
    assert quotes.link_quotes(df.limit(0)).count() == 0


def brute_origin(turns: list[str], at: int) -> tuple:
    """The turn that ``turns[at]`` quotes and how many lines, straight from the rule."""
    def lines(text):
        out = []
        for line in text.split("\n"):
            level, rest = 0, line
            while rest.lstrip(" \t").startswith(">"):
                level, rest = level + 1, rest.lstrip(" \t")[1:]
            norm = " ".join(rest.replace("\t", " ").replace("\r", " ").split(" ")).lower().strip(" ")
            while "  " in norm:
                norm = norm.replace("  ", " ")
            if norm:
                out.append((level, norm))
        return out

    own = [[n for v, n in lines(t) if v == 0] for t in turns[:at]]
    bears = lambda p: max((i for i, o in enumerate(own) if any(o[k : k + len(p)] == p for k in range(len(o) - len(p) + 1))), default=None)
    mine = lines(turns[at])
    for level in sorted({v for v, _ in mine if v}):
        runs, last = [], False
        for v, n in mine:
            if v == level:
                runs = runs if last else [*runs, []]
                runs[-1].append(n)
            last = v == level
        for parts in (runs, [[n] for r in runs for n in r]):
            votes = {}
            for p in parts:
                if bears(p) is not None:
                    votes[bears(p)] = votes.get(bears(p), 0) + len(p)
            if votes:
                n, origin = max((n, o) for o, n in votes.items())
                return origin, n
    return None, 0


QUOTING = ["hello\nworld", "hello", "> hello\n> world\nok", "> ok", "a\nb\nc", "a\nb", "b\nc", "> a\n> b\n> c\nyes", ">> hello\n> yes\n>> world\n> no such line", "> a\n> x\n> c"]


def test_quotations_link_by_whole_passages(spark, duck):
    """A passage goes to the message that holds all of it, even if later ones repeat its lines."""
    rng = np.random.default_rng(6)
    talks = {0: QUOTING}
    for c in range(1, 25):
        turns = []
        for t in range(12):
            body = [f"line {rng.integers(6)}" for _ in range(rng.integers(1, 5))]
            for _ in range(int(rng.integers(0, 3)) if t else 0):
                source = turns[int(rng.integers(t))].split("\n")
                at = int(rng.integers(len(source)))
                body = [*("> " + x for x in source[at : at + int(rng.integers(1, 5))]), *body]
            turns.append("\n".join(body))
        talks[c] = turns
    rows = [(c, t, "a", x) for c, turns in talks.items() for t, x in enumerate(turns)]
    found = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {(r["conv_id"], r["turn"]): (r["reply_to"] if r["linked_by"] == "quote" else None, r["quoted_lines"]) for r in found.collect()}
    assert got == {(c, t): brute_origin(talks[c], t) for c, t, _, _ in rows}
    assert got[0, 2] == (0, 2) and got[0, 7] == (4, 3)
    made = duck.cursor()
    made.execute("CREATE TEMP TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    made.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = made.execute(ORACLE["op7_quote_threads"])
    names = [d[0] for d in want.description]
    assert sorted(repr(sorted(zip(names, r))) for r in want.fetchall()) == sorted(repr(sorted(r.asDict().items())) for r in found.collect())


@pytest.mark.parametrize(
    "text, own",
    [
        ("Here is what he wrote:\nthe poem itself", "Here is what he wrote:\nthe poem itself"), ("Ann wrote:\n\n > hi\nyes", "yes"), ("Ann wrote: \r\n> hi\r\nyes", "yes"),
        ("she wrote:\nBob wrote:\n> hi", "she wrote:"), ("x wrote:", "x wrote:"), ("> Ann wrote:\n>> hi\n\n> no\nend wrote:\n", "end wrote:"),
    ],
)
def test_own_text(spark, duck, text, own):
    """Only a line that announces a quotation goes with it, in the SQL too."""
    table = spark.createDataFrame([(1, 0, "a", text)], "conv_id long, turn long, role string, text string")
    assert [r["text"] for r in quotes.link_quotes(table).collect()] == [own]
    con = duck.cursor()
    con.execute("CREATE OR REPLACE TEMP TABLE one AS SELECT 1 AS conv_id, 0 AS turn, 'a' AS role, $1 AS text", [text])
    assert [r[3] for r in con.sql(ORACLE["op7_quote_threads"].replace("FROM conversations", "FROM one")).fetchall()] == [own]


def test_warc_files(spark, tmp_path):
    body = "<p>" + "x" * 200
    pages = [(3, "http://a", body), (1, "http://b\r\nX: y", body), (2, None, "tiny"), (4, "http://d", "tiny"), (5, "http://e", None), (6, "http://f", "ü" * 60), (6, "http://f", "ü" * 60), (None, "http://g", "z")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"payload": F.lit(1), "shard": F.lit(2)})
    manifests = []
    for name, parts in (("one", 1), ("two", 5)):
        path = f"file://{tmp_path}/{name}"
        manifests.append(rows(warc.write_archive(df.repartition(parts), path)))
        back = {(r["page_id"], r["record_type"]): r for r in warc.read_archive(spark, path).collect()}
        assert back[3, "revisit"]["refers_to"] == 1 and back[1, "response"]["url"] == "http://b%0D%0AX: y" and bytes(back[1, "response"]["payload"]).decode() == body
        assert back[2, "response"]["url"] is None and back[4, "response"]["refers_to"] is None and back[5, "response"]["payload_bytes"] == 0
        assert back[6, "revisit"]["refers_to"] == 6 and back[None, "response"]["payload_bytes"] == 1
    assert manifests[0] == manifests[1]
    first = sorted((tmp_path / "one").glob("*.warc.gz"))[0]
    assert gzip.decompress(first.read_bytes()).startswith(b"WARC/1.1\r\n")
    assert warc.read_archive(spark, f"file://{tmp_path}/one", payloads=False).count() == 8
    warc.write_archive(df.limit(0), f"file://{tmp_path}/none")
    assert warc.read_archive(spark, f"file://{tmp_path}/none").count() == 0


def test_mixing_shares_shortage_among_siblings(spark, none, docs):
    """Budgets follow the weights; what a source lacks goes to its sibling first."""
    table = [(i, "w " * 10, "en", "s0" if i < 5 else "s4", 0) for i in range(100)] + [(i, "w " * 10, "de", "s1", 0) for i in range(100, 200)]
    df = spark.createDataFrame(table, DOCS)
    tree = {"lang": F.col("lang"), "source": F.col("source")}
    found = mixing.mix_report(df, tree, {"lang": {"en": 3}}, share=0.5, max_epochs=1)
    got = {(r["lang"], r["source"]): r["n"] for r in found.groupBy("lang", "source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("n")).collect()}
    assert got[("en", "s0")] == 50 and got[("en", "s4")] + 50 in range(740, 751) and got[("de", "s1")] in range(240, 251)
    assert mixing.mix(df, tree, {"lang": {"en": 3}}, share=0.5, max_epochs=1).columns == df.columns
    assert mixing.mix_report(none, queries.tree(), {}).count() == 0 and mixing.mix(none, queries.tree(), {}).count() == 0
    assert mixing.mix_report(docs, queries.tree(), {"lang": queries.LANGUAGE_WEIGHTS}).count() == 10


@pytest.mark.parametrize("bits", [(1,), (1, 3), (4, 30)])
def test_mixing_does_not_depend_on_its_buckets(spark, monkeypatch, bits):
    """Coarse buckets leave much to sort, fine ones nothing; the selection is the same."""
    df = spark.createDataFrame([(i, "w " * (i % 9), "en", f"s{i % 3}", 0) for i in range(400)], DOCS)
    select = lambda: rows(mixing.mix_report(df, {"source": F.col("source")}, {"source": {"s0": 5}}, share=0.6))
    want = select()
    monkeypatch.setattr(mixing, "BUCKET_BITS", bits)
    assert select() == want and any("('copies', 1)" in r for r in want) and any("('copies', 0)" in r for r in want)


def test_pipeline_stages_on_odd_rows(spark, docs, none):
    """Nulls, empty and long texts, repeated rows, clashing columns and an empty table pass every stage."""
    docs = docs.withColumn("a.b", F.lit("dot"))
    given = Counter(map(repr, docs.collect()))
    texts = {t or "" for _, t, *_ in ODD}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF_DIR)
        found = got.collect()
        assert stage(spark, none, SF_DIR).count() == 0, name
        if name == "best-fit packing":
            assert Counter(r["doc_id"] for r in found if r["piece"] == 0) == Counter(r[0] for r in ODD)
            continue
        assert got.columns == docs.columns, name
        kept = Counter(map(repr, found))
        assert set(kept) <= set(given), name  # rows as they were, all columns
        if name == "exact dedup":
            assert len(found) == len(texts) and {r["text"] or "" for r in found} == texts
        elif name == "toxicity":
            model = toxicity.fit(docs, queries.table(spark, SF_DIR, "labels"))
            clean = {r["text"] or "" for r in toxicity.score(docs.select("doc_id", "text"), model).join(docs.select("doc_id", "text"), "doc_id").where("score < 0.5").collect()}
            assert sum(kept.values()) == sum(1 for _, t, *_ in ODD if (t or "") in clean | ({"a b c d e f g h i"} & {r["text"] for r in found}))
        elif name == "n-gram jaccard join":
            assert {r["text"] or "" for r in found} >= {"one two", "x " * 30_000} and sum(kept.values()) < len(ODD) and max(kept.values()) == 1
        else:
            assert max(kept[r] - 2 * given[r] for r in kept) <= 0  # no row oftener than two epochs


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF_DIR).persist()
        assert docs.columns == before.columns and docs.count() > 0, name
        if name == "exact dedup":
            assert docs.count() == before.select("text").distinct().count()
        if name == "n-gram jaccard join":
            pairs = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert {r["doc_id"] for r in docs.collect()} == set(brute_components(pairs).values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    n = packed.agg(F.sum("length")).first()[0]
    expected = ids_of("byte_bpe_50k.json", [(k, r["text"]) for k, r in enumerate(docs.collect())], 2)
    assert n == sum(map(len, expected.values()))
