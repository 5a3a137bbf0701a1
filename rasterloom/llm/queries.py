"""One query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import shared_dir
from . import alignment, ann, dedup, jaccard, licenses, mixing, orc_tokens, packing, pieces, quotes, toxicity, warc, whitening

LANGUAGE_WEIGHTS = {"en": 4, "de": 2, "fr": 2, "es": 1}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tree() -> dict[str, Column]:
    """Domain, language and source; the table has no domains, so four are made of the sources."""
    digit = F.ascii(F.right(F.coalesce(F.col("source"), F.lit("")), F.lit(1)))
    return {"domain": F.concat(F.lit("domain"), F.pmod(digit, F.lit(4)).cast("string")), "lang": F.col("lang"), "source": F.col("source")}


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"), tree(), {"lang": LANGUAGE_WEIGHTS})


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2, capacity=1024)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scores = toxicity.score(docs, model)
    return scores.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op7_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op10_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tokens"
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=1)
    return orc_tokens.digests(orc_tokens.read_tokens(spark, path))


def op11_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = vocabulary("piece_bpe_32k.model")
    tokens = pieces.decode_pieces(pieces.encode_pieces(table(spark, sf_dir, "documents"), model), model)
    n = F.size("ids").cast("long").alias("n_tokens")
    return tokens.select("doc_id", n, pieces.ids_digest(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=16)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_mix_sources, op2_best_fit_packing, op3_ngram_jaccard, op4_toxicity, op5_nearest_vectors, op6_license_scan, op7_quote_threads,
        op8_warc_archive, op9_exact_dedup, op10_orc_tokens, op11_piece_round_trip, op12_token_alignment, op13_whitening,
    )
    return {f.__name__: f for f in every}


def _level(depth: int, levels: tuple[str, ...]) -> str:
    """SQL of one step of the budgets: children share what their parent has."""
    cols, parent, level = ", ".join(levels[:depth]), ", ".join(levels[: depth - 1]), levels[depth - 1]
    by = f"PARTITION BY {parent}" if parent else ""
    weight = "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LANGUAGE_WEIGHTS.items()) + " ELSE 1 END" if level == "lang" else "1"
    joined = f"JOIN b{depth - 1} USING ({parent})" if parent else "CROSS JOIN b0"
    return f"""
c{depth} AS (SELECT {cols}, sum(cap)::BIGINT AS cap, ({weight})::BIGINT AS w FROM leaves GROUP BY {cols}),
p{depth} AS (SELECT *, coalesce(sum(cap) OVER ({by} ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c0,
    (sum(w) OVER ({by} ORDER BY cap / w, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS w1 FROM c{depth} {joined}),
f{depth} AS (SELECT *, cap * w1 <= w * (budget - c0) AS filled FROM p{depth}),
r{depth} AS (SELECT *, (budget - coalesce(sum(CASE WHEN filled THEN cap END) OVER ({by}), 0))::BIGINT AS rest,
    (sum(CASE WHEN NOT filled THEN w END) OVER ({by}))::BIGINT AS w_all,
    (sum(CASE WHEN NOT filled THEN w END) OVER ({by} ORDER BY cap / w, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS w_to FROM f{depth}),
b{depth} AS (SELECT {cols}, CASE WHEN filled THEN cap ELSE rest * w_to // w_all - rest * (w_to - w) // w_all END AS budget FROM r{depth}),"""


_TREE = ("domain", "lang", "source")
_KEY = "('0x' || substr(md5('1/' || whole || '/' || doc_id), 1, 15))::BIGINT"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, 'domain' || (ascii(right(coalesce(source, ''), 1)) % 4) AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS available, (2 * sum(n_tokens))::BIGINT AS cap FROM d GROUP BY ALL),
b0 AS (SELECT least(sum(cap), sum(available))::BIGINT AS budget FROM leaves),{_level(1, _TREE)}{_level(2, _TREE)}{_level(3, _TREE)}
plan AS (SELECT domain, lang, source, CASE WHEN available > 0 THEN budget // available ELSE 0 END AS whole,
    CASE WHEN available > 0 THEN budget % available ELSE budget END AS rest FROM leaves JOIN b3 USING (domain, lang, source)),
keyed AS (SELECT *, {_KEY} AS k FROM d JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens,
    (whole + CASE WHEN sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k) <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM keyed
"""

OP3_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
g AS MATERIALIZED (SELECT doc_id, len(sh)::BIGINT AS n, unnest(sh) AS gram FROM s),
links AS MATERIALIZED (SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
both_ways AS MATERIALIZED (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM s UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON x = reach.r)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, m.component_id FROM s JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
"""

OP7_SQL = r"""
WITH RECURSIVE base AS (SELECT conv_id AS c, turn AS t, role, coalesce(text, '') AS body FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
read AS MATERIALIZED (SELECT c, t, list_filter(list_transform(string_split(body, chr(10)), lambda x: {'level': length(regexp_replace(regexp_extract(x, '^(?:[ \t]*>)+'), '[^>]', '', 'g')),
    'norm': replace(lower(trim(regexp_replace(regexp_replace(x, '^(?:[ \t]*>)+', ''), '[ \t\r]+', ' ', 'g'))), chr(1), ' ')}), lambda x: x.norm <> '') AS lines FROM base),
levels AS (SELECT c, t, lines, unnest(list_distinct(list_transform(lines, lambda x: x.level))) AS level FROM read),
quoted AS MATERIALIZED (SELECT c, t, level, key, len(string_split(key, chr(10))) AS n FROM (SELECT c, t, level,
    unnest(string_split(array_to_string(list_transform(lines, lambda x: CASE WHEN x.level = level THEN x.norm ELSE chr(1) END), chr(10)), chr(1))) AS raw FROM levels WHERE level > 0)
    CROSS JOIN LATERAL (SELECT trim(raw, chr(10)) AS key) WHERE key <> ''),
lengths AS (SELECT DISTINCT c, n FROM quoted UNION SELECT DISTINCT c, 1 FROM quoted),
own AS (SELECT c, t, list_transform(list_filter(lines, lambda x: x.level = 0), lambda x: x.norm) AS own FROM read),
spread AS (SELECT c, t, n, own, unnest(range(1, len(own) - n + 2)) AS p FROM own JOIN lengths USING (c)),
windows AS (SELECT c, t, array_to_string(own[p:p + n - 1], chr(10)) AS key FROM spread),
entries AS (SELECT c, t, 0 AS level, 0 AS whole, key, 0 AS n FROM windows UNION ALL SELECT c, t, level, 1, key, n FROM quoted
    UNION ALL SELECT c, t, level, 0, unnest(string_split(key, chr(10))), 1 FROM quoted),
counted AS (SELECT c, t, level, whole, key, sum(n)::BIGINT AS n FROM entries GROUP BY ALL),
seen AS (SELECT *, max(CASE WHEN level = 0 THEN t END) OVER (PARTITION BY c, key ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS origin FROM counted),
votes AS (SELECT c, t, level, whole, origin, sum(n)::BIGINT AS n FROM seen WHERE level > 0 AND origin IS NOT NULL GROUP BY ALL),
best AS (SELECT c, t, origin, n FROM votes QUALIFY row_number() OVER (PARTITION BY c, t ORDER BY level, whole DESC, n DESC, origin DESC) = 1),
turns AS (SELECT c, t, lag(t) OVER (PARTITION BY c ORDER BY t) AS before FROM (SELECT DISTINCT c, t FROM base)),
nodes AS (SELECT c, t, coalesce(origin, before) AS reply_to, coalesce(n, 0) AS quoted_lines,
    CASE WHEN origin IS NOT NULL THEN 'quote' WHEN before IS NOT NULL THEN 'previous' ELSE 'start' END AS linked_by FROM turns LEFT JOIN best USING (c, t)),
deep(c, t, depth) AS (SELECT c, t, 0::BIGINT FROM nodes WHERE reply_to IS NULL UNION ALL SELECT n.c, n.t, depth + 1 FROM nodes n JOIN deep ON n.c = deep.c AND n.reply_to = deep.t),
placed AS (SELECT c, t, depth, row_number() OVER (PARTITION BY c ORDER BY depth, t) AS position FROM deep)
SELECT base.c AS conv_id, base.t AS turn, role,
    regexp_replace(array_to_string(list_filter(string_split(regexp_replace(body, '(?m)^[^\n]*wrote:[ \t\r]*\n([ \t\r\n]*>)', '\1', 'g'), chr(10)),
        lambda x: NOT regexp_matches(x, '^[ \t]*>')), chr(10)),
        '^[\n\r\t ]+|[\n\r\t ]+$', '', 'g') AS text,
    reply_to, linked_by, quoted_lines, depth, position FROM base JOIN nodes USING (c, t) JOIN placed USING (c, t)
"""

OP8_SQL = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
q AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first_id FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to FROM q
"""

OP9_SQL = """
WITH x AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
    doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM x
"""


def oracle_sql() -> dict[str, str]:
    """Operators that learn, pack, search approximately or need a tokenizer have tests instead."""
    return {"op1_mix_sources": OP1_SQL, "op3_ngram_jaccard": OP3_SQL, "op7_quote_threads": OP7_SQL, "op8_warc_archive": OP8_SQL, "op9_exact_dedup": OP9_SQL}
