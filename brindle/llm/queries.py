"""The queries ``opN_<name>``, thin over the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import audit, bpe, covertree, gif, hmm, langid, licenses, minhash, pack, pii, resample, suffix, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gif.store_texts(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    return langid.identify(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op7_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.links(table(spark, sf_dir, "embeddings"))


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.report(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.parse_records(warc.read_archive(*warc.write_archive(table(spark, sf_dir, "pages"))))
    refers = F.regexp_extract("refers_to_id", r"^<urn:page:(-?\d+)>$", 1)
    return records.select("page_id", F.length("payload").cast("long").alias("payload_bytes"), warc.base32_of_hex(F.sha1("payload")).alias("payload_digest"), "record_type", F.when(refers != "", refers.cast("long")).alias("refers_to"))


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


_ALL = (op1_gif, op2_licenses, op3_pii, op4_minhash, op5_language, op6_bpe, op7_cover_tree, op8_pack, op9_suffix, op10_warc, op11_audit, op12_resample, op13_hmm)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

LOWER = f"translate(coalesce(text, ''), '{licenses.UPPER}', '{licenses.LOWER}')"
REACH = """both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, c) AS (SELECT id, id FROM nodes UNION SELECT b, c FROM reach JOIN both_ways ON a = id)"""


def _license_sql() -> str:
    """Spans as the operator defines them, by window frames over all places of the templates' tokens."""
    rows = ", ".join(f"({k}, '{label}', {tokens}, {len(tokens)}, {licenses.needed(len(tokens))}, {span})" for k, (label, tokens, span) in enumerate(licenses.template_tokens()))
    places = " || ".join(f"[struct_pack(label := '{label}', at := i - 1) FOR i IN generate_series(1, len(w)) IF {' AND '.join(f"w[i + {k}] = '{p}'" for k, p in enumerate(phrase))}]" for label, phrase in licenses.PHRASES.items())
    frames = " UNION ALL ".join(f"SELECT id, template, pos, list(DISTINCT word) OVER f AS has, max(pos) OVER f AS last FROM p WHERE span = {span} WINDOW f AS (PARTITION BY id, template ORDER BY pos RANGE BETWEEN CURRENT ROW AND {span - 1} FOLLOWING)" for span in sorted({t[2] for t in licenses.template_tokens()}))
    return f"""WITH t(template, label, tokens, size, need, span) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all({LOWER}, '{licenses.WORD}') AS w FROM documents),
h AS (SELECT id, doc_id, len(w) AS n_words, {places} AS hits FROM d),
tw AS (SELECT template, need, span, unnest(tokens) AS word FROM t),
w AS (SELECT id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
e AS (SELECT id, template FROM (SELECT DISTINCT id, word FROM w) JOIN tw USING (word) GROUP BY id, template, need HAVING count(*) >= need),
p AS (SELECT id, template, pos, word, span FROM w JOIN tw USING (word) SEMI JOIN e USING (id, template)),
s AS ({frames}),
m AS (SELECT id, template, label, tokens, size, pos, last, has, len(has) / size AS c FROM s JOIN t USING (template) WHERE len(has) >= need),
k AS (SELECT * FROM m AS a WHERE NOT EXISTS (SELECT 1 FROM m AS b WHERE a.id = b.id AND b.pos <= a.last AND a.pos <= b.last AND (b.c > a.c OR b.c = a.c AND b.size > a.size) AND len(list_intersect(a.has, b.tokens)) = len(a.has))),
f AS (SELECT id, list(DISTINCT label) AS found, max(c) AS c, count(*) AS n FROM k GROUP BY 1)
SELECT doc_id, n_words, len(hits) AS n_base, list_min([x.at FOR x IN hits]) AS first_word, list_max([x.at FOR x IN hits]) AS last_word,
  array_to_string(list_sort(list_distinct([x.label FOR x IN hits])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct([x.label FOR x IN hits] || coalesce(found, []))), ',') AS labels,
  CASE WHEN len(hits) > 0 THEN 1.0::DOUBLE ELSE coalesce(f.c, 0)::DOUBLE END AS score, coalesce(f.n, 0) AS n_spans
FROM h LEFT JOIN f USING (id)"""


def _audit_sql() -> str:
    """Masks by window and expressions; each order's steps by comparing bits."""
    words = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
    orders = ", ".join(f"('{o}')" for o in audit.ORDERS)
    return rf"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, part, {words} AS w, len(regexp_extract_all(text, '[A-Z]')) AS caps, length(text) AS points, regexp_matches(text, '[#$%&*|]') AS sign, doc_id > min(doc_id) OVER (PARTITION BY text) AS copy FROM d),
f AS (SELECT doc_id, part, CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT) + 4 * CAST(100 * caps > 3 * points AS INT) + 8 * CAST(sign AS INT) + 16 * CAST(coalesce(copy, false) AS INT) AS mask FROM w),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic FROM f LEFT JOIN labels USING (doc_id) GROUP BY ALL),
o AS (SELECT o, unnest(generate_series(1, 5)) AS step FROM (VALUES {orders}) AS v(o)),
s AS (SELECT o, CAST(step AS INT) AS step, 1 << (ascii(substr(o, step, 1)) - 65) AS own, CAST(list_sum([0] || [1 << (ascii(substr(o, i, 1)) - 65) FOR i IN generate_series(1, step - 1)]) AS INT) AS before FROM o),
r AS (SELECT part, o AS filter_order, step, own, sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, substr(filter_order, step, 1) AS filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""


def _resample_sql() -> str:
    """The CRC by its table, a byte of all distinct features at a time."""
    feature = "SELECT {0}, unnest([w, w || ' ' || b, w || ' ' || b || ' ' || c]) AS f FROM (SELECT {0}, w, lead(w) OVER d AS b, lead(w, 2) OVER d AS c FROM (SELECT {0}, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM {1}) WINDOW d AS (PARTITION BY {0} ORDER BY i))"
    return rf"""WITH RECURSIVE t(i, k, v) AS (SELECT i, 0, i FROM range(256) AS r(i) UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM t WHERE k < 8),
tab AS (SELECT i, v FROM t WHERE k = 8),
d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all({LOWER}, '{resample.WORD}') AS w FROM documents),
b AS (SELECT row_number() OVER () AS id, regexp_extract_all({LOWER}, '{resample.WORD}') AS w FROM benchmark),
df AS ({feature.format("id", "d")}), bf AS ({feature.format("id", "b")}),
u AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df WHERE f IS NOT NULL UNION SELECT f FROM bf WHERE f IS NOT NULL)),
crc(f, h, pos, v) AS (SELECT f, h, 1, 4294967295 FROM u UNION ALL SELECT f, h, pos + 2, xor(crc.v // 256, tab.v) FROM crc JOIN tab ON tab.i = xor(crc.v % 256, CAST('0x' || substr(h, pos, 2) AS BIGINT)) WHERE pos < length(h)),
k AS (SELECT f, xor(v, 4294967295) % {resample.BUCKETS} AS bucket FROM crc WHERE pos > length(h)),
s AS (SELECT bucket, count(*) AS s FROM df JOIN k USING (f) GROUP BY 1), tt AS (SELECT bucket, count(*) AS t FROM bf JOIN k USING (f) GROUP BY 1),
n AS (SELECT (SELECT sum(s) FROM s) AS s_all, (SELECT sum(t) FROM tt) AS t_all),
g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + {resample.BUCKETS}) / ((s + 1.0::DOUBLE) * (t_all + {resample.BUCKETS})))) AS BIGINT) AS gain FROM s LEFT JOIN tt USING (bucket), n),
x AS (SELECT id, sum(gain) AS weight, count(*) AS n FROM df JOIN k USING (f) JOIN g USING (bucket) GROUP BY 1),
y AS (SELECT id, doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
  CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN x USING (id)),
r AS (SELECT id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, 5 * count(*) OVER () // 100 AS drawn FROM y WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= drawn THEN r END AS rank FROM y LEFT JOIN r USING (id)"""


#: The rest has no SQL: code streams, trained models, byte pairs, linear programs and removed bytes are tested otherwise.
ORACLE_SQL: dict[str, str] = {
    "op2_licenses": _license_sql(),
    "op4_minhash": f"""WITH RECURSIVE w AS (SELECT doc_id, [x FOR x IN regexp_split_to_array({LOWER}, '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN generate_series(1, len(w) - 4)]) END AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
nodes AS (SELECT doc_id AS id FROM documents), {REACH}
SELECT doc_id, len(s) AS n_shingles, c AS component_id, doc_id = c AS kept FROM s JOIN (SELECT id, min(c) AS c FROM reach GROUP BY id) ON id = doc_id""",
    "op7_cover_tree": f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_sum([abs(x) FOR x IN embedding]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id AND list_cosine_similarity(a.e, b.e) >= {covertree.COSINE}),
nodes AS (SELECT vec_id AS id FROM embeddings), {REACH}
SELECT id AS vec_id, (SELECT count(*) FROM both_ways WHERE a = id) AS n_links, min(c) AS component_id, id = min(c) AS kept FROM reach GROUP BY id""",
    "op11_audit": _audit_sql(),
    "op12_resample": _resample_sql(),
    "op10_warc": f"""WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS best FROM p)
SELECT page_id, n AS payload_bytes, array_to_string([substr('{warc.BASE32}', 1 + CAST((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) // [32768, 1024, 32, 1][1 + i % 4]) % 32 AS INTEGER), 1) FOR i IN generate_series(0, 31)], '') AS payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> best THEN best END AS refers_to FROM m""",
}
