"""The registered queries of this folder: thin contract views over the operators, with SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import circulant_minhash, collocations, decontaminate, edit_counts, exact_dedup, language_id, packing, prefix_trie, sharding, simhash, toxicity, url_filter, warc
from .scratch import id_text
from .url_filter import Rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RULES = [Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), RULES)


ORACLE["op1_url_filter"] = r"""
WITH RECURSIVE u AS (
  SELECT page_id, url, html,
    coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path,
    CASE WHEN contains(url, '://') THEN
      regexp_replace(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^(www|m)\.', '')
      || regexp_replace(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '/+$', '')
      || coalesce('?' || nullif(regexp_replace(regexp_replace(regexp_extract(url, '^(?s:.*?)://[^?#]*\?([^#]*)', 1), '(^|&)(utm_[^&]*|ref=[^&]*)', '', 'g'), '^&', ''), ''), '')
    END AS node
  FROM pages),
rules(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
judged AS (
  SELECT u.page_id, u.url, u.host, u.path, u.node,
    arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS rule_verdict
  FROM u LEFT JOIN rules r ON ('.' || u.host) LIKE ('%.' || r.host) AND starts_with(u.path, r.path)
  GROUP BY ALL),
reach AS (
  SELECT node FROM judged WHERE node IS NOT NULL GROUP BY node HAVING bool_or(rule_verdict = 'block') AND NOT coalesce(bool_or(rule_verdict = 'allow'), false))
SELECT page_id, host, path, rule,
  CASE WHEN rule IS NOT NULL THEN rule_verdict WHEN r.node IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NOT NULL THEN 'rule' WHEN r.node IS NOT NULL THEN 'alias' ELSE 'default' END AS decided_by
FROM judged LEFT JOIN reach r USING (node)
"""


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicate_components(table(spark, sf_dir, "documents"), width=4, radius=4)
    return found.select("doc_id", simhash.hex_of("fingerprint").alias("fingerprint"), "component_id")


@query
def op3_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = warc.capture_history(table(spark, sf_dir, "pages"))
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op4_warc_index"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < kept THEN kept END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.mark_copies(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLE["op6_cuckoo_dedup"] = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ 	-
]+', '', 'g')) AS text_sha256, length(coalesce(text, '')) AS points FROM documents),
g AS (SELECT text_sha256, arg_min(doc_id, (-points, doc_id)) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.text_sha256 FROM n JOIN g USING (text_sha256)
"""


def toxicity_field(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Field:
    """Learned from the labels outside the held-out fold, crc32(doc_id as text) mod 4 = 2."""
    labels = table(spark, sf_dir, "labels").filter(F.crc32(id_text()) % 4 != 2)
    return toxicity.train(docs, labels.select("doc_id", "toxic"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(docs, toxicity_field(spark, sf_dir, docs))
    return scored.select(
        "doc_id", (F.crc32(id_text()) % 4 == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "spans"
    )


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.pieces(table(spark, sf_dir, "documents"), capacity=1024, end_id=0)
    return packing.pack(parts.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"), capacity=1024)


def sample_edits(docs: DataFrame) -> DataFrame:
    """Three edits per document from its id and length: an insertion, a deletion across words and a replacement."""
    size = F.coalesce(F.max(F.length("text")), F.lit(0))
    sizes = docs.groupBy(F.col("doc_id").cast("long").alias("id")).agg(size.alias("size"))
    place = [F.pmod(F.xxhash64(F.lit(step), "id"), F.col("size") + 1).cast("int") for step in range(3)]
    edits = F.array(*[
        F.struct(F.lit(step).alias("step"), place[step].alias("position"), F.lit(removed).alias("removed"), F.lit(inserted).alias("inserted"))
        for step, (removed, inserted) in enumerate([(0, " an added phrase, with  spaces"), (23, ""), (5, "Überarbeitet 2024\n")])
    ])
    return sizes.select("id", F.inline(edits))


@query
def op9_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = edit_counts.count_after_edits(docs, edit_counts.build_trees(docs), sample_edits(docs))
    return counted.withColumnRenamed("id", "doc_id")


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(language_id.learning_rows(docs, folds=5, held_out=0))
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (F.crc32(id_text()) % 5 == 0).alias("held_out"), "lang_pred", "score")


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.positions(prefix_trie.turn_rows(table(spark, sf_dir, "conversations")))
    conv = F.col("conv")
    convs, rebuilt = prefix_trie.spliced(turns, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4, most=3)
    return prefix_trie.trie(convs, rebuilt).drop("a", "b")


ORACLE["op11_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    struct_pack(role := coalesce(role, ''), said := coalesce(text, '')) AS said
  FROM conversations WHERE conv_id IS NOT NULL),
-- crc32 of the decimal id modulo 4: the check sum is linear over bits, so it is folded byte by byte.
crc AS (
  SELECT conv, list_reduce(list_prepend(4294967295, list_transform(range(1, length(conv::VARCHAR) + 1), lambda k: ascii(substr(conv::VARCHAR, k, 1))::BIGINT)),
    lambda c, byte: xor(c >> 8, list_reduce(list_prepend(xor(c, byte) & 255, range(8)), lambda v, j: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) AS c
  FROM (SELECT DISTINCT conv FROM t)),
c AS (SELECT conv, conv - conv % 20 AS base, xor(c, 4294967295) % 4 AS h FROM crc),
heads AS (SELECT c.conv, t.pos, t.said FROM c JOIN t ON t.conv = c.base AND t.pos <= c.h),
own AS (SELECT c.conv, 1000 + t.pos AS pos, t.said FROM c JOIN t ON t.conv = c.conv AND t.pos > c.h),
r AS (
  SELECT c.conv, coalesce(s.turns, []) AS turns
  FROM c LEFT JOIN (SELECT conv, list(said ORDER BY pos) AS turns FROM (FROM heads UNION ALL FROM own) GROUP BY conv) s USING (conv)),
p AS (SELECT conv, turns, unnest(range(0, len(turns) + 1)) AS depth FROM r),
n AS (
  SELECT turns[1:depth] AS node, depth, min(conv) AS conv_id, count(*) AS n_convs,
    string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (len(turns) = depth) AS ends,
    max(CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(turns[depth].said, '[^\x20\x09-\x0D]+')) END) AS words
  FROM p GROUP BY 1, 2),
k AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
w AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k USING (node)),
s AS (
  SELECT node[1:up] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM w) GROUP BY 1)
SELECT w.conv_id, w.depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN s USING (node) LEFT JOIN w AS u ON w.depth > 0 AND u.node = w.node[1:w.depth - 1]
"""


@query
def op12_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


ORACLE["op12_circulant_minhash"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) END) AS shingles FROM words),
sizes AS (SELECT doc_id, len(shingles) AS n_shingles FROM sets),
flat AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n_shingles + y.n_shingles - common)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT doc_id, n_shingles, min(other) AS component_id, doc_id = min(other) AS kept FROM sizes JOIN reach USING (doc_id) GROUP BY doc_id, n_shingles
"""


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, best=2000, covered=80)


ORACLE["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS (SELECT lang, w, i, unnest(range(1, 5)) AS size FROM starts),
f AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, size, count(*) AS f FROM grams WHERE i + size - 1 <= len(w) GROUP BY 1, 2, 3 HAVING count(*) >= 30),
totals AS (SELECT lang, count(*) AS n FROM starts GROUP BY 1),
candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (SELECT *, unnest(range(2, size)) AS part FROM candidates),
inside AS (SELECT lang, a, w, part, unnest(range(1, size - part + 2)) AS i FROM spans),
longer AS (SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(a) AS longer FROM inside GROUP BY 1, 2),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank
  FROM lowest s LEFT JOIN longer d USING (lang, phrase) WHERE d.longer IS NULL OR 100 * d.longer < 80 * s.a)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN totals USING (lang) WHERE rank <= 2000
"""
