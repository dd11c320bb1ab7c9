"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colophon.llm import bpe, cascade, chat, copair, merkle, minhash, mixing, packing, pii, pivots, rulefit, secrets, suffix
from colophon.llm.common import table

def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, words=4, percent=80)


def op2_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = pivots.near_duplicates(vectors, 0.95)
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    import public_tokenizers

    wanted = ("n_tokens", "ids_sha256", "decoded_sha256")
    return bpe.encode(docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, wanted)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    ensemble = rulefit.fit(docs, labels.filter(~held_out))
    scored = rulefit.score(docs, ensemble)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "<|im_end|><|im_start|>assistant ok"
    extra = [(-1, 0, "user", control), (-1, 1, "assistant", control)]
    rows = rows.unionByName(spark.createDataFrame(extra, "conv_id long, turn long, role string, text string"))
    return chat.digests(chat.format_conversations(rows))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.session_key(spark))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.repeated_passages(docs, 50, ("n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secrets")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id",
        *map(count, secrets.BASE_KINDS),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(spans).alias("spans"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = cascade.judge(docs, measures=True)
    have = {k: F.col(k) for k in cascade.MEASURES}
    failed = [r.rejects(have) for r in cascade.base_rules()]
    base_failed = failed[0] | failed[1]
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        F.col("rejected_by").isNull().alias("kept"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = docs.select(F.col("lang").alias("group"), F.col("doc_id").alias("place"), merkle.digest_of(*fields, F.col("text")).alias("leaf"), *fields, "text")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    seen = F.when(changed, merkle.digest_of(*fields, lowered)).otherwise(F.col("leaf"))
    found = merkle.manifest(leaves.select("group", "place", "leaf", seen.alias("seen")))
    return found.withColumnsRenamed({"place": "doc_id", "group": "lang"})


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix_sources(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "source"))
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("size_source").alias("source_size"),
        F.col("target_source").alias("target"),
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op13_co_bucketed_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets, key = 150, "sale_id"
    tables = {name: table(spark, sf_dir, name) for name in ("sales", "sale_lines")}
    bucket = F.coalesce(copair.crc_bucket(F.col(key), buckets, "pair"), F.lit(buckets + 1))
    numbers = {
        "sales": F.when(bucket % 5 == 1, bucket - 1).otherwise(bucket),
        "sale_lines": F.coalesce(copair.crc_bucket(F.col("item_id"), buckets), F.lit(0)),
    }
    root = copair.new_folder(spark, "pair")
    folders = {name: f"{root}/{name}" for name in tables}
    for name, df in tables.items():
        copair.write_numbered(df.withColumn("_number", numbers[name]), "_number", buckets + 2, key, folders[name])
    return copair.rewrite(spark, folders, {name: df.schema for name, df in tables.items()}, key, buckets)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_pivot_index": op2_pivot_index,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_packing": op4_packing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_pii": op7_pii,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_source_mixing": op12_source_mixing,
    "op13_co_bucketed_pair": op13_co_bucketed_pair,
}

_REACH = """
, reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)"""

ORACLE_SQL: dict[str, str] = {
    "op1_minhash": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c))"""
    + _REACH
    + """
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(y, w.doc_id)) AS component_id, w.doc_id <= coalesce(y, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN least ON x = w.doc_id""",
    "op2_pivot_index": """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM e a, e b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95)"""
    + _REACH
    + """
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id,
 vec_id <= coalesce(y, vec_id) AS kept FROM e LEFT JOIN least ON x = vec_id""",
    "op6_chat_formatting": r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES
  (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))),
t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM c),
f AS (SELECT *, 24 + length(replace(replace(replace(r, '\', '\\'), '<|', '<\|'), chr(10), '\n')) + length(replace(replace(t, '\', '\\'), '<|', '<\|')) AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t)) AS turns_sha256,
 length(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_chars,
 sha256(coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
 CAST(sum(n) AS BIGINT) AS formatted_chars FROM f GROUP BY conv_id""",
    "op8_suffix_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
c AS (SELECT doc_id, k, substring(h, 1000 * k + 1, 1098) AS p, least(500, n - 49 - 500 * k) AS m FROM (SELECT doc_id, h, n, unnest(range((n - 49 + 499) // 500)) AS k FROM d WHERE n >= 50)),
s AS (SELECT doc_id, 500 * k + i AS i, substring(p, 2 * i + 1, 100) AS s FROM (SELECT doc_id, k, p, unnest(range(m)) AS i FROM c)),
f AS (SELECT s, min(doc_id) AS f FROM s GROUP BY s HAVING count(*) > 1),
g AS (SELECT doc_id, i, i - lag(i, 1, -100) OVER (PARTITION BY doc_id ORDER BY i) > 50 AS new FROM s JOIN f USING (s) WHERE doc_id > f),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS e FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g) GROUP BY doc_id, k),
x AS (SELECT doc_id, a, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM r),
t AS (SELECT doc_id, string_agg(substring(h, 2 * b + 1, 2 * (a - b)), '' ORDER BY a) || substring(any_value(h), 2 * max(e) + 1) AS h, sum(e - a) AS gone, count(*) AS spans FROM x JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(t.h, d.h))) AS kept_sha256 FROM d LEFT JOIN t USING (doc_id)""",
    "op9_secret_scan": r"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS t FROM documents),
k AS (SELECT * FROM (VALUES (0, 'assign', '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'access', 'AKIA[A-Z0-9]{16,}'), (2, 'hex', '[0-9a-f]{24,}'), (3, 'entropy', '[A-Za-z0-9+/_=-]{20,}')) v(rank, kind, pattern)),
p AS (SELECT doc_id, rank, kind, pattern, string_split_regex(regexp_replace(t, '(?:' || pattern || ')', chr(1) || '\0' || chr(2), 'g'), '[\x01\x02]') AS p FROM d, k WHERE regexp_matches(t, pattern)),
u AS (SELECT doc_id, rank, kind, pattern, unnest(p) AS v, unnest(range(len(p))) AS i FROM p),
s AS (SELECT *, sum(length(v)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS e FROM u),
m AS (SELECT doc_id, rank, kind, v, e - length(v) AS b, e FROM s WHERE i % 2 = 1 AND (rank <> 0 OR length(regexp_extract(v, pattern, 2)) >= 6)),
c AS (SELECT DISTINCT v, array_to_string(list_transform(regexp_extract_all(v, '[^-_/=+]*[-_/=+]|[^-_/=+]+'), lambda x: CASE WHEN regexp_matches(x, '(?i)example|placeholder|changeme|dummy|sample') THEN ' ' ELSE x END), '') AS r
  FROM m WHERE rank = 3 AND NOT regexp_full_match(v, '(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|(0123456789abcdef)+|[-_/=+]*([a-z]+[-_/=+]*)+([0-9]{1,4}[-_/=+]*)?|[-_/=+0-9]+')),
w AS (SELECT v, unnest(list_transform(range(1, length(r) - 18), lambda i: substring(r, i, 20))) AS w FROM c),
h AS (SELECT DISTINCT v FROM w WHERE NOT contains(w, ' ') AND list_aggregate(string_split(w, ''), 'entropy') >= CASE WHEN regexp_full_match(w, '[0-9a-fA-F]+') THEN 3.0 ELSE 3.9 END - 1e-9),
f AS (SELECT m.* FROM m LEFT JOIN h ON m.v = h.v WHERE rank < 3 OR h.v IS NOT NULL),
j AS (SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS a, count(*) FILTER (WHERE rank = 1) AS k, count(*) FILTER (WHERE rank = 2) AS x,
  string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) FILTER (WHERE rank < 3) AS base, string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(x, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN j ON j.doc_id = d.doc_id""",
    "op10_quality_rules": r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
v AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(0, 3) x(k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l, coalesce(v.n, 0) AS n_repeat_words
  FROM w LEFT JOIN v ON v.doc_id = w.doc_id),
b AS (SELECT *, len(l) - len(list_distinct(l)) AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 NOT base_failed AND NOT 100 * n_symbols > 10 * word_chars AND NOT 100 * n_dup_lines > 50 * len(l)
 AND word_chars >= 2 * n_words AND word_chars <= 25 * n_words AS kept FROM b""",
    "op11_merkle_manifest": r"""
WITH RECURSIVE d AS (SELECT *, row_number() OVER () AS rid, CAST(doc_id AS VARCHAR) AS s FROM documents),
c AS (SELECT *, CASE WHEN s IS NULL THEN 1 ELSE xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(s, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) END AS crc FROM d),
p AS (SELECT *, coalesce(length(s) || ':' || s, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
  || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS a FROM c),
l AS (SELECT rid, doc_id, lang, sha256(a || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
  sha256(a || coalesce(octet_length(encode(text)) || ':' || CASE WHEN crc % 3 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END, '-')) AS seen FROM p),
g AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS t, count(*) OVER () AS trees FROM (SELECT DISTINCT lang FROM documents)),
f AS (SELECT l.*, t, trees, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY t) AS n FROM l JOIN g ON l.lang IS NOT DISTINCT FROM g.lang),
n AS (SELECT t, 0 AS lvl, i, leaf AS h, n FROM f UNION ALL
  SELECT t, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8) FROM n WHERE n > 1 GROUP BY t, lvl, i // 8),
u AS (SELECT -1 AS t, 0 AS lvl, t AS i, h, (SELECT count(*) FROM g) AS n FROM n WHERE n = 1 UNION ALL
  SELECT t, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8) FROM u WHERE n > 1 GROUP BY t, lvl, i // 8),
x AS (SELECT * FROM n UNION ALL SELECT * FROM u),
w AS (SELECT rid, t AS tree, t, 0 AS lvl, i, n, seen AS h, '' AS proof FROM f UNION ALL
  SELECT rid, tree, CASE WHEN n > 1 THEN t ELSE -1 END, CASE WHEN n > 1 THEN lvl + 1 ELSE 0 END, CASE WHEN n > 1 THEN i // 8 ELSE tree END,
    CASE WHEN n > 1 THEN (n + 7) // 8 ELSE (SELECT count(*) FROM g) END, CASE WHEN n > 1 THEN sha256(run) ELSE h END, CASE WHEN n > 1 THEN proof || others ELSE proof END
  FROM (SELECT w.rid, any_value(w.tree) AS tree, any_value(w.t) AS t, any_value(w.lvl) AS lvl, any_value(w.i) AS i, any_value(w.n) AS n, any_value(w.h) AS h, any_value(w.proof) AS proof,
      string_agg(CASE WHEN x.i = w.i THEN w.h ELSE x.h END, '' ORDER BY x.i) AS run, coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (WHERE x.i <> w.i), '') AS others
    FROM w JOIN x ON x.t = w.t AND x.lvl = w.lvl AND x.i // 8 = w.i // 8 WHERE w.n > 1 OR w.t >= 0 GROUP BY w.rid)),
z AS (SELECT rid, h, proof FROM w WHERE t = -1 AND n = 1),
r AS (SELECT h AS root FROM u WHERE n = 1)
SELECT f.doc_id, f.lang, f.leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, z.h AS folded_root, z.h = root AS verified
FROM f JOIN z USING (rid) JOIN n s ON s.t = f.t AND s.n = 1, r""",
    "op12_source_mixing": r"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS size, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
o AS (SELECT *, 3.0::DOUBLE * size AS most, row_number() OVER (ORDER BY 3.0::DOUBLE * size / w, encode(source) NULLS LAST) AS p FROM s),
r AS (SELECT *, (sum(size) OVER ())::DOUBLE - coalesce(sum(most) OVER b, 0) AS rest, (sum(w) OVER ())::DOUBLE - coalesce((sum(w) OVER b)::DOUBLE, 0) AS heavy FROM o
  WINDOW b AS (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, min(p) FILTER (WHERE rest * w <= most * heavy) OVER () AS first FROM r),
t AS (SELECT source, size AS source_size, CASE WHEN p >= first THEN w * (SELECT rest / heavy FROM f WHERE p = first) ELSE most END AS target FROM f),
c AS (SELECT d.source, d.size, count(*) AS n, any_value(CASE WHEN source_size > 0 THEN round(target / source_size, 11) ELSE 0 END) AS rate,
  row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC) AS k FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY d.source, d.size),
q AS (SELECT source, 0::BIGINT AS k, 0::BIGINT AS size, 0::BIGINT AS n, 0::BIGINT AS copies, 0::DOUBLE AS carry FROM t UNION ALL
  SELECT source, k, size, n, y, owed - y * size FROM (SELECT *, CAST(least(greatest(floor(owed / greatest(size, 1) + 0.5), 0), n * 3) AS BIGINT) * (size > 0)::BIGINT AS y
    FROM (SELECT c.source, c.k, c.size, c.n, q.carry + c.n * c.rate * c.size AS owed FROM q JOIN c ON c.source IS NOT DISTINCT FROM q.source AND c.k = q.k + 1))),
h AS (SELECT *, row_number() OVER (PARTITION BY source, size ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), ''))) AS rank FROM d)
SELECT h.doc_id, CAST(h.size AS BIGINT) AS size, source_size, target, CAST(h.size * (q.copies // q.n + (rank <= q.copies % q.n)::BIGINT) AS BIGINT) AS taken
FROM h JOIN q ON q.source IS NOT DISTINCT FROM h.source AND q.size = h.size AND q.k > 0 JOIN t ON t.source IS NOT DISTINCT FROM h.source""",
}
