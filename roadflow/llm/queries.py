"""The operators of this subpackage as queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import covertree, hyperminhash, language, lineblocks, merkle, mih, mixing, pieces, quotes, rangecoder, secrets, toxicity, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of each vector whose id is divisible by 20, among all others."""
    return mih.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels of three quarters of them."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(toxicity.fit_rows(F.col("doc_id"))))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(~toxicity.fit_rows(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("tox_score").alias("score"),
        (F.col("tox_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: counts, digest of the base spans, all spans."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda k: F.size(F.filter("secret_spans", lambda x: x["k"] == k)).cast("long")
    base = F.filter("secret_spans", lambda x: x["k"] < 3)
    return found.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), of(3).alias("n_entropy"),
        F.sha2(secrets.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(F.col("secret_spans")).alias("spans"),
    )


def _spans_sql(name: str, pattern: str, k: int, keep: str) -> str:
    p = pattern.replace("'", "''")
    return f"""{name} AS (SELECT doc_id, {k} AS k, s, s + length(m) AS e, m FROM (
      SELECT doc_id, m[i] AS m, list_sum([length(x) for x in g[1:i]]) + coalesce(list_sum([length(x) for x in m[1:i-1]]), 0) AS s
      FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS g FROM d WHERE regexp_matches(text, '{p}')))) WHERE {keep})"""


def _without_allowed(text: str) -> str:
    for part, n in secrets.ALLOWED_PARTS.items():
        text = f"regexp_replace({text}, '{part}', repeat(' ', {n}), 'g')"
    return text


OP3_SQL = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id AS id, coalesce(text, '') AS text FROM documents),
d0 AS (SELECT r AS doc_id, text FROM d),
{_spans_sql("a", secrets.ASSIGN, 0, f"length(regexp_extract(m, '{secrets.ASSIGN.replace("'", "''")}', 1)) >= 8").replace("FROM d WHERE", "FROM d0 WHERE")},
{_spans_sql("b", secrets.ACCESS, 1, "true").replace("FROM d WHERE", "FROM d0 WHERE")},
{_spans_sql("c", secrets.HEX, 2, "true").replace("FROM d WHERE", "FROM d0 WHERE")},
base AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c),
cuts AS (SELECT doc_id, list({{'t': '', 's': s::BIGINT, 'e': e::BIGINT}} ORDER BY s, e) AS l FROM base GROUP BY doc_id),
rest AS (SELECT doc_id, CASE WHEN l IS NULL THEN text ELSE list_reduce(list_prepend({{'t': text, 's': 0::BIGINT, 'e': 0::BIGINT}}, l),
  lambda a, x: {{'t': left(a.t, x.s) || repeat(' ', x.e - x.s) || substr(a.t, x.e + 1), 's': 0::BIGINT, 'e': 0::BIGINT}}).t END AS text FROM d0 LEFT JOIN cuts USING (doc_id)),
d1 AS (SELECT doc_id, {_without_allowed("text")} AS text FROM rest),
{_spans_sql("n", secrets.CANDIDATE, 3, f"regexp_matches(m, '[0-9]') AND NOT regexp_matches(m, '{secrets.ALLOWED}')").replace("FROM d WHERE", "FROM d1 WHERE")},
w AS (SELECT n.*, unnest(range(1, length(m) - {secrets.WINDOW - 2})) AS i FROM n),
low AS (SELECT doc_id, k, s, e, m, min(list_sum([{secrets.COUNT_BITS}[c::BIGINT + 1] for c in map_values(list_histogram(string_split(m[i:i+{secrets.WINDOW - 1}], '')))])) AS least
  FROM w GROUP BY ALL),
found AS (SELECT * FROM base UNION ALL SELECT doc_id, k, s, e, m FROM low WHERE least <=
  CASE WHEN regexp_matches(m, '^[0-9a-f]+$|^[0-9A-F]+$') THEN {secrets.most_allowed(secrets.LEAST_BITS["hex"])}
       WHEN regexp_matches(m, '^[0-9A-Z+/_=-]+$|^[0-9a-z+/_=-]+$') THEN {secrets.most_allowed(secrets.LEAST_BITS["upper"])}
       ELSE {secrets.most_allowed(secrets.LEAST_BITS["mixed"])} END),
g AS (SELECT doc_id, sum((k = 0)::INT) AS n0, sum((k = 1)::INT) AS n1, sum((k = 2)::INT) AS n2, sum((k = 3)::INT) AS n3,
  string_agg({list(secrets.KINDS)}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS b,
  string_agg({list(secrets.KINDS)}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, e, k) AS t FROM found GROUP BY doc_id)
SELECT id AS doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
  coalesce(n3, 0)::BIGINT AS n_entropy, sha256(coalesce(b, '')) AS base_sha256, coalesce(t, '') AS spans
FROM d LEFT JOIN g ON d.r = g.doc_id"""


def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.95 or more between all vectors, and their components."""
    return covertree.link_vectors(table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source with weights 1, 2, 3, repeating, and at most three epochs."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


OP5_SQL = r"""WITH d AS (SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
  CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
  substr(md5(coalesce(doc_id::VARCHAR, 't' || md5(coalesce(text, '')))), 1, 9) AS h FROM documents),
s AS (SELECT k, sum(size)::DOUBLE AS n, ((row_number() OVER (ORDER BY k) - 1) % 3 + 1)::DOUBLE AS w FROM d GROUP BY k),
l AS (SELECT *, (sum(n) OVER () - coalesce(sum(3 * n) OVER (ORDER BY 3 * n / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY 3 * n / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev FROM s),
t AS (SELECT k, n, least(3 * n, w * (SELECT lev FROM l WHERE lev <= 3 * n / w ORDER BY 3 * n / w, k LIMIT 1)) AS target FROM l),
p AS (SELECT *, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS f FROM t),
b AS (SELECT k, h, sum(size) AS words FROM d WHERE size > 0 GROUP BY k, h),
c AS (SELECT *, sum(words) OVER (PARTITION BY k ORDER BY h) AS upto FROM b),
e AS (SELECT c.k, min_by(h, h) AS h, min_by((target - f * n - (upto - words)) * 2 > words, h) AS with_edge
  FROM c JOIN p USING (k) WHERE upto > target - f * n GROUP BY c.k)
SELECT doc_id, size::BIGINT AS size, n::BIGINT AS source_size, target,
  (size * (f + CASE WHEN f < 3 AND (d.h < coalesce(e.h, '~') OR (d.h = e.h AND e.with_edge)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN p USING (k) LEFT JOIN e ON e.k = d.k"""


def op6_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents: similarity 0.8 or more of their two-word shingles."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)


OP6_SQL = r"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) END AS s FROM d),
c AS (SELECT list_sort(s) AS s, min(doc_id) AS rep, len(any_value(s.s)) AS n FROM s GROUP BY 1),
u AS (SELECT rep, unnest(s) AS x FROM c),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS i FROM u a JOIN u b ON a.x = b.x AND a.rep < b.rep GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN c x ON x.rep = a JOIN c y ON y.rep = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t(node, seen) AS (SELECT rep, rep FROM c UNION SELECT node, e.b FROM t JOIN e ON e.a = t.seen),
m AS (SELECT node, min(seen) AS component FROM t GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(CASE WHEN len(s.s) > 0 THEN component END, s.doc_id) AS component_id,
  s.doc_id = coalesce(CASE WHEN len(s.s) > 0 THEN component END, s.doc_id) AS kept
FROM s JOIN c ON c.s = list_sort(s.s) JOIN m ON m.node = c.rep"""


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of all documents: number, checksum, and whether they decode to the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.tokenised(docs, pieces.default_model(), with_ids=False).drop("text")


def op8_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages with their reply links, in threads, as chat text without quotes."""
    linked = quotes.link_quotes(table(spark, sf_dir, "conversations"))
    return linked.select(
        "conv_id", "turn", "role", "reply_to", "thread", F.col("n_quotes").cast("long"), "n_repeats", F.col("deepest").cast("long"),
        F.length("own_text").cast("long").alias("own_chars"), F.md5(F.col("chat_text").cast("binary")).alias("chat_md5"),
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from four fifths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(language.fit_rows(F.col("doc_id"))))
    return language.predict(docs, model).select(
        "doc_id", F.coalesce(~language.fit_rows(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score", "n_words", "n_switches"
    )


def op10_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as coded ids and read back: where each begins, its ids' number and checksum."""
    path = rangecoder.new_path(spark)
    rangecoder.write_ids(table(spark, sf_dir, "documents"), rangecoder.default_tokenizer(), path)
    return rangecoder.read_ids(rangecoder.stored(spark, path))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents, a third of them tampered with: leaves, roots, proofs and whether they fold to the root."""
    return merkle.tampered(table(spark, sf_dir, "documents"))


def _tree_sql(name: str, base: str) -> str:
    """Levels of the trees over ``base(tr, pos, h, n)``, and what stands beside every node in its run."""
    side = f"string_agg(h, '') OVER (PARTITION BY lv, tr, pos // {merkle.ARITY} ORDER BY pos ROWS BETWEEN"
    return f"""{name}(lv, tr, pos, h, n) AS (SELECT 0, tr, pos, h, n FROM {base} UNION ALL
  SELECT lv + 1, tr, pos // {merkle.ARITY}, sha256(string_agg(h, '' ORDER BY pos)), (n + {merkle.ARITY - 1}) // {merkle.ARITY} FROM {name} WHERE n > 1 GROUP BY lv, tr, pos // {merkle.ARITY}, n),
{name}s AS (SELECT lv, tr, pos, coalesce({side} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a, coalesce({side} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {name} WHERE n > 1)"""


def _leaf_sql(text: str) -> str:
    fields = [text if f == "text" else f for f in merkle.FIELDS]
    return "sha256(" + " || ".join(f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}::VARCHAR) || ':' || {f} END" for f in fields) + ")"


OP11_SQL = f"""WITH RECURSIVE d AS (SELECT doc_id, lang, {_leaf_sql("text")} AS h, {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS low,
  xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(doc_id::VARCHAR, '')])),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384::BIGINT * (crc & 1)) END), 4294967295::BIGINT) % 3 = 0 AS third FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tr FROM d),
{_tree_sql("t", "p")},
sub AS (SELECT tr, h FROM t WHERE n = 1), s1 AS (SELECT 0 AS tr, tr AS pos, h, count(*) OVER () AS n FROM sub), {_tree_sql("u", "s1")},
w AS (SELECT r, list({{'a': a, 'b': b, 'h': ''}} ORDER BY k) AS l FROM (
    SELECT p.tr || '-' || p.pos AS r, ts.lv AS k, a, b FROM p JOIN ts ON ts.tr = p.tr AND ts.pos = p.pos // ({merkle.ARITY} ** ts.lv)::BIGINT
    UNION ALL SELECT p.tr || '-' || p.pos, 1000 + us.lv, a, b FROM p JOIN us ON us.pos = p.tr // ({merkle.ARITY} ** us.lv)::BIGINT) GROUP BY r),
m AS (SELECT doc_id, p.h AS leaf, sub.h AS subroot, (SELECT h FROM u WHERE n = 1) AS root, coalesce(l, []) AS l, CASE WHEN third THEN low ELSE p.h END AS own
  FROM p JOIN sub USING (tr) LEFT JOIN w ON w.r = p.tr || '-' || p.pos),
f AS (SELECT *, sha256(array_to_string([x.a || x.b for x in l], '')) AS proof_sha256,
  list_reduce(list_prepend({{'a': '', 'b': '', 'h': own}}, l), lambda s, x: {{'a': '', 'b': '', 'h': sha256(x.a || s.h || x.b)}}).h AS folded_root FROM m)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f"""


def op12_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    found = lineblocks.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_polarisation_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the first 32 components of their covariance, scaled to variance 1."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_multi_index_hashing, op2_toxicity, op3_secrets, op4_cover_tree, op5_mixing, op6_hyperminhash, op7_suffix_array, op8_quotes, op9_language,
            op10_range_coder, op11_merkle_manifest, op12_line_blocks, op13_polarisation_whitening, pipeline,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_secrets": OP3_SQL, "op5_mixing": OP5_SQL, "op6_hyperminhash": OP6_SQL, "op11_merkle_manifest": OP11_SQL}
