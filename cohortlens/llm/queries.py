"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import bpe_speculative, collocations, decontaminate, exact_recipes, hard_negatives, language_zstd, line_chunks
from cohortlens.llm import minhash_tensor, mixing, pii_bootstrap, secrets_crf, token_orc, toxicity
from cohortlens.llm.common import read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt from the labels that are not held out."""
    docs, out = read(spark, sf_dir, "documents"), toxicity.held_out(F.col("doc_id"))
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"), toxicity.not_held_out)
    return toxicity.score(docs, model).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Systematic sampling of all documents to source targets."""
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source", mixing.words("text").alias("size")), F.col("size"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to ORC and read back."""
    return token_orc.encode_and_reread(read(spark, sf_dir, "documents"))


def op4_exact_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents by chunk recipes."""
    return exact_recipes.duplicates(read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, and where."""
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of lines found elsewhere, and what is removed of them."""
    return line_chunks.report(read(spark, sf_dir, "documents"))


def op7_secrets_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: base patterns and a CRF."""
    docs = read(spark, sf_dir, "documents")
    return secrets_crf.secrets(docs, secrets_crf.learn(docs))


def op9_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: base patterns and bootstrapped contexts."""
    return pii_bootstrap.personal_data(read(spark, sf_dir, "documents"))


def op8_minhash_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents by tensored MinHash bands."""
    return minhash_tensor.near_duplicates(read(spark, sf_dir, "documents"))


def op10_language_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learnt from those that are not held out."""
    docs, out = read(spark, sf_dir, "documents"), toxicity.held_out(F.col("doc_id"))
    found = language_zstd.identify(docs, language_zstd.sample(docs, ~out))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "accepted")


def op11_bpe_speculative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level token ids of all documents, and what they decode to."""
    return bpe_speculative.round_trip(read(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two or three words of each language, over all documents."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector among all vectors; the labels of every seventh are moved on by one."""
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP2_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, source_size * 3 AS lim, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
l AS (SELECT *, row_number() OVER o AS k, coalesce(sum(lim) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS given, sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS rest, (sum(source_size) OVER ())::BIGINT AS total FROM w WINDOW o AS (ORDER BY lim::DOUBLE / weight, source NULLS LAST)),
f AS (SELECT k, given, rest FROM l WHERE lim * rest >= weight * (total - given) ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN l.k < f.k THEN lim::DOUBLE ELSE (weight * (total - f.given))::DOUBLE / f.rest END AS target FROM l, f),
p AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e, ('0x' || substr(md5(coalesce(d.source, '') || 'mix-1'), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u, row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC, d.doc_id NULLS FIRST) AS r FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * least(3, floor(r * e + u) - floor((r - 1) * e + u)))::BIGINT AS taken FROM p
"""

OP4_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain, length(coalesce(text, '')) AS chars FROM documents),
r AS (SELECT doc_id, sha256(plain) AS text_sha256, first_value(doc_id) OVER o AS keep_id, row_number() OVER o AS k, count(*) OVER (PARTITION BY plain) AS group_size FROM n WINDOW o AS (PARTITION BY plain ORDER BY chars DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM r
"""

OP6_SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM d),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM l),
b AS (SELECT *, lag(line) OVER o AS prev, lag(h) OVER o AS ph FROM h WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
j AS (SELECT *, i > 0 AND count(*) OVER (PARTITION BY prev, line) > 1 AS joined FROM b),
c AS (SELECT doc_id, line, i, seed, CASE WHEN NOT joined OR seed = 4 OR (seed > 0 AND ((ph * (7919 + seed * 104) + h * 31 + seed * 2654435761) % 4294967296) // 512 % 2 = 0) THEN 1 ELSE 0 END AS starts FROM j, (SELECT unnest(range(5)) AS seed)),
g AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id, seed ORDER BY i) AS k FROM c),
k AS (SELECT doc_id, seed, min(i) AS first, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS chunk FROM g GROUP BY doc_id, seed, k),
w AS (SELECT *, len(regexp_extract_all(chunk, '[^ 	-
]+')) AS words FROM k),
r AS (SELECT *, count(*) OVER (PARTITION BY seed, chunk) AS copies, first_value(doc_id) OVER o AS first_doc, row_number() OVER o AS place FROM w WHERE (n >= 2 AND words >= 10) OR words >= 50 WINDOW o AS (PARTITION BY seed, chunk ORDER BY doc_id NULLS FIRST, first)),
x AS (SELECT doc_id, place = 1 AS keeps, unnest(range(first, first + n)) AS i, first_doc FROM r WHERE copies > 1),
y AS (SELECT doc_id, list_sort(list_distinct(list(i) FILTER (NOT keeps))) AS gone, list_distinct(list(i) FILTER (keeps)) AS held, list_sort(list_distinct(list(first_doc) FILTER (NOT keeps))) AS firsts FROM x GROUP BY doc_id)
SELECT doc_id, coalesce(len(gone), 0) AS removed_lines, coalesce(array_to_string(gone, ','), '') AS removed, coalesce(len(held), 0) - coalesce(len(list_intersect(held, gone)), 0) AS shared_lines, coalesce(array_to_string(firsts, ','), '') AS first_doc_ids FROM y
"""

OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text, row_number() OVER () AS d FROM documents),
p AS (SELECT lang, d, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece, generate_subscripts(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]'), 1) AS p FROM d),
s AS (SELECT lang, d, p, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
w AS (SELECT lang, unnest(ws) AS w1, unnest(ws[2:] || [NULL]) AS w2, unnest(ws[3:] || [NULL, NULL]) AS w3 FROM s WHERE len(ws) > 0),
u AS (SELECT lang, w1, w2, w3 FROM w WHERE w1 IS NOT NULL),
c AS (SELECT lang, count(*) AS n FROM u GROUP BY lang),
f1 AS (SELECT lang, w1, count(*) AS f FROM u GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM u WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM u WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
held AS (SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
two AS (SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, x.f AS l, y.f AS r, 1 AS k FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
  LEFT JOIN held h ON h.lang = f2.lang AND h.w1 = f2.w1 AND h.w2 = f2.w2 WHERE h.f IS NULL OR 100 * h.f < 50 * f2.f),
three AS (SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3 AS phrase, f3.f AS a, unnest([x.f, xy.f]) AS l, unnest([yz.f, z.f]) AS r, unnest([1, 2]) AS k FROM f3
  JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f1 z ON z.lang = f3.lang AND z.w1 = f3.w3
  JOIN f2 xy ON xy.lang = f3.lang AND xy.w1 = f3.w1 AND xy.w2 = f3.w2 JOIN f2 yz ON yz.lang = f3.lang AND yz.w1 = f3.w2 AND yz.w2 = f3.w3),
cuts AS (SELECT *, (a::HUGEINT * a * 1000000 // (l::HUGEINT * r))::BIGINT AS score FROM (SELECT * FROM two UNION ALL SELECT * FROM three)),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN c USING (lang) WHERE rank <= 2000
"""

OP13_SQL = r"""
WITH v AS (SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score FROM v a JOIN v r ON a.id <> r.id WHERE a.id % 50 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER o)::INTEGER AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW o AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) QUALIFY row_number() OVER o <= 3
"""

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_mixing": op2_mixing,
    "op3_token_orc": op3_token_orc,
    "op4_exact_recipes": op4_exact_recipes,
    "op5_decontaminate": op5_decontaminate,
    "op6_line_chunks": op6_line_chunks,
    "op7_secrets_crf": op7_secrets_crf,
    "op8_minhash_tensor": op8_minhash_tensor,
    "op9_pii_bootstrap": op9_pii_bootstrap,
    "op10_language_zstd": op10_language_zstd,
    "op11_bpe_speculative": op11_bpe_speculative,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE = {"op2_mixing": OP2_SQL, "op4_exact_recipes": OP4_SQL, "op6_line_chunks": OP6_SQL, "op12_collocations": OP12_SQL, "op13_hard_negatives": OP13_SQL}
