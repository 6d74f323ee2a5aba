"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankforge.llm import (ann_hnsw, decontam_cgk, langid_em, merkle_manifest, mixing, quality_crf, secret_ledger, simhash_gray, suffix_dedup, topk_taat,
                           toxicity_knn, vector_codes, warc_merge)
from rankforge.llm.common import is_remainder, read


def op1_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc_merge.capture_index(read(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.repeated_spans(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", is_remainder("doc_id", 3, 1))
    crf = quality_crf.fit(docs, read(spark, sf_dir, "labels"), ~is_remainder("doc_id", 3, 1))
    return quality_crf.score(docs, crf, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted")


def op5_topk_taat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_taat.top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_ledger.secrets(read(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"].isin("assign", "access", "hex"))
    return rows.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(secret_ledger.written_spans(base).cast("binary"), 256).alias("base_sha256"),
                       secret_ledger.written_spans(F.col("found")).alias("spans"))


def op7_mixture_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", is_remainder("doc_id", 4, 2))
    models = langid_em.fit(docs, ~is_remainder("doc_id", 4, 2))
    return langid_em.identify(docs, models, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score")


def op8_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", is_remainder("doc_id", 5, 0))
    index = toxicity_knn.fit(docs, read(spark, sf_dir, "labels"), ~is_remainder("doc_id", 5, 0))
    return toxicity_knn.score(docs, index, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted")


def op9_decontam_cgk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = decontam_cgk.with_leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", F.explode("leaks").alias("x")).select("doc_id", "x.item_id", "x.distance", "x.similarity", "x.start", "x.end")


def op10_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_gray.near_duplicates(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    cols = merkle_manifest.FIELDS
    cut = F.when(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False)), F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    tampered = merkle_manifest.leaf_digest([cut if c == "text" else F.col(c) for c in cols])
    rows = merkle_manifest.manifest(docs, cols, carry={"tampered": tampered})
    folded = merkle_manifest.fold(F.col("tampered"), F.col("path"))
    return (rows.select("doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op12_ann_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_hnsw.nearest(read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = vector_codes.compress(read(spark, sf_dir, "embeddings"), keep=["label"])
    rows = vector_codes.summed_by(rows, "label", "error", "label_error")
    return rows.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


QUERIES = {f.__name__: f for f in (op1_warc_index_merge, op2_suffix_dedup, op3_pareto_mixing, op4_crf_quality, op5_topk_taat, op6_secret_ledger,
                                   op7_mixture_langid, op8_toxicity_knn, op9_decontam_cgk, op10_simhash_gray, op11_merkle_manifest, op12_ann_hnsw, op13_vector_codes)}

# p is the part, e the entry; each round assigns the parts, then takes floors of the means.
_NEAREST = """n{0} AS (SELECT r, p, any_value(x.v) AS v, arg_min(e, (list_sum(list_transform(range(1, 1 + len(x.v)), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i]))), e)) AS e,
        min(list_sum(list_transform(range(1, 1 + len(x.v)), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i])))) AS d FROM x JOIN b{0} b USING (p) GROUP BY r, p)"""
_MEANS = """s{0} AS (SELECT p, e, j, sum(v[j])::BIGINT AS s, count(*) AS n FROM n{0}, (SELECT unnest(range(1, 1 + (SELECT max(len(v)) FROM x))) AS j) GROUP BY p, e, j),
m{0} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM s{0} GROUP BY p, e),
b{1} AS (SELECT p, e, coalesce(m{0}.v, b{0}.v) AS v FROM b{0} LEFT JOIN m{0} USING (p, e))"""
_ROUNDS = ",\n".join(f"{_NEAREST.format(r)},\n{_MEANS.format(r, r + 1)}" for r in range(6)) + ",\n" + _NEAREST.format(6)

# A fill: x are the rows with what is taken so far, w the words left by source; those that fit are taken by rank while there is room.
_FILL = """w{0} AS (SELECT any_value(src) AS src, greatest(any_value(target) - any_value(sure) * any_value(source_size) - sum(extra * size), 0) AS room FROM x{0} GROUP BY src),
u{0} AS (SELECT r, room, sum(size) OVER (PARTITION BY x.src ORDER BY rank, doc_id NULLS LAST, size, r ROWS UNBOUNDED PRECEDING) AS upto, size FROM x{0} x JOIN w{0} USING (src)
  WHERE extra = 0 AND rank IS NOT NULL AND size <= {2} * room),
x{1} AS (SELECT x.* REPLACE (CASE WHEN upto - u.size * {3} <= room THEN 1 ELSE extra END AS extra) FROM x{0} x LEFT JOIN u{0} u USING (r))"""
_FILLS = ",\n".join(_FILL.format(n, n + 1, *((1, 0) if n < 2 else (2, 0.5))) for n in range(3))

ORACLES = {
    "op1_warc_index_merge": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)""",
    # Positions in hex digits: byte i is digits 2i+1, 2i+2.
    "op2_suffix_dedup": """
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
s AS (SELECT r, unnest(range(length(h) // 2 - 199)) AS i, h FROM t WHERE length(h) >= 400),
w AS (SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM s),
rep AS (SELECT r, i FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
g AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM rep),
k AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS span FROM g),
sp AS (SELECT r, span, min(i) AS a, max(i) + 200 AS b FROM k GROUP BY 1, 2),
gap AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS from_byte FROM sp),
cut AS (SELECT r, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, max(b) AS last_byte, list({'f': from_byte, 't': a} ORDER BY a) AS kept FROM gap GROUP BY 1)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN kept IS NULL THEN h ELSE array_to_string(list_transform(kept, lambda x: substr(h, 2 * x.f + 1, 2 * (x.t - x.f))), '') || substr(h, 2 * last_byte + 1) END)) AS kept_sha256
FROM t LEFT JOIN cut USING (r)""",
    # Sources are numbered (src), so that a null one joins; c is solved at every size, the largest that isn't certain counts.
    "op3_pareto_mixing": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, dense_rank() OVER (ORDER BY source NULLS LAST) AS src, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
        (('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '-') || '|' || coalesce(source, '-') || '|' || coalesce(sha256(text), '-')), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u FROM documents),
g AS (SELECT src, sum(size)::BIGINT AS source_size, ([3, 1, 2])[1 + (src - 1) % 3]::DOUBLE AS w, 2::DOUBLE * sum(size)::BIGINT AS cap FROM d GROUP BY src),
v AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level
      FROM g WINDOW o AS (ORDER BY cap / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT src, source_size, CASE WHEN cap <= w * coalesce(final, cap / w) THEN cap ELSE w * final END AS target
      FROM v, (SELECT max(level) FILTER (cap > w * level) AS final FROM v)),
m AS (SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END + 1e-9::DOUBLE) AS sure FROM t),
n AS (SELECT src, size, count(*) AS n FROM d WHERE size > 0 GROUP BY ALL),
c AS (SELECT src, size, (greatest(target - sure * source_size, 0) - coalesce(sum(n * size) OVER (PARTITION BY src ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / sum(n::DOUBLE * size * size) OVER (PARTITION BY src ORDER BY size ROWS UNBOUNDED PRECEDING) AS c FROM n JOIN m USING (src)),
o AS (SELECT src, greatest(arg_max(c, size) FILTER (c * size <= 1), 0) AS c FROM c GROUP BY src),
p AS (SELECT d.*, source_size, target, sure, least(coalesce(c, 0) * size, 1) AS p FROM d JOIN m USING (src) LEFT JOIN o USING (src)),
x0 AS (SELECT *, CASE WHEN p > 0 AND p < 1 - 1e-9::DOUBLE THEN (u / (1 - u)) / (p / (1 - p)) END AS rank, CASE WHEN p >= 1 - 1e-9::DOUBLE THEN 1 ELSE 0 END AS extra FROM p),
{_FILLS}
SELECT doc_id, size, source_size, target, (least(sure + extra, 2) * size)::BIGINT AS taken FROM x3""",
    "op5_topk_taat": """
WITH e AS (SELECT row_number() OVER () AS r, vec_id::BIGINT AS vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, 1 + least(len(q.v), len(c.v))), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.r <> c.r),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM k WHERE rank <= 5""",
    "op6_secret_ledger": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
k(kind, ord, pat, grp, least) AS (VALUES
  ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  ('access', 1, 'AKIA[A-Z0-9]+', 0, 20), ('hex', 2, '[0-9a-f]+', 0, 24)),
m AS (SELECT r, kind, ord, least,
        CASE kind WHEN 'assign' THEN regexp_extract_all(text, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)
          WHEN 'access' THEN regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0) ELSE regexp_extract_all(text, '[0-9a-f]+', 0) END AS found,
        CASE kind WHEN 'assign' THEN regexp_extract_all(text, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
          WHEN 'access' THEN regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0) ELSE regexp_extract_all(text, '[0-9a-f]+', 0) END AS judged,
        CASE kind WHEN 'assign' THEN string_split_regex(text, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)')
          WHEN 'access' THEN string_split_regex(text, 'AKIA[A-Z0-9]+') ELSE string_split_regex(text, '[0-9a-f]+') END AS pieces
      FROM d, k),
u AS (SELECT r, kind, ord, least, unnest(range(1, len(found) + 1)) AS i, found, judged, pieces FROM m),
x AS (SELECT r, kind, ord, least, i, length(found[i]) AS n, length(judged[i]) AS j, length(pieces[i]) AS before FROM u),
p AS (SELECT *, sum(before) OVER w + sum(n) OVER w - n AS s FROM x WINDOW w AS (PARTITION BY r, kind ORDER BY i)),
f AS (SELECT r, kind, ord, s, s + n AS e FROM p WHERE j >= least),
a AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || s::BIGINT || ':' || e::BIGINT, ',' ORDER BY s, ord) AS spans FROM f GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)""",
    # l is the level, i the place in it. The CRC's last bit decides; its steps: a byte of the id comes in, eight shifts (256).
    "op11_merkle_manifest": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, *, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: [ascii(c)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))), lambda a, x: CASE WHEN x < 256 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc FROM documents),
f AS (SELECT r, doc_id, source, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
        || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head, text,
        CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed FROM d),
h AS (SELECT r, doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(octet_length(encode(changed)) || ':' || changed, '-')) AS tampered FROM f),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM h),
t(s, l, i, n, h) AS (SELECT s, 0, i, n, leaf FROM o
  UNION ALL SELECT s, l + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY s, l, i // 3),
u(l, i, n, h) AS (SELECT 0, s, count(*) OVER (), h FROM t WHERE n = 1
  UNION ALL SELECT l + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY i)) FROM u WHERE n > 1 GROUP BY l, i // 3),
top AS (SELECT s, l AS height, h AS subroot FROM t WHERE n = 1),
steps AS (
  SELECT o.r, t.l, coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i < o.i // (3 ** t.l)::BIGINT), '') AS a, coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i > o.i // (3 ** t.l)::BIGINT), '') AS b
  FROM o JOIN t ON t.s = o.s AND t.n > 1 AND t.i = o.i // (3 ** t.l)::BIGINT JOIN t x ON x.s = t.s AND x.l = t.l AND x.i // 3 = t.i // 3 GROUP BY o.r, t.l
  UNION ALL
  SELECT o.r, any_value(top.height) + u.l, coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i < o.s // (3 ** u.l)::BIGINT), ''), coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i > o.s // (3 ** u.l)::BIGINT), '')
  FROM o JOIN top USING (s) JOIN u ON u.n > 1 AND u.i = o.s // (3 ** u.l)::BIGINT JOIN u x ON x.l = u.l AND x.i // 3 = u.i // 3 GROUP BY o.r, u.l),
proofs AS (SELECT r, sha256(string_agg(a || b, '' ORDER BY l)) AS proof_sha256 FROM steps GROUP BY r),
folds(r, l, h) AS (SELECT r, 0, tampered FROM o UNION ALL SELECT folds.r, folds.l + 1, sha256(a || folds.h || b) FROM folds JOIN steps ON steps.r = folds.r AND steps.l = folds.l),
ends AS (SELECT r, max_by(h, l) AS folded_root FROM folds GROUP BY r)
SELECT doc_id, leaf, subroot, u.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = u.h AS verified
FROM o JOIN top USING (s) JOIN u ON u.n = 1 JOIN ends USING (r) LEFT JOIN proofs USING (r)""",
    "op13_vector_codes": f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS (SELECT r, p, v[1 + p * (len(v) // 8) : (p + 1) * (len(v) // 8)] AS v FROM k, (SELECT unnest(range(8)) AS p)),
b0 AS (SELECT p, r - 1 AS e, v FROM x WHERE r <= 16),
{_ROUNDS},
c AS (SELECT r, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM n6 GROUP BY r),
l AS (SELECT label, sum(error)::BIGINT AS label_error FROM c JOIN k USING (r) GROUP BY label),
h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b6)
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM c JOIN k USING (r) JOIN l ON l.label IS NOT DISTINCT FROM k.label, h""",
}
