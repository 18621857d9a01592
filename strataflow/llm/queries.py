"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import (centroids, chat, decontaminate, langid, packing, passages, pii, sharding, simhash, spotsigs,
                            toxicity, vectors, whitening)
from strataflow.llm.common import crc_bucket, read_table


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    labels = read_table(spark, sf_dir, "labels").where(crc_bucket("doc_id", 3) != 1)
    return toxicity.fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_model(spark, docs, sf_dir).score(docs, drop=("text",))
    return scored.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.with_digest(passages.remove_repeats(docs, with_text=False)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP2_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS MATERIALIZED (SELECT r, p, md5_number(substr(x, 2 * p + 1, 400)) AS h
      FROM d, unnest(range(0, greatest(len(x) // 2 - 199, 0))) AS t(p)),
hits AS (SELECT r, p FROM w SEMI JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
starts AS (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 200 THEN 0 ELSE 1 END AS new FROM hits),
runs AS (SELECT r, min(p) AS a, max(p) + 200 AS b
         FROM (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS run FROM starts) GROUP BY r, run),
gone AS (SELECT r, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b
         FROM runs GROUP BY r)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN a IS NULL THEN x ELSE array_to_string(list_transform(range(0, len(a) + 1), lambda i:
    substr(x, 2 * coalesce(b[i], 0) + 1, 2 * (coalesce(a[i + 1], len(x) // 2) - coalesce(b[i], 0)))), '') END)) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
"""


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), drop=("text",))
    return decontaminate.with_digest(marked).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, w[p:p + least(10, len(w)) - 1] AS g
  FROM i, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
grams AS (
  SELECT r, n, p, w[p:p + n - 1] AS g FROM d, sizes, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS t(p)),
hits AS (SELECT r, n, p, item_id FROM grams JOIN win USING (g)),
words AS (SELECT r, count(DISTINCT q) AS n_hit FROM hits, unnest(range(p, p + n)) AS t(q) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.with_digest(pii.find_pii(docs, drop=("text",))).select(
        "doc_id", *[f"n_{k}" for k in pii.BASE], "base_sha256", "spans")


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, size = vectors.build_index(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return vectors.nearest(index, size, index.where("vec_id % 100 = 0"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.format_pairs(chat.with_other_answers(chat.pair_by_opening(chat.conversations(turns))))
    return made.select(
        "chosen_id", "rejected_id", "n_common", "prompt", "chosen_completion", "rejected_completion",
        *[F.array_join(F.transform(f"{side}_mask", lambda x: F.concat_ws(
            ":", x["start"].cast("string"), x["end"].cast("string"))), ",").alias(f"{side}_mask")
          for side in ("chosen", "rejected")])


def _side_sql(side: str, turns: str) -> str:
    """The completion and its mask from the turns after the common ones."""
    return f"""array_to_string({turns}, '') AS {side}_completion,
  array_to_string(list_transform(list_filter(range(1, len({turns}) + 1), lambda i: {side}_rest[i].role = 'assistant'),
    lambda i: CAST(coalesce(list_sum(list_transform({turns}[1:i - 1], lambda t: length(t))), 0) + 22 AS BIGINT) || ':' ||
         CAST(coalesce(list_sum(list_transform({turns}[1:i], lambda t: length(t))), 0) - 1 AS BIGINT)), ',') AS {side}_mask"""


# 22: the letters of the opening mark, the role and the line break before an assistant's words
OP6_SQL = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn, role, text) AS turns FROM t GROUP BY 1),
k AS (SELECT *, row_number() OVER w AS n, lead(conv_id) OVER w AS other_id, lead(turns) OVER w AS other
      FROM c WINDOW w AS (PARTITION BY turns[1] ORDER BY conv_id)),
o AS (SELECT *, CASE WHEN other_id IS NULL THEN list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant'))
             END AS said FROM k WHERE n % 2 = 1),
l AS (SELECT conv_id, turns[said].text AS answer, row_number() OVER (ORDER BY conv_id) AS place, count(*) OVER () AS many
      FROM o WHERE said IS NOT NULL),
g AS (SELECT x.conv_id, y.conv_id AS donor, y.answer FROM l AS x JOIN l AS y ON y.place = x.place % x.many + 1 WHERE x.many > 1),
p AS (SELECT o.*, donor, answer, other_id IS NOT NULL AND length(other[-1].text) > length(turns[-1].text) AS swap
      FROM o LEFT JOIN g USING (conv_id)),
q AS (SELECT CASE WHEN swap THEN other_id ELSE conv_id END AS chosen_id,
             CASE WHEN swap THEN conv_id ELSE coalesce(other_id, donor) END AS rejected_id,
             CASE WHEN swap THEN other ELSE turns END AS a,
             CASE WHEN swap THEN turns WHEN other_id IS NOT NULL THEN other WHEN donor IS NOT NULL
                  THEN list_append(turns[1:said - 1], struct_pack(role := turns[said].role, text := answer)) ELSE [] END AS b FROM p),
m AS (SELECT *, CAST(coalesce(list_min(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] IS DISTINCT FROM b[i])) - 1,
                              least(len(a), len(b))) AS INTEGER) AS n_common FROM q),
r AS (SELECT *, a[n_common + 1:] AS chosen_rest, b[n_common + 1:] AS rejected_rest FROM m),
s AS (SELECT *, {", ".join(f"list_transform({x}, lambda t: '<|im_start|>' || t.role || chr(10) || replace(t.text, '<|', '< |') || '<|im_end|>' || chr(10)) AS {y}"
                           for x, y in (("a[1:n_common]", "same"), ("chosen_rest", "chosen_said"), ("rejected_rest", "rejected_said")))} FROM r)
SELECT chosen_id, rejected_id, n_common, array_to_string(same, '') AS prompt, {_side_sql("chosen", "chosen_said")},
  {_side_sql("rejected", "rejected_said")} FROM s
"""


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs, words=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = langid.learn(docs.where(crc_bucket("doc_id", 5) != 0))
    return langid.predict(docs.select("doc_id", "text"), prototypes, drop=("text",)).select(
        "doc_id", (crc_bucket("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", F.char_length("text").alias("n_chars"))
    # a duplicate cluster is a component of near copies
    clustered = simhash.add_components(docs, words=3, max_bits=2, drop=("text",))
    return packing.pack(clustered, chars_col="n_chars", cluster_col="component_id")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign(docs, drop=("text",))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _op11_sql(rounds: int = 10) -> str:
    """The rounds written out one after the other: a<r> assigns, c<r> moves the centroids."""
    parts = ["""v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
      list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64)""",
             "e AS MATERIALIZED (SELECT r, i, x[i] AS x FROM v, unnest(range(1, 65)) AS t(i))",
             """c0 AS MATERIALIZED (SELECT k, i, x AS c FROM e JOIN (SELECT r, row_number() OVER (
      ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), x) - 1 AS k FROM v QUALIFY k < 8) USING (r))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT r, k, d FROM (
      SELECT r, k, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM e JOIN c{r} USING (i) GROUP BY r, k)
      QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT k, i, CAST(coalesce((s - ((s % n) + n) % n) // n, c) AS BIGINT) AS c
      FROM c{r} LEFT JOIN (SELECT k, i, sum(x) AS s, count(*) AS n FROM e JOIN a{r} USING (r) GROUP BY k, i) USING (k, i))""")
    return f"""WITH {", ".join(parts)},
h AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a{rounds} JOIN v USING (r) JOIN h USING (k)"""


def op12_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.against_edits(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def _jaccard_sql(x: str, y: str) -> str:
    return f"""CASE WHEN len({x}) + len({y}) = 0 THEN CAST(1 AS DOUBLE)
    ELSE CAST(len(list_intersect({x}, {y})) AS DOUBLE) / (len({x}) + len({y}) - len(list_intersect({x}, {y}))) END"""


# t: each text and its edited text under an odd number; c counts the content words up to a word
OP12_SQL = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY doc_id DESC) AS r, doc_id, coalesce(text, '') AS text,
    coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC), '') AS other
  FROM documents),
t AS MATERIALIZED (
  SELECT 2 * r AS t, text FROM d UNION ALL
  SELECT 2 * r + 1, substr(text, 1, length(text) - length(text) // 3) || substr(other, 1, length(text) // 3) FROM d),
w AS MATERIALIZED (
  SELECT t, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t),
p AS (
  SELECT t, i, w[i] AS word, w[i] IN ({", ".join(f"'{a}'" for a in sorted(spotsigs.ANCHORS))}) AS anchor
  FROM w, unnest(range(1, len(w) + 1)) AS u(i)),
n AS MATERIALIZED (SELECT *, sum(CAST(NOT anchor AS INTEGER)) OVER (PARTITION BY t ORDER BY i) AS c FROM p),
o AS (SELECT t, c, word, lead(word) OVER (PARTITION BY t ORDER BY i) AS after FROM n WHERE NOT anchor),
s AS (
  SELECT DISTINCT n.t, substr(md5(n.word || ' ' || o.word || ' ' || o.after), 1, 16) AS s
  FROM n JOIN o ON n.t = o.t AND o.c = n.c + 1 WHERE n.anchor AND o.after IS NOT NULL),
f AS MATERIALIZED (
  SELECT t, coalesce(l, CASE WHEN len(w) > 0 THEN [substr(md5(array_to_string(w, ' ')), 1, 16)] ELSE [] END) AS l
  FROM w LEFT JOIN (SELECT t, list(s ORDER BY s) AS l FROM s GROUP BY t) USING (t)),
j AS (
  SELECT d.doc_id, length(d.text) AS n_chars, sha256(t.text) AS edited_sha256, a.l AS a, b.l AS b, c.l AS c
  FROM d JOIN f AS a ON a.t = 2 * d.r JOIN f AS b ON b.t = 2 * d.r + 1 JOIN t ON t.t = 2 * d.r + 1
  JOIN f AS c ON c.t = 2 * CASE WHEN d.r = (SELECT max(r) FROM d) THEN 1 ELSE d.r + 1 END)
SELECT doc_id, n_chars, edited_sha256, array_to_string(a, '') AS fingerprint, array_to_string(b, '') AS edited_fingerprint,
  {_jaccard_sql("a", "b")} AS near_edited, {_jaccard_sql("a", "c")} AS near_next
FROM j
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = whitening.whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return made.withColumn("deviation", F.col("deviation").try_cast("long"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_toxicity, op2_passages, op3_decontaminate, op4_pii, op5_vectors, op6_chat, op7_simhash, op8_langid,
        op9_packing, op10_sharding, op11_centroids, op12_spotsigs, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op2_passages": OP2_SQL, "op3_decontaminate": OP3_SQL, "op6_chat": OP6_SQL,
            "op11_centroids": _op11_sql(), "op12_spotsigs": OP12_SQL}
