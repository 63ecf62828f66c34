"""The operators applied to their whole tables, with SQL counterparts where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalens.llm import chat, embeddings, html, licenses, lines, mixing, orderminhash, phrases, pieces, ranking, simhash, toxicity, urls
from catalog_queries.registry import query


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op8_simhash_components")
def op8(spark, sf):
    return simhash.simhash_components(_table(spark, sf, "documents"))


OP10_SQL = """
WITH lines AS (
  SELECT doc_id, i, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)
), holders AS (
  SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), judged AS (
  SELECT l.*, h.first IS NOT NULL AND h.first < l.doc_id AS gone FROM lines l LEFT JOIN holders h USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op10_line_dedup", OP10_SQL)
def op10(spark, sf):
    kept = lines.dedup_lines(_table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op5_toxicity_scores")
def op5(spark, sf):
    docs = _table(spark, sf, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, _table(spark, sf, "labels")))


@query("op4_source_mix")
def op4(spark, sf):
    mixed = mixing.mix(mixing.document_sizes(_table(spark, sf, "documents")), "sources", "size", row_id="row_key")
    return mixed.select("doc_id", "size", F.col("source_size")[0].alias("source_size"), F.col("target")[0].alias("target"), "taken")


@query("op9_sampled_pieces")
def op9(spark, sf):
    decoded = pieces.encode(_table(spark, sf, "documents"), pieces.PIECE_MODEL, with_decoded=True)
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op1_license_scan", licenses.scan_sql())
def op1(spark, sf):
    return licenses.scan(_table(spark, sf, "documents"))


OP2_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0)
  WHERE list_dot_product(v, v) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98
), reached AS (
  SELECT DISTINCT a, a AS b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), parts AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a
), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN parts p ON p.a = vec_id LEFT JOIN counts c ON c.a = vec_id
"""


@query("op2_near_vectors", OP2_SQL)
def op2(spark, sf):
    return embeddings.near_vectors(_table(spark, sf, "embeddings"))


@query("op3_url_filter")
def op3(spark, sf):
    return urls.judge_urls(_table(spark, sf, "pages"), _table(spark, sf, "labels"))


@query("op6_main_text")
def op6(spark, sf):
    pages = _table(spark, sf, "pages")
    return html.extract(pages, html.fit(pages))


@query("op7_order_minhash")
def op7(spark, sf):
    return orderminhash.fingerprints_with_edits(_table(spark, sf, "documents"))


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER_SQL}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), word_lists AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces
), sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM word_lists GROUP BY lang
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
    FROM word_lists, (VALUES (1), (2), (3), (4)) t(k) WHERE len(w) >= k
  ) GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, cut, string_split(c.phrase, ' ') AS w
  FROM f c, (VALUES (1), (2), (3)) t(cut) WHERE cut < c.k
), scored AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, h.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (h.f::HUGEINT + r.f) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(list_slice(w, 1, cut), ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(list_slice(w, cut + 1, c.k), ' ')
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase, max(a) AS around
  FROM (SELECT lang, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 2), (VALUES (2), (3)) s(m), (VALUES (1), (2), (3)) t(i)
  WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), ranked AS (
  SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
  FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE i.around IS NULL OR 100 * i.around < 80 * w.a
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""


@query("op12_phrase_collocations", OP12_SQL)
def op12(spark, sf):
    return phrases.collocations(_table(spark, sf, "documents"))


OP13_SQL = f"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWER_SQL}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM documents
), asked AS (
  SELECT item_id, t, count(*) AS k
  FROM (SELECT item_id, unnest(regexp_extract_all({LOWER_SQL}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark) GROUP BY ALL
), sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
), whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS length FROM sizes
), tf AS (SELECT doc_id, t, count(*) AS tf FROM terms WHERE t IN (SELECT t FROM asked) GROUP BY ALL
), weight AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY t, n_docs
), added AS (
  SELECT tf.doc_id, tf.t, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // length))) AS c
  FROM tf JOIN weight USING (t) JOIN sizes USING (doc_id), whole
), scores AS (
  SELECT item_id, doc_id, sum(k * c)::BIGINT AS score FROM asked JOIN added USING (t) GROUP BY item_id, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
) WHERE rank <= 20
"""


@query("op13_ranked_search", OP13_SQL)
def op13(spark, sf):
    return ranking.search(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


OP11_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), shown AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         length(regexp_replace(coalesce(text, ''), '([<\[]\\*)(/?s>|/?INST\]|/?ROLE\]|/TURN\]|<SYS>>|</SYS>>)', '\1\\\2', 'g')) AS chars,
         length(regexp_replace(coalesce(role, ''), '([<\[]\\*)(/?s>|/?INST\]|/?ROLE\]|/TURN\]|<SYS>>|</SYS>>)', '\1\\\2', 'g')) AS role_chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(chars + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 19 WHEN 'assistant' THEN 6 ELSE 20 + role_chars END))::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""


@query("op11_chat_format", OP11_SQL)
def op11(spark, sf):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.format_conversations(chat.threads(rows), "msg_id", "parent_id", carry=["conv_id"])
    read = chat.read_back(formatted)
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
