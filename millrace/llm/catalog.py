"""The dealt operators as named queries over the test tables, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import ship
from . import bagminhash, chat, decontaminate, fingerprints, langid, licenses, negatives, packing, pieces, secret_scan, substrings, toxicity, trie

QUERIES, ORACLES = {}, {}


def query(name, oracle=None):
    def keep(function):
        def run(spark, folder):
            ship(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return keep


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: A word of the plain kind in SQL: A-Z lowered, other letters as they are.
PLAIN_WORDS = """regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""


@query(
    "op3_decontaminate",
    f"""
WITH d AS (SELECT doc_id, coalesce({PLAIN_WORDS.format(text="text")}, []) AS w FROM documents),
b AS (SELECT item_id, {PLAIN_WORDS.format(text="text")} AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)
),
dw AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)
),
m AS (SELECT doc_id, i, k, item_id FROM dw JOIN bw USING (k, gram)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM m) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
""",
)
def op3_decontaminate(spark, folder):
    found = decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("longest")


@query("op4_fingerprints")
def op4_fingerprints(spark, folder):
    return fingerprints.compare(table(spark, folder, "documents"))


@query(
    "op10_chat_perspectives",
    """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations
),
p AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
s AS (
  SELECT conv_id, speaker, turn, role, text, role = speaker AS own,
    '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN role
      ELSE 'user name=' || replace(role, '<|', '< |') END || chr(10) || text || '<|im_end|>' || chr(10) AS segment
  FROM t JOIN p USING (conv_id)
),
o AS (
  SELECT *, row_number() OVER w AS pos, sum(length(segment)) OVER (w ROWS UNBOUNDED PRECEDING) - 1 AS til
  FROM s WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, speaker, count(*) AS n_turns, count(*) FILTER (own) AS n_masked, length(string_agg(segment, '' ORDER BY pos)) AS n_chars,
  string_agg(segment, '' ORDER BY pos) AS rendered,
  string_agg((til - length(text) - 10)::BIGINT || ':' || til::BIGINT, ',' ORDER BY pos) FILTER (own) AS mask
FROM o GROUP BY conv_id, speaker
""",
)
def op10_chat_perspectives(spark, folder):
    return chat.perspectives(table(spark, folder, "conversations"))


@query(
    "op9_substrings",
    """
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)
),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS n FROM g),
x AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM r WHERE n > 1),
k AS (SELECT doc_id, w[p] AS word, p FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM d) ANTI JOIN x USING (doc_id, p)),
s AS (SELECT doc_id, count(*) AS n, sha256(string_agg(word, ' ' ORDER BY p)) AS sha FROM k GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, coalesce(sha, sha256('')) AS kept_sha256 FROM d LEFT JOIN s USING (doc_id)
""",
)
def op9_substrings(spark, folder):
    return substrings.dedup(table(spark, folder, "documents"))


@query("op1_near_duplicates")
def op1_near_duplicates(spark, folder):
    return bagminhash.classes(table(spark, folder, "documents"))


@query("op5_licenses")
def op5_licenses(spark, folder):
    return licenses.scan(table(spark, folder, "documents"))


@query("op7_secrets")
def op7_secrets(spark, folder):
    return secret_scan.scan(table(spark, folder, "documents"))


@query("op6_languages")
def op6_languages(spark, folder):
    return langid.held_out_predictions(table(spark, folder, "documents"))


@query("op8_pieces")
def op8_pieces(spark, folder):
    docs = table(spark, folder, "documents")
    coded = pieces.encode(docs.select("doc_id", "text"), keep=True)
    return coded.select(
        "doc_id", F.size(F.coalesce("ids", F.array())).cast("long").alias("n_pieces"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"), F.coalesce(F.col("decoded").eqNullSafe(F.replace("text", F.lit(pieces.SPACE), F.lit(" "))), F.lit(False)).alias("exact"),
    )


@query("op2_toxicity")
def op2_toxicity(spark, folder):
    return toxicity.predictions(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op12_packing")
def op12_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


#: CRC-32 of the text ``{text}`` of ASCII characters, bit by bit.
CRC32 = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


@query(
    "op11_prefixes",
    f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (SELECT conv_id, {CRC32.format(text="conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS part, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND p <= h
  UNION ALL
  SELECT conv_id, 1, p, role, text FROM t JOIN c USING (conv_id) WHERE p > h
),
u AS (
  SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
    sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, ',') OVER w) AS node
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, p ROWS UNBOUNDED PRECEDING)
),
m AS (SELECT conv_id, depth, node, words FROM u UNION ALL SELECT conv_id, 0, '', 0 FROM c),
l AS (SELECT conv_id, max(depth) AS depth FROM m GROUP BY conv_id),
e AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends FROM l JOIN m USING (conv_id, depth) GROUP BY node),
n AS (SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(words) AS words FROM m GROUP BY node),
k AS (
  SELECT n.node, p.node AS up, q.conv_id AS parent_conv_id FROM n JOIN m p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 JOIN n q ON q.node = p.node
),
f AS (SELECT up AS node, count(*) AS n_children FROM k GROUP BY up),
s AS (
  SELECT m.node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * n.words) AS saved
  FROM n JOIN m USING (conv_id) LEFT JOIN f ON f.node = n.node WHERE m.depth <= n.depth GROUP BY m.node
)
SELECT n.conv_id, n.depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved::BIGINT AS saved_tokens,
  sha256(coalesce(ends, '')) AS ends_sha256
FROM n JOIN s USING (node) LEFT JOIN k USING (node) LEFT JOIN f USING (node) LEFT JOIN e USING (node)
""",
)
def op11_prefixes(spark, folder):
    return trie.rebuilt_prefixes(table(spark, folder, "conversations")).drop("n_words", "prefix_words")


@query(
    "op13_hard_negatives",
    """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
""",
)
def op13_hard_negatives(spark, folder):
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows, label=label)
