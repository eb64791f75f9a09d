"""The registered queries of the training-data operators, and their SQL where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import (
    bin_slack, bottomk_dedup, chat_repair, chat_rotation, lexical_search, lsh_forest, mixture_shards, mtree_topk, ordinal_toxicity, quality_crf,
    secret_battery, sentence_pieces, substring_dedup,
)
from tripweave.llm.batches import read

SHARDS = 16
GOOD = 0.7
#: Rows whose id this number divides are the queries of the vector searches, and their results each.
ASKED, K = 50, 5
CAPACITY = 1024
BYTE_BPE_END = 2
RANKED, WINDOW = 50, 50


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = quality_crf.fit(docs, labels.where(~quality_crf.held_out()))
    return quality_crf.score(docs, model, keep=["doc_id"]).select(
        "doc_id", quality_crf.held_out().alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_battery.scan(read(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("found", lambda s: s["kind"] != "random")
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
    )


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.nearest(read(spark, sf_dir, "embeddings"), F.col("id") % ASKED == 0, K)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = chat_rotation.rotate(read(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return rotated.select(
        "conv_id", "participant", "piece", "n_turns", "rendered", F.array_join(spans, ",").alias("mask")
    )


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk_dedup.near_duplicates(read(spark, sf_dir, "documents"), words=3, percent=85)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = ordinal_toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return ordinal_toxicity.score(docs, model, keep=["doc_id"])


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = sentence_pieces.encode(read(spark, sf_dir, "documents"), model, keep=["doc_id"])
    decoded = sentence_pieces.decode(encoded, model, keep=["doc_id", "n_tokens", "ids"])
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def packed_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")  # the vocabulary of byte_bpe_50k.json as ranks
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    pieces = bin_slack.tokenize(docs, path, vocabulary, keep=["doc_id"], end_id=BYTE_BPE_END, capacity=CAPACITY)
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return bin_slack.pack(spark, pieces, capacity=CAPACITY)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(spark, read(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = mixture_shards.shard(read(spark, sf_dir, "documents"), SHARDS)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree_topk.largest(read(spark, sf_dir, "embeddings"), F.col("id") % ASKED == 0, K)


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=RANKED)


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring_dedup.deduplicate(read(spark, sf_dir, "documents"), window=WINDOW)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    found = chat_repair.repair(chat_repair.damage(rows))
    columns = ["c", *chat_repair.FIGURES, "sha256"]
    hashed = found.long.join(chat_repair.digests(found.spans).select(F.struct("n", "v").alias("g"), "sha256"), "g").select(*columns).unionByName(
        found.short.withColumn("sha256", F.sha2(chat_repair.lines().cast("binary"), 256)).select(*columns)
    )
    zero, counts = F.lit(0).cast("long"), ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    whole = rows.select(F.col("conv_id")).distinct().join(hashed, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return whole.select(
        "conv_id", *[F.coalesce(F.col(x).cast("long"), zero).alias(x) for x in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    "op1_quality": op1_quality,
    "op2_secrets": op2_secrets,
    "op3_nearest": op3_nearest,
    "op4_chat": op4_chat,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_toxicity": op6_toxicity,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_packing": op8_packing,
    "op9_sharding": op9_sharding,
    "op10_topk": op10_topk,
    "op11_lexical": op11_lexical,
    "op12_substrings": op12_substrings,
    "op13_repair": op13_repair,
}

# DuckDB has no crc32: its table of 256 values is made from the polynomial, then folded over the bytes.
_CRC32 = """
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i, i::UBIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
crc_text AS (
  SELECT text, xor(list_reduce(list_prepend(4294967295::UBIGINT,
           list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::UBIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) AS crc
  FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL), crc_table
)"""

# Digits, ASCII letters and everything beyond ASCII.
_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"



def _repair_sql() -> str:
    """Damage, faults and the cheapest edits: a step of the recursion takes one more row of every conversation."""
    kept = "damaged.role || ':' || damaged.text"
    cell = lambda c, a, t: f"{{'c': {c}, 'a': {a}, 't': {t}}}"
    after = lambda s, cost, edit, line: cell(f"{s}.c + {cost}", f"{s}.a || '{edit}'", f"{s}.t || {line}" if line else f"{s}.t")
    least = lambda *cells: f"list_min([{', '.join(cells)}])"
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    extra = "CASE fault WHEN 't' THEN 5 ELSE 0 END"

    def taken(s: str, role: str, initial: str) -> str:
        """The row kept if its role has the initial, else given the role."""
        keep = after(s, extra, "K", f"chr(10) || {kept}")
        change = after(s, f"1 + {extra}", "R", f"chr(10) || '{role}:' || damaged.text") if role else none
        return f"CASE WHEN fault IN ('b', 'd') THEN {none} WHEN left(damaged.role, 1) = '{initial}' THEN {keep} ELSE {change} END"

    none = cell("1000000000::BIGINT", "'~'", "''")
    rows = [after(f"s{i}", 2, "D", "") for i in range(4)]
    row = [
        rows[0], least(rows[1], taken("s0", "", "s")), least(rows[2], *(taken(f"s{i}", "user", "u") for i in (0, 1, 3))),
        least(rows[3], taken("s2", "assistant", "a")),
    ]
    users = lambda n: least(f"{n}2", *(after(f"{n}{i}", 5, "I", user) for i in (0, 1, 3)))
    return f"""
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i, i::UBIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS o_role, coalesce(text, ' ') AS o_text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS seed FROM conversations
), kinds AS (
  SELECT seed, xor(list_reduce(list_prepend(4294967295::UBIGINT,
           list_transform(regexp_extract_all(hex(encode(seed)), '..'), lambda x: ('0x' || x)::UBIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % 20 AS kind
  FROM (SELECT DISTINCT seed FROM named), crc_table
), copies AS (
  SELECT conv_id, turn, o_role, o_text, k, CASE kind WHEN 4 THEN 'user' ELSE o_role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(o_text, '[.!?]', '', 'g') ELSE o_text END AS text
  FROM named JOIN kinds USING (seed), range(2) c(k) WHERE kind <> 0 AND (k = 0 OR kind = 3)
), numbered AS (
  SELECT coalesce(conv_id::VARCHAR, '') AS g, conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, o_role, o_text, k) AS i FROM copies
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed,
         left(lag(role) OVER (PARTITION BY g ORDER BY i), 1) || left(role, 1) AS pair FROM numbered
), damaged AS MATERIALIZED (
  SELECT *, CASE WHEN trimmed = '' THEN 'b' WHEN again THEN 'd' WHEN right(trimmed, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM seen
), walk AS (
  SELECT g, 0::BIGINT AS i, {cell('0::BIGINT', "''", "''")} AS s0, {none} AS s1, {cell('5::BIGINT', "'I'", user)} AS s2,
         {cell('10::BIGINT', "'II'", user + ' || ' + assistant)} AS s3 FROM (SELECT DISTINCT g FROM damaged)
  UNION ALL
  SELECT g, i, n0, n1, m2, {least('n3', after('m2', 5, 'I', assistant))} FROM (
    SELECT g, i, n0, n1, n3, {users('n')} AS m2 FROM (
      SELECT walk.g, damaged.i, {', '.join(f'{x} AS n{k}' for k, x in enumerate(row))} FROM walk JOIN damaged ON damaged.g = walk.g AND damaged.i = walk.i + 1
    )
  )
), best AS (SELECT g, arg_max({least('s0', 's3')}, i) AS e FROM walk GROUP BY g),
counts AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM damaged GROUP BY g
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.c, 0)::BIGINT AS cost,
       coalesce(e.a, '') AS audit, sha256(coalesce(substr(e.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) w LEFT JOIN counts ON counts.g = coalesce(w.conv_id::VARCHAR, '') LEFT JOIN best ON best.g = counts.g"""


ORACLE_SQL = {
    "op4_chat": f"""
WITH turns AS (
  SELECT DISTINCT conv_id, coalesce(turn::BIGINT, {chat_rotation.NO_TURN}) AS turn, coalesce(role, 'unknown') AS speaker,
         coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), cut_up AS (
  SELECT *, (sum(strlen(speaker) + strlen(text)) OVER (PARTITION BY conv_id ORDER BY turn, speaker, text) - strlen(speaker) - strlen(text))::BIGINT
            // {chat_rotation.PIECE_BYTES} AS piece
  FROM turns
), seen AS (
  SELECT t.*, w.participant, replace(t.text, '<|', '< |') || '<|im_end|>' || chr(10) AS body,
         CASE WHEN t.speaker = 'system' THEN '<|im_start|>system' WHEN t.speaker = w.participant THEN '<|im_start|>assistant'
              ELSE '<|im_start|>user name=' || replace(t.speaker, '<|', '< |') END || chr(10) AS head
  FROM cut_up t JOIN (SELECT DISTINCT conv_id, speaker AS participant FROM turns WHERE speaker <> 'system') w USING (conv_id)
), placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (
           PARTITION BY conv_id, participant, piece ORDER BY turn, speaker, text) - length(body) AS pos
  FROM seen
)
SELECT conv_id, participant, piece, count(*) AS n_turns, string_agg(head || body, '' ORDER BY turn, speaker, text) AS rendered,
       coalesce(string_agg(pos::BIGINT || ':' || (pos + length(body))::BIGINT, ',' ORDER BY turn, text)
                FILTER (speaker = participant), '') AS mask
FROM placed GROUP BY conv_id, participant, piece""",
    "op11_lexical": f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') AS terms FROM documents
), held AS (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs),
asked AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) AS term FROM benchmark
), counts AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, sum(len(terms))::HUGEINT AS total FROM docs),
found AS (SELECT r, doc_id, n, term, count(*) AS tf FROM held GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM found GROUP BY term), counts
), scored AS (
  SELECT a.item_id, f.r, any_value(f.doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n::HUGEINT * docs) // total)::BIGINT)))::BIGINT AS score
  FROM asked a JOIN found f USING (term) JOIN weights USING (term), counts GROUP BY a.item_id, f.r
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {RANKED}""",
    "op12_substrings": f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), windows AS (
  SELECT r, doc_id, i, md5(array_to_string(words[i:i + {WINDOW - 1}], ' ')) AS h
  FROM split, unnest(range(1, len(words) - {WINDOW - 2})) t(i)
), hit AS (
  SELECT r, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS least FROM windows) WHERE least < coalesce(doc_id, 9223372036854775807)
), gone AS (
  SELECT DISTINCT r, i + k AS j FROM hit, range({WINDOW}) t(k)
), kept AS (
  SELECT s.r, count(g.j) AS n_removed, coalesce(string_agg(s.words[w.j], ' ' ORDER BY w.j) FILTER (g.j IS NULL), '') AS left_text
  FROM split s, unnest(range(1, len(s.words) + 1)) w(j) LEFT JOIN gone g ON g.r = s.r AND g.j = w.j GROUP BY s.r
)
SELECT s.doc_id, len(s.words)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.left_text, '')) AS kept_sha256
FROM split s LEFT JOIN kept k USING (r)""",
    "op10_topk": f"""
WITH vecs AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(list_zip(q.v, r.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM vecs q JOIN vecs r ON q.vec_id % {ASKED} = 0 AND q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= {K}""",
    "op9_sharding": _CRC32 + f""",
keyed AS (
  SELECT d.doc_id, coalesce('s' || d.source, 'n') AS stratum, coalesce(strlen(d.text), 0) + 1 AS size,
         coalesce(c.crc, 0)::BIGINT AS crc
  FROM documents d LEFT JOIN crc_text c ON c.text = d.text
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY digest, doc_id, size) - 1 AS r, count(*) OVER (PARTITION BY stratum) AS n
  FROM (SELECT *, md5('0|' || coalesce(doc_id::VARCHAR || '|', '') || crc) AS digest FROM keyed)
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (r + (('0x' || substr(md5('0|' || stratum), 1, 8))::UBIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE) / n::DOUBLE,
                               stratum, digest, doc_id, size) - 1 AS g, count(*) OVER () AS total
  FROM ranked
)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'rows' AS law, (g * {SHARDS} // total)::INT AS shard,
       (g - ((g * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard
FROM placed""",
    "op13_repair": _repair_sql(),
}
