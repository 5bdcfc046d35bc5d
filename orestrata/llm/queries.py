"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.llm import (
    chat,
    classify,
    conversation_trie,
    fingerprints,
    hard_negatives,
    main_text,
    mixing,
    near_dedup,
    neighbours,
    pii,
    sentencepiece,
    token_counts,
    urls,
)
from orestrata.sources.scratch import materialize, scratch_path
from orestrata.sources.tables import read_table

TOKENIZERS = "/opt/tokenizers"
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans counted by kind, and all spans, of every document."""
    found = pii.detect(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        _sha(pii.written(F.col("base"))).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
    )


VERSION = "byte_bpe_50k"


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches over all documents: inserts with an estimate of a token per
    four characters, revisions to the counted tokens, and deletes of the documents without any
    token. The first comes once more after itself, and again after it has been rolled up."""
    docs = table(spark, sf_dir, "documents")
    estimate = F.floor(F.length(F.coalesce("text", F.lit(""))) / 4).cast("bigint").alias("old_tokens")
    counted = token_counts.with_token_count(docs.select("source", "lang", estimate, "text"), RANKS)
    counted = materialize(counted, "tokens")
    first = counted.select("source", "lang", F.col("old_tokens").alias("tokens"))
    ledger = token_counts.TokenLedger(spark, scratch_path(spark, "ledger"))
    ledger.commit("load", token_counts.inserts(first, VERSION))
    ledger.commit("load", token_counts.inserts(first, VERSION))
    ledger.commit("count", token_counts.revisions(counted, VERSION))
    ledger.roll_up()
    ledger.forget()
    ledger.commit("load", token_counts.inserts(first, VERSION))
    ledger.commit("empty", token_counts.deletes(counted.filter("tokens = 0"), VERSION))
    return ledger.totals()


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken", "copies")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, a hash of their ids, and whether they decode to the text."""
    sentencepiece.verify_parity(PIECES)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece.round_trip(docs, PIECES)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.xxhash64("token_ids").alias("ids_hash"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"),
    )


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations")
    tricky = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    turns = turns.unionByName(tricky).withColumn("parts", chat.text_parts(F.col("text")))
    chats = chat.format_chats(turns)
    chats = chats.withColumn("turns", chat.read_turns(F.col("formatted")))
    chats = chats.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        _sha(F.array_join(lines, "")).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        _sha(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = classify.select_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return picked.select("doc_id", "log_weight", "sampling_key", "selected")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, percent=85).drop("text_hash")


URL_RULES = (
    urls.place_rule("allow", "org", "/"),
    urls.place_rule("block", "example.org", "/es/"),
    urls.place_rule("block", "example.org", "/en/1"),
    urls.place_rule("allow", "com", "/fr/"),
    urls.place_rule("block", "com", "/de/"),
    *urls.GENERAL,
)


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = main_text.extract_main_text(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


# Conversations in a row that open with the turns of their first, and how many turns at most.
OPENING_EVERY, OPENING_TURNS = 100, 5


def shared_openings(turns: DataFrame) -> DataFrame:
    """Each conversation c rebuilt: the first crc32(c) % 6 turns of the conversation that its
    hundred starts with, then its own turns after as many. conv_id, path."""
    own = materialize(conversation_trie.turn_paths(turns), "paths")
    start = F.col("conv_id") - F.col("conv_id") % OPENING_EVERY
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (OPENING_TURNS + 1)).cast("int")
    openings = own.filter(F.col("conv_id") % OPENING_EVERY == 0).select(
        F.col("conv_id").alias("start"), conversation_trie.first_turns(F.col("path"), F.lit(OPENING_TURNS)).alias("opening")
    )
    both = own.withColumn("start", start).join(openings, "start", "left")
    opening = F.coalesce("opening", F.lit(b""))
    path = F.concat(conversation_trie.first_turns(opening, taken), conversation_trie.without_first_turns(F.col("path"), taken))
    return both.select("conv_id", path.alias("path"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(shared_openings(table(spark, sf_dir, "conversations")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_token_counts": op2_token_counts,
        "op3_mixing": op3_mixing,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_chat": op5_chat,
        "op6_fingerprints": op6_fingerprints,
        "op7_quality": op7_quality,
        "op8_near_dedup": op8_near_dedup,
        "op9_urls": op9_urls,
        "op10_neighbours": op10_neighbours,
        "op11_main_text": op11_main_text,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_hard_negatives": op13_hard_negatives,
    }


# The templates' control strings; in a text they are as long as their escaped form less one.
_CONTROL = r"<\\*(?:\|[A-Za-z0-9_]+\|>|/?s>|/?SYS>|pad>|unk>)|\[\\*/?(?:INST|SYSTEM_PROMPT|AVAILABLE_TOOLS|TOOL_CALLS|TOOL_RESULTS)\]"


# CRC-32 of a decimal id, bit by bit: 256 and more brings in a byte, 0 shifts by one bit.
_CRC = """xor(list_reduce(
                           list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
                               lambda c: [256 + ascii(c), 0, 0, 0, 0, 0, 0, 0, 0]))),
                           lambda c, x: CASE WHEN x >= 256 THEN xor(c, x - 256) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
                       ), 4294967295)"""


def _general_sql() -> str:
    return " OR ".join(f"regexp_matches(host || path, '{rule.pattern}')" for rule in urls.GENERAL)


def oracle_sql() -> dict[str, str]:
    return {
        "op5_chat": f"""
            WITH turns AS (
                SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
                UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
            )
            SELECT conv_id, count(*) AS n_turns,
                   sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
                   CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
                   sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
                       AS loss_sha256,
                   CAST(sum({len(chat.TURN) + len(chat.BODY) + len(chat.END)} + length(role) + length(text)
                       + len(regexp_extract_all(role || chr(10) || text, '{_CONTROL}'))) AS BIGINT) AS formatted_chars
            FROM turns GROUP BY conv_id""",
        "op9_urls": f"""
            WITH cut AS (
                SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
                FROM pages
            ), placed AS (
                SELECT page_id,
                       translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                       regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
                FROM cut
            ), ruled AS (
                SELECT *, '.' || host AS dotted,
                       CASE WHEN suffix(dotted, '.example.org') AND prefix(path, '/en/1') THEN 'example.org/en/1'
                            WHEN suffix(dotted, '.example.org') AND prefix(path, '/es/') THEN 'example.org/es/'
                            WHEN suffix(dotted, '.com') AND prefix(path, '/fr/') THEN 'com/fr/'
                            WHEN suffix(dotted, '.com') AND prefix(path, '/de/') THEN 'com/de/'
                            WHEN suffix(dotted, '.org') AND prefix(path, '/') THEN 'org/' END AS rule
                FROM placed
            )
            SELECT page_id, host, path, rule,
                   CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                        WHEN {_general_sql()} THEN 'block' ELSE 'allow' END AS verdict
            FROM ruled""",
        # In the given pages the one article element is the main text, and its tags are few.
        "op11_main_text": r"""
            WITH cut AS (
                SELECT page_id, url, regexp_extract(html, '<article>(.*)</article>', 1, 's') AS body FROM pages
            ), bare AS (
                SELECT page_id, url,
                       regexp_replace(regexp_replace(body, '</?(?:p|h1|br)>', ' ', 'g'), '<[^>]*>', '', 'g') AS body
                FROM cut
            ), decoded AS (
                SELECT page_id, url,
                       regexp_replace(replace(replace(replace(replace(body, '&quot;', '"'), '&#39;', chr(39)), '&lt;', '<'), '&gt;', '>'),
                           '&amp;?', '&', 'g') AS body
                FROM bare
            ), told AS (
                SELECT page_id, url, trim(regexp_replace(coalesce(body, ''), '\s+', ' ', 'g')) AS text FROM decoded
            )
            SELECT page_id, url, text, length(text) AS n_chars FROM told""",
        "op12_conversation_trie": f"""
            WITH turns AS (
                SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
            ), listed AS (
                SELECT conv_id, list({{'hash': sha256(length(role) || ':' || role || text), 'size': length(text)}}
                           ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS own,
                       {_CRC} % 6 AS taken
                FROM turns GROUP BY conv_id
            ), rebuilt AS (
                SELECT c.conv_id,
                       list_concat(coalesce(s.own, [])[1:c.taken], c.own[c.taken + 1:]) AS path
                FROM listed c LEFT JOIN listed s ON s.conv_id = c.conv_id - c.conv_id % 100
            ), reached AS (
                SELECT conv_id, len(path) AS turns, d AS depth, path[1:d] AS node, CASE WHEN d > 0 THEN path[d].size END AS size
                FROM rebuilt, LATERAL (SELECT unnest(range(0, len(path) + 1)) AS d)
            ), nodes AS (
                SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
                       sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE turns = depth), ''))
                           AS ends_sha256
                FROM reached GROUP BY node, depth
            ), families AS (
                SELECT n.*, p.conv_id AS parent_conv_id,
                       (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.node[1:n.depth] = n.node) AS n_children
                FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1] AND n.depth > 0
            )
            SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children,
                   count(*) FILTER (WHERE b.n_children = 0) AS n_leaves,
                   CAST(coalesce(sum((b.n_convs - 1) * b.size), 0) AS BIGINT) AS saved_tokens,
                   n.ends_sha256
            FROM families n JOIN families b ON b.depth >= n.depth AND b.node[1:n.depth] = n.node
            GROUP BY n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, n.ends_sha256""",
        "op13_hard_negatives": """
            WITH rows AS (
                SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                       list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                FROM embeddings
                WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            ), scored AS (
                SELECT a.vec_id AS anchor_id, r.vec_id AS id, r.label = a.label AS same,
                       CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) AS score
                FROM rows a JOIN rows r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
            ), positives AS (
                SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
                QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
            )
            SELECT anchor_id, positive_id,
                   CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
                   s.id AS negative_id, positive_score, s.score AS negative_score
            FROM positives JOIN scored s USING (anchor_id)
            WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
            QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) <= 10""",
    }
