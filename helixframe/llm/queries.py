"""The queries that apply the operators of this subpackage to the tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, credentials, filter_audit, fingerprints, html_wrappers, language_id, merkle, mixing, pieces, quality, sharding, simhash, url_rules
from .common import table

#: Rules of op4 (verdict, host, path).
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k sketches of all documents and of their edited texts (see fingerprints.compare_with_edits).

    A null text is empty; empty texts have empty fingerprints, alike only to each other; very long texts are sketched whole;
    rows with equal ids follow each other by their text's hash; other columns aren't read; an empty table gives no rows.
    """
    found = fingerprints.compare_with_edits(table(spark, sf_dir, "documents"))
    text = fingerprints.fingerprint_text
    return found.select("doc_id", "n_chars", "edited_sha256", text(F.col("sketch")).alias("fingerprint"), text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next", "n_shingles")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by Pfair windows; target weights are the square roots of the sources' counts (see mixing.mix_sources).

    Null sources are one source, null ids and repeated rows are rows like any other, texts aren't read, ties between
    deadlines go by source, and an empty table gives no rows.
    """
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and their components at 2 bits (see simhash.near_duplicates).

    BK-trees are built where the shuffle puts their shard and not broadcast, as all trees together grow with the corpus:
    no size bound could be proven. Null and empty texts have fingerprint zero; very long ones are hashed whole; equal
    fingerprints are taken together first; repeated rows stay; an empty table gives no rows.
    """
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=2, width=3)


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page urls judged by the contract's rules (see url_rules.filter_urls).

    A null url, or one without `://`, has empty host and path; of rules that fit, the longest wins; repeated rows are each
    judged; an empty table gives no rows.
    """
    return url_rules.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages, by wrappers of their hosts (see html_wrappers.extract_pages).

    Null, empty, very long and very deep pages have a defined text; repeated rows are each extracted; an empty table gives none.
    """
    return html_wrappers.extract_pages(table(spark, sf_dir, "pages"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and the contract's own, folded from events, rendered, and read back (see chat).

    A null text or role is empty; turns that are equal go by role and text; a very long conversation is one group, as it is
    one row of output; repeated rows are turns of their own; an empty table gives conversation -1 only.
    """
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = f"{chat.END}{chat.START}assistant ok"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(own).alias("text"))
    return chat.digests(chat.read_back(chat.render(chat.fold_events(chat.conversation_events(said.unionByName(more))))))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in all documents (see credentials.scan_secrets).

    A null text is empty; very long texts are scanned whole; spans that begin together are listed by kind; repeated rows are
    each scanned; an empty table gives no rows.
    """
    return credentials.scan_secrets(table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, tokenizer measures and verdicts of all documents (see quality.judge_quality).

    A null text has no words and fails; a null language has the bands of others; very long texts are counted whole; repeated
    rows are each judged; an empty table gives no rows.
    """
    return quality.judge_quality(table(spark, sf_dir, "documents"))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as piece ids, and the texts that these give back (see pieces.encode_documents).

    A null text has null ids; an empty one has none; very long ones are coded whole; repeated rows are each coded; an empty
    table gives no rows.
    """
    return pieces.encode_documents(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, equal texts together (see sharding.assign_shards).

    A null text is empty; ties between loads go to the lowest shard and between sizes by item; rows with null or equal ids are
    rows like any other; an empty table gives no rows.
    """
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op11_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, by byte context trees fitted to a sample of three quarters of them (see language_id).

    A null text, or one without a letter, is `und`; a null id isn't learned from and isn't held out; very long texts are
    scored whole; ties go to the first language by name; repeated rows are each judged; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    trees = language_id.fit(docs.filter(fold != 2))
    return language_id.predict(docs.withColumn("held_out", F.coalesce(fold == 2, F.lit(False))), trees).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of all documents by source, with proofs checked against rows of which some are tampered with (see merkle).

    A null column is `-` in a leaf; a null source is a group, a null id is first in its group and isn't tampered with; very
    long texts are hashed whole; repeated rows are leaves of their own, next to each other; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    fields, text = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], F.col("text")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    leaf = merkle.leaf_of([*fields, text])
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    claimed = F.when(tampered, merkle.leaf_of([*fields, F.translate(text, upper, upper.lower())])).otherwise(leaf)
    proven = merkle.manifest(docs.select("doc_id", "source", leaf.alias("leaf"), claimed.alias("claimed")), "doc_id", "source")
    return proven.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents, by language, in all orders (see filter_audit.audit_filters).

    A null text is empty, a null language the empty string, a null id greater than all others; very long texts count whole;
    repeated rows fail alike; an empty table gives no rows.
    """
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_fingerprints, op2_mixing, op3_simhash, op4_url_rules, op5_html, op6_chat, op7_secrets, op8_quality, op9_pieces, op10_sharding, op11_languages, op12_manifest, op13_filter_audit)
}

_URL_SQL = r"""
WITH parts AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""

# the formatted length counts start and end strings, two line ends, and a backslash for each escaped `<|`
_CHAT_SQL = r"""
WITH own AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), turns AS (
    SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS n FROM own
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(role) + 1 + n + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

_AUDIT_SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), counted AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS capitals,
           min(doc_id) OVER (PARTITION BY text) AS first_id
    FROM texts
), told AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failed AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
           (len(words) < 200)::INT + 2 * (100 * list_unique(words) < 50 * len(words))::INT
           + 4 * (100 * capitals > 3 * length(text))::INT + 8 * regexp_matches(text, '[#$%&*|]')::INT
           + 16 * (first_id IS NOT NULL AND (doc_id IS NULL OR first_id < doc_id))::INT AS fails
    FROM counted LEFT JOIN told USING (doc_id)
), sets AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM failed GROUP BY part, fails
), letters AS (
    SELECT chr(65 + k::INT) AS letter, (1 << k)::INT AS bit FROM range(5) AS t(k)
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, step::INT AS step, l.bit,
           (SELECT coalesce(sum(m.bit), 0)::INT FROM letters m WHERE strpos(filter_order, m.letter) < step) AS before
    FROM orders, range(1, 6) AS s(step) JOIN letters l ON substr(filter_order, step::INT, 1) = l.letter
)
SELECT part, filter_order, step,
       coalesce(sum(n) FILTER (WHERE fails & (before | bit) = 0), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (WHERE fails & bit > 0 AND fails & before = 0), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (WHERE fails & bit > 0 AND fails & before > 0), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (WHERE fails = bit), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (WHERE fails & bit > 0 AND fails & before = 0), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (WHERE fails & bit > 0 AND fails & before = 0), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * (120 // greatest(bit_count(fails), 1))) FILTER (WHERE fails & bit > 0), 0)::BIGINT AS shapley
FROM sets, steps GROUP BY part, filter_order, step
"""


def _merkle_sql(levels: int = 5) -> str:
    """The manifest in SQL, for groups of at most 16 ** levels rows and as many groups."""
    field = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
    fixed = " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "list_reduce(list_concat([xor(a, b)], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)"
    crc = f"xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)), lambda a, b: {bits}), 4294967295)"
    parts = [
        f"leaves AS (SELECT doc_id, source AS g, sha256({fixed} || {field.format('text')}) AS leaf, coalesce({crc} % 5 = 0, false) AS tampered, sha256({fixed} || {field.format(lower)}) AS changed FROM documents)",
        "placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, dense_rank() OVER (ORDER BY g IS NOT NULL, encode(g)) - 1 AS place FROM leaves)",
        "a0 AS (SELECT place AS g, i, leaf AS d, count(*) OVER (PARTITION BY place) AS n FROM placed)",
    ]

    def tree(name: str) -> None:
        for k in range(levels):
            here = f"{name}{k}"
            parts.append(f"{name}{k + 1} AS (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM (SELECT g, i // 16 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE any_value(d) END AS d FROM {here} GROUP BY g, i // 16))")
            parts.append(
                f"s{here} AS (SELECT x.g, x.i, any_value(x.n) > 1 AS more, coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (WHERE y.i < x.i), '') AS l, coalesce(string_agg(y.d, '' ORDER BY y.i) FILTER (WHERE y.i > x.i), '') AS r"
                f" FROM {here} x JOIN {here} y ON x.g = y.g AND x.i // 16 = y.i // 16 GROUP BY x.g, x.i)"
            )

    tree("a")
    parts.append(f"b0 AS (SELECT 0 AS g, g AS i, d, count(*) OVER () AS n FROM a{levels})")
    tree("b")
    parts.append("f0 AS (SELECT *, CASE WHEN tampered THEN changed ELSE leaf END AS f, '' AS p FROM placed)")
    step = 0
    for name, group, at in (("a", "z.place", "z.i"), ("b", "0", "z.place")):
        for k in range(levels):
            fold = "CASE WHEN s.more THEN sha256(s.l || f || s.r) ELSE f END"
            parts.append(f"f{step + 1} AS (SELECT z.* EXCLUDE (f, p), {fold} AS f, p || s.l || s.r AS p FROM f{step} z JOIN s{name}{k} s ON s.g = {group} AND s.i = {at} // {16**k})")
            step += 1
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT z.doc_id, z.leaf, a.d AS subroot, b.d AS root, sha256(z.p) AS proof_sha256, z.f AS folded_root, z.f = b.d AS verified"
        f" FROM f{step} z JOIN a{levels} a ON a.g = z.place CROSS JOIN b{levels} b"
    )


ORACLE_SQL: dict[str, str] = {"op4_url_rules": _URL_SQL, "op6_chat": _CHAT_SQL, "op12_manifest": _merkle_sql(), "op13_filter_audit": _AUDIT_SQL}
