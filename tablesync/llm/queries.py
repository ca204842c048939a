"""One query per operator, over its whole table with production parameters, and its SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm import byte_bpe, decontaminate, kneser_ney, language, merkle, minhash, quality_model, quality_rules, sharding, site_style, token_counts, warc, whitening
from tablesync.llm.base import ORACLES, QUERIES, query, table  # noqa: F401


OP2 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), m AS (SELECT payload_digest, max(page_id) AS largest FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN largest IS NULL OR page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < largest THEN largest END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)
"""


@query("op2_warc", OP2)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return warc.read(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN)


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))


def quality_sql(rules: quality_rules.Rules) -> str:
    """The quality rules in SQL; the languages of documents all have word lists."""
    space = r"[\x20\x09-\x0D]"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    quoted = lambda x: x.replace("'", "''")
    classes = ", ".join(f"length(t) - length(regexp_replace(t, '{quoted(p)}', '', 'g'))" for p in quality_rules.CLASSES.values())
    common = " ".join(
        f"WHEN '{code}' THEN [" + ", ".join(f"len(list_filter(lw, lambda x: x = '{w}'))" for w in listed) + "]"
        for code, listed in rules.common.items())
    sums = lambda c, n: "[" + ", ".join(f"sum({c}[{i}])" for i in range(1, n + 1)) + "]"
    widest = max(map(len, rules.common.values())) + 1
    jsd = """sqrt(greatest(0, list_sum(list_transform(list_zip({a}, {b}), lambda z: 0.5 * (
      CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END + CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END)))))"""
    share = lambda c: f"list_transform({c}, lambda x: x::DOUBLE / list_sum({c}))"
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '{space}+'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
tok AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w),
win AS (SELECT doc_id, pos, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o] AS five,
          lead(word, 4) OVER o AS last FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
dup AS (SELECT doc_id, five FROM win WHERE last IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT pos + j) AS n_repeat_words FROM win JOIN dup USING (doc_id, five), range(5) r(j) GROUP BY 1),
m AS (SELECT doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        length(t) AS n_chars, [{classes}] AS cls, list_transform(words, lambda x: translate(x, '{upper}', '{lower}')) AS lw
      FROM w LEFT JOIN rep USING (doc_id)),
f AS (SELECT * EXCLUDE (cls, lw), list_append(cls, n_chars - list_sum(cls)) AS cls, CASE lang {common} END AS common0,
        n_words < {rules.least_words} OR 100 * n_repeat_words > {rules.repeat_percent} * n_words AS base_failed FROM m),
h AS (SELECT * EXCLUDE (common0), list_append(common0, n_words - list_sum(common0)) AS common FROM f),
ref AS (SELECT lang, {sums("cls", len(quality_rules.CLASSES) + 1)} AS rc, {sums("common", widest)} AS rw
        FROM h WHERE NOT base_failed AND n_words >= {rules.judged_words} GROUP BY 1),
v AS (SELECT h.*, CASE WHEN list_sum(cls) > 0 THEN {jsd.format(a=share("cls"), b=share("rc"))} END AS char_distance,
        CASE WHEN n_words > 0 THEN {jsd.format(a=share("common"), b=share("rw"))} END AS word_distance FROM h LEFT JOIN ref USING (lang))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (n_words >= {rules.judged_words}
    AND (coalesce(char_distance, 0) > {rules.char_distance} OR coalesce(word_distance, 0) > {rules.word_distance})) AS kept
FROM v"""


@query("op6_quality_rules", quality_sql(quality_rules.Rules()))
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    return found.drop("char_distance", "word_distance")


@query("op1_minhash")
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.components(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.passages(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.select(
        "doc_id", (F.size("hits") == 0).alias("kept"), decontaminate.found_items(F.col("hits")).alias("item_ids"),
        F.array_max(F.transform("hits", lambda h: h["similarity"])).alias("similarity"))


@query("op9_kneser_ney")
def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.train_and_score(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("op5_site_style")
def op5_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.main_texts(table(spark, sf_dir, "pages"), "page_id", "url", "html")


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), "doc_id", "text", "lang", "source")


@query("op8_quality_model")
def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_model.quality(docs, labels, "doc_id", "text", "quality", "source", "lang")


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "vec_id")


def merkle_sql(levels: int = 8, top_levels: int = 4, fan: int = 8) -> str:
    """The manifest in SQL, for up to fan ** levels rows of a language and fan ** top_levels languages."""
    # One byte of a CRC-32 is eight steps of one bit.
    crc = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
    part = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = f"translate(text, '{merkle.UPPER}', '{merkle.LOWER}')"
    run = f"PARTITION BY tree, pos // {fan} ORDER BY pos ROWS BETWEEN"

    def tree(name: str, count: int) -> list[str]:
        """The levels above name0 (tree, pos, n, node), and the other nodes of each run."""
        out = []
        for i in range(count):
            out.append(f"""{name}s{i} AS MATERIALIZED (SELECT tree, pos, n,
              coalesce(string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
              coalesce(string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {name}{i})""")
            out.append(f"""{name}{i + 1} AS MATERIALIZED (SELECT tree, pos // {fan} AS pos, (n + {fan - 1}) // {fan} AS n,
              CASE WHEN n > 1 THEN sha256(string_agg(node, '' ORDER BY pos)) ELSE min(node) END AS node FROM {name}{i} GROUP BY tree, pos // {fan}, n)""")
        return out

    def folds(name: str, source: str, at: str, of: str, count: int) -> list[str]:
        """Rows of `source` with node and proof carried up the levels of a tree."""
        out = []
        for i in range(count):
            out.append(f"""{name}{i + 1} AS (SELECT f.* EXCLUDE (folded, proof), proof || before || after AS proof,
              CASE WHEN s.n > 1 THEN sha256(before || folded || after) ELSE folded END AS folded
              FROM {source if i == 0 else f"{name}{i}"} f JOIN {of}s{i} s ON s.tree = f.{at}tree AND s.pos = f.{at}pos // {fan**i})""")
        return out

    steps = [
        f"""d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({head} || {part("text")}) AS leaf,
          CASE WHEN {crc} % 3 = 0 THEN sha256({head} || {part(lower)}) END AS changed FROM documents)""",
        """p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
          count(*) OVER (PARTITION BY tree) AS n FROM d)""",
        "a0 AS (SELECT tree, pos, n, leaf AS node FROM p)", *tree("a", levels),
        f"""b0 AS MATERIALIZED (SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, node, tree AS lang_tree FROM a{levels})""",
        *tree("b", top_levels),
        "f AS (SELECT p.*, '' AS proof, coalesce(changed, leaf) AS folded FROM p)", *folds("f", "f", "", "a", levels),
        f"g AS (SELECT f.*, b0.node AS subroot, '' AS top_tree, b0.pos AS top_pos FROM f{levels} f JOIN b0 ON b0.lang_tree = f.tree)",
        *folds("g", "g", "top_", "b", top_levels),
    ]
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, b.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b.node AS verified
FROM g{top_levels}, b{top_levels} b"""


@query("op12_merkle", merkle_sql())
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = {"text": merkle.tampered_text(F.col("text"))}
    when = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 3 == 0
    found = merkle.manifest(docs, "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], "lang", changed, when)
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op13_sharding")
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.sharded(table(spark, sf_dir, "documents"), "doc_id", "text", shards=8)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
