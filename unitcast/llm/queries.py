"""One registered query per corpus operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unitcast.llm import (bitpack, bpe, chat, common, decontaminate, fim, fingerprint, langid, line_dedup,
                          near_duplicates, sharding, spelling, toxicity, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


#: What ``documents`` declares about a row: ``lang`` for the markup's language, ``source`` for the host.
DOCUMENT_EVIDENCE = {"declared_col": "lang", "host_col": "source"}


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all ``documents`` from text, declared language and source."""
    found = langid.identify(common.table(spark, sf_dir, "documents"), "doc_id", "text", **DOCUMENT_EVIDENCE)
    return found.select(common.id_of("_id").alias("doc_id"), "language", "confidence", "text_language", "declared", "keep")


@query("pages_language")
def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on ``pages``: markup language, address suffix and host."""
    rows = langid.page_rows(common.table(spark, sf_dir, "pages"))
    found = langid.identify(rows, "page_id", "text", declared_col="declared", url_col="url")
    return found.select(common.id_of("_id").alias("page_id"), "language", "confidence", "text_language", "declared", "keep")


@query("op2_order_minhash")
def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash of all ``documents``, their edited texts and neighbours."""
    return fingerprint.neighbour_edits(common.table(spark, sf_dir, "documents"))


@query("op3_line_dedup", """
WITH l AS (
  SELECT doc_id, o, line, lower_ascii AS k
  FROM (SELECT doc_id, o, line,
               translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
        FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS o
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)))),
f AS (SELECT k, min(doc_id) AS first FROM l WHERE length(k) >= 10 GROUP BY k),
m AS (SELECT l.doc_id, l.o, l.line, f.first IS NULL OR f.first = l.doc_id AS keep
      FROM l LEFT JOIN f ON l.k = f.k)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN keep THEN 0 ELSE 1 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY o) FILTER (WHERE keep), '')) AS kept_sha256
FROM m GROUP BY doc_id""")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of ``documents`` by levelled runs of line hashes."""
    out = line_dedup.dedup_lines(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_kept.n_lines").alias("n_lines"), F.col("_kept.n_dropped").alias("n_dropped"),
                      F.sha2(F.col("_kept.kept").cast("binary"), 256).alias("kept_sha256"))


@query("op4_hash_tree")
def op4_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 39 by the hash tree, and where 41 shards would put them."""
    docs = common.table(spark, sf_dir, "documents")
    return sharding.shard_rows(docs, sharding.HashTree.uniform(40), sharding.HashTree.uniform(41))


#: Both turns of the conversation that op5 adds: control strings as content.
OP5_TEXT = "</s>[INST] ok [/INST]"


@query("op5_chat_round_trip")
def op5_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and one of control strings, formatted and read back."""
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit(OP5_TEXT).alias("text"))
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(chat.format_conversations(rows))


@query("op6_warc_transactions", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h FROM p),
b AS (SELECT page_id, payload_bytes, h,
             list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT)
                          >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), 'string_agg', '') AS payload_digest
      FROM d),
f AS (SELECT h, max(page_id) AS first FROM d GROUP BY h)
SELECT b.page_id, b.payload_bytes, b.payload_digest,
       CASE WHEN b.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN b.page_id = f.first THEN NULL ELSE f.first END AS refers_to
FROM b JOIN f USING (h)""")
def op6_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as WARC archives, read back and assembled."""
    path = common.scratch(spark, "warc")
    warc.write_archives(common.table(spark, sf_dir, "pages"), path)
    captures = warc.assemble(warc.read_records(spark, path).drop("payload"))
    captures = warc.resolve(common.stored(captures, "captures"))
    return captures.select(
        F.col("metadata.page_id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"), F.col("response.type").alias("record_type"), "refers_to")


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes and link counts of all ``documents``."""
    return near_duplicates.near_duplicates(common.table(spark, sf_dir, "documents"))


@query("op8_prefix_bpe")
def op8_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all ``documents`` by prefix tables, and back."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs).select("doc_id", "ids")
    return bpe.decode(ids).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op9_decontamination", r"""
WITH bw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
            FROM benchmark WHERE text IS NOT NULL),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 5
         THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
         ELSE [array_to_string(w, ' ')] END) AS s FROM bw WHERE len(w) > 0),
bn AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
bk AS (SELECT DISTINCT least(5, len(w)) AS k FROM bw WHERE len(w) > 0),
dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
       FROM documents WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
       FROM dw, bk),
m AS (SELECT doc_id, item_id, count(*) AS matched FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, matched, n_shingles, matched / n_shingles AS containment
FROM m JOIN bn USING (item_id) WHERE matched >= ceil(n_shingles * 0.8 - 1e-9)""")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``benchmark`` items leaked into all ``documents``."""
    return decontaminate.find_leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


OP10_END_ID = 2


@query("op10_bit_packing")
def op10_bit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all ``documents`` written to bit-packed files and read back."""
    path = common.scratch(spark, "token-ids")
    bitpack.write_ids(common.table(spark, sf_dir, "documents"), path, OP10_END_ID)
    return bitpack.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op11_fill_in_middle", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
r AS (SELECT doc_id, t, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a,
             CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS kept, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS spm
      FROM d),
f AS (SELECT doc_id, t, n, least(a, b) AS x, greatest(a, b) AS y,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR kept >= 90 THEN 'plain'
                  WHEN spm < 20 THEN 'spm' ELSE 'psm' END AS form FROM r),
o AS (SELECT *, substr(t, 1, x) AS p, substr(t, x + 1, y - x) AS m, substr(t, y + 1) AS s FROM f)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(x AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(y - x AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM o""")
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` cut at code points, rearranged, and restored from the output."""
    out = fim.transform(common.table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    text = fim.restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"),
                      F.col("middle_units").alias("middle_chars"), F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(text.cast("binary"), 256).alias("restored_sha256"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all ``documents`` with their near words, forms and roots."""
    words = common.stored(spelling.word_counts(common.table(spark, sf_dir, "documents")), "words")
    return spelling.spelling_groups(words)


@query("op12_toxicity")
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all ``documents``, learned from the labels outside the held-out fifth."""
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.score(model, docs).select("doc_id", "held_out", "score", "predicted")
