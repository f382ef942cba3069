"""The registered queries of this subpackage. Each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shelfline.llm import byte_bpe, exact_dedup, fingerprints, language_id, lexical_search, minhash_dedup, mixing, prefix_trie, quality_classifier, repeated_passages, sentence_pieces, token_counts, web_archives
from shelfline.llm.common import crc_mod, table, token_pattern, tokenizer_path


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_archives.archive_pages(table(spark, sf_dir, "pages")).drop("record_id", "url")


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.repeated_passages(table(spark, sf_dir, "documents"))


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether they decode to it again."""
    path = tokenizer_path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").withColumn("original", F.sha2(F.replace(F.coalesce("text", F.lit("")), F.lit("\u2581"), F.lit(" ")), 256))
    decoded = sentence_pieces.encode_documents(docs, path, keep=("original",), decoded_col="text")
    text_sha256 = F.sha2("text", 256)
    return decoded.select("doc_id", "n_tokens", "ids", text_sha256.alias("decoded_sha256"), (text_sha256 == F.col("original")).alias("round_trip"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_decisions(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = language_id.train(docs, usable=~held_out)
    out = language_id.predict_languages(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"), usable=crc_mod(F.col("id"), 5) != 0)
    out = quality_classifier.quality_scores(docs, model)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the bytes they decode to, as digests."""
    model = (tokenizer_path("byte_bpe_50k.tiktoken"), token_pattern())
    decoded = byte_bpe.decode_documents(byte_bpe.encode_documents(table(spark, sf_dir, "documents"), *model), *model)
    return decoded.select(F.col("doc_id").cast("long"), "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_warc_archives": op2_warc_archives,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_repeated_passages": op5_repeated_passages,
    "op6_sentence_pieces": op6_sentence_pieces,
    "op7_source_mix": op7_source_mix,
    "op8_language_id": op8_language_id,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lexical_search": op13_lexical_search,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op9_exact_dedup": """
        with d as (select doc_id, coalesce(text, '') as text from documents),
        g as (select text, max(doc_id) as keep_id, count(*) as group_size from d group by text)
        select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.text) as text_sha256
        from d join g on d.text = g.text
    """,
    # the crc32 of a conversation's digits goes over a table of 256 entries, each made by eight steps
    "op12_prefix_trie": """
        with crc_table as (
            select list(c order by b) as entries from (
                select b, list_reduce(list_prepend(b, range(8)),
                    lambda a, step: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c
                from range(256) bytes(b))
        ),
        turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
        ),
        own as (
            select conv_id, list({'role': role, 'text': text} order by turn nulls first, role,
                sha256(concat(upper(lpad(to_hex(octet_length(encode(role))), 8, '0')), role, text))) as turns
            from turns group by conv_id
        ),
        heads as (
            select conv_id, turns, conv_id - conv_id % 5 as head_id, xor(list_reduce(
                list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
                lambda a, b: xor(entries[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 9 as h
            from own, crc_table
        ),
        rebuilt as (
            select c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) as turns
            from heads c left join own b on b.conv_id = c.head_id
        ),
        members as (
            select conv_id, d, turns[1:d] as path, d = len(turns) as is_end from (
                select conv_id, turns, unnest(range(len(turns) + 1)) as d from rebuilt)
        ),
        nodes as (
            select path, d, min(conv_id) as conv_id, count(*) as n_convs,
                sha256(coalesce(string_agg(case when is_end then conv_id::varchar end, ',' order by conv_id), '')) as ends_sha256,
                (count(*) - 1) * coalesce(octet_length(encode(path[d].text)), 0) as saved
            from members group by path, d
        ),
        children as (select path[1:d - 1] as path, d - 1 as d, count(*) as n_children from nodes where d > 0 group by 1, 2),
        counted as (select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c on n.path = c.path and n.d = c.d),
        subtrees as (
            select path[1:k] as path, k as d, sum(case when n_children = 0 then 1 else 0 end)::bigint as n_leaves, sum(saved)::bigint as saved_tokens
            from (select path, d, n_children, saved, unnest(range(d + 1)) as k from counted) group by 1, 2
        )
        select n.conv_id, n.d as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
        from counted n join subtrees s on n.path = s.path and n.d = s.d left join nodes p on n.d > 0 and p.d = n.d - 1 and p.path = n.path[1:n.d - 1]
    """,
    "op13_lexical_search": r"""
        with words as (
            select row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from (select row_number() over () as row, doc_id, text from documents)
        ),
        counts as (select row, doc_id, term, count(*) as tf from words group by all),
        lengths as (select row, sum(tf)::bigint as n from counts group by row),
        corpus as (select count(*) as docs, sum(n)::bigint as terms from lengths),
        weights as (
            select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w from counts, corpus group by term
        ),
        asked as (
            select item_id, item, term, count(*) as times from (
                select item_id, text as item, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
                from (select distinct item_id, text from benchmark))
            group by all
        ),
        scores as (
            select item_id, item, row, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))))::bigint as score
            from asked join counts using (term) join weights using (term) join lengths using (row), corpus
            group by item_id, item, row, doc_id
        )
        select item_id, rank, doc_id, score from (
            select *, row_number() over (partition by item_id, item order by score desc, doc_id nulls last)::integer as rank from scores where score > 0)
        where rank <= 10
    """,
}

if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
