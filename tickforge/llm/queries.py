"""Registered queries of this package: each operator over its whole tables."""

import public_tokenizers
from pyspark.sql import functions as F

from tickforge.llm import (
    bpe, chat, decontam, langid, lmscore, mixing, neardup, negatives, pii, quality, topk, trie, warc,
)
from tickforge.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def op1_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    encoded = bpe.encode(docs, public_tokenizers.path(TOKENIZER), decoded=True)
    return encoded.select(
        "doc_id",
        bpe.token_count("ids").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op3_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.quality_scores(docs, labels)


def op4_decontaminate(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.contaminated(docs, items)


def op5_chat(spark, sf_dir):
    return chat.chats(table(spark, sf_dir, "conversations"))


def op6_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors.where("vec_id % 20 = 0"), vectors, k=20)


def op7_pii(spark, sf_dir):
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[f"n_{kind}" for kind in pii.KINDS],
        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"),
        pii.all_spans().alias("spans"),
    )


def op8_warc(spark, sf_dir):
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.read_archives(manifest, folder).select(*columns)


def op9_language(spark, sf_dir):
    return langid.languages(table(spark, sf_dir, "documents"))


def op10_lm_score(spark, sf_dir):
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lmscore.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op11_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op12_hard_negatives(spark, sf_dir):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return negatives.hard_negatives(vectors.where("vec_id % 100 = 0"), vectors)


def op13_prefix_trie(spark, sf_dir):
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe, op2_near_duplicates, op3_quality, op4_decontaminate, op5_chat, op6_topk,
        op7_pii, op8_warc, op9_language, op10_lm_score, op11_mixing, op12_hard_negatives,
        op13_prefix_trie,
    )
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL = {
    "op2_near_duplicates": rf"""
        with recursive words as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                '[^\x20\x09-\x0D]+') as w
            from documents),
        sets as (
            select doc_id, case
                when len(w) >= 2 then list_distinct(list_transform(
                    range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
                when len(w) = 1 then [w[1]] else [] end as s
            from words),
        shingles as (select doc_id, len(s) as n, unnest(s) as x from sets),
        links as (
            select a.doc_id as u, b.doc_id as v
            from shingles a join shingles b on a.x = b.x and a.doc_id <> b.doc_id
            group by a.doc_id, b.doc_id, a.n, b.n
            having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        reach as (
            select doc_id as u, doc_id as v from documents
            union select r.u, l.v from reach r join links l on r.v = l.u)
        select s.doc_id, cast(len(s.s) as bigint) as n_shingles, c.component_id,
            s.doc_id = c.component_id as kept
        from sets s join (select u, min(v) as component_id from reach group by u) c on c.u = s.doc_id
    """,
    "op5_chat": """
        with said as (
            select conv_id, turn, string_agg('<|im_start|>' || coalesce(role, '') || chr(10)
                    || coalesce(text, '') || '<|im_end|>' || chr(10), ''
                    order by coalesce(role, ''), coalesce(text, '')) as line,
                string_agg(coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n'), chr(2)
                    order by role, text) as exact
            from (select distinct conv_id, turn, role, text from conversations
                where conv_id is not null and turn is not null)
            group by conv_id, turn),
        rolled as (
            select *, string_agg(turn || chr(3) || exact, chr(4)) over (
                    partition by conv_id order by turn) as prefix,
                max(turn) over (partition by conv_id) as last
            from said),
        kept as (
            select min(conv_id) as conv_id from rolled where turn = last
                and prefix not in (select prefix from rolled where turn < last)
            group by prefix)
        select conv_id, cast(floor(turn / 256) as bigint) as part, count(*) as turns,
            string_agg(line, '' order by turn) as rendered
        from said semi join kept using (conv_id) group by 1, 2
    """,
    "op6_topk": """
        with usable as (
            select vec_id, list_transform(embedding,
                lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
            from embeddings
            where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding,
                lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(
                list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
            from usable q join usable c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
            where q.vec_id % 20 = 0)
        select query_id, cast(row_number() over best as int) as rank, vec_id, score
        from scored window best as (partition by query_id order by score desc, vec_id)
        qualify row_number() over best <= 20
    """,
    "op8_warc": """
        with payloads as (
            select page_id, coalesce(html, '') as payload from pages where page_id is not null),
        hashed as (
            select *, cast(cast(unhex(sha1(payload)) as bit) as varchar) as bits from payloads)
        select page_id, cast(strlen(payload) as bigint) as payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr(
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + list_sum(list_transform(range(5), lambda k:
                    cast(substr(bits, 5 * i + k + 1, 1) as bigint) * (16 >> k)))::bigint, 1)), '')
                as payload_digest,
            case when page_id = last then 'response' else 'revisit' end as record_type,
            case when page_id <> last then last end as refers_to
        from (select *, max(page_id) over (partition by payload) as last from hashed)
    """,
    "op12_hard_negatives": """
        with usable as (
            select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
            from embeddings
            where vec_id is not null and label is not null and len(embedding) > 0 and len(list_filter(
                embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select a.id as anchor_id, r.id, a.label = r.label as same, cast(list_sum(list_transform(
                list_zip(a.v, r.v), lambda p: p[1] * p[2])) as bigint) as score
            from usable a join usable r on a.id <> r.id and len(a.v) = len(r.v)
            where a.id % 100 = 0),
        positives as (
            select anchor_id, id, score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
        select p.anchor_id, p.id as positive_id, cast(row_number() over best as int) as rank,
            n.id as negative_id, p.score as positive_score, n.score as negative_score
        from positives p join scored n on p.anchor_id = n.anchor_id and not n.same
            and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
        window best as (partition by p.anchor_id, p.id order by n.score desc, n.id)
        qualify row_number() over best <= 5
    """,
    "op13_prefix_trie": """
        with turns as (
            select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                row_number() over (partition by conv_id order by turn nulls first, sha256(
                    length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as place
            from conversations where conv_id is not null),
        heads as (
            select conv_id, (4294967295 - list_reduce(
                flatten(list_transform(list_transform(range(1, strlen(conv_id::varchar) + 1),
                    lambda i: ascii(substr(conv_id::varchar, i, 1))::bigint),
                    lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1])),
                lambda crc, b: case when b >= 0 then xor(crc, b)
                    else xor(crc >> 1, (crc & 1) * 3988292384) end, 4294967295)) % 9 as head
            from (select distinct conv_id from turns)),
        lent as (
            select h.conv_id, t.place, t.role, t.text
            from heads h join turns t on t.conv_id = h.conv_id - h.conv_id % 5 and t.place <= h.head),
        said as (
            select conv_id, 0 as own, place, role, text from lent
            union all select t.conv_id, 1, t.place, t.role, t.text
            from turns t join heads h using (conv_id) where t.place > h.head),
        placed as (
            select *, row_number() over (partition by conv_id order by own, place) as depth from said),
        rolled as (
            select conv_id, depth, strlen(text) as bytes, string_agg(
                length(role) || ':' || role || length(text) || ':' || text, ''
                ) over (partition by conv_id order by depth) as sofar
            from placed),
        along as (
            select conv_id, depth, bytes, sha256(sofar) as key from rolled
            union all select conv_id, 0, 0, '' from heads),
        ended as (select conv_id, max(depth) as last from along group by conv_id),
        nodes as (
            select key, depth, min(conv_id) as conv_id, count(*) as n_convs,
                (count(*) - 1) * min(bytes) as saved,
                sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id)
                    filter (depth = last), '')) as ends_sha256
            from along join ended using (conv_id)
            group by key, depth),
        steps as (
            select distinct b.key, a.key as parent
            from along a join along b on a.conv_id = b.conv_id and b.depth = a.depth + 1),
        children as (select parent as key, count(*) as n_children from steps group by parent),
        below as (
            select a.key, count(*) filter (c.n_children is null) as n_leaves, sum(n.saved) as saved
            from nodes n join along a on a.conv_id = n.conv_id and a.depth <= n.depth
                left join children c on c.key = n.key
            group by a.key)
        select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs,
            coalesce(c.n_children, 0) as n_children, b.n_leaves,
            cast(b.saved as bigint) as saved_tokens, n.ends_sha256
        from nodes n join below b on b.key = n.key left join children c on c.key = n.key
            left join steps s on s.key = n.key left join nodes p on p.key = s.parent
    """,
}
