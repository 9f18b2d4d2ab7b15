"""One registered query per operator, over its whole table, and the SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from martloom.llm import arrow_files, bpe, clusters, embedding_dedup, exact_dedup, line_dedup, minhash, mixing, negatives, prefix_bpe, private, quality, repeats
from martloom.llm.common import table


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), shingle=4, percent=80)


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_bpe_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.roundtrip_digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_private_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return private.with_surrogates(table(spark, folder, "documents"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, folder, "documents"))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_digests(table(spark, folder, "documents"))


def op7_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"))


def op8_arrow_tokens(spark: SparkSession, folder: str) -> DataFrame:
    manifest = arrow_files.write(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return arrow_files.read_documents(manifest)


def op9_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixing_report(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op11_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_bpe.rank_digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, folder, "embeddings"), "vec_id % 100 = 0", label)


def op13_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return clusters.cluster_digests(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_bpe_roundtrip": op3_bpe_roundtrip,
    "op4_private_surrogates": op4_private_surrogates,
    "op5_line_dedup": op5_line_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_arrow_tokens": op8_arrow_tokens,
    "op9_soft_mixing": op9_soft_mixing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_prefix_bpe": op11_prefix_bpe,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_centroid_clusters": op13_centroid_clusters,
}

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _finite(column: str) -> str:
    return f"len(list_filter({column}, lambda x : x is null or not isfinite(x))) = 0"


def _clusters_sql(rounds: int = 3) -> str:
    """Rounds of assigning and averaging, one after the other."""
    parts = [
        f"""v as materialized (
            select vec_id, row_number() over () as row, list_transform(embedding, lambda x : floor(64 * cast(x as double))) as q
            from embeddings where len(embedding) = 64 and {_finite("embedding")}
        )""",
        """c0 as materialized (
            select row_number() over (order by h, q) - 1 as cluster, q as c
            from (select sha256('1:' || vec_id) as h, q from v where vec_id is not null order by h, q limit 16)
        )""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} as materialized (
            select vec_id, row, q, arg_min(cluster, (d, cluster)) as cluster, cast(min(d) as bigint) as distance
            from (select vec_id, row, q, cluster, list_dot_product(q, q) - 2 * list_dot_product(q, c) + list_dot_product(c, c) as d from v, c{i})
            group by vec_id, row, q
        )""")
        if i < rounds:
            parts.append(f"""c{i + 1} as materialized (
                select cluster, list(m order by i) as c from (
                    select cluster, i, floor(cast(sum(x) as bigint) / count(*)) as m
                    from (select cluster, unnest(q) as x, generate_subscripts(q, 1) as i from a{i}) group by cluster, i
                ) group by cluster
                union all select cluster, c from c{i} where cluster not in (select cluster from a{i})
            )""")
    return "with " + ", ".join(parts) + f"""
        select vec_id, cast(cluster as integer) as cluster, distance,
               cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia, cast(sum(distance) over () as bigint) as inertia,
               sha256(array_to_string(list_transform(c, lambda x : cast(x as bigint)), ',')) as centroid_sha256
        from a{rounds} join c{rounds} using (cluster)
    """


ORACLE: dict[str, str] = {
    "op1_minhash_near_dedup": f"""
        with recursive w as (
            select doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\\x20\\x09-\\x0D]+') as words from documents
        ), s as (
            select doc_id, unnest(list_distinct(case when len(words) = 0 then [] when len(words) < 4 then [words]
                       else list_transform(range(1, len(words) - 2), lambda i : words[i : i + 3]) end)) as gram
            from w
        ), g as (
            select doc_id, md5(cast(gram as varchar)) as gram from s
        ), n as (
            select doc_id, count(*) as n from g group by doc_id
        ), link as (
            select x.doc_id as a, y.doc_id as b
            from g x join g y on x.gram = y.gram and x.doc_id <> y.doc_id
                 join n nx on nx.doc_id = x.doc_id join n ny on ny.doc_id = y.doc_id
            group by x.doc_id, y.doc_id, nx.n, ny.n
            having 100 * count(*) >= 80 * (nx.n + ny.n - count(*))
        ), reach as (
            select doc_id, doc_id as other from documents
            union
            select reach.doc_id, link.b from reach join link on reach.other = link.a
        ), label as (
            select doc_id, min(other) as component_id from reach group by doc_id
        )
        select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id, doc_id = component_id as kept
        from label left join n using (doc_id)
    """,
    "op5_line_dedup": r"""
        with l as (
            select doc_id, line, i,
                   translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
            from (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i
                  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents))
        ), c as (
            select key, max(doc_id) as keep_id from l where length(key) >= 40
            group by key having count(distinct doc_id) >= 5
        ), j as (
            select doc_id, line, i, keep_id is not null and doc_id <> keep_id as lost from l left join c using (key)
        )
        select doc_id, count(*) as n_lines, cast(count_if(lost) as bigint) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not lost), '')) as kept_sha256
        from j group by doc_id
    """,
    "op6_substring_dedup": r"""
        with w as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
        ), g as (
            select doc_id, unnest(range(1, len(words) - 18)) as i, words from w where len(words) >= 20
        ), h as (
            select doc_id, i, md5(array_to_string(words[i : i + 19], ' ')) as win from g
        ), r as (
            select doc_id, i, row_number() over (partition by win order by doc_id, i) > 1 as again from h
        ), c as (
            select doc_id, i, max(case when again then i else 0 end) over
                   (partition by doc_id order by i rows unbounded preceding) as last from r
        ), u as (
            select doc_id, words, unnest(words) as word, generate_subscripts(words, 1) as i from w
        ), k as (
            select u.doc_id, u.word, u.i,
                   coalesce(max(c.last) over (partition by u.doc_id order by u.i rows unbounded preceding), 0) as last
            from u left join c on c.doc_id = u.doc_id and c.i = u.i
        ), t as (
            select doc_id, count(*) filter (where last > 0 and i < last + 20) as n_removed,
                   string_agg(word, ' ' order by i) filter (where not (last > 0 and i < last + 20)) as kept
            from k group by doc_id
        )
        select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
               sha256(coalesce(kept, '')) as kept_sha256
        from w left join t using (doc_id)
    """,
    "op10_exact_dedup": f"""
        with t as (select doc_id, {_ASCII_LOWER} as norm from documents)
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
               doc_id = max(doc_id) over w as kept, sha256(norm) as text_sha256
        from t window w as (partition by norm)
    """,
    "op12_hard_negatives": f"""
        with r as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x : floor(256 * cast(x as double))) as q
            from embeddings where vec_id is not null and label is not null and embedding is not null and {_finite("embedding")}
        ), s as (
            select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as other, cast(list_dot_product(a.q, b.q) as bigint) as score
            from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
        ), p as (
            select anchor_id, other as positive_id, score as positive_score from s where same
            qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
        )
        select anchor_id, positive_id, cast(row_number() over w as integer) as rank, other as negative_id, positive_score, score as negative_score
        from p join s using (anchor_id)
        where not same and 80 * positive_score <= 100 * score and score <= positive_score
        window w as (partition by anchor_id, positive_id order by score desc, other)
        qualify row_number() over w <= 5
    """,
    "op13_centroid_clusters": _clusters_sql(),
}
