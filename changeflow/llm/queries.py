"""The operators over the given tables, as registered queries, and SQL for the same results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import (
    alignment,
    chat,
    embeddings,
    line_dedup,
    minhash,
    mixing,
    packing,
    quality,
    suffix,
    token_counts,
    topk,
    url_filter,
    whitening,
)
from changeflow.llm.ship import shipped

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and number -7, whose texts look like a template's control strings."""
    said = "</s>[INST] ok [/INST]"
    turns = F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(r).alias("role")) for i, r in enumerate(("user", "assistant"))])
    planted = spark.range(1).select(F.explode(turns).alias("t")).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("t.turn").cast("long").alias("turn"), "t.role", F.lit(said).alias("text")
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_chats(chat.table_events(rows.unionByName(planted))))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return found.select("doc_id", *[F.col(f"_{n}").alias(n) for n in names])


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_tokens(_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    scored = quality.score_quality(docs, quality_model(spark, sf_dir, docs)).drop("text", "n_chars")
    predicted = (F.col("score") >= 0.5).cast("int")
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", predicted.alias("predicted"))


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> quality.FactorisationMachine:
    """Fitted on labels outside the rows that are held out."""
    labels = _table(spark, sf_dir, "labels").filter(~quality.held_out())
    return quality.fit_quality(docs, labels)


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score beyond 64 bits, which no long can hold, is null; its rank is right."""
    found = topk.top_k(_table(spark, sf_dir, "embeddings"), queries_every=100)
    return found.withColumn("score", F.col("score").try_cast("long"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, plan = mixing.mix(_table(spark, sf_dir, "documents"))
    plan = plan.withColumnRenamed("source", "_source")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    taken = (F.col("size") * mixing.copies()).alias("taken")
    return joined.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = alignment.score(alignment.align(_table(spark, sf_dir, "documents")))
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return scored.select(F.col("id").cast("long").alias("doc_id"), *names)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_lines(_table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", digest)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    deviation = F.col("deviation").try_cast("long")
    names = ("whitened", "explained", "identity_error")
    return rows.select(F.col("id").alias("vec_id"), "component", "n", deviation.alias("deviation"), *names)


QUERIES: dict[str, Query] = {
    f.__name__: shipped(f)
    for f in (
        op1_url_filter,
        op2_chat_format,
        op3_minhash_dedup,
        op4_suffix_dedup,
        op5_embedding_dedup,
        op6_token_counts,
        op7_best_fit_packing,
        op8_quality_classifier,
        op9_topk_search,
        op10_mix_sources,
        op11_token_alignment,
        op12_line_dedup,
        op13_embedding_whitening,
    )
}

# What links to what, and the least id reachable.
_GROUPS = """
    reach(id, other) as (
      select a, b from links union select b, a from links
      union select r.id, case when l.a = r.other then l.b else l.a end
      from reach r join links l on l.a = r.other or l.b = r.other),
    least as (select id, min(other) as other from reach group by id)"""

ORACLES: dict[str, str] = {
    "op1_url_filter": r"""
        with cut as (
          select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
          from pages),
        parsed as (
          select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
          from cut),
        judged as (
          select *, case
            when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
            when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
            when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
            when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule
          from parsed)
        select page_id, host, path, rule, case
          when rule in ('net/', 'example.com/de/') then 'block'
          when rule is not null then 'allow'
          when len(list_intersect(regexp_split_to_array(host, '[._-]'), ['adult', 'casino', 'porn', 'spam', 'xxx'])) > 0
            then 'block' else 'allow' end as verdict
        from judged""",
    "op2_chat_format": r"""
        with turns as (
          select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
          union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
          union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        sized as (
          select *, length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
            + len(regexp_extract_all(text, '<\||</?s>|<</?SYS>>|\[/?INST\]')) as escaped
          from turns)
        select conv_id, count(*) as n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
          cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
          sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
          cast(sum(escaped + length(role) + 17) as bigint) as formatted_chars
        from sized group by conv_id""",
    "op3_minhash_dedup": rf"""
        with recursive words as (
          select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
          from documents),
        shingles as (
          select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s
          from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) as i from words)),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        shared as (
          select x.doc_id as a, y.doc_id as b, count(*) as n
          from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id group by all),
        links as (
          select a, b from shared h join sizes x on x.doc_id = a join sizes y on y.doc_id = b
          where 100 * h.n >= 75 * (x.n + y.n - h.n)),
        {_GROUPS}
        select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(l.other, doc_id)) as component_id,
          doc_id <= coalesce(l.other, doc_id) as kept
        from documents left join sizes using (doc_id) left join least l on l.id = doc_id""",
    "op4_suffix_dedup": r"""
        with bytes as (
          select doc_id, hex(encode(coalesce(text, ''))) as h, length(hex(encode(coalesce(text, '')))) // 2 as n
          from documents),
        places as (select doc_id, h, n, unnest(range(n)) as p from bytes),
        grams as (
          select doc_id, p, case when p + 50 <= n then substr(h, 2 * p + 1, 100) end as g, substr(h, 2 * p + 1, 2) as byte
          from places),
        marked as (
          select *, g is not null and doc_id > min(doc_id) over (partition by g) as starts from grams),
        covered as (
          select *, bool_or(starts) over (partition by doc_id order by p rows between 49 preceding and current row) as gone
          from marked),
        edges as (
          select *, gone and not coalesce(lag(gone) over (partition by doc_id order by p), false) as opens from covered),
        summed as (
          select doc_id, count(*) filter (where gone) as n_removed, count(*) filter (where opens) as n_spans,
            string_agg(byte, '' order by p) filter (where not gone) as kept
          from edges group by doc_id)
        select doc_id, cast(n as bigint) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
          sha256(unhex(coalesce(kept, ''))) as kept_sha256
        from bytes left join summed using (doc_id)""",
    "op5_embedding_dedup": f"""
        with recursive fine as (
          select vec_id, cast(embedding as double[]) as v from embeddings
          where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
            and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links as (
          select x.vec_id as a, y.vec_id as b from fine x join fine y on x.vec_id < y.vec_id and len(x.v) = len(y.v)
          where list_cosine_similarity(x.v, y.v) >= 0.9),
        degrees as (
          select id, count(*) as n from (select a as id from links union all select b from links) group by id),
        {_GROUPS}
        select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(l.other, vec_id)) as component_id,
          vec_id <= coalesce(l.other, vec_id) as kept
        from embeddings left join degrees d on d.id = vec_id left join least l on l.id = vec_id""",
    "op9_topk_search": """
        with whole as (
          select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
          from embeddings
          where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
          select q.vec_id as query_id, c.vec_id, cast(list_inner_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
          from whole q join whole c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id)
        select query_id, cast(rank as integer) as rank, vec_id, score from (
          select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
        where rank <= 10""",
    "op12_line_dedup": r"""
        with split as (
          select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
            unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as i
          from documents),
        keyed as (
          select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
          from split),
        repeated as (select k from keyed where k <> '' group by k having count(distinct doc_id) >= 10)
        select doc_id, count(*) as n_lines, count(*) filter (where r.k is not null) as n_dropped,
          sha256(coalesce(string_agg(line, chr(10) order by i) filter (where r.k is null), '')) as kept_sha256
        from keyed left join repeated r using (k) group by doc_id""",
}
