"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetlake.llm import bpe
from sheetlake.llm.exact_dedup import exact_duplicates
from sheetlake.llm.langid import identify
from sheetlake.llm.lexical import rank_documents
from sheetlake.llm.licenses import scan_licenses
from sheetlake.llm.minhash import near_duplicates
from sheetlake.llm.mixing import mix
from sheetlake.llm.packing import pack
from sheetlake.llm.pii import anonymised
from sheetlake.llm.topk import top_k
from sheetlake.llm.url_filter import judge
from sheetlake.llm.wavelet import token_shards
from sheetlake.llm.whitening import whiten

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), share=(85, 100))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anonymised(table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op7_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", F.floor(F.length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", F.floor(F.length("ids") / 4).alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_packing": op2_packing,
    "op3_licenses": op3_licenses,
    "op4_topk": op4_topk,
    "op5_pii": op5_pii,
    "op6_langid": op6_langid,
    "op7_wavelet": op7_wavelet,
    "op8_bpe": op8_bpe,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_mixing": op11_mixing,
    "op12_lexical": op12_lexical,
    "op13_whitening": op13_whitening,
}

ORACLES: dict[str, str] = {
    "op4_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as e from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (
            select q.vec_id as query_id, c.vec_id,
                   list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::bigint as score
            from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(q.e) = len(c.e))
        select query_id, cast(row_number() over best as integer) as rank, vec_id, score
        from s window best as (partition by query_id order by score desc, vec_id)
        qualify row_number() over best <= 10""",
    "op9_exact_dedup": f"""
        with t as (
            select doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) as text_sha256
            from documents)
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id is not distinct from max(doc_id) over same as kept, text_sha256
        from t window same as (partition by text_sha256)""",
    "op10_url_filter": r"""
        with recursive rules(host, path, verdict) as (values
            ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
            ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        links as (
            select url, unnest(list_filter(list_concat(
                list_transform(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*>'),
                    lambda t: regexp_matches(t, '(?is)\brel\s*=\s*["'']?\s*canonical\b')),
                    lambda t: regexp_extract(t, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)),
                list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*>'),
                    lambda t: regexp_matches(t, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')),
                    lambda t: regexp_extract(t, '(?is)\bcontent\s*=\s*(?:"[^">]*?|''[^''>]*?)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1))),
                lambda x: x <> '')) as link
            from pages where url is not null and html is not null),
        targets as (
            select url, case
                when regexp_matches(link, '(?i)^[a-z][a-z0-9+.-]*://') then link
                when link like '//%' then 'http:' || link
                when link like '/%' then 'http://' || host || link
                when link like '?%' then 'http://' || host || path || link
                when regexp_matches(link, '(?i)^([a-z][a-z0-9+.-]*:|#)') then null
                else 'http://' || host || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') || link end as target
            from links, lateral (
                select translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') as host,
                       regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path)),
        parsed(url, host, path, query) as (
            select u, translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz'),
                   regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1),
                   regexp_extract(u, '(?s)^.*?://[^?#]*\?([^#]*)', 1)
            from (select url as u from pages union select target from targets) where u is not null),
        judged as (
            select p.url, p.host, p.path,
                   case when p.host <> '' then p.host || coalesce(nullif(p.path, ''), '/')
                        || case when p.query <> '' then '?' || p.query else '' end end as node,
                   arg_max(r.host || r.path, length(r.host || r.path)) as rule,
                   arg_max(r.verdict, length(r.host || r.path)) as verdict
            from parsed p left join rules r on (p.host = r.host or suffix(p.host, '.' || r.host))
                                           and starts_with(p.path, r.path)
            group by p.url, p.host, p.path, p.query),
        edges as (
            select a.node as a, b.node as b from targets t join judged a on a.url = t.url join judged b on b.url = t.target
            where a.node is not null and b.node is not null),
        both_ways as (select a, b from edges union select b, a from edges),
        bad(node) as (
            select j.node from judged j join both_ways e on e.a = j.node where j.verdict = 'block'
            union select e.b from bad join both_ways e on e.a = bad.node)
        select p.page_id, coalesce(j.host, '') as host, coalesce(j.path, '') as path, j.rule,
               coalesce(j.verdict, case when j.node in (select node from bad) then 'block' end, 'allow') as verdict
        from pages p left join judged j on j.url = p.url""",
    # blocks and seats are listed one by one here, sources stop in rounds
    "op11_mixing": r"""
        with recursive docs as (
            select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
        src as (
            select source, sum(size)::hugeint as source_size,
                   row_number() over (order by source nulls last) - 1 as rank from docs group by source),
        weighed as (select *, 1 + rank % 3 as weight, 3 * source_size as most, sum(source_size) over () as total from src),
        rounds(turn, stopped) as (
            select 0, []::bigint[]
            union all
            select turn + 1, now from (
                select any_value(turn) as turn, any_value(stopped) as stopped, list(rank order by rank) filter (
                    list_contains(stopped, rank) or most * free_weight <= (total - held) * weight) as now
                from (select r.turn, r.stopped, w.*,
                             sum(case when list_contains(r.stopped, w.rank) then 0 else w.weight end) over () as free_weight,
                             sum(case when list_contains(r.stopped, w.rank) then w.most else 0 end) over () as held
                      from rounds r, weighed w))
            where now is distinct from stopped and now is not null),
        stopped as (select stopped from rounds order by turn desc limit 1),
        aimed as (
            select w.*, list_contains(stopped, rank) as stops,
                   total - sum(case when list_contains(stopped, rank) then most else 0 end) over () as shared,
                   sum(case when list_contains(stopped, rank) then 0 else weight end) over () as sharing
            from weighed w, stopped),
        plan as (
            select *, case when stops then most::double else (shared * weight)::double / sharing end as target,
                   (source_size + 31) // 32 as blocks, (total + 16) // 32 as seats from aimed),
        won as (
            select rank, row_number() over (order by target / (2 * k + 1) desc, rank, k) as nth, seats
            from plan, lateral (select unnest(range(0, least(seats, 3 * blocks)::bigint)) as k)),
        quotas as (select rank, count(*) as quota from won where nth <= seats group by rank),
        runs as (
            select rank, quota, blocks, greatest(1, (blocks + 63) // 64) as run from plan join quotas using (rank) where blocks > 0),
        shards as (
            select rank, quota, run, shard, least(run, blocks - shard * run) as n, md5('0|shard|' || rank || '|' || shard) as draw
            from runs, lateral (select unnest(range(0, ((blocks - 1) // run + 1)::bigint)) as shard)),
        dealt as (
            select rank, shard, n, row_number() over (partition by rank order by n::double / (2 * k + 1) desc, draw, k) as nth, quota
            from shards, lateral (select unnest(range(0, least(quota, 3 * n)::bigint)) as k)),
        taken_by as (select rank, shard, count(*) as q from dealt where nth <= quota group by all),
        block as (
            select rank, shard * run + k as nr, q // n + ((k + 1 + turn) * (q % n)) // n - ((k + turn) * (q % n)) // n as times
            from (select rank, shard, run, n, coalesce(q, 0) as q, ('0x' || left(draw, 8))::bigint % n as turn
                  from shards left join taken_by using (rank, shard)),
                 lateral (select unnest(range(0, n::bigint)) as k)),
        placed as (
            select doc_id, size, rank, row_number() over () as row,
                   sum(size) over (partition by rank order by md5('0|' || coalesce(doc_id::varchar, 'null') || '|' || size), doc_id
                                   rows unbounded preceding) - size as start
            from docs join src on docs.source is not distinct from src.source),
        taken as (
            select row, sum((least(start + size, 32 * nr + 32) - greatest(start, 32 * nr)) * times) as taken
            from placed p join block b on b.rank = p.rank and b.nr >= start // 32 and 32 * b.nr < start + size
            where size > 0 group by row)
        select doc_id, source, size::bigint as size, source_size::bigint as source_size, target,
               coalesce(taken, 0)::bigint as taken
        from placed join plan using (rank) left join taken using (row)""",
    "op12_lexical": r"""
        with words as (
            select row, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from (select row_number() over () as row, doc_id,
                         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents)),
        counts as (select row, any_value(doc_id) as doc_id, term, count(*) as tf from words group by row, term),
        lengths as (select row, sum(tf)::bigint as n from counts group by row),
        whole as (select count(*) as docs, sum(n)::bigint as total from lengths),
        weights as (select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w
                    from counts, whole group by term),
        asked as (
            select item, any_value(item_id) as item_id, term, count(*) as times
            from (select item, item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
                  from (select row_number() over () as item, item_id,
                               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from benchmark))
            group by item, term),
        scored as (
            select item, any_value(item_id) as item_id, any_value(doc_id) as doc_id,
                   sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::bigint as score
            from asked join counts using (term) join weights using (term) join lengths using (row), whole
            group by item, row)
        select item_id, cast(row_number() over best as integer) as rank, doc_id, score from scored where score > 0
        window best as (partition by item order by score desc, doc_id nulls last)
        qualify row_number() over best <= 20""",
}
