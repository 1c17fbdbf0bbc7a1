"""Registered queries of this subpackage, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.llm.exact_dedup import exact_dedup
from sparrowmill.llm.hamming_search import nearest
from sparrowmill.llm.hard_negatives import mine
from sparrowmill.llm.language_id import identify
from sparrowmill.llm.line_dedup import dedup_lines
from sparrowmill.llm.mixing import mix_sources
from sparrowmill.llm.ngram_join import ngram_components
from sparrowmill.llm.packing import pack_documents
from sparrowmill.llm.piece_bpe import encode_documents
from sparrowmill.llm.ppm import score_corpus
from sparrowmill.llm.repair import damaged, repair
from sparrowmill.llm.sharding import shard_documents
from sparrowmill.llm.text import id_remainder, words_in
from sparrowmill.llm.toxicity import score_toxicity
from sparrowmill.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def quality_weight(labels: DataFrame) -> DataFrame:
    """Sampling weight by id: 2 for documents of good quality, a half for bad ones."""
    best = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return best.select("doc_id", F.when(F.col("quality") > 0, 2.0).otherwise(0.5).alias("weight"))


def toxic_labels(labels: DataFrame) -> DataFrame:
    """Labels of the rows that are not held out."""
    return labels.filter(id_remainder(F.col("doc_id"), 5) != 0).select("doc_id", "toxic")


@query("op1_language_id")
def language_id(spark, sf_dir):
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    found = identify(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op3_sharding")
def sharding(spark, sf_dir):
    placed = shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op4_toxicity")
def toxicity(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    return score_toxicity(documents, toxic_labels(labels)).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op5_exact_dedup", """
    with d as (
        select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) as text_sha256
        from documents
    )
    select doc_id, min(doc_id) over (partition by text_sha256) as keep_id,
        count(*) over (partition by text_sha256) as group_size,
        doc_id = min(doc_id) over (partition by text_sha256) as kept, text_sha256
    from d
""")
def dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op6_ppm")
def partial_matching(spark, sf_dir):
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    scored = score_corpus(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op7_piece_bpe")
def piece_bpe(spark, sf_dir):
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op8_mixing", """
    with recursive w as (
        select doc_id, case when max(quality) > 0 then 2.0 else 0.5 end as weight
        from labels where doc_id is not null and quality is not null group by doc_id
    ), d as (
        select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
            -ln((cast('0x' || substr(md5(concat_ws(':', cast(doc_id as varchar), '17')), 1, 13) as bigint) + 0.5) / 4503599627370496.0)
                / coalesce(w.weight, 1.0) as k
        from documents left join w using (doc_id)
    ), s as (
        select source, sum(size) as source_size, row_number() over (order by source nulls last) - 1 as r from d group by source
    ), c as (
        select source, source_size, cast(1 + r % 3 as double) as ratio, cast(3 * source_size as double) as lim,
            (select sum(size) from d) as total from s
    ), o as (
        select *, (total - coalesce(sum(lim) over (order by lim / ratio, source rows between unbounded preceding and 1 preceding), 0))
            / sum(ratio) over (order by lim / ratio, source rows between current row and unbounded following) as level
        from c
    ), t as (
        select source, source_size,
            least(ratio * coalesce((select min_by(level, lim / ratio) from o where lim / ratio >= level), 0), lim) as target from o
    ), u as (
        select doc_id, d.source, size, cast(source_size as bigint) as source_size, target, k,
            case when source_size > 0 then floor(target / source_size) else 0 end as whole,
            row_number() over (partition by d.source order by k, doc_id) as rn
        from d join t on d.source is not distinct from t.source
    ), p as (
        select source, cast(0 as bigint) as rn, any_value(target - whole * source_size) as room, false as chosen from u group by source
        union all
        select u.source, u.rn, case when size <= room and room > 0 then room - size else room end, size <= room and room > 0
        from p join u on u.source is not distinct from p.source and u.rn = p.rn + 1
    ), g as (
        select u.*, p.chosen, min(p.room) over (partition by u.source) as free from u join p on u.source is not distinct from p.source and u.rn = p.rn
    ), f as (        select *, not chosen and abs(free - size) < free and 1 = row_number() over (
            partition by source, chosen, abs(free - size) < free order by abs(free - size), k, doc_id) as fits
        from g
    )
    select doc_id, cast(size as bigint) as size, source_size, target,
        cast(size * (whole + case when chosen or fits then 1 else 0 end) as bigint) as taken
    from f
""")
def mixing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", words_in(F.col("text")).alias("size"))
    weighted = documents.join(quality_weight(table(spark, sf_dir, "labels")), "doc_id", "left")
    mixed = mix_sources(weighted, F.col("size"), F.col("weight"))
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("bigint").alias("taken"))


@query("op9_ngram_join", """
    with recursive w as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') as w from documents
    ), g as (
        select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
        from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from w where len(w) > 0)
    ), n as (select doc_id, count(*) as n from g group by doc_id),
    often as (select g from g group by g having count(*) > 1),
    o as (
        select x.doc_id as a, y.doc_id as b, count(*) as o
        from (select * from g semi join often using (g)) x join (select * from g semi join often using (g)) y on x.g = y.g and x.doc_id <> y.doc_id
        group by x.doc_id, y.doc_id
    ), l as (
        select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * o >= 80 * (x.n + y.n - o)
    ), r as (
        select doc_id as a, doc_id as c from documents union select r.a, l.b from r join l on l.a = r.c
    )
    select d.doc_id, coalesce(n.n, 0) as n_shingles, m.c as component_id
    from documents d left join n using (doc_id) left join (select a, min(c) as c from r group by a) m on m.a = d.doc_id
""")
def ngram_join(spark, sf_dir):
    return ngram_components(table(spark, sf_dir, "documents"))


@query("op2_hamming_search")
def hamming_search(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op10_line_dedup")
def line_dedup(spark, sf_dir):
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_exact", "n_near", F.md5(F.array_join("kept", ",").cast("binary")).alias("kept_md5"))


@query("op11_packing")
def packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), longest=2048, end_id=1)


@query("op12_conversation_repair", """
    with recursive t as (
        select list(v order by i) as t from (
            select i, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as v
            from range(256) as r(i)
        )
    ), c as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, xor(4294967295, list_reduce(
            list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
                lambda ch: cast(unicode(ch) as bigint)),
            lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1]), 4294967295)) % 20 as kind
        from conversations cross join t
    ), d as (
        select conv_id, turn, case when kind = 4 then 'user' else role end as role,
            case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, unnest(range(case when kind = 3 then 2 else 1 end)) as again
        from c where kind <> 0
    ), o as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i, left(role, 1) as ini from d
    ), f as (
        select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
            when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
            when regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
            ini || lead(ini) over (partition by conv_id order by i) as pair
        from o
    ), ins(q, n, p) as (values (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (2, 2, 2), (3, 0, 3), (3, 1, 2), (3, 2, 3)),
    op(p, e, ini, cost, z) as (values (0, 'D', '', 4, 0), (1, 'D', '', 4, 1), (2, 'D', '', 4, 2), (3, 'D', '', 4, 3),
        (0, 'K', 's', 0, 1), (0, 'K', 'u', 0, 2), (1, 'K', 'u', 0, 2), (2, 'K', 'a', 0, 3), (3, 'K', 'u', 0, 2),
        (0, 'R', '', 3, 2), (1, 'R', '', 3, 2), (2, 'R', '', 3, 3), (3, 'R', '', 3, 2)),
    p as (
        select conv_id, cast(0 as bigint) as i, 0 as q, {'c': 0, 'e': ''} as m from c group by conv_id
        union all
        select f.conv_id, f.i, op.z, min({'c': m.c + 3 * n + cost + case when e <> 'D' and fault = 'truncated' then 3 else 0 end, 'e': m.e || repeat('I', n) || e})
        from p join f on p.conv_id is not distinct from f.conv_id and f.i = p.i + 1 join ins using (q) join op on op.p = ins.p
        where e = 'D' or fault in ('', 'truncated') and (e = 'R' or op.ini = f.ini)
        group by f.conv_id, f.i, op.z
    ), ends(q, n) as (values (0, 0), (1, 2), (2, 1), (3, 0)),
    last as (
        select conv_id, min({'c': m.c + 3 * n, 'e': m.e || repeat('I', n)}) as m from p join ends using (q)
        where i = (select count(*) from f where f.conv_id is not distinct from p.conv_id) group by conv_id
    ), e as (
        select conv_id, len(replace(m.e, 'D', '')) % 2 as alone, unnest(string_split(m.e, '')) as e, generate_subscripts(string_split(m.e, ''), 1) as j
        from last where m.e <> ''
    ), w as (
        select *, sum(cast(e <> 'I' as int)) over (partition by conv_id order by j) as i,
            sum(cast(e <> 'D' as int)) over (partition by conv_id order by j) - 1 as k from e
    ), r as (
        select w.conv_id, string_agg(case when e = 'K' then f.role when (k - alone) % 2 = 0 then 'user' else 'assistant' end
            || ':' || case when e = 'I' then '' else f.text end, chr(10) order by j) as repaired
        from w left join f on w.conv_id is not distinct from f.conv_id and w.i = f.i where e <> 'D' group by w.conv_id
    ), g as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
            count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
            count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
        from f group by conv_id
    )
    select last.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
        coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(m.c as bigint) as cost, m.e as audit,
        sha256(coalesce(repaired, '')) as repaired_sha256
    from last left join g on last.conv_id is not distinct from g.conv_id left join r on last.conv_id is not distinct from r.conv_id
""")
def conversation_repair(spark, sf_dir):
    return repair(damaged(table(spark, sf_dir, "conversations")), there=F.col("there"))


@query("op13_hard_negatives", """
    with r as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
        from embeddings
        where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), s as (
        select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score
        from r a join r b on a.vec_id <> b.vec_id and len(a.v) = len(b.v) where a.vec_id % 100 = 0
    ), p as (
        select anchor_id, id as positive_id, score as positive_score from s where same
        qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
    )
    select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as int) as rank,
        id as negative_id, positive_score, score as negative_score
    from s join p using (anchor_id)
    where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
    qualify rank <= 10
""")
def hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, F.col("vec_id") % 100 == 0, label=label)
