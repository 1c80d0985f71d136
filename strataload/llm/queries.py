"""The contract queries, each next to the SQL that must give the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataload.llm import htmltext, langid, quality_gam, simhash, toxicity
from strataload.llm.common import fold_of
from strataload.llm.decontaminate import find_leaks
from strataload.llm.minhash import near_duplicates
from strataload.llm.mixing import mix
from strataload.llm.periodic import find_runs
from strataload.llm.pii import pseudonymised
from strataload.llm.pii import pseudonymised
from strataload.llm.quality_rules import judge
from strataload.llm.registry import query
from strataload.llm.search import search
from strataload.llm.warc import archived

WORDS_SQL = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint"

MIX_SQL = rf"""
with sized as (
  select doc_id, source, {WORDS_SQL} as size, md5('mix:' || coalesce(doc_id::varchar, 'none')) as place from documents
), sources as (
  select source, sum(size)::bigint as source_size from sized group by source
), ranked as (
  select *, 2 * source_size as cap,
         [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from sources
), leveled as (
  select *, (sum(source_size) over ()::double * 1.5
             - coalesce(sum(cap) over (order by cap / weight, source nulls last
                                       rows between unbounded preceding and 1 preceding), 0)::double)
          / (sum(weight) over () - coalesce(sum(weight) over (order by cap / weight, source nulls last
                                       rows between unbounded preceding and 1 preceding), 0))::double as level
  from ranked
), found as (
  select max(level) filter (where level <= cap::double / weight::double) as level from leveled
), targets as (
  select l.source, source_size, least(cap::double, coalesce(f.level * weight::double, cap::double)) as target
  from leveled l, found f
), queued as (
  select s.*, t.source_size, t.target,
         sum(size) over (partition by s.source order by place, doc_id, size
                         rows between unbounded preceding and current row)::bigint as sent
  from sized s join targets t on s.source is not distinct from t.source
), copies as (
  select q.*, epoch, (sent + epoch * source_size)::double / target as finish
  from queued q, (values (0), (1)) e(epoch) where size > 0
), stream as (
  select *, sum(size) over (order by finish, source is null, source, sent
                            rows between unbounded preceding and current row) as running from copies
), counts as (
  select source, sent, doc_id, size, count(*) as n from stream
  where running <= 1.5 * (select sum(size) from sized) group by all
)
select q.doc_id, q.size, q.source_size, q.target, coalesce(q.size * c.n, 0)::bigint as taken
from queued q left join counts c
  on q.source is not distinct from c.source and q.sent = c.sent and q.doc_id is not distinct from c.doc_id
  and q.size = c.size and q.size > 0
"""


@query("op6_weighted_mix", MIX_SQL)
def op6_weighted_mix(t):
    return mix(t.documents).select("doc_id", "size", "source_size", "target", "taken")


NEAR_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then []
    when len(w) < 5 then [list_aggregate(w, 'string_agg', ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) end) as s from words
), sizes as (
  select d.doc_id, count(s.s)::bigint as n from documents d left join shingles s on d.doc_id = s.doc_id group by d.doc_id
), pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select p.a, p.b from pairs p join sizes x on p.a = x.doc_id join sizes y on p.b = y.doc_id
  where 100 * common >= 85 * (x.n + y.n - common)
), edges as (select a, b from links union all select b, a from links
), reach as (
  select doc_id as u, doc_id as v from documents union select r.u, e.b from reach r join edges e on r.v = e.a
), comps as (select u, min(v) as component_id from reach group by u)
select s.doc_id, s.n as n_shingles, c.component_id, s.doc_id = c.component_id as kept
from sizes s join comps c on s.doc_id = c.u
"""


@query("op3_circulant_minhash", NEAR_SQL)
def op3_circulant_minhash(t):
    return near_duplicates(t.documents)


@query("op10_greedy_tiling")
def op10_greedy_tiling(t):
    return (
        find_leaks(t.documents, t.benchmark)
        .select("doc_id", F.col("item").cast("long").alias("item_id"), "n_tokens", "covered", "n_tiles", "coverage")
        .distinct()
    )


@query("op4_nearest_centroid")
def op4_nearest_centroid(t):
    docs = t.documents.select("doc_id", "text", "lang")
    model = langid.fit(langid.learning_rows(docs))
    held_out = F.coalesce(fold_of(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out, "lang_pred", "score", "cosine", "rejected")


@query("op1_feistel_pseudonyms")
def op1_feistel_pseudonyms(t):
    return pseudonymised(t.documents.select("doc_id", "text"))


@query("op9_ngram_likelihood")
def op9_ngram_likelihood(t):
    trusted = t.labels.filter("quality = 1").select("doc_id")
    return judge(t.documents.select("doc_id", "text"), trusted)


WARC_SQL = """
with payloads as (
  select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as payload_digest,
         strlen(coalesce(html, ''))::bigint as payload_bytes from pages
), marked as (
  select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) end as original
  from payloads
)
select page_id, payload_bytes, payload_digest,
       case when original is not null and page_id is distinct from original then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from original then original end as refers_to
from marked
"""


@query("op8_warc_archives", WARC_SQL)
def op8_warc_archives(t):
    return archived(t.pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_additive_quality")
def op7_additive_quality(t):
    docs = t.documents.select("doc_id", "text")
    labels = t.labels.filter(fold_of(F.col("doc_id"), 5) != 0).select("doc_id", F.col("quality").alias("label"))
    model = quality_gam.fit(docs, labels)
    held_out = F.coalesce(fold_of(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")
    return quality_gam.score(docs, model).select("doc_id", held_out, "score", "predicted")


@query("op5_noisy_channel")
def op5_noisy_channel(t):
    docs = t.documents.select("doc_id", "text")
    labels = t.labels.filter(fold_of(F.col("doc_id"), 3) != 1).select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, labels)
    held_out = F.coalesce(fold_of(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held_out, "score", "predicted")


@query("op2_boosted_nodes")
def op2_boosted_nodes(t):
    pages = t.pages.select("page_id", "url", "html")
    return htmltext.main_text(pages, htmltext.fit(pages)).select("page_id", "url", "text", "n_chars")


@query("op13_pigeonring_simhash")
def op13_pigeonring_simhash(t):
    return simhash.near_duplicates(t.documents)


@query("op12_basic_factors")
def op12_basic_factors(t):
    return find_runs(t.documents.select("doc_id", "text"), seed_tails=True).drop("text")


TERMS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

SEARCH_SQL = rf"""
with tokens as (
  select doc_id, {TERMS_SQL} as t from documents
), totals as (
  select count(*) filter (where len(t) > 0) as docs, sum(len(t))::bigint as len from tokens
), wanted as (
  select distinct item_id, unnest({TERMS_SQL}) as term from benchmark
), held as (
  select doc_id, n, term, count(*) as tf from (select doc_id, len(t) as n, unnest(t) as term from tokens)
  where term in (select term from wanted) group by all
), weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w
  from (select term, count(*) as df from held group by term), totals
), scored as (
  select item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // len))))::bigint as score
  from wanted join held using (term) join weights using (term), totals group by all
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
  from scored where score > 0
)
select * from ranked where rank <= 50
"""


@query("op11_document_tree", SEARCH_SQL)
def op11_document_tree(t):
    return search(t.documents, t.benchmark)
