"""The numbered queries and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm import centroids, decontam, fim, langid, license, neardup, pieces, pii, quality, secretscan, topk, toxicity, warc
from spanloom.llm.learn import fold
from spanloom.llm.matches import spelled
from spanloom.session import ship_package, spread


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


OP1_SQL = """
with v as (
  select vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as q
  from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
), s as (
  select a.vec_id as query_id, b.vec_id as vec_id,
         coalesce(cast(list_sum([a.q[i] * b.q[i] for i in range(1, least(len(a.q), len(b.q)) + 1)]) as bigint), 0) as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 10
"""


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"), min_bytes=0)


OP6_SQL = """
with p as (select page_id, coalesce(encode(html), ''::blob) as payload from pages),
m as (select payload, max(page_id) as top from p group by payload),
d as (select page_id, octet_length(payload) as n, sha1(payload) as hex, case when page_id < top then top end as refers_to from p join m using (payload)),
b as (
  select page_id, n, refers_to, list_transform(range(32), lambda k:
    (cast('0x' || hex[(k * 5) // 4 + 1 : (k * 5) // 4 + 2] || case when (k * 5) // 4 + 2 > 40 then '0' else '' end as int)
      >> (3 - (k * 5) % 4)) & 31) as five
  from d
)
select page_id, cast(n as bigint) as payload_bytes,
       array_to_string(list_transform(five, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x + 1, 1)), '') as payload_digest,
       case when refers_to is null then 'response' else 'revisit' end as record_type, refers_to
from b
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), size=10)
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"), "contaminated")


OP7_SQL = """
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark where item_id is not null),
bw as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as s
       from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as t(i) where len(w) > 0),
sizes as (select distinct n from bw),
dw as (select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as s from d, sizes, unnest(range(1, len(w) - n + 2)) as t(i) where len(w) >= n),
hit as (select doc_id, i, dw.n, item_id from dw join bw on dw.s = bw.s and dw.n = bw.n),
words as (select doc_id, count(distinct i + k) as n_hit from hit, unnest(range(0, n)) as t(k) group by doc_id),
items as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as names from hit group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, percent=80)


OP10_SQL = """
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[i : i + 1], ' ') as s from d, unnest(range(1, greatest(len(w) - 1, 1) + 1)) as t(i) where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * k >= 80 * (na.n + nb.n - k)),
e as (select a, b from l union all select b, a from l),
r(node, low) as (select doc_id, doc_id from d union select e.b, r.low from r join e on e.a = r.node and r.low < e.b),
c as (select node, min(low) as low from r group by node)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c.low as component_id, d.doc_id = c.low as kept
from d join c on c.node = d.doc_id left join n on n.doc_id = d.doc_id
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = langid.train(docs.where(~held_out))
    found = langid.identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(spelled("base_spans"), 256).alias("base_sha256"), spelled("spans").alias("spans"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return _scored(toxicity.score(docs, model, keep=["doc_id"]), 0.5)


def _scored(found: DataFrame, limit: float) -> DataFrame:
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def model_path() -> str:
    """The piece model: a file that every executor has."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode(docs, model_path(), keep=["doc_id"])
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secretscan.find(docs, secretscan.train(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(spelled("base_spans"), 256).alias("base_sha256"), spelled("spans").alias("spans"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return _scored(quality.score(docs, model, keep=["doc_id"]), 0.3)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license.scan(_table(spark, sf_dir, "documents"), license.build())
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"), F.array_max("base.start").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"), joined(F.concat("base.label", "spans.label")).alias("labels"), "score",
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"), k=8, rounds=10, size=64, seed=3)


def _rounds_sql(k: int, rounds: int, size: int, seed: int) -> str:
    """k-means as a chain of common table expressions, two for each round. q is a vector's list of whole numbers."""
    parts = [
        f"""v as materialized (
  select row_number() over () as row, vec_id, [cast(floor(1024 * cast(x as double)) as bigint) for x in embedding] as q
  from embeddings where len(embedding) = {size} and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
)""",
        f"""c0 as materialized (
  select row_number() over (order by h, q) - 1 as k, q
  from (select sha256('{seed}:' || cast(vec_id as varchar)) as h, q from v order by h nulls last, q limit {k})
)""",
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} as materialized (
  select row, min(d * {k} + k) % {k} as k, min(d * {k} + k) // {k} as d
  from (select row, k, cast(list_sum([(v.q[i] - c.q[i]) * (v.q[i] - c.q[i]) for i in range(1, {size + 1})]) as bigint) as d from v, c{i} c)
  group by row
)""")
        if i < rounds:
            parts.append(f"""c{i + 1} as materialized (
  select c.k, coalesce(m.q, c.q) as q from c{i} c left join (
    select k, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as q from (
      select a.k, i, sum(v.q[i]) as s, count(*) as n from a{i} a join v using (row), unnest(range(1, {size + 1})) as t(i) group by a.k, i
    ) group by k
  ) m using (k)
)""")
    return f"""with {", ".join(parts)}
select vec_id, cast(k as int) as cluster, d as distance, cast(sum(d) over (partition by k) as bigint) as cluster_inertia,
       cast(sum(d) over () as bigint) as inertia, sha256(array_to_string(c.q, ',')) as centroid_sha256
from a{rounds} join v using (row) join c{rounds} c using (k)
"""


OP12_SQL = _rounds_sql(8, 10, 64, 3)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fim.transform(_table(spark, sf_dir, "documents"), seed=1, plain_from=90, spm_below=20, keep=["doc_id"])
    again = fim.restored(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"))


OP13_SQL = """
with d as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as w,
         sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents
), g as (
  select *, len(w) as n, [cast('0x' || h[8 * i + 1 : 8 * i + 8] as bigint) for i in range(4)] as r from d
), c as (
  select *, least(r[1] % (n + 1), r[2] % (n + 1)) as a, greatest(r[1] % (n + 1), r[2] % (n + 1)) as b,
         case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or r[3] % 100 >= 90 then 'plain'
              when r[4] % 100 < 20 then 'spm' else 'psm' end as form
  from g
), p as (
  select *, array_to_string(w[1 : a], '') as prefix, array_to_string(w[a + 1 : b], '') as middle, array_to_string(w[b + 1 : n], '') as suffix from c
)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from p
"""


def queries() -> dict:
    return {
        "op1_exact_topk": op1_exact_topk,
        "op2_language_id": op2_language_id,
        "op3_pii": op3_pii,
        "op4_toxicity": op4_toxicity,
        "op5_pieces": op5_pieces,
        "op6_warc": op6_warc,
        "op7_decontamination": op7_decontamination,
        "op8_secrets": op8_secrets,
        "op9_quality": op9_quality,
        "op10_near_dedup": op10_near_dedup,
        "op11_license_scan": op11_license_scan,
        "op12_centroids": op12_centroids,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_topk": OP1_SQL,
        "op6_warc": OP6_SQL,
        "op7_decontamination": OP7_SQL,
        "op10_near_dedup": OP10_SQL,
        "op12_centroids": OP12_SQL,
        "op13_fill_in_middle": OP13_SQL,
    }
