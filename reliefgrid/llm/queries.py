"""The registered queries of the subpackage, each over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reliefgrid.llm import bpe, clusters, multiindex, ordinal, outliers, packing, personal, pulearn, ranked, recompression, sharding, simhash, warc
from reliefgrid.rounds import Rounds, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), Rounds(spark, "simhash"))


@query
def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounds = Rounds(spark, "shards")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    numbered, n = sharding.numbered(rows, ["doc_id", "size", "text_crc32"], rounds)
    placed = sharding.shard(numbered, n, 16, seed=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(cut, Rounds(spark, "packing"))


@query
def op6_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounds = Rounds(spark, "outliers")
    rows = rounds.put(outliers.statistics(table(spark, sf_dir, "documents")), "statistics")
    return outliers.judged(rows, rounds).drop("lang", "source")


@query
def op7_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = pulearn.score(docs, pulearn.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", pulearn.held_out().alias("held_out"), "score", (F.col("score") >= pulearn.SCORE_FROM).cast("int").alias("predicted"))


@query
def op3_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    graded = ordinal.severity(docs, ordinal.fit(docs, table(spark, sf_dir, "labels")))
    return graded.select("doc_id", pulearn.held_out().alias("held_out"), "score", "severity", "grade", (F.col("score") >= ordinal.TOXIC_FROM).cast("int").alias("predicted"))


@query
def op1_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = recompression.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op1_recompression"] = r"""
with texts as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), windows as (
  select doc_id, p, array_to_string(words[p:p + 12], ' ') as w
  from (select doc_id, words, unnest(range(1, len(words) - 11)) as p from texts)
), repeats as (
  select doc_id, p from (select doc_id, p, min(doc_id) over (partition by w) as least from windows) where doc_id > least
), gone as (
  select distinct doc_id, p + j as i from repeats, range(13) r(j)
), kept as (
  select t.doc_id, string_agg(t.word, ' ' order by t.i) as kept, count(*) as n_kept
  from (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as i from texts) t
  anti join gone g on t.doc_id = g.doc_id and t.i = g.i
  group by t.doc_id
)
select t.doc_id, len(words)::bigint as n_words, (len(words) - coalesce(n_kept, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts t left join kept k using (doc_id)
"""


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=False)


@query
def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.near_duplicates(table(spark, sf_dir, "embeddings"), Rounds(spark, "vectors"))


ORACLES["op4_multi_index"] = """
with recursive vectors as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as materialized (
  select a.vec_id as a, b.vec_id as b from vectors a join vectors b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.93
), reach(vec_id, r) as (
  select vec_id, vec_id from embeddings
  union
  select reach.vec_id, links.b from reach join links on reach.r = links.a
)
select vec_id, coalesce(n, 0)::bigint as n_links, least as component_id, vec_id = least as kept
from (select vec_id, min(r) as least from reach group by vec_id)
left join (select a as vec_id, count(*) as n from links group by a) using (vec_id)
"""


@query
def op2_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder).drop("url")


ORACLES["op2_warc_dictionary"] = """
with p as (
  select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), f as (
  select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) else page_id end as first from p
)
select page_id, payload_bytes, payload_digest, case when first < page_id then 'revisit' else 'response' end as record_type,
  case when first < page_id then first end as refers_to
from f
"""


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clustered(table(spark, sf_dir, "embeddings"), Rounds(spark, "centroids"))


def _centroids_sql(turns: int) -> str:
    assign = """a{t} as materialized (
  select k.r, any_value(k.vec_id) as vec_id, any_value(k.x) as x, min(list_sum(list_transform(list_zip(k.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint * 8 + c.c) as m
  from kept k, c{t} c group by k.r
)"""
    move = """c{u} as materialized (
  select c.c, coalesce(n.x, c.x) as x from c{t} c left join (
    select c, list(f order by i) as x from (
      select c, i, (s - ((s % n) + n) % n) // n as f from (
        select c, i, sum(x)::bigint as s, count(*) as n from (select m % 8 as c, unnest(x) as x, unnest(range(64)) as i from a{t}) group by c, i
      )
    ) group by c
  ) n on n.c = c.c
)"""
    steps = [s.format(t=t, u=t + 1) for t in range(turns) for s in (assign, move)] + [assign.format(t=turns)]
    return f"""
with kept as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda e: floor(1024 * e::double)::bigint) as x from embeddings
  where embedding is not null and len(embedding) = 64 and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
), c0 as materialized (
  select row_number() over (order by sha256('3:' || vec_id), x) - 1 as c, x from kept order by sha256('3:' || vec_id), x limit 8
), {", ".join(steps)}
select a.vec_id, (m % 8)::int as cluster, (m // 8)::bigint as distance, (sum(m // 8) over (partition by m % 8))::bigint as cluster_inertia,
  (sum(m // 8) over ())::bigint as inertia, sha256(array_to_string(c.x, ',')) as centroid_sha256
from a{turns} a join c{turns} c on a.m % 8 = c.c
"""


ORACLES["op13_centroids"] = _centroids_sql(10)


@query
def op12_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Rounds(spark, "ranked"))


ORACLES["op12_pair_maxscore"] = r"""
with d as materialized (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents where text is not null
), sized as materialized (
  select doc_id, terms, len(terms)::bigint as n from d where len(terms) > 0
), totals as materialized (
  select count(*)::bigint as n_docs, sum(n)::bigint as total from sized
), asked as materialized (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), postings as materialized (
  select term, doc_id, n, count(*)::bigint as tf from (select doc_id, n, unnest(terms) as term from sized)
  where term in (select term from asked) group by term, doc_id, n
), weights as materialized (
  select term, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from postings, totals group by term
), scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // total))))::bigint as score
  from asked join postings using (term) join weights using (term), totals group by item_id, doc_id
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from scored where score > 0 qualify rank <= 50
"""


@query
def op11_crf_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal.find(docs, personal.learn(personal.labelled(docs)))
