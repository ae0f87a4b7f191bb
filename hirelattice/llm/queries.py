"""The registered queries of this package: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelattice.llm import alignment, blocknames, covertree, decontaminate, hardneg, huffman, minhash, packing, passages, quality, rollup, sharding, urlfilter
from hirelattice.llm.common import read_table, ready, stored
from hirelattice.session import run_dir

SHARDS = 40
# (host and path, verdict): fixed values of the contract
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(ready(spark), sf_dir, "documents"), SHARDS)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(ready(spark), sf_dir, "documents"))


def op3_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeat_report(read_table(ready(spark), sf_dir, "documents"))


def op4_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicate_vectors(read_table(ready(spark), sf_dir, "embeddings").select("vec_id", "embedding"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "key string, verdict string")
    pages = read_table(ready(spark), sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge_urls(pages, rules).drop("url")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read_table(ready(spark), sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end=0)
    return packed.select("doc_id", "start", "length", packing.wide_crc32().alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return quality.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(ready(spark), "token-files")
    huffman.write_tokens(read_table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end=2)
    return huffman.open_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after five deliveries: all documents come in under two tokenizers, copies but the first of each text go, the
    counts of what is left are revised under the first tokenizer, whose documents get an end id, and the deletion comes once more."""
    documents = read_table(ready(spark), sf_dir, "documents")
    names = ("byte_bpe_50k", "word_bpe_49k")
    counted = stored(rollup.token_counts(documents, {name: tokenizer_path(f"{name}.json") for name in names}), "token-counts")
    rows = stored(rollup.without_copies(counted).withColumns({"left": F.col("n") - F.col("gone"), "ended": F.col(names[0]) + 1}), "copies")
    totals = rollup.TokenTotals(spark, run_dir(spark, "token-totals"))
    for name in names:
        totals.commit(f"load {name}", rollup.deltas(rows, name, name, 1, "n"))
    gone = rollup.deltas(rows, names[0], names[0], -1, "gone").union(rollup.deltas(rows, names[1], names[1], -1, "gone"))
    totals.commit("copies", gone)
    totals.commit("ended", rollup.deltas(rows, names[0], names[0], -1, "left").union(rollup.deltas(rows, names[0], "ended", 1, "left")))
    totals.commit("copies", gone)
    return totals.totals()


def op11_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocknames.exact_copies(read_table(ready(spark), sf_dir, "documents")).drop("level", "name")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(ready(spark), sf_dir, "documents")
    return alignment.align_documents(documents, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of every seventh vector is moved on by one, as the contract has it."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(ready(spark), sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hardneg.hard_negatives(rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_minhash": op2_minhash,
    "op3_substring": op3_substring,
    "op4_cover_tree": op4_cover_tree,
    "op5_url_filter": op5_url_filter,
    "op6_decontamination": op6_decontamination,
    "op7_packing": op7_packing,
    "op8_quality": op8_quality,
    "op9_huffman": op9_huffman,
    "op10_token_counts": op10_token_counts,
    "op11_block_naming": op11_block_naming,
    "op12_alignment": op12_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

_URL_PARTS = """
    parts as (
        select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
    urls as (
        select page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
               regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path from parts)"""
_RULES = ", ".join(f"('{k[:k.index('/')]}', '{k[k.index('/'):]}', '{v}')" for k, v in URL_RULES)

SQL: dict[str, str] = {
    "op5_url_filter": f"""
with {_URL_PARTS},
    rules(rule_host, rule_path, verdict) as (values {_RULES}),
    fits as (
        select page_id, rule_host || rule_path as rule, verdict,
               row_number() over (partition by page_id order by length(rule_host || rule_path) desc, length(rule_host) desc) as k
        from urls join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from urls u left join fits f on f.page_id = u.page_id and f.k = 1""",
    "op11_block_naming": """
with lower_case as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
from lower_case window w as (partition by t)""",
    "op13_hard_negatives": """
with vectors as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
    from embeddings
    where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scores as (
        select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
               cast(list_sum(list_transform(range(1, len(a.q) + 1), lambda k: a.q[k] * b.q[k])) as bigint) as score
        from vectors a join vectors b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
    positives as (
        select anchor_id, other_id as positive_id, score as positive_score from scores where same
        qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.other_id) as integer) as rank,
       s.other_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scores s on s.anchor_id = p.anchor_id and not s.same
    and 100 * s.score >= 30 * p.positive_score and 100 * s.score <= 90 * p.positive_score
qualify rank <= 10""",
}
