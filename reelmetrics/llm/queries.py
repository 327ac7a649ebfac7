"""The registered queries of this subpackage: thin calls of the operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelmetrics.llm.common import fold, table
from reelmetrics.llm.decontaminate import overlaps
from reelmetrics.llm.html_text import extract_text
from reelmetrics.llm.line_chunks import drop_repeated_passages
from reelmetrics.llm.merkle import fold as folded, leaf_digest, merkle_proofs, proof_digest
from reelmetrics.llm.minhash import minhash_duplicates
from reelmetrics.llm.pii import personal_data
from reelmetrics.llm.prefix_trie import prefix_trie, regrown, turn_lists
from reelmetrics.llm.quality import quality, quality_model
from reelmetrics.llm.simhash import near_duplicates
from reelmetrics.llm.token_counts import token_counts
from reelmetrics.llm.topk import top_k
from reelmetrics.llm.toxicity import toxicity, toxicity_model
from reelmetrics.llm.transducer import encode_decode

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def piece_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def encoded_documents(docs: DataFrame) -> DataFrame:
    """Every document encoded and decoded; the decoded text as its digest."""
    done = encode_decode(docs, piece_model())
    return done.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"), "exact")


@query
def op4_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    return encoded_documents(table(spark, d, "documents"))


@query
def op6_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts(table(spark, d, "documents"), piece_model())


@query
def op2_simhash(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(table(spark, d, "documents"))


@query
def op3_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return overlaps(table(spark, d, "documents"), table(spark, d, "benchmark"), short_items=True)


@query
def op5_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    done = drop_repeated_passages(table(spark, d, "documents"))
    return done.select("doc_id", "text", "n_chunks_removed", "n_lines_removed")


@query
def op8_main_text(spark: SparkSession, d: str) -> DataFrame:
    return extract_text(table(spark, d, "pages"))


@query
def op7_top_k(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE["op7_top_k"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, v.vec_id, list_dot_product(q.v, v.v)::bigint as score
  from v q join v on q.vec_id <> v.vec_id where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10"""


def _scored(scored: DataFrame, parts: int, held_out: int, least: float) -> DataFrame:
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), parts) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= least).cast("int").alias("predicted"),
    )


@query
def op9_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, d, "labels"))
    return _scored(toxicity(docs, model), 5, 0, 0.5)


@query
def op10_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = quality_model(docs, table(spark, d, "labels"))
    return _scored(quality(docs, model), 4, 2, 0.7)


@query
def op1_personal_data(spark: SparkSession, d: str) -> DataFrame:
    return personal_data(table(spark, d, "documents"))


MANIFEST = ["doc_id", "source", "lang", "n_chars", "text"]
# The letters that tampering lower-cases.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query
def op11_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    lowered = leaf_digest(*(F.col(c) for c in MANIFEST[:-1]), F.translate("text", UPPER, LOWER))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    proofs = merkle_proofs(docs, MANIFEST, claim=F.when(tampered, lowered))
    done = proofs.withColumn("folded_root", folded(F.coalesce("claim", "leaf"), F.col("proof")))
    return done.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _sql_crc32(value: str) -> str:
    """Unsigned CRC-32 of an ASCII text, a byte and then a bit at a time."""
    bits = "list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({value}, ''), lambda c: ascii(c)::bigint)), lambda acc, b: {bits}), 4294967295)"


def _sql_leaf(text: str) -> str:
    fields = (f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("doc_id::varchar", "source", "lang", "n_chars::varchar", text))
    return f"sha256({' || '.join(fields)})"


ORACLE["op11_merkle_manifest"] = f"""
with recursive
leaves as (
  select doc_id, source, {_sql_leaf("text")} as leaf, {_sql_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} as lowered,
    coalesce({_sql_crc32("doc_id::varchar")} % 5 = 0, false) as tampered from documents),
placed as (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by source) as n, dense_rank() over (order by source nulls first) - 1 as tree from leaves),
lower_nodes(tree, level, idx, h, n) as (
  select tree, 0, pos, leaf, n from placed
  union all
  select tree, level + 1, idx // 16, sha256(string_agg(h, '' order by idx)), (n + 15) // 16 from lower_nodes where n > 1 group by tree, level, idx // 16, n),
subroots as (select tree, h from lower_nodes where n = 1),
upper_nodes(level, idx, h, n) as (
  select 0, tree, h, (select count(*) from subroots) from subroots
  union all
  select level + 1, idx // 16, sha256(string_agg(h, '' order by idx)), (n + 15) // 16 from upper_nodes where n > 1 group by level, idx // 16, n),
nodes as (select tree, level, idx, h, n from lower_nodes where n > 1 union all select -1, level, idx, h, n from upper_nodes where n > 1),
runs as (select tree, level, idx // 16 as run, list(h order by idx) as hs from nodes group by all),
sides as (
  select tree, level, idx, array_to_string(hs[:idx % 16], '') as before, array_to_string(hs[idx % 16 + 2:], '') as after
  from nodes join runs using (tree, level) where run = idx // 16),
steps(doc_id, tree, pos, leaf, top, level, idx, folded, siblings) as (
  select doc_id, tree, pos, leaf, false, 0, pos, case when tampered then lowered else leaf end, '' from placed
  union all
  select s.doc_id, s.tree, s.pos, s.leaf, s.top or d.idx is null, case when d.idx is null then 0 else s.level + 1 end,
    case when d.idx is null then s.tree else s.idx // 16 end,
    case when d.idx is null then s.folded else sha256(d.before || s.folded || d.after) end,
    case when d.idx is null then s.siblings else s.siblings || d.before || d.after end
  from steps s left join sides d on d.tree = case when s.top then -1 else s.tree end and d.level = s.level and d.idx = s.idx
  where not (s.top and d.idx is null)),
ended as (select * from steps where top qualify row_number() over (partition by tree, pos order by level desc) = 1),
root as (select h as root from upper_nodes where n = 1)
select doc_id, leaf, r.h as subroot, root, sha256(siblings) as proof_sha256, folded as folded_root, folded = root as verified
from ended join subroots r using (tree), root"""


@query
def op12_minhash(spark: SparkSession, d: str) -> DataFrame:
    found = minhash_duplicates(table(spark, d, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


@query
def op13_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    return prefix_trie(regrown(turn_lists(table(spark, d, "conversations"))))


ORACLE["op12_minhash"] = """
with recursive
words as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \\x09-\\x0D]+'), lambda w: w <> '') as w from documents),
five as (
  select doc_id, w || ' ' || lead(w, 1) over o || ' ' || lead(w, 2) over o || ' ' || lead(w, 3) over o || ' ' || lead(w, 4) over o as x
  from (select doc_id, unnest(w) as w, unnest(range(1, len(w) + 1)) as i from words where len(w) >= 5) window o as (partition by doc_id order by i)),
items as (
  select distinct doc_id, x from five where x is not null
  union all select doc_id, array_to_string(w, ' ') from words where len(w) between 1 and 4),
sizes as (select doc_id, count(x) as n from documents left join items using (doc_id) group by doc_id),
-- Any 15 % + 1 of a set must meet a similar one; the rarest shingles are taken.
spread as (select x, count(*) as f from items group by x),
rare as (select doc_id, x from items join spread using (x) join sizes using (doc_id) where f > 1
  qualify row_number() over (partition by doc_id order by f, x) <= n - ceil(0.85 * n) + 1),
near as (select distinct a.doc_id as a, b.doc_id as b from rare a join rare b on a.x = b.x and a.doc_id < b.doc_id
  join sizes sa on sa.doc_id = a.doc_id join sizes sb on sb.doc_id = b.doc_id where 100 * least(sa.n, sb.n) >= 85 * greatest(sa.n, sb.n)),
links as (
  select a, b from near join items i on i.doc_id = a join items j on j.doc_id = b and i.x = j.x
  group by a, b having 185 * count(*) >= 85 * (any_value((select n from sizes where doc_id = a)) + any_value((select n from sizes where doc_id = b)))),
ways as (select a, b from links union all select b, a from links),
reach(doc_id, low) as (select doc_id, doc_id from sizes union select b, r.low from reach r join ways on a = r.doc_id where r.low < b),
least_of as (select doc_id, min(low) as component_id from reach group by doc_id)
select doc_id, n as n_shingles, component_id, doc_id = component_id as kept from sizes join least_of using (doc_id)"""


ORACLE["op13_prefix_trie"] = f"""
with turns as (
  select conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as h,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+')) as w from conversations where conv_id is not null),
lists as (select conv_id, list({{'h': h, 'w': w}} order by turn nulls first, h) as t from turns group by conv_id),
aimed as (select *, ({_sql_crc32("conv_id::varchar")} % 4)::bigint as h from lists),
rebuilt as (
  select a.conv_id, coalesce(s.t[:a.h], []) || a.t[a.h + 1:] as t
  from aimed a left join lists s on s.conv_id = a.conv_id - a.conv_id % 20),
keyed as (select conv_id, len(t) as n, list_transform(t, lambda x: x.h) as hs, list_transform(t, lambda x: x.w) as ws from rebuilt),
prefixes as (select conv_id, n, d, array_to_string(hs[:d], ',') as key, array_to_string(hs[:d - 1], ',') as up, ws[d] as w
  from (select *, unnest(range(0, n + 1)) as d from keyed)),
nodes as (
  select d, key, any_value(case when d > 0 then up end) as up, min(conv_id) as conv_id, count(*) as n_convs, coalesce(any_value(w), 0) as w,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = d), '')) as ends_sha256
  from prefixes group by d, key),
children as (select up as key, d - 1 as d, count(*) as n_children from nodes where up is not null group by all),
full_nodes as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join children using (d, key)),
inside as (
  select top, key_top, sum((n_children = 0)::int) as n_leaves, sum((n_convs - 1) * w) as saved_tokens
  from (select *, unnest(range(0, d + 1)) as top, key[:greatest(0, top * 65 - 1)] as key_top from full_nodes) group by top, key_top)
select n.conv_id, n.d as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, i.n_leaves::bigint as n_leaves,
  i.saved_tokens::bigint as saved_tokens, n.ends_sha256
from full_nodes n join inside i on i.top = n.d and i.key_top = n.key left join full_nodes p on p.d = n.d - 1 and p.key = n.up"""
