"""The corpus queries on the given tables, with check SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from assay.llm import bpe, chaining, idfile, langid, minhash, negatives, phrases, quality, simhash, suffixes, tiling, topk, urls
from assay.session import shared_folder, small_batches
from assay.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, check: str | None = None):
    """Register a (spark, folder) -> DataFrame query with its check SQL, if one exists."""
    def keep(fn):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            small_batches(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if check is not None:
            CHECK_SQL[name] = check
        return fn
    return keep


@query("op1_suffix_array")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of documents in 50-byte strings that also start in a document of smaller id, removed."""
    return suffixes.kept_digest(suffixes.remove_repeats(read_table(spark, folder, "documents")))


@query("op2_substring")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of documents that repeat, exactly or nearly, in a document of smaller id."""
    found = chaining.repeated_passages(read_table(spark, folder, "documents"))
    return found.withColumnsRenamed({"id": "doc_id", "first_id": "first_doc_id"})


@query("op3_minhash")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose 3-word shingle sets are similar by 85 in 100 or more."""
    return minhash.near_duplicates(read_table(spark, folder, "documents"), shingle=3, percent=85)


OP4_CHECK = """
with v as (select vec_id, list_transform(embedding, lambda e: cast(floor(64 * cast(e as double)) as bigint)) as v from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
      from v q join v c on q.vec_id != c.vec_id and len(q.v) = len(c.v) where q.vec_id % 20 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score from
    (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 20"""


@query("op4_topk", OP4_CHECK)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 greatest integer inner products of every twentieth vector."""
    return topk.top_k(read_table(spark, folder, "embeddings"))


@query("op5_token_ids")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, written as id files and read back."""
    import public_tokenizers

    target = f"{shared_folder(spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    idfile.write_ids(read_table(spark, folder, "documents"), target, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    docs = idfile.read_ids(spark, target)
    return docs.select(
        F.col("id").cast("long").alias("doc_id"), "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
    )


@query("op6_url_filter", urls.CHECK)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's address by rules, then host reputation."""
    return urls.judge(read_table(spark, folder, "pages"), read_table(spark, folder, "labels"))


@query("op7_language")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every page from its text, markup, address and host."""
    return langid.identify(read_table(spark, folder, "pages"), read_table(spark, folder, "documents"))


@query("op8_decontaminate")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items that documents hold, in whole or in reordered parts."""
    return tiling.contaminated(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


@query("op9_quality")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document and whether it is kept."""
    scored = quality.classify(read_table(spark, folder, "documents"))
    return scored.select("doc_id", "quality_score", F.col("accepted").alias("kept"))


@query("op10_byte_bpe")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level BPE ids of every document and what they decode to, as digests."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.encode_decode(read_table(spark, folder, "documents"), path, pattern)


OP11_CHECK = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda e: cast(floor(256 * cast(e as double)) as bigint)) as v from embeddings
           where vec_id is not null and label is not null and embedding is not null
             and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0),
s as (select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
             cast(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
      from v a join v c on a.vec_id != c.vec_id and len(a.v) = len(c.v) where a.vec_id % 100 = 0),
p as (select * from (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as r from s where same) where r <= 5)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from
    (select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
            row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as rank
     from p join s on p.anchor_id = s.anchor_id and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
where rank <= 10"""


@query("op11_hard_negatives", OP11_CHECK)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Ten negatives of moderate score for each of the five best positives of every hundredth vector."""
    rows = read_table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved))


OP12_CHECK = r"""
with d as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
p as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as (select lang, row_number() over () as id, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x != '') as ws from p),
u as (select lang, id, unnest(ws) as w1, generate_subscripts(ws, 1) as i from w),
t as (select lang, w1, lead(w1) over q as w2, lead(w1, 2) over q as w3 from u window q as (partition by id order by i)),
g as (select lang, 1 as k, w1 as phrase from t union all select lang, 2, w1 || ' ' || w2 from t where w2 is not null
      union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 from t where w3 is not null),
f as materialized (select lang, k, phrase, count(*) as f from g group by all),
n as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by lang),
c as materialized (select *, string_split(phrase, ' ') as words from f where k > 1 and f >= 10),
part as materialized (select lang, phrase, k, f as a, j, array_to_string(words[1:j], ' ') as one, array_to_string(words[j + 1:], ' ') as two
         from c, (values (1), (2)) t(j) where j < k),
cut as (select p.lang, p.phrase, p.k, p.a, x.f as l, y.f as r, j, cast(1000000 * p.a::hugeint * p.a // (x.f::hugeint * y.f) as bigint) as score
        from part p join f x on x.lang = p.lang and x.phrase = p.one join f y on y.lang = p.lang and y.phrase = p.two),
best as (select * from (select *, row_number() over (partition by lang, phrase order by score, j) as q from cut) where q = 1),
inside as (select lang, array_to_string(words[1:2], ' ') as phrase, f from c where k = 3
           union all select lang, array_to_string(words[2:3], ' '), f from c where k = 3),
around as (select lang, phrase, max(f) as most from inside group by all),
kept as (select b.lang, b.phrase, b.a, b.l, b.r, b.score
         from best b left join around o on o.lang = b.lang and o.phrase = b.phrase where o.most is null or 100 * o.most < 50 * b.a)
select lang, rank, phrase, a, l, r, n, score from
    (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept) join n using (lang) where rank <= 2000"""


@query("op12_collocations", OP12_CHECK)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """The 2,000 best phrases of two and three words of each language."""
    return phrases.collocations(read_table(spark, folder, "documents"))


@query("op13_simhash")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose 3-word SimHash fingerprints differ in two bits or fewer."""
    return simhash.simhash_groups(read_table(spark, folder, "documents"))
