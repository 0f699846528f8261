"""The registered queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsieve.llm import bpe, mixing, substring, suffix
from postsieve.llm.base import table
from postsieve.llm.cells import near_vectors
from postsieve.llm.chat import stream_digests
from postsieve.llm.negatives import hard_negatives
from postsieve.llm.resampling import resample
from postsieve.llm.sharding import shard_documents
from postsieve.llm.simhash import hex_digits, near_duplicates
from postsieve.llm.sketch import edited_by_neighbour
from postsieve.llm.top_k import top_k
from postsieve.llm.toxicity import with_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its check."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer_path() -> str:
    """The tokenizer file of the contract."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op1_mixing_sources")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document for source weights 5, 2, 1 in turn."""
    out, _ = mixing.mix_words(table(spark, sf_dir, "documents", "doc_id", "text", "source"), weights=(5, 2, 1))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op2_bpe_encoding_and_decoding")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of the text they decode to."""
    return bpe.digests(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())


@query("op3_simhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query("op4_chat_formatting", r"""
    with rows as (
        select conv_id, turn, role, coalesce(text, '') as text from conversations
        union all select -7, 0, 'user', '\### Assistant: </turn> ok'
        union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ),
    sized as (
        select *, row_number() over (partition by conv_id order by turn, role, text) as n,
            lag(role, 1, '') over (partition by conv_id order by turn, role, text) as before,
            length(replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t')) as body
        from rows
    )
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
        coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
        sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
        sum(length(role) + body + 6 + 8)::bigint as formatted_chars,
        bool_and(before || '>' || role in
            ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user'))
            and max_by(role, n) = 'assistant' as valid
    from sized group by conv_id
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that tries to break out of its turns."""
    chats = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    return stream_digests(chats.unionByName(tricky))


@query("op5_substring_dedup", r"""
    with d as materialized (
        select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w from documents
    ),
    words as materialized (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from d),
    places as (
        select doc_id, p, word, sum(strlen(word) + 1) over (partition by doc_id order by p) as stop from words
    ),
    ranges as materialized (
        select doc_id, p as i, (stop - strlen(word))::bigint as a,
            lead(stop, 19) over (partition by doc_id order by p)::bigint - 1 as b
        from places
    ),
    joined as materialized (select doc_id, encode(array_to_string(w, ' ')) as x from d),
    windows as materialized (
        select doc_id, i, hash(array_slice(x, a, b)) as h from ranges join joined using (doc_id) where b is not null
    ),
    firsts as (select h, min((doc_id, i)) as first from windows group by h having count(*) > 1),
    late as (select doc_id, i from windows join firsts using (h) where (doc_id, i) <> first),
    marked as (
        select words.doc_id, p, word, max(late.i is not null) over (
            partition by words.doc_id order by p rows between 19 preceding and current row) as gone
        from words left join late on late.doc_id = words.doc_id and late.i = p
    ),
    kept as (
        select doc_id, count(*) filter (gone) as n_removed,
            coalesce(string_agg(word, ' ' order by p) filter (not gone), '') as kept
        from marked group by doc_id
    )
    select d.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
        sha256(coalesce(kept, '')) as kept_sha256
    from d left join kept using (doc_id)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document without windows that occur earlier."""
    return substring.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op6_document_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited copy, and their likeness."""
    return edited_by_neighbour(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op7_suffix_array_dedup", """
    with d as materialized (
        select doc_id, octet_length(encode(coalesce(text, ''))) as n, encode(coalesce(text, '')) as x from documents
    ),
    windows as materialized (
        select doc_id, i, hash(array_slice(x, i, i + 399)) as h from d, unnest(range(1, n - 398)) t(i)
    ),
    repeated as (select h from windows group by h having count(*) > 1),
    again as (select doc_id, i from windows join repeated using (h)),
    covered as (
        select doc_id, i, least(i + 399, n) as last,
            max(i + 399) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding) as before
        from again join d using (doc_id)
    ),
    starts as (
        select doc_id, i, last, sum((before is null or i > before + 1)::int) over (partition by doc_id order by i) as run
        from covered
    ),
    spans as (select doc_id, run, min(i) as a, max(last) as b from starts group by doc_id, run),
    gaps as (
        select doc_id, b + 1 as a, lead(a) over (partition by doc_id order by a) as next from spans
        union all select doc_id, 1, min(a) from spans group by doc_id
    ),
    kept as (
        select doc_id, string_agg(hex(array_slice(x, a, coalesce(next, n + 1) - 1)), '' order by a) as y
        from gaps join d using (doc_id) group by doc_id
    ),
    counts as (select doc_id, sum(b - a + 1) as removed, count(*) as spans from spans group by doc_id)
    select doc_id, n::bigint as n_bytes, coalesce(removed, 0)::bigint as n_removed, coalesce(spans, 0)::bigint as n_spans,
        sha256(case when removed is null then x else unhex(coalesce(y, '')) end) as kept_sha256
    from d left join counts using (doc_id) left join kept using (doc_id)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document without runs of 400 that occur anywhere else."""
    return suffix.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op8_exact_top_k", """
    with ints as (
        select vec_id, row_number() over () as r,
            list_transform(embedding, lambda x: floor(64 * x::double)) as v
        from embeddings
        where embedding is not null and not list_has_any(
            list_transform(embedding, lambda x: x is null or not isfinite(x)), [true])
    ),
    scored as (
        select q.vec_id as query_id, c.vec_id, q.r,
            list_dot_product(q.v, c.v)::bigint as score
        from ints q join ints c on q.r <> c.r
        where q.vec_id % 20 = 0
    ),
    ranked as (
        select *, row_number() over (partition by r order by score desc, vec_id) as rank from scored
    )
    select query_id, rank::int as rank, vec_id, score from ranked where rank <= 20
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best partners of every twentieth vector."""
    return top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), k=20, divisor=20)


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = with_toxicity(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return found.select("doc_id", "held_out", "score", "predicted")


@query("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    placed, _ = shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"), n_shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "next_shard",
    )


@query("op11_hard_negatives", """
    with ints as materialized (
        select row_number() over () as r, vec_id,
            case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * x::double)) as v
        from embeddings
        where label is not null and embedding is not null and not list_has_any(
            list_transform(embedding, lambda x: x is null or not isfinite(x)), [true])
    ),
    scored as materialized (
        select a.r, a.vec_id as anchor_id, c.vec_id, c.r as c, a.label = c.label as same,
            list_dot_product(a.v, c.v)::bigint as score
        from ints a join ints c on a.r <> c.r
        where a.vec_id % 100 = 0
    ),
    positives as (
        select * from scored where same
        qualify row_number() over (partition by r order by score desc, vec_id) <= 5
    )
    select p.anchor_id, p.vec_id as positive_id,
        row_number() over (partition by p.r, p.c order by n.score desc, n.vec_id)::int as rank,
        n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
    from positives p join scored n on p.r = n.r and not n.same
        and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
    qualify rank <= 10
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, some labels shifted by one."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(rows.withColumn("label", shifted), divisor=100)


@query("op12_embedding_near_dedup", """
    with recursive rows as materialized (
        select row_number() over () as r, vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
    ),
    usable as materialized (
        select * from rows where v is not null and list_has_any(list_transform(v, lambda x: x <> 0), [true])
            and not list_has_any(list_transform(v, lambda x: x is null or not isfinite(x)), [true])
    ),
    links as materialized (
        select a.r as a, b.r as b from usable a join usable b on a.r <> b.r
        where list_cosine_similarity(a.v, b.v) >= 0.9
    ),
    reached(r, t) as (select r, r from rows union select reached.r, b from reached join links on t = a),
    groups as (
        select reached.r, min(rows.vec_id) as component_id from reached join rows on rows.r = t group by reached.r
    )
    select vec_id, count(links.b) as n_links, component_id, vec_id = component_id as kept
    from rows join groups using (r) left join links on links.a = rows.r
    group by rows.r, vec_id, component_id
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors with cosines of 0.9 or more."""
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), least=0.9)


@query("op13_target_resampling", r"""
    with recursive bytes as (select unnest(range(256)) as i),
    crc as materialized (
        select list(list_reduce(list_concat([i::bigint], range(8)), lambda c, x:
            case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t from bytes
    ),
    words as materialized (
        select 'd' as side, doc_id as id, rowid as r, unnest(regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w
        from (select *, row_number() over () as rowid from documents)
        union all
        select 'b', null, null, unnest(regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))
        from benchmark
    ),
    places as materialized (
        select w, xor(list_reduce(list_concat([4294967295::bigint],
            list_transform(range(1, octet_length(encode(w)) + 1),
                lambda k: ('0x' || substr(hex(encode(w)), 2 * k - 1, 2))::bigint)),
            lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) % 10000 as bucket
        from (select distinct w from words), crc
    ),
    counts as (
        select bucket, count(*) filter (side = 'd') as s, count(*) filter (side = 'b') as t
        from words join places using (w) group by bucket
    ),
    gains as materialized (
        select bucket, floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)
            / ((s + 1)::double * (sum(t) over () + 10000))))::bigint as gain
        from counts
    ),
    weights as (
        select r, count(*) as n, sum(gain)::bigint as weight
        from words join places using (w) join gains using (bucket) where side = 'd' group by r
    ),
    scores as (
        select doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
            (coalesce(weight, 0) + floor(-1000 * ln(-ln(
                (('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint + 0.5::double) / 4294967296))))::bigint as score
        from (select *, row_number() over () as r from documents) left join weights using (r)
    ),
    ranked as (
        select *, n_features >= 20 as fit, row_number() over (
            partition by n_features >= 20 order by score desc, doc_id) as place, count(*) over (partition by n_features >= 20) as n
        from scores
    )
    select doc_id, n_features, weight, score,
        case when fit and place <= 10 * n // 100 then place end as rank
    from ranked
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the word statistics of the benchmark."""
    return resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"),
                    share=0.1, min_words=20, max_run=1, buckets=10_000, seed=2024)
