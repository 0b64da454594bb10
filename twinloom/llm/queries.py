"""One registered query for each operator, over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from twinloom.llm import (
    clusters, exact_dedup, html_text, language, line_dedup, manifest, mixing, near_dedup, pieces, pii, token_counts, topk, toxicity,
)
from twinloom.session import materialize

#: Public vocabulary files, read on the driver.
VOCABULARIES = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
PIECE_MODEL = f"{VOCABULARIES}/piece_bpe_32k.model"
RANKS = f"{VOCABULARIES}/byte_bpe_50k.tiktoken"
#: The pattern that belongs to the rank file. Fixed value.
RANKS_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
#: Shares of all words that the mixture is to have.
DOMAIN_WEIGHTS = {"good": 0.90, "poor": 0.07, "toxic": 0.03}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    """A fifth of the documents, which nothing is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def domains_of(labels: DataFrame) -> DataFrame:
    """``doc_id, domain``: toxic, else good or poor."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain"))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles, as the query's contract asks; the operator takes five by itself."""
    return near_dedup.near_duplicates(
        table(spark, sf_dir, "documents"), near_dedup.NearConfig(width=2)
    )


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents that give the domains of ``labels`` their weights."""
    _, rated, _ = mixing.domain_rates(
        table(spark, sf_dir, "documents"), domains_of(table(spark, sf_dir, "labels")), DOMAIN_WEIGHTS
    )
    shares = [F.col("_posterior")[k].alias(f"p_{d}") for k, d in enumerate(DOMAIN_WEIGHTS)]
    return rated.select("doc_id", "tokens", *shares, "rate")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sample = toxicity.labelled_sample(docs.filter(~held_out()), table(spark, sf_dir, "labels"))
    model = toxicity.learn_toxicity(sample)
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.toxicity_of(F.col("text"), model).alias("t"))
    return scored.select(
        "doc_id", "held_out", F.col("t.score").alias("score"),
        (F.col("t.score") >= 0.5).cast("int").alias("predicted"), F.col("t.matched").alias("matched"),
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = language.learn_dictionaries(docs.filter(~held_out()).select("text", "lang"))
    found = docs.select("doc_id", held_out().alias("held_out"), language.language_of(F.col("text"), learned).alias("l"))
    return found.select(
        "doc_id", "held_out", F.col("l.lang").alias("lang_pred"), F.col("l.score").alias("score"),
        F.col("l.margin").alias("margin"), F.col("l.rejected").alias("rejected"),
    )


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it."""
    model = pieces.read_model(PIECE_MODEL)
    return pieces.encode_documents(table(spark, sf_dir, "documents"), model, ["doc_id"], check=True)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.with_main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def edits_of(doc_id: Column, text: Column) -> Column:
    """Three edits for each document, drawn from its own text: a word replaced, a copy of a passage put
    in, and the text's middle character removed."""
    size = F.length(F.coalesce(text, F.lit("")))
    at = F.pmod(F.xxhash64(doc_id), F.greatest(size, F.lit(1)))

    def edit(start: Column, end: Column, new: Column) -> Column:
        return F.struct(
            start.cast("int").alias("start"), end.cast("int").alias("end"), new.cast("string").alias("text")
        )

    return F.array(
        edit(at, at + 5, F.concat(F.lit(" edited "), doc_id.cast("string"))),
        edit(F.lit(0), F.lit(0), F.substring(text, (at + 1).cast("int"), F.lit(40))),
        edit(size / 2, size / 2 + 1, F.lit("")),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after its edits, which are applied to trees kept as a table."""
    model = token_counts.read_ranks(RANKS, RANKS_PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = materialize(docs.withColumn("tree", token_counts.count_trees(F.col("text"), model)), "token-trees")
    edits = edits_of(F.col("doc_id"), F.col("text"))
    edited = kept.withColumn("edited", token_counts.edited_counts(F.col("text"), F.col("tree"), edits, model))
    return edited.select(
        "doc_id", token_counts.tokens_of(F.col("tree")).alias("n_before"), F.col("edited.tokens").alias("n_after"),
        F.col("tree.size").cast("long").alias("n_pieces"), F.col("edited.counted").alias("n_counted"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pii.spans_of(F.col("text"), pii.learn_pii(docs)).alias("p"))

    def count(kind: str) -> Column:
        return F.size(F.filter("p.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, pii.KINDS), F.sha2(pii.spelled(F.col("p.base")), 256).alias("base_sha256"),
        pii.spelled(F.col("p.spans")).alias("spans"),
    )


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.clusters(table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; a fifth of them are tampered with by lower-casing their texts."""
    return manifest.manifest(table(spark, sf_dir, "documents"), held_out())


QUERIES = {
    f.__name__: f for f in (
        op1_exact_dedup, op2_near_dedup, op3_top_k, op4_mixing, op5_toxicity, op6_language, op7_pieces,
        op8_html_text, op9_token_counts, op10_pii, op11_clusters, op12_line_dedup, op13_manifest,
    )
}

def clusters_sql(rounds: int = 10) -> str:
    """Vectors assigned, and centroids moved, once a round."""
    parts = ["""
        kept as materialized (
            select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
            from embeddings
            where embedding is not null and len(embedding) = 64
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        )""", """
        c0 as materialized (
            select cast(row_number() over (order by h) - 1 as integer) as cluster, v
            from (select sha256('3:' || vec_id) as h, v from kept order by h limit 8)
        )"""]
    for k in range(rounds + 1):
        parts.append(f"""
        a{k} as materialized (
            select vec_id, v, arg_min(cluster, d * 8 + cluster) as cluster, min(d) as distance
            from (
                select k.vec_id, k.v, c.cluster, cast(list_sum(list_transform(
                    list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])
                )) as bigint) as d from kept k, c{k} c
            ) group by vec_id, v
        )""")
        if k < rounds:
            parts.append(f"""
        c{k + 1} as materialized (
            select c.cluster, coalesce(m.v, c.v) as v from c{k} c left join (
                select cluster, list(mean order by pos) as v from (
                    select cluster, pos, cast((s - (((s % n) + n) % n)) // n as bigint) as mean from (
                        select cluster, pos, cast(sum(x) as bigint) as s, count(*) as n from (
                            select cluster, unnest(v) as x, unnest(range(64)) as pos from a{k}
                        ) group by cluster, pos
                    )
                ) group by cluster
            ) m using (cluster)
        )""")
    return f"""
        with {",".join(parts)}
        select a.vec_id, a.cluster, a.distance,
               cast(sum(a.distance) over (partition by a.cluster) as bigint) as cluster_inertia,
               cast(sum(a.distance) over () as bigint) as inertia,
               sha256(list_aggregate(c.v, 'string_agg', ',')) as centroid_sha256
        from a{rounds} a join c{rounds} c using (cluster)
    """


def manifest_sql(depth: int = 6, top: int = 4) -> str:
    """Trees of up to 16 ** ``depth`` documents a source and 16 ** ``top`` sources, level by level."""
    crc = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(
            string_split(cast(doc_id as varchar), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]
        ))), lambda a, x: case when x >= 0 then xor(a, x)
             else xor(a // 2, case when a % 2 = 1 then 3988292384 else 0 end) end), 4294967295)"""

    def leaf(text: str) -> str:
        fields = ("cast(doc_id as varchar)", "source", "lang", "cast(n_chars as varchar)", text)
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [f"""
        docs as materialized (
            select *, row_number() over (partition by source order by doc_id) - 1 as pos,
                   case when {crc} % 5 = 0 then tampered else leaf end as start
            from (select doc_id, source, {leaf('text')} as leaf, {leaf(lowered)} as tampered from documents)
        ), s0 as materialized (
            select source as tree, pos as idx, leaf as h, count(*) over (partition by source) as n from docs
        )"""]

    def levels(name: str, count: int) -> None:
        beside = "over (partition by tree, idx // 16 order by idx rows between"
        for k in range(count):
            parts.append(f"""
        {name}w{k} as materialized (
            select tree, idx, n, coalesce(string_agg(h, '') {beside} unbounded preceding and 1 preceding), '') as b,
                   coalesce(string_agg(h, '') {beside} 1 following and unbounded following), '') as a from {name}{k}
        ), {name}{k + 1} as materialized (
            select tree, idx // 16 as idx, (n + 15) // 16 as n,
                   case when n > 1 then sha256(string_agg(h, '' order by idx)) else min(h) end as h
            from {name}{k} group by tree, idx // 16, n
        )""")

    levels("s", depth)
    parts.append(f"""
        t0 as materialized (
            select 0 as tree, tree as source, row_number() over (order by tree nulls first) - 1 as idx, h, count(*) over () as n
            from s{depth}
        )""")
    levels("t", top)
    steps = [("s", k) for k in range(depth)] + [("t", k) for k in range(top)]
    joins = "".join(
        f" join sw{k} on sw{k}.tree is not distinct from d.source and sw{k}.idx = d.pos // {16 ** k}" for k in range(depth)
    ) + " join t0 on t0.source is not distinct from d.source" + "".join(
        f" join tw{k} on tw{k}.idx = t0.idx // {16 ** k}" for k in range(top)
    )
    sides = ", ".join(f"{s}w{k}.b as b{s}{k}, {s}w{k}.a as a{s}{k}, {s}w{k}.n as n{s}{k}" for s, k in steps)
    parts.append(f"""
        f0 as (select d.doc_id, d.leaf, t0.h as subroot, d.start as f, {sides} from docs d{joins})""")
    for at, (s, k) in enumerate(steps):
        parts.append(f"""
        f{at + 1} as (select * replace (case when n{s}{k} > 1 then sha256(b{s}{k} || f || a{s}{k}) else f end as f) from f{at})""")
    proof = " || ".join(f"b{s}{k} || a{s}{k}" for s, k in steps)
    return f"""
        with {",".join(parts)}
        select doc_id, leaf, subroot, t{top}.h as root, sha256({proof}) as proof_sha256, f as folded_root, f = t{top}.h as verified
        from f{len(steps)}, t{top}
    """


ORACLES = {
    "op13_manifest": manifest_sql(),
    "op11_clusters": clusters_sql(),
    "op1_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
        from documents window same as (partition by coalesce(text, ''))
    """,
    "op3_top_k": """
        with rows as (
            select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
            from embeddings
            where embedding is not null and vec_id is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id,
                   cast(list_inner_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
            from rows q join rows c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v)
        ), ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
        )
        select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
    """,
    "op12_line_dedup": """
        with cut as (
            select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents
        ), placed as (
            select doc_id, unnest(lines) as line, unnest(range(len(lines))) as pos from cut
        ), keyed as (
            select *, translate(
                trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
            ) as line_key from placed
        ), repeated as (
            select line_key, min(doc_id) as keep_id from keyed where length(line_key) >= 10
            group by line_key having count(distinct doc_id) >= 2
        ), marked as (
            select k.*, coalesce(k.doc_id <> r.keep_id, false) as gone
            from keyed k left join repeated r on k.line_key = r.line_key
        )
        select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
        from marked group by doc_id
    """,
}
