"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.llm import codes, darts, html_text, long_matches, mixing, multi_index, patience, phrases, quality, secrets, templates, token_files, toxicity
from segmill.llm.common import bounded_batches, held_out, unpack
from segmill.operators.staging import owned, staging_path
from segmill.sources import read_table


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per license text or notice found in a document."""
    return patience.scan_licenses(_read(spark, sf_dir, "documents"), keep=["doc_id"])


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "n_random"
    )


@owned
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: the smallest id of its class, and the class's size. An empty text is a class of its own."""
    classed = darts.near_duplicates(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    sizes = classed.where("class_key is not null").groupBy("class_key").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")
    )
    return classed.join(sizes, "class_key", "left").select(
        "doc_id",
        F.when(F.col("class_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
    )


@owned
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    rows, leaks = templates.find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    results = ["item_id", "n_windows", "item_windows", "coverage", "n_slots", "n_changed"]
    return unpack(rows.join(leaks, "row_no"), *results)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    pages = _read(spark, sf_dir, "pages")
    text = pages.select("page_id", "url", html_text.extract(F.col("html")).alias("text"))
    return text.withColumn("n_chars", F.char_length("text").cast("long"))


def _scored(docs: DataFrame, score, threshold: float) -> DataFrame:
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    forest = quality.fit(docs, _read(spark, sf_dir, "labels"))
    return _scored(docs, quality.score(F.col("text"), forest), quality.THRESHOLD)


def op7_long_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = long_matches.remove_repeats(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@owned
def op9_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return multi_index.nearest(vectors, vectors["vec_id"] % 50 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    weights = toxicity.fit(docs, _read(spark, sf_dir, "labels"))
    return _scored(docs, toxicity.score(F.col("text"), weights), toxicity.THRESHOLD)


def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = staging_path(spark, "token-files")
    token_files.write_tokens(_read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, path, ids=False)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codes.compress(_read(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.best(phrases.mine(_read(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = [
        op1_licenses, op2_secrets, op3_near_duplicates, op4_decontamination, op5_html_text, op6_quality, op7_long_matches,
        op8_mixing, op9_nearest_vectors, op10_toxicity, op11_token_ids, op12_vector_codes, op13_collocations, pipeline,
    ]
    return {query.__name__: query for query in registered}


def _vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The rounds one by one, in integers throughout."""
    square = "list_sum(list_transform(generate_series(1, len(r.x)), lambda i: (r.x[i] - b.x[i]) * (r.x[i] - b.x[i])))"

    def assigned(n: int) -> str:
        return f"""
            a{n} as materialized (
                select vec_id, p, any_value(label) as label, arg_min(e, {entries} * d + e) as e, min(d) as d
                from (select r.vec_id, r.label, r.p, b.e, {square}::hugeint as d from r join b{n} b on r.p = b.p)
                group by vec_id, p)"""

    steps = "".join(
        f"""{assigned(n)},
            s{n} as (
                select p, e, i, sum(x[i])::hugeint as s, count(*) as c
                from a{n} join r using (vec_id, p), generate_series(1, len(x)) as t(i) group by p, e, i),
            u{n} as (select p, e, list(((s - (s % c + c) % c) // c)::bigint order by i) as x from s{n} group by p, e),
            b{n + 1} as materialized (select b.p, b.e, coalesce(u.x, b.x) as x from b{n} b left join u{n} u on b.p = u.p and b.e = u.e),"""
        for n in range(rounds)
    )
    return f"""
        with kept as materialized (
            select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as v from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        r as materialized (
            select vec_id, label, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] as x from kept, range({parts}) as t(p)),
        f as (select vec_id, row_number() over (order by vec_id) - 1 as e from kept qualify e < {entries}),
        b0 as materialized (select p, e, x from r join f using (vec_id)),{steps}{assigned(rounds)},
        books as (select sha256(string_agg(array_to_string(x, ','), ',' order by p, e)) as h from b{rounds}),
        rows as (
            select vec_id, any_value(label) as label, string_agg(printf('%02x', e), '' order by p) as code, sum(d)::bigint as error
            from a{rounds} group by vec_id)
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, h as codebooks_sha256 from rows, books"""


#: Phrases as lists of words, counted whole; a phrase of which a longer one holds all cases is dropped.
_COLLOCATIONS_SQL = r"""
    with docs as (
        select row_number() over () as d, coalesce(lang, 'und') as lang,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
    pieces as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as p from docs),
    lists as materialized (
        select lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda w: w <> '') as w from pieces),
    f as materialized (
        select lang, k, array_to_string(w[i : i + k - 1], ' ') as ph, count(*) as a
        from (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from lists, generate_series(1, 5) as t(k))
        group by all having k = 1 or a >= 100),
    total as (select lang, sum(a)::bigint as n from f where k = 1 group by lang),
    candidates as materialized (select lang, k, ph, a, string_split(ph, ' ') as w from f where k > 1),
    halves as materialized (
        select lang, ph, k, a, cut, array_to_string(w[1 : cut], ' ') as lp, array_to_string(w[cut + 1 :], ' ') as rp
        from candidates, generate_series(1, 4) as t(cut) where cut < k),
    with_l as materialized (select h.*, f.a as l from halves h join f on f.lang = h.lang and f.ph = h.lp),
    cuts as materialized (
        select h.lang, h.ph, h.a, cut, l, f.a as r, n, (1000::hugeint * h.a * n) // (l::hugeint * f.a) as score
        from with_l h join f on f.lang = h.lang and f.ph = h.rp join total on total.lang = h.lang),
    chosen as (select * from cuts qualify row_number() over (partition by lang, ph order by score, cut) = 1),
    inside as materialized (
        select lang, array_to_string(w[i : i + m - 1], ' ') as ph, max(a) as longer
        from candidates, generate_series(2, 4) as t(m), generate_series(1, 4) as u(i)
        where m < k and i + m - 1 <= k group by all),
    ranked as (
        select c.lang, row_number() over (partition by c.lang order by score desc, a desc, c.ph) as rank, c.ph as phrase, a, l, r, n, score
        from chosen c left join inside i on c.lang = i.lang and c.ph = i.ph where i.longer is null or 100 * i.longer < 100 * a)
    select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score from ranked where rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {"op12_vector_codes": _vector_codes_sql(), "op13_collocations": _COLLOCATIONS_SQL}
