"""One query for each operator of this subpackage, over its whole table, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .base import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def piece_model() -> str:
    """The vocabulary file the piece queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import digests

    return digests(table(spark, sf_dir, "documents"), piece_model())


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .chat import format_chats, read_back

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    return read_back(format_chats(rows.unionByName(hard)))


ORACLES["op10_chat"] = """
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), told as (
        select *,
            regexp_matches(text, '(<|\\[)(/?s>|(INST|OUT|SYS|ROLE:[0-9A-F]*)!?\\]|/(INST|OUT|SYS|ROLE)\\])') as hard,
            case role when 'user' then 'INST' when 'assistant' then 'OUT' when 'system' then 'SYS' else 'ROLE:' || hex(encode(role)) end as tag
        from turns
    ), sized as (
        select *, length(tag) + length(split_part(tag, ':', 1)) + 14
            + case when hard then 1 + length(text) + length(text) - length(replace(text, '\\', ''))
                + len(regexp_extract_all(text, '(<|\\[)(/?s>|(INST|OUT|SYS|ROLE:[0-9A-F]*)!?\\]|/(INST|OUT|SYS|ROLE)\\])'))
              else length(text) end as chars
        from told
    )
    select conv_id, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
        coalesce(length(string_agg(text, '' order by turn, role, text) filter (role = 'assistant')), 0) as loss_chars,
        sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
        sum(chars)::bigint as formatted_chars
    from sized group by conv_id
"""


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import build_archive, read_archive

    records = read_archive(build_archive(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op1_warc"] = """
    with hashed as (select page_id, coalesce(html, '') as html from pages),
    held as (select *, max(page_id) over (partition by html) as holder, strlen(html) as payload_bytes from hashed)
    select page_id, payload_bytes, sha1(html) as payload_digest,
        case when payload_bytes < 1000 or page_id = holder then 'response' else 'revisit' end as record_type,
        case when payload_bytes < 1000 or page_id = holder then null else holder end as refers_to
    from held
"""


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .simhash import classes

    found = classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .sketches import as_text, fingerprints, likeness

    return fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        as_text(F.col("cells")).alias("fingerprint"),
        as_text(F.col("edited_cells")).alias("edited_fingerprint"),
        likeness(F.col("keys"), F.col("edited_keys"), F.col("from_edited")).alias("near_edited"),
        likeness(F.col("keys"), F.col("next_keys"), F.col("from_next")).alias("near_next"),
    )


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import held_out, identify, train

    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(rows, train(docs)).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .wrappers import extract

    return extract(table(spark, sf_dir, "pages"))


@query
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm import held_out, score

    return score(table(spark, sf_dir, "documents"), held_out())


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import grade, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return grade(docs, train(docs)).select("doc_id", "quality", "weak_quality", "keep")


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .leaks import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .negatives import mine

    label = "case when vec_id % 7 = 0 then (label + 1) % 10 else label end"
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=label)


_INTEGERS = """
    ints as (
        select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * x::double) as bigint)) as v
        from embeddings where embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    )"""

ORACLES["op12_negatives"] = f"""
    with {_INTEGERS}, named as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, v from ints where label is not null
    ), pairs as (
        select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
            cast(list_inner_product(a.v::double[], b.v::double[]) as bigint) as score
        from named a join named b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
    ), positives as (
        select * from pairs where same qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
    )
    select p.anchor_id, p.other as positive_id,
        cast(row_number() over (partition by p.anchor_id, p.other order by n.score desc, n.other) as integer) as rank,
        n.other as negative_id, p.score as positive_score, n.score as negative_score
    from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
        and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
    qualify rank <= 3
"""


@query
def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .codes import compress

    return compress(table(spark, sf_dir, "embeddings"))


def _codes_sql() -> str:
    steps = [f"""with {_INTEGERS}, sized as (select *, (select max(len(v)) from ints) // 16 as step from ints),
    parts as (select vec_id, p, step, list_slice(v, p * step + 1, (p + 1) * step) as x from sized, range(16) r(p)),
    seeds as (select vec_id, row_number() over (order by vec_id) - 1 as e from ints qualify e < 64),
    book0 as (select p, e, x as y from parts join seeds using (vec_id))"""]
    for r in range(3):
        steps.append(f"""near{r} as (
        select vec_id, p, any_value(x) as x, any_value(step) as step, min(struct_pack(d := d, e := e)) as best
        from (select vec_id, p, x, step, e, list_sum(list_transform(range(1, step + 1), lambda k: (x[k] - y[k]) * (x[k] - y[k])))::bigint as d
            from parts join book{r} using (p)) group by vec_id, p)""")
        if r < 2:
            steps.append(f"""moved{r} as (
        select p, e, list(c order by k) as y from (
            select p, best.e as e, k, cast(floor(sum(x[k]) / count(*)) as bigint) as c from near{r}, unnest(range(1, step + 1)) u(k) group by all
        ) group by p, e),
    book{r + 1} as (select b.p, b.e, coalesce(m.y, b.y) as y from book{r} b left join moved{r} m using (p, e))""")
    return ",\n    ".join(steps) + """,
    coded as (select vec_id, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' order by p) as code, sum(best.d)::bigint as error from near2 group by vec_id)
    select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
        (select sha256(string_agg(array_to_string(y, ','), ',' order by p, e)) from book2) as codebooks_sha256
    from coded join ints using (vec_id)
"""


ORACLES["op13_codes"] = _codes_sql()


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import grade, held_out, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return grade(docs.withColumn("held_out", held_out()), model).select("doc_id", "held_out", "score", "predicted")
