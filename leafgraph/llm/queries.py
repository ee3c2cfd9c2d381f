"""The registered query of each operator, with its SQL equivalent where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafgraph.llm import (
    embedding_dedup,
    exact_dedup,
    language_id,
    license_scan,
    line_dedup,
    minhash_dedup,
    mixing,
    piece_codec,
    token_rollup,
    toxicity,
)
from leafgraph.llm.store import arrow_batches, stage, staged_path, table

_UPPER, _LOWER = license_scan.UPPER, license_scan.LOWER
#: ASCII white space as DuckDB (RE2) writes it.
_SPACE = r"[\x20\x09-\x0D]"


def _fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; an id that is null counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(_fold(F.col("doc_id"), 5) != 0)
    model = toxicity.train(docs, labels)
    arrow_batches(spark)
    scored = docs.select("doc_id", toxicity.score_column(model)(F.col("text")).alias("score"))
    return scored.select(
        "doc_id", (_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def _op2_sql() -> str:
    phrases = [(p, label, True) for p, label in license_scan.BASE] + [(p, label, False) for p, label in license_scan.MORE]
    values = ", ".join(f"({n}, '{p}', '{label}', {base})" for n, (p, label, base) in enumerate(phrases))
    k, near, least = license_scan.K, license_scan.NEAR, license_scan.LEAST
    run = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return rf"""
    with phrases(template, phrase, label, is_base) as (values {values}),
    t0 as (select template, label, is_base, string_split(phrase, ' ') as w from phrases),
    t1 as (select *, unnest(range(1, len(w) - {k} + 2)) as i from t0),
    t as (select template, label, is_base, len(w) - {k} + 1 as runs, i - 1 as t, {run} as run from t1),
    d0 as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
    d1 as (select doc_id, w, unnest(range(1, len(w) - {k} + 2)) as i from d0),
    d as (select doc_id, i - 1 as pos, {run} as run from d1),
    hits as (select distinct doc_id, template, label, is_base, runs, pos - t.t as diagonal, t.t from d join t using (run)),
    diagonal as (select doc_id, template, label, is_base, runs, diagonal, list(t) as votes from hits group by all),
    begins as (select *, case when diagonal - lag(diagonal) over p <= {near} then 0 else 1 end as begins from diagonal
               window p as (partition by doc_id, template order by diagonal)),
    places as (select *, sum(begins) over (partition by doc_id, template order by diagonal) as place from begins),
    merged as (select doc_id, template, label, is_base, place,
                      len(list_distinct(flatten(list(votes)))) / max(runs) as coverage,
                      list(diagonal) filter (len(votes) = runs) as verbatim
               from places group by all),
    found as (select doc_id, coalesce(flatten(list(verbatim) filter (is_base and verbatim is not null)), []) as starts,
                     list_sort(list_distinct(list(label) filter (is_base and verbatim is not null))) as base,
                     list_sort(list_distinct(list(label) filter (case when is_base then verbatim is not null
                                                                      else coverage >= {least} end))) as every,
                     max(coverage) as best
              from merged group by doc_id)
    select d0.doc_id, len(w)::bigint as n_words, coalesce(len(starts), 0)::bigint as n_base,
           list_min(starts)::bigint as first_word, list_max(starts)::bigint as last_word,
           coalesce(array_to_string(base, ','), '') as base_labels, coalesce(array_to_string(every, ','), '') as labels,
           coalesce(best, 0.0)::double as score
    from d0 left join found using (doc_id)"""


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.vector_groups(table(spark, sf_dir, "embeddings"))


_OP3_SQL = """
    with recursive
    v as (select vec_id, embedding::double[] as e from embeddings),
    links as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id
              where list_dot_product(a.e, b.e) >= 0.95 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))),
    reach(vec_id, other) as (select vec_id, vec_id from v union
                             select r.vec_id, l.b from reach r join links l on r.other = l.a),
    n as (select a as vec_id, count(*) as n from links group by a)
    select r.vec_id, coalesce(max(n.n), 0)::bigint as n_links, min(r.other) as component_id, min(r.other) = r.vec_id as kept
    from reach r left join n using (vec_id) group by r.vec_id"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = line_dedup.apply_keep_bitmaps(docs, line_dedup.line_keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


_OP4_SQL = rf"""
    with l0 as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    l as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i from l0),
    k as (select *, translate(regexp_replace(line, '^{_SPACE}+|{_SPACE}+$', '', 'g'), '{_UPPER}', '{_LOWER}') as key from l),
    common as (select key, max(doc_id) as largest from k where length(key) >= {line_dedup.MIN_CHARS} group by key
               having count(distinct doc_id) >= {line_dedup.MIN_DOCS}),
    marked as (select k.doc_id, i, line, common.key is not null and k.doc_id <> largest as gone
               from k left join common using (key))
    select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
    from marked group by doc_id"""


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(_fold(F.col("doc_id"), 3) != 1))
    labelled = language_id.label_languages(docs, model)
    language, share = language_id.main_language(F.col("spans"))
    return labelled.select("doc_id", (_fold(F.col("doc_id"), 3) == 1).alias("held_out"), language.alias("lang_pred"), share.alias("score"))


def op6_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's pieces, and whether decoding them gives back its text."""
    encoded = piece_codec.round_trip(table(spark, sf_dir, "documents"))
    return encoded.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", "lossless")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicate_groups(table(spark, sf_dir, "documents"), percent=85)


_OP7_SQL = rf"""
    with recursive
    w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') as w
          from documents),
    s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
          from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from w where len(w) > 0)),
    n as (select doc_id, count(*) as n from s group by doc_id),
    pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.s = b.s and a.doc_id < b.doc_id
             group by all),
    links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b
              where 100 * shared >= 85 * (x.n + y.n - shared)),
    edges as (select a, b from links union all select b, a from links),
    reach(doc_id, other) as (select doc_id, doc_id from w union select r.doc_id, e.b from reach r join edges e on r.other = e.a)
    select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, r.component_id, r.component_id = w.doc_id as kept
    from w left join n using (doc_id) join (select doc_id, min(other) as component_id from reach group by doc_id) r using (doc_id)"""


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


_OP8_SQL = rf"""
    with t as (select doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}+', ' ', 'g') as t from documents),
    g as (select t, min(doc_id) as keep_id, count(*) as group_size from t group by t)
    select doc_id, keep_id, group_size::bigint as group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
    from t join g using (t)"""


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    taken = F.col("size") * F.col("copies")
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


_OP9_SQL = rf"""
    with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
               from documents),
    s as (select source, sum(size)::bigint as source_size from d group by source),
    r as (select *, [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight,
                 source_size * 2.0::double as cap from s),
    o as (select *, coalesce(sum(cap) over before, 0.0) as taken, sum(weight) over rest as open, sum(source_size) over () as total
          from r window before as (order by cap / weight, source rows between unbounded preceding and 1 preceding),
                        rest as (order by cap / weight, source rows between current row and unbounded following)),
    level as (select max((1.5::double * total - taken) / open) filter ((1.5::double * total - taken) / open <= cap / weight) as level
              from o),
    t as (select source, source_size, least(cap, weight * level) as target from r, level),
    x as (select d.*, source_size, target, case when source_size > 0 then target / source_size else 0.0 end as rate,
                 ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint / 4294967296.0::double as draw
          from d join t on d.source is not distinct from t.source)
    select doc_id, size, source_size, target::double as target,
           (size * (floor(rate)::bigint + (draw < rate - floor(rate))::bigint))::bigint as taken from x"""

def op10_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of two tokenizer versions after six commits.

    All documents are inserted with their words, with a provisional token count (a quarter of their bytes) and with a
    version that is given up, their bytes.  Then the provisional counts are revised to the true ones, all rows of the
    version that is given up are deleted, and one batch is committed a second time.
    """
    arrow_batches(spark)
    text = F.col("text")
    n_bytes = F.coalesce(F.octet_length(text), F.lit(0))
    counts = table(spark, sf_dir, "documents").select(
        "source", "lang", mixing.n_words(text).alias("words"), n_bytes.alias("bytes"), F.ceil(n_bytes / 4).alias("guess"),
        token_rollup.count_tokens(text).alias("tokens"),
    )
    counts = stage(counts, "token-counts")
    rollup = token_rollup.Rollup(spark, staged_path(spark, "rollup"))
    provisional = token_rollup.inserts(counts, "byte_bpe_50k", "guess")
    rollup.commit("words", token_rollup.inserts(counts, "words-1", "words"))
    rollup.commit("bytes", token_rollup.inserts(counts, "bytes-0", "bytes"))
    rollup.commit("provisional", provisional)
    rollup.commit("revised", token_rollup.revisions(counts, "byte_bpe_50k", "guess", "tokens"))
    rollup.commit("given-up", token_rollup.deletes(counts, "bytes-0", "bytes"))
    rollup.commit("provisional", provisional)  # again: no effect
    return rollup.totals()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_license_scan": op2_license_scan,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_language_id": op5_language_id,
    "op6_piece_codec": op6_piece_codec,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_source_mixing": op9_source_mixing,
    "op10_token_rollup": op10_token_rollup,
}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": _op2_sql(),
    "op3_embedding_dedup": _OP3_SQL,
    "op4_line_dedup": _OP4_SQL,
    "op7_minhash_dedup": _OP7_SQL,
    "op8_exact_dedup": _OP8_SQL,
    "op9_source_mixing": _OP9_SQL,
}
