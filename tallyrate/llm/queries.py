"""The registered queries of this package, and their SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrate.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    language_id,
    lexical_search,
    line_dedup,
    mixing,
    quality_rules,
    simhash,
    suffix_dedup,
    token_alignment,
    token_counts,
    tokens,
    url_filter,
)
from tallyrate.storage import written_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.fit(table(spark, sf_dir, "documents"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return language_id.identify_pages(pages, model).select(
        "page_id", "declared", "host", "text_language", "language",
        F.round("probability", 6).alias("probability"))


def encoded_digests(docs: DataFrame, path: str) -> DataFrame:
    found = bpe.encode(docs, path)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"), tokens.public_path("word_bpe_49k.json"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count(table(spark, sf_dir, "documents"), tokens.public_path("byte_bpe_50k.json"))
    return token_counts.with_limit(counts, 512)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.near_duplicates(table(spark, sf_dir, "documents"), most=None)


URL_RULES = (
    url_filter.Rule("block", "net/"), url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"), url_filter.Rule("allow", "org/fr/"),
)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = written_table(quality_rules.ledger(table(spark, sf_dir, "documents")), "quality-ledger")
    return quality_rules.verdicts(entries, quality_rules.PROSE).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"), "kept", "failures")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"), tokens.public_path("byte_bpe_50k.json"),
                                 tokens.public_path("piece_bpe_32k.model"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_language_id": op2_language_id,
    "op3_bpe_encode_decode": op3_bpe_encode_decode,
    "op4_token_counts": op4_token_counts,
    "op5_line_dedup": op5_line_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_quality_rules": op11_quality_rules,
    "op12_token_alignment": op12_token_alignment,
    "op13_lexical_search": op13_lexical_search,
}

def _url_sql() -> str:
    def distinct(terms) -> str:
        found = " + ".join(
            f"regexp_matches(address, '(^|[^a-z0-9]){term}($|[^a-z0-9])')::integer" for term in terms)
        return f"({found})"

    cases = "".join(
        f" when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')"
        f" then '{r.target}'"
        for r in sorted(URL_RULES, key=lambda r: (-len(r.host), -len(r.path))))
    verdicts = "".join(f" when rule = '{r.target}' then '{r.verdict}'" for r in URL_RULES)
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
        with parts as (
            select page_id, {lower.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} as host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
        ruled as (
            select *, case{cases} end as rule, {lower.format("host || path")} as address from parts),
        counted as (
            select *, {distinct(url_filter.STRICT)} as strict_terms, {distinct(url_filter.SOFT)} as soft_terms
            from ruled)
        select page_id, host, path, rule, strict_terms, soft_terms,
               case{verdicts} when strict_terms > 0 or soft_terms >= {url_filter.SOFT_LIMIT} then 'block'
                    else 'allow' end as verdict
        from counted"""


def _quality_sql() -> str:
    bits = " + ".join(f"case when {rule.broken} then {1 << i} else 0 end"
                      for i, rule in enumerate(quality_rules.RULES))
    return rf"""
        with cut as (
            select row_number() over () as r, doc_id, coalesce(text, '') as text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
            from documents),
        places as (
            select r, words, unnest(range(1, len(words) - 3)) as p from cut),
        repeated as (
            select r, p from (
                select r, p, count(*) over (partition by r, words[p:p + 4]) as n from places) where n > 1),
        covered as (
            select r, count(distinct place) as n from (
                select r, unnest(range(p, p + 5)) as place from repeated) group by r),
        measured as (
            select doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
                   (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
                   coalesce(n, 0)::bigint as n_repeat_words, len(lines) as n_lines,
                   len(regexp_extract_all(text, '[A-Z]')) as n_capitals,
                   len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*\x{{2022}}]'))) as n_bullets,
                   len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}})[\x20\x09-\x0D]*$'))) as n_ellipses,
                   len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) as n_letter_words
            from cut left join covered using (r)),
        ledger as (select *, ({bits})::bigint as failures from measured)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               failures & {quality_rules.BASE.mask} <> 0 as base_failed,
               failures & {quality_rules.PROSE.mask} = 0 as kept, failures from ledger"""


ORACLES = {
    "op11_quality_rules": _quality_sql(),
    "op13_lexical_search": r"""
        with cut as (
            select doc_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from documents),
        asked as (
            select item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark),
        totals as (select count(distinct doc_id)::bigint as n_docs, count(*)::bigint as n_terms from cut),
        lengths as (
            select doc_id, 25 + (75 * count(*)::bigint * n_docs) // n_terms as m
            from cut, totals group by doc_id, n_docs, n_terms),
        postings as (select doc_id, term, count(*)::bigint as tf from cut group by all),
        weights as (
            select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint as w
            from postings, totals group by term, n_docs),
        questions as (select item_id, term, count(*)::bigint as times from asked group by all),
        scores as (
            select item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
            from questions join weights using (term) join postings using (term) join lengths using (doc_id)
            group by item_id, doc_id),
        ranked as (
            select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::integer as rank,
                   doc_id, score from scores where score > 0)
        select * from ranked where rank <= 10""",
    "op6_url_filter": _url_sql(),
    "op1_mix_sources": r"""
        with sized as (
            select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
                   ('0x' || substr(md5(coalesce(doc_id::varchar, text, '')), 1, 9))::bigint as hash,
                   ('0x' || substr(md5(coalesce(text, '')), 1, 15))::bigint as tie, row_number() over () as place
            from documents),
        sources as (
            select source, sum(size)::bigint as source_size,
                   [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
            from sized group by source),
        levels as (
            select *, ((sum(source_size) over ())
                       - coalesce(sum(3 * source_size) over earlier, 0))::bigint::double
                      / ((sum(weight) over ()) - coalesce(sum(weight) over earlier, 0))::bigint::double as level
            from sources window earlier as (
                order by (3 * source_size)::double / weight, source nulls last
                rows between unbounded preceding and 1 preceding)),
        targets as (
            select source, source_size,
                   least((3 * source_size)::double, weight * (select max(level) from levels)) as target
            from levels),
        budgets as (
            select *, coalesce(floor(target / nullif(source_size, 0)), 0)::bigint as whole,
                   target - coalesce(floor(target / nullif(source_size, 0)), 0) * source_size as rest
            from targets),
        upto as (
            select s.doc_id, s.size, s.hash, b.source_size, b.target, b.whole, b.rest,
                   sum(s.size) over (partition by s.source order by s.hash, s.tie, s.place
                                     rows between unbounded preceding and current row) as upto
            from sized s join budgets b on s.source is not distinct from b.source)
        select doc_id, size, source_size, target,
               (size * (whole + case when upto <= rest or upto - rest < rest - (upto - size)
                                     then 1 else 0 end))::bigint as taken
        from upto""",
    "op8_embedding_near_dedup": """
        with recursive vectors as (
            select row_number() over () as r, vec_id, label, embedding::double[] as v from embeddings),
        usable as (
            select * from vectors where label is not null and v is not null
            and len(list_filter(v, lambda x: x is null or isnan(x) or isinf(x))) = 0
            and len(list_filter(v, lambda x: x <> 0)) > 0),
        links as (
            select a.r as a, b.r as b from usable a join usable b
            on a.label = b.label and a.r <> b.r and len(a.v) = len(b.v)
               and list_cosine_similarity(a.v, b.v) >= 0.93),
        reach as (
            select r, vec_id as least from vectors
            union
            select links.b, reach.least from reach join links on links.a = reach.r),
        counts as (select a as r, count(*) as n from links group by a),
        components as (select r, min(least) as component_id from reach group by r)
        select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
        from vectors join components using (r) left join counts using (r)""",
    "op9_exact_dedup": r"""
        select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = min(doc_id) over same as kept, text_sha256
        from (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                     as text_sha256 from documents)
        window same as (partition by text_sha256)""",
}
