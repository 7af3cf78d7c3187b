"""One query for each corpus operator, over its whole table, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm import bpe_lexicon, centroids, chat_format, decontaminate, filter_audit, jaccard_join, page_text, quality_rules, source_mix
from repopulse.llm import suffix_dedup, surrogates, url_rules, weak_labels

Run = Callable[[SparkSession, str], DataFrame]

RUNS: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        RUNS[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    # What is left of a text; a character that a cut splits becomes the replacement character here, and stays whole in the digest.
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


PLAIN_WORDS = r"list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+', ' ', 'g')), ' '), lambda x: x != '')"


@query(
    "op2_decontamination",
    rf"""
    with docs as (select row_number() over () as row_no, doc_id, {PLAIN_WORDS} as words from documents),
    items as (select item_id, {PLAIN_WORDS} as words from benchmark),
    doc_words as (select row_no, unnest(words) as w, generate_subscripts(words, 1) as i from docs),
    item_words as (select item_id, unnest(words) as w, generate_subscripts(words, 1) as i from items),
    doc_grams as (
        select distinct row_no, concat_ws(' ', w, lead(w) over five, lead(w, 2) over five, lead(w, 3) over five, lead(w, 4) over five) as g
        from doc_words window five as (partition by row_no order by i) qualify lead(w, 4) over five is not null
    ),
    item_grams as (
        select distinct item_id, concat_ws(' ', w, lead(w) over five, lead(w, 2) over five, lead(w, 3) over five, lead(w, 4) over five) as g
        from item_words window five as (partition by item_id order by i) qualify lead(w, 4) over five is not null
    ),
    sized as (select *, count(*) over (partition by item_id) as n_item from item_grams)
    select doc_id, item_id, n_item, count(*) as n_shared, count(*)::double / n_item as containment
    from doc_grams join sized using (g) join docs using (row_no)
    group by row_no, doc_id, item_id, n_item having count(*)::double / n_item >= 0.8::double
    """,
)
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "item_id", F.col("n_item").cast("bigint").alias("n_item"), F.col("n_shared").cast("bigint").alias("n_shared"), "containment"
    )


@query("op3_page_text")
def op3_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.extract_pages(table(spark, folder, "pages"))


@query("op4_surrogates")
def op4_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, key="corpus surrogate key")


@query("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_join.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


@query("op5_chat_format")
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    awkward = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat_format.read_back(chat_format.format_turns(turns.unionByName(awkward)))


@query("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return weak_labels.classify(table(spark, folder, "documents"))


@query("op8_bpe")
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe_lexicon.encode(table(spark, folder, "documents").select("doc_id", "text"), path)
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query(
    "op9_url_filter",
    r"""
    with parts as (
        select page_id,
               case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end as rest
        from pages
    ), cut as (
        select page_id, row_number() over () as row_no,
               coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
        from parts
    ), rules(rule_host, rule_path, rule_verdict) as (
        values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
               ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
    )
    select page_id, host, path, rule_host || rule_path as rule, coalesce(rule_verdict, 'allow') as verdict
    from cut left join rules
      on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    qualify row_number() over (partition by row_no order by length(rule_host || rule_path) desc) = 1
    """,
)
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, folder, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op10_quality_rules",
    rf"""
    with docs as (select row_number() over () as row_no, doc_id, coalesce(text, '') as text from documents),
    listed as (
        select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
               list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
        from docs
    ),
    placed as (select row_no, unnest(words) as w, generate_subscripts(words, 1) as i from listed),
    windows as (
        select row_no, i, w, case when lead(w, 4) over five is not null then
               concat_ws(' ', w, lead(w) over five, lead(w, 2) over five, lead(w, 3) over five, lead(w, 4) over five) end as shingle
        from placed window five as (partition by row_no order by i)
    ),
    counted as (
        select row_no, i, w, shingle is not null and count(*) over (partition by row_no, shingle) > 1 as twice from windows
    ),
    covered as (
        select row_no, w, max(twice::int) over (partition by row_no order by i rows between 4 preceding and current row) as c
        from counted
    ),
    by_word as (
        select row_no, sum(c)::bigint as n_repeat_words,
               count(*) filter (where w in ({", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)})) as n_stop
        from covered group by row_no
    ),
    counts as (
        select doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
               (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
               (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, len(lines) as n_lines,
               coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(n_stop, 0) as n_stop
        from listed left join by_word using (row_no)
    ),
    base as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from counts)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and word_chars >= 2.0 * n_words and word_chars <= 14.0 * n_words
           and n_symbols::double / n_words <= 0.1::double
           and (n_words < 20 or n_stop::double / n_words >= 0.03::double)
           and (n_lines = 0 or n_dup_lines::double / n_lines <= 0.5::double) as kept
    from base
    """,
)
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query(
    "op11_filter_audit",
    r"""
    with docs as (
        select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
        from documents
    ),
    marks as (
        select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic
        from labels where doc_id is not null group by doc_id
    ),
    flagged as (
        select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
               (len(words) < 200)::int as a,
               (100 * len(list_distinct(words)) < 50 * len(words))::int as b,
               (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text))::int as c,
               regexp_matches(text, '[#$%&*|]')::int as d,
               coalesce(doc_id > min(doc_id) over (partition by text), false)::int as e
        from docs left join marks using (doc_id)
    ),
    masks as (
        select part, a + 2 * b + 4 * c + 8 * d + 16 * e as mask, count(*) as n, sum(good) as n_good, sum(toxic) as n_toxic
        from flagged group by all
    ),
    letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x, unnest([1, 2, 4, 8, 16]) as bit),
    orders as (
        select f.x || g.x || h.x || i.x || j.x as filter_order
        from letters f, letters g, letters h, letters i, letters j
        where f.bit + g.bit + h.bit + i.bit + j.bit = 31
          and f.bit | g.bit | h.bit | i.bit | j.bit = 31
    ),
    steps as (
        select filter_order, step::int as step, substr(filter_order, step, 1) as letter,
               (select bit from letters where x = substr(filter_order, step, 1)) as bit,
               (select coalesce(sum(bit), 0) from letters where contains(substr(filter_order, 1, step - 1), x))::int as before
        from orders, unnest([1, 2, 3, 4, 5]) as s(step)
    ),
    counted as (
        select part, filter_order, step, letter,
               coalesce(sum(n) filter (where mask & (before | bit) = 0), 0)::bigint as kept,
               coalesce(sum(n) filter (where mask & bit > 0 and mask & before = 0), 0)::bigint as removed,
               coalesce(sum(n) filter (where mask & bit > 0 and mask & before > 0), 0)::bigint as redundant,
               coalesce(sum(n) filter (where mask = bit), 0)::bigint as unique_fails,
               coalesce(sum(n_good) filter (where mask & bit > 0 and mask & before = 0), 0)::bigint as good_lost,
               coalesce(sum(n_toxic) filter (where mask & bit > 0 and mask & before = 0), 0)::bigint as toxic_lost
        from masks, steps group by part, filter_order, step, letter
    )
    select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           sum(removed) over (partition by part, letter)::bigint as shapley
    from counted
    """,
)
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _assign(vectors: str, centroids: str) -> str:
    """SQL for the nearest of ``centroids`` (c, i, y) of each of ``vectors`` (n, i, x)."""
    return f"""
        select n, arg_min(c, (d, c)) as c, min(d) as d from (
            select n, c, sum((x - y) * (x - y))::bigint as d from {vectors} join {centroids} using (i) group by n, c
        ) group by n
    """


def _round(k: int) -> str:
    return f"""
    near{k} as ({_assign("parts", f"centroids{k}")}),
    centroids{k + 1} as (
        select c, i, coalesce(m, y) as y from centroids{k}
        left join (select c, i, floor(sum(x)::double / count(*))::bigint as m from near{k} join parts using (n) group by c, i) using (c, i)
    )"""


@query(
    "op12_centroids",
    rf"""
    with kept as (
        select row_number() over () as n, vec_id, list_transform(embedding, lambda e: floor(64 * e::double)::bigint) as v
        from embeddings
        where len(embedding) = 64 and len(list_filter(embedding, lambda e: isfinite(e))) = 64
    ),
    parts as (select n, unnest(v) as x, generate_subscripts(v, 1) as i from kept),
    firsts as (
        select v, row_number() over (order by sha256('1:' || vec_id) nulls last, v) - 1 as c
        from kept qualify c < 16
    ),
    centroids0 as (select c, unnest(v) as y, generate_subscripts(v, 1) as i from firsts),
    {_round(0)}, {_round(1)}, {_round(2)},
    final as ({_assign("parts", "centroids3")}),
    digests as (select c, sha256(string_agg(y::varchar, ',' order by i)) as centroid_sha256 from centroids3 group by c)
    select vec_id, c::int as cluster, d as distance, sum(d) over (partition by c)::bigint as cluster_inertia,
           sum(d) over ()::bigint as inertia, centroid_sha256
    from final join kept using (n) join digests using (c)
    """,
)
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.report(centroids.cluster(table(spark, folder, "embeddings")))


@query(
    "op13_source_mix",
    r"""
    with sized as (
        select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::bigint as size,
               sha256(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) as h, row_number() over () as n
        from documents
    ),
    sources as (
        select source, sum(size)::hugeint as s, 3 * sum(size)::hugeint as stop,
               [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::hugeint as w
        from sized group by source
    ),
    -- A source stops if, shared among it and those with more room for their weight, its part is above its stop.
    stops as (
        select *, stop * sum(w) over later < (sum(s) over () - coalesce(sum(stop) over earlier, 0)) * w as over
        from sources
        window later as (order by stop::double / w, source rows between current row and unbounded following),
               earlier as (order by stop::double / w, source rows between unbounded preceding and 1 preceding)
    ),
    level as (
        select (sum(s) - coalesce(sum(stop) filter (where over), 0))::hugeint as rest,
               coalesce(sum(w) filter (where not over), 1)::hugeint as free from stops
    ),
    placed as (
        select *, coalesce(sum(if(over, stop, 0)) over line, 0) + coalesce(sum(if(over, 0, w)) over line, 0) * rest // free as upper,
               if(over, stop::double, (rest * w)::bigint::double / free::bigint::double) as target
        from stops, level window line as (order by source nulls last)
    ),
    takes as (select *, (upper - coalesce(lag(upper) over (order by source nulls last), 0))::bigint as words from placed),
    starts as (
        select doc_id, sized.size, s::bigint as source_size, target, words,
               (sum(size) over (partition by sized.source order by h, size, n) - size)::bigint as start
        from sized join takes on sized.source is not distinct from takes.source
    )
    select doc_id, size, source_size, target,
           case when size = 0 then 0
                else (words // source_size) * size + least(greatest(words % source_size - start, 0), size) end::bigint as taken
    from starts
    """,
)
def op13_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.taken(source_mix.mix(table(spark, folder, "documents")))
