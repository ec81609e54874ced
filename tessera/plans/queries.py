"""Queries of the core operators over whole tables, and the SQL of those that SQL expresses at a bearable price."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import chat, metrics, quality, script, text
from tessera.operators import chunks, dedup, evaluation, packing, pieces, sampling, stats, tokenizers
from tessera.plans import presets
from tessera.plans.shared import shared_dir, spread, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents")


# SQL fragments
W = r"[\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
T = "coalesce(text, '')"


def sub(x: str, pattern: str, to: str = "") -> str:
    q = lambda v: v.replace("'", "''")
    return f"regexp_replace({x}, '{q(pattern)}', '{q(to)}', 'g')"


def strip(x: str) -> str:
    return sub(sub(x, f"^{W}+"), f"{W}+$")


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{W}+'), lambda w: w <> '')"


def nwords(x: str) -> str:
    return f"len({words(x)})"


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '{pattern}'))"


def key(x: str) -> str:
    return strip(sub(f"lower({x})", f"{W}+", " "))


MEITEI, BENGALI, DEVANAGARI, LATIN = r"[\x{ABC0}-\x{ABFF}\x{AAE0}-\x{AAFF}]", r"[\x{980}-\x{9FF}]", r"[\x{900}-\x{97F}]", "[a-zA-Z]"
Q = {"d": text.DOUBLE_QUOTES, "s": text.SINGLE_QUOTES}
NORMAL = "nfc_normalize(text)"
NORMAL = sub(sub(NORMAL, r"[\x{200b}\x{feff}]"), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}\x{ad}]")
NORMAL = f"translate({NORMAL}, '{Q['d']}{Q['s']}', '{'"' * len(Q['d'])}{"''" * len(Q['s'])}')"
NORMAL = sub(sub(sub(NORMAL, f"{W}+([.,!?])", r"\1"), r"\.\.\.+", "..."), " +", " ")


@query("txt_normalise", f"select doc_id, {NORMAL} as text from documents")
def _(s, d):
    return docs(s, d).select("doc_id", text.normalise(F.col("text")).alias("text"))


MARK = sub(sub("text", r"<\?[^?>]+\?>|<![^>]+>"), r"<[^>]+>")


@query("txt_markup", f"select doc_id, {MARK} as text from documents")
def _(s, d):
    return docs(s, d).select("doc_id", text.strip_markup(F.col("text")).alias("text"))


@query("txt_markdown", "select doc_id, " + sub(sub(sub("text", r"!?\[([^\]]*)\]\([^)]*\)", r"\1"), r"(?m)^#{1,6}[ \t\n\r\f\x0b]+"), "[*_`]|~~") + " as text from documents")
def _(s, d):
    return docs(s, d).select("doc_id", text.strip_markdown(F.col("text")).alias("text"))


@query("txt_addresses")
def _(s, d):
    return docs(s, d).select("doc_id", text.drop_addresses(F.col("text")).alias("text"))


@query("txt_lines", "select doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(replace(text, chr(9), ' '), '\\r\\n|[\\n\\x0b\\f\\r\\x{85}\\x{2028}\\x{2029}]'), lambda x: " + sub(strip("x"), " +", " ") + "), lambda x: x <> ''), chr(10)) as text from documents where text is not null")
def _(s, d):
    return docs(s, d).where("text is not null").select("doc_id", text.tidy_lines(F.col("text")).alias("text"))


@query("txt_scan_noise", "select doc_id, " + strip(sub(sub(sub("text", rf"^{W}*\([ivxIVX0-9]+\){W}*"), r"[.\-_=~]{3,}", " "), " +", " ")) + " as text from documents")
def _(s, d):
    return docs(s, d).select("doc_id", text.drop_scan_noise(F.col("text")).alias("text"))


@query("txt_clean")
def _(s, d):
    return docs(s, d).select("doc_id", text.clean(F.col("text")).alias("text"))


@query("txt_foreign", "select doc_id, " + sub("text", r"[\x{A00}-\x{AFF}\x{B00}-\x{D7F}]") + " as text, " + count(T, r"[\x{A80}-\x{AFF}]") + " as gujarati from documents where text is not null")
def _(s, d):
    return docs(s, d).where("text is not null").select("doc_id", text.drop_foreign(F.col("text")).alias("text"), F.coalesce(text.foreign_counts(F.col("text"))["gujarati"], F.lit(0)).alias("gujarati"))


@query("txt_key", f"select doc_id, {key('text')} as k from documents")
def _(s, d):
    return docs(s, d).select("doc_id", text.dedup_key(F.col("text")).alias("k"))


CAT = "case when x is null or x in ('', 'unknown') then 'unknown' " + "".join(f"when contains(x, '{c}') then '{c}' " for c in text.CATEGORIES) + "else x end"


@query("txt_category", f"select doc_id, {CAT} as category from (select doc_id, lower({strip('category')}) as x from documents)")
def _(s, d):
    return docs(s, d).select("doc_id", text.category(F.col("category")).alias("category"))


@query("txt_snippet", "select doc_id, case when length(text) > 120 then substring(text, 1, 120) || '...' else text end as snippet from documents")
def _(s, d):
    return docs(s, d).select("doc_id", text.snippet(F.col("text"), 120).alias("snippet"))


REASON = f"""case when text is null or {strip('text')} = '' then 'empty' when contains(text, chr(65533)) then 'corrupted_unicode'
 when regexp_matches(text, '^(?:{W}|[!-/:-@\\[-`{{-~\\x{{964}}\\x{{965}}\\x{{201c}}\\x{{201d}}\\x{{2018}}\\x{{2019}}])+$') then 'only_punctuation'
 when regexp_matches(text, '^(?:{W}|[0-9\\x{{9e6}}-\\x{{9ef}}\\x{{abf0}}-\\x{{abf9}}])+$') then 'only_numbers'
 when len(list_filter(range(1, len(l) - 3), lambda i: l[i] not in (chr(10), chr(13), chr(133), chr(8232), chr(8233)) and l[i] = l[i + 1] and l[i] = l[i + 2] and l[i] = l[i + 3] and l[i] = l[i + 4])) > 0
   or (regexp_matches(text, '[\\x{{980}}-\\x{{9FF}}\\x{{ABC0}}-\\x{{ABFF}}]') and {count('text', LATIN)} / length(text) > 0.35) then 'repeated_chars' end"""


@query("val_reason", f"select doc_id, {REASON} as reason from (select doc_id, text, string_split(text, '') as l from documents)")
def _(s, d):
    return docs(s, d).select("doc_id", quality.reject_reason(F.col("text")).alias("reason"))


@query("val_reasons", f"select coalesce(reason, 'kept') as reason, count(*) as n from (select {REASON} as reason from (select text, string_split(text, '') as l from documents)) group by 1")
def _(s, d):
    return docs(s, d).groupBy(F.coalesce(quality.reject_reason(F.col("text")), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("val_length", f"select doc_id, coalesce(length(text) between 3 and 512, false) as ok_chars, coalesce({nwords('text')} between 3 and 512, false) as ok_words from documents")
def _(s, d):
    return docs(s, d).select("doc_id", quality.length_ok(F.col("text")).alias("ok_chars"), quality.length_ok(F.col("text"), unit="words").alias("ok_words"))


@query("val_rows", f"""select reason, count(*) as n from (select case when {strip(T)} = '' then 'Empty' when regexp_matches(text, '[\\x{{fffd}}\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]') then 'Invalid Unicode'
 when not regexp_matches(text, '{MEITEI}') then 'Script mismatch' when row_number() over (partition by text || '||' || coalesce(source, '') order by doc_id) > 1 then 'Duplicate' else 'Valid' end as reason from documents) group by 1""")
def _(s, d):
    t = F.col("text")
    base = docs(s, d).select("doc_id", "text", F.concat_ws("||", "text", F.coalesce("source", F.lit(""))).alias("k"))
    first = dedup.first_rows(base, ["k"], "doc_id").select("doc_id", F.lit(True).alias("first"))
    r = F.when(text.strip(F.coalesce(t, F.lit(""))) == "", "Empty").when(quality.invalid_unicode(t), "Invalid Unicode").when(~t.rlike(script.SCRIPTS["meitei"]), "Script mismatch").when(F.col("first").isNull(), "Duplicate").otherwise("Valid")
    return base.join(first, "doc_id", "left").groupBy(r.alias("reason")).agg(F.count("*").alias("n"))


DOM = """select doc_id, case when tot = 0 then 'unknown' when second / tot > 0.15 then 'mixed' when m = top then 'meitei' when b = top then 'bengali' when v = top then 'devanagari' else 'latin' end as script,
 case when tot = 0 then 0.0 when second / tot > 0.15 then top / tot else round(top / tot, 4) end as confidence from (select *, m + b + v + x as tot, greatest(m, b, v, x) as top, list_sort([m, b, v, x])[3] as second from (select doc_id, """ + ", ".join(f"{count(T, p)} as {n}" for n, p in (("m", MEITEI), ("b", BENGALI), ("v", DEVANAGARI), ("x", LATIN))) + " from documents))"


@query("scr_dominant", DOM)
def _(s, d):
    x = script.dominant(F.col("text"))
    return docs(s, d).select("doc_id", x["script"].alias("script"), x["confidence"].alias("confidence"))


@query("scr_shares", f"select doc_id, case when n = 0 then 0.0 else round({count('t', MEITEI)} / n, 4) end as meitei, case when n = 0 then 0.0 else round({count('t', BENGALI)} / n, 4) end as bengali, case when n = 0 then 0.0 else round({count('lower(t)', '[a-z]')} / n, 4) end as latin from (select doc_id, {sub(T, W)} as t, length({sub(T, W)}) as n from documents)")
def _(s, d):
    x = script.shares(F.col("text"))
    return docs(s, d).select("doc_id", x["meitei"].alias("meitei"), x["bengali"].alias("bengali"), x["latin"].alias("latin"))


@query("scr_presence", f"select doc_id, case when m and b then 'mixed' when m then 'meitei' when b then 'bengali' else 'other' end as script from (select doc_id, coalesce(regexp_matches(text, '[\\x{{ABC0}}-\\x{{ABFF}}\\x{{1C80}}-\\x{{1C8F}}]'), false) as m, coalesce(regexp_matches(text, '{BENGALI}'), false) as b from documents)")
def _(s, d):
    return docs(s, d).select("doc_id", script.presence(F.col("text")).alias("script"))


@query("scr_fidelity", f"select count(*) as n, sum((b > 3)::int)::bigint as switched, sum((m > 0 and b > 0 and abs(m - b) / length(text) < 0.2)::int)::bigint as confused, sum({count('text', '[\\x{fffd}\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]')})::bigint as invalid from (select text, {count('text', MEITEI)} as m, {count('text', BENGALI)} as b from documents where text is not null)")
def _(s, d):
    x = script.fidelity(F.col("text"))
    rows = docs(s, d).where("text is not null").select(x.alias("x"))
    return rows.agg(F.count("*").alias("n"), F.sum(F.col("x.switched").cast("int")).alias("switched"), F.sum(F.col("x.confused").cast("int")).alias("confused"), F.sum("x.invalid").alias("invalid"))


@query("lng_language", f"select doc_id, case when script = 'meitei' and confidence > 0.8 then 'mni' else coalesce(lang, 'unknown') end as language from (select doc_id, lang from documents) join ({DOM}) using (doc_id)")
def _(s, d):
    return docs(s, d).select("doc_id", script.language(F.col("text"), F.col("lang")).alias("language"))


MAYEK = T
for _k in sorted(script.MAYEK, key=len, reverse=True):
    MAYEK = f"replace({MAYEK}, '{_k}', '{script.MAYEK[_k]}')"


@query("trl_mayek", f"select doc_id, {MAYEK} as text from documents where text is not null")
def _(s, d):
    return docs(s, d).where("text is not null").select("doc_id", script.to_mayek(F.col("text")).alias("text"))


QS = f"""case when text is null or text = '' then 0.0 when n < 3 then 0.2 when sr > 0.35 then 0.3 when awl > 25 or awl < 1.5 then 0.35
 else round(least(greatest(0.85 - sr * 0.5 + case when n >= 15 then 0.10 else 0.0 end, 0.0), 1.0), 3) end"""
QFROM = f"(select *, {count('t', '[^\\p{L}\\p{N}\\t\\n\\x0b\\f\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]')} / nullif(length(t), 0)::double as sr, list_sum(list_transform(w, lambda y: length(y))) / nullif(n, 0)::double as awl from (select *, len(w) as n from (select *, {words('t')} as w from (select *, {strip(T)} as t from documents))))"


@query("qlt_score", f"select doc_id, cast({QS} as double) as score from {QFROM}")
def _(s, d):
    return docs(s, d).select("doc_id", quality.quality_score(F.col("text")).cast("double").alias("score"))


@query("tox_terms", "select doc_id, case when contains(lower(text), 'bridge') then 'bridge' when contains(lower(text), 'kill yourself') then 'kill yourself' end as term from documents where contains(lower(text), 'bridge') or contains(lower(text), 'kill yourself')")
def _(s, d):
    return docs(s, d).select("doc_id", quality.blocked_term(F.col("text"), ("Bridge",)).alias("term")).where("term is not null")


@query("pii_masked")
def _(s, d):
    m = quality.masked(F.col("text"))
    return spread(docs(s, d).select("doc_id", "text")).select("doc_id", m.alias("m")).select("doc_id", "m.text", F.array_sort(F.map_keys("m.counts")).alias("kinds"))


# repeats
@query("ded_exact", "select min(doc_id) as doc_id from documents group by text")
def _(s, d):
    return dedup.exact(docs(s, d)).select("doc_id")


@query("ded_normalised", f"select min(doc_id) as doc_id from documents group by {key('text')}")
def _(s, d):
    return dedup.normalised(docs(s, d)).select("doc_id")


@query("ded_fuzzy")
def _(s, d):
    return dedup.fuzzy_gone(table(s, d, "corpus_rows"), "text", "row_id", shared_dir(s))


@query("ded_minhash")
def _(s, d):
    return dedup.minhash_gone(dedup.signatures(spread(table(s, d, "corpus_rows").select("row_id", "text")), "text", "row_id"), "row_id", shared_dir(s))


@query("ded_against", f"select row_id from incoming_rows i where not exists (select 1 from corpus_rows c where {strip('c.text')} = {strip('i.text')})")
def _(s, d):
    return dedup.against(table(s, d, "incoming_rows"), table(s, d, "corpus_rows")).select("row_id")


@query("ded_consolidated", "select id from (select id, row_number() over (partition by text order by p, id) as r from (select row_id as id, text, 0 as p from corpus_rows union all select row_id, text, 1 from incoming_rows)) where r = 1")
def _(s, d):
    a = table(s, d, "corpus_rows").select(F.col("row_id").alias("id"), "text")
    return dedup.consolidated(a, table(s, d, "incoming_rows").select(F.col("row_id").alias("id"), "text"), "text", "id").select("id")


@query("ded_columns", "select min(row_id) as row_id from corpus_rows group by concat_ws('||', text, source)")
def _(s, d):
    return dedup.on_columns(table(s, d, "corpus_rows"), ["text", "source"], "row_id").select("row_id")


@query("ded_pairs", "select min(pair_id) as pair_id from instructions group by instruction, output")
def _(s, d):
    return dedup.first_rows(table(s, d, "instructions"), ["instruction", "output"], "pair_id").select("pair_id")


@query("ded_chunks", "select count(distinct md5(c)) as chunks from (select unnest(string_split_regex(text, '\\n+')) as c from documents) where c <> ''")
def _(s, d):
    c = docs(s, d).select(F.explode(F.split("text", r"\n+")).alias("c")).where("c <> ''")
    return c.select(F.sha2("c", 256).alias("h")).distinct().agg(F.count("*").alias("chunks"))


# chunks, splits, shards
CH = f"""select doc_id, (i)::int as chunk_id, k::int as total_chunks, case when n <= 200 then t else array_to_string(w[i * 180 + 1 : i * 180 + 200], ' ') end as text
 from (select *, unnest(range(0, k)) as i from (select doc_id, t, w, len(w) as n, greatest(ceil((len(w) - 20) / 180.0), 1)::bigint as k from (select doc_id, {strip(T)} as t, {words(strip(T))} as w from documents) where t <> ''))"""


@query("chk_words", CH)
def _(s, d):
    return chunks.chunked(docs(s, d).select("doc_id", "text"), "text", 200, 20).select("doc_id", "chunk_id", "total_chunks", "text")


@query("chk_chars")
def _(s, d):
    return chunks.chunked(docs(s, d).select("doc_id", "text"), "text", 500, 50, "chars").select("doc_id", "chunk_id", "total_chunks", "text")


SHUFFLED = "select doc_id, row_number() over (order by substr(md5('42-' || doc_id), 1, 15), doc_id) as r, count(*) over () as n from documents"


@query("spl_ratio", f"select doc_id, case when r <= ceil(n * 0.05::double) then 'test' when r <= 2 * ceil(n * 0.05::double) then 'validation' else 'train' end as split from ({SHUFFLED})")
def _(s, d):
    return chunks.split_rows(docs(s, d).select("doc_id"), "doc_id", 0.9, 0.05, 0.05)


@query("spl_sizes", "select 'test' as split, ceil(count(*) * 0.05)::bigint as n from documents union all select 'validation', ceil(count(*) * 0.05)::bigint from documents union all select 'train', count(*) - 2 * ceil(count(*) * 0.05)::bigint from documents")
def _(s, d):
    return chunks.split_rows(docs(s, d).select("doc_id"), "doc_id", 0.9, 0.05, 0.05).groupBy("split").agg(F.count("*").alias("n"))


@query("spl_task", f"select doc_id, case when r <= floor(n * 0.9::double) then 'train' when r <= floor(n * 0.9::double) + greatest(1, floor(n * 0.05::double)) then 'validation' else 'test' end as split from ({SHUFFLED})")
def _(s, d):
    return chunks.task_split(docs(s, d).select("doc_id"), "doc_id")


@query("shd_rows", "select row_id, split, ((row_number() over (partition by split order by row_id) - 1) // 1000)::bigint as shard, ((row_number() over (partition by split order by row_id) - 1) % 1000)::bigint as shard_row from corpus_rows")
def _(s, d):
    return chunks.sharded(table(s, d, "corpus_rows").select("row_id", "split"), "row_id", 1000, "split").select("row_id", "split", F.col("shard").cast("long"), F.col("shard_row").cast("long"))


@query("shd_fingerprint")
def _(s, d):
    return chunks.fingerprint(table(s, d, "corpus_rows").select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("h")), "h")


# statistics
@query("agg_lengths", "select count(*) as n, sum(length(text))::bigint as chars, min(length(text)) as least, max(length(text)) as most, count(*) filter (where text is null) as nulls from documents")
def _(s, d):
    n = F.length("text")
    return docs(s, d).agg(F.count("*").alias("n"), F.sum(n).alias("chars"), F.min(n).alias("least"), F.max(n).alias("most"), F.count_if(F.col("text").isNull()).alias("nulls"))


@query("agg_splits", f"select coalesce(split, 'all') as split, count(*) as sequences, sum(length({T}))::bigint as chars, sum({nwords(T)})::bigint as tokens from corpus_rows group by rollup(split)")
def _(s, d):
    n = F.coalesce(F.length("text"), F.lit(0))
    rows = table(s, d, "corpus_rows").select("split", n.alias("n"), text.word_count(F.col("text")).alias("w"))
    fine = rows.groupBy("split").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("w").alias("w"))
    return fine.rollup("split").agg(F.sum("k").alias("sequences"), F.sum("n").alias("chars"), F.sum("w").alias("tokens")).select(F.coalesce("split", F.lit("all")).alias("split"), "sequences", "chars", "tokens")


@query("agg_percentiles", "select min(v) filter (where r > floor(n * 0.1)) as p10, min(v) filter (where r > floor(n * 0.5)) as p50, min(v) filter (where r > floor(n * 0.9)) as p90, min(v) filter (where r > floor(n * 0.99)) as p99, max(v) as max from (select length(text) as v, row_number() over (order by length(text)) as r, count(*) over () as n from documents where text is not null)")
def _(s, d):
    return stats.percentiles(docs(s, d).select(F.length("text").alias("v")), "v")


@query("agg_balance", "select label, coalesce(n, 0) as n from (select unnest(['meitei', 'bengali', 'latin', 'devanagari', 'mixed', 'unknown']) as label) left join (select case when script in ('meitei', 'bengali', 'latin', 'devanagari', 'mixed') then script else 'unknown' end as label, count(*) as n from documents group by 1) using (label)")
def _(s, d):
    return stats.balance(docs(s, d), "script", ("meitei", "bengali", "latin", "devanagari", "mixed")).select("label", "n")


@query("agg_sources", f"select source, count(*) as sequences, sum({nwords(T)})::bigint as tokens, 100.0::double * count(*) / sum(count(*)) over () as percent from documents group by source")
def _(s, d):
    g = docs(s, d).select("source", text.word_count(F.col("text")).alias("w")).groupBy("source").agg(F.count("*").alias("sequences"), F.sum("w").alias("tokens"))
    return g.withColumn("percent", 100.0 * F.col("sequences") / F.sum("sequences").over(Window.partitionBy()))


@query("agg_estimate", f"select doc_id, floor({nwords(T)} * 1.4::double)::bigint as tokens from documents")
def _(s, d):
    return docs(s, d).select("doc_id", text.token_estimate(F.col("text")).alias("tokens"))


@query("agg_histograms", "select source, category, script, language, count(*) as n from documents group by grouping sets ((source), (category), (script), (language))")
def _(s, d):
    base = docs(s, d).groupBy("source", "category", "script", "language").agg(F.count("*").alias("n"))
    return base.groupingSets([["source"], ["category"], ["script"], ["language"]], "source", "category", "script", "language").agg(F.sum("n").alias("n"))


@query("agg_funnel", f"select source, count(*) as raw, count(*) filter (where text is null or {strip('text')} = '') as filtered, count(*) filter (where r > 1 and {strip(T)} <> '') as duplicates from (select source, text, row_number() over (partition by text order by doc_id) as r from documents) group by source")
def _(s, d):
    rows = docs(s, d).select("doc_id", "source", "text")
    first = dedup.exact(rows).select("doc_id", F.lit(1).alias("first"))
    blank = F.col("text").isNull() | (text.strip(F.col("text")) == "")
    return rows.join(first, "doc_id", "left").groupBy("source").agg(F.count("*").alias("raw"), F.count_if(blank).alias("filtered"), F.count_if(~blank & F.col("first").isNull()).alias("duplicates"))


@query("aud_summary", f"with t as (select unnest({words('lower(' + T + ')')}) as w from documents) select (select count(*) from documents) as rows, (select sum(length({T}))::bigint from documents) as chars, count(*) as tokens, count(distinct w) as vocabulary from t")
def _(s, d):
    rows = docs(s, d)
    tokens = stats.token_rows(rows, "text", []).groupBy("token").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("vocabulary"))
    t = tokens.first()
    return rows.agg(F.count("*").alias("rows"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("chars")).withColumn("tokens", F.lit(t[0])).withColumn("vocabulary", F.lit(t[1]))


@query("aud_novelty", "select source, count(*) as raw, count(*) filter (where not seen) as kept, count(*) filter (where not seen) * 100.0::double / greatest(count(*), 1) as novelty from (select source, exists (select 1 from corpus_rows c where c.text = i.text) as seen from incoming_rows i) group by source")
def _(s, d):
    new = table(s, d, "incoming_rows").select("source", F.sha2("text", 256).alias("k"))
    old = table(s, d, "corpus_rows").where("text is not null").select(F.sha2("text", 256).alias("k"), F.lit(1).alias("old")).distinct()
    kept = F.count_if(F.col("old").isNull())
    return new.join(old, "k", "left").groupBy("source").agg(F.count("*").alias("raw"), kept.alias("kept"), (kept * F.lit(100.0) / F.greatest(F.count("*"), F.lit(1))).alias("novelty"))


@query("aud_domains", f"select category, count(*) as sequences, 100.0::double * count(*) / sum(count(*)) over () as sequence_percent, 100.0::double * sum({nwords(T)}) / sum(sum({nwords(T)})) over () as token_percent from documents group by category")
def _(s, d):
    g = docs(s, d).select("category", text.word_count(F.col("text")).alias("w")).groupBy("category").agg(F.count("*").alias("sequences"), F.sum("w").alias("w"))
    every = Window.partitionBy()
    return g.select("category", "sequences", (100.0 * F.col("sequences") / F.sum("sequences").over(every)).alias("sequence_percent"), (100.0 * F.col("w") / F.sum("w").over(every)).alias("token_percent"))


@query("aud_extremes", "select (select doc_id from documents where text is not null order by length(text) desc, doc_id limit 1) as longest, (select doc_id from documents where text is not null order by length(text), doc_id limit 1) as shortest")
def _(s, d):
    n = F.length("text")
    return docs(s, d).where("text is not null").agg(F.max_by("doc_id", F.struct(n, -F.col("doc_id"))).alias("longest"), F.min_by("doc_id", F.struct(n, F.col("doc_id"))).alias("shortest"))


@query("aud_mixed_scans", f"select doc_id from documents where script in ('meitei', 'bengali') and {count(T, LATIN)} / nullif(length(text), 0) > 0.35 order by doc_id limit 10")
def _(s, d):
    share = F.regexp_count("text", F.lit("[a-zA-Z]")) / F.length("text")
    return docs(s, d).where(F.col("script").isin("meitei", "bengali") & (F.length("text") > 0) & (share > 0.35)).select("doc_id").orderBy("doc_id").limit(10)


@query("aud_repetitive", f"select doc_id from (select doc_id, w, count(*) as n, sum(count(*)) over (partition by doc_id) as t from (select doc_id, unnest({words('lower(' + T + ')')}) as w from documents) group by doc_id, w) where t > 15 and n / t > 0.6 group by doc_id")
def _(s, d):
    c = stats.token_rows(docs(s, d), "text", ["doc_id"]).groupBy("doc_id", "token").agg(F.count("*").alias("n")).groupBy("doc_id").agg(F.sum("n").alias("t"), F.max("n").alias("top"))
    return c.where("t > 15 and top / t > 0.6").select("doc_id")


@query("aud_vocabulary", f"with t as (select doc_id, source, unnest({words('lower(' + T + ')')}) as w from documents), f as (select w, min(doc_id) as first from t group by w), l as (select source, max(doc_id) as last from documents group by source) select source, (select count(*) from f where first <= last) as vocabulary from l")
def _(s, d):
    return stats.vocabulary_growth(docs(s, d), "text", "source", "doc_id")


@query("aud_top_tokens", f"with t as (select doc_id, unnest({words('lower(' + T + ')')}) as w, generate_subscripts({words('lower(' + T + ')')}, 1) as p from documents) select w as token, count(*) as n from t group by w order by count(*) desc, min(doc_id * 1000000 + p) limit 100")
def _(s, d):
    return stats.top_tokens(docs(s, d), "text", "doc_id", 100).select("token", "n")


@query("aud_characters", "select c, count(*) as n from (select unnest(string_split(text, '')) as c from documents) where c <> '' group by c")
def _(s, d):
    return docs(s, d).select(F.explode(F.split("text", "")).alias("c")).where("c <> ''").groupBy("c").agg(F.count("*").alias("n"))


@query("his_lengths", f"select case when n < 128 then '<128' when n <= 512 then '128-512' when n <= 1024 then '513-1024' when n <= 2048 then '1025-2048' else '>2048' end as bin, count(*) as n from (select {nwords(T)} as n from documents) group by 1")
def _(s, d):
    return stats.histogram(docs(s, d), text.word_count(F.col("text")))


@query("his_summary", f"select max(n)::bigint as most, min(n)::bigint as least, sum(n)::bigint as tokens, round(avg(n), 2) as average, count(*) filter (where n >= 512) as truncated from (select {nwords(T)} as n from documents)")
def _(s, d):
    n = text.word_count(F.col("text")).cast("long")
    return docs(s, d).select(n.alias("n")).agg(F.max("n").alias("most"), F.min("n").alias("least"), F.sum("n").alias("tokens"), F.round(F.avg("n"), 2).alias("average"), F.count_if(F.col("n") >= 512).alias("truncated"))


# tokenizers
@query("tok_encoded")
def _(s, d):
    return pieces.encoded(docs(s, d), "text", table(s, d, "vocab_pieces"), ["doc_id"]).select("doc_id", F.size("input_ids").alias("tokens"), "round_trip")


def fit_rows(s, d, by):
    rows = docs(s, d).where("text is not null").select(by, text.word_count(F.col("text")).cast("long").alias("w"), F.octet_length("text").cast("long").alias("b"), F.length("text").cast("long").alias("c"), "text")
    return pieces.encoded(spread(rows), "text", table(s, d, "vocab_pieces"), [by, "w", "b", "c"])


@query("tok_fitness")
def _(s, d):
    return tokenizers.fitness(fit_rows(s, d, "script"), "script", table(s, d, "vocab_pieces").count())


@query("tok_domains")
def _(s, d):
    f = tokenizers.fitness(fit_rows(s, d, "category"), "category", table(s, d, "vocab_pieces").count())
    return f.withColumn("complies", tokenizers.complies()).withColumn("score", tokenizers.score(F.lit("unigram")))


@query("tok_winner")
def _(s, d):
    f = tokenizers.fitness(fit_rows(s, d, "script"), "script", table(s, d, "vocab_pieces").count())
    return tokenizers.winner(f.where("script is not null and fertility is not null"), "script")


@query("tok_coverage", "with c as (select distinct unnest(string_split(text, '')) as c from documents), v as (select distinct unnest(string_split(piece, '')) as c from vocab_pieces where kind = 'normal') select count(*) as characters, count(v.c) as covered from c left join v using (c) where c <> ''")
def _(s, d):
    seen = docs(s, d).select(F.explode(F.array_distinct(F.split("text", ""))).alias("c")).where("c <> ''").distinct()
    held = table(s, d, "vocab_pieces").where("kind = 'normal'").select(F.explode(F.split("piece", "")).alias("c")).where("c <> ''").distinct().withColumn("h", F.lit(1))
    return seen.join(held, "c", "left").agg(F.count("*").alias("characters"), F.count("h").alias("covered"))


@query("tok_boundaries")
def _(s, d):
    rows = docs(s, d).select("doc_id", "text", text.word_count(F.col("text")).alias("w"), F.coalesce(F.col("text").rlike(quality.INDIC), F.lit(False)).alias("indic"))
    got = pieces.encoded(spread(rows), "text", table(s, d, "vocab_pieces"), ["doc_id", "w", "indic"])
    return got.select("doc_id", tokenizers.boundary_quality(F.size("input_ids"), F.col("w"), F.col("indic")).alias("quality"))


@query("tok_preservation")
def _(s, d):
    f = tokenizers.fitness(fit_rows(s, d, "script"), "script", table(s, d, "vocab_pieces").count())
    return f.select("script", tokenizers.preservation(F.col("unknown_rate")).alias("preservation"), F.col("fertility").alias("inflation"))


@query("his_ids")
def _(s, d):
    ids = pieces.encoded(spread(docs(s, d).select("doc_id", "text")), "text", table(s, d, "vocab_pieces"), ["doc_id"]).select(F.explode("input_ids").alias("id"))
    return ids.groupBy("id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "id").limit(20)


@query("tok_stability", f"with t as (select distinct split, unnest({words('lower(' + T + ')')}) as w from corpus_rows), n as (select split, count(*) as n from t group by split) select a.split as a, b.split as b, count(*) / (na.n + nb.n - count(*))::double as jaccard from t a join t b on a.w = b.w and a.split < b.split join n na on na.split = a.split join n nb on nb.split = b.split group by a.split, b.split, na.n, nb.n")
def _(s, d):
    t = stats.token_rows(table(s, d, "corpus_rows"), "text", ["split"]).select("split", "token").distinct()
    sets = t.groupBy("token").agg(F.array_sort(F.collect_set("split")).alias("in"))  # as many as splits at most
    n = t.groupBy("split").agg(F.count("*").alias("n"))
    pairs = sets.select(F.explode(F.flatten(F.transform("in", lambda a: F.transform(F.filter("in", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("k"))
    return pairs.join(n.select(F.col("split").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("split").alias("b"), F.col("n").alias("nb")), "b").select("a", "b", (F.col("k") / (F.col("na") + F.col("nb") - F.col("k"))).alias("jaccard"))


@query("tok_tier", "select source, case when b >= 524288000 then 'v3-final' when b >= 262144000 then 'v2-expanded' when b >= 52428800 then 'v1-pretrain' else 'v0-experimental' end as tier from (select source, coalesce(sum(strlen(text)), 0) as b from documents group by source)")
def _(s, d):
    g = docs(s, d).groupBy("source").agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b"))
    return g.select("source", tokenizers.tier(F.col("b")).alias("tier"))


@query("tok_longest", f"select script, max(length(w)) as longest from (select script, unnest({words(T)}) as w from documents) group by script")
def _(s, d):
    return docs(s, d).select("script", F.explode(text.words(F.col("text"))).alias("w")).groupBy("script").agg(F.max(F.length("w")).alias("longest"))


# packing
@query("pak_positions", f"select doc_id, n, coalesce(sum(n) over (order by doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as start from (select doc_id, {nwords(T)} + 1 as n from documents)")
def _(s, d):
    rows = docs(s, d).select("doc_id", (text.word_count(F.col("text")) + 1).cast("long").alias("n"))
    return packing.positions(rows, "doc_id", "n").select("doc_id", "n", "start")


@query("pak_blocks")
def _(s, d):
    ids = pieces.encoded(spread(docs(s, d).select("doc_id", "text")), "text", table(s, d, "vocab_pieces"), ["doc_id"]).select("doc_id", F.concat("input_ids", F.array(F.lit(2))).alias("ids"))
    return packing.packed(ids, "doc_id", "ids", 512, 3)


# conversations
@query("prm_instruction", f"select pair_id, '### Instruction:' || chr(10) || instruction || case when coalesce({strip('input')}, '') = '' then '' else chr(10) || chr(10) || '### Input:' || chr(10) || input end || chr(10) || chr(10) || '### Response:' || chr(10) || coalesce(output, '') as prompt from instructions")
def _(s, d):
    return table(s, d, "instructions").select("pair_id", chat.prompt("instruction", F.col("instruction"), F.col("input"), F.col("output")).alias("prompt"))


@query("lbl_masked", f"select pair_id, list_transform(range(1, n + 1), lambda i: case when i <= k then -100 else i end)::int[] as labels from (select pair_id, {nwords('coalesce(instruction, chr(32))')} as k, {nwords('coalesce(instruction, chr(32))')} + {nwords('coalesce(output, chr(32))')} as n from instructions)")
def _(s, d):
    k, n = text.word_count(F.col("instruction")), text.word_count(F.col("output"))
    ids = F.when(k + n > 0, F.sequence(F.lit(1), k + n)).otherwise(F.array().cast("array<int>"))
    return table(s, d, "instructions").select("pair_id", chat.labels(ids, k).alias("labels"))


PS = f"case when a = 0 or b = 0 then 0.0 when b / a < 0.25 or b / a > 4 then 0.2 else round(least(greatest(0.95::double - 0.2 * abs(b / a - 1.2), 0.0), 1.0), 3) end"


@query("xlt_score", f"select row_id, cast({PS} as double) as score from (select row_id, {nwords(T)}::double as a, {nwords('english_parallel')}::double as b from corpus_rows where english_parallel is not null)")
def _(s, d):
    return table(s, d, "corpus_rows").where("english_parallel is not null").select("row_id", metrics.pair_score(F.col("text"), F.col("english_parallel")).cast("double").alias("score"))


# metrics over response and input of instruction pairs
PW, RW = words("lower(coalesce(output, chr(32)))"), words("lower(coalesce(input, chr(32)))")


@query("met_precision", f"select 100.0::double * sum(len(list_filter(p, lambda w: list_contains(r, w)))) / sum(len(p)) as score from (select {PW} as p, {RW} as r from instructions)")
def _(s, d):
    return table(s, d, "instructions").agg(metrics.unigram_precision(F.col("output"), F.col("input")).alias("score"))


@query("met_overlap", f"select pair_id, case when len(p) = 0 or len(r) = 0 or k = 0 then 0.0 else 2.0::double * (k / len(p)::double) * (k / len(r)::double) / (k / len(p)::double + k / len(r)::double) end::double as f1 from (select *, len(list_intersect(list_distinct(p), r)) as k from (select pair_id, {PW} as p, {RW} as r from instructions))")
def _(s, d):
    return table(s, d, "instructions").select("pair_id", metrics.overlap_f1(F.col("output"), F.col("input")).alias("f1"))


@query("met_token_f1", f"select pair_id, case when k = 0 then 0.0 else 2.0::double * k / (len(p) + len(r)) end::double as f1 from (select *, len(list_intersect(p, r)) as k from (select pair_id, list_distinct({PW}) as p, list_distinct({RW}) as r from instructions))")
def _(s, d):
    return table(s, d, "instructions").select("pair_id", metrics.token_set_f1(F.col("output"), F.col("input")).alias("f1"))


@query("met_accuracy", f"select count(*) filter (where {strip('lower(coalesce(output, chr(32)))')} = {strip('lower(coalesce(input, chr(32)))')}) / count(*)::double as accuracy from instructions")
def _(s, d):
    return table(s, d, "instructions").agg((F.count_if(metrics.exact_match(F.col("output"), F.col("input"))) / F.count("*")).alias("accuracy"))


@query("met_chars")
def _(s, d):
    return table(s, d, "instructions").select("pair_id", metrics.char_fscore(F.col("output"), F.col("input")).alias("score"))


@query("met_perplexity", "select script, exp(least(avg(quality_score), 20.0)) as perplexity from documents where quality_score is not null group by script")
def _(s, d):
    return docs(s, d).where("quality_score is not null").groupBy("script").agg(metrics.perplexity(F.col("quality_score")).alias("perplexity"))


@query("met_distinct", f"select count(distinct g) / count(*)::double as distinct_2 from (select unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as g from (select {PW} as w from instructions))")
def _(s, d):
    w = text.words(F.lower("output"))
    grams = table(s, d, "instructions").select(w.alias("w")).where("size(w) > 1").select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.element_at("w", i), F.element_at("w", i + 1)))).alias("g"))
    counts = grams.groupBy("g").agg(F.count("*").alias("n"))
    return counts.agg((F.count("*") / F.sum("n")).alias("distinct_2"))


@query("met_verbatim", "select item_id from bench_items i where length(text) >= 30 and exists (select 1 from documents d where contains(d.text, i.text))")
def _(s, d):
    """Items that stand letter by letter in a document: found by a 30-character hash at each line or sentence start first."""
    items = table(s, d, "bench_items").where("length(text) >= 30").select("item_id", F.col("text").alias("item"))
    held = F.broadcast(items) if items.limit(100_001).count() <= 100_000 else items
    starts = F.regexp_extract_all("text", F.lit(r"(?s)(?=(.{30}))."), F.lit(1))
    grams = docs(s, d).where("text is not null").select("doc_id", F.explode(F.array_distinct(starts)).alias("g"))
    hits = grams.join(held.withColumn("g", F.substring("item", 1, 30)), "g").select("doc_id", "item_id", "item").distinct()
    return docs(s, d).select("doc_id", "text").join(hits, "doc_id").where("contains(text, item)").select("item_id").distinct()


@query("met_cosine", "select a.vec_id as a, b.vec_id as b from (select * from embeddings where vec_id % 50 = 0) a, embeddings b where a.vec_id <> b.vec_id qualify row_number() over (partition by a.vec_id order by round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 9) desc, b.vec_id) <= 3")
def _(s, d):
    """The three nearest of all vectors for every query vector, whose id is divisible by 50; queries go in blocks."""
    rows = table(s, d, "embeddings").select("vec_id", "embedding")
    q = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("a"), F.col("embedding").alias("e"))
    block = F.pmod(F.xxhash64("a"), F.lit(16))
    both = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(15)))).join(q.withColumn("block", block.cast("int")), "block").where("a <> vec_id")
    near = both.select("a", F.col("vec_id").alias("b"), F.round(metrics.cosine(F.col("e"), F.col("embedding")), 9).alias("c"))
    # the best three of each part of the rows first, then of the parts
    part = Window.partitionBy("a", F.pmod(F.xxhash64("b"), F.lit(8))).orderBy(F.desc("c"), "b")
    few = near.withColumn("r", F.row_number().over(part)).where("r <= 3")
    return few.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("c"), "b"))).where("r <= 3").select("a", "b")


@query("met_hallucination", "select count(*) filter (where contains(lower(coalesce(output, '')), 'i am not sure') or contains(lower(coalesce(output, '')), 'however, factually') or length(coalesce(output, '')) > 4 * length(coalesce(input, ''))) as flagged from instructions")
def _(s, d):
    return table(s, d, "instructions").agg(F.count_if(evaluation.hallucinated(F.col("output"), F.col("input"))).alias("flagged"))


@query("met_self", f"with t as (select pair_id, w, count(*) as n from (select pair_id, unnest({PW}) as w from instructions) group by pair_id, w), o as (select w, count(*) > 1 as others from t group by w) select avg(s) as self_overlap from (select 100.0::double * sum(case when others then n else 0 end) / sum(n) as s from t join o using (w) group by pair_id)")
def _(s, d):
    return evaluation.self_overlap(table(s, d, "instructions"), "pair_id", "output")


@query("met_bands", "select category, case when acc >= 85 then 'ideal' when acc >= 65 then 'acceptable' else 'failed' end as band from (select category, 100.0 * avg((output = input)::int) as acc from instructions where output is not null and input is not null group by category)")
def _(s, d):
    acc = table(s, d, "instructions").where("output is not null and input is not null").groupBy("category").agg((100.0 * F.avg((F.col("output") == F.col("input")).cast("int"))).alias("v"))
    return evaluation.banded(acc.withColumn("metric", F.lit("accuracy")), "metric", "v").select("category", "band")


@query("ben_held_out", "select row_id from corpus_rows where split = 'test' and length(text) >= 30 order by row_id limit 1000")
def _(s, d):
    return evaluation.held_out(table(s, d, "corpus_rows").where("split = 'test'"), "text", "row_id").select("row_id")


@query("ben_noised")
def _(s, d):
    return table(s, d, "bench_items").where("length(text) <= 300").select("item_id", evaluation.noised(F.col("text"), F.col("item_id")).alias("noisy_text"), F.col("text").alias("target_clean_text"))


@query("xlt_pairs")
def _(s, d):
    return evaluation.parallel_pairs(docs(s, d), "text", "doc_id")


# sampling and sources
@query("str_extracted", f"select doc_id from documents where length({strip('text')}) between 10 and 100000 and (language is null or language in ('mni', 'bn'))")
def _(s, d):
    return sampling.extracted(docs(s, d), languages=("mni", "bn"), language="language").select("doc_id")


@query("str_sources", "select source, count(*) as rows, sum(strlen(text))::bigint as bytes, sum(length(text))::bigint as chars from (select source, text from corpus_rows union all select source, text from incoming_rows) group by source")
def _(s, d):
    both = table(s, d, "corpus_rows").unionByName(table(s, d, "incoming_rows"), allowMissingColumns=True)
    return sampling.acquisition(both, ["source"])


@query("str_probabilities", "select name, p / sum(p) over () as p from (select name, pow(coalesce(weight, 0.1) * case when languages[1] = 'mni' then 2.0 else 1.0 end, 1 / 0.7::double) as p from source_catalog)")
def _(s, d):
    return sampling.probabilities(table(s, d, "source_catalog"), F.col("weight"), "languages", {"mni": 2.0}, 0.7).select("name", "p")


@query("str_quota")
def _(s, d):
    shares = sampling.probabilities(table(s, d, "source_catalog"), F.col("weight"), "languages").select(F.col("name").alias("source"), "p")
    return sampling.quota(docs(s, d), shares, "source", "doc_id", 500).select("doc_id", "source")


@query("str_round_robin", "select doc_id, row_number() over (partition by source order by doc_id) as turn from documents")
def _(s, d):
    return sampling.round_robin(docs(s, d), "source", "doc_id").select("doc_id", "turn")


@query("str_acquired", f"select source, language, count(*) as rows, sum(strlen(text))::bigint as bytes, sum({nwords(T)})::bigint as words, round(sum({nwords(T)}) / count(*)::double, 1) as average, round(count(*) / (sum(count(*)) over ())::double, 4) as share from documents group by source, language")
def _(s, d):
    rows = docs(s, d).select("source", "language", "text", text.word_count(F.col("text")).alias("w"))
    return rows.groupBy("source", "language").agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"), F.sum("w").alias("words"), F.round(F.sum("w") / F.count("*"), 1).alias("average")).withColumn("share", F.round(F.col("rows") / F.sum("rows").over(Window.partitionBy()), 4))


@query("src_scan_gates", "select page_id, case when quality is null or quality = 0 then 1.0 else quality / 100 end::double as quality_score from ocr_pages where (ocr_confidence is null or ocr_confidence >= 50) and (quality is null or quality >= 65)")
def _(s, d):
    from tessera.sources.readers import scan_gates

    return scan_gates(table(s, d, "ocr_pages")).select("page_id", F.col("quality_score").cast("double").alias("quality_score"))


@query("src_sidecar", "select doc_id, coalesce(nullif(license, ''), nullif(c_license, ''), 'unknown') as license from documents left join (select name as source, license as c_license from source_catalog) using (source)")
def _(s, d):
    from tessera.sources.readers import with_sidecar

    side = table(s, d, "source_catalog").select(F.col("name").alias("source"), "license")
    return with_sidecar(docs(s, d).select("doc_id", "source", "license"), side, "source", ["license"], {"license": "unknown"}).select("doc_id", "license")


@query("pln_corpus")
def _(s, d):
    return presets.corpus(docs(s, d)).select("doc_id", "chunk_id", "total_chunks", "language", "script", "quality_score", "text")


@query("pln_funnel")
def _(s, d):
    return presets.funnel(docs(s, d))


@query("evt_windows", "select event_type, (date_trunc('hour', ts))::timestamp as start, count(*) as n from events group by 1, 2")
def _(s, d):
    w = table(s, d, "events").groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"))
    return w.select("event_type", F.col("w.start").alias("start"), "n")
