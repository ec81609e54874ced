"""Queries of the task builders: conversations, templates, row checks, parallel records, grades, pipeline statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import chat, metrics, quality, text
from tessera.operators import tokenizers
from tessera.plans.queries import LATIN, NORMAL, REASON, T, count, docs, nwords, query, strip
from tessera.plans.shared import table

N = "chr(10)"
I, P, O = "coalesce(instruction, '')", "coalesce(input, '')", "coalesce(output, '')"  # noqa: E741
PROMPT = f"'{chat.SYSTEM_PROMPT}'"
FORMS = {  # as SQL: a message of a role with its content
    "qwen": lambda r, c: f"'<|im_start|>{r}' || {N} || {c} || '<|im_end|>' || {N}",
    "llama": lambda r, c: f"'<|start_header_id|>{r}<|end_header_id|>' || {N} || {N} || {c} || '<|eot_id|>'",
    "gemma": lambda r, c: f"'<start_of_turn>{'model' if r == 'assistant' else 'user'}' || {N} || {c} || '<end_of_turn>' || {N}",
    "mistral": lambda r, c: f"'[INST] ' || {c} || ' [/INST]'" if r == "user" else f"' ' || {c} || '</s>'",
    "generic": lambda r, c: f"'<{r}>' || {N} || {c} || {N}",
}


def part(form: str, role: str, content: str) -> str:
    """SQL: a message, or nothing where its content is empty."""
    return f"case when {content} = '' then '' else {FORMS[form](role, strip(content))} end"


ASK = f"case when {strip(P)} = '' then {strip(I)} else {strip(I)} || {N} || {N} || 'Context:' || {N} || {strip(P)} end"


def from_tasks(form: str) -> str:
    return f"select pair_id, {FORMS[form]('system', PROMPT)} || {part(form, 'user', '(' + ASK + ')')} || {part(form, 'assistant', '(' + strip(O) + ')')} as chat from instructions where ({ASK}) <> ''"


def shown(s, d, messages: Column, form: str = "qwen"):
    rows = table(s, d, "instructions").select("pair_id", messages.alias("m")).where("m is not null")
    return rows.select("pair_id", (chat.plainly(F.col("m")) if form == "plain" else chat.rendered(F.col("m"), form)).alias("chat"))


for _form in FORMS:

    @query(f"cht_{_form}", from_tasks(_form))
    def _(s, d, form=_form):
        return shown(s, d, chat.from_instruction(F.col("instruction"), F.col("input"), F.col("output")), form)


@query("cht_plain", f"select pair_id, {strip(FORMS['generic']('system', PROMPT) + ' || ' + part('generic', 'user', '(' + ASK + ')') + ' || ' + part('generic', 'assistant', '(' + strip(O) + ')'))} as chat from instructions where ({ASK}) <> ''")
def _(s, d):
    return shown(s, d, chat.from_instruction(F.col("instruction"), F.col("input"), F.col("output")), "plain")


def turns(who: str, what: str, *pairs: tuple[str, str]) -> Column:
    return F.array(*[F.struct(F.lit(r).alias(who), F.col(c).alias(what)) for r, c in pairs])


LEAD = FORMS["qwen"]("system", PROMPT)
SHAREGPT = f"{LEAD} || {part('qwen', 'user', I)} || {part('qwen', 'assistant', O)}"
ULTRACHAT = f"{LEAD} || {part('qwen', 'user', I)} || {part('qwen', 'assistant', P)} || {part('qwen', 'user', O)}"
SINGLE = f"{LEAD} || {part('qwen', 'user', I)}"
STANDARD = f"case when {P} = '' then {LEAD} else {FORMS['qwen']('system', strip(P))} end || {part('qwen', 'user', I)} || {part('qwen', 'assistant', O)}"


@query("cht_sharegpt", f"select pair_id, {SHAREGPT} as chat from instructions where {I} <> ''")
def _(s, d):
    return shown(s, d, chat.conversation(turns("from", "value", ("human", "instruction"), ("nobody", "input"), ("GPT ", "output"))))


@query("cht_ultrachat", f"select pair_id, {ULTRACHAT} as chat from instructions where {I} <> '' or {O} <> ''")
def _(s, d):
    return shown(s, d, chat.from_alternating(F.array("instruction", "input", "output")))


@query("cht_openassistant", f"select pair_id, {SINGLE} as chat from instructions where {I} <> '' and category is not null")
def _(s, d):
    return shown(s, d, chat.from_message(F.when(F.col("category").isNull(), "bot").otherwise("prompter"), F.col("instruction")))


@query("cht_standard", f"select pair_id, {STANDARD} as chat from instructions where {I} <> ''")
def _(s, d):
    return shown(s, d, chat.conversation(turns("role", "content", ("sys", "input"), ("user", "instruction"), ("assistant", "output")), "role", "content"))


DETECTED = f"""select pair_id, case k when 0 then {SHAREGPT} when 1 then {FORMS['qwen']('system', PROMPT)} || {part('qwen', 'user', '(' + ASK + ')')} || {part('qwen', 'assistant', '(' + strip(O) + ')')} when 2 then {ULTRACHAT} when 3 then {SINGLE} else {STANDARD} end as chat
 from (select *, pair_id % 5 as k from instructions) where case k when 0 then {I} <> '' when 1 then instruction is not null and output is not null and ({ASK}) <> '' when 2 then {I} <> '' or {O} <> '' when 3 then {I} <> '' else {I} <> '' end"""


@query("cht_detected", DETECTED)
def _(s, d):
    """Every pair as a record of one of the five formats by its number, told apart by the fields alone."""
    k = F.col("pair_id") % 5
    only = lambda n, c: F.when(k == n, c)
    record = {
        "conversations": only(0, turns("from", "value", ("human", "instruction"), ("gpt", "output"))),
        "instruction": only(1, F.col("instruction")),
        "input": only(1, F.col("input")),
        "output": only(1, F.col("output")),
        "data": only(2, F.array("instruction", "input", "output")),
        "role": only(3, F.lit("prompter")),
        "text": only(3, F.col("instruction")),
        "messages": only(4, turns("role", "content", ("system", "input"), ("user", "instruction"), ("assistant", "output"))),
    }
    return shown(s, d, chat.any_conversation(record))


@query("val_tasks", f"select count(*) as n, count(*) filter (where {I} <> '' and {O} <> '') as instruction, count(*) filter (where {I} <> '' and {P} <> '') as translation, count(*) filter (where {O} <> '') as pretraining, count(*) filter (where {I} <> '' or {O} <> '') as chat from instructions")
def _(s, d):
    i, p, o = F.col("instruction"), F.col("input"), F.col("output")
    valid = {"instruction": chat.task_valid("instruction", i, o), "translation": chat.task_valid("translation", i, p), "pretraining": chat.task_valid("pretraining", o), "chat": chat.task_valid("chat", turns("role", "content", ("user", "instruction"), ("assistant", "output")))}
    return table(s, d, "instructions").agg(F.count("*").alias("n"), *[F.count_if(v).alias(k) for k, v in valid.items()])


@query("val_trainable", "select source, count(*) as rows, sum(length(text))::bigint as chars, count(*) >= 100 and sum(length(text)) >= 10000 as trainable from documents where trim(coalesce(text, '')) <> '' group by source")
def _(s, d):
    return tokenizers.trainable(docs(s, d), ["source"])


@query("xlt_records", f"select row_id, {strip('text')} as mni, {strip('english_parallel')} as en from corpus_rows where {nwords(T)} > 0 and {nwords('coalesce(english_parallel, chr(32))')} > 0 and {nwords('coalesce(english_parallel, chr(32))')} / {nwords(T)} between 0.25 and 4.0")
def _(s, d):
    rows = table(s, d, "corpus_rows").where(metrics.pair_valid(F.col("text"), F.col("english_parallel")))
    return rows.select("row_id", text.strip(F.col("text")).alias("mni"), text.strip(F.col("english_parallel")).alias("en"))


GRADED = "select source, avg(quality_score) * 60 as p, avg((text is null)::int) as u, avg((language is null)::int) as w from documents group by source"


@query("met_grades", f"select source, case when u > 0.05 or w > 0.3 or p > 100 then 'C' when p <= 20 and w < 0.05 and u = 0 then 'A+' when p <= 50 and w < 0.1 then 'A' when p <= 100 then 'B' else 'B+' end as grade from ({GRADED})")
def _(s, d):
    rate = lambda c: F.avg(F.col(c).isNull().cast("int"))
    rows = docs(s, d).groupBy("source").agg((F.avg("quality_score") * 60).alias("p"), rate("text").alias("u"), rate("language").alias("w"))
    return rows.select("source", metrics.grade(F.col("p"), F.col("w"), F.col("u")).alias("grade"))


REASONS = ("empty", "corrupted_unicode", "only_punctuation", "only_numbers", "repeated_chars")


@query("agg_pipeline", f"select count(*) as processed, count(*) filter (where {NORMAL} <> text) as unicode_fixed, {', '.join(f'count(*) filter (where reason = {chr(39)}{r}{chr(39)}) as {r}' for r in REASONS)}, round(avg(length(text)), 2) as average, min(length(text)) as least, max(length(text)) as most, round(100.0::double * (count(text) - count(distinct text)) / count(*), 2) as duplicate_pct from (select *, {REASON} as reason from (select text, string_split(text, '') as l from documents))")
def _(s, d):
    t = F.col("text")
    rows = docs(s, d).select("text", text.normalise(t).alias("fixed"), quality.reject_reason(t).alias("reason"), F.length("text").alias("n"))
    return rows.agg(F.count("*").alias("processed"), F.count_if(F.col("fixed") != t).alias("unicode_fixed"), *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS], F.round(F.avg("n"), 2).alias("average"), F.min("n").alias("least"), F.max("n").alias("most"), F.round(100.0 * (F.count("text") - F.count_distinct(F.sha2("text", 256))) / F.count("*"), 2).alias("duplicate_pct"))


@query("str_targets", "select language, count(*) as sources, round(sum(weight), 6) as weight from (select unnest(languages) as language, weight from source_catalog) group by language")
def _(s, d):
    rows = table(s, d, "source_catalog").select(F.explode("languages").alias("language"), "weight")
    return rows.groupBy("language").agg(F.count("*").alias("sources"), F.round(F.sum("weight"), 6).alias("weight"))


@query("scr_latin_share", f"select script, round(avg(case when length({T}) > 0 then {count(T, LATIN)} / length({T})::double else 0 end), 4) as latin from documents group by script")
def _(s, d):
    t = F.coalesce(F.col("text"), F.lit(""))
    share = F.when(F.length(t) > 0, F.regexp_count(t, F.lit("[a-zA-Z]")) / F.length(t)).otherwise(0.0)
    return docs(s, d).groupBy("script").agg(F.round(F.avg(share), 4).alias("latin"))
