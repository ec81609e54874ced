"""Column functions: conversations, prompts and labels. A conversation is array<struct<role, content>>."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import strip

# Fixed values.
USER, ASSISTANT, SYSTEM = ("human", "user", "prompter", "qu"), ("gpt", "assistant", "bot", "ai", "model"), ("system", "sys")
SYSTEM_PROMPT = "You are a helpful assistant."
# By template, what a message of a role turns into ("" stands for any other role), and the mark that asks for
# an answer.
TEMPLATES = {
    "qwen": ({"": "<|im_start|>{role}\n{content}<|im_end|>\n"}, "<|im_start|>assistant\n"),
    "llama": ({"": "<|start_header_id|>{role}<|end_header_id|>\n\n{content}<|eot_id|>"}, "<|start_header_id|>assistant<|end_header_id|>\n\n"),
    "gemma": ({"assistant": "<start_of_turn>model\n{content}<end_of_turn>\n", "model": "<start_of_turn>model\n{content}<end_of_turn>\n", "": "<start_of_turn>user\n{content}<end_of_turn>\n"}, "<start_of_turn>model\n"),
    "mistral": ({"user": "[INST] {content} [/INST]", "": " {content}</s>"}, ""),
    "generic": ({"": "<{role}>\n{content}\n"}, ""),
}


def role(c: Column, unknown: str | None = None) -> Column:
    """user, assistant or system for any of their names; others as `unknown`, null by default."""
    low = F.lower(strip(c))
    return F.when(low.isin(*USER), "user").when(low.isin(*ASSISTANT), "assistant").when(low.isin(*SYSTEM), "system").otherwise(F.lit(unknown))


def settled(messages: Column, prompt: str | None = SYSTEM_PROMPT) -> Column:
    """Messages (role, content) of known roles, a system prompt in front unless the first is one; null without a user."""
    known = F.filter(messages, lambda m: m["role"].isNotNull() & (F.coalesce(m["content"], F.lit("")) != ""))
    known = F.transform(known, lambda m: F.struct(m["role"].alias("role"), strip(m["content"]).alias("content")))
    lead = F.array(F.struct(F.lit("system").alias("role"), F.lit(prompt).alias("content")))
    full = F.when(F.lit(prompt is not None) & (F.get(known, F.lit(0))["role"] != "system"), F.concat(lead, known)).otherwise(known)
    return F.when(F.exists(known, lambda m: m["role"] == "user"), full)


def conversation(turns: Column, who: str = "from", what: str = "value", prompt: str | None = SYSTEM_PROMPT, lenient: bool = False) -> Column:
    """The conversation in an array of turns; turns of unknown roles or without content are left out (lenient: an unknown
    role is the user's)."""
    return settled(F.transform(turns, lambda t: F.struct(role(t[who], "user" if lenient else None).alias("role"), t[what].alias("content"))), prompt)


def from_instruction(instruction: Column, extra: Column, output: Column, prompt: str | None = SYSTEM_PROMPT) -> Column:
    """The conversation in an instruction, its context and a response; null columns are empty."""
    bare = lambda x: strip(F.coalesce(x, F.lit("")))
    ask = F.when(bare(extra) == "", bare(instruction)).otherwise(F.concat(bare(instruction), F.lit("\n\nContext:\n"), bare(extra)))
    turns = F.array(F.struct(F.lit("user").alias("role"), ask.alias("content")), F.struct(F.lit("assistant").alias("role"), bare(output).alias("content")))
    return settled(turns, prompt)


def from_alternating(texts: Column, prompt: str | None = SYSTEM_PROMPT) -> Column:
    """The conversation in an array of strings, the user's first and every other one."""
    return settled(F.transform(texts, lambda t, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), t.alias("content"))), prompt)


def from_message(who: Column, what: Column, prompt: str | None = SYSTEM_PROMPT) -> Column:
    """The conversation of a single message: null unless it is a user's."""
    return settled(F.array(F.struct(role(who).alias("role"), what.alias("content"))), prompt)


def source_format(columns: dict[str, Column]) -> Column:
    """sharegpt, alpaca, ultrachat, openassistant, standard or unknown, by the fields of a record that aren't null."""
    has = lambda *names: F.lit(True) if not names else _all([columns[n].isNotNull() if n in columns else F.lit(False) for n in names])
    return (
        F.when(has("conversations"), "sharegpt")
        .when(has("instruction") & (has("output") | has("response")), "alpaca")
        .when(has("data"), "ultrachat")
        .when(has("role", "text"), "openassistant")
        .when(has("messages"), "standard")
        .otherwise("unknown")
    )


def _all(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def any_conversation(columns: dict[str, Column], prompt: str | None = SYSTEM_PROMPT) -> Column:
    """The conversation of a record in whichever of the five formats its fields show."""
    kind = source_format(columns)
    got = lambda *names: F.coalesce(*[columns[n] for n in names if n in columns], F.lit(None).cast("string"))
    out = F.when(kind == "alpaca", from_instruction(got("instruction"), got("input", "context"), got("output", "response"), prompt))
    if "conversations" in columns:
        out = out.when(kind == "sharegpt", conversation(columns["conversations"], prompt=prompt))
    if "data" in columns:
        out = out.when(kind == "ultrachat", from_alternating(columns["data"], prompt))
    if "messages" in columns:
        out = out.when(kind == "standard", conversation(columns["messages"], "role", "content", prompt))
    return out.when(kind == "openassistant", from_message(got("role"), got("text"), prompt))


def rendered(messages: Column, template: str, prompt_only: bool = False) -> Column:
    """One string; with prompt_only the mark that asks for an answer at the end."""
    forms, lead = TEMPLATES[template]

    def filled(form: str, m: Column) -> Column:
        parts = []
        for piece in re.split(r"(\{role\}|\{content\})", form):
            parts.append(m[piece[1:-1]] if piece in ("{role}", "{content}") else F.lit(piece))
        return F.concat(*parts)

    def one(m: Column) -> Column:
        out = filled(forms[""], m)
        for k, form in forms.items():
            out = F.when(m["role"] == k, filled(form, m)).otherwise(out) if k else out
        return out

    text = F.array_join(F.transform(messages, one), "")
    return F.concat(text, F.lit(lead)) if prompt_only else text


def plainly(messages: Column) -> Column:
    """Rendering without a template: <user>, <assistant> or the role's own name before each content."""
    name = lambda r: F.when(r.isin("user", "human"), "user").when(r.isin("assistant", "gpt"), "assistant").otherwise(r)
    line = lambda m: F.concat(F.lit("<"), name(F.lower(m["role"])), F.lit(">\n"), m["content"], F.lit("\n"))
    return strip(F.array_join(F.transform(messages, line), ""))


def task_valid(kind: str, a: Column, b: Column | None = None) -> Column:
    """Whether a row has what its task needs: instruction (instruction, output), translation (source, target), pretraining
    (text), chat (messages, one of them with content). Empty strings count as missing, blanks don't."""
    some = lambda x: F.coalesce(x != "", F.lit(False))
    if kind == "chat":
        return F.coalesce(F.exists(a, lambda m: some(m["content"])), F.lit(False))
    return some(a) if kind == "pretraining" else some(a) & some(b)


def prompt(kind: str, a: Column, b: Column | None = None, c: Column | None = None, prompt_only: bool = False) -> Column:
    """translation (source, target), instruction (instruction, input, output) or pretraining (text) as one string."""
    end = lambda x: F.lit("") if prompt_only or x is None else F.coalesce(x, F.lit(""))
    if kind == "translation":
        return F.concat(F.lit("Translate:\n"), a, F.lit("\n\nTranslation:\n"), end(b))
    if kind == "instruction":
        extra = F.when(F.coalesce(strip(b), F.lit("")) == "", F.lit("")).otherwise(F.concat(F.lit("\n\n### Input:\n"), b))
        return F.concat(F.lit("### Instruction:\n"), a, extra, F.lit("\n\n### Response:\n"), end(c))
    return a


def labels(ids: Column, prompt_length: Column, ignore: int = -100) -> Column:
    """The ids with those of the prompt masked."""
    k = F.least(prompt_length, F.size(ids))
    return F.concat(F.array_repeat(F.lit(ignore), k), F.slice(ids, k + 1, F.greatest(F.size(ids) - k, F.lit(0))))
