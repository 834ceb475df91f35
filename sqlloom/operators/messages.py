"""Chat messages: assembly and rendering."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, functions as F

from sqlloom.functions.text import strip, text_or_empty
from sqlloom.functions.tokens import TURN_END, TURN_START
from sqlloom.options import ADVANCED_REASONING, PromptOptions


def user_message(question: Column, schema: Column, template: str) -> Column:
    """The template is cut up once, here; values are only concatenated, so braces inside them
    mean nothing."""
    values = {"question": strip(text_or_empty(question)), "schema": strip(text_or_empty(schema))}
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(values[name])
    return strip(F.concat(*parts))


def system_prompt(options: PromptOptions, format_name: str) -> str:
    if format_name == ADVANCED_REASONING:
        return options.reasoning_system_prompt.strip()
    return options.direct_system_prompt.strip()


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def prompt_messages(
    question: Column, schema: Column, options: PromptOptions, format_name: str
) -> Column:
    """System and user message: what a model is asked at inference time."""
    return F.array(
        _message("system", F.lit(system_prompt(options, format_name))),
        _message("user", user_message(question, schema, options.user_template)),
    )


def assistant_content(
    sql: Column, options: PromptOptions, explanation: Column | None = None
) -> Column:
    answer = strip(text_or_empty(sql))
    if not options.include_explanation or explanation is None:
        return answer
    reasoned = F.concat(
        F.lit("Reasoning:\n"), strip(explanation), F.lit("\n\nFinal SQL:\n"), answer
    )
    return F.when(text_or_empty(explanation) != "", reasoned).otherwise(answer)


def training_messages(
    question: Column,
    schema: Column,
    sql: Column,
    options: PromptOptions,
    explanation: Column | None = None,
    format_name: str | None = None,
) -> Column:
    """System, user, assistant, in this order."""
    asked = prompt_messages(question, schema, options, format_name or options.train_format)
    return F.concat(asked, F.array(_message("assistant", assistant_content(sql, options, explanation))))


def without_answer(messages: Column) -> Column:
    return F.slice(messages, 1, F.size(messages) - 1)


def render_turn(role: Column, content: Column) -> Column:
    """One turn between its two markers."""
    return F.concat(F.lit(TURN_START), role, F.lit("\n"), content, F.lit(f"{TURN_END}\n"))


def render_chat(messages: Column, add_generation_prompt: bool = False) -> Column:
    text = F.array_join(F.transform(messages, lambda m: render_turn(m["role"], m["content"])), "")
    return F.concat(text, F.lit(f"{TURN_START}assistant\n")) if add_generation_prompt else text
