"""Row formatters: heterogeneous rows as one text column. Each is a column expression, listed by name in FORMATTERS."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain(text: Column) -> Column:
    """Trimmed text, '' where there is none."""
    return F.trim(F.coalesce(text, F.lit("")))


def first_text(*candidates: Column) -> Column:
    """First of the candidate fields that is present, '' else."""
    return F.coalesce(*candidates, F.lit(""))


def conversation(messages: Column) -> Column:
    """role: content of every message with content, a line each; messages ARRAY<STRUCT<role, content>>."""
    kept = F.filter(messages, lambda m: F.trim(F.coalesce(m["content"], F.lit(""))) != "")
    return F.array_join(F.transform(kept, lambda m: F.concat(F.coalesce(m["role"], F.lit("user")), F.lit(": "), F.trim(m["content"]))), "\n")


def turns(contents: Column) -> Column:
    """Contents of turns without roles; contents ARRAY<STRING>."""
    return F.array_join(F.filter(F.transform(contents, lambda x: F.trim(x)), lambda x: x != ""), "\n")


def single_message(role: Column, text: Column) -> Column:
    return F.concat(F.coalesce(role, F.lit("user")), F.lit(": "), plain(text))


def code(language: Column, text: Column) -> Column:
    """Code with a line that names its language where known."""
    return F.when(F.coalesce(language, F.lit("")) != "", F.concat(F.lit("# language: "), language, F.lit("\n"), plain(text))).otherwise(plain(text))


def tagged_chat(contents: Column, system: Column | None = None, end: str = "<|end|>") -> Column:
    """Tagged blocks with alternating user and assistant roles, an optional system block first, and an end sign."""
    blocks = F.transform(contents, lambda x, i: F.concat(F.when(i % 2 == 0, F.lit("<|user|>")).otherwise(F.lit("<|assistant|>")), F.trim(x), F.when(i % 2 == 0, F.lit("<|/user|>")).otherwise(F.lit("<|/assistant|>"))))
    body = F.array_join(blocks, "\n")
    if system is not None:
        body = F.when(F.coalesce(system, F.lit("")) != "", F.concat(F.lit("<|system|>"), F.trim(system), F.lit("<|/system|>\n"), body)).otherwise(body)
    return F.concat(body, F.lit("\n" + end))


def instruction_answer(instruction: Column, context: Column, answer: Column, system: Column | None = None) -> Column:
    """Question and Answer blocks; only the part that exists where the other is missing."""
    parts = [F.nullif(plain(c), F.lit("")) for c in ([system] if system is not None else []) + [instruction, context]]
    q = F.concat_ws("\n", *parts)
    a = plain(answer)
    return F.when((q != "") & (a != ""), F.concat(F.lit("Question: "), q, F.lit("\n\nAnswer: "), a)).when(q != "", q).otherwise(a)


def question_answers(title: Column, answers: Column) -> Column:
    """Title and first answer; answers ARRAY<STRING>."""
    return instruction_answer(title, F.lit(None).cast("string"), F.try_element_at(answers, F.lit(1)))


FORMATTERS: dict[str, Callable[..., Column]] = {
    "plain": plain, "conversation": conversation, "turns": turns, "message": single_message, "code": code,
    "tagged_chat": tagged_chat, "instruction_qa": instruction_answer, "stack_exchange": question_answers,
}
