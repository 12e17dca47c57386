"""Texts cut into chunks of bounded size at the joints of their structure."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamstone.functions.arrow import flat_map

FENCE = re.compile(r"```.*?(?:```|\Z)|\$\$.*?(?:\$\$|\Z)", re.DOTALL)
BLANK = re.compile(r"\n[ \t]*\n+")
HEADING = re.compile(r"^(?:#{1,6} |={2,}.+={2,}$)")
SENTENCE = re.compile(r"(?<=[.!?。！？])\s+")


def blocks(text: str) -> list[str]:
    """Blocks between blank lines; fenced code and formulas are one block each, a heading stays with what follows it."""
    out: list[str] = []
    at = 0
    for m in [*FENCE.finditer(text), None]:
        plain = text[at : m.start() if m else len(text)]
        out += [p.strip() for p in BLANK.split(plain) if p.strip()]
        if m:
            out.append(m[0])
            at = m.end()
    joined: list[str] = []
    for b in out:
        if joined and HEADING.match(joined[-1].rsplit("\n", 1)[-1]):
            joined[-1] += "\n\n" + b
        else:
            joined.append(b)
    return joined


def pieces(block: str, size: int) -> list[str]:
    """A block above the size cut at sentences, and a sentence above it at the size; code and formulas stay whole."""
    if len(block) <= size or FENCE.match(block):
        return [block]
    out: list[str] = []
    for s in SENTENCE.split(block):
        for k in range(0, len(s), size):
            part = s[k : k + size]
            if out and len(out[-1]) + 1 + len(part) <= size:
                out[-1] += " " + part
            else:
                out.append(part)
    return out


def segment(text: str | None, max_tokens: int = 3000, chars_per_token: int = 4, overlap: float = 0.12, least: float = 0.2) -> list[str]:
    """Chunks of at most max_tokens, packed greedily from blocks in order.

    A chunk after the first begins with the last sentences of the one before,
    up to the overlap; a tail below `least` of the size goes to the chunk
    before it. Null and blank texts have no chunks.
    """
    if text is None or not text.strip():
        return []
    size = max_tokens * chars_per_token
    groups: list[list[str]] = [[]]
    used = 0
    for b in (p for block in blocks(text) for p in pieces(block, size)):
        if groups[-1] and used + 2 + len(b) > size:
            groups.append([])
            used = 0
        groups[-1].append(b)
        used += len(b) + 2
    if len(groups) > 1 and sum(map(len, groups[-1])) < least * size:
        tail = groups.pop()
        groups[-1] += tail
    bodies = ["\n\n".join(g) for g in groups]
    out = bodies[:1]
    for before, body in zip(bodies, bodies[1:]):
        head = ""
        for s in reversed(SENTENCE.split(before.rsplit("\n\n", 1)[-1])):
            if len(head) + len(s) + 1 > overlap * size or FENCE.search(s):
                break
            head = f"{s} {head}".strip()
        out.append(f"{head}\n\n{body}" if head else body)
    return out


def chunked(docs: DataFrame, max_tokens: int = 3000, overlap: float = 0.12) -> DataFrame:
    """(doc_id, chunk, chunks, text) of docs (doc_id, text): one narrow pass."""

    def one(i, t):
        parts = segment(t, max_tokens, overlap=overlap)
        return [(i, k, len(parts), p) for k, p in enumerate(parts)]

    return flat_map(docs.select("doc_id", F.col("text")), lambda: one, "doc_id long, chunk int, chunks int, text string")
