"""Strings of which a text that a Java pattern finds something in must hold one: they are looked for first, as that is much cheaper."""

from __future__ import annotations

import re
from functools import cache

MOST = 20  # strings a pattern
_CLASS = re.compile(r"\[\^?(?:[^\\\[\]&]|\\.)+\]")
_SIGN = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|x\{([0-9A-Fa-f]+)\}|([^\w\s]))")
_KIND = re.compile(r"\\(?:[dDwWsS]|[pP]\{\w+\})")
_QUANTIFIER = re.compile(r"(?:[?*+]|\{(\d+)(?:,\d*)?\})[?+]?")


def guard(c: str, p: str) -> str | None:
    """SQL that is false only where the pattern finds nothing in a text; null where there is none to look for."""
    found = needed(p)
    if not found:
        return None
    low = f"lower({c})" if p.startswith(("(?i", "(?mi")) else c
    return " OR ".join(f"contains({low}, '{x}')" for x in sorted(found))


@cache
def needed(p: str) -> frozenset[str] | None:
    m = re.match(r"\(\?([a-zA-Z]+)\)", p)
    if m and not set(m[1]) <= set("ims"):
        return None
    body = p[m.end() :] if m else p
    try:
        found = _either(body)
    except ValueError:
        return None
    if m and "i" in m[1] and found:
        found = {x.lower() for x in found}
    return frozenset(found) if found and len(found) <= MOST else None


def _close(s: str, at: int) -> int:
    """Place behind the group that opens at a place."""
    depth, k = 0, at
    while k < len(s):
        if s[k] == "\\":
            k += 2
            continue
        if s[k] == "[":
            k = _behind(_CLASS, s, k)
            continue
        depth += (s[k] == "(") - (s[k] == ")")
        k += 1
        if depth == 0:
            return k
    raise ValueError(s)


def _behind(what: re.Pattern, s: str, at: int) -> int:
    m = what.match(s, at)
    if not m:
        raise ValueError(s)
    return m.end()


def _either(s: str) -> set[str] | None:
    """Of the alternatives of a pattern; none where one needs nothing."""
    parts, start, k = [], 0, 0
    while k < len(s):
        if s[k] == "(":
            k = _close(s, k)
        elif s[k] == "[":
            k = _behind(_CLASS, s, k)
        elif s[k] == "\\":
            k += 2
        else:
            if s[k] == "|":
                parts.append(s[start:k])
                start = k + 1
            k += 1
    sets = [_row(x) for x in [*parts, s[start:]]]
    return set().union(*sets) if all(sets) else None


def _row(s: str) -> set[str] | None:
    """Of a row of signs, classes and groups: the part that needs the longest strings."""
    options: list[set[str]] = []
    run, k = "", 0
    while k < len(s):
        if s.startswith((r"\b", "^", "$"), k):
            k += 2 if s[k] == "\\" else 1
            continue
        sign, group = None, None
        if s[k] == "(":
            end = _close(s, k)
            if s[k + 1] != "?":
                group = _either(s[k + 1 : end - 1])
            elif s.startswith("(?:", k):
                group = _either(s[k + 3 : end - 1])
            elif not s.startswith(("(?=", "(?!", "(?<=", "(?<!"), k):
                raise ValueError(s)
        elif s[k] == "[":
            end = _behind(_CLASS, s, k)
        elif s[k] == "\\":
            if m := _SIGN.match(s, k):
                end, sign = m.end(), m[3] or chr(int(m[1] or m[2], 16))
            else:
                end = _behind(_KIND, s, k)
        elif s[k] in "|)*+?{}]":
            raise ValueError(s)
        else:
            end, sign = k + 1, None if s[k] == "." else s[k]
        if sign is not None and (sign in "'\\" or not sign.isascii() and sign.isalpha()):
            sign = None
        q = _QUANTIFIER.match(s, end)
        optional = bool(q) and (q[0][0] in "?*" or q[1] is not None and int(q[1]) == 0)
        if sign is not None and not optional:
            run += sign
        if sign is None or q:
            options.append({run})
            run = ""
        if group and not optional:
            options.append(group)
        k = q.end() if q else end
    options.append({run})
    useful = [x for x in options if all(len(y) > 1 or y and not y.isalnum() and not y.isspace() and y not in ".,-:" for y in x)]
    return max(useful, key=lambda x: (min(map(len, x)), -len(x)), default=None)
