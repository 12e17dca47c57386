"""Personal data, toxicity and licence signals of a text as column expressions: counts, risks, bands, redaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns that Java and RE2 read alike.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
PHONE = r"\+?\d[\d ().-]{8,16}\d"
CARD = r"\b\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}\b"
SECRET = r"(?i)\b(?:api[_-]?key|secret|token|password|passwd)\b\s*[:=]\s*\S{10,}"
TEMPLATE_EMAIL = r"@(?:example\.|domain\.|your)|\.tld\b"
EDUCATION = r"(?i)\b(?:example|sample|tutorial|documentation|for instance|lesson)\b"
INSULT = r"(?i)\b(?:idiot|stupid|moron|trash|pathetic|loser)\b"
THREAT = r"(?i)\b(?:kill you|hurt you|destroy you|you will pay)\b"
PROFANITY = r"(?i)\b(?:damn|crap|bloody hell)\b"
LICENCES = (
    ("cc-by-sa", r"(?i)\bcc[- ]by[- ]sa\b|creativecommons\.org/licenses/by-sa"), ("cc-by", r"(?i)\bcc[- ]by\b|creativecommons\.org/licenses/by/"), ("mit", r"(?i)\bmit licen[cs]e\b|SPDX-License-Identifier: MIT"),
    ("apache-2.0", r"(?i)\bapache licen[cs]e\b|Apache-2\.0"), ("gpl", r"(?i)\bgnu general public licen[cs]e\b|\bGPL"), ("public-domain", r"(?i)\bpublic domain\b"), ("proprietary", r"(?i)all rights reserved|without written consent|not permitted"),
)


def pii_risk(emails: Column, phones: Column, cards: Column, secrets: Column, benign: Column) -> Column:
    """Weighted risk in [0, 1]: the strongest kind by 0.85 and 0.05 for each item up to eight; halved in a benign context."""
    best = F.greatest(F.when(emails > 0, 0.6).otherwise(0.0), F.when(phones > 0, 0.55).otherwise(0.0), F.when(cards > 0, 0.9).otherwise(0.0), F.when(secrets > 0, 0.95).otherwise(0.0))
    n = emails + phones + cards + secrets
    risk = F.when(n > 0, F.least(F.lit(1.0), best * 0.85 + 0.05 * F.least(n, F.lit(8)))).otherwise(0.0)
    return F.when(benign, risk * 0.5).otherwise(risk)


def band(risk: Column) -> Column:
    return F.when(risk <= 0.20, "accept").when(risk < 0.60, "redact").when(risk < 0.95, "reject").otherwise("hard_reject")


def redact(c: Column) -> Column:
    """Secrets, cards, mailboxes and phone numbers replaced by their kind, in this order."""
    for pattern, kind in ((SECRET, "<SECRET>"), (CARD, "<CARD>"), (EMAIL, "<EMAIL>"), (PHONE, "<PHONE>")):
        c = F.regexp_replace(c, pattern, kind)
    return c


def licence(c: Column) -> Column:
    """First licence that the text names, in table order; unknown else."""
    e = F.when(c.rlike(LICENCES[0][1]), LICENCES[0][0])
    for name, pattern in LICENCES[1:]:
        e = e.when(c.rlike(pattern), name)
    return e.otherwise("unknown")
