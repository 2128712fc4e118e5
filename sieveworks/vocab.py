"""Vocabularies and limits of the listing rules, as parameter objects with the default values."""

from __future__ import annotations

from dataclasses import dataclass

# Terms, patterns, phrases and limits that results depend on.
EMPLOYMENT_TERMS = r"fractional|contract|part[- ]time|part time|interim|advisory|retainer|full[- ]time|hourly|hrs?/w|hours per week|freelance|consultant"
ROLE_WORDS = r"engineer|developer|programmer|designer|scientist|architect|analyst|researcher|manager|management|director|founding|head of|lead\b|leader|devops|sre\b|tpm\b|\bpm\b|cto\b|cpo\b|vp\b|specialist|consultant|roles?\b|position|hiring|intern\b"
METADATA_FIELD = r"(remote|onsite|on-site|hybrid|anywhere|worldwide)\b|(full|part)[\s-]?time\b|(contract|freelance|permanent|intern)\b|\$|[\d,.]+\s*k?\s*[-–]|yc[\s(]|[swfx]\d{2}\b"
URL_FIELD = r"(https?://|www\.)"
TIER1_PHRASES = ("first technical program manager", "our second tpm", "establish the program management function", "build out our tpm practice", "first tpm hire")
ROLE_TERM = r"technical program manager|program management|\btpm\b"
FOUNDATION_TERM = r"\bfirst\b|\bsecond\b|\bfounding\b|\bestablish\b|\bbuild out\b|\bstand up\b|\bfrom scratch\b|\b0 to 1\b|\bno one in this role\b"
HEAD_CHARS, THREAD_HEAD_CHARS, SNIPPET_CHARS = 400, 600, 1200
COMPANY_CHARS, TITLE_CHARS, ERROR_CHARS = 80, 100, 500
WINDOW_CHARS, CHUNK_ROWS, SCORE_FLOOR = 200, 50, 35
VERDICTS = ("match", "no_match")
STAGES = ("fetch", "fetch_ats", "normalize", "prefilter", "dedupe", "classify", "score", "digest")


@dataclass(frozen=True)
class SnippetRules:
    """How a description becomes a snippet."""

    terms: str = EMPLOYMENT_TERMS
    head: int = HEAD_CHARS
    cap: int = SNIPPET_CHARS


@dataclass(frozen=True)
class RoleRules:
    """Which field of a header names the role."""

    roles: str = ROLE_WORDS
    metadata: str = METADATA_FIELD
    urls: str = URL_FIELD
    cap: int = TITLE_CHARS


@dataclass(frozen=True)
class PhraseRules:
    """Phrases that suffice, and two families of terms that must stand close."""

    phrases: tuple[str, ...] = TIER1_PHRASES
    role: str = ROLE_TERM
    foundation: str = FOUNDATION_TERM
    window: int = WINDOW_CHARS
