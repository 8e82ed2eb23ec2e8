"""Run parameters: given values first, then the environment, then defaults."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from mentionflow.operators.health import STRIKES, WAIT
from mentionflow.operators.match import clean_keywords
from mentionflow.sources.rules import DEFAULT_RULES, Rule

log = logging.getLogger(__name__)

# Fallbacks of a run.
DEFAULT_KEYWORDS = ("news", "policy", "technology")
DEFAULT_MAX_PER_KEYWORD = 50
DEFAULT_LANG = "id"
DEFAULT_OUTPUT_DIR = "output"

#: Source families that can be run alone. Reviews are web content but not part of the web family.
FAMILIES = ("x", "web", "instagram", "tiktok", "youtube", "ecommerce")


@dataclass(frozen=True)
class RunConfig:
    keywords: tuple[str, ...] = DEFAULT_KEYWORDS
    max_per_keyword: int = DEFAULT_MAX_PER_KEYWORD
    families: frozenset[str] = frozenset(FAMILIES)
    lang: str = DEFAULT_LANG
    output_dir: str = DEFAULT_OUTPUT_DIR
    table_dir: str | None = None
    database: Mapping[str, str] | None = None
    rules: tuple[Rule, ...] = field(default=DEFAULT_RULES)
    #: Bad runs in a row that leave a source out, and runs it is left out before it is tried again.
    strikes: int = STRIKES
    wait: int = WAIT


def families_of(choice: str | None) -> frozenset[str]:
    """The families a choice stands for; an unknown choice means all of them."""
    name = (choice or "all").strip().lower()
    if name in FAMILIES:
        return frozenset({name})
    if name != "all":
        log.warning("unknown source choice %r, running all", choice)
    return frozenset(FAMILIES)


def _positive(raw: str | None, default: int) -> int:
    try:
        number = int(raw) if raw else default
    except ValueError:
        number = 0
    if number < 1:
        log.warning("not a positive number: %r, using %d", raw, default)
        return default
    return number


def resolve_config(given: Mapping[str, Any] | None = None, environ: Mapping[str, str] | None = None) -> RunConfig:
    """Configuration from given values (wrong ones are errors) over environment values (wrong ones are ignored)."""
    given, environ = dict(given or {}), dict(environ or {})
    listed = environ.get("KEYWORDS", "")
    keywords = clean_keywords(listed.split(",")) if listed.strip(", \t") else list(DEFAULT_KEYWORDS)
    if given.get("keywords") is not None:
        words = given["keywords"]
        keywords = clean_keywords(words.split(",") if isinstance(words, str) else words)
    limit = _positive(environ.get("X_MAX_RESULTS"), DEFAULT_MAX_PER_KEYWORD)
    if given.get("max_per_keyword") is not None:
        limit = int(given["max_per_keyword"])
        if limit < 1:
            raise ValueError("max_per_keyword must be a positive number")
    output_dir = environ.get("OUTPUT_DIR", DEFAULT_OUTPUT_DIR)
    if given.get("output_dir") is not None:
        output_dir = given["output_dir"].strip()
        if not output_dir:
            raise ValueError("output_dir must not be empty")
    choice = given.get("source")
    if choice is not None and choice not in ("all", *FAMILIES):
        raise ValueError(f"unknown source choice {choice!r}")
    return RunConfig(
        keywords=tuple(keywords),
        max_per_keyword=limit,
        families=families_of(choice or environ.get("SOURCE")),
        lang=given.get("lang") or DEFAULT_LANG,
        output_dir=output_dir,
        table_dir=given.get("table_dir"),
        database=given.get("database"),
        rules=tuple(given.get("rules") or DEFAULT_RULES),
        strikes=int(given.get("strikes") or STRIKES),
        wait=int(given.get("wait") or WAIT),
    )
