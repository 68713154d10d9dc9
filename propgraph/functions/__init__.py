"""Column-level building blocks: ids, predicates, text parsing."""

from .ids import key_id, key_text, to_int
from .predicates import equals, is_blank, not_blank, not_both_blank
from .text import (clean_keyword, github_parts, keyword_tokens, person_and_email,
                   py_strip, strip_chars, top_level_domain, url_features)

__all__ = [
    "key_id", "key_text", "to_int", "equals", "is_blank", "not_blank", "not_both_blank",
    "clean_keyword", "github_parts", "keyword_tokens", "person_and_email",
    "py_strip", "strip_chars", "top_level_domain", "url_features",
]
