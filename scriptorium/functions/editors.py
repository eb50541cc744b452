"""Deterministic text editors usable as the transform callable (no model needed)."""

from __future__ import annotations

import re

_SPACE_BEFORE_PUNCT = re.compile(r"\s+([,.;:!?])")


def tidy_punctuation(text: str) -> str:
    """Remove whitespace before , . ; : ! ?"""
    return _SPACE_BEFORE_PUNCT.sub(r"\1", text)


def tidy_punctuation_factory():
    return tidy_punctuation


class CountingEditor:
    """``tidy_punctuation`` with call statistics; texts of a length divisible by 7 always time out, by 5 once."""

    def __init__(self):
        self.failed: set[str] = set()

    def __call__(self, text: str):
        if len(text) % 7 == 0 or len(text) % 5 == 0 and text not in self.failed:
            self.failed.add(text)
            raise TimeoutError("no answer")
        out = tidy_punctuation(text)
        self.failed.discard(text)
        return out, {"prompt_eval_count": len(text), "prompt_eval_duration": 2_000_000 * len(text), "eval_count": len(out), "eval_duration": 4_000_000 * len(out)}
