"""Line-first cleaning: judge every line, drop the failures, then reject texts that lost too much.

A line fails when it
- repeats an earlier line of its text (``repeat``),
- is a menu: every fourth word or more is a bare separator (``navigation``),
- is a notice on cookies, privacy or scripts, or a claim of rights: their phrases make up a quarter of its
  characters or more, so that a sentence that only mentions one stays (``boilerplate``),
- is noise: as many symbols as half its words, exclamation runs on half of them, or, from three
  words on, at least 10 upper-case letters, more than it has lower-case ones (``punctuation``),
- is long, from 12 words on, and holds no sentence mark at all (``punctuation``).

Lines without a word are dropped and count for nothing. A text is kept when its words number
``min_words`` or more, at most ``max_repeat`` percent of them lie in repeated 5-word windows, and the
failed lines hold at most ``max_loss`` percent of them. Null and empty texts have no words and are
rejected; their cleaned text is empty. Repeated rows are judged one by one; no other column is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW = 5
MIN_WORDS, MAX_REPEAT, MAX_LOSS = 10, 20, 50

# --- fixed values: marks and phrases of the rules ---------------------------------
BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
SEPARATORS = ("|", ">", "<", "/", "-", "*", "»", "›", "•", "·")
SENTENCE_MARKS = ".!?:;…。！？؟।"
BOILERPLATE = (
    "all rights reserved", "cookie policy", "we use cookies", "accept cookies", "privacy policy", "terms of use",
    "terms of service", "enable javascript", "javascript is disabled", "subscribe to our newsletter",
    "sign up for our newsletter", "skip to content", "powered by",
)
#: A line is a notice when its phrases, so many times over, are as long as the line.
NOTICE_SHARE = 4
REASONS = ("repeat", "navigation", "boilerplate", "punctuation")
SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_lines bigint, n_failed_lines bigint, lost_words bigint, repeat bigint, navigation bigint, "
    "boilerplate bigint, punctuation bigint, base_failed boolean, kept boolean, cleaned string"
)

_PHRASE = re.compile("|".join(map(re.escape, BOILERPLATE)))
_MARK = re.compile(f"[{re.escape(SENTENCE_MARKS)}]")


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text, first occurrences included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    index: dict = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    if len(index) == len(words):
        return 0
    key = ids[:n]
    for k in range(1, window):
        key = key * len(index) + ids[k : k + n]
        if k < window - 1 and len(index) ** (k + 2) >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            if (int(key.max()) + 1) * len(index) >= 1 << 62:
                raise OverflowError("text of over 2**31 words")
    _, at, count = np.unique(key, return_inverse=True, return_counts=True)
    marks = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(count[at] >= 2)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


def line_fault(line: str, words: list[bytes]) -> str | None:
    """The rule that a line breaks, if any. ``words`` are those of the line."""
    n = len(words)
    if 4 * sum(line.count(f" {s} ") for s in SEPARATORS) >= n:
        return "navigation"
    low = line.lower()
    if NOTICE_SHARE * (len(low) - len(_PHRASE.sub("", low))) >= len(low):
        return "boilerplate"
    if 2 * sum(map(line.count, SYMBOLS)) >= n or 2 * line.count("!!") >= n:
        return "punctuation"
    if n >= 3 and line != line.lower():
        upper = sum(c.isupper() for c in line)
        if upper >= 10 and upper > sum(c.islower() for c in line):
            return "punctuation"
    if n >= 12 and not _MARK.search(line):
        return "punctuation"
    return None


def judge(text: str, min_words: int, max_repeat: int, max_loss: int) -> tuple:
    words = text.encode().split()
    n, repeats = len(words), repeated_words(words)
    seen, kept_lines = set(), []
    n_lines = lost = duplicates = 0
    reasons = dict.fromkeys(REASONS, 0)
    for line in text.split("\n"):
        own = line.encode().split()
        if not own:
            continue
        n_lines += 1
        if line in seen:
            fault = "repeat"
            duplicates += 1
        else:
            seen.add(line)
            fault = line_fault(line, own)
        if fault:
            reasons[fault] += 1
            lost += len(own)
        else:
            kept_lines.append(line)
    failed = n < min_words or 100 * repeats > max_repeat * n
    return (
        n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), duplicates, repeats,
        n_lines, sum(reasons.values()), lost, *reasons.values(), failed, not failed and 100 * lost <= max_loss * n,
        "\n".join(kept_lines),
    )


def line_rules(
    text: Column | str, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT, max_loss: int = MAX_LOSS
) -> Column:
    """Measures, verdict and cleaned text of each text, as a struct of ``SCHEMA``."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    @F.pandas_udf(SCHEMA)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [judge(t, min_words, max_repeat, max_loss) for t in texts.fillna("")]
            yield pd.DataFrame(rows, columns=names)

    return judged.asNondeterministic()(text)
