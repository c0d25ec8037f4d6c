"""Line-first cleaning and the verdict on what is left.

Each line is judged by itself: it must end like a sentence or be long enough
(punctuation), must not be a list of links (navigation) and must not consist of
stock phrases (boilerplate: whole words that make up ``PHRASE_SHARE`` percent of the
line's words). Lines that fail are removed; a document that loses more
than ``max_lost`` percent of its bytes is rejected, as is one that fails the
base figures (too few words, or too many words in repeated windows).

NULL and empty texts have no words and fail. Equal rows get equal results; an
empty table gives an empty result. Other columns are left out of the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salespipe.llm.texts import WORD, column, distinct, shingles, slices

# Symbols counted, sentence ends, navigation marks and stock phrases.
SYMBOLS = b"#*$%&|<>"
SENTENCE_ENDS = (".", "!", "?", '"', "'", ")", "…", ":", ";")
NAVIGATION = (" | ", " > ", " » ", "home |", "skip to", "next page", "previous page", "read more", "click here")
BOILERPLATE = (
    "cookie", "cookies", "terms of use", "terms of service", "privacy policy", "all rights reserved", "javascript",
    "copyright ©", "sign up", "log in", "subscribe", "lorem ipsum",
)

MIN_WORDS = 20
MAX_REPEATED = 30
WINDOW = 8
MIN_LINE_WORDS = 10
NAVIGATION_MARKS = 2
PHRASE_SHARE = 10
MAX_LOST = 50

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_lines long, n_lines_removed long, n_bytes long, n_bytes_removed long, "
    "cleaned_text string, kept boolean"
)


_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def bordered(phrase: str) -> str:
    """A pattern of the phrase as whole words; borders are those of ASCII letters and digits."""
    ends = [r"\b" if c.isascii() and c.isalnum() else "" for c in (phrase[0], phrase[-1])]
    return ends[0] + phrase + ends[1]


_PHRASES = [(re.compile(bordered(p), re.ASCII), len(p.split(" "))) for p in BOILERPLATE]


def line_fails(line: str) -> str | None:
    """The rule that a line with a word fails, or None."""
    text = line.strip(" \t\n\x0b\x0c\r")
    low = text.lower()
    n_words = len(_WORDS.findall(text))
    if any(phrase in low for phrase in BOILERPLATE):
        stock = sum(size * len(phrase.findall(low)) for phrase, size in _PHRASES)
        if stock and 100 * stock >= PHRASE_SHARE * n_words:
            return "boilerplate"
    if any(low.startswith(mark) for mark in NAVIGATION if mark[0] != " ") or (
        sum(low.count(mark) for mark in NAVIGATION if mark[0] == " ") >= NAVIGATION_MARKS
    ):
        return "navigation"
    if not text.endswith(SENTENCE_ENDS) and n_words < MIN_LINE_WORDS:
        return "punctuation"
    return None


def clean(text: str) -> tuple[str, int, int]:
    """The text without failed lines, the number of lines with a word, and of those removed."""
    kept, lines, removed = [], 0, 0
    for line in text.split("\n"):
        if not line.strip(" \t\n\x0b\x0c\r"):
            kept.append(line)
            continue
        lines += 1
        if line_fails(line):
            removed += 1
        else:
            kept.append(line)
    return ("\n".join(kept) if removed else text), lines, removed


def _base(part) -> dict[str, np.ndarray]:
    data, n = part.data, part.n
    inside = WORD[data]
    starts, ends, docs = part.runs(inside)
    words = part.hashes(starts, ends)
    counts = np.bincount(docs, minlength=n)
    symbols = np.zeros(256, bool)
    symbols[list(SYMBOLS)] = True

    # Lines are the runs between newlines; a line counts if it has a word.
    line_starts, line_ends, line_docs = part.runs(data != 0x0A)
    total = np.concatenate(([0], np.cumsum(inside)))
    wordy = total[line_ends] > total[line_starts]
    lines, line_docs = part.hashes(line_starts, line_ends)[wordy], line_docs[wordy]
    different = np.bincount(distinct(lines, line_docs)[1], minlength=n)

    repeated = np.zeros(len(words) + 1, np.int64)
    long = counts >= WINDOW
    if long.any():
        chosen = long[docs]
        base = np.flatnonzero(chosen)
        hashed, owner = shingles(words[chosen], docs[chosen], n, WINDOW)
        order = np.lexsort((hashed, owner))
        equal = (hashed[order][1:] == hashed[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        twice = np.zeros(len(hashed), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        # The k-th window of a document starts at its k-th word.
        full = np.where(long, counts - WINDOW + 1, 0)
        firsts = np.concatenate(([0], np.cumsum(np.where(long, counts, 0))))[:-1]
        at = base[firsts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)]
        np.add.at(repeated, at[twice], 1)
        np.add.at(repeated, at[twice] + WINDOW, -1)
    covered = np.cumsum(repeated[:-1]) > 0
    return {
        "n_words": counts,
        "word_chars": part.sums(inside & ((data & 0xC0) != 0x80)),
        "n_symbols": part.sums(symbols[data]),
        "n_dup_lines": np.bincount(line_docs, minlength=n) - different,
        "n_repeat_words": np.bincount(docs[covered], minlength=n),
        "n_bytes": np.diff(part.at),
    }


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = column(batch, "doc_id"), column(batch, "text")
        for part in slices(texts):
            base = _base(part)
            failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEATED * base["n_words"])
            own = texts.slice(part.first, part.n)
            cleaned = [clean(t) if t is not None else (None, 0, 0) for t in own.to_pylist()]
            left = np.array([0 if t is None else len(t.encode()) for t, _, _ in cleaned], np.int64)
            lost = base["n_bytes"] - left
            kept = ~failed & (100 * lost <= MAX_LOST * base["n_bytes"])
            yield pa.RecordBatch.from_pydict({
                "doc_id": ids.slice(part.first, part.n), "n_words": base["n_words"], "word_chars": base["word_chars"],
                "n_symbols": base["n_symbols"], "n_dup_lines": base["n_dup_lines"],
                "n_repeat_words": base["n_repeat_words"], "base_failed": failed,
                "n_lines": np.array([x[1] for x in cleaned], np.int64),
                "n_lines_removed": np.array([x[2] for x in cleaned], np.int64),
                "n_bytes": base["n_bytes"], "n_bytes_removed": lost,
                "cleaned_text": pa.array([x[0] for x in cleaned], pa.string()), "kept": kept,
            })


def line_first(docs: DataFrame) -> DataFrame:
    """One row per document: base figures, the cleaned text and whether the document is kept."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(_judge, SCHEMA)
