"""Line-first cleaning: rules per line, failures removed, documents that lose too much text rejected."""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import SPACE, texts

SYMBOLS = b"#*$%&|<>"
#: White space and UTF-8 continuation bytes; what is left are the code points of words.
NOT_COUNTED = SPACE + bytes(range(0x80, 0xC0))
#: What may end a line of prose.
TERMINAL = (".", "!", "?", '"', "'", ")", ":", ";", ",", "…", "”", "’", "»")
#: Words that only part the entries of menus, crumb trails and tables.
SEPARATORS = (b"|", b"||", b">", b">>", "»".encode(), "›".encode(), "·".encode(), "•".encode(), b"/")
#: Phrases of page furniture.
PHRASES = (
    "all rights reserved", "privacy policy", "terms of use", "terms of service", "cookie policy", "use of cookies", "uses cookies", "accept cookies",
    "enable javascript", "javascript is disabled", "click here", "read more", "sign in", "sign up", "log in", "subscribe to", "lorem ipsum",
    "skip to content", "back to top", "share this", "powered by",
)


@dataclass(frozen=True)
class Rules:
    """Shares are of a line's words.

    ``heading``: a line of fewer words must end like prose. ``symbols``: most characters of
    ``SYMBOLS``, and most ``!!``, per word. ``stutter``: share of words equal to the one before, from
    ``heading`` words on. ``furniture``: a phrase fails a line of up to so many words.
    ``separators``: share of separator words, at least two, that makes navigation.
    ``lost``: a document that loses more than this share of its words is rejected.
    """

    heading: int = 4
    symbols: float = 0.3
    separators: float = 0.2
    stutter: float = 0.5
    furniture: int = 25
    lost: float = 0.4


_PHRASE = re.compile("|".join(PHRASES).encode())
_ENDS = tuple(t.encode() for t in TERMINAL)


def line_fails(line: bytes, words: list[bytes], rules: Rules) -> bool:
    """Whether a line with at least one word breaks a punctuation, navigation or boilerplate rule."""
    n = len(words)
    if n < rules.heading and not words[-1].endswith(_ENDS):
        return True
    if len(line) - len(line.translate(None, SYMBOLS)) > rules.symbols * n or line.count(b"!!") > rules.symbols * n:
        return True
    if n >= rules.heading and sum(map(operator.eq, words, words[1:])) > rules.stutter * n:
        return True
    parts = sum(map(words.count, SEPARATORS)) if any(s in line for s in SEPARATORS) else 0
    if parts >= 2 and parts > rules.separators * n:
        return True
    return n <= rules.furniture and _PHRASE.search(line.lower()) is not None


def repeated_words(words: list[bytes], window: int = 8) -> int:
    """Words that lie in a window of ``window`` words which the text has twice or more, the first one included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    code = np.zeros(n, np.uint64)
    for i in range(window):
        code = code * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    flat = np.sort(code)
    if not (flat[1:] == flat[:-1]).any():
        return 0
    order = np.argsort(code, kind="stable")
    flat = code[order]
    group = np.r_[0, np.cumsum(flat[1:] != flat[:-1])]
    first = order[np.r_[True, flat[1:] != flat[:-1]]][group]
    seen = np.zeros(n, bool)
    for a, b in zip(first[order != first].tolist(), order[order != first].tolist(), strict=True):
        if words[a : a + window] != words[b : b + window]:  # two windows under one code: count by the words themselves
            places: dict[tuple, list[int]] = {}
            for i in range(n):
                places.setdefault(tuple(words[i : i + window]), []).append(i)
            seen[[i for p in places.values() if len(p) > 1 for i in p]] = True
            break
        seen[a] = seen[b] = True
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(seen)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def clean(text: bytes, rules: Rules) -> tuple[tuple, bytes]:
    """The counts of a text, whether its bulk fails, whether it is kept, its words lost; and the lines that stay."""
    seen: set[bytes] = set()
    stay, words, copies, lost = [], [], 0, 0
    for line in text.split(b"\n"):
        w = line.split()
        if not w:
            continue
        words += w
        if line in seen:
            copies += 1
            lost += len(w)
            continue
        seen.add(line)
        if line_fails(line, w, rules):
            lost += len(w)
        else:
            stay.append(line)
    n = len(words)
    repeated = repeated_words(words)
    failed = n < 20 or 100 * repeated > 30 * n
    counts = (n, len(text.translate(None, NOT_COUNTED)), len(text) - len(text.translate(None, SYMBOLS)), copies, repeated)
    return (*counts, failed, not failed and lost <= rules.lost * n, lost), b"\n".join(stay)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lost_words")


def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def clean_sql(rules: Rules = Rules()) -> str:
    """The same counts and verdict in DuckDB."""
    last = f"list_contains([{_list(TERMINAL)}], right(ws[-1], 1))"
    parts = " + ".join(f"len(list_filter(ws, lambda x: x = {_list([s.decode()])}))" for s in SEPARATORS)
    stutter = "len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1]))"
    phrase = "lower(line), '" + "|".join(PHRASES) + "'"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
wins AS (SELECT doc_id, i, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS s FROM words),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM wins WHERE len(s) = 8),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat FROM twice, range(8) AS r(k) WHERE n > 1 GROUP BY doc_id),
cut AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS i FROM d),
lines AS (SELECT doc_id, i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM cut),
judged AS (
  SELECT doc_id, len(ws) AS n, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS copy,
    (len(ws) < {rules.heading} AND NOT {last})
    OR length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) > {rules.symbols} * len(ws)
    OR (length(line) - length(replace(line, '!!', ''))) / 2 > {rules.symbols} * len(ws)
    OR (len(ws) >= {rules.heading} AND {stutter} > {rules.stutter} * len(ws))
    OR ({parts} >= 2 AND {parts} > {rules.separators} * len(ws))
    OR (len(ws) <= {rules.furniture} AND regexp_matches({phrase})) AS bad
  FROM lines WHERE len(ws) > 0),
lost AS (SELECT doc_id, count(*) FILTER (copy) AS copies, coalesce(sum(n) FILTER (copy OR bad), 0) AS lost FROM judged GROUP BY doc_id),
base AS (
  SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(copies, 0) AS n_dup_lines,
    coalesce(n_repeat, 0) AS n_repeat_words, coalesce(lost, 0) AS n_lost_words
  FROM w LEFT JOIN lost USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_lost_words <= {rules.lost} * n_words AS kept, n_lost_words::BIGINT AS n_lost_words
FROM base
"""


def clean_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Rules = Rules(), with_text: bool = True) -> DataFrame:
    """``key``, the columns ``NAMES`` and, if asked for, ``cleaned``: one row for each row of ``docs``.

    Words are runs of anything but ASCII white space; lines end at ``\\n``. A line equal to an
    earlier one of its text, and a line that breaks a rule, is removed; ``kept`` is false when the
    text fails as a whole (under 20 words, or over 30 % repeated) or loses more than ``rules.lost``.
    A null text has no words: counts 0, failed, cleaned to an empty text. Repeated rows and null
    keys give a row each; an empty table gives an empty one. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [clean(t, rules) for t in texts(b.column(1))]
            out = [pa.array([x[0][i] for x in found], pa.bool_() if i in (5, 6) else pa.int64()) for i in range(len(NAMES))]
            more = [pa.array([x[1] for x in found], pa.binary()).cast(pa.string())] if with_text else []
            yield pa.RecordBatch.from_arrays([b.column(0), *out, *more], names=[key, *NAMES, *["cleaned"] * with_text])

    kinds = ", ".join(f"{n} {'boolean' if i in (5, 6) else 'long'}" for i, n in enumerate(NAMES))
    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, {kinds}" + ", cleaned string" * with_text)


def keep_clean(docs: DataFrame, text: str = "text", length: str = "n_chars", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns; the text is the cleaned one and ``length`` follows it."""
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [clean(t, rules) for t in texts(b.column(at))]
            stay = pa.array([x[0][6] for x in found], pa.bool_())
            cols = [pa.array([x[1] for x in found], pa.binary()).cast(pa.string()) if i == at else c for i, c in enumerate(b.columns)]
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(stay)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn(length, F.char_length(text).cast("long")) if length in names else out
