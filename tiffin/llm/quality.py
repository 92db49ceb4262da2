"""Quality rules with repeated passages found by suffix arrays over words.

Texts of a batch stand one after another, each word numbered within its text, so
that no suffix of one text equals a part of another. Prefix doubling sorts the
suffixes: those still tied on their first 2^k words are sorted by the ranks of what
follows, the others are done. The common prefix of a suffix with the one before it in the
order is compared word by word only where the words in front of the two differ; elsewhere it is
one shorter than that of the suffix in front. So all lengths are exact, and no level of ranks is
kept. A suffix's longest repeat is the larger of its two common prefixes, the top of the LCP
intervals that hold it; the union of these spans is what maximal repeated passages cover.

Memory: about 60 bytes a word of one slice of texts (about 1 million characters, or a single
longer text), whatever repeats in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import map_texts

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def word_numbers(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, equal for equal words, and where each text starts (with the end)."""
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
    flat = lists.flatten()
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(filled)])
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    words = flat.filter(pa.array(filled)).dictionary_encode().indices.to_numpy()
    return words, before[offsets]


def _group_starts(keys: np.ndarray) -> np.ndarray:
    """For sorted keys, the place of the first equal one."""
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    return np.maximum.accumulate(np.where(new, np.arange(len(keys), dtype=np.int32), np.int32(0)))


def _suffix_array(first: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling from ``place``, sorted by their first words' ranks ``first``."""
    n, width, rank = len(first), 1, first.copy()
    while True:
        sorted_rank = rank[place]
        same = sorted_rank[1:] == sorted_rank[:-1]
        at = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same])).astype(np.int32)
        if not len(at):
            return place
        key = sorted_rank[at].astype(np.int64) * (n + 1)
        del sorted_rank, same
        tied = place[at]
        inside = tied < n - width
        key[inside] += rank[tied[inside] + width].astype(np.int64) + 1
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        del by
        place[at] = tied  # a tied group keeps its places in the order
        rank[tied] = at[_group_starts(key)]
        width *= 2


def _matching(words: np.ndarray, a: np.ndarray, b: np.ndarray, at_once: int = 1 << 18) -> np.ndarray:
    """Length of the common prefix of each pair of suffixes, compared word by word in widening blocks."""
    n, width = len(words), 8
    out = np.zeros(len(a), dtype=np.int32)
    live = np.arange(len(a))
    while len(live):
        still, step, steps = [], max(1, at_once // width), np.arange(width, dtype=np.int32)
        for s in range(0, len(live), step):
            part = live[s : s + step]
            x, y = (a[part] + out[part])[:, None] + steps, (b[part] + out[part])[:, None] + steps
            same = (words[np.minimum(x, n - 1)] == words[np.minimum(y, n - 1)]) & (np.maximum(x, y) < n)
            run = np.where(same.all(axis=1), width, same.argmin(axis=1))
            out[part] += run.astype(np.int32)
            still.append(part[run == width])
        live, width = np.concatenate(still), min(2 * width, at_once)
    return out


def longest_repeats(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest passage from it on that its text holds twice or more."""
    n = len(words)
    if n < 2:
        return np.zeros(n, dtype=np.int32)
    key = np.repeat(np.arange(len(starts) - 1) * (int(words.max()) + 1), np.diff(starts)) + words
    place = np.argsort(key, kind="stable").astype(np.int32)
    first = np.empty(n, dtype=np.int32)
    first[place] = _group_starts(key[place])
    del key
    place = _suffix_array(first, place)
    before = np.full(n, -1, dtype=np.int32)  # the suffix that stands before each one in the order
    before[place[1:]] = place[:-1]
    del place
    # Where the words in front agree too, the suffix in front has this common prefix and a word more.
    follows = before[1:] >= 1
    follows &= first[:-1] == first[np.maximum(before[1:], 1) - 1]
    heads = np.flatnonzero(np.concatenate([[True], ~follows])).astype(np.int32)
    own = np.zeros(len(heads), dtype=np.int32)
    paired = before[heads] >= 0
    own[paired] = _matching(first, heads[paired], before[heads[paired]])
    run = np.diff(np.append(heads, np.int32(n)))
    common = np.repeat(own + heads, run) - np.arange(n, dtype=np.int32)
    longest = common.copy()
    after = np.flatnonzero(before >= 0)
    longest[before[after]] = np.maximum(longest[before[after]], common[after])
    return longest


def covered(spans: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Words of each text in the union of spans: ``spans[i]`` words from word i on."""
    n = len(spans)
    change = np.zeros(n + 1, dtype=np.int32)
    at = np.flatnonzero(spans)
    np.add.at(change, at, 1)
    np.add.at(change, at + spans[at], -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(change[:-1], dtype=np.int32) > 0)])
    return np.diff(inside[starts])


def _most(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(starts) - 1, dtype=np.int64)
    filled = np.flatnonzero(np.diff(starts))
    if len(filled):
        out[filled] = np.maximum.reduceat(values, starts[:-1][filled])
    return out


def _duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return len(lines) - len(set(lines))


def measures(texts: list, least_repeat: int, window: int = 3) -> dict[str, np.ndarray]:
    """Base measures and repetition of each text; null is empty."""
    texts = [t or "" for t in texts]
    words, starts = word_numbers(texts)
    longest = longest_repeats(words, starts)
    return {
        "n_words": np.diff(starts),
        "word_chars": np.array([len(t) - sum(map(t.count, WHITE)) for t in texts], dtype=np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], dtype=np.int64),
        "n_dup_lines": np.array([_duplicate_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": covered(np.where(longest >= window, window, 0), starts),
        "repeat_covered": covered(np.where(longest >= least_repeat, longest, 0), starts),
        "longest_repeat": _most(longest, starts),
    }


def judged(
    docs: DataFrame,
    keep: list[str],
    least_repeat: int = 10,
    most_covered: float = 0.3,
    most_repeat: int = 200,
    least_words: int = 50,
) -> DataFrame:
    """``keep`` columns with the measures of each whole ``text`` and the verdict.

    base_failed: fewer than ``least_words`` words, or over half of the words in
    three-word windows that repeat. kept: not base_failed, passages of ``least_repeat``
    words or more that repeat within the text cover at most ``most_covered`` of its
    words, and none is longer than ``most_repeat`` words.

    A null or wordless text has zeros and fails. Repeated rows are judged alike, an
    empty table gives no rows, other columns are ignored unless kept.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "repeat_covered", "longest_repeat"]
    made = map_texts(
        docs, keep, "text", ", ".join(f"{n} long" for n in names), lambda: lambda texts: measures(texts, least_repeat), 1_000_000
    )
    n = F.col("n_words")
    failed = (n < least_words) | (F.col("n_repeat_words") * 100 > n * 50)
    clean = (F.col("repeat_covered") <= n * F.lit(most_covered)) & (F.col("longest_repeat") <= most_repeat)
    return made.withColumn("base_failed", failed).withColumn("kept", ~failed & clean)
