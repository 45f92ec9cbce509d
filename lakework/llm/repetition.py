"""Quality rules on repetition: how many characters of a text lie inside n-grams and lines
that stood in it before.

The texts of a batch are measured together. The 64-bit hash of the n-gram at each word grows
from that of the (n-1)-gram there by one more word, so one pass rolls through all lengths;
the number of the text is mixed in, so one sort per length finds the repeated n-grams of all
texts. What they cover is the union of their later places, that is, what the text would lose
if each n-gram stood in it once. Counts are whole numbers of code points, and the rules compare
them by whole numbers.
"""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lakework.llm.common import chunks, share_code
from lakework.llm.shingles import WordHashes, mixed

#: Words that a text must have, and the most percent of them in repeated 3-word windows.
MIN_WORDS = 50
REPEAT_WINDOW, MAX_REPEAT_PERCENT = 3, 50
#: Percent of the characters of words that the n-gram which repeats most may fill, by length.
MAX_TOP = {2: 20, 3: 18, 4: 16}
#: Percent of the characters of words that n-grams which stood before may fill, by length.
MAX_COVERED = {5: 15, 7: 13, 10: 10}
#: Percent of the lines that may repeat an earlier one, and of characters in those.
MAX_LINES, MAX_LINE_CHARS = 30, 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_M1, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)
_HASHES = WordHashes()

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [
    *BASE, "n_chars", "n_lines", "dup_line_chars", *[f"top_{n}_chars" for n in MAX_TOP], *[f"dup_{n}_chars" for n in MAX_COVERED]]


def _characters(texts):
    """Per text: code points, those in words, symbols; and the code points of each word."""
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = _SPACE[data]
    point = (data & 0xC0) != 0x80
    points = np.concatenate((np.zeros(1, np.int64), np.cumsum(point)))
    inside = np.concatenate((np.zeros(1, np.int64), np.cumsum(point & ~space)))
    marks = np.concatenate((np.zeros(1, np.int64), np.cumsum(_SYMBOL[data])))
    # Words never touch: each text ends in a line break.
    last = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    words = np.diff(inside[last], prepend=0)
    return (np.diff(points[ends], prepend=0) - 1, np.diff(inside[ends], prepend=0),
            np.diff(marks[ends], prepend=0), words)


def _lines(text):
    """Lines with a word, those equal to an earlier one, and code points in the latter."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    different = set(lines)
    if len(different) == len(lines):
        return len(lines), 0, 0
    often = sum((n - 1) * len(line.decode()) for line, n in Counter(lines).items() if n > 1)
    return len(lines), len(lines) - len(different), often


def measure(texts):
    """``COUNTS`` of each text (bytes or None) as arrays, by name."""
    texts = [t or b"" for t in texts]
    found = {}
    found["n_chars"], found["word_chars"], found["n_symbols"], size = _characters(texts)
    words = [t.split() for t in texts]
    n_words = np.fromiter(map(len, words), np.int64, len(words))
    found["n_words"] = n_words
    found["n_lines"], found["n_dup_lines"], found["dup_line_chars"] = np.array(
        [_lines(t) for t in texts], dtype=np.int64).reshape(-1, 3).T
    each = _HASHES.of([w for t in words for w in t])
    text = np.repeat(np.arange(len(texts)), n_words)
    reach = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))  # code points of words before
    rolled = mixed((text.astype(np.uint64) + np.uint64(1)) * _STEP)
    for n in range(1, max(*MAX_TOP, *MAX_COVERED, REPEAT_WINDOW) + 1):
        places = max(0, len(each) - n + 1)
        rolled = mixed(rolled[:places] * _M1 + each[n - 1:] + _STEP)
        if n in MAX_TOP or n in MAX_COVERED or n == REPEAT_WINDOW:
            start = np.flatnonzero(text[:places] == text[n - 1:]) if places else np.zeros(0, np.int64)
            start, group, times, later = _repeated(rolled[start], start)
            if n in MAX_TOP:
                chars = times[group] * (reach[start + n] - reach[start])
                top = np.zeros(len(texts), np.int64)
                np.maximum.at(top, text[start], chars)
                found[f"top_{n}_chars"] = top
            if n == REPEAT_WINDOW:
                at = _covered(start, n, len(each))
                found["n_repeat_words"] = np.bincount(text[at], minlength=len(texts))
            if n in MAX_COVERED:
                at = _covered(start[later], n, len(each))
                found[f"dup_{n}_chars"] = np.bincount(
                    text[at], weights=size[at], minlength=len(texts)).astype(np.int64)
    return found


def _repeated(keys, start):
    """Places whose key occurs twice or more, their group, all groups' sizes, and which are
    not the first of their group."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(first) - 1
    times = np.bincount(group)
    often = np.flatnonzero(times[group] > 1)
    return start[order[often]], group[often], times, ~first[often]


def _covered(start, n, words):
    """The words inside any of the n-grams that begin at ``start``."""
    edges = np.bincount(start, minlength=words + 1) - np.bincount(start + n, minlength=words + 1)
    return np.flatnonzero(np.cumsum(edges[:-1]) > 0)


def _measured(batches):
    for batch in batches:
        for piece in chunks(batch, "text"):
            found = measure(piece.column("text").to_pylist())
            yield pa.record_batch(
                [piece.column("doc_id"), *[pa.array(found[c], pa.int64()) for c in COUNTS]],
                names=["doc_id", *COUNTS])


def quality(docs):
    """Base counts, ``base_failed`` and ``kept`` for every row of ``docs`` (``doc_id, text``).

    ``kept`` is false where the base rule fails or a repetition rule does: the n-gram which
    repeats most, all repeated n-grams of a length, repeated lines, or their characters fill
    more than the allowed share. Words are whole and case counts. Null and empty texts have
    no words and fail the base rule. Repeated rows and ids, null ids and other columns
    change nothing; an empty table gives no rows.
    """
    share_code(docs.sparkSession)
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        _measured, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))
    base = (F.col("n_words") < MIN_WORDS) | _over("n_repeat_words", MAX_REPEAT_PERCENT, "n_words")
    repeats = _over("n_dup_lines", MAX_LINES, "n_lines") | _over(
        "dup_line_chars", MAX_LINE_CHARS, "n_chars")
    for n, percent in MAX_TOP.items():
        repeats |= _over(f"top_{n}_chars", percent, "word_chars")
    for n, percent in MAX_COVERED.items():
        repeats |= _over(f"dup_{n}_chars", percent, "word_chars")
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~repeats).alias("kept"),
        *[c for c in COUNTS if c not in BASE])


def _over(part, percent, whole):
    return F.col(part) * 100 > F.col(whole) * percent


def quality_sql():
    """DuckDB SQL for the rows of ``quality`` over the table ``documents``."""
    lengths = sorted({*MAX_TOP, *MAX_COVERED, REPEAT_WINDOW})
    parts, joins, columns = [], [], []
    for n in lengths:
        parts.append(f"""
    g{n} as (select r, i, g, count(*) over (partition by r, g) as c,
            row_number() over (partition by r, g order by i) as place
        from (select r, unnest(range(1, len(w) - {n - 2})) as i,
                unnest(list_transform(range(1, len(w) - {n - 2}),
                    lambda i: array_to_string(w[i:i + {n - 1}], ' '))) as g
            from texts where len(w) >= {n})),
    t{n} as (select r, max(c * (length(g) - {n - 1})) as top from g{n} where c > 1 group by r),
    c{n} as (select r, sum(again::int) as n_again, sum(case when later then length(x) else 0 end) as chars
        from (select w.r, w.x,
                bool_or(coalesce(c > 1, false)) over reach as again,
                bool_or(coalesce(place > 1, false)) over reach as later
            from words w left join g{n} g on w.r = g.r and w.i = g.i
            window reach as (partition by w.r order by w.i rows between {n - 1} preceding and current row))
        group by r)""")
        joins.append(f" left join t{n} on t{n}.r = b.r left join c{n} on c{n}.r = b.r")
    columns += [f"coalesce(t{n}.top, 0)::bigint as top_{n}_chars" for n in MAX_TOP]
    columns += [f"coalesce(c{n}.chars, 0)::bigint as dup_{n}_chars" for n in MAX_COVERED]
    rules = [f"100 * n_dup_lines > {MAX_LINES} * n_lines", f"100 * dup_line_chars > {MAX_LINE_CHARS} * n_chars"]
    rules += [f"100 * top_{n}_chars > {p} * word_chars" for n, p in MAX_TOP.items()]
    rules += [f"100 * dup_{n}_chars > {p} * word_chars" for n, p in MAX_COVERED.items()]
    repeats = " or ".join(rules)
    return rf"""
    with texts as (
        select row_number() over () as r, doc_id, coalesce(text, '') as text,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
        from documents),
    words as (select r, unnest(range(1, len(w) + 1)) as i, unnest(w) as x from texts),
    lines as (select r, x, row_number() over (partition by r, x) as place
        from (select r, unnest(string_split(text, chr(10))) as x from texts)
        where regexp_matches(x, '[^\x20\x09-\x0D]')),
    repeated as (select r, count(*) as n_lines, count(*) filter (place > 1) as n_dup_lines,
        coalesce(sum(length(x)) filter (place > 1), 0) as dup_line_chars from lines group by r),
    base as (
        select t.r, doc_id, len(w)::bigint as n_words,
            length(array_to_string(w, ''))::bigint as word_chars,
            (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
            coalesce(n_dup_lines, 0)::bigint as n_dup_lines, length(text)::bigint as n_chars,
            coalesce(n_lines, 0)::bigint as n_lines, coalesce(dup_line_chars, 0)::bigint as dup_line_chars
        from texts t left join repeated l on t.r = l.r),{",".join(parts)},
    counted as (
        select b.*, coalesce(c{REPEAT_WINDOW}.n_again, 0)::bigint as n_repeat_words, {", ".join(columns)}
        from base b{"".join(joins)}),
    judged as (select *,
        n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from counted)
    select * exclude (r), not base_failed and not ({repeats}) as kept from judged
    """
