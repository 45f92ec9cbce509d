"""Phrase collocations: exact counts of phrases in HAT-tries, and how firmly they stick together.

Each task numbers its words and counts phrases in a trie that is shallow: the number of the
first word leads to a hash container of the rest, and a container that grows too large bursts
into one container per second word. When a worker holds too many phrases, its largest
subtrees are written out whole as runs sorted by words. Runs meet in one partition per prefix,
the first two words, where their counts are summed.

A phrase is as frequent as asked only if all pairs of words in it are. The first pass over the
texts therefore counts the words, and beside them 32-bit hashes of all pairs, packed into three
bytes a pair. A hash that occurs less often than asked belongs to no frequent pair. The others
reach the tasks of the second pass as a bitmap, whose size has a bound, and only phrases all of
whose pairs pass it are counted. Pairs that share a hash, or a bit, let phrases through that the
final count leaves out, so the result does not depend on the hashes.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakework.llm.common import chunks, cut, if_small, share_code, thrifty, width
from lakework.llm.shingles import mixed, word_hashes

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
#: Words counted together, and words that a task numbers at a time; numbers have 21 bits.
SLICE, NUMBERED, BITS = 1 << 19, 1 << 20, 21
#: Phrases in a container before it bursts, and in all tries of a worker before it spills.
BURST, HELD = 1 << 13, 1_000_000
#: Bits of the bitmap for each frequent hash, and for all of them at most (16 MB).
HASH_BITS, MAP_BITS = 64, 1 << 27
#: Hashes of pairs that a worker holds before it packs them; bits of a hash within its block.
HASHES, BLOCK_BITS = 1 << 23, 22
ROWS = 100_000

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_BREAK = b"\xff"  # in no UTF-8 text
_TABLE = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MASK = (1 << BITS) - 1
RUNS = "lang string, head string, phrase string, n long"
BLOCKS = "block int, sizes binary, lows binary, counts binary"


class HatTrie:
    """Counts of phrases of one length, as rows of word numbers.

    ``root``: number of the first word to a container, a dict from the other numbers (bytes)
    to a count, or to a dict of such containers by second word once it has burst.
    """

    def __init__(self, words):
        self.words, self.root, self.burst, self.size = words, {}, set(), 0

    def add(self, phrases, counts):
        """Rows of numbers, sorted and distinct, and how often each occurs."""
        if not len(phrases):
            return
        first = phrases[:, 0]
        rest = np.ascontiguousarray(phrases[:, 1:], dtype=">u4")
        rest = rest.view(f"V{4 * (self.words - 1)}").ravel().tolist()
        counts = counts.tolist()
        starts = np.flatnonzero(np.diff(first, prepend=-1))
        ends = np.append(starts[1:], len(first)).tolist()
        for word, i, j in zip(first[starts].tolist(), starts.tolist(), ends, strict=True):
            held = self.root.setdefault(word, {})
            if word in self.burst:
                for key, n in zip(rest[i:j], counts[i:j], strict=True):
                    self._count(held.setdefault(key[:4], {}), ((key[4:], n),))
            else:
                self._count(held, zip(rest[i:j], counts[i:j], strict=True))
                if len(held) > BURST and self.words > 2:
                    self._burst(word, held)

    def _count(self, held, found):
        before = len(held)
        for key, n in found:
            held[key] = held.get(key, 0) + n
        self.size += len(held) - before

    def _burst(self, word, held):
        parts = {}
        for key, n in held.items():
            parts.setdefault(key[:4], {})[key[4:]] = n
        self.root[word] = parts
        self.burst.add(word)

    def subtrees(self):
        """``(phrases, path, container)`` of every container; the path is its place."""
        for word, held in self.root.items():
            if word in self.burst:
                for second, part in held.items():
                    yield len(part), (word, second), part
            else:
                yield len(held), (word,), held

    def take(self, most):
        """Cut out the largest subtrees until at most ``most`` phrases are left; all as rows."""
        parts, counts = [], []
        for n, path, held in sorted(self.subtrees(), key=lambda x: -x[0]):
            if self.size <= most:
                break
            prefix = path[0].to_bytes(4) + b"".join(path[1:])
            parts += [prefix + key for key in held]
            counts += held.values()
            self.size -= n
            if len(path) > 1:
                del self.root[path[0]][path[1]]
            else:
                del self.root[path[0]]
        rows = np.frombuffer(b"".join(parts), ">u4").reshape(-1, self.words).astype(np.int64)
        return rows, np.array(counts, np.int64)


class WordCounts:
    """Counts of single words: the root of a trie alone, an array by word number."""

    def __init__(self):
        self.totals, self.size = np.zeros(0, np.int64), 0

    def add(self, words, counts):
        words = words[:, 0]
        if len(words) and words[-1] >= len(self.totals):
            self.totals = np.concatenate((self.totals, np.zeros(words[-1] + 1, np.int64)))
        self.totals[words] += counts
        self.size = np.count_nonzero(self.totals)

    def take(self, most):
        """All words as rows, and their counts, if there are more than ``most``."""
        words = np.flatnonzero(self.totals) if self.size > most else np.zeros(0, np.int64)
        counts = self.totals[words]
        self.totals[words] = 0
        self.size -= len(words)
        return words[:, None], counts


class Words:
    """Numbers of words, from 1 on; 0 is the end of a piece. A word's hash depends on it alone."""

    def __init__(self):
        self.number, self.hashes = {_BREAK: 0}, np.zeros(1, np.uint64)

    def of(self, words):
        new = list(set(words).difference(self.number))
        if new:
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            self.hashes = np.concatenate((self.hashes, word_hashes(new)))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


def _hash_of_lang(lang):
    return word_hashes([b"lang " + lang])


def pair_hashes(seed, first, second):
    """32-bit hashes of pairs of words in a language, from the words' hashes."""
    return (mixed(mixed(seed * _M1 + first) * _M1 + second) >> np.uint64(32)).astype(np.uint32)


def distinct_windows(numbers, starts, words):
    """The distinct windows of ``words`` numbers at ``starts``, sorted, and their counts."""
    if not len(starts):
        return np.zeros((0, words), np.int64), np.zeros(0, np.int64)
    at = [numbers[starts + j] for j in range(words)]
    heads = None
    if words > 3:  # three numbers fill a word: the first three go by their rank
        heads, rank = np.unique(at[0] << 2 * BITS | at[1] << BITS | at[2], return_inverse=True)
        at = [rank.astype(np.int64), *at[3:]]
    key = at[0]
    for x in at[1:]:
        key = key << BITS | x
    key, counts = np.unique(key, return_counts=True)
    columns = []
    for _ in at[1:]:
        columns.append(key & _MASK)
        key = key >> BITS
    if heads is not None:
        head = heads[key]
        columns += [head & _MASK, head >> BITS & _MASK, head >> 2 * BITS]
    else:
        columns.append(key)
    return np.stack(columns[::-1], axis=1), counts


class Counter:
    """The tries of one task, by language and length of the phrases.

    Without ``bits`` words are counted, and the hashes of all pairs kept for ``packed``; with
    them phrases of two words and more whose pairs all pass.
    """

    def __init__(self, bits=None, least=MIN_COUNT):
        self.least = least
        self.lengths, self.bits = [1] if bits is None else list(range(2, MAX_WORDS + 1)), bits
        self.words, self.tries, self.pairs = Words(), {}, []

    def _passes(self, hashes):
        at = hashes & np.uint32(len(self.bits) * 8 - 1)
        return self.bits[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8) & 1 > 0

    def count(self, lang, tokens):
        """Count the phrases in a row of words and breaks; yields what is spilled meanwhile."""
        seed = _hash_of_lang(lang)
        for i in range(0, len(tokens), SLICE):
            part = tokens[i:i + SLICE + MAX_WORDS - 1]
            if len(self.words.number) > NUMBERED:
                yield from self.spill(0)
                self.words, self.tries = Words(), {}
            numbers = self.words.of(part)
            whole = numbers > 0
            places = np.flatnonzero(whole[:-1] & whole[1:])
            hashes = self.words.hashes[numbers]
            hashes = pair_hashes(seed, hashes[places], hashes[places + 1])
            if self.bits is None:
                self.pairs.append(hashes[places < SLICE])
                self._trie(lang, 1).add(*distinct_windows(numbers, np.flatnonzero(whole[:SLICE]), 1))
                if sum(map(len, self.pairs)) > HASHES:
                    yield from self.packed()
            else:
                # Whether a pair passes, by its place, and each longer phrase by its first pairs.
                pairs = np.zeros(len(numbers), dtype=bool)
                pairs[places] = self._passes(hashes)
                open_ = pairs
                for words in self.lengths:
                    self._trie(lang, words).add(
                        *distinct_windows(numbers, np.flatnonzero(open_[:SLICE]), words))
                    open_ = open_[:-1] & pairs[words - 1:]
            if sum(t.size for t in self.tries.values()) > HELD:
                yield from self.spill(HELD // 2 // len(self.tries))

    def _trie(self, lang, words):
        if (lang, words) not in self.tries:
            self.tries[lang, words] = WordCounts() if words == 1 else HatTrie(words)
        return self.tries[lang, words]

    def packed(self):
        """The distinct hashes of pairs held, by block: for each run of 2^16 of them how many
        there are, their lowest 16 bits, and their counts up to the number asked for."""
        if self.pairs:
            hashes, counts = np.unique(np.concatenate(self.pairs), return_counts=True)
            counts = np.minimum(counts, min(self.least, 255)).astype(np.uint8)
            lows = hashes.astype("<u2")
            runs = np.searchsorted(hashes, np.arange((1 << 16) + 1, dtype=np.int64) << 16)
            each = 1 << BLOCK_BITS - 16
            rows = [
                (i // each, np.diff(runs[i:i + each + 1]).astype("<u4").tobytes(),
                 lows[runs[i]:runs[i + each]].tobytes(), counts[runs[i]:runs[i + each]].tobytes())
                for i in range(0, 1 << 16, each) if runs[i] < runs[i + each]]
            self.pairs = []
            yield _batch(dict(zip(("block", "sizes", "lows", "counts"), zip(*rows, strict=True), strict=True)))

    def spill(self, most):
        """Runs of the largest subtrees; at most ``most`` phrases stay in each trie."""
        table = list(self.words.number)
        order = np.zeros(len(table), np.int64)
        order[sorted(range(len(table)), key=table.__getitem__)] = np.arange(len(table))
        table = pa.array(table, pa.binary())
        for (lang, words), trie in self.tries.items():
            phrases, counts = trie.take(most)
            run = np.lexsort([order[phrases[:, j]] for j in reversed(range(words))])
            for i in range(0, len(run), ROWS):
                at = run[i:i + ROWS]
                columns = [table.take(pa.array(phrases[at, j])) for j in range(words)]
                head = _joined(columns[:2])
                yield _batch({
                    "lang": pa.array([lang] * len(at), pa.binary()).cast(pa.string()), "head": head,
                    "phrase": _joined([head.cast(pa.binary()), *columns[2:]]), "n": counts[at]})


def _joined(columns):
    joined = columns[0] if len(columns) == 1 else pc.binary_join_element_wise(*columns, b" ")
    return joined.cast(pa.string())


_SCHEMA = pa.schema([
    *[(c, pa.string()) for c in ("lang", "head", "phrase")], ("n", pa.int64()), ("block", pa.int32()),
    *[(c, pa.binary()) for c in ("sizes", "lows", "counts")]])


def _batch(columns):
    """Rows of runs or of packed hashes; the columns of the others are null."""
    rows = len(next(iter(columns.values())))
    return pa.record_batch([
        pa.array(columns[f.name], f.type) if f.name in columns and not isinstance(columns[f.name], pa.Array)
        else columns.get(f.name, pa.nulls(rows, f.type)) for f in _SCHEMA], schema=_SCHEMA)


def _counting(bits, least):
    def counting(batches):
        counter = Counter(bits, least)
        for batch in batches:
            for piece in chunks(batch, "text"):
                texts = {}
                for lang, text in zip(*(piece.column(c).to_pylist() for c in ("lang", "text")), strict=True):
                    texts.setdefault(lang, []).append(text)
                for lang, some in texts.items():
                    text = _BREAK.join([*some, b""]).translate(_TABLE)
                    # Only blanks and tabs are left of the characters at which split() splits.
                    yield from counter.count(lang, text.replace(_BREAK, b" \xff ").split())
        yield from counter.spill(0)
        yield from counter.packed()
    return counting


def _merged(runs):
    """``lang, phrase, n``: runs meet by prefix, and the counts of a phrase are summed."""
    return runs.where("block is null").select("lang", "head", "phrase", "n").repartition(
        "lang", "head").groupBy("lang", "head", "phrase").agg(F.sum("n").alias("n")).select(
        "lang", "phrase", "n")


def _often(least):
    least = min(least, 255)

    def often(batches):
        """The hashes that occur often enough, from packed rows in order of their block."""
        block, counts = None, None

        def found():
            at = np.flatnonzero(counts >= least) + (block << BLOCK_BITS)
            return pa.record_batch([pa.array(at.astype(np.int64))], names=["hash"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != block:
                    if block is not None:
                        yield found()
                    block, counts = row["block"], np.zeros(1 << BLOCK_BITS, np.uint16)
                sizes = np.frombuffer(row["sizes"], "<u4")
                at = np.repeat(np.arange(len(sizes)) << 16, sizes) + np.frombuffer(row["lows"], "<u2")
                # Counts beyond the number asked for need no more room.
                counts[at] = np.minimum(counts[at] + np.frombuffer(row["counts"], np.uint8), least)
        if block is not None:
            yield found()
    return often


def _bitmap(packed, least):
    """The frequent hashes among packed ones as a bitmap of bounded size."""
    hashes = cut(packed.repartition("block").sortWithinPartitions("block").mapInArrow(
        _often(least), "hash long"), "hashes")
    size, wanted = 1 << 15, min(MAP_BITS, hashes.count() * HASH_BITS)
    while size < wanted:
        size *= 2
    place = F.col("hash").bitwiseAND(F.lit(size - 1)) + 1
    parts = hashes.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    bits = np.zeros((size >> 15, 1 << 12), dtype=np.uint8)
    for part, found in parts:
        bits[part - 1] = np.frombuffer(found, np.uint8)
    return bits.ravel()


def phrase_counts(docs, least=MIN_COUNT):
    """``totals, frequent``: words of each language, and all phrases that occur often enough.

    ``frequent`` has ``lang, phrase, words, n``, of 1 to ``MAX_WORDS`` words.
    """
    share_code(docs.sparkSession)
    docs = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary").alias("lang"),
        F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary")).alias("text"))
    often = F.col("n") >= least
    runs = cut(docs.mapInArrow(thrifty(_counting(None, least)), f"{RUNS}, {BLOCKS}"), "word-runs")
    bits = _bitmap(runs.where("block is not null").select("block", "sizes", "lows", "counts"), least)
    words = cut(_merged(runs), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    longer = _merged(docs.mapInArrow(thrifty(_counting(bits, least)), f"{RUNS}, {BLOCKS}"))
    every = words.where(often).unionAll(longer.where(often))
    return totals, cut(every.withColumn("words", F.size(F.split("phrase", " "))), "frequent")


def collocations(docs, top=TOP, least=MIN_COUNT):
    """The ``top`` phrases of each language of ``docs`` (``lang, text``) by their weakest cut.

    A phrase has 2 to ``MAX_WORDS`` words inside a piece and occurs ``least`` times or more.
    Cut behind its first k words it scores ``floor(1000 a n / (l r))``; the lowest score counts,
    the smallest k on ties. Phrases that only occur inside one longer candidate are dropped.
    Null languages count as ``und``, null texts as empty; repeated rows count each time;
    other columns change nothing, and an empty table gives no rows. Scores are exact up to
    10^15 words of a language.
    """
    totals, frequent = phrase_counts(docs, least)
    whole = frequent.where("words > 1")
    parts = if_small(frequent.select("lang", F.col("phrase").alias("part"), F.col("n").alias("count")))
    text = F.split("phrase", " ")
    cuts = whole.select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(
        F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).withColumns({
            "left": F.array_join(F.slice(text, F.lit(1), F.col("k")), " "),
            "right": F.array_join(F.slice(text, F.col("k") + 1, F.col("words") - F.col("k")), " ")})
    scored = cuts.join(parts.toDF("lang", "left", "l"), ["lang", "left"]).join(
        parts.toDF("lang", "right", "r"), ["lang", "right"]).join(if_small(totals), "lang")
    number = "cast({} as decimal(15, 0))".format
    score = F.expr(f"cast(1000 as decimal(4, 0)) * {number('a')} * {number('total')}"
                   f" div ({number('l')} * {number('r')})")
    weakest = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"), F.first("a").alias("a"),
        F.first("total").alias("total"))
    size = F.col("words") - F.col("less")
    inner = whole.where("words > 2").select("lang", "phrase", "words", "n", F.explode(
        F.sequence(F.lit(1), F.col("words") - 2)).alias("less")).select("lang", "n", F.explode(
            F.transform(F.sequence(F.lit(1), F.col("less") + 1),
                        lambda i: F.array_join(F.slice(text, i, size), " "))).alias("phrase"))
    inside = inner.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = weakest.join(if_small(cut(inside, "inside")), ["lang", "phrase"], "left").where(
        "longer is null or 100 * longer < 100 * a")
    rows = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
                       F.col("total").alias("n"), F.col("cut.score").alias("score"))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First the best of each share of a language, so no task gets all its phrases.
    share = F.pmod(F.xxhash64("phrase"), F.lit(width(docs.sparkSession)))
    some = rows.withColumn("share", share).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*best))).where(
        F.col("rank") <= top)
    return some.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql():
    """DuckDB SQL for the rows of ``collocations`` over the table ``documents``."""
    grams = " union all ".join(f"""
            select lang, {k} as words, unnest(list_transform(range(1, len(w) - {k - 2}),
                lambda i: array_to_string(w[i:i + {k - 1}], ' '))) as phrase
            from pieces where len(w) >= {k}""" for k in range(1, MAX_WORDS + 1))
    return rf"""
    with texts as (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
        from documents where text is not null),
    pieces as (
        select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w
        from texts),
    totals as (select lang, sum(len(w))::bigint as n from pieces group by lang),
    counts as (select lang, words, phrase, count(*) as f from ({grams}) group by all
        having count(*) >= {MIN_COUNT}),
    whole as (select *, string_split(phrase, ' ') as w from counts where words > 1),
    cuts as (select lang, phrase, words, f as a, w, unnest(range(1, words)) as k from whole),
    scored as (
        select c.lang, c.phrase, a, k, x.f as l, y.f as r, n,
            ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint as score
        from cuts c
        join counts x on x.lang = c.lang and x.phrase = array_to_string(w[1:k], ' ')
        join counts y on y.lang = c.lang and y.phrase = array_to_string(w[k + 1:c.words], ' ')
        join totals t on t.lang = c.lang),
    weakest as (select * from scored
        qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    inner_parts as (
        select lang, f, unnest(list_transform(range(1, words - size + 2),
            lambda i: array_to_string(w[i:i + size - 1], ' '))) as phrase
        from (select *, unnest(range(2, words)) as size from whole)),
    inside as (select lang, phrase, max(f) as longer from inner_parts group by all),
    kept as (select w.* from weakest w left join inside i on i.lang = w.lang and i.phrase = w.phrase
        where longer is null or 100 * longer < 100 * a)
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
        phrase, a, l, r, n, score from kept
    qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= {TOP}
    """
