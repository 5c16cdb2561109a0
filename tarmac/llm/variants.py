"""Spelling variants: words one edit apart, found with FM-indexes read from both ends.

Of two words that differ by one code point, either the first half of the one that asks is the
start of the other, or its last half is the other's end. So every word is filed under its
starts and its ends that are halves of a word of its length, one more or one less, and asks under
its own two halves. A bucket of files holds some ``BUCKET`` words in one index: the suffixes
of the delimited words in order, as the symbols before them, from which the interval of suffixes
that a string begins is extended by a symbol to its left (starts are indexed in words read backwards).

A search matches the half exactly and goes on through the other half allowing one error: at
every place a symbol may be skipped, replaced or put in, along the symbols that the
interval holds. An interval closed by delimiters on both sides is a word.

A half shared by more than ``BUCKET`` words has buckets of its own: its words are dealt to several, and
who asks, asks in each. What a bucket finds for a word is summed up before it moves.

Words are taken by ``vocabulary``. A null text has none; a null ``doc_id`` is written as nothing
when the deleted code point is drawn; repeated rows count again; an empty table gives an empty
table; other columns are not read. Words of any length are searched: a search ends when its
interval holds no other word, so only long words that are near to each other take a step a letter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import settle

LEAST_LENGTH, LEAST_COUNT = 7, 2
RATIO = 10
BUCKET = 1 << 15
ASKED_AT_ONCE = 1 << 14
DELETED_OF = 31
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DELIMITER, NOTHING = 0, 256
FEW = 48


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """The words of at least ``least`` code points that occur twice or more, with their number ``n``.

    A word is a run of Latin letters with A-Z in lower case; of every 31st run, by a checksum of document and
    run, one code point is deleted.
    """
    lower = F.translate("text", UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(lower, F.lit(f"[a-zÀ-ÿ]{{{least},}}"), F.lit(0))).alias("run"))
    drawn = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = drawn.select(F.when(F.pmod("h", F.lit(DELETED_OF)) == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).filter(
        F.col("n") >= LEAST_COUNT)


class Index:
    """Words by the intervals of suffixes that a string begins; extended to the left."""

    def __init__(self, words: list[bytes]):
        self.words = sorted(words)
        text = np.frombuffer(b"\0" + b"\0".join(self.words) + b"\0", np.uint8).astype(np.int64)
        delimiters = np.flatnonzero(text == DELIMITER)
        ranks = text + len(delimiters)
        ranks[delimiters] = np.arange(len(delimiters))
        step = 1
        while True:  # suffixes end at their delimiter, so they differ once they are ranked that far
            later = np.zeros(len(ranks), np.int64)
            later[:max(0, len(ranks) - step)] = ranks[step:] + 1
            keys = (ranks << 32) | later
            order = np.argsort(keys)
            new = np.diff(keys[order]) != 0
            ranks = np.empty(len(keys), np.int64)
            ranks[order] = np.concatenate([[0], np.cumsum(new)])
            if new.all():
                break
            step *= 2
        self.before = text[order - 1]
        self.before[0] = NOTHING  # the first delimiter
        self.rows = len(text)
        self.places = np.sort(self.before * (self.rows + 1) + np.arange(self.rows))
        self.symbols = np.unique(text[text != DELIMITER])
        self.delimiters = len(delimiters)

    def extended(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of strings with a symbol put before them. Of delimiters, the rows are the words' numbers."""
        base = symbols * (self.rows + 1)
        letters = (symbols != DELIMITER).astype(np.int64)
        return (np.searchsorted(self.places, base + low) + letters, np.searchsorted(self.places, base + high) + letters)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per interval every letter that stands before one of its suffixes: number of the interval, letter."""
        size = high - low
        few = np.flatnonzero(size <= FEW)
        own = np.repeat(few, size[few])
        row = np.arange(len(own)) - np.repeat(np.cumsum(size[few]) - size[few], size[few]) + low[own]
        found = np.unique(own * 512 + self.before[row])
        many = np.flatnonzero(size > FEW)
        wide = np.repeat(many, len(self.symbols)) * 512 + np.tile(self.symbols, len(many))
        found = np.concatenate([found[(found % 512 != DELIMITER) & (found % 512 != NOTHING)], wide])
        return found // 512, found % 512

    def near(self, asked: list[bytes], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of asked word and own word that are one edit apart and share the last ``exact`` symbols."""
        lengths = np.array([len(w) for w in asked])
        flat = np.frombuffer(b"".join(asked), np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        symbol = lambda q, t: flat[ends[q] - 1 - t]  # noqa: E731  the t-th from the end
        known = set(self.words)
        own = np.array([w in known for w in asked])
        q, low, high = np.arange(len(asked)), np.zeros(len(asked), np.int64), np.full(len(asked), self.delimiters)
        none = np.zeros(0, np.int64)
        late = (none, none, none)  # with their error spent
        out_q, out_low = [none], [none]

        def grow(q, symbols, low, high):
            low, high = self.extended(symbols, low, high)
            some = low < high
            return q[some], low[some], high[some]

        t = 0
        while len(q) or len(late[0]):
            branching = np.flatnonzero(t >= exact[q])
            of, letters = self.branches(low[branching], high[branching])
            of = branching[of]
            put_in = grow(q[of], letters, low[of], high[of])
            late = tuple(np.concatenate(x) for x in zip(late, put_in))
            ended = lengths[late[0]] == t
            done_q, done_low, _ = grow(late[0][ended], np.full(ended.sum(), DELIMITER), late[1][ended], late[2][ended])
            out_q.append(done_q)
            out_low.append(done_low)
            late = tuple(x[~ended] for x in late)
            on = lengths[q[of]] > t
            of, letters = of[on], letters[on]
            other = letters != symbol(q[of], t)
            replaced = grow(q[of][other], letters[other], low[of][other], high[of][other])
            branching = branching[lengths[q[branching]] > t]
            skipped = (q[branching], low[branching], high[branching])
            late = tuple(np.concatenate(x) for x in zip(grow(late[0], symbol(late[0], t), *late[1:]), replaced, skipped))
            on = lengths[q] > t
            q, low, high = grow(q[on], symbol(q[on], t), low[on], high[on])
            other = ~own[q] | (high - low > 1)  # else the word asked for is alone
            q, low, high = q[other], low[other], high[other]
            t += 1
        pairs = np.unique(np.concatenate(out_q) * self.rows + np.concatenate(out_low))
        return pairs // self.rows, pairs % self.rows


def _answers(index: Index, counts: dict[bytes, int], side: int, words: list[str], ns: list[int]) -> pa.RecordBatch:
    """Per word that asks, how many own words are near it and which is the most frequent (then the smallest)."""
    plain = [w.encode("latin-1") for w in words]
    lengths = np.array([len(w) for w in plain])
    exact = lengths // 2 if side == 0 else lengths - lengths // 2
    q, found = index.near([w[::-1] for w in plain] if side == 0 else plain, exact)
    best: dict[int, tuple[int, bytes]] = {}
    number: dict[int, int] = {}
    for i, j in zip(q.tolist(), found.tolist()):
        word = index.words[j] if side else index.words[j][::-1]
        half = len(plain[i]) // 2
        if side and word[:half] == plain[i][:half]:
            continue  # found from the start
        number[i] = number.get(i, 0) + 1
        this = (-counts[word], word)
        if i not in best or this < best[i]:
            best[i] = this
    some = sorted(number)
    return pa.RecordBatch.from_pydict({
        "word": pa.array([words[i] for i in some], pa.string()), "n": pa.array([ns[i] for i in some], pa.int64()),
        "n_near": pa.array([number[i] for i in some], pa.int64()),
        "near_n": pa.array([-best[i][0] for i in some], pa.int64()),
        "near": pa.array([best[i][1].decode("latin-1") for i in some], pa.string())})


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets in order, their own words before those that ask."""
    bucket, side, counts, index = None, 0, {}, None
    words, ns = [], []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "side", "asks", "word", "n"))):
            if row[0] != bucket:
                if words:
                    yield _answers(index, counts, side, words, ns)
                bucket, side, counts, index, words, ns = row[0], row[1], {}, None, [], []
            if not row[2]:
                counts[row[3].encode("latin-1")] = row[4]
                continue
            if not counts:
                continue
            if index is None:
                index = Index([w[::-1] for w in counts] if side == 0 else list(counts))
            words.append(row[3])
            ns.append(row[4])
            if len(words) >= ASKED_AT_ONCE:
                yield _answers(index, counts, side, words, ns)
                words, ns = [], []
    if words:
        yield _answers(index, counts, side, words, ns)


def _filed(words: DataFrame) -> DataFrame:
    """Every word under the halves it shares with words one edit away: ``half``, ``side``, ``asks`` (its own half)."""
    length = F.length("word")
    files = []
    for more in (-1, 0, 1):
        asking = length + more
        start = (asking / 2).cast("int")
        for side, half in ((0, F.substring("word", F.lit(1), start)),
                           (1, F.substring("word", length - (asking - start) + 1, asking - start))):
            files.append(F.struct(F.xxhash64(F.lit(side), asking, half).alias("half"),
                                  F.lit(side).alias("side"), F.lit(more == 0).alias("asks")))
    return words.select("word", "n", F.inline(F.array(*files)))


def near_words(words: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Per word of a table (word, n) with a near word: ``n_near``, and the most frequent of them with its number."""
    filed = _filed(words)
    sizes = filed.groupBy("half").agg(F.count("*").alias("size"))
    hot = settle(sizes.filter(F.col("size") > bucket).select(
        "half", F.ceil(F.col("size") / bucket).cast("long").alias("parts")), "variant-halves")
    buckets = max(1, -(-3 * words.count() // bucket))
    placed = filed.join(hot, "half", "left")
    part: Column = F.pmod(F.xxhash64("word"), "parts")
    cold = F.pmod("half", F.lit(buckets)) * 2 + F.col("side")
    own = lambda part: F.when(F.col("parts").isNull(), cold).otherwise(F.xxhash64("half", part))
    members = placed.select(own(part).alias("bucket"), "side", F.lit(False).alias("asks"), "word", "n")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    askers = placed.filter("asks").select("*", every).select(own(F.col("part")).alias("bucket"), "side", "asks", "word", "n")
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets)
    found = members.union(askers).repartition(tasks, "bucket").sortWithinPartitions("bucket", "asks").mapInArrow(
        _search, "word string, n long, n_near long, near_n long, near string")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    ).select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for rows of (word, form): each round goes on as far again.

    A form is ``RATIO`` times as frequent as its word, so there is no circle, and some five rounds end it.
    """
    roots = settle(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = settle(roots.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        roots = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            return roots


def variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Every word with its form (the near word of largest ``n``, if ``ratio`` times its own), the root of forms, and counts."""
    words = settle(vocabulary(docs), "variant-words")
    near = settle(words.join(near_words(words), "word", "left"), "variant-near")
    formed = F.col("near_n") >= F.lit(ratio) * F.col("n")
    rows = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                       F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n"))
    return rows.join(_roots(rows.filter("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
