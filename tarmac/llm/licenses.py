"""License notices in text, also with a few edits: exact seeds locate, bounded-error matching verifies.

Words are the runs of letters, digits and non-ASCII characters of the lower-cased text;
a text is searched as its words joined by single blanks. A notice that may hold k edits
is split into k + 1 seeds: whatever the edits, one seed stays as it is (pigeonhole), so
a text without any seed needs no further look. Around each seed a window as long as the
notice with its edits is matched by the ``regex`` library with at most k errors. Words that
tell one license from another (``TELLING``) have to stand in the match unedited.

Exact phrases are the base: every place where their words stand consecutively, reported
whatever the fuzzy search finds. Texts are whole; null counts as empty.

Empty and null texts have no words and no spans. Equal rows are reported alike; an empty table gives an empty table.
Other columns pass through ``scan``; its own two, ``n_words`` and ``spans``, replace the caller's. A long text is
searched as one string, in memory a few times its size.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import chunks, widened
from tarmac.llm.words import PLAIN

# Phrases with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
NOTICES = {
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under the gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license version 2 0": "mpl-2",
}
TELLING = {
    "released under the mit license": ("mit",),
    "licensed under the apache license version 2 0": ("2",),
    "licensed under cc by nc 4 0": ("nc",),
    "licensed under the gnu general public license version 3": ("3",),
    "mozilla public license version 2 0": ("2",),
}
MAX_EDITS = {notice: max(1, len(notice) // 12) for notice in NOTICES}

SPAN = "array<struct<label: string, first: bigint, last: bigint, edits: int, exact: boolean>>"


def seeds(notice: str, edits: int) -> list[tuple[str, int]]:
    """``edits`` + 1 pieces of about equal length, with their places in the notice."""
    n = edits + 1
    cuts = [len(notice) * i // n for i in range(n + 1)]
    return [(notice[a:b], a) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, base: dict[str, str], notices: dict[str, str], max_edits: dict[str, int]):
        self.base = [(f" {p} ".encode(), label, len(p.split())) for p, label in base.items()]
        self.notices = []
        for notice, label in notices.items():
            k = max_edits[notice]
            pieces = [(s.encode(), at) for s, at in seeds(notice, k)]
            pattern = regex.compile(f"(?e)(?:{regex.escape(notice)}){{e<={k}}}")
            telling = [word.encode() for word in TELLING.get(notice, ())]
            self.notices.append((label, 4 * k, len(notice), pieces, pattern, telling))

    def spans(self, joined: bytes) -> list[tuple[str, int, int, int, bool]]:
        """Label, first and last word, edits, and whether it is of the base; ``joined`` has a blank at both ends."""
        found = []
        ends: list[int] | None = None

        def word_at(place: int) -> int:
            nonlocal ends
            if ends is None:
                ends = [i for i, b in enumerate(joined) if b == 32]
            return bisect_right(ends, place) - 1

        for phrase, label, n in self.base:
            at = joined.find(phrase)
            while at >= 0:
                first = word_at(at)
                found.append((label, first, first + n - 1, 0, True))
                at = joined.find(phrase, at + 1)
        for label, slack, length, pieces, pattern, telling in self.notices:
            wanted = []
            for piece, offset in pieces:
                at = joined.find(piece)
                while at >= 0:
                    wanted.append(_characters(joined, at - offset - slack, at - offset + length + slack))
                    at = joined.find(piece, at + 1)
            seen = -1
            for start, stop in _merged(wanted):
                for match in pattern.finditer(joined[start:stop].decode("utf-8", "replace")):
                    before = len(match.string[:match.start()].encode())
                    inside = len(match.group().rstrip().encode())
                    first, last = word_at(start + before), word_at(start + before + max(0, inside - 1))
                    if first > seen and not set(telling) - set(joined[ends[first]:ends[last + 1]].split()):
                        found.append((label, first, last, sum(match.fuzzy_counts), False))
                        seen = last
        return sorted(found)


def _characters(joined: bytes, start: int, stop: int) -> tuple[int, int]:
    """The range within the text, widened to whole characters."""
    start, stop = max(0, start), min(len(joined), stop)
    while start and joined[start] & 0xC0 == 0x80:
        start -= 1
    while stop < len(joined) and joined[stop] & 0xC0 == 0x80:
        stop += 1
    return start, stop


def _merged(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(windows):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def scan(docs: DataFrame, text: str = "text", base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES,
         max_edits: dict[str, int] = MAX_EDITS) -> DataFrame:
    """``docs`` with ``n_words`` and ``spans``: label, first and last word, edits, and whether it is a base phrase."""
    kept = docs.drop("n_words", "spans")
    kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                               ("edits", pa.int32()), ("exact", pa.bool_())]))
    names = ("label", "first", "last", "edits", "exact")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices, max_edits)
        for batch, texts in chunks(batches, text):
            counts, spans = [], []
            for data in texts:
                words = data.translate(PLAIN).split()
                counts.append(len(words))
                found = scanner.spans(b" " + b" ".join(words) + b" ") if words else []
                spans.append([dict(zip(names, span)) for span in found])
            columns = [*batch.columns, pa.array(counts, pa.int64()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "n_words", "spans"])

    return kept.mapInArrow(run, widened(kept, n_words="long", spans=SPAN))


def report(docs: DataFrame, *keys: str) -> DataFrame:
    """Per row its ``keys``, base places and labels, all labels, and a score: 1 for a base phrase, less with each edit."""
    found = scan(docs.select(*keys, "text"))
    exact = F.filter("spans", lambda s: s["exact"])
    labels = lambda spans: F.concat_ws(",", F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))))
    likeness = F.transform("spans", lambda s: F.when(s["exact"], 1.0).otherwise(1.0 / (1.0 + 0.25 * s["edits"])))
    return found.select(
        *keys,
        "n_words",
        F.size(exact).cast("long").alias("n_base"),
        F.array_min(F.transform(exact, lambda s: s["first"])).alias("first_word"),
        F.array_max(F.transform(exact, lambda s: s["first"])).alias("last_word"),
        labels(exact).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(likeness), F.lit(0.0)).alias("score"),
    )
