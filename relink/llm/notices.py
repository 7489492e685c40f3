"""License scans: fuzzy search for short notices.

A notice of k allowed edits is cut into k + 1 pieces; any text within k edits of it holds one piece unchanged (pigeonhole).
All pieces of all notices are found in one pass of an Aho-Corasick automaton; around each find the regex library verifies
the notice within its bounded number of errors and gives the best match's place and edits. A notice's anchors, the words that tell it from its
like ("mit", "cc by nc", the digits of a version; one phrase of it), must stand in the match unchanged: edits may not turn one license into another.
The notices are a parameter: (text, label, anchors) each. Texts and notices are compared
as lower-case words joined by blanks, so punctuation and line breaks don't count as edits.

Besides, fixed phrases are found exactly, wherever their words stand consecutively (base places).

Defined results: a null text has no words; empty label lists are empty strings; overlapping places of one phrase all count;
several matches of a notice that overlap are one, the one of least edits, then the first; repeated rows are rows; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import alnum_words, map_batches, raw

#: Exact phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Notices that are also found with edits, their labels, and the words that may not be edited.
NOTICES = (
    ("all rights reserved", "reserved", ""),
    ("apache license version 2 0", "apache-2.0", "2 0"),
    ("creative commons attribution", "cc-by", ""),
    ("general public license", "gpl", ""),
    ("licensed under cc by", "cc-by", "cc by"),
    ("licensed under cc by nc", "cc-by-nc", "cc by nc"),
    ("licensed under cc by nd", "cc-by-nd", "cc by nd"),
    ("licensed under cc by sa", "cc-by-sa", "cc by sa"),
    ("licensed under the apache license", "apache", ""),
    ("mozilla public license", "mpl", ""),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", ""),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", ""),
    ("redistribution and use in source and binary forms", "bsd", ""),
    ("released under the bsd license", "bsd", "bsd"),
    ("released under the gpl license", "gpl", "gpl"),
    ("released under the isc license", "isc", "isc"),
    ("released under the mit license", "mit", "mit"),
    ("this work is licensed under the gnu general public license", "gpl", ""),
)
#: One edit is allowed for so many characters of a notice.
PER_EDIT = 9

SPANS = "array<struct<label string, first int, last int, edits int, size int, base boolean>>"


def pieces(notice: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): the notice cut into k + 1 nearly equal pieces."""
    cuts = [round(i * len(notice) / (k + 1)) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


@lru_cache(4)
def searcher(notices: tuple, per_edit: int):
    """(automaton of all pieces, pattern and edits of each notice)."""
    import ahocorasick
    import regex

    seeds: dict[str, list[tuple[int, int, int]]] = {}
    patterns = []
    for number, (notice, label, anchors) in enumerate(notices):
        k = len(notice) // per_edit
        before, anchor, after = f" {notice} ".partition(f" {anchors} ") if anchors else (f" {notice}", "", "")
        if anchors and not anchor:
            raise ValueError(f"{anchors!r} does not stand in {notice!r}")
        parts = [f"(?:{regex.escape(x, literal_spaces=True)}){{e<={k}}}" if x else "" for x in (before[1:] + " " * bool(anchors and before), " " * bool(after) + after[:-1])]
        exact = rf"(?<!\S){regex.escape(anchors, literal_spaces=True)}(?!\S)" if anchors else ""
        patterns.append((regex.compile(f"(?b){parts[0]}{exact}{parts[1]}"), k, len(notice), label))
        for offset, piece in pieces(notice, k):
            seeds.setdefault(piece, []).append((number, offset, len(piece)))
    automaton = ahocorasick.Automaton()
    for piece, uses in seeds.items():
        automaton.add_word(piece, uses)
    automaton.make_automaton()
    return automaton, patterns


def apart(pattern, line: str, spans: set[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """(start, end, edits) of the matches of at most k edits that lie within one of the spans: least edits first, then the first,
    and none that overlaps one taken before. A span keeps its best match until another takes a part of it; then what is left
    is searched. (Around an anchor the pattern bounds the edits of each side; the sum is bounded here.)"""
    def best(a: int, b: int) -> None:
        m = pattern.search(line, a, b)
        if m and sum(m.fuzzy_counts) <= k:
            heappush(waiting, (sum(m.fuzzy_counts), m.start(), m.end(), a, b))

    waiting: list[tuple[int, int, int, int, int]] = []
    for a, b in spans:
        best(a, b)
    taken: list[tuple[int, int, int]] = []  # by place
    while waiting:
        edits, start, end, a, b = heappop(waiting)
        i = bisect_right(taken, (a, len(line) + 1, 0))
        i -= i > 0 and taken[i - 1][1] > a
        j = bisect_left(taken, (b,))
        inside = taken[i:j]
        if all(y <= start or x >= end for x, y, _ in inside):
            insort(taken, (start, end, edits))
        else:
            for x, y in zip([a, *(y for _, y, _ in inside)], [*(x for x, _, _ in inside), b]):
                if x < y:
                    best(x, y)
    return taken


def fuzzy(line: str, notices: tuple = NOTICES, per_edit: int = PER_EDIT) -> list[tuple[str, int, int, int, int]]:
    """(label, start, end, edits, notice's length) of matches in a line of words."""
    automaton, patterns = searcher(notices, per_edit)
    regions: dict[int, set[tuple[int, int]]] = {}
    for end, uses in automaton.iter(line):
        for number, offset, size in uses:
            k, length = patterns[number][1:3]
            begin = end + 1 - size - offset
            regions.setdefault(number, set()).add((max(0, begin - k), min(len(line), begin + length + k)))
    found = []
    for number, spans in regions.items():
        pattern, k, length, label = patterns[number]
        found += [(label, a, b, edits, length) for a, b, edits in apart(pattern, line, spans, k)]
    return sorted(found, key=lambda x: (x[1], x[2], x[0]))


def spans_of(words: list[bytes], notices: tuple = NOTICES, per_edit: int = PER_EDIT) -> list[tuple[str, int, int, int, int, bool]]:
    """All matches of a document: label, first and last word, edits, notice's length, and whether it is a base place."""
    line = b" ".join(words).decode("utf-8", "replace")
    framed = f" {line} "
    out = []
    for phrase, label in PHRASES:
        at = framed.find(f" {phrase} ")
        while at >= 0:
            first = framed.count(" ", 0, at + 1) - 1
            out.append((label, first, first + phrase.count(" "), 0, len(phrase), True))
            at = framed.find(f" {phrase} ", at + 1)
    near = fuzzy(line, notices, per_edit)
    if near:
        ends = list(accumulate(len(w.decode("utf-8", "replace")) + 1 for w in words))  # where the next word starts
        for label, a, b, edits, size in near:
            inner = line[a:b]
            a, b = a + len(inner) - len(inner.lstrip()), b - len(inner) + len(inner.rstrip())
            out.append((label, bisect_right(ends, a), bisect_right(ends, max(a, b - 1)), edits, size, False))
    return out


def notice_table(notices: DataFrame, most: int = 10_000) -> tuple:
    """Notices of a table (notice, label, anchors): lower-case words joined by blanks, those without a word left out, equal ones
    once, in order. They stand in every task, so more than ``most`` are an error."""
    words = F.array_join(F.regexp_extract_all(F.lower("notice"), F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)")), " ")
    rows = notices.select(words.alias("n"), F.coalesce("label", F.lit("")).alias("l"), F.coalesce(F.lower("anchors"), F.lit("")).alias("a")).where("n <> ''")
    found = rows.distinct().sort("n", "l", "a").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} notices")
    return tuple(tuple(r) for r in found)


def scan(docs: DataFrame, notices: tuple = NOTICES, per_edit: int = PER_EDIT) -> DataFrame:
    """One row per document: doc_id, n_words and spans, every match with its words, edits and label."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("label", "first", "last", "edits", "size", "base")
        kind = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("edits", pa.int32()),
                                   ("size", pa.int32()), ("base", pa.bool_())]))
        for b in batches:
            number, spans = [], []
            for text in b.column(1):
                words = alnum_words(text.as_py())
                number.append(len(words))
                spans.append([dict(zip(names, s)) for s in spans_of(words, notices, per_edit)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(number, pa.int64()), pa.array(spans, kind)], ["doc_id", "n_words", "spans"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw("text")), rows, f"doc_id long, n_words long, spans {SPANS}")


def labelled(found: DataFrame) -> DataFrame:
    """Counts, labels and score of scanned documents; the score is the best match's share of characters without edits."""
    return found.selectExpr(
        "doc_id", "n_words", "cast(size(filter(spans, s -> s.base)) as bigint) as n_base",
        "cast(array_min(transform(filter(spans, s -> s.base), s -> s.first)) as bigint) as first_word",
        "cast(array_max(transform(filter(spans, s -> s.base), s -> s.first)) as bigint) as last_word",
        "array_join(array_sort(array_distinct(transform(filter(spans, s -> s.base), s -> s.label))), ',') as base_labels",
        "array_join(array_sort(array_distinct(transform(spans, s -> s.label))), ',') as labels",
        "coalesce(array_max(transform(spans, s -> 1.0D - s.edits / s.size)), 0.0D) as score", "spans")
