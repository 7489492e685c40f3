"""Benchmark decontamination by a distributed positional inverted index.

The index is partitioned by documents: a segment holds the documents that one task read together, and per term one list of
word positions, delta-coded. Between two documents one position stays empty, so no phrase runs from one into the next.
A search takes the test windows' term lists of a segment, starts from the rarest term and intersects the lists shifted by
the terms' offsets; a segment is bounded, so is the task. Nothing but the test set is broadcast, in blocks of bounded size.

Defined results: a null or wordless text has no words and no hits; repeated document rows give a row each; repeated items
count once by item_id; an item without id marks hits but is not listed; empty tables give empty results or no hits;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import alnum_words, map_batches, raw, written

#: Words after which a segment is closed; one longer document makes a segment of its own.
SEGMENT_WORDS = 1 << 20
#: Words of the test set that are broadcast at once; a larger test set is searched in blocks.
BLOCK_WORDS = 4_000_000

POSTINGS = "segment long, term binary, n int, deltas binary, doc_ids array<long>, lengths array<int>"
FOUND = "segment long, doc_no int, doc_id long, n_words long, runs array<int>, items array<string>"
MATCHES = "doc_id long, item_id string, start long, n long, kind string"


def windows(words: list, n: int) -> list[tuple]:
    """Windows of n consecutive words; a shorter item is one window, an item without words none."""
    if not words:
        return []
    return [tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]


def build(docs: DataFrame, terms: set[bytes] | None = None) -> DataFrame:
    """Postings of all documents, stored in the shared folder: per segment a row for each term, and one (no term) that
    lists its documents. With `terms`, only their lists are kept: those a known test set can ask for."""
    spark = docs.sparkSession
    wanted = spark.sparkContext.broadcast({w: i for i, w in enumerate(sorted(terms))} if terms is not None else None)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, lengths, tokens, size = TaskContext.get().partitionId(), 0, [], [], [], 0
        table = wanted.value

        def close() -> pa.RecordBatch:
            local = table if table is not None else {}
            codes, at = [], 0
            for words in tokens:
                if table is None:
                    own = np.fromiter((local.setdefault(w, len(local)) for w in words), np.int32, len(words))
                else:
                    own = np.fromiter((local.get(w, -1) for w in words), np.int32, len(words))
                keep = np.flatnonzero(own >= 0)
                codes.append((own[keep], keep + at))
                at += len(words) + 1
            code = np.concatenate([c for c, _ in codes])
            pos = np.concatenate([p for _, p in codes])
            order = np.argsort(code, kind="stable")
            code, pos = code[order], pos[order]
            names = list(local)
            first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.array([], int)
            ends = np.r_[first[1:], len(code)]
            rows = {"term": [None], "n": [0], "deltas": [None]}
            for a, b in zip(first.tolist(), ends.tolist()):
                rows["term"].append(names[code[a]])
                rows["n"].append(b - a)
                rows["deltas"].append(coded(pos[a:b]))
            k = len(rows["term"])
            return pa.RecordBatch.from_arrays([
                pa.array([part << 32 | number] * k, pa.int64()), pa.array(rows["term"], pa.binary()), pa.array(rows["n"], pa.int32()),
                pa.array(rows["deltas"], pa.binary()), pa.array([ids] + [None] * (k - 1), pa.list_(pa.int64())),
                pa.array([lengths] + [None] * (k - 1), pa.list_(pa.int32()))], [c.split()[0] for c in POSTINGS.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = alnum_words(text.as_py())
                ids.append(doc_id)
                lengths.append(len(words))
                tokens.append(words)
                size += len(words) + 1
                if size >= SEGMENT_WORDS:
                    yield close()
                    ids, lengths, tokens, size, number = [], [], [], 0, number + 1
        if ids:
            yield close()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw("text"))
    return written(map_batches(slim, segments, POSTINGS), "postings")


def coded(pos: np.ndarray) -> bytes:
    """Deltas of ascending positions, of two bytes each if all fit, after one byte that says so."""
    d = np.diff(pos, prepend=0)
    return b"\x02" + d.astype("<u2").tobytes() if d.max() < 1 << 16 else b"\x04" + d.astype("<u4").tobytes()


def decoded(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, "<u2" if blob[0] == 2 else "<u4", offset=1), dtype=np.int64)


def test_blocks(benchmark: DataFrame, n: int) -> list[dict]:
    """The stated test set as blocks of at most BLOCK_WORDS words (at least one item): windows as term numbers."""
    blocks, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), raw("text")).toLocalIterator():
        words = alnum_words(bytes(row[1]) if row[1] is not None else None)
        if not words:
            continue
        if not blocks or size + len(words) > BLOCK_WORDS:
            blocks, size = [*blocks, {"terms": {}, "rows": [], "items": [], "offsets": []}], 0
        b = blocks[-1]
        for w in windows([b["terms"].setdefault(x, len(b["terms"])) for x in words], n):
            b["rows"].append(w)
            b["items"].append(row[0])
        size += len(words)
    for b in blocks:
        grid = np.full((len(b["rows"]), n), -1, np.int32)
        for i, w in enumerate(b["rows"]):
            grid[i, :len(w)] = w
        b["rows"] = grid
    return blocks


def phrase(lists: list[np.ndarray | None], window: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Starts of a phrase: offset-adjusted lists intersected from the rarest term on."""
    order = np.argsort(counts[window], kind="stable")
    at = lists[window[order[0]]] - order[0]
    for k in order[1:]:
        if not len(at):
            break
        other, want = lists[window[k]], at + k
        i = np.searchsorted(other, want)
        at = at[(i < len(other)) & (other[np.minimum(i, len(other) - 1)] == want)]
    return at


def near(lists: list[np.ndarray | None], window: np.ndarray, reach: int, bounds: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int]]:
    """(start, length) of the shortest stretch of at most `reach` words around each place of a document's rarest term that
    holds every term of the window, in any order. `bounds` are the documents' first positions and ends; each document is
    searched by itself, and of its equally rare terms the window's first counts, so its neighbours change nothing."""
    terms = list(dict.fromkeys(window.tolist()))
    least = min((lists[t] for t in terms), key=len)
    holders = np.unique(np.searchsorted(bounds[0], least, "right") - 1)  # no other document has all terms
    cuts = np.array([np.searchsorted(lists[t], [b[holders] for b in bounds]) for t in terms])  # term, first or end, document
    sizes = cuts[:, 1] - cuts[:, 0]
    found = set()
    for d in np.flatnonzero(sizes.min(axis=0) > 0).tolist():
        own = [lists[t][a:b] for t, (a, b) in zip(terms, cuts[:, :, d].tolist())]
        rare = int(sizes[:, d].argmin())
        for p in own[rare].tolist():
            around = []
            for k, x in enumerate(own):
                a, b = np.searchsorted(x, (p - reach + 1, p + reach))
                around.append(x[a:b] if k != rare else np.array([p]))
            if any(not len(x) for x in around):
                continue
            best = None
            for lo in sorted({int(v) for x in around for v in x if v <= p}, reverse=True):
                i = [np.searchsorted(x, lo) for x in around]
                if all(j < len(x) for j, x in zip(i, around)):
                    hi = max(int(x[j]) for j, x in zip(i, around))
                    if hi - lo < reach and (best is None or hi - lo + 1 < best[1]):
                        best = (lo, hi - lo + 1)
            if best:
                found.add(best)
    return sorted(found)


def _segment(table: pa.Table, terms: dict[bytes, int]):
    lists: list[np.ndarray | None] = [None] * len(terms)
    counts = np.zeros(len(terms) + 1, np.int64)
    ids, lengths = [], []
    for row in table.select(["term", "n", "deltas"]).to_pylist():
        k = terms.get(row["term"]) if row["term"] is not None else None
        if k is not None:
            lists[k], counts[k] = decoded(row["deltas"]), row["n"]
    for i, (a, b) in enumerate(zip(table.column("doc_ids").to_pylist(), table.column("lengths").to_pylist())):
        if b is not None:
            ids, lengths = a, b
    offsets = np.cumsum(np.r_[0, np.asarray(lengths, np.int64) + 1])
    return lists, counts, ids, lengths, offsets


def _hits(block: dict, lists, counts) -> Iterator[tuple[int, np.ndarray]]:
    """(window number, starts) of the windows that occur in the segment; windows that lack a term cost one vector step."""
    grid = block["rows"]
    least = np.where(grid >= 0, counts[grid], np.iinfo(np.int64).max).min(axis=1)
    for k in np.flatnonzero(least > 0).tolist():
        at = phrase(lists, grid[k][grid[k] >= 0], counts)
        if len(at):
            yield k, at


def _by_segment(index: DataFrame, block: dict, fn, schema: str) -> DataFrame:
    sc = index.sparkSession.sparkContext
    shared = sc.broadcast(block)
    asked = index.where(F.col("term").isNull() | F.col("term").isin(list(block["terms"]))) if len(block["terms"]) <= 1000 else index
    return asked.groupBy("segment").applyInArrow(lambda t: fn(t, shared.value), schema)


def search(index: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Per document: n_words, the runs of hit words [start, end, ...] and the items whose windows occur in it."""
    blocks = test_blocks(benchmark, n) or [{"terms": {}, "rows": np.zeros((0, n), np.int32), "items": []}]

    def find(table: pa.Table, block: dict) -> pa.Table:
        lists, counts, ids, lengths, offsets = _segment(table, block["terms"])
        cover = np.zeros(offsets[-1] + 1, np.int32)
        items: dict[int, set] = {}
        for k, at in _hits(block, lists, counts):
            size = int((block["rows"][k] >= 0).sum())
            np.add.at(cover, at, 1)
            np.add.at(cover, at + size, -1)
            for d in np.unique(np.searchsorted(offsets, at, "right") - 1).tolist():
                items.setdefault(d, set()).add(block["items"][k])
        on = np.flatnonzero(np.diff(np.cumsum(cover) > 0, prepend=False, append=False)).reshape(-1, 2)
        doc = np.searchsorted(offsets, on[:, 0], "right") - 1
        runs = [[] for _ in ids]
        for d, (a, b) in zip(doc.tolist(), on.tolist()):
            runs[d] += [a - int(offsets[d]), b - int(offsets[d])]
        names = [sorted(x for x in items.get(d, ()) if x is not None) for d in range(len(ids))]
        seg = table.column("segment")[0].as_py()
        return pa.table({"segment": pa.array([seg] * len(ids), pa.int64()), "doc_no": pa.array(range(len(ids)), pa.int32()),
                         "doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(lengths, pa.int64()),
                         "runs": pa.array(runs, pa.list_(pa.int32())), "items": pa.array(names, pa.list_(pa.string()))})

    parts = [_by_segment(index, b, find, FOUND) for b in blocks]
    out = parts[0]
    if len(parts) > 1:  # a document's runs of all blocks; there are as many rows of it as blocks
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.groupBy("segment", "doc_no", "doc_id", "n_words").agg(
            F.flatten(F.collect_list("runs")).alias("runs"), F.flatten(F.collect_list("items")).alias("items"))
    return out


def matches(index: DataFrame, benchmark: DataFrame, n: int = 10, slop: int = 0) -> DataFrame:
    """Every place of a window: kind `phrase`, and with slop > 0 also kind `near`, a stretch of at most n + slop words that
    holds all terms of a window of n words in any order around the term that its document has least often."""
    def find(table: pa.Table, block: dict) -> pa.Table:
        lists, counts, ids, _, offsets = _segment(table, block["terms"])
        rows = []
        for k, at in _hits(block, lists, counts):
            size = int((block["rows"][k] >= 0).sum())
            rows += [(p, size, block["items"][k], "phrase") for p in at.tolist()]
        if slop:
            grid = block["rows"]
            least = np.where(grid >= 0, counts[grid], np.iinfo(np.int64).max).min(axis=1)
            for k in np.flatnonzero(least > 0).tolist():
                window = grid[k][grid[k] >= 0]
                rows += [(p, size, block["items"][k], "near") for p, size in near(lists, window, len(window) + slop, (offsets[:-1], offsets[1:] - 1))]
        out = []
        for p, size, item, kind in rows:
            d = int(np.searchsorted(offsets, p, "right")) - 1
            out.append((ids[d], item, p - int(offsets[d]), size, kind))
        columns = list(zip(*out)) or [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                        names=["doc_id", "item_id", "start", "n", "kind"])

    blocks = test_blocks(benchmark, n)
    out = [_by_segment(index, b, find, MATCHES) for b in blocks] or [index.sparkSession.createDataFrame([], MATCHES)]
    for p in out[1:]:
        out[0] = out[0].unionByName(p)
    return out[0]


def digest(found: DataFrame) -> DataFrame:
    """n_hit, n_items and the digest of the sorted item ids."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit, number, sha = [], [], []
            for runs, items in zip(b.column("runs").to_pylist(), b.column("items").to_pylist()):
                end = total = 0
                for a, z in sorted(zip(runs[::2], runs[1::2])):
                    total += max(0, z - max(a, end))
                    end = max(end, z)
                names = sorted(set(items))
                hit.append(total)
                number.append(len(names))
                sha.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_words"), pa.array(hit, pa.int64()), pa.array(number, pa.int64()),
                 pa.array(sha, pa.string()), pa.array([x > 0 for x in hit], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return found.mapInArrow(rows, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Index the documents for the test set's terms, search all its windows, one row per document."""
    terms = {t for b in test_blocks(benchmark, n) for t in b["terms"]}
    return digest(search(build(docs, terms), benchmark, n))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The rows of `docs`, columns untouched, in which no test window stands. The verdict belongs to a document's text: it is
    taken per doc_id and text hash, and the list of those to drop is written first, so that Spark knows its size when it
    picks the join (broadcast only below its threshold). Equal rows share their fate."""
    key = F.xxhash64("doc_id", F.xxhash64("text"), F.hash("text"))
    terms = {t for b in test_blocks(benchmark, n) for t in b["terms"]}
    found = search(build(docs.select(key.alias("doc_id"), "text"), terms), benchmark, n)
    drop = written(found.where(F.size("runs") > 0).select(F.col("doc_id").alias("_key")).distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_key"))  # whatever the columns are called
    return rows.join(drop, "_key", "left_anti").select("_row.*")
