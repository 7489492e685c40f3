"""Language-model scores by subword lattices.

A word's lattice has an arc for every piece of an existing subword vocabulary at every place where the piece stands, and
one arc that spans the whole word. Arcs are weighted by unigram scores learned from the training documents: the word's own
share, and the pieces' shares; the vocabulary itself is given and not trained. The forward recursion sums over all
segmentations, so a word's score is its marginal probability; as no arc crosses white space, the marginal of a document's
words is their product. There is a set of scores for each class of training documents (their `lang`, the CLASSES commonest,
the last one pooling the rest), and the document's marginal sums over the classes by their shares as well; the class of a
scored document is not looked at.

With c, N, V the counts of a class's training tokens, C and M those of all classes, e = V / (N + V) (what novel words may
expect) and OWN the weight of the class's own counts:

    P(word) = (1 - e) (OWN c / N + (1 - OWN) C / M) + e * sum over segmentations of first(p1) next(p2) ... next(pk) stop

`first` is a distribution over the vocabulary's pieces that open a word, `next` and `stop` one over those that go on and
the word's end. As it serves novel words, it counts every distinct training word of the class once; each piece has
SMOOTHING pseudo-counts, and single bytes are pieces, so that every word has a segmentation. The recursion carries
mantissas and one log10 offset, so that long words don't vanish.

The counts of all words, and the scores of all words, are tables that grow with the corpus; only the commonest HOT words of
at most HOT_BYTES bytes are broadcast, to spare their shuffle. Other words are joined; none of them but an overlong one can
be common, and that is split by adaptive execution.

Defined results: a null text is empty and has the closing token alone; a null doc_id counts as crc32 zero, so it trains; a
null lang is a class of its own; repeated rows are rows and count twice in training; without training documents only the
spelling counts; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_batches, raw, space_words, written

VOCABULARY = "piece_bpe_32k.model"
FOLDS, HELD_OUT = 7, 2
SMOOTHING, OWN, CLASSES = 0.1, 0.9, 8
HOT, HOT_BYTES = 200_000, 64
#: Distinct words that a task counts before it hands them on.
HELD = 300_000
OPENING = "▁"


@lru_cache(2)
def vocabulary(name: str):
    """(tokenizer, bytes of pieces that open a word, bytes of those that go on) by id; None where a piece has no such use."""
    import public_tokenizers as public
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public.path(name))
    opening: list[bytes | None] = []
    going: list[bytes | None] = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            opening.append(None)
            going.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or OPENING in piece[1:] or piece[1:] and piece[1:].isspace():
            opening.append(None)
            going.append(None)
        elif piece.startswith(OPENING):
            opening.append(piece[1:].encode())
            going.append(None)
        else:
            opening.append(None)
            going.append(piece.encode())
    return model, opening, going


def held_out() -> Column:
    return F.pmod(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)), F.lit(FOLDS)) == HELD_OUT


def classes_of(docs: DataFrame) -> tuple[Column, list[int]]:
    """(class number of a training document, training documents of each class)."""
    name = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    found = sorted(((r[1], r[0]) for r in docs.where(~held_out()).groupBy(name.alias("c")).count().select("c", "count").collect()),
                   key=lambda x: (-x[0], x[1]))  # a row for each language
    own = [c for _, c in found[:CLASSES]] if len(found) <= CLASSES else [c for _, c in found[:CLASSES - 1]]
    sizes = [n for n, _ in found[:len(own)]] + ([sum(n for n, _ in found[len(own):])] if len(found) > len(own) else [])
    number = F.lit(max(0, len(sizes) - 1))
    for k, c in enumerate(own):
        number = F.when(name == c, k).otherwise(number)
    return number, sizes or [0]


def word_counts(docs: DataFrame, number: Column, k: int) -> DataFrame:
    """(word, n, c0, c1, ...): a word's tokens in all documents and in the training documents of each class."""
    names = ["word", "n", *(f"c{i}" for i in range(k))]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = [Counter() for _ in range(k + 1)]  # the last one: documents held out

        def flush() -> pa.RecordBatch:
            words = list(set().union(*tallies))
            counts = [np.fromiter(map(t.get, words, repeat(0)), np.int64, len(words)) for t in tallies]
            for t in tallies:
                t.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(sum(counts)), *map(pa.array, counts[:k])], names)

        for b in batches:
            for own, text in zip(b.column(0).to_pylist(), b.column(1)):
                tallies[k if own is None else own].update(space_words(text.as_py()))
            if sum(map(len, tallies)) > HELD:
                yield flush()
        if any(tallies):
            yield flush()

    slim = docs.select(F.when(~held_out(), number).cast("int").alias("own"), raw("text"))
    parts = map_batches(slim, rows, ", ".join(["word binary", *(f"{c} long" for c in names[1:])]))
    return written(parts.groupBy("word").agg(*(F.sum(c).alias(c) for c in names[1:])), "words")


def piece_scores(words: DataFrame, k: int, name: str = VOCABULARY) -> dict:
    """Scores of the vocabulary's pieces in each class. Their number is the vocabulary's, so they fit the driver."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _, _ = vocabulary(name)
        size = model.get_piece_size()
        first, after, stop = np.zeros((k, size), np.int64), np.zeros((k, size), np.int64), np.zeros((k, 1), np.int64)
        for b in batches:
            texts = [w.decode("utf-8", "replace") for w in b.column(0).to_pylist()]
            known = np.stack([b.column(i + 1).to_numpy() > 0 for i in range(k)], axis=1)
            coded = model.encode(texts, num_threads=1)
            for i in range(k):
                own = [ids for ids, yes in zip(coded, known[:, i].tolist()) if yes and ids]
                first[i] += np.bincount([ids[0] for ids in own], minlength=size)
                after[i] += np.bincount([x for ids in own for x in ids[1:]], minlength=size)
                stop[i] += len(own)
        for kind, counts in (("first", first), ("next", after), ("stop", stop)):
            i, j = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(i), pa.string()), pa.array(i), pa.array(j), pa.array(counts[i, j])], ["kind", "own", "id", "c"])

    known = map_batches(words.select("word", *(f"c{i}" for i in range(k))), rows, "kind string, own long, id long, c long")
    counts = {(r[0], r[1], r[2]): r[3] for r in known.groupBy("kind", "own", "id").agg(F.sum("c")).collect()}
    _, opening, going = vocabulary(name)
    return scores_of(counts, k, opening, going)


def scores_of(counts: dict, k: int, opening: list[bytes | None], going: list[bytes | None]) -> dict:
    """For every piece its probability in each class, and how far pieces with the same two first bytes reach."""
    first: dict[bytes, np.ndarray] = {}
    after: dict[bytes, np.ndarray] = {}
    for i, (a, b) in enumerate(zip(opening, going)):
        for kind, piece, table in (("first", a, first), ("next", b, after)):
            if piece is not None:
                table[piece] = table.get(piece, 0.0) + np.array([counts.get((kind, c, i), 0) + SMOOTHING for c in range(k)])
    stop = np.array([counts.get(("stop", c, 0), 0) + SMOOTHING for c in range(k)])
    total, more = sum(first.values()), sum(after.values()) + stop
    reach: dict[bytes, int] = {}
    for piece in after:
        reach[piece[:2]] = max(reach.get(piece[:2], 0), len(piece))
    return {"first": {p: tuple((v / total).tolist()) for p, v in first.items()}, "next": {p: tuple((v / more).tolist()) for p, v in after.items()},
            "stop": (stop / more).tolist(), "reach": reach, "longest": max(map(len, first)), "classes": k}


def lattice(word: bytes, pieces: dict) -> list[float]:
    """log10 of the probability of all segmentations of a word in each class, by the forward recursion over its bytes."""
    first, after, reach = pieces["first"], pieces["next"].get, pieces["reach"].get
    n = len(word)
    into: list[list[float] | None] = [None] * (n + 1)
    offset = 0.0
    for j in range(min(n, pieces["longest"]) + 1):
        x = first.get(word[:j])
        if x is not None:
            into[j] = list(x)
    for i in range(n):
        at = into[i]
        if at is None:
            continue
        if i > 12 and max(at) < 1e-150:  # all that is still ahead is scaled alike
            offset -= 150
            for j in range(i, n + 1):
                if into[j] is not None:
                    into[j] = [x * 1e150 for x in into[j]]
                elif j > i + 64:
                    break
            at = into[i]
        for j in range(i + 1, min(n, i + reach(word[i:i + 2], 1)) + 1):
            x = after(word[i:j])
            if x is not None:
                to = into[j]
                into[j] = [a * b for a, b in zip(at, x)] if to is None else [t + a * b for t, a, b in zip(to, at, x)]
        into[i] = None
    return [math.log10(max(x, 1e-320)) + offset + math.log10(s) for x, s in zip(into[n], pieces["stop"])]


class Shares:
    """Token probabilities of each class from counts of tokens and distinct tokens."""

    def __init__(self, tokens: list[int], distinct: list[int]):
        self.tokens, self.all = tokens, sum(tokens)
        self.novel = [v / (n + v) if n else 1.0 for n, v in zip(tokens, distinct)]

    def logs(self, counts: list[int], spelled: list[float] | None) -> list[float]:
        """log10 P of a token in each class; `spelled` is the log10 probability of its spelling (none for the end)."""
        out, every = [], sum(counts)
        for c, n, e, s in zip(counts, self.tokens, self.novel, spelled or [-math.inf] * len(counts)):
            share = (1 - e) * (OWN * c / n + (1 - OWN) * every / self.all) if n else 0.0
            if share and s > -300:
                out.append(math.log10(share + e * 10.0 ** s))
            elif share:
                out.append(math.log10(share))
            else:
                out.append(math.log10(e) + s if s > -math.inf else math.log10(0.5))
        return out


def score(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    number, ends = classes_of(docs)
    k = len(ends)
    own, places = [f"c{i}" for i in range(k)], [f"s{i}" for i in range(k)]
    words = word_counts(docs, number, k)
    seen = words.agg(*(F.sum(c) for c in own), *(F.count_if(F.col(c) > 0) for c in own), F.count_if(sum(F.col(c) for c in own) > 0)).first()
    shares = Shares([(seen[i] or 0) + ends[i] for i in range(k)], [seen[k + i] + (ends[i] > 0) for i in range(k)])
    total, distinct = shares.all, seen[2 * k] + (sum(ends) > 0)
    pieces = spark.sparkContext.broadcast(piece_scores(words, k, name))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = list(zip(*(b.column(c).to_pylist() for c in own)))
            whole = [shares.logs(c, lattice(w, pieces.value)) for w, c in zip(b.column("word").to_pylist(), counts)]
            base = [math.log10((sum(c) + 1) / (total + distinct + 1)) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [b.column("word"), b.column("n"), pa.array([int(sum(c) > 0) for c in counts], pa.int64()), pa.array(base, pa.float64()),
                 *(pa.array(x, pa.float64()) for x in zip(*whole))], ["word", "n", "w_known", "w_base", *(f"w_{s}" for s in places)])

    kinds = ", ".join(["word binary, n long, w_known long, w_base double", *(f"w_{s} double" for s in places)])
    table = written(map_batches(words, scored, kinds), "word-scores")
    hot = spark.sparkContext.broadcast(table.where(F.octet_length("word") <= HOT_BYTES).orderBy(F.desc("n"), "word").limit(HOT).drop("n").toArrow())
    end = np.array([float(sum(ends) > 0), math.log10((sum(ends) + 1) / (total + distinct + 1)), *shares.logs(ends, None)])
    names = ["row", "word", "tf", "doc_id", "held_out", "n_tokens", "known", "base", *places]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        get = {w: i for i, w in enumerate(hot.value.column("word").to_pylist())}.get
        grid = np.stack([hot.value.column(c).to_numpy() for c in ("w_known", "w_base", *(f"w_{s}" for s in places))], axis=1)
        for b in batches:
            rows, rare, times, ids, sums = [], [], [], [], []
            for text in b.column(2):
                bag = Counter(space_words(text.as_py()))
                places_of = [get(w, -1) for w in bag]
                at, tf = np.array(places_of, np.int64), np.fromiter(bag.values(), np.float64, len(bag))
                usual = at >= 0
                sums.append(end + tf[usual] @ grid[at[usual]])
                more = [w for w, p in zip(bag, places_of) if p < 0]
                rare += more
                rows += [row] * len(more)
                times += [bag[w] for w in more]
                ids.append((row, bag.total() + 1))
                row += 1
            # no word holds a blank: a document's own row meets no word in the join, and no two of them meet
            m, d = len(rows), len(ids)
            sums_of = np.array(sums).reshape(d, 2 + k)
            blank = pa.nulls(m)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows + [r for r, _ in ids], pa.int64()), pa.array(rare + [b" %d" % r for r, _ in ids], pa.binary()),
                 pa.array(times + [0] * d, pa.int64()), pa.concat_arrays([blank.cast(pa.int64()), b.column(0)]), pa.concat_arrays([blank.cast(pa.bool_()), b.column(1)]),
                 pa.array([None] * m + [n for _, n in ids], pa.int64()), pa.array([None] * m + sums_of[:, 0].astype(int).tolist(), pa.int64()),
                 *(pa.array([None] * m + sums_of[:, j].tolist(), pa.float64()) for j in range(1, 2 + k))], names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), raw("text"))
    schema = ", ".join(["row long, word binary, tf long, doc_id long, held_out boolean, n_tokens long, known long, base double", *(f"{s} double" for s in places)])
    met = map_batches(slim, parts, schema).join(table.drop("n"), "word", "left")
    both = lambda c: F.sum(F.coalesce(F.col(c), F.col("tf") * F.col(f"w_{c}"))).alias(c)
    sums = met.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
                                  both("known"), both("base"), *(both(s) for s in places))
    logs = [F.col(s) + math.log10(n / sum(ends) if sum(ends) else 1.0) for s, n in zip(places, ends)]
    most = F.greatest(*logs) if k > 1 else logs[0]
    return sums.withColumn("_most", most).select(
        "doc_id", "held_out", "n_tokens", F.col("known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("_most") + F.log10(sum(F.pow(F.lit(10.0), x - F.col("_most")) for x in logs))).alias("score"))
