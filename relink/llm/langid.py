"""Language identification by cross-parsing entropy.

Per language a suffix automaton is built over a bounded sample of labelled text. A text is parsed against each automaton:
follow it as long as it matches, count a phrase where it fails, start again. The language that needs the fewest phrases per
symbol wins; ties go to the first name. Letters are lowered, and every run of other characters is one blank.

The sample is the only thing that is bounded: at most DOCS_PER_LANGUAGE distinct training documents per language, those with
the least hashes of id and text, a slice of SLICE characters of each. All texts are parsed whole, in blocks of
BLOCK symbols that are walked side by side; a phrase ends with its block, for each language alike.

Defined results: a null text or one without letters gets `und` with score 0; no training text at all makes every result
`und`; rows without language or text teach nothing; a null doc_id is not held out; repeated rows are rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import map_batches

DOCS_PER_LANGUAGE, SLICE, BLOCK = 160, 320, 512
FOLDS, HELD_OUT, UNKNOWN = 4, 2, "und"
#: Symbols: the blank, a letter that no sample has, then the samples' letters; the last one parts slices.
BLANK, OTHER = 0, 1


def fold() -> Column:
    """crc32 of the id as text, modulo FOLDS; a null id counts as crc32 zero."""
    return F.pmod(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)), F.lit(FOLDS))


def sample(docs: DataFrame) -> list[tuple[str, str]]:
    """(lang, slice) of the DOCS_PER_LANGUAGE training documents of each language with the least hashes of id and text. Equal
    rows teach once, so neither null nor repeated ids let more in; about twice as many pass the hash, then the rest is cut."""
    train = docs.where((fold() != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    counts = {r[0]: r[1] for r in train.groupBy("lang").agg(F.approx_count_distinct("h")).collect()}  # a row for each language
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, 2 * DOCS_PER_LANGUAGE / n))])
    at = F.pmod(F.xxhash64("h"), F.greatest(F.length("text") - SLICE, F.lit(0)) + 1).cast("int") + 1
    place = F.pmod("h", F.lit(1 << 52))
    passed = train.where(place < share[F.col("lang")] * float(1 << 52)).groupBy("lang", "h").agg(F.min(F.col("text").substr(at, F.lit(SLICE))).alias("slice"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(place, "h"))
    chosen = passed.withColumn("rank", rank).where(F.col("rank") <= DOCS_PER_LANGUAGE)
    return sorted((r[0], r[1]) for r in chosen.select("lang", "slice").collect())


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def symbols(text: str, alphabet: dict[str, int]) -> np.ndarray:
    """Symbols of a text; runs of anything but letters are one blank."""
    return _coded(np.frombuffer(text.encode("utf-32-le", "replace"), "<u4"), _table(tuple(alphabet.items())))


@lru_cache(2)
def _table(alphabet: tuple[tuple[str, int], ...]) -> np.ndarray:
    table = np.where(_letters(), OTHER, BLANK).astype(np.uint8)
    known = dict(alphabet)
    for c in range(0x110000):
        if table[c] == OTHER and (s := known.get(chr(c).lower())):
            table[c] = s
    return table


def _coded(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    s = table[codes]
    return s[(s != BLANK) | np.r_[True, s[:-1] != BLANK]] if len(s) else s


def automaton(s: list[int], size: int) -> np.ndarray:
    """Transitions [state, symbol] of the suffix automaton of `s`; state 0 stands for none, 1 is the root."""
    go: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [0, 0], 1
    for c in s:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(1)
        p, last = last, new
        while p and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if not p:
            continue
        q = go[p][c]
        if length[q] != length[p] + 1:
            twin = len(go)
            go.append(dict(go[q]))
            length.append(length[p] + 1)
            link.append(link[q])
            link[q] = twin
            while p and go[p].get(c) == q:
                go[p][c] = twin
                p = link[p]
            q = twin
        link[new] = q
    table = np.zeros((len(go), size), np.int32)
    for state, out in enumerate(go):
        for c, to in out.items():
            table[state, c] = to
    return table


def train(slices: list[tuple[str, str]], most: int = 200) -> dict:
    """The automata by language over a shared alphabet of the `most` commonest letters."""
    seen: dict[str, int] = {}
    for _, t in slices:
        for c in t.lower():
            if c.isalpha():
                seen[c] = seen.get(c, 0) + 1
    alphabet = {c: i + 2 for i, c in enumerate(sorted(seen, key=lambda c: (-seen[c], c))[:most])}
    parting = len(alphabet) + 2
    texts: dict[str, list[int]] = {}
    for lang, t in slices:
        texts.setdefault(lang, []).extend([*symbols(t, alphabet).tolist(), parting])
    return {"alphabet": alphabet, "langs": sorted(texts), "go": [automaton(texts[k], parting + 1) for k in sorted(texts)]}


def phrases(pieces: list[np.ndarray], go: np.ndarray) -> np.ndarray:
    """Phrases that each piece needs; pieces are walked side by side, longest first."""
    width = go.shape[1]
    flat, restart = go.ravel(), np.where(go[1] > 0, go[1], 1)
    literal = go[1] == 0  # a symbol that the language lacks is a phrase of its own
    lengths = np.array([len(p) for p in pieces], np.int64)
    order = np.argsort(-lengths, kind="stable")
    grid = np.zeros((lengths.max(initial=0), len(pieces)), np.uint8)
    for column, k in enumerate(order.tolist()):
        grid[:lengths[k], column] = pieces[k]
    live = np.searchsorted(-lengths[order], -np.arange(len(grid)), "left")
    state, count = np.ones(len(pieces), np.int64), np.ones(len(pieces), np.int64)
    for row, n in zip(grid, live.tolist()):
        c = row[:n]
        to = flat[state[:n] * width + c]
        failed = to == 0
        count[:n] += failed
        count[:n] += failed & literal[c]
        state[:n] = np.where(failed, restart[c], to)
    out = np.empty(len(pieces), np.int64)
    out[order] = count
    return out


def verdicts(texts: list[str | None], model: dict) -> tuple[list[str], list[float], list[float | None]]:
    """Language, score (1 - fewest / second fewest phrases) and phrases per symbol of each text."""
    table, langs = _table(tuple(model["alphabet"].items())), model["langs"]
    coded = [_coded(np.frombuffer((t or "").encode("utf-32-le", "replace"), "<u4"), table) for t in texts]
    live = [i for i, s in enumerate(coded) if langs and s.any()]
    pieces, owner = [], []
    for i in live:
        for a in range(0, len(coded[i]), BLOCK):
            pieces.append(coded[i][a:a + BLOCK])
            owner.append(i)
    need = np.zeros((len(langs), len(texts)), np.int64)
    for k, go in enumerate(model["go"]):
        np.add.at(need[k], owner, phrases(pieces, go))
    pred, score, rate = [UNKNOWN] * len(texts), [0.0] * len(texts), [None] * len(texts)
    for i in live:
        column = need[:, i]
        best = int(column.argmin())
        rest = np.delete(column, best)
        pred[i] = langs[best]
        score[i] = float(1 - column[best] / rest.min()) if len(rest) else 1.0
        rate[i] = float(column[best] / len(coded[i]))
    return pred, score, rate


def predict(docs: DataFrame, slices: list[tuple[str, str]]) -> DataFrame:
    """Every row's doc_id and held_out with lang_pred, score and phrases_per_symbol."""
    shared = docs.sparkSession.sparkContext.broadcast(train(slices))  # bounded by the sample

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, score, rate = verdicts(b.column(2).to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score", "phrases_per_symbol"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold() == HELD_OUT).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return map_batches(slim, rows, "doc_id long, held_out boolean, lang_pred string, score double, phrases_per_symbol double")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, sample(docs))


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, columns untouched, whose language can be told. The verdict falls where the text is read, so no
    text is shuffled. Without any labelled training text no verdict can be given, and every row with a letter stays."""
    slices = sample(docs)
    shared = docs.sparkSession.sparkContext.broadcast(train(slices))
    at = docs.columns.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, model = b.column(at).to_pylist(), shared.value
            known = [p != UNKNOWN for p in verdicts(texts, model)[0]] if model["langs"] else [bool(symbols(t or "", {}).any()) for t in texts]
            yield b.filter(pa.array(known, pa.bool_()))

    return map_batches(docs, rows, docs.schema)
