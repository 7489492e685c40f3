"""The streamed audit against counting by hand: arrival orders, retractions, resumed runs, edge rows."""

import collections
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from relink.llm import filter_audit as fa
from relink.lineage import work_path

DOCS = "doc_id long, text string, lang string, mask int, part string"


def own(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(words) < 100) | 2 * (100 * len(set(words)) < 80 * len(words)) | 4 * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text)) | \
        8 * bool(re.search(r"[#$%&*|]", text))


def brute_masks(docs, labels):
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = collections.defaultdict(lambda: [0, 0, 0])
    for i, text, lang, *_ in docs:
        text = text or ""
        c = out[lang or "", own(text) | 16 * (i is not None and i > least[text])]
        c[0] += 1
        c[1] += i in good
        c[2] += i in toxic
    return {k: tuple(v) for k, v in out.items()}


def brute_audit(masks):
    out = []
    for part in {p for p, _ in masks}:
        here = {m: c for (p, m), c in masks.items() if p == part}
        first = collections.Counter()
        rows = []
        for order in itertools.permutations("ABCDE"):
            gone = 0
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                hit = {m: c for m, c in here.items() if m & bit and not m & gone}
                kept = sum(c[0] for m, c in here.items() if not m & (gone | bit))
                redundant = sum(c[0] for m, c in here.items() if m & bit and m & gone)
                removed, good, toxic = (sum(c[j] for c in hit.values()) for j in range(3))
                first[letter] += removed
                rows.append([part, "".join(order), step, kept, removed, redundant, here.get(bit, (0,))[0], good, toxic, letter])
                gone |= bit
        out += [tuple(r[:-1]) + (first[r[-1]],) for r in rows]
    return sorted(out)


def sample(seed, n):
    rng = random.Random(seed)
    texts = [" ".join(f"w{j}" for j in range(k)) for k in (99, 100, 101)] + ["word " * 120, "A" * 9 + "b" * 81, "A" * 10 + "b" * 90, "A" * 11 + "b" * 89, "x # y", None, "",
             " ".join(f"w{j}" for j in range(80)) + " w0" * 20, " ".join(f"w{j}" for j in range(79)) + " w0" * 21, "é" * 50, "a\x1cb \x0bc"]
    docs = [(rng.choice([None, *range(n)]) if rng.random() < 0.2 else i, rng.choice(texts), rng.choice(["en", "fr", None, ""]), 1, "clash") for i in range(n)]
    labels = [(rng.choice([None, *range(n)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(n)]
    return docs, labels


def of(df):
    return {(r.part, r["mask"]): (r.n, r.good, r.toxic) for r in df.collect()}


def land(spark, rows, path):
    spark.createDataFrame(rows, DOCS).coalesce(1).write.mode("append").parquet(path)


def test_masks():
    for text in (t or "" for t, in {(d[1],) for d in sample(1, 300)[0]}):
        assert fa.own_mask(text.encode()) == own(text)
    assert fa.own_mask(b"same " * 500_000) == 2


def sequential(now, rows, changes):
    """The state of one text after rows (id, mask, part, n, good, toxic, claim), one after the other, and what that changes."""
    for i, mask, part, *counts, claim in rows:
        if not claim:
            fa.add(changes, (part, mask), counts)
        elif now is not None and i > now[0]:
            fa.add(changes, (part, mask | fa.E), counts)
        else:
            if now is None or i < now[0]:
                for old, had in (now[2] if now else {}).items():
                    fa.add(changes, (old, mask), had, -1)
                    fa.add(changes, (old, mask | fa.E), had)
                now = (i, mask, {})
            fa.add(now[2], part, counts)
            fa.add(changes, (part, mask), counts)
    return now


def test_fold_equals_the_sequential_walk(spark):
    """Three batches of claims on a few texts, folded one after the other, against the walk row by row."""
    rng = random.Random(4)
    owners, states, changes, got = spark.createDataFrame([], fa.OWNERS), {}, {}, collections.defaultdict(lambda: [0, 0, 0])
    for _ in range(3):
        rows = [(bytes([k]), rng.randint(1, 6), k, rng.choice("ab"), rng.randint(1, 3), rng.randint(0, 1), 0, rng.random() < 0.9) for k in (rng.randrange(5) for _ in range(12))]
        for key, *row in rows:
            states[key] = sequential(states.get(key), [tuple(row)], changes)
        made, fresh = fa.fold(spark.createDataFrame(rows, fa.CLAIMS), owners.join(spark.createDataFrame([(r[0],) for r in rows if r[-1]], "key binary"), "key", "left_semi"))
        for r in made.collect():
            fa.add(got, (r.part, r["mask"]), (r.n, r.good, r.toxic))
        fresh = spark.createDataFrame(fresh.collect(), fa.OWNERS)
        owners = owners.join(fresh, "key", "left_anti").unionByName(fresh)
    assert {k: v for k, v in got.items() if any(v)} == {k: v for k, v in changes.items() if any(v)}
    kept = {(bytes(r.key), r.id, r.part): r.n for r in owners.collect()}
    assert kept == {(key, s[0], part): c[0] for key, s in states.items() if s for part, c in s[2].items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_late_smaller_ids_retract(spark, seed):
    """Files land with the largest ids first, so that every batch takes places over; the counters equal one count of all."""
    docs, labels = sample(seed, 150)
    path = work_path(spark, "landed")
    for rows in (docs[100:], docs[50:100], docs[:50]):
        land(spark, rows, path)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit("clash"))
    masks = fa.count_masks(spark, path, lab, batches=3)
    assert of(masks) == brute_masks(docs, labels)
    assert sorted(tuple(r) for r in fa.audit(masks).collect()) == brute_audit(brute_masks(docs, labels))


@pytest.mark.parametrize("fold", [1, 4, 1000])
def test_a_task_folds_its_rows(monkeypatch, fold):
    """However often a task sends what it has folded, states that fold the claims on come to the same counters."""
    monkeypatch.setattr(fa, "FOLD", fold)
    monkeypatch.setattr(fa.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 3})()))
    docs, labels = sample(6, 120)
    names = ["doc_id", "text", "part"]
    batches = [fa.pa.record_batch([fa.pa.array([d[j] if j != 1 else (d[1] or "").encode() for d in docs[a : a + 17]]) for j in (0, 1)]
                                  + [fa.pa.array([d[2] or "" for d in docs[a : a + 17]])], names=names) for a in range(0, 120, 17)]
    facts = [b for b in fa._facts(iter(batches))]
    with_labels = [fa.pa.record_batch([*b.columns, b.column("n"), fa.pa.array([0] * b.num_rows)], names=[*b.schema.names, "good", "toxic"]) for b in facts]
    states, changes, sent = {}, {}, 0
    for b in fa._claims(iter(with_labels)):
        for r in b.to_pylist():
            key = r.pop("key")
            states[key] = sequential(states.get(key), [tuple(r.values())], changes)
            sent += 1
    want = {k: (v[0], v[0], 0) for k, v in brute_masks(docs, []).items()}
    assert {k: tuple(v) for k, v in changes.items() if any(v)} == want and sent > 0


def test_resumed_run_reads_new_files_only(spark):
    docs, labels = sample(3, 90)
    path, progress, counters = (work_path(spark, x) for x in ("landed", "progress", "counters"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    land(spark, docs[45:], path)
    assert of(fa.count_masks(spark, path, lab, progress=progress, counters=counters)) == brute_masks(docs[45:], labels)
    again = fa.count_masks(spark, path, lab, progress=progress, counters=counters)
    assert of(again) == brute_masks(docs[45:], labels)  # nothing new: nothing counted twice
    land(spark, docs[:45], path)
    assert of(fa.count_masks(spark, path, lab, progress=progress, counters=counters)) == brute_masks(docs, labels)


def test_a_batch_that_is_run_again_counts_once(spark, monkeypatch):
    """The job dies after a batch has written its owners; the next run does that batch again."""
    docs, labels = sample(5, 90)
    path, progress, counters = (work_path(spark, x) for x in ("landed", "progress", "counters"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    land(spark, docs[45:], path)
    land(spark, docs[:45], path)
    real, calls = fa.fold, []

    class Dies:
        def __getattr__(self, _):
            raise RuntimeError("killed")

    def dying(claims, owners):
        calls.append(1)
        changes, kept = real(claims, owners)
        return (Dies() if len(calls) == 2 else changes), kept

    with monkeypatch.context() as m:
        m.setattr(fa, "fold", dying)
        with pytest.raises(Exception):
            fa.count_masks(spark, path, lab, batches=2, progress=progress, counters=counters)
    assert of(fa.count_masks(spark, path, lab, batches=2, progress=progress, counters=counters)) == brute_masks(docs, labels)


def test_edges(spark):
    path = work_path(spark, "landed")
    land(spark, [], path)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.filter_audit(spark, path, none).count() == 0
    path = work_path(spark, "landed")
    land(spark, [(7, "one two", None, 1, "x")] * 3 + [(None, "one two", "", 1, "x"), (8, "one two", "", 1, "x")], path)
    got = fa.filter_audit(spark, path, none).where("filter_order = 'AEBCD' and step <= 2").orderBy("step").collect()
    assert [(r.part, r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in got] == [("", 0, 5, 0, 4, 4 * 120 + 60), ("", 0, 0, 1, 0, 60)]
