"""Files in, files out, streams, and the registered queries against their SQL."""

import json
import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import oracle
from relink import lineage
from relink.operators import crosswalk as cx
from relink.sinks import tables
from relink.sources import entities as en, pages as pg, snapshots as sn
from relink.streaming import trace as tr

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL_SESSION = ("from pyspark.sql import SparkSession; s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
                 ".config('spark.sql.shuffle.partitions', '4').config('spark.sql.session.timeZone', 'UTC').getOrCreate()")


def in_process(code, folder):
    """Run code in a process of its own whose search path has neither this repository nor its tests."""
    path = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and not os.path.abspath(p).startswith(ROOT)]
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=300,
                          env={**os.environ, "PYTHONPATH": os.pathsep.join(path)})


def test_pages_from_files(spark, tmp_path):
    bodies = {
        "entity=suite/project_code=P": [{"status": True, "result": {"total": 3, "entities": [{"id": 1, "title": "a"}, {"id": 2, "parent_id": 1}]}},
                                        {"status": True, "result": [{"id": 3}]}],
        "entity=suite/project_code=Q": [{"status": False, "result": {"total": 9, "entities": [{"id": 7}]}}, {"status": True, "result": None}],
    }
    for folder, pages in bodies.items():
        (tmp_path / folder).mkdir(parents=True)
        for i, p in enumerate(pages):
            (tmp_path / folder / f"{i}.json").write_text(json.dumps(p))
    pages = pg.read_pages(spark, str(tmp_path))
    assert sorted((r.project_code, r.id, r.parent_id) for r in en.suites(pages).collect()) == [("P", 1, None), ("P", 2, 1), ("P", 3, None)]
    audit = {r.project_code: (r.landed, r.declared, r.complete) for r in pg.audit_pages(pages).collect()}
    assert audit["P"] == (3, 3, True) and audit["Q"][0] == 0


def test_crosswalk_roundtrip_and_scope_replacement(spark, tmp_path):
    path = str(tmp_path / "cw")
    rows = spark.createDataFrame([("case", "P", "1", "a"), ("case", "Q", "1", "b"), ("user", "*", "1", "c")], "entity string, scope string, source_key string, target_key string")
    tables.save_crosswalk(rows, path)
    tables.replace_scope(spark.createDataFrame([("case", "P", "9", "z")], rows.schema), path, "P")
    got = sorted(tuple(r) for r in sn.read_crosswalk(spark, path).select(*rows.columns).collect())
    assert got == [("case", "P", "9", "z"), ("case", "Q", "1", "b"), ("user", "*", "1", "c")]
    assert sorted(tuple(r) for r in cx.replace_slices(rows, rows.where("false"), "P").collect()) == [("case", "Q", "1", "b"), ("user", "*", "1", "c")]


def test_buckets(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"users": {"1": 10}, "cases": {"P": {"5": "x"}, "Q": {}}}))
    got = sorted(tuple(r) for r in sn.read_buckets(spark, str(tmp_path / "m.json")).collect())
    assert got == [("cases", "P", "5", "x"), ("users", "*", "1", "10")]


def test_stream_replays_pass_once_and_upserts_last(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text('{"id":"1","ts":"2024-01-01T00:00:00Z","v":1}\n{"id":"1","ts":"2024-01-01T00:01:00Z","v":2}\n{"id":"2","ts":"2024-01-01T00:02:00Z","v":3}\n')
    rows = tr.trace_stream(spark, str(src), "id string, ts timestamp, v bigint")
    assert sorted(r.id for r in tr.run_to_table(tr.once_per_id(rows, "id"), "t").collect()) == ["1", "2"]
    pairs = rows.select(F.lit("e").alias("entity"), F.lit("P").alias("scope"), F.col("id").alias("source_key"), F.col("v").cast("string").alias("target_key"), "v")
    path, progress = str(tmp_path / "cw"), str(tmp_path / "progress")
    tr.upsert_crosswalk(pairs, path, progress, ["v"])
    (src / "b.json").write_text('{"id":"2","ts":"2024-01-01T00:03:00Z","v":9}\n')
    tr.upsert_crosswalk(pairs, path, progress, ["v"])
    assert sorted((r.source_key, r.target_key) for r in sn.read_crosswalk(spark, path).collect()) == [("1", "2"), ("2", "9")]


def test_shared_folder_is_kept(spark):
    first = lineage.shared_dir(spark)
    assert lineage.shared_dir(spark) == first and lineage.work_path(spark, "x").startswith(lineage.run_path(spark))


def test_workers_find_the_package_from_any_folder(tmp_path):
    """Functions that run on executors import the package; it need not be the working folder."""
    code = f"import sys; sys.path[:0] = [{ROOT!r}]; import __spark_entry__ as e; {SMALL_SESSION}; " \
           "print(e.queries()['w06_capped_batches'](s, '/root/testdata/sf0.001').count())"
    done = in_process(code, tmp_path)
    assert done.returncode == 0 and done.stdout.strip().endswith("200"), done.stderr[-1500:]


def test_library_works_without_the_document_operators(tmp_path):
    """A copy without relink/llm, its tests and the pipeline registers and runs all other queries; so does one whose document
    operators lack a library of theirs."""
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    count = "q, o = e.queries(), e.oracle_sql(); assert not [n for n in q if n.startswith('op') or n == 'pipeline']; print(len(q), len(o), e.entry(s).count() >= 0)"
    done = in_process(f"import __spark_entry__ as e; {SMALL_SESSION}; {count}", tmp_path / "copy")
    assert done.returncode == 0 and done.stdout.split()[-1] == "True", done.stderr[-1500:]
    n, m = map(int, done.stdout.split()[-3:-1])
    assert n == m >= 191
    blocked = f"import sys; sys.path[:0] = [{ROOT!r}]; sys.modules['xxhash'] = None; import __spark_entry__ as e; {count.split('; print')[0]}; print(len(q))"
    done = in_process(blocked, tmp_path)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) == n, done.stderr[-1500:]


def test_every_query_has_sql():
    from relink import catalog

    catalog.load()
    assert set(catalog.QUERIES) == set(catalog.SQL) and set(catalog.QUERIES) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF)


QUICK = ("s01", "s13", "s17", "s21", "s22", "k02", "k03", "j01", "j04_", "j05_", "j08", "j11", "j12", "j15", "j18", "j20", "u03", "u04", "a03", "a06",
         "w01_", "w02", "w04", "w06", "w07_", "w08", "h01", "h05_", "m01", "m09", "d01", "x05_", "x13", "n05", "e03", "e06b", "e13", "e17", "e21", "t02")


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith(QUICK)])
def test_query_agrees_with_sql(spark, con, name):
    ok, message = oracle.compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, message
