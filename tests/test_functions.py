"""Edge rows of the column functions."""

from pyspark.sql import functions as F

from relink.functions import dates, enums, predicates as pr, shapes as sh, text as tx
from relink.operators import audit as au, batching as ba, overlay as ov

HEX = "ABCDEF0123456789abcdef0123456789abcdef01"


def test_safe_id(col):
    big = 2147483648
    import hashlib
    made = int(hashlib.md5(str(big).encode()).hexdigest()[:8], 16) % 2147483647
    assert col([2147483647, big, None], enums.safe_id("v"), "bigint") == [2147483647, made, None]


def test_wall_clock(col):
    given = ["2026-01-13T13:31:55+00:00", "2026-01-13T13:31:55-05:00", "2026-01-13T13:31:55Z", "2026-01-13T13:31:55.123456",
             "2026-01-13", "garbage", None, "", "2026-13-45"]
    clock = "2026-01-13 13:31:55"
    assert col(given, dates.wall_clock("v")) == [clock] * 4 + ["2026-01-13 00:00:00", "garbage", None, None, "2026-13-45"]


def test_day(col):
    assert col(["2026-01-13T10:00:00", "2026-13-45", "abc", "", None], dates.day("v")) == [
        "2026-01-13", "2026-13-45", "abc", None, None]


def test_result_status(spark):
    rows = [(1, None), (2, None), (3, None), (4, None), (5, None), (9, "Fail"), (None, "pending"), (None, "xyz"), (None, None)]
    df = spark.createDataFrame(rows, "n int, w string").coalesce(1)
    assert [r[0] for r in df.select(enums.result_status("n", "w")).collect()] == [
        "passed", "blocked", "skipped", "retest", "failed", "failed", "in_progress", "skipped", "skipped"]


def test_run_status(col):
    assert col(["retest", "in_progress", "untested", "zzz"], enums.run_execution_status("v")) == [
        "blocked", "blocked", "untested", "skipped"]


def test_step_status(col):
    given = ["1", "2", "3", "5", "7", "4", '"block"', None]
    assert col(given, enums.step_status(F.parse_json("v"))) == [
        "passed", "failed", "blocked", "skipped", "in_progress", "passed", "blocked", "passed"]


def test_duration(spark):
    rows = [("-5", None, "3"), (None, None, "3"), ("x", "7", None)]
    df = spark.createDataFrame(rows, "a string, b string, t string").coalesce(1)
    ms = enums.duration_ms([F.col("a").try_cast("bigint"), F.col("b").try_cast("bigint")], [F.col("t").try_cast("bigint")])
    assert [r[0] for r in df.select(ms).collect()] == [None, 3000, 7]


def test_uniquify(col):
    out = ba.uniquify(F.split("v", ","))
    assert col(["A,A,A (1),A", "x"], out) == [["A", "A (1)", "A (1) (1)", "A (2)"], ["x"]]


def test_embedded_keys(col):
    uuid = "01234567-89AB-cdef-0123-456789abcdef"
    given = [f"![a](https://h/attachment/{HEX}/f.png)", f"/attachments/{uuid}/", "/attachment/short/", None]
    assert col(given, tx.embedded_keys("v")) == [[HEX.lower()], [uuid.replace("-", "").lower()], [], []]


def test_rewrite_keys(spark):
    ws, new_ws = "a" * 32, "b" * 32
    old, new = HEX.lower(), "c" * 40
    m = F.create_map(F.lit(old), F.lit(new))
    given = [
        f"![x](https://h/public/team/{ws}/attachment/{HEX}/f.png) and /attachment/{old}/",
        f"https://h/public/team/{ws}/attachment/{'d' * 40}/f.png",
        f"/attachments/{old}/x", None, "plain"]
    want = [
        f"![x](https://h/public/team/{new_ws}/attachment/{new}/f.png) and /attachment/{new}/",
        given[1], given[2], None, "plain"]
    df = spark.createDataFrame([(g,) for g in given], "v string").coalesce(1)
    assert [r[0] for r in df.select(tx.rewrite_keys("v", m, new_ws)).collect()] == want
    empty = F.create_map().cast("map<string,string>")
    assert [r[0] for r in df.select(tx.rewrite_keys("v", empty, new_ws)).collect()] == given


def test_rewriting_does_not_chain(spark):
    a, b, c = "a" * 40, "b" * 40, "c" * 40
    m = F.create_map(F.lit(a), F.lit(b), F.lit(b), F.lit(c))
    df = spark.createDataFrame([(f"/attachment/{a}/ /attachment/{b}/",)], "v string")
    assert df.select(tx.rewrite_keys("v", m)).first()[0] == f"/attachment/{b}/ /attachment/{c}/"


def test_row_identity(spark):
    df = spark.sql("select 9L as c, 'h' as h, array(named_struct('key','b','value','2'), named_struct('key','a','value','1')) as p,"
                   " cast(null as array<struct<key:string,value:string>>) as np, cast(null as string) as nh, cast(null as bigint) as nc")
    row = df.select(tx.row_identity("h", F.lit(None).cast("string"), "c", F.col("p"))[1], tx.row_identity("h", F.lit(" "), "c", F.col("np"))[1],
                    tx.row_identity("nh", F.lit(""), "c", F.col("np"))[1], tx.row_identity("h", F.lit(" s "), "c", F.col("p"))[1],
                    tx.row_identity("h", F.lit(""), "nc", F.col("np"))[1]).first()
    assert list(row) == ["9:a=1|b=2:h", "9:h", None, "s", "none:h"]


def test_run_finished(spark):
    v = "parse_json('{}')"
    rows = [("null", "null", "null", True)]
    cases = [
        ("parse_json('true')", "null", "null", True), ("null", "'2024-01-01'", "null", True), ("null", "null", "parse_json('\"Done \"')", True),
        ("null", "null", "parse_json('{\"title\":\"closed\"}')", True), ("null", "''", "parse_json('2')", False), ("parse_json('0')", "null", v, False)]
    for flag, end, state, want in cases:
        df = spark.sql(f"select cast({flag} as variant) as is_completed, cast({end} as string) as completed_at, cast({state} as variant) as state")
        assert df.select(pr.run_finished(df)).first()[0] is want
    assert rows


def test_defect_resolved(col):
    assert col(['"Resolved"', '"open"', "1", "0", None], pr.defect_resolved(F.parse_json("v"))) == [True, False, True, False, False]


def test_expected_results(spark):
    df = spark.sql("""select parse_json(s) as stats, n as results_count, parse_json(c) as cases from values
        ('{"total":5}', 1L, null), ('{"passed":2,"failed":3}', 1L, null), ('{}', 4L, null), (null, null, '[1,2,3]'), (null, null, null) as t(s, n, c)""").coalesce(1)
    assert [r[0] for r in df.select(au.expected_results(df)).collect()] == [5, 5, 4, 3, None]


def test_scope_labels(spark):
    rows = [(3, False, 3, "not judged (no plan)"), (3, True, 3, "honoured"), (3, True, 10, "expanded"), (3, True, 5, "unexpected"),
            (None, True, 10, "not judged (no cases)"), (0, True, 7, "not judged (no cases)")]
    df = spark.createDataFrame(rows, "sent int, has_plan boolean, actual int, want string").withColumn("plan_size", F.lit(10))
    out = df.select(au.scope_label("sent", "plan_size", "actual", "has_plan").alias("got"), "want").collect()
    assert all(r.got == r.want for r in out)
    late = spark.createDataFrame([(3, 3, True, "preserved and attached"), (3, 3, False, "preserved, not attached"), (3, 10, True, "expanded after update")],
                                 "before int, after int, attached boolean, want string")
    out = late.select(au.scope_after_update(F.lit(3), F.lit(10), "before", "after", "attached").alias("got"), "want").collect()
    assert all(r.got == r.want for r in out)


def test_flat_step(spark):
    df = spark.sql("""select parse_json('{"comment":"own","action":"","status":1,"data":{"action":"from data","comment":"no"},
        "execution":{"comment":" ","status":5,"action":"no","stdout":"out"}}') as s""").withColumn("f", ov.flat_step(F.col("s")))
    row = df.select(ov.step_text("f", ov.ACTION), ov.step_text("f", ov.COMMENT), ov.step_text("f", ov.ACTUAL), sh.as_text(ov.step_member("f", "status"))).first()
    assert list(row) == ["from data", "own", "out", "5"]


def test_params_and_groups(spark):
    df = spark.sql("""select parse_json('[{"name":"a","value":1},{"key":"a","Value":2},{"x":1},{"title":"b","selected":"s"}]') as l,
        parse_json('{}') as e, parse_json('["x"," ",["a",null,"b"],{"parameters":[{"title":"t"}]},[]]') as g""")
    row = df.select(sh.joined_entries(sh.first_params("e", "l")), sh.param_groups("g")).first()
    assert row[0] == "a=2|b=s" and row[1] == [["x"], ["a", "b"], ["t"]]


def test_short_titles_and_names(spark):
    first, last = tx.split_name("n", F.lit("me@x"))
    df = spark.createDataFrame([("  Ada  King Lovelace ",), ("Solo",), ("  ",)], "n string").coalesce(1)
    assert [tuple(r) for r in df.select(first, last).collect()] == [("Ada", "King Lovelace"), ("Solo", ""), ("me", "")]
    cut = df.select(tx.short_titles(F.array(F.repeat(F.lit("x"), F.lit(600)), F.lit(" ")))).first()[0]
    assert len(cut) == 1 and len(cut[0]) == 500 and cut[0].endswith("...")
