"""Quality rules against SQL; the plan runs no Python."""

import collections
import random

import compare

from pulsepanel.llm import line_quality, registry
from pulsepanel.llm.common import ROW, table


def test_query_equals_sql(spark, sf_dir):
    name = "op9_line_frequency"
    duck = compare.connect(sf_dir)
    assert compare.differences(spark, duck, registry.QUERIES[name], registry.SQL[name], sf_dir)[0] == []


def test_copies_that_count_once_equal_sql(spark, sf_dir):
    sql = registry.SQL["op9_line_frequency"].replace("count(DISTINCT (doc_id, text))", "count(DISTINCT text)")
    assert sql != registry.SQL["op9_line_frequency"]
    judge = lambda spark, sf: line_quality.judge(table(spark, sf, "documents"), copies_count_once=True)
    duck = compare.connect(sf_dir)
    assert compare.differences(spark, duck, lambda s, d: judge(s, d).drop(ROW), sql, sf_dir)[0] == []


def test_plan_is_native(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for df in (registry.QUERIES["op9_line_frequency"](spark, sf_dir), line_quality.remove_lines(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_removed_lines_against_plain_counts(spark):
    rng = random.Random(3)
    pool = ["Home", " home ", "Log  in", "log in", "", " ", "a b", "c", "d e f", "only \t here", "é"]
    rows = [
        (i % 70, "\n".join(rng.choices(pool, [9, 9, 9, 9, 5, 5, 2, 2, 2, 1, 1], k=rng.randrange(9))), h)
        for i in range(120)
        for h in [rng.choice("abn").replace("n", "") or None]
    ]
    rows += [(500, None, "a"), (None, "Home\nsweet home", "a"), (501, "Home", "a"), (501, "Home", "a")]
    schema = "doc_id long, text string, source string, gone string, at int"
    docs = spark.createDataFrame([(*r, f"x{i}", i) for i, r in enumerate(rows)], schema)
    for once in (False, True):
        normal = lambda line: " ".join(line.lower().split())
        where = collections.defaultdict(set)
        for i, t, h in rows:
            for line in (t or "").split("\n"):
                where[h, normal(line)].add(t if once else (i, t))
        hosts = collections.defaultdict(set)
        for i, t, h in rows:
            hosts[i, t].add(h)
        bad = lambda i, t, line: normal(line) and any(len(where[h, normal(line)]) > 12 for h in hosts[i, t])
        want = [
            (i, t if t is None else "\n".join(x for x in t.split("\n") if not bad(i, t, x)), h, f"x{n}", n)
            for n, (i, t, h) in enumerate(rows)
        ]
        out = line_quality.remove_lines(docs, limit=12, copies_count_once=once)
        assert out.columns == docs.columns
        assert sorted(map(tuple, out.collect()), key=lambda r: r[4]) == want
        assert any(a[1] != b[1] for a, b in zip(want, rows))


def test_boilerplate_goes_and_copies_stay(spark):
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(60))
    menu = " ".join(f"Menu {k}" for k in range(100))
    rows = [(i, f"{menu}\n{own(i)}", "a") for i in range(25)]  # 200 shared words, 60 own
    rows += [(100 + i, own(999), "a") for i in range(40)]  # copies of one text
    rows += [(200 + i, f"{menu.lower()}\n{own(i)} {own(i + 1)}", f"h{i}") for i in range(25)]  # one host each
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in line_quality.judge(docs, copies_count_once=True).collect()}
    assert not any(kept[i] for i in range(25))
    assert all(kept[100 + i] for i in range(40)) and all(kept[200 + i] for i in range(25))
    # by documents the line of forty copies is above the limit too
    kept = {r.doc_id: r.kept for r in line_quality.judge(docs).collect()}
    assert not any(kept[i] for i in range(25)) and not any(kept[100 + i] for i in range(40))
    assert all(kept[200 + i] for i in range(25))


def test_figures_of_one_text(spark):
    text = "a b c a b c\n\n x  y \nx y\n x  y \n#*$ %&|<>"
    docs = spark.createDataFrame([(1, text, None)], "doc_id long, text string, source string")
    row = line_quality.judge(docs).first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines) == (14, 20, 8, 1)
    # a b c twice, and x y x / y x y twice
    assert row.n_repeat_words == 12 and row.base_failed and not row.kept


def test_odd_rows(odd_documents, no_documents):
    rows = line_quality.judge(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert all((r.n_words, r.word_chars, r.kept) == (0, 0, False) for r in rows if r.doc_id in (2, 3, 4))
    assert [r.kept for r in rows if r.doc_id == 5] == [True]
    assert line_quality.judge(no_documents).count() == 0
    out = line_quality.remove_lines(odd_documents)
    assert out.columns == odd_documents.columns and out.count() == odd_documents.count()
    assert line_quality.remove_lines(no_documents).count() == 0
