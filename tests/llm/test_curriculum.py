import re

import duckdb
import pytest

from strata.llm import curriculum, oracles
from tests.llm import cases


def brute_targets(sizes, plan):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: plan.weights[i % len(plan.weights)] for i, s in enumerate(names)}
    target, free, left = {}, list(names), plan.share[0] / plan.share[1] * sum(sizes.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > plan.most * sizes[s]]
        if not over:
            return target | {s: unit * weight[s] for s in free}
        for s in over:
            target[s] = plan.most * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def check(docs, plan=curriculum.Plan()):
    out = [r.asDict() for r in curriculum.mix(docs, plan).collect()]
    words = {}
    for r in docs.select("doc_id", "text", "source").collect():
        words.setdefault(r.source, []).append(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
    sizes = {s: sum(w) for s, w in words.items()}
    want = brute_targets(sizes, plan)
    assert sorted((str(r["source"]), r["size"]) for r in out) == sorted((str(s), n) for s, w in words.items() for n in w)
    for s, size in sizes.items():
        mine = [r for r in out if r["source"] == s]
        assert {r["source_size"] for r in mine} == {size}
        assert mine[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in mine) - want[s]) < 1 + 1e-9 * want[s]
        assert all(0 <= r["taken"] <= plan.most * r["size"] for r in mine)
        assert all((r["position"] is None) == (r["taken"] == 0) for r in mine)
        # the integral of the schedule up to a position is the demand before it
        starts = sorted((x, r["size"]) for r in mine for x in r["positions"])
        assert all(0 <= x <= 1 for x, _ in starts)
        assert all(len(r["positions"]) == -(-r["taken"] // r["size"]) for r in mine if r["size"])
    return out


def test_awkward_rows(spark):
    out = check(cases.documents(spark))
    assert len(out) == len(cases.rows())
    clash = curriculum.mix(cases.documents(spark, clash=True)).collect()
    assert sorted(map(str, clash)) == sorted(str(r) for r in curriculum.mix(cases.documents(spark)).collect())
    assert curriculum.mix(cases.nothing(spark)).collect() == []


def test_sizes_at_both_ends_and_repeated_rows(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(1, "a"), (1, "a"), (5000, "b"), (40, "c"), (7, None), (900, "d"), (0, "e"), (3, "\U0001f600"), (3, "￮")])]
    docs = spark.createDataFrame(rows + [rows[2]] * 30 + [(None, None, None)], "doc_id bigint, text string, source string")
    check(docs)
    check(docs, curriculum.Plan(share=(5, 1)))  # more than all can give: every source stops
    check(docs, curriculum.Plan(share=(1, 10), weights=(1, 7), most=3))


def test_ranges_do_not_change_the_result(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "x " * (i % 13), "hot" if i % 3 else f"s{i % 5}") for i in range(900)], "doc_id bigint, text string, source string")
    one = sorted(map(str, curriculum.mix(docs).collect()))
    monkeypatch.setattr(curriculum, "RANGE_ROWS", 2)
    monkeypatch.setattr(curriculum, "LEVEL_DIGITS", 1)
    assert curriculum.digits_for(900) == 3
    assert sorted(map(str, curriculum.mix(docs).collect())) == one
    check(docs)


def test_inverse_of_the_integral(spark):
    for knots in curriculum.Plan().schedules:
        shares = spark.createDataFrame([(i / 97,) for i in range(98)], "y double")
        for y, t in shares.select("y", curriculum.moment(shares.y, knots)).collect():
            area = sum((min(t, b[0]) - a[0]) * (a[1] + a[1] + (b[1] - a[1]) * (min(t, b[0]) - a[0]) / (b[0] - a[0])) / 2 for a, b in zip(knots, knots[1:]) if t > a[0])
            whole = sum((b[1] + a[1]) / 2 * (b[0] - a[0]) for a, b in zip(knots, knots[1:]))
            assert area / whole == pytest.approx(y, abs=1e-12)
    with pytest.raises(ValueError):
        curriculum.Plan(schedules=(((0.0, 1.0), (0.5, 1.0)),))


def test_training_order(spark):
    mixed = curriculum.mix(cases.documents(spark))
    rows = curriculum.training_order(mixed).collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert len(rows) == sum(len(r.positions) for r in mixed.collect())


def test_native_plan_and_hot_source(spark):
    from strata.plans.inspect import plan_text
    text = plan_text(curriculum.mix(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text


def test_equals_sql(spark):
    from strata.llm.queries import op11_curriculum_mix
    from tools.check_oracle import rows_of
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    cur = con.execute(oracles.CURRICULUM_MIX)
    names = [c[0] for c in cur.description]
    df = op11_curriculum_mix(spark, "/root/testdata/sf0.001")
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())
