from pyspark.sql import functions as F

from gazetick.llm.mixing import mix_documents, mix_plan, source_targets

SCHEMA = "doc_id long, text string, source string, target string"


def targets_by_hand(sizes, weights=(1, 2, 3), most=3.0):
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    held = {}
    while True:
        rest = sum(sizes.values()) - sum(held.values())
        open_ = [n for n in names if n not in held]
        unit = rest / sum(weight[n] for n in open_) if open_ else 0
        over = [n for n in open_ if weight[n] * unit > most * sizes[n]]
        if not over:
            return held | {n: weight[n] * unit for n in open_}
        held |= {n: most * sizes[n] for n in over}


def test_targets(spark):
    sizes = {"a": 5, "b": 1000, "c": 10, "Z": 300, "é": 40, None: 7, "empty": 0}
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    want = targets_by_hand(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert abs(sum(got.values()) - sum(sizes.values())) < 1e-6


def test_rows(spark):
    rows = [(i, "w " * (i % 9), "hot" if i % 3 else f"s{i % 7}", "x") for i in range(3000)]
    rows += [(None, None, None, "x"), (3000, "", "empty", None), (3000, "", "empty", None), (3001, "long " * 50_000, "s1", "y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mix_plan(docs)
    assert plan.count() == len(rows)
    assert plan.filter("_mix_copies > 3 or _mix_copies < 0").count() == 0
    assert plan.filter("source = 'empty' and (_mix_target <> 0 or _mix_copies <> 0)").count() == 0
    near = plan.filter("_mix_size < 100").groupBy("source").agg(F.sum(F.expr("_mix_size * _mix_copies")).alias("t"), F.sum("_mix_size").alias("s"),
                                                                F.first(F.expr("try_divide(_mix_target, _mix_source_size)")).alias("rate"))
    for r in near.filter("s > 2000").collect():
        assert abs(r.t - r.rate * r.s) < 0.15 * r.rate * r.s
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == plan.agg(F.sum("_mix_copies")).first()[0]
    assert sorted(map(str, mixed.groupBy("doc_id").count().collect())) == sorted(map(str, mix_documents(docs).groupBy("doc_id").count().collect()))


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mix_plan(docs).count() == 0 and mix_documents(docs).count() == 0
    nothing = spark.createDataFrame([(1, None, "a", "x"), (2, " ", None, "x")], SCHEMA)
    assert {r._mix_copies for r in mix_plan(nothing).collect()} == {0}


def test_many_sources_use_the_salted_join(spark, monkeypatch):
    from gazetick.llm import common

    docs = spark.createDataFrame([(i, "w " * (i % 5 + 1), None if i % 4 == 0 else f"s{i % 3}", "x") for i in range(200)], SCHEMA)
    small = sorted(map(str, mix_plan(docs).collect()))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert sorted(map(str, mix_plan(docs).collect())) == small
