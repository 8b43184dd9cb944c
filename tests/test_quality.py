from aerolake import constants as K
from aerolake.operators import quality as D


def _df(spark):
    rows = [(1, "No Solo", 10.0), (2, "Em Voo", 1400.0), (2, "em voo", None), (None, "Taxiando", -1.0),
            (None, None, 5.0)]
    return spark.createDataFrame(rows, "k int, status string, speed double")


def test_unique_skips_null_keys(spark):
    got = D.dq_unique(_df(spark), "k").collect()
    assert [(r.k, r.n_rows) for r in got] == [(2, 2)]


def test_not_null(spark):
    assert D.dq_not_null(_df(spark), "k").count() == 2


def test_accepted_values_case_and_null(spark):
    strict = D.dq_accepted_values(_df(spark), "status", K.DECLARED_STATUS_VALUES)
    loose = D.dq_accepted_values(_df(spark), "status", K.DECLARED_STATUS_VALUES, case_sensitive=False)
    assert strict.count() == 4             # 'No Solo', 'Em Voo', 'em voo', 'Taxiando'; NULL passes
    assert [r.status for r in loose.collect()] == ["Taxiando"]
    alt = D.dq_accepted_values(_df(spark), "status", K.ALTERNATIVE_STATUS_VALUES)
    assert alt.count() == 4


def test_accepted_range_inclusive_null_passes(spark):
    got = D.dq_accepted_range(_df(spark), "speed", 0, 1300).collect()
    assert sorted(r.speed for r in got) == [-1.0, 1400.0]
    edge = spark.createDataFrame([(0.0,), (1300.0,)], "speed double")
    assert D.dq_accepted_range(edge, "speed", 0, 1300).count() == 0
    assert D.dq_accepted_range(edge, "speed", 0, 1300, inclusive=False).count() == 2


def test_relationships_and_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert [(r.k, r.n_rows) for r in D.dq_relationships(child, "k", parent, "pk").collect()] == [(3, 1)]
    assert [r.k for r in D.orphans(child, "k", parent, "pk").collect()] == [3]


def test_suite_verdict(spark):
    df = _df(spark)
    parent = spark.createDataFrame([(1,)], "pk int")
    checks = [D.Check("t", "unique", "k"), D.Check("t", "not_null", "k"),
              D.Check("t", "accepted_range", "speed", {"lo": 0, "hi": 1300}),
              D.Check("t", "accepted_values", "status", {"values": K.DECLARED_STATUS_VALUES,
                                                          "case_sensitive": False}),
              D.Check("t", "relationships", "k", {"to": "p", "field": "pk"}),
              D.Check("p", "not_null", "pk")]
    out = {(r.model, r.check_name, r.column_name): (r.violations, r.passed)
           for r in D.dq_run({"t": df, "p": parent}, checks).collect()}
    assert out == {("t", "unique", "k"): (1, False), ("t", "not_null", "k"): (2, False),
                   ("t", "accepted_range", "speed"): (2, False), ("t", "accepted_values", "status"): (1, False),
                   ("t", "relationships", "k"): (1, False), ("p", "not_null", "pk"): (0, True)}
