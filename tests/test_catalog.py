from strataflow.plans.catalog import oracle_sql, positive_zero_rounds, queries


def test_round_rewrite_nested():
    s = positive_zero_rounds("SELECT round(a / round(b, 2), 6) AS x, myround(c) FROM t")
    assert s == "SELECT (round(a / (round(b, 2) + 0.0), 6) + 0.0) AS x, myround(c) FROM t"


def test_every_oracle_has_a_query_and_names_are_unique():
    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 130
    for name, sql in o.items():
        assert sql.lstrip().upper().startswith("WITH"), name  # stand-in views prepended
