"""Places of tokens by the rows that first show them."""

from textloom.operators import stats


def test_first_places(spark, monkeypatch):
    """Several order columns, nulls first; and before the early rows are known a number a token is sent, no struct."""
    plans, table = [], stats.settled
    monkeypatch.setattr(stats, "settled", lambda rows, name: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or table(rows, name))
    data = [(2, "b", ["q", "p"]), (1, "b", ["r", "r", "s"]), (1, "a", ["s", "t"]), (None, "z", ["u", "p"]), (3, "a", []), (4, "a", None), (3, "a", ["v", "q"])]
    got = {r["token"]: r["place"] for r in stats.first_seen_tokens(spark.createDataFrame(data, "x int, y string, tokens array<string>"), ["x", "y"]).collect()}
    assert [t for t, _ in sorted(got.items(), key=lambda i: i[1])] == ["u", "p", "s", "t", "r", "q", "v"] and sorted(got.values()) == list(range(7))
    assert plans and not any("min(struct" in p for p in plans)
