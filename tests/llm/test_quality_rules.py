"""The lasso of op3 chooses among all rules of the forest."""

from cardwatch.llm import common, quality

SF = "/root/testdata/sf0.001"


def test_rules_of_the_last_trees_reach_the_lasso(spark, monkeypatch):
    name = quality.FEATURES[0]
    idle = [((name, True, -1000.0 - k),) for k in range(260)]
    real = quality.paths
    monkeypatch.setattr(quality, "paths", lambda debug: idle + real(debug))
    model = quality.train(common.table(spark, SF, "documents"), common.table(spark, SF, "labels"))
    assert model.rules and not {r for r, _ in model.rules} & set(idle)
