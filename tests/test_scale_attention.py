"""Attention statistics sort no cells."""

import itertools

from bitext.operators import attention_stats as AS


def test_attention_sink_sorts_no_cells(spark):
    cells = [(s, "encoder", 0, h, r, c, v) for s, h in itertools.product(range(3), range(2))
             for r, row in enumerate([[0.5, 0.5, 0.0], [0.2, 0.5, 0.3], [0.6, 0.1, 0.3]]) for c, v in enumerate(row)]
    df = spark.createDataFrame([*cells, (9, "decoder", 0, 0, 0, 1, 1.0)], "seq_id int, type string, layer int, head int, row int, column int, value double")
    sink = AS.attention_sink(df)
    plan = sink._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan
    got = {(r["type"], r["head"]): (round(r["mean_peak"], 6), round(r["sink_share"], 6)) for r in sink.collect()}
    assert got == {("encoder", 0): (0.533333, 0.666667), ("encoder", 1): (0.533333, 0.666667), ("decoder", 0): (1.0, 0.0)}
