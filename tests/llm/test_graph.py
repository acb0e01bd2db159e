from onsetlake.llm import graph


def test_repeated_edges_loops_nulls_and_nothing(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 1), (5, 5), (7, 6), (None, 3), (3, None), (8, 7)], "u long, v long")
    got = {r.node: r.root for r in graph.components(edges).collect()}
    assert got == {1: 1, 2: 1, 6: 6, 7: 6, 8: 6}
    assert graph.components(edges.limit(0)).collect() == []
