import random
import re

import pytest

from tidemark.operators import graph


@pytest.fixture(scope="module")
def edges(spark):
    def make(*rows):
        full = [(a, b, len(rest) > 0) for a, b, *rest in rows]
        return spark.createDataFrame(full, "dataset string, depends_on string, load_only boolean")

    return make


def roots(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "dataset string")


def test_edges_full_reference_wins(spark):
    rows = [("a", "dep_ts", "b"), ("a", "load_dep_ts", "b"), ("a", "load_dep_ts", "c"), ("a", "swin", "d")]
    refs = spark.createDataFrame(rows, "dataset string, parameter string, depends_on string")
    got = {(r["depends_on"], r["load_only"]) for r in graph.dependency_edges(refs).collect()}
    assert got == {("b", False), ("c", True), ("d", False)}


def test_closure(spark, edges):
    table = edges(("a", "b"), ("b", "c"), ("a", "d", "load"), ("d", "e"), ("x", "y"))
    got = {r["dataset"]: r["load_only"] for r in graph.dependency_closure(table, roots(spark, "a")).collect()}
    assert got == {"a": False, "b": False, "c": False, "d": True}


def test_closure_full_need_wins_over_load_only(spark, edges):
    # d is first met as load-only, then needed in full two levels down, so it is followed after all.
    table = edges(("a", "d", "load"), ("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"))
    got = {r["dataset"]: r["load_only"] for r in graph.dependency_closure(table, roots(spark, "a")).collect()}
    assert got == {name: False for name in "abcde"}


def test_closure_ends_in_a_cycle(spark, edges):
    got = graph.reachable(edges(("a", "b"), ("b", "a")), roots(spark, "a"))
    assert sorted(r["dataset"] for r in got.collect()) == ["a", "b"]


def test_layers(edges):
    table = edges(("d", "b"), ("d", "c"), ("d", "c"), ("b", "a"), ("c", "a"), ("e", "a"), ("e", "d"))
    got = {r["dataset"]: r["layer"] for r in graph.layers(table).collect()}
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2, "e": 3}


def test_layers_reject_a_cycle(edges):
    with pytest.raises(ValueError, match="cycle"):
        graph.layers(edges(("a", "b"), ("b", "c"), ("c", "b")))


def test_layers_reject_edges_without_a_name(edges):
    for row in ((None, "a"), ("b", None)):
        with pytest.raises(ValueError, match="cycle"):
            graph.layers(edges(("c", "b"), ("b", "a"), row))


def test_layers_of_copies_and_of_a_raw_dataset_that_all_need(edges):
    table = edges(("b", "a"), *[(f"top{k}", need) for k in range(200) for need in ("a", "b", "b")])
    got = graph.layers(table).collect()
    assert len(got) == 202
    assert {r["dataset"]: r["layer"] for r in got} == {"a": 0, "b": 1} | {f"top{k}": 2 for k in range(200)}


def test_rounds_of_layers_leave_out_what_nothing_depends_on(edges, monkeypatch):
    """Datasets that nothing depends on are most of them; neither a frontier nor a table of waiting ones holds them."""
    seen, rounds, frontier, plain = set(), [], graph._frontier, graph.cut_lineage

    def watched(df, parts):
        rounds.append(df.count())
        return frontier(df, parts)

    def written(df):
        table = plain(df)
        if "depends_on" not in table.columns:
            seen.update(row["dataset"] for row in table.select("dataset").collect())
        return table

    monkeypatch.setattr(graph, "_frontier", watched)
    monkeypatch.setattr(graph, "cut_lineage", written)
    table = edges(("b", "a"), ("c", "b"), *[(f"top{k}", need) for k in range(50) for need in ("raw", "a", "b", "c")])
    got = {r["dataset"]: r["layer"] for r in graph.layers(table).collect()}
    assert got == {"a": 0, "raw": 0, "b": 1, "c": 2} | {f"top{k}": 3 for k in range(50)}
    assert seen == {"a", "b", "c", "raw"}
    assert rounds == [2, 1, 1]  # no round for what nothing leaves


def test_references_are_shuffled_once_for_edges_and_their_datasets(spark, monkeypatch):
    rows = [(f"x{k}", "dep_ts", f"x{k // 2}") for k in range(1, 40)] + [("x7", "load_dep_ts", "x3")]
    refs = spark.createDataFrame(rows, "dataset string, parameter string, depends_on string")
    plans, plain = [], graph.cut_lineage

    def planned(df):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return plain(df)

    monkeypatch.setattr(graph, "cut_lineage", planned)
    got = graph.layers(graph.dependency_edges(refs.repartition("dataset")), refs)
    assert {r["dataset"]: r["layer"] for r in got.collect()} == {"x0": 0} | {f"x{k}": k.bit_length() for k in range(1, 40)}
    [plan] = [text for columns, text in plans if "depends_on" in columns]
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2  # the references, and the names of what is needed


def test_random_graphs_against_plain_walks(spark, edges):
    chance = random.Random(6)
    for size in (2, 30, 120):
        links = sorted({(f"n{a}", f"n{b}") for a, b in (sorted(chance.sample(range(size), 2), reverse=True) for _ in range(2 * size))})
        needs = {}
        for a, b in links:
            needs.setdefault(a, set()).add(b)

        def layer(n):
            return 1 + max(map(layer, needs[n])) if n in needs else 0

        nodes = {n for link in links for n in link}
        got = {r["dataset"]: r["layer"] for r in graph.layers(edges(*links)).collect()}
        assert got == {n: layer(n) for n in nodes}
        start, reached = f"n{size - 1}", set()
        todo = [start]
        while todo:
            n = todo.pop()
            if n not in reached:
                reached.add(n)
                todo += needs.get(n, ())
        assert {r["dataset"] for r in graph.reachable(edges(*links), roots(spark, start)).collect()} == reached


def test_a_round_opens_the_parts_of_its_frontier(spark, edges, monkeypatch):
    """Along a chain the edges read in all are about those there are, not rounds times edges."""
    links = [(f"n{k}", f"n{k + 1}") for k in range(14)] + [(f"x{k}", f"y{k}") for k in range(4000)]
    monkeypatch.setattr(graph, "_parts", lambda df: 64)
    read = []
    plain = graph.cut_lineage

    def counted(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        read.append(set(re.findall(r"PartitionFilters: \[(.*?)\]", plan)))
        return plain(df)

    monkeypatch.setattr(graph, "cut_lineage", counted)
    got = graph.reachable(edges(*links), roots(spark, "n0"))
    assert {r["dataset"] for r in got.collect()} == {f"n{k}" for k in range(15)}
    pruned = [filters for filters in read if any("part" in f for f in filters)]
    assert len(pruned) == 15  # every round after the roots, the last of which finds nothing
    assert all(any(re.search(r"part#\d+ (=|IN|in)|\(part#\d+ = \d+\)", f) for f in filters) for filters in pruned)


def test_no_edges(spark, edges):
    table = edges(("a", "b")).where("false")
    assert graph.layers(table).collect() == []
    assert [r["dataset"] for r in graph.reachable(table, roots(spark, "q")).collect()] == ["q"]


def test_failure_spreads(spark, edges):
    table = edges(("a", "b"), ("b", "c"), ("x", "c", "load"), ("y", "z"))
    got = graph.failed_with_descendants(table, roots(spark, "c"))
    assert sorted(r["dataset"] for r in got.collect()) == ["a", "b", "c", "x"]


def test_plan_order(spark):
    steps = spark.createDataFrame([("a", 30, "z"), ("a", 10, "x"), ("b", 5, "q")], "dataset string, index int, configuration string")
    got = {(r["dataset"], r["position"]): r["configuration"] for r in graph.plan_order(steps).collect()}
    assert got == {("a", 1): "x", ("a", 2): "z", ("b", 1): "q"}
    graph.check_plan_indices(steps)
    with pytest.raises(ValueError):
        graph.check_plan_indices(steps.union(spark.createDataFrame([("a", 10, "w")], steps.schema)))
