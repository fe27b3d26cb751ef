"""Link-file cleaning and PageRank semantics on hand-written fixtures."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import links, rank

T = "\t"
# (raw line, expected (src, dst) or None when dropped)
CASES = [
    (f"a{T}b", ("a", "b")),
    (f" A{T}B ", ("a", "b")),
    (f"#x{T}y", None),
    (f" #x{T}y", ("#x", "y")),
    (f"a{T}{T}b", None),
    (f"a{T}", None),
    (f"{T}a{T}b{T}", ("a", "b")),
    (f"Category:X{T}b", ("category:x", "b")),
    (f"category:X{T}b", None),
    (f"Category:X:Y{T}Talk", ("category:x:y", "talk")),
    (f"Talk:Q{T}b", None),
    (f"a{T}Category:Z", ("a", "category:z")),
    (f" g{T}h ", ("g", "h")),
    (f"\x1fm{T}n\x85", ("m", "n")),
    (f"a b{T}c d ", ("a b", "c d")),
    ("", None),
    (T, None),
    ("x", None),
    (f"q {T} r", ("q ", " r")),
    (f"A:Category:{T}b", None),
]


def test_fixture_lines(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "value string")
    got = sorted(tuple(r) for r in links.clean_links(df).collect())
    want = sorted(c[1] for c in CASES if c[1] is not None)
    assert got == want
    assert len(got) == 11


def test_lines_made_from_known_fields(spark):
    """Lines put together from fields, padding and defects whose effect is known."""
    import random

    rng = random.Random(7)
    pads = ["", " ", "  ", "\xa0", "\u2003 ", "\x1c", "\t"]
    good = [("Ab", "ab"), ("x y", "x y"), ("É1", "é1"), ("Category:Q", "category:q"), ("Category:A:B", "category:a:b"), ("#z", "#z")]
    bad = ["Talk:Q", "category:x", "a:b", ":"]
    lines, want = [], []
    for _ in range(2000):
        (a, la), (b, lb) = rng.choice(good), rng.choice(good)
        left, right = rng.choice(pads), rng.choice(pads)
        defect = rng.choice(["", "", "namespace", "one field", "three fields", "comment"])
        if defect == "namespace":
            a, b = rng.choice([(rng.choice(bad), b), (a, rng.choice(bad))])
        middle = {"one field": " ", "three fields": "\tmore\t"}.get(defect, "\t")
        line = left + a + middle + b + right
        if defect == "comment":
            line = "#" + line
        lines.append(line)
        if not defect and not line.startswith("#"):
            want.append((la, lb))
    got = links.clean_links(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 500


def test_edge_set_dedups_and_keeps_self_loops(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "a")], "src string, dst string")
    assert sorted(tuple(r) for r in links.edge_set(df).collect()) == [("a", "a"), ("a", "b")]


def _ranks(spark, pairs, **kw):
    df = spark.createDataFrame(pairs, "src string, dst string")
    return {r["node"]: r["rank"] for r in rank.pagerank(df, **kw).collect()}


def test_cycle_keeps_rank_one(spark):
    got = _ranks(spark, [("a", "b"), ("b", "c"), ("c", "a")])
    assert got == pytest.approx({"a": 1.0, "b": 1.0, "c": 1.0})


def test_dangling_graph_empties(spark):
    assert _ranks(spark, [("a", "b")], rounds=1) == {"b": 1.0}
    assert _ranks(spark, [("a", "b")], rounds=2) == {}


def test_source_only_node_vanishes(spark):
    pairs = [("s", "a"), ("a", "b"), ("b", "a")]
    assert _ranks(spark, pairs, rounds=1) == pytest.approx({"a": 1.85, "b": 1.0})
    assert _ranks(spark, pairs, rounds=2) == pytest.approx({"a": 1.0, "b": 1.7225})


def test_self_loop(spark):
    assert _ranks(spark, [("a", "a")]) == pytest.approx({"a": 1.0})


@pytest.mark.parametrize("partitions,per_part", [(1, None), (3, None), (3, 2), (7, 1)])
def test_spread_hubs_and_any_parts_give_the_same_ranks(spark, partitions, per_part):
    # hub 'h' links to everyone and back; few edges a part spread it over many
    pairs = [("h", f"n{i}") for i in range(40)] + [(f"n{i}", "h") for i in range(40)] + [("n1", "n2"), ("x", "h"), ("n3", "sink")]
    plain, spread = _ranks(spark, pairs), _ranks(spark, pairs, partitions=partitions, edges_per_part=per_part)
    assert plain.keys() == spread.keys()
    for k in plain:
        assert spread[k] == pytest.approx(plain[k], rel=1e-12)


def test_nodes_too_many_to_broadcast(spark, monkeypatch):
    from quarry.operators import blocks

    pairs = [("h", f"n{i}") for i in range(60)] + [(f"n{i}", f"n{i // 2}") for i in range(60)]
    plain = _ranks(spark, pairs)
    monkeypatch.setattr(blocks, "BROADCAST_MAX_BYTES", 0)
    assert _ranks(spark, pairs, partitions=4) == pytest.approx(plain, rel=1e-12)


def test_no_edges_nulls_and_no_rounds(spark):
    schema = "src string, dst string"
    assert rank.pagerank(spark.createDataFrame([], schema)).count() == 0
    odd = [("a", None), (None, "b"), (None, None), ("a", "b"), ("b", "a"), ("a", "b")]
    assert _ranks(spark, odd) == pytest.approx({"a": 1.0, "b": 1.0})
    assert _ranks(spark, odd, rounds=0) == {"a": 1.0, "b": 1.0}


def test_ranks_sum_to_node_count_on_two_way_graph(spark):
    from quarry.plans import graphs
    from tests.conftest import SF_SMALL

    r = rank.pagerank(graphs.graph_two_way(spark, SF_SMALL))
    n, total = r.agg(F.count("*"), F.sum("rank")).first()
    assert total == pytest.approx(n, rel=1e-9)


def test_adjacency_chunks_in_order_are_the_sorted_list(spark):
    pairs = [("h", f"n{i:02d}") for i in range(25)] + [("a", "b"), ("g", "x"), ("g", "w")]
    df = spark.createDataFrame(pairs, "src string, dst string").repartition(5)
    rows = sorted(map(tuple, links.adjacency_lists(df, 10).collect()))
    assert [(s, c, len(d)) for s, c, d in rows] == [("a", 0, 1), ("g", 0, 2), ("h", 0, 10), ("h", 1, 10), ("h", 2, 5)]
    assert [x for s, _, d in rows if s == "h" for x in d] == [f"n{i:02d}" for i in range(25)]
    with pytest.raises(ValueError):
        links.adjacency_lists(df, 0)


def test_no_cut_setting_changes_the_ranks(spark):
    pairs = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")]
    plain = _ranks(spark, pairs, rounds=4)
    for cut in (0, 1, 3):
        assert _ranks(spark, pairs, rounds=4, cut_every=cut) == pytest.approx(plain)


def test_ranks_leave_one_scratch_table_and_no_cached_frame(spark):
    import glob
    import os

    from quarry.session import checkpoint_dir

    root = checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(os.path.join(root, "scratch", "*")))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    _ranks(spark, [("a", "b"), ("b", "a")], rounds=5)
    assert len(set(glob.glob(os.path.join(root, "scratch", "*"))) - before) == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_rank_csv_keeps_padding(spark, tmp_dir):
    from quarry.sources import files

    df = spark.createDataFrame([(" r", 1.5), ("r", 0.5), ("r ", 2.5)], "node string, rank double")
    files.write_ranks(df, tmp_dir + "/csv")
    assert sorted(r.node for r in files.read_csv_strings(spark, tmp_dir + "/csv").collect()) == [" r", "r", "r "]


def test_join_small_checks_size_before_broadcasting(spark):
    from quarry.session import join_small

    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    plan_b = join_small(big, small, "k")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan_s = join_small(big, small, "k", max_bytes=5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan_b
    assert "BroadcastHashJoin" not in plan_s


def test_text_scan_splits_on_all_line_terminators(spark, tmp_dir):
    import os

    from quarry.sources import files

    path = os.path.join(tmp_dir, "links.txt")
    with open(path, "wb") as f:
        f.write(b"a\tb\r\nc\td\re\tf\n")
    lines = files.read_lines(spark, path)
    assert lines.count() == 3
    assert sorted(tuple(r) for r in links.clean_links(lines).collect()) == [("a", "b"), ("c", "d"), ("e", "f")]


@pytest.mark.parametrize("graph", ["graph_two_way", "graph_users"])
def test_pagerank_matches_python_brute_force(spark, graph):
    from collections import defaultdict

    from quarry.plans import graphs
    from tests.conftest import SF_SMALL

    e = getattr(graphs, graph)(spark, SF_SMALL)
    adj = defaultdict(list)
    for s, d in {tuple(r) for r in e.collect()}:
        adj[s].append(d)
    ranks = {s: 1.0 for s in adj}
    for _ in range(10):
        contrib = defaultdict(float)
        for s, r in ranks.items():
            for d in adj.get(s, ()):
                contrib[d] += r / len(adj[s])
        ranks = {d: 0.15 + 0.85 * c for d, c in contrib.items()}
    got = {r["node"]: r["rank"] for r in rank.pagerank(e).collect()}
    assert got.keys() == ranks.keys()
    for k, v in ranks.items():
        assert got[k] == pytest.approx(v, rel=1e-12)
