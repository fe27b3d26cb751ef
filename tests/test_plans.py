"""Physical-plan properties that matter at scale."""

from pyspark.sql import functions as F

from quarry.operators import blocks, links
from quarry.plans import graphs
from quarry.session import scoped_conf
from tests.conftest import SF_SMALL


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _node_names(df) -> list[str]:
    """Operator names of the physical plan, walking children only, so the
    plans behind cached relations (leaf scans) are not counted."""

    def walk(p):
        name = p.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(p.executedPlan())
        if "QueryStage" in name:
            return walk(p.plan())
        out = [name]
        kids = p.children()
        for i in range(kids.size()):
            out += walk(kids.apply(i))
        return out

    return walk(df._jdf.queryExecution().executedPlan())


def test_link_cleaning_runs_without_python(spark):
    plan = _plan(links.clean_links(graphs.link_lines(spark, SF_SMALL)))
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_pagerank_round_moves_only_the_packed_sums(spark):
    edges = links.edge_set(graphs.graph_two_way(spark, SF_SMALL))
    graph = blocks.blocked(edges, partitions=3)
    # as inside pagerank(): rounds run with the graph's number of parts
    with scoped_conf(spark, "spark.sql.shuffle.partitions", str(graph.n_parts), spark__sql__adaptive__enabled="false"):
        sums = blocks.first_sums(graph, last=False)
        for _ in range(2):
            sums = blocks.next_sums(graph, sums, lambda s: 0.15 + 0.85 * s, last=False)
        names = _node_names(sums)
        sent = sums.count()
    graph.release()
    # one exchange a round, of the sums; the packed parts are met where they lie
    assert names.count("FlatMapCoGroupsInArrow") == 2 and names.count("Exchange") == 2, names
    assert names.count("InMemoryTableScan") == 3 and not [n for n in names if "Join" in n], names
    # rows are pairs of part and block, not nodes
    assert 0 < sent <= graph.n_parts * 3


def test_parts_hold_a_bounded_number_of_edges(spark):
    """A hub's edges are spread over parts; every hash partition gets one part."""
    pairs = [("h", f"n{i}") for i in range(300)] + [(f"n{i}", f"n{i + 1}") for i in range(299)]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    graph = blocks.blocked(edges, partitions=4, edges_per_part=50)
    rows = graph.parts.select("key", (F.octet_length("place") / 4).alias("n"), F.spark_partition_id().alias("p")).collect()
    graph.release()
    assert sum(r["n"] for r in rows) == 599
    assert max(r["n"] for r in rows) <= 100 and len(rows) == graph.n_parts >= 12
    assert len({r["p"] for r in rows}) == len(rows) == len({r["key"] for r in rows})


def test_parquet_scan_prunes_columns(spark):
    plan = _plan(graphs.graph_one_way(spark, SF_SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan


def test_numbers_travel_squeezed():
    import numpy as np
    import pyarrow as pa

    places = np.sort(np.random.default_rng(1).choice(40_000, 10_000, replace=False)).astype(np.uint32)
    sums = np.random.default_rng(2).random(10_000)
    row = blocks._squeezed(blocks._steps(places)), blocks._squeezed(sums)
    assert sum(map(len, row)) < 8.5 * len(sums)  # 12 bytes plain
    met = blocks._met(pa.table({"places": [row[0], row[0]], "sums": [row[1], row[1]]}))
    assert (np.flatnonzero(met) == places).all() and (met[places] == 2 * sums).all()


def test_edges_of_one_part_from_many_runs(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(blocks, "RUN_EDGES", 7)
    rng = np.random.default_rng(3)
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 1 << 34, (60, 2))} | {(5, d) for d in range(40)})
    degree = {s: sum(a == s for a, _ in pairs) for s, _ in pairs}
    rng.shuffle(pairs)
    rows = [(9, s, d, degree[s]) for s, d in map(tuple, pairs)]
    batches = [pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows[i : i + 5])], names=list("ksdn")) for i in range(0, len(rows), 5)]
    dealt = list(blocks._deal(iter(batches)))
    assert len(dealt) > 5
    (part,) = blocks._pack(iter(dealt))
    packed = {c: part.column(i)[0].as_py() for i, c in enumerate(blocks._names(blocks._PART)) if i}
    got = {c: np.frombuffer(x, np.int32 if c == "place" else np.int64) for c, x in packed.items() if c != "dst"}
    got["dst"] = np.cumsum(blocks._spread(packed["dst"], np.int64))
    src = np.repeat(got["src"], got["n_edges"])
    assert sorted(zip(src, got["dst"][got["place"]])) == sorted((s & blocks._LOW, d) for s, d in map(tuple, pairs))
    assert len(got["degree"]) == len(got["src"]) == len(degree) and got["degree"].max() == 40
    assert part.column(0)[0].as_py() == 9
