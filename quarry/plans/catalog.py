"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
whose column names and types match the oracle SQL of the same key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import jobs
from ..functions import arrays
from ..operators import batching, evaluate, features, learn, links, ml, network, ordering, progress, rank, sweeps
from ..session import scratch_path
from ..sources import files
from ..sources.tables import table
from ..streaming.links import ingest_links
from . import graphs, sheets

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return deco


def r6(col: str, alias: str | None = None):
    return F.round(F.col(col), 6).alias(alias or col)


# -- PageRank ---------------------------------------------------------------


@query("pagerank_10")
def q_pagerank_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = rank.pagerank(graphs.graph_two_way(spark, sf_dir))
    return ranks.select("node", r6("rank"))


@query("pagerank_one_way")
def q_pagerank_one_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dangling case: parts only send, suppliers only receive, so the rank
    set is empty from round two (inner-join semantics) and after all ten."""
    ranks = rank.pagerank(graphs.graph_one_way(spark, sf_dir))
    return ranks.select("node", r6("rank"))


@query("pagerank_mixed")
def q_pagerank_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that never receive, sinks that never send, and a core that
    goes round: ranks of ten rounds."""
    ranks = rank.pagerank(graphs.graph_mixed(spark, sf_dir))
    return ranks.select("node", r6("rank"))


@query("pagerank_users")
def q_pagerank_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = rank.pagerank(graphs.graph_users(spark, sf_dir))
    return ranks.select("node", r6("rank"))


# -- link files ---------------------------------------------------------------


@query("link_parse")
def q_link_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.clean_links(graphs.link_lines(spark, sf_dir))


@query("link_dedup")
def q_link_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.edge_set(links.clean_links(graphs.link_lines(spark, sf_dir)))


@query("out_degree")
def q_out_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.out_degree(links.edge_set(graphs.graph_two_way(spark, sf_dir)))


@query("adjacency_lists")
def q_adjacency_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    adj = links.adjacency_lists(links.edge_set(graphs.graph_two_way(spark, sf_dir)), chunk_len=7)
    return adj.select(
        "src", "chunk", F.size("dsts").cast("bigint").alias("n"), F.array_join("dsts", ",").alias("dsts")
    )


# -- PageRank single steps ------------------------------------------------------


@query("rank_init")
def q_rank_init(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.rank_init(links.edge_set(graphs.graph_two_way(spark, sf_dir)))


@query("rank_contribs")
def q_rank_contribs(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = links.edge_set(graphs.graph_two_way(spark, sf_dir))
    return rank.rank_contribs(edges, rank.rank_init(edges)).select("src", "dst", r6("contrib"))


@query("rank_step")
def q_rank_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = links.edge_set(graphs.graph_one_way(spark, sf_dir))
    return rank.rank_step(edges, rank.rank_init(edges)).select("node", r6("rank"))


@query("rank_export_text")
def q_rank_export_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = rank.pagerank(graphs.graph_two_way(spark, sf_dir))
    path = scratch_path(spark, "rank_export")
    files.write_lines(files.rank_lines(ranks, digits=6), path)
    return files.read_lines(spark, path)


@query("rank_export_csv")
def q_rank_export_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV form, read back as strings; node names keep their padding."""
    ranks = rank.pagerank(graphs.graph_mixed(spark, sf_dir))
    padded = F.concat(F.lit("  "), F.col("node"), F.lit(" "))
    path = scratch_path(spark, "rank_export")
    files.write_ranks(ranks.select(padded.alias("node"), r6("rank")), path, fmt="csv")
    return files.read_csv_strings(spark, path).select("node", F.round(F.col("rank").cast("double"), 6).alias("rank"))


# -- sources, sinks, ordered exports --------------------------------------------------


@query("text_scan_lines")
def q_text_scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    path = scratch_path(spark, "part_names")
    even = F.pmod(F.col("p_partkey"), F.lit(2)) == 0
    files.write_lines(part.where(even), path + "/a", column="p_name")
    files.write_lines(part.where(~even), path + "/b", column="p_name")
    return files.read_lines(spark, path + "/*").select(F.col("value").alias("p_name"))


@query("csv_scan_strings")
def q_csv_scan_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    path = scratch_path(spark, "nation_csv")
    files.write_csv(nation, path)
    return files.read_csv_strings(spark, path)


@query("csv_roundtrip_sorted")
def q_csv_roundtrip_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    as_text = supplier.select([F.col(c).cast("string").alias(c) for c in supplier.columns])
    ordered = ordering.with_position(as_text, ["s_nationkey", "s_name"])
    path = scratch_path(spark, "supplier_sorted")
    files.write_csv(ordered, path)
    return files.read_csv_strings(spark, path)


@query("export_sort")
def q_export_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("cca2"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
    )
    return ordering.with_position(ev, ["cca2", "timestamp"]).select("event_id", "pos")


@query("export_sort_strings")
def q_export_sort_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("nation_text"), "c_name"
    )
    return ordering.with_position(cust, ["nation_text", "c_name"]).select("c_name", "nation_text", "pos")


# -- labelled examples: split, encode, reshape ----------------------------------

# Fixed demo model: w(c, j) = ((7c + 3j + 33) mod 11 - 5) / 10, j = -1 is the bias.
def demo_weight(c: int, j: int) -> float:
    return ((7 * c + 3 * j + 33) % 11 - 5) / 10


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as a labelled example table with double features."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", arrays.as_double("embedding").alias("features"), "label")


def demo_model(k: int = 10, d: int = 64) -> evaluate.LinearModel:
    return evaluate.LinearModel.from_rule(k, d, demo_weight)


@query("train_test_split")
def q_train_test_split(spark, sf_dir):
    return features.train_test_split(labelled(spark, sf_dir), "vec_id").select("vec_id", "split")


@query("split_counts")
def q_split_counts(spark, sf_dir):
    return features.split_counts(features.train_test_split(labelled(spark, sf_dir), "vec_id"), 128)


@query("scale_features")
def q_scale_features(spark, sf_dir):
    df = features.scale_features(labelled(spark, sf_dir), "features", 255.0)
    return features.long_form(df, "vec_id", "features")


@query("one_hot_labels")
def q_one_hot_labels(spark, sf_dir):
    df = features.one_hot_labels(labelled(spark, sf_dir), 10)
    return features.long_form(df, "vec_id", "label_onehot", "c", "flag")


@query("reshape_grid")
def q_reshape_grid(spark, sf_dir):
    df = features.reshape_grid(labelled(spark, sf_dir), 8, 8)
    rows = df.select("vec_id", F.posexplode("grid").alias("r", "row"))
    return rows.select("vec_id", "r", F.posexplode("row").alias("c", "v"))


@query("flatten_grid")
def q_flatten_grid(spark, sf_dir):
    df = features.flatten_grid(features.reshape_grid(labelled(spark, sf_dir), 8, 8), "grid", "flat")
    return features.long_form(df, "vec_id", "flat")


@query("unstack_steps")
def q_unstack_steps(spark, sf_dir):
    df = features.reshape_grid(labelled(spark, sf_dir), 8, 8)
    steps = features.unstack_steps(df, "grid", "vec_id")
    return steps.select("vec_id", "step", F.round(arrays.array_sum("vec"), 6).alias("s"))


@query("last_step")
def q_last_step(spark, sf_dir):
    df = features.last_step(features.reshape_grid(labelled(spark, sf_dir), 8, 8), "grid", "last")
    return features.long_form(df, "vec_id", "last")


@query("argmax_class")
def q_argmax_class(spark, sf_dir):
    return features.argmax_class(labelled(spark, sf_dir), "features").select("vec_id", "cls")


@query("take_head")
def q_take_head(spark, sf_dir):
    return ordering.head(labelled(spark, sf_dir), ["vec_id"], 128).select("vec_id", "label")


# -- shuffle, repeat, batch, shard ------------------------------------------------


@query("shuffle_epoch")
def q_shuffle_epoch(spark, sf_dir):
    return batching.shuffle_epoch(labelled(spark, sf_dir).select("vec_id"), "vec_id", epoch=1, seed=0)


@query("shuffle_blocks")
def q_shuffle_blocks(spark, sf_dir):
    """The two-level order of two epochs, cut in exact batches."""
    rows = table(spark, sf_dir, "documents").select("doc_id")
    epochs = [batching.shuffle_blocks(rows, "doc_id", epoch, n_blocks=16).withColumn("epoch", F.lit(epoch)) for epoch in (0, 1)]
    return batching.batches_of(epochs[0].unionByName(epochs[1]), "pos", 64).select("epoch", "doc_id", "pos", "batch")


@query("shuffle_buffer")
def q_shuffle_buffer(spark, sf_dir):
    """Every document once after the buffer, and whether it left no earlier than the buffer allows."""
    split = F.spark_partition_id().alias("split")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = table(spark, sf_dir, "documents").select("doc_id", place.alias("came"))
    left = batching.shuffle_buffer(rows, size=500, seed=7).select("doc_id", "came", place.alias("left"), split)
    return left.select("doc_id", (F.col("left") > F.col("came") - 500).alias("in_bounds"))


@query("repeat_epochs")
def q_repeat_epochs(spark, sf_dir):
    return batching.repeat_epochs(labelled(spark, sf_dir).select("vec_id"), 3)


@query("assign_batches")
def q_assign_batches(spark, sf_dir):
    return batching.assign_batches(labelled(spark, sf_dir).select("vec_id"), "vec_id", 64, seed=0)


@query("assign_batches_exact")
def q_assign_batches_exact(spark, sf_dir):
    df = batching.assign_batches_exact(labelled(spark, sf_dir).select("vec_id"), "vec_id", 64, epoch=0, seed=0)
    return df.select("vec_id", "batch")


@query("shard_by_key")
def q_shard_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return batching.shard_by_key(orders, "o_orderkey", 15).select("o_orderkey", "shard")


# -- scoring and evaluation with a fixed model ------------------------------------


@query("linear_scores")
def q_linear_scores(spark, sf_dir):
    df = evaluate.with_scores(labelled(spark, sf_dir), demo_model())
    return df.select("vec_id", F.posexplode("z").alias("c", "z")).select("vec_id", "c", r6("z"))


@query("softmax_scores")
def q_softmax_scores(spark, sf_dir):
    df = evaluate.with_probabilities(labelled(spark, sf_dir), demo_model())
    return df.select("vec_id", F.posexplode("p").alias("c", "p")).select("vec_id", "c", r6("p"))


@query("cross_entropy")
def q_cross_entropy(spark, sf_dir):
    df = features.one_hot_labels(labelled(spark, sf_dir), 10)
    return evaluate.cross_entropy(df, demo_model(), onehot="label_onehot").select(r6("loss"), "n")


@query("cross_entropy_sparse")
def q_cross_entropy_sparse(spark, sf_dir):
    return evaluate.cross_entropy(labelled(spark, sf_dir), demo_model()).select(r6("loss"), "n")


@query("accuracy_counts")
def q_accuracy_counts(spark, sf_dir):
    return evaluate.accuracy_counts(labelled(spark, sf_dir), demo_model()).select("correct", "total", r6("accuracy"))


@query("evaluate_model")
def q_evaluate_model(spark, sf_dir):
    df = features.train_test_split(labelled(spark, sf_dir), "vec_id")
    return evaluate.evaluate_model(df, demo_model()).select("split", "n", r6("loss"), r6("accuracy"))


@query("batch_score")
def q_batch_score(spark, sf_dir):
    scored = evaluate.batch_score(labelled(spark, sf_dir), demo_model(), drop_features=True)
    return scored.select("vec_id", "pred")


# -- training -------------------------------------------------------------------

SGD_BATCHES = 4
SGD_REPLICAS = 2
SGD_STEPS = 8


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.train_test_split(labelled(spark, sf_dir), "vec_id")
    return df.where(F.col("split") == "train").select("vec_id", "features", "label")


def _sync_model(spark, sf_dir, optimizer="sgd", lr=learn.LEARNING_RATE, log_every=0):
    batched = learn.prepare_batches(train_rows(spark, sf_dir), "vec_id", SGD_BATCHES, seed=0)
    try:
        return learn.sgd_sync(
            batched, 10, 64, SGD_STEPS, replicas=SGD_REPLICAS, lr=lr, optimizer=optimizer, log_every=log_every
        )
    finally:
        batched.delete()


def _weights_frame(spark, model):
    return model.to_frame(spark).select("class", "feature", r6("weight"))


@query("softmax_sgd_sync")
def q_softmax_sgd_sync(spark, sf_dir):
    model, _ = _sync_model(spark, sf_dir)
    return _weights_frame(spark, model)


@query("softmax_sgd_adam")
def q_softmax_sgd_adam(spark, sf_dir):
    model, _ = _sync_model(spark, sf_dir, optimizer="adam", lr=learn.ADAM_RATE)
    return _weights_frame(spark, model)


@query("training_metrics")
def q_training_metrics(spark, sf_dir):
    _, log = _sync_model(spark, sf_dir, log_every=2)
    metrics = learn.append_metrics(spark, log, scratch_path(spark, "metrics"))
    return metrics.select("step", "metric", r6("value"))


@query("weights_roundtrip")
def q_weights_roundtrip(spark, sf_dir):
    model, _ = _sync_model(spark, sf_dir)
    path = scratch_path(spark, "weights")
    if learn.load_or_init(spark, path, 10, 64).W.any():
        raise AssertionError("fresh path must initialise to zeros")
    learn.save_weights(model, spark, path)
    return _weights_frame(spark, learn.load_or_init(spark, path, 10, 64))


@query("softmax_sgd_averaged")
def q_softmax_sgd_averaged(spark, sf_dir):
    w = learn.sgd_averaged(train_rows(spark, sf_dir), "vec_id", 10, 64, n_shards=3, n_batches=SGD_BATCHES, seed=0)
    return w.select("class", "feature", r6("weight"))


@query("softmax_sgd_averaged_epochs")
def q_softmax_sgd_averaged_epochs(spark, sf_dir):
    w = learn.sgd_averaged(train_rows(spark, sf_dir), "vec_id", 10, 64, n_shards=3, n_batches=2, seed=0, epochs=3)
    return w.select("class", "feature", r6("weight"))


@query("softmax_sgd_step_limit")
def q_softmax_sgd_step_limit(spark, sf_dir):
    """Three epochs on batches dealt anew, stopped by the step rule."""
    rows = train_rows(spark, sf_dir)
    size = rows.count() // SGD_BATCHES
    model, _ = learn.train_sync(rows, "vec_id", 10, 64, size, 3, replicas=SGD_REPLICAS, n_batches=SGD_BATCHES)
    return _weights_frame(spark, model)


@query("train_then_evaluate")
def q_train_then_evaluate(spark, sf_dir):
    """Train on scaled features, store, restore, score, evaluate on both splits."""
    df = features.train_test_split(features.scale_features(labelled(spark, sf_dir), "features", 4.0), "vec_id")
    train = df.where(F.col("split") == "train").select("vec_id", "features", "label")
    batched = learn.prepare_batches(train, "vec_id", SGD_BATCHES, seed=0)
    model, _ = learn.sgd_sync(batched, 10, 64, SGD_STEPS, replicas=SGD_REPLICAS)
    batched.delete()
    path = scratch_path(spark, "trained")
    learn.save_weights(model, spark, path)
    restored = learn.load_or_init(spark, path, 10, 64)
    return evaluate.evaluate_model(df, restored).select("split", "n", r6("loss"), r6("accuracy"))


# -- runs that stop and go on ---------------------------------------------------


def _stopped_and_resumed(spark, sf_dir, optimizer, lr, stop_after, checkpoint_every=None, log_every=0):
    """Three epochs of four steps, ended in the second one and called again:
    the second call finds the newest checkpoint and takes the steps left."""
    rows = train_rows(spark, sf_dir)
    size = rows.count() // SGD_BATCHES
    checkpoints = progress.Checkpoints(spark, scratch_path(spark, "checkpoints"))
    metrics = progress.MetricLog(spark, scratch_path(spark, "metrics"), "resumed")
    for stop in (stop_after, None):
        model, _ = learn.train_sync(
            rows, "vec_id", 10, 64, size, 3, replicas=SGD_REPLICAS, n_batches=SGD_BATCHES, optimizer=optimizer, lr=lr,
            log_every=log_every, metrics=metrics, checkpoints=checkpoints, checkpoint_every=checkpoint_every, stop_after=stop,
        )
    return model, checkpoints, metrics


@query("softmax_sgd_resumed")
def q_softmax_sgd_resumed(spark, sf_dir):
    """Stopped after step 6, with a checkpoint at the end of each epoch: steps 5 and 6 are taken again."""
    model, _, _ = _stopped_and_resumed(spark, sf_dir, "sgd", learn.LEARNING_RATE, stop_after=6)
    return _weights_frame(spark, model)


@query("softmax_adam_resumed")
def q_softmax_adam_resumed(spark, sf_dir):
    """The same with Adam, whose moments the checkpoint of step 6 holds; the
    weights are those of the last checkpoint."""
    _, checkpoints, _ = _stopped_and_resumed(spark, sf_dir, "adam", learn.ADAM_RATE, stop_after=7, checkpoint_every=3)
    step, arrays, _ = checkpoints.load()
    model = learn.Softmax(10, 64).model(arrays["theta"])
    return _weights_frame(spark, model).withColumn("step", F.lit(step).cast("bigint"))


@query("training_metrics_resumed")
def q_training_metrics_resumed(spark, sf_dir):
    """The metric log of a run that stopped after step 7 and went on from step 4."""
    _, _, metrics = _stopped_and_resumed(spark, sf_dir, "sgd", learn.LEARNING_RATE, stop_after=7, log_every=1)
    return metrics.read().select("run", "step", "metric", r6("value"))


# -- feed-forward network with ReLU layers -------------------------------------------


# Fixed start of the demo network: unit u, input i (-1 is the bias) of layer l.
def network_weight(layer: int, u: int, i: int) -> float:
    return ((389 * u + 211 * i + 101 * layer + 557) % 997 - 498) / 5000


NETWORK = network.FeedForward((64, *network.HIDDEN, 10))


def _trained_network(spark, rows, epochs, steps_per_epoch):
    start = network.Network.from_rule(NETWORK.sizes, network_weight)
    size = rows.count() // steps_per_epoch
    return learn.train(
        rows, "vec_id", NETWORK, size, epochs, replicas=SGD_REPLICAS, lr=learn.ADAM_RATE, optimizer="adam",
        epsilon=network.ADAM_EPSILON, n_batches=SGD_BATCHES, init=start,
    )[0]


@query("relu_network_adam")
def q_relu_network_adam(spark, sf_dir):
    """All weights of the 64-120-84-10 network after three Adam steps from a fixed start."""
    model = _trained_network(spark, train_rows(spark, sf_dir), epochs=1, steps_per_epoch=3)
    return model.to_frame(spark).select("layer", "unit", "input", r6("weight"))


@query("relu_network_evaluate")
def q_relu_network_evaluate(spark, sf_dir):
    """Three epochs of two steps on batches dealt anew, then loss and accuracy of
    the stored and restored network on both splits."""
    df = features.train_test_split(labelled(spark, sf_dir), "vec_id")
    model = _trained_network(spark, train_rows(spark, sf_dir), epochs=3, steps_per_epoch=2)
    path = scratch_path(spark, "network")
    learn.save_weights(model, spark, path)
    restored = network.Network.from_frame(spark.read.parquet(path))
    return evaluate.evaluate_model(df, restored).select("split", "n", r6("loss"), r6("accuracy"))


@query("softmax_regression_check")
def q_softmax_regression_check(spark, sf_dir):
    """Summed class probabilities of the converged softmax regression on its training rows."""
    df = features.train_test_split(labelled(spark, sf_dir), "vec_id").where(F.col("split") == "train")
    mass = ml.class_mass(ml.softmax_regression(df, tol=1e-9, max_iter=500, keep_probability=True))
    return mass.select("class", F.round("mass", 3).alias("mass"))


@query("mlp_classifier_check")
def q_mlp_classifier_check(spark, sf_dir):
    """Whether the network beats always naming the most frequent class, on its training rows."""
    df = features.train_test_split(labelled(spark, sf_dir), "vec_id").where(F.col("split") == "train")
    return ml.beats_prior(ml.mlp_classifier(df, hidden=(120, 84)))


@query("softmax_regression_ml")
def q_softmax_regression_ml(spark, sf_dir):
    df = features.train_test_split(labelled(spark, sf_dir), "vec_id")
    return ml.softmax_regression(df).select("vec_id", "split", "pred")


@query("mlp_classifier")
def q_mlp_classifier(spark, sf_dir):
    df = features.train_test_split(labelled(spark, sf_dir), "vec_id")
    return ml.mlp_classifier(df, hidden=(120, 84)).select("vec_id", "split", "pred")


# -- experiment sheets ------------------------------------------------------------


def _sweeps(spark, sf_dir):
    path, settings = sheets.write_sheet(spark, sf_dir)
    return sweeps.read_sweeps(spark, path), settings


@query("sweep_unpivot")
def q_sweep_unpivot(spark, sf_dir):
    raw = sweeps.parse_sheet(sweeps.read_sheet_lines(spark, sheets.write_sheet(spark, sf_dir)[0]))
    value = F.round(sweeps.parse_value(F.col("value_text")), 6).alias("value")
    return raw.select("experiment", "series", "setting_text", value)


@query("sweep_parse_values")
def q_sweep_parse_values(spark, sf_dir):
    t, _ = _sweeps(spark, sf_dir)
    return t.select("experiment", "model", "measure", "setting", r6("value"))


@query("sweep_speedup")
def q_sweep_speedup(spark, sf_dir):
    t, _ = _sweeps(spark, sf_dir)
    return sweeps.speedup(t).select("experiment", "series", "setting", r6("speedup"))


@query("sweep_best_setting")
def q_sweep_best_setting(spark, sf_dir):
    t, _ = _sweeps(spark, sf_dir)
    return sweeps.best_setting(t).select("experiment", "series", "best_setting", r6("best_value"))


@query("sweep_model_ratio")
def q_sweep_model_ratio(spark, sf_dir):
    t, _ = _sweeps(spark, sf_dir)
    return sweeps.model_ratio(t, "F", "O").select("experiment", "measure", "setting", r6("ratio"))


@query("sweep_pivot")
def q_sweep_pivot(spark, sf_dir):
    t, settings = _sweeps(spark, sf_dir)
    wide = sweeps.pivot(t, settings)
    cols = [sweeps.setting_label(float(s)) for s in settings]
    return wide.select("experiment", "series", *[r6(c) for c in cols])


@query("sweep_two_sheets")
def q_sweep_two_sheets(spark, sf_dir):
    """Two sheets with equal titles; the second has a cell that isn't a
    number, a series without any value and twice the first one's values."""
    first, second = sheets.write_two_sheets(spark, sf_dir)
    t = sweeps.speedup(sweeps.read_sweeps(spark, [first, second]))
    sheet = F.when(F.col("file").contains("sheet_b"), 2).otherwise(1)
    return t.select(sheet.alias("sheet"), "experiment", "series", "setting", r6("value"), "value_text", r6("speedup"))


# -- streaming ingestion ------------------------------------------------------------


@query("link_stream_ingest")
def q_link_stream_ingest(spark, sf_dir):
    """Link lines land as text files; a Structured Streaming query cleans
    them batch by batch into an edge table, read back as a distinct edge set."""
    base = scratch_path(spark, "link_stream")
    files.write_lines(graphs.link_lines(spark, sf_dir), base + "/incoming")
    q = ingest_links(spark, base + "/incoming", base + "/edges", name=base.rsplit("/", 1)[-1])
    q.awaitTermination()
    return links.edge_set(spark.read.parquet(base + "/edges"))


@query("export_sort_job")
def q_export_sort_job(spark, sf_dir):
    """The sort job end to end: ``customer`` exported as a string CSV with
    the job's key columns, sorted by ``jobs.sort_job``, then the written part
    files read back in file order to recover each row's place in the total
    order (file, split offset, position in split)."""
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("cca2"),
        F.col("c_custkey").cast("string").alias("timestamp"),
        F.col("c_name"),
    )
    base = scratch_path(spark, "sort_job")
    files.write_csv(cust, base + "/in")
    jobs.sort_job(spark, base + "/in", base + "/out")
    back = files.read_csv_strings(spark, base + "/out").select(
        "c_name",
        F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("bigint").alias("_f"),
        F.col("_metadata.file_block_start").alias("_b"),
        F.monotonically_increasing_id().alias("_m"),
    )
    return ordering.with_position(back, ["_f", "_b", "_m"]).select("c_name", "pos")
