"""DuckDB oracle SQL for the registered queries.

Each string runs on views named after the provided tables. They are written
independently of the Spark code: plain SQL on the same inputs, chained CTEs
for iterative jobs. Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

# -- shared fragments -------------------------------------------------------

EDGES_T = """
edges AS MATERIALIZED (
  SELECT DISTINCT src, dst FROM (
    SELECT 'p' || CAST(l_partkey AS VARCHAR) AS src, 's' || CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem
    UNION ALL
    SELECT 's' || CAST(l_suppkey AS VARCHAR), 'p' || CAST(l_partkey AS VARCHAR) FROM lineitem
  )
)"""

EDGES_O = """
edges AS MATERIALIZED (
  SELECT DISTINCT 'p' || CAST(l_partkey AS VARCHAR) AS src, 's' || CAST(l_suppkey AS VARCHAR) AS dst
  FROM lineitem
)"""

EDGES_M = """
edges AS MATERIALIZED (
  SELECT 'p' || CAST(l_partkey AS VARCHAR) AS src, 's' || CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem
  UNION
  SELECT 's' || CAST(l_suppkey AS VARCHAR), 'p' || CAST(l_partkey AS VARCHAR) FROM lineitem WHERE l_linenumber = 1
)"""

EDGES_U = """
edges AS MATERIALIZED (
  SELECT DISTINCT src, dst FROM (
    SELECT 'u' || CAST(user_id AS VARCHAR) AS src,
           'u' || CAST(lead(user_id) OVER (ORDER BY ts) AS VARCHAR) AS dst
    FROM events
  ) WHERE dst IS NOT NULL
)"""


def pagerank_sql(edges_cte: str, rounds: int = 10) -> str:
    parts = [
        edges_cte,
        "deg AS MATERIALIZED (SELECT src, count(*) AS deg FROM edges GROUP BY src)",
        "r0 AS MATERIALIZED (SELECT src AS node, CAST(1.0 AS DOUBLE) AS rank FROM deg)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"r{i} AS MATERIALIZED (SELECT e.dst AS node, "
            f"CAST(0.15 AS DOUBLE) + CAST(0.85 AS DOUBLE) * sum(r.rank / d.deg) AS rank "
            f"FROM edges e JOIN deg d ON e.src = d.src JOIN r{i - 1} r ON r.node = e.src "
            f"GROUP BY e.dst)"
        )
    return "WITH " + ",\n".join(parts) + f"\nSELECT node, round(rank, 6) AS rank FROM r{rounds}"


ORACLES: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


register("pagerank_10", pagerank_sql(EDGES_T))
register("pagerank_mixed", pagerank_sql(EDGES_M))
register("pagerank_users", pagerank_sql(EDGES_U))
register("pagerank_one_way", pagerank_sql(EDGES_O))


# -- link files ---------------------------------------------------------------

_P = "CAST(l_partkey AS VARCHAR)"
_S = "CAST(l_suppkey AS VARCHAR)"
_O = "CAST(l_orderkey AS VARCHAR)"
LINK_LINES = f"""
lines AS (
  SELECT CASE l_linenumber
    WHEN 1 THEN 'P' || {_P} || chr(9) || 'S' || {_S}
    WHEN 2 THEN '#P' || {_P} || chr(9) || 'S' || {_S}
    WHEN 3 THEN chr(8195) || ' Category:Part ' || {_P} || chr(9) || 'S' || {_S} || ' ' || chr(160) || chr(12288)
    WHEN 4 THEN 'P' || {_P}
    WHEN 5 THEN 'P' || {_P} || chr(9) || chr(9) || 'S' || {_S}
    WHEN 6 THEN 'Talk:P' || {_P} || chr(9) || 'S' || {_S}
    ELSE ' #O' || {_O} || chr(9) || 'Category:Flag:' || l_returnflag
  END AS value
  FROM lineitem
)"""


def _link_sql() -> str:
    from ..functions.text import PY_STRIP_PATTERN

    return f"""{LINK_LINES},
parsed AS (
  SELECT value, string_split(regexp_replace(value, '{PY_STRIP_PATTERN}', '', 'g'), chr(9)) AS parts
  FROM lines
),
kept AS (
  SELECT string_split(lower(regexp_replace(value, '{PY_STRIP_PATTERN}', '', 'g')), chr(9)) AS lp
  FROM parsed
  WHERE NOT starts_with(value, '#') AND len(parts) = 2
    AND list_bool_and(list_transform(parts, lambda p: starts_with(p, 'Category:') OR NOT contains(p, ':')))
)"""


register("link_parse", "WITH " + _link_sql() + "\nSELECT lp[1] AS src, lp[2] AS dst FROM kept")
register("link_dedup", "WITH " + _link_sql() + "\nSELECT DISTINCT lp[1] AS src, lp[2] AS dst FROM kept")
register("link_stream_ingest", "WITH " + _link_sql() + "\nSELECT DISTINCT lp[1] AS src, lp[2] AS dst FROM kept")
register(
    "out_degree",
    "WITH " + EDGES_T + "\nSELECT src, count(*) AS deg FROM edges GROUP BY src",
)
register(
    "adjacency_lists",
    "WITH " + EDGES_T + """,
placed AS (SELECT src, dst, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // 7 AS chunk FROM edges)
SELECT src, CAST(chunk AS BIGINT) AS chunk, count(*) AS n, string_agg(dst, ',' ORDER BY dst) AS dsts
FROM placed GROUP BY src, chunk""",
)

# -- PageRank single steps ------------------------------------------------------

register(
    "rank_init",
    "WITH " + EDGES_T + "\nSELECT DISTINCT src AS node, CAST(1.0 AS DOUBLE) AS rank FROM edges",
)
register(
    "rank_contribs",
    "WITH " + EDGES_T + """,
deg AS (SELECT src, count(*) AS deg FROM edges GROUP BY src)
SELECT e.src, e.dst, round(1.0::DOUBLE / d.deg, 6) AS contrib
FROM edges e JOIN deg d ON e.src = d.src""",
)
register(
    "rank_step",
    "WITH " + EDGES_O + """,
deg AS (SELECT src, count(*) AS deg FROM edges GROUP BY src)
SELECT e.dst AS node, round(0.15::DOUBLE + 0.85::DOUBLE * sum(1.0::DOUBLE / d.deg), 6) AS rank
FROM edges e JOIN deg d ON e.src = d.src GROUP BY e.dst""",
)
register(
    "rank_export_text",
    pagerank_sql(EDGES_T).rsplit("\nSELECT", 1)[0] + "\nSELECT node || chr(9) || printf('%.6f', rank) AS value FROM r10",
)
register(
    "rank_export_csv",
    pagerank_sql(EDGES_M).rsplit("\nSELECT", 1)[0] + "\nSELECT '  ' || node || ' ' AS node, round(rank, 6) AS rank FROM r10",
)

# -- sources, sinks, ordered exports ------------------------------------------

register("text_scan_lines", "SELECT p_name FROM part")
register(
    "csv_scan_strings",
    """SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name,
       CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation""",
)
register(
    "csv_roundtrip_sorted",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
       CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal,
       CAST(row_number() OVER (ORDER BY CAST(s_nationkey AS VARCHAR) NULLS FIRST, s_name NULLS FIRST) AS VARCHAR) AS pos
FROM supplier""",
)
register(
    "export_sort",
    """SELECT event_id,
       row_number() OVER (ORDER BY event_type NULLS FIRST,
                                   strftime(ts, '%Y-%m-%d %H:%M:%S.%f') NULLS FIRST) AS pos
FROM events""",
)
register(
    "export_sort_job",
    """SELECT c_name,
       row_number() OVER (ORDER BY c_mktsegment NULLS FIRST, CAST(c_custkey AS VARCHAR) NULLS FIRST) AS pos
FROM customer""",
)
register(
    "export_sort_strings",
    """SELECT c_name, CAST(c_nationkey AS VARCHAR) AS nation_text,
       row_number() OVER (ORDER BY CAST(c_nationkey AS VARCHAR) NULLS FIRST, c_name NULLS FIRST) AS pos
FROM customer""",
)


# -- labelled examples ----------------------------------------------------------

KEY = "('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _key(text: str) -> str:
    return KEY.format(text=text)


VEC_KEY = _key("'0:' || CAST(vec_id AS VARCHAR)")
ORDER_KEY = _key("'0:' || CAST(o_orderkey AS VARCHAR)")
SPLIT = f"CASE WHEN {VEC_KEY} % 100 < 20 THEN 'test' ELSE 'train' END"
LONG_X = """x AS (
  SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j,
         CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings
)"""
WEIGHTS = """w AS (
  SELECT CAST(c AS INTEGER) AS c, CAST(j AS INTEGER) AS j,
         CAST(((7 * c + 3 * j + 33) % 11) - 5 AS DOUBLE) / 10 AS w
  FROM range(10) t(c), range(-1, 64) u(j)
)"""
SCORES = f"""{LONG_X},
{WEIGHTS},
z AS (
  SELECT s.vec_id, s.label, s.c, s.s + b.w AS z FROM (
    SELECT x.vec_id, any_value(x.label) AS label, w.c, sum(x.x * w.w) AS s
    FROM x JOIN w ON x.j = w.j GROUP BY x.vec_id, w.c
  ) s JOIN w b ON b.c = s.c AND b.j = -1
),
lse AS (
  SELECT vec_id, any_value(label) AS label, max(z) + ln(sum(exp(z - m))) AS lse,
         arg_max(c, z) AS pred_any
  FROM (SELECT *, max(z) OVER (PARTITION BY vec_id) AS m FROM z) GROUP BY vec_id
),
pred AS (
  SELECT vec_id, min(c) AS pred FROM (
    SELECT vec_id, c, z, max(z) OVER (PARTITION BY vec_id) AS m FROM z
  ) WHERE z = m GROUP BY vec_id
),
per_row AS (
  SELECT l.vec_id, l.label, l.lse - zl.z AS loss, CAST(p.pred = l.label AS INTEGER) AS ok
  FROM lse l JOIN z zl ON zl.vec_id = l.vec_id AND zl.c = l.label JOIN pred p ON p.vec_id = l.vec_id
)"""

register("train_test_split", f"SELECT vec_id, {SPLIT} AS split FROM embeddings")
register(
    "split_counts",
    f"""SELECT split, count(*) AS n, CAST(floor(count(*) / 128) AS BIGINT) AS n_batches
FROM (SELECT {SPLIT} AS split FROM embeddings) GROUP BY split""",
)
register("scale_features", "WITH " + LONG_X + "\nSELECT vec_id, j AS i, x / 255.0 AS v FROM x")
register(
    "one_hot_labels",
    "SELECT vec_id, CAST(c AS INTEGER) AS c, CASE WHEN label = c THEN 1.0 ELSE 0.0 END::DOUBLE AS flag "
    "FROM embeddings, range(10) t(c)",
)
register(
    "reshape_grid",
    "WITH " + LONG_X + "\nSELECT vec_id, CAST(j // 8 AS INTEGER) AS r, CAST(j % 8 AS INTEGER) AS c, x AS v FROM x",
)
register("flatten_grid", "WITH " + LONG_X + "\nSELECT vec_id, j AS i, x AS v FROM x")
register(
    "unstack_steps",
    "WITH " + LONG_X + "\nSELECT vec_id, CAST(j // 8 AS INTEGER) AS step, round(sum(x), 6) + 0.0 AS s FROM x GROUP BY vec_id, j // 8",
)
register("last_step", "WITH " + LONG_X + "\nSELECT vec_id, j - 56 AS i, x AS v FROM x WHERE j >= 56")
register(
    "argmax_class",
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS cls FROM embeddings",
)
register("take_head", "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 128")

# -- shuffle, repeat, batch, shard ------------------------------------------------

SHUF = _key("'0:' || '1' || ':' || CAST(vec_id AS VARCHAR)")
SHUF0 = _key("'0:' || '0' || ':' || CAST(vec_id AS VARCHAR)")
register(
    "shuffle_epoch",
    f"SELECT vec_id, row_number() OVER (ORDER BY {SHUF}, vec_id) AS pos FROM embeddings",
)
register(
    "repeat_epochs",
    "SELECT vec_id, CAST(e AS INTEGER) AS epoch FROM embeddings, range(3) t(e)",
)
register(
    "assign_batches",
    f"""SELECT vec_id, CAST({VEC_KEY}
       % CAST(ceil((SELECT count(*) FROM embeddings) / 64.0) AS BIGINT) AS INTEGER) AS batch
FROM embeddings""",
)
register(
    "assign_batches_exact",
    f"""SELECT vec_id, CAST((row_number() OVER (ORDER BY {SHUF0}, vec_id) - 1) // 64 AS INTEGER) AS batch
FROM embeddings""",
)
register(
    "shard_by_key",
    f"SELECT o_orderkey, CAST({ORDER_KEY} % 15 AS INTEGER) AS shard FROM orders",
)

# -- scoring and evaluation with a fixed model --------------------------------------

register("linear_scores", "WITH " + SCORES + "\nSELECT vec_id, c, round(z, 6) + 0.0 AS z FROM z")
register(
    "softmax_scores",
    "WITH " + SCORES + "\nSELECT z.vec_id, z.c, round(exp(z.z - l.lse), 6) AS p FROM z JOIN lse l ON l.vec_id = z.vec_id",
)
register("cross_entropy", "WITH " + SCORES + "\nSELECT round(avg(loss), 6) AS loss, count(*) AS n FROM per_row")
register("cross_entropy_sparse", "WITH " + SCORES + "\nSELECT round(avg(loss), 6) AS loss, count(*) AS n FROM per_row")
register(
    "accuracy_counts",
    "WITH " + SCORES + """
SELECT CAST(sum(ok) AS BIGINT) AS correct, count(*) AS total, round(sum(ok) / count(*), 6) AS accuracy FROM per_row""",
)
register(
    "evaluate_model",
    "WITH " + SCORES + f""",
split AS (SELECT vec_id, {SPLIT} AS split FROM embeddings)
SELECT s.split, count(*) AS n, round(avg(loss), 6) AS loss, round(avg(ok), 6) AS accuracy
FROM per_row p JOIN split s ON s.vec_id = p.vec_id GROUP BY s.split""",
)
register("batch_score", "WITH " + SCORES + "\nSELECT vec_id, pred FROM pred")


#: Blocks in the epoch's order, the rows within each by their own key.
register(
    "shuffle_blocks",
    "WITH b AS (SELECT doc_id, "
    + _key("'0/block:' || CAST(doc_id AS VARCHAR)")
    + " % 16 AS block FROM documents), "
    + ", ".join(
        f"""e{e} AS (
  SELECT {e} AS epoch, doc_id, row_number() OVER (ORDER BY {_key(f"'0/block/{e}:' || CAST(block AS VARCHAR)")}, block, {_key(f"'0:{e}:' || CAST(doc_id AS VARCHAR)")}, doc_id) AS pos FROM b
)"""
        for e in (0, 1)
    )
    + " SELECT epoch, doc_id, pos, (pos - 1) // 64 AS batch FROM (SELECT * FROM e0 UNION ALL SELECT * FROM e1)",
)
register("shuffle_buffer", "SELECT doc_id, true AS in_bounds FROM documents")

# -- training (chained CTEs, one block per step) ------------------------------------

TRAIN_KEY_SPLIT = SPLIT


def _sgd_base(n_batches: int, seeds=("0",), x: str = "x.x") -> list[str]:
    """Training rows with one batch column ``b<i>`` per seed, their long form and batch sizes."""
    batches = ", ".join(f"CAST({_key(f"'{v}:' || CAST(vec_id AS VARCHAR)")} % {n_batches} AS INTEGER) AS b{i}" for i, v in enumerate(seeds))
    names = ", ".join(f"t.b{i}" for i in range(len(seeds)))
    own = ", ".join(f"b{i}" for i in range(len(seeds)))
    ctes = [
        f"tr AS MATERIALIZED (SELECT vec_id, label, {batches} FROM embeddings WHERE {SPLIT} = 'train')",
        f"""xl AS MATERIALIZED (
  SELECT t.vec_id, t.label, {names}, x.j, {x} AS x FROM tr t JOIN (
    SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j,
           CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
  ) x ON x.vec_id = t.vec_id
  UNION ALL
  SELECT vec_id, label, {own}, -1, CAST(1.0 AS DOUBLE) FROM tr
)""",
    ]
    return ctes + [f"nb{i} AS MATERIALIZED (SELECT b{i} AS batch, count(*) AS n FROM tr GROUP BY b{i})" for i in range(len(seeds))]


def _step_ctes(s: int, where: str, batch: str) -> list[str]:
    return [
        f"""z{s} AS MATERIALIZED (
  SELECT xl.vec_id, any_value(xl.label) AS label, any_value(xl.{batch}) AS batch, w.c, sum(xl.x * w.w) AS z
  FROM xl JOIN w{s} w ON xl.j = w.j WHERE {where} GROUP BY xl.vec_id, w.c
)""",
        f"zm{s} AS (SELECT *, max(z) OVER (PARTITION BY vec_id) AS m FROM z{s})",
        f"l{s} AS MATERIALIZED (SELECT vec_id, any_value(m) + ln(sum(exp(z - m))) AS lse FROM zm{s} GROUP BY vec_id)",
        f"""d{s} AS MATERIALIZED (
  SELECT z.vec_id, z.batch, z.c, exp(z.z - l.lse) - CASE WHEN z.c = z.label THEN 1.0 ELSE 0.0 END AS d
  FROM z{s} z JOIN l{s} l ON l.vec_id = z.vec_id
)""",
    ]


def sgd_ctes(steps: int, replicas: int, n_batches: int, lr: float, optimizer: str = "sgd", log_every: int = 0,
             beta1: float = 0.9, beta2: float = 0.999, eps: float = 1e-8, seeds=("0",), x: str = "x.x") -> tuple[list[str], list[str]]:
    """CTEs of a synchronous run (weights ``w<steps>``) and its metric selects.
    With several seeds the steps are divided evenly among them."""
    import math

    ctes = _sgd_base(n_batches, seeds, x)
    ctes.append(
        "w0 AS MATERIALIZED (SELECT CAST(c AS INTEGER) AS c, CAST(j AS INTEGER) AS j, CAST(0 AS DOUBLE) AS w, "
        "CAST(0 AS DOUBLE) AS m, CAST(0 AS DOUBLE) AS v FROM range(10) t(c), range(-1, 64) u(j))"
    )
    metrics = []
    for s in range(steps):
        epoch, local = divmod(s, steps // len(seeds))
        ids = sorted({(local * replicas + r) % n_batches for r in range(replicas)})
        ctes += _step_ctes(s, f"xl.b{epoch} IN ({', '.join(map(str, ids))})", f"b{epoch}")
        ctes.append(
            f"""g{s} AS MATERIALIZED (
  SELECT c, j, sum(gb) / count(*) AS g FROM (
    SELECT d.c, xl.j, d.batch, sum(d.d * xl.x) / any_value(n.n) AS gb
    FROM d{s} d JOIN xl ON xl.vec_id = d.vec_id JOIN nb{epoch} n ON n.batch = d.batch
    GROUP BY d.c, xl.j, d.batch
  ) GROUP BY c, j
)"""
        )
        if optimizer == "sgd":
            upd = f"w.w - {lr!r} * g.g AS w, w.m, w.v"
        else:
            t = s + 1
            lr_t = lr * math.sqrt(1 - beta2**t) / (1 - beta1**t)
            m_new = f"({beta1!r} * w.m + {1 - beta1!r} * g.g)"
            v_new = f"({beta2!r} * w.v + {1 - beta2!r} * g.g * g.g)"
            upd = f"w.w - {lr_t!r} * {m_new} / (sqrt({v_new}) + {eps!r}) AS w, {m_new} AS m, {v_new} AS v"
        ctes.append(
            f"w{s + 1} AS MATERIALIZED (SELECT w.c, w.j, {upd} FROM w{s} w JOIN g{s} g ON g.c = w.c AND g.j = w.j)"
        )
        if log_every and s % log_every == 0:
            ctes.append(
                f"""p{s} AS (SELECT vec_id, min(c) AS pred FROM zm{s} WHERE z = m GROUP BY vec_id)"""
            )
            metrics.append(
                f"""SELECT CAST({s} AS BIGINT) AS step, 'loss' AS metric, round(avg(l.lse - z.z), 6) AS value
FROM l{s} l JOIN z{s} z ON z.vec_id = l.vec_id AND z.c = z.label
UNION ALL
SELECT CAST({s} AS BIGINT), 'accuracy', round(avg(CASE WHEN p.pred = z.label THEN 1.0 ELSE 0.0 END), 6)
FROM p{s} p JOIN (SELECT DISTINCT vec_id, label FROM z{s}) z ON z.vec_id = p.vec_id"""
            )
    return ctes, metrics


def sgd_sql(steps: int, *args, **more) -> str:
    ctes, metrics = sgd_ctes(steps, *args, **more)
    head = "WITH " + ",\n".join(ctes) + "\n"
    if metrics:
        return head + "\nUNION ALL\n".join(metrics)
    return head + f"SELECT c AS class, j AS feature, round(w, 6) + 0.0 AS weight FROM w{steps}"


def train_evaluate_sql(steps: int, replicas: int, n_batches: int, lr: float, divisor: float) -> str:
    """A synchronous run on scaled features, then loss and accuracy of its weights on both splits."""
    ctes, _ = sgd_ctes(steps, replicas, n_batches, lr, x=f"x.x / {divisor!r}")
    ctes += [
        f"""ax AS (
  SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j,
         CAST(unnest(embedding) AS DOUBLE) / {divisor!r} AS x FROM embeddings
  UNION ALL SELECT vec_id, label, -1, CAST(1.0 AS DOUBLE) FROM embeddings
)""",
        f"az AS MATERIALIZED (SELECT ax.vec_id, any_value(ax.label) AS label, w.c, sum(ax.x * w.w) AS z FROM ax JOIN w{steps} w ON w.j = ax.j GROUP BY ax.vec_id, w.c)",
        "am AS (SELECT *, max(z) OVER (PARTITION BY vec_id) AS m FROM az)",
        """ar AS (
  SELECT vec_id, any_value(m) + ln(sum(exp(z - m))) - max(CASE WHEN c = label THEN z END) AS loss,
         CAST(min(CASE WHEN z = m THEN c END) = any_value(label) AS INTEGER) AS ok
  FROM am GROUP BY vec_id
)""",
    ]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT s.split, count(*) AS n, round(avg(loss), 6) AS loss, round(avg(ok), 6) AS accuracy
FROM ar JOIN (SELECT vec_id, {SPLIT} AS split FROM embeddings) s ON s.vec_id = ar.vec_id GROUP BY s.split"""


def averaged_sql(n_shards: int, n_batches: int, lr: float, epochs: int = 1) -> str:
    shard_key = _key("'0:' || CAST(vec_id AS VARCHAR)")
    batches = ", ".join(f"CAST({_key(f"'0+{e + 1}:' || CAST(vec_id AS VARCHAR)")} % {n_batches} AS INTEGER) AS b{e}" for e in range(epochs))
    own = ", ".join(f"b{e}" for e in range(epochs))
    ctes = [
        f"""tr AS MATERIALIZED (
  SELECT vec_id, label, CAST({shard_key} % {n_shards} AS INTEGER) AS shard, {batches}
  FROM embeddings WHERE {SPLIT} = 'train'
)""",
        f"""xl AS MATERIALIZED (
  SELECT t.*, x.j, x.x FROM tr t JOIN (
    SELECT vec_id AS id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j,
           CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
  ) x ON x.id = t.vec_id
  UNION ALL
  SELECT vec_id, label, shard, {own}, -1, CAST(1.0 AS DOUBLE) FROM tr
)""",
        "shards AS (SELECT DISTINCT shard FROM tr)",
        "w0 AS MATERIALIZED (SELECT shard, CAST(c AS INTEGER) AS c, CAST(j AS INTEGER) AS j, CAST(0 AS DOUBLE) AS w "
        "FROM shards, range(10) t(c), range(-1, 64) u(j))",
    ]
    for s in range(n_batches * epochs):
        epoch, batch = divmod(s, n_batches)
        if epoch and not batch:  # every shard goes on from the average
            mean = f"(SELECT c, j, avg(w) AS w FROM w{s}_ GROUP BY c, j)"
            ctes.append(f"w{s} AS MATERIALIZED (SELECT shard, m.c, m.j, m.w FROM shards, {mean} m)")
        after = f"w{s + 1}" + "_" * (batch == n_batches - 1)
        ctes += [
            f"""z{s} AS MATERIALIZED (
  SELECT xl.vec_id, any_value(xl.label) AS label, xl.shard, w.c, sum(xl.x * w.w) AS z
  FROM xl JOIN w{s} w ON xl.j = w.j AND xl.shard = w.shard WHERE xl.b{epoch} = {batch}
  GROUP BY xl.vec_id, xl.shard, w.c
)""",
            f"zm{s} AS (SELECT *, max(z) OVER (PARTITION BY vec_id) AS m FROM z{s})",
            f"l{s} AS MATERIALIZED (SELECT vec_id, any_value(m) + ln(sum(exp(z - m))) AS lse FROM zm{s} GROUP BY vec_id)",
            f"""d{s} AS MATERIALIZED (
  SELECT z.vec_id, z.shard, z.c, exp(z.z - l.lse) - CASE WHEN z.c = z.label THEN 1.0 ELSE 0.0 END AS d
  FROM z{s} z JOIN l{s} l ON l.vec_id = z.vec_id
)""",
            f"""g{s} AS MATERIALIZED (
  SELECT d.shard, d.c, xl.j, sum(d.d * xl.x) / count(DISTINCT d.vec_id) AS g
  FROM d{s} d JOIN xl ON xl.vec_id = d.vec_id GROUP BY d.shard, d.c, xl.j
)""",
            f"""{after} AS MATERIALIZED (
  SELECT w.shard, w.c, w.j, w.w - {lr!r} * coalesce(g.g, 0.0) AS w
  FROM w{s} w LEFT JOIN g{s} g ON g.shard = w.shard AND g.c = w.c AND g.j = w.j
)""",
        ]
    return (
        "WITH " + ",\n".join(ctes)
        + f"\nSELECT c AS class, j AS feature, round(avg(w), 6) + 0.0 AS weight FROM w{n_batches * epochs}_ GROUP BY c, j"
    )


register("softmax_sgd_sync", sgd_sql(8, 2, 4, 0.025))
register("weights_roundtrip", sgd_sql(8, 2, 4, 0.025))
register("softmax_sgd_adam", sgd_sql(8, 2, 4, 1e-3, optimizer="adam"))
register("training_metrics", sgd_sql(8, 2, 4, 0.025, log_every=2))
register("softmax_sgd_averaged", averaged_sql(3, 4, 0.025))
register("softmax_sgd_averaged_epochs", averaged_sql(3, 2, 0.025, epochs=3))
register("softmax_sgd_step_limit", sgd_sql(12, 2, 4, 0.025, seeds=("0/0", "0/1", "0/2")))
register("train_then_evaluate", train_evaluate_sql(8, 2, 4, 0.025, 4.0))

#: A run that stopped and went on took the steps of one that never did.
register("softmax_sgd_resumed", sgd_sql(12, 2, 4, 0.025, seeds=("0/0", "0/1", "0/2")))
register(
    "softmax_adam_resumed",
    sgd_sql(12, 2, 4, 1e-3, optimizer="adam", seeds=("0/0", "0/1", "0/2")).replace("AS weight FROM", "AS weight, CAST(12 AS BIGINT) AS step FROM"),
)
_RESUMED = sgd_ctes(12, 2, 4, 0.025, log_every=1, seeds=("0/0", "0/1", "0/2"))
register(
    "training_metrics_resumed",
    "WITH " + ",\n".join(_RESUMED[0]) + "\nSELECT 'resumed' AS run, * FROM (" + "\nUNION ALL\n".join(_RESUMED[1]) + ")",
)


# -- feed-forward network (chained CTEs: forward, back, Adam, for each step) -----------

NETWORK_SIZES = (64, 120, 84, 10)


def _network_start() -> list[str]:
    ctes = []
    for n, (i, u) in enumerate(zip(NETWORK_SIZES[:-1], NETWORK_SIZES[1:])):
        ctes.append(
            f"""w{n}_0 AS MATERIALIZED (
  SELECT CAST(u AS INTEGER) AS u, CAST(i AS INTEGER) AS i, CAST((389 * u + 211 * i + {101 * n + 557}) % 997 - 498 AS DOUBLE) / 5000 AS w,
         CAST(0 AS DOUBLE) AS m, CAST(0 AS DOUBLE) AS v FROM range({u}) t(u), range(-1, {i}) s(i)
)"""
        )
    return ctes


def _network_forward(tag: str, rows: str, step: int) -> list[str]:
    """Activations ``a<layer><tag>`` (input -1 is constant) of the layers after the first, and the scores ``z<tag>``."""
    ctes, last = [], len(NETWORK_SIZES) - 2
    for n in range(last + 1):
        total = f"SELECT a.vec_id, w.u AS i, sum(a.x * w.w) AS x FROM {rows if not n else f'a{n}{tag}'} a JOIN w{n}_{step} w ON w.i = a.i GROUP BY a.vec_id, w.u"
        if n < last:
            ctes.append(
                f"a{n + 1}{tag} AS MATERIALIZED (SELECT vec_id, i, greatest(x, 0.0) AS x FROM ({total}) "
                f"UNION ALL SELECT DISTINCT vec_id, -1, CAST(1.0 AS DOUBLE) FROM {rows})"
            )
        else:
            ctes.append(f"z{tag} AS MATERIALIZED ({total})")
    ctes.append(f"zm{tag} AS MATERIALIZED (SELECT *, max(x) OVER (PARTITION BY vec_id) AS top FROM z{tag})")
    ctes.append(f"l{tag} AS MATERIALIZED (SELECT vec_id, any_value(top) + ln(sum(exp(x - top))) AS lse FROM zm{tag} GROUP BY vec_id)")
    return ctes


def network_ctes(steps: int, replicas: int, n_batches: int, lr: float, seeds, beta1=0.9, beta2=0.999, eps=1e-7) -> list[str]:
    import math

    ctes = _sgd_base(n_batches, seeds) + _network_start()
    for s in range(steps):
        epoch, local = divmod(s, steps // len(seeds))
        ids = sorted({(local * replicas + r) % n_batches for r in range(replicas)})
        ctes.append(f"r_{s} AS MATERIALIZED (SELECT vec_id, label, b{epoch} AS batch, j AS i, x FROM xl WHERE b{epoch} IN ({', '.join(map(str, ids))}))")
        ctes += _network_forward(f"_{s}", f"r_{s}", s)
        ctes.append(f"y_{s} AS MATERIALIZED (SELECT DISTINCT vec_id, label, batch FROM r_{s})")
        top = len(NETWORK_SIZES) - 2
        ctes.append(
            f"""d{top}_{s} AS MATERIALIZED (
  SELECT z.vec_id, z.i AS u, exp(z.x - l.lse) - CASE WHEN z.i = y.label THEN 1.0 ELSE 0.0 END AS d
  FROM z_{s} z JOIN l_{s} l ON l.vec_id = z.vec_id JOIN y_{s} y ON y.vec_id = z.vec_id
)"""
        )
        for n in range(top, 0, -1):
            ctes.append(
                f"""d{n - 1}_{s} AS MATERIALIZED (
  SELECT b.vec_id, b.i AS u, CASE WHEN a.x > 0 THEN b.d ELSE 0.0 END AS d FROM (
    SELECT d.vec_id, w.i, sum(d.d * w.w) AS d FROM d{n}_{s} d JOIN w{n}_{s} w ON w.u = d.u WHERE w.i >= 0 GROUP BY d.vec_id, w.i
  ) b JOIN a{n}_{s} a ON a.vec_id = b.vec_id AND a.i = b.i
)"""
            )
        t = s + 1
        rate = lr * math.sqrt(1 - beta2**t) / (1 - beta1**t)
        for n in range(top + 1):
            m_new, v_new = f"({beta1!r} * w.m + {1 - beta1!r} * g.g)", f"({beta2!r} * w.v + {1 - beta2!r} * g.g * g.g)"
            ctes.append(
                f"""w{n}_{t} AS MATERIALIZED (
  SELECT w.u, w.i, w.w - {rate!r} * {m_new} / (sqrt({v_new}) + {eps!r}) AS w, {m_new} AS m, {v_new} AS v FROM w{n}_{s} w JOIN (
    SELECT u, i, avg(g) AS g FROM (
      SELECT d.u, a.i, y.batch, sum(d.d * a.x) / any_value(nb.n) AS g
      FROM d{n}_{s} d JOIN {f'a{n}_{s}' if n else f'r_{s}'} a ON a.vec_id = d.vec_id JOIN y_{s} y ON y.vec_id = d.vec_id JOIN nb{epoch} nb ON nb.batch = y.batch
      GROUP BY d.u, a.i, y.batch
    ) GROUP BY u, i
  ) g ON g.u = w.u AND g.i = w.i
)"""
            )
    return ctes


register(
    "relu_network_adam",
    "WITH " + ",\n".join(network_ctes(3, 2, 4, 1e-3, ("0/0",))) + "\n"
    + "\nUNION ALL\n".join(f"SELECT CAST({n} AS INTEGER) AS layer, u AS unit, i AS input, round(w, 6) + 0.0 AS weight FROM w{n}_3" for n in range(3)),
)
register(
    "relu_network_evaluate",
    "WITH " + ",\n".join(
        network_ctes(6, 2, 4, 1e-3, ("0/0", "0/1", "0/2"))
        + ["""ax AS MATERIALIZED (
  SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings
  UNION ALL SELECT vec_id, -1, CAST(1.0 AS DOUBLE) FROM embeddings
)"""]
        + _network_forward("_all", "ax", 6)
    )
    + f"""
SELECT split, count(*) AS n, round(avg(lse - own), 6) AS loss, round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM (
  SELECT e.vec_id, e.label, any_value(e.split) AS split, any_value(l.lse) AS lse, max(CASE WHEN z.i = e.label THEN z.x END) AS own,
         min(CASE WHEN z.x = z.top THEN z.i END) AS pred
  FROM (SELECT vec_id, label, {SPLIT} AS split FROM embeddings) e JOIN zm_all z ON z.vec_id = e.vec_id JOIN l_all l ON l.vec_id = e.vec_id GROUP BY e.vec_id, e.label
) GROUP BY split""",
)

# -- converged estimators -----------------------------------------------------------

#: At the optimum of an unpenalised softmax regression, the probabilities of a
#: class add up to its number of training rows.
register(
    "softmax_regression_check",
    f"SELECT CAST(label AS INTEGER) AS class, round(CAST(count(*) AS DOUBLE), 3) AS mass FROM embeddings WHERE {SPLIT} = 'train' GROUP BY label",
)
register(
    "mlp_classifier_check",
    f"SELECT 'train' AS split, count(*) AS n, true AS beats_prior FROM embeddings WHERE {SPLIT} = 'train'",
)


# -- experiment sheets -------------------------------------------------------------

SWEEP_TIDY = """agg AS (
  SELECT l_returnflag AS f, l_linestatus AS st, l_linenumber AS ln,
         avg(l_extendedprice) AS price, avg(l_quantity) AS qty
  FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber
),
tidy AS (
  SELECT 'Flag ' || f || ' (avg price, by line number)' AS experiment, st || ' (' || m.measure || ')' AS series,
         st AS model, m.measure, CAST(ln AS DOUBLE) AS setting,
         CASE WHEN ln % 2 = 0 THEN '2*' || CAST(ln // 2 AS VARCHAR) ELSE CAST(ln AS VARCHAR) END AS setting_text,
         CASE WHEN m.measure = 'price' THEN price ELSE qty END AS value
  FROM agg, (VALUES ('price'), ('qty')) m(measure)
)"""

register("sweep_unpivot", "WITH " + SWEEP_TIDY + "\nSELECT experiment, series, setting_text, round(value, 6) AS value FROM tidy")
register(
    "sweep_parse_values",
    "WITH " + SWEEP_TIDY + "\nSELECT experiment, model, measure, setting, round(value, 6) AS value FROM tidy",
)
register(
    "sweep_speedup",
    "WITH " + SWEEP_TIDY + """,
base AS (SELECT experiment, series, arg_min(value, setting) AS b FROM tidy GROUP BY experiment, series)
SELECT t.experiment, t.series, t.setting, round(b.b / t.value, 6) AS speedup
FROM tidy t JOIN base b ON b.experiment = t.experiment AND b.series = t.series""",
)
register(
    "sweep_best_setting",
    "WITH " + SWEEP_TIDY + """
SELECT experiment, series, arg_min(setting, [value, setting]) AS best_setting, round(min(value), 6) AS best_value
FROM tidy GROUP BY experiment, series""",
)
register(
    "sweep_model_ratio",
    "WITH " + SWEEP_TIDY + """
SELECT a.experiment, a.measure, a.setting, round(a.value / b.value, 6) AS ratio
FROM tidy a JOIN tidy b ON a.experiment = b.experiment AND a.measure = b.measure AND a.setting = b.setting
WHERE a.model = 'F' AND b.model = 'O'""",
)


def _pivot_sql(settings=range(1, 8)) -> str:
    cols = ", ".join(
        f"round(max(CASE WHEN setting = {s} THEN value END), 6) AS s_{s}" for s in settings
    )
    return "WITH " + SWEEP_TIDY + f"\nSELECT experiment, series, {cols} FROM tidy GROUP BY experiment, series"


register("sweep_pivot", _pivot_sql())

register(
    "sweep_two_sheets",
    """WITH q AS (
  SELECT l_linestatus AS st, l_linenumber AS ln, CAST(sum(l_quantity) AS BIGINT) AS v FROM lineitem GROUP BY ALL
), cells AS (
  SELECT 1 AS sheet, st, ln, CAST(v AS DOUBLE) AS value, CAST(v AS VARCHAR) || 's' AS value_text FROM q
  UNION ALL
  SELECT 2, st, ln, CASE WHEN ln > least THEN CAST(2 * v AS DOUBLE) END, CASE WHEN ln > least THEN CAST(2 * v AS VARCHAR) || 's' ELSE 'n/a' END
  FROM q, (SELECT min(l_linenumber) AS least FROM lineitem)
)
SELECT sheet, 'Quantities, by "line"' AS experiment, st || ' (sum)' AS series, CAST(ln AS DOUBLE) AS setting, value, value_text,
       round(first_value(value IGNORE NULLS) OVER (PARTITION BY sheet, st ORDER BY ln ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) / value, 6) AS speedup
FROM cells""",
)
