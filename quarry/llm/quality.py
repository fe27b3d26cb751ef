"""Quality rules as a learned decision list (operator 7).

Every document gets simple counts (words, word characters, symbols, repeated
lines, words in repeated three-word windows). From labelled rows, *sequential
covering* learns an ordered list of rules: a rule is grown as a conjunction of
thresholds on ratios of the counts (best information gain first) on two thirds
of the rows, pruned on the last third, and kept if it is precise enough there;
the rows it covers are taken out, and the next rule is grown on the rest. The
list is emitted as one ordered Spark conditional expression.

Fitting uses at most ``FIT_ROWS`` labelled rows (lowest hash of the id first).
Documents that repeat a labelled id share the weight of its label, equal ones as
one row, and at most ``FIT_ROWS`` rows (heaviest first) reach the driver;
counting and judging cover every document.

Defined cases: a null text has no words, so it fails the base rule; labels
without a document or without a label are left out; with no labels (or none of
one class) the list is empty and only the base rule rejects; documents listed
twice in the labels count twice in the fit; repeated documents are judged
alike; extra columns stay as they are.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import join_small
from .components import written
from .texts import free_name, small_batches, space_words, utf8

#: Bound of the labelled rows that the list is fitted on.
FIT_ROWS = 20_000
#: Fixed values of the base rule.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words")
_SCHEMA = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def repeated_window_words(ids: np.ndarray, n_ids: int) -> int:
    """Words inside three-word windows that occur at least twice."""
    if len(ids) < 4:
        return 0
    a, b, c = ids[:-2], ids[1:-1], ids[2:]
    pair = a * n_ids + b
    if n_ids >= 1 << 20:  # three ids don't fit 63 bits: number the pairs first
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    windows, inverse, times = np.unique(pair * n_ids + c, return_inverse=True, return_counts=True)
    if len(windows) == len(pair):
        return 0
    twice = times[inverse] > 1
    marked = np.zeros(len(ids), bool)
    for k in range(3):
        marked[k : k + len(twice)] |= twice
    return int(marked.sum())


def counts_of(text: bytes | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = space_words(text)
    if not words:
        return (0,) * 5 + (0, 0)
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    stream = np.frombuffer(b"".join(words), np.uint8)
    code_points = int(((stream & 0xC0) != 0x80).sum())
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words), code_points, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
        repeated_window_words(ids, len(seen)), len(lines), len(seen),
    )


def quality_counts(text: Column | str) -> Column:
    """Struct of the counts of a text column."""

    @F.arrow_udf(_SCHEMA)
    def counts(texts: pa.Array) -> pa.Array:
        table = np.array([counts_of(t) for t in utf8(texts)], np.int64).reshape(-1, len(COUNTS))
        return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(table[:, k])) for k in range(len(COUNTS))], names=list(COUNTS))

    return counts(F.col(text) if isinstance(text, str) else text)


def features(c: Column) -> dict[str, Column]:
    """The numbers that rules put thresholds on, from a counts struct."""
    per = lambda a, b: c[a] / F.greatest(c[b], F.lit(1))
    return {
        "words": c["n_words"].cast("double"),
        "word_length": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "distinct_share": per("n_distinct_words", "n_words"),
        "words_per_line": per("n_words", "n_lines"),
    }


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x > self.threshold if self.above else x <= self.threshold

    def column(self, f: dict[str, Column]) -> Column:
        return f[self.feature] > self.threshold if self.above else f[self.feature] <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


class DecisionList:
    """Ordered rules that reject; what no rule covers is kept."""

    def __init__(self, rules: list[tuple[Condition, ...]]):
        self.rules = rules

    def verdict(self, c: Column) -> Column:
        """``true`` where the list keeps: ``CASE WHEN rule 1 THEN false ... ELSE true``."""
        f, out = features(c), None
        for rule in self.rules:
            test = F.lit(True)
            for condition in rule:
                test = test & condition.column(f)
            out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def rejects(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.zeros(len(next(iter(x.values()))), bool)
        for rule in self.rules:
            out |= np.logical_and.reduce([c.holds(x[c.feature]) for c in rule])
        return out

    def __str__(self) -> str:
        return "\n".join(["reject if " + " and ".join(map(str, rule)) for rule in self.rules] + ["keep"])


def fit_decision_list(
    x: dict[str, np.ndarray], bad: np.ndarray, min_precision: float = 0.95, min_cover: int = 5,
    max_conditions: int = 4, max_rules: int = 20, cuts: int = 64, seed: int = 7, weight: np.ndarray | None = None,
) -> DecisionList:
    """Sequential covering of the ``bad`` rows. Deterministic for given rows."""
    n = len(bad)
    weight = np.ones(n) if weight is None else weight
    mass = lambda rows: float(weight[rows].sum())
    part = np.random.default_rng(seed).permutation(n) % 3 < 2  # grow on these, prune on the others
    left = np.ones(n, bool)
    rules: list[tuple[Condition, ...]] = []
    thresholds = {k: np.unique(np.quantile(v, np.linspace(0, 1, cuts + 1)))[:-1] if n else [] for k, v in x.items()}

    def cover(rule, rows):
        return np.logical_and.reduce([rows, *[c.holds(x[c.feature]) for c in rule]])

    def worth(rule):
        got = cover(rule, left & ~part)
        p, m = mass(got & bad), mass(got & ~bad)
        return (p - m) / (p + m) if p + m else -1.0

    while len(rules) < max_rules and mass(left & bad) >= min_cover:
        rule: list[Condition] = []
        rows = left & part
        while len(rule) < max_conditions and (rows & ~bad).any():
            p0, n0 = mass(rows & bad), mass(rows & ~bad)
            if not p0:
                break
            best = None
            for k, values in x.items():
                for t in thresholds[k]:
                    for above in (True, False):
                        got = rows & (values > t if above else values <= t)
                        p, m = mass(got & bad), mass(got & ~bad)
                        if p >= min_cover // 2 + 1:
                            gain = p * (log2(p / (p + m)) - log2(p0 / (p0 + n0)))
                            if best is None or gain > best[0]:
                                best = (gain, Condition(k, above, float(t)))
            if best is None or best[0] <= 1e-9:
                break
            rule.append(best[1])
            rows = cover(rule, left & part)
        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule.pop()
        if not rule:
            break
        got = cover(rule, left)
        held = cover(rule, left & ~part)
        precise = mass(held & bad) >= min_precision * max(1, mass(held)) and mass(got & bad) >= min_precision * mass(got)
        if not precise or mass(got & bad) < min_cover:
            break
        rules.append(tuple(rule))
        left &= ~got
    return DecisionList(rules)


def fit_table(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit_rows: int) -> DataFrame:
    """At most ``fit_rows`` rows ``(id, label, features, weight)``; a label's weight is shared by the documents of its id."""
    chosen = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id IS NOT NULL AND label IS NOT NULL")
    chosen = chosen.orderBy(F.xxhash64("id"), "id", "label").limit(fit_rows)  # bounded, so it may be broadcast
    chosen = chosen.groupBy("id", "label").agg(F.count("*").alias("times"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    counted = rows.select("id", "label", "times", quality_counts("text").alias("c")).where(~base_failed(F.col("c")))
    f = features(F.col("c"))
    each = counted.select("id", "label", "times", *[v.alias(k) for k, v in f.items()]).groupBy("id", "label", "times", *f).agg(F.count("*").alias("n"))
    each = written(each, "labelled")
    total = each.groupBy("id", "label").agg(F.sum("n").alias("total"))
    weighed = join_small(each, total, ["id", "label"]).select("id", "label", *f, (F.col("times") * F.col("n") / F.col("total")).alias("weight"))
    return weighed.orderBy(F.desc("weight"), F.xxhash64("id", "label", *f), "id", "label", *f).limit(fit_rows)


def learn_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> DecisionList:
    """The decision list learned from at most ``fit_rows`` labelled documents."""
    found = fit_table(docs, labels, id_col, text_col, label_col, fit_rows)
    names = [x for x in found.columns if x not in ("id", "label", "weight")]
    table = found.orderBy("id", "label", *names).toPandas()
    return fit_decision_list({k: table[k].to_numpy(float) for k in names}, table["label"].to_numpy() == 0, weight=table["weight"].to_numpy(float))


def judged(docs: DataFrame, rules: DecisionList, text_col: str = "text", out_col: str = "quality_counts") -> DataFrame:
    """``docs`` with a struct of the counts, ``base_failed`` and ``kept``."""
    small_batches(docs.sparkSession)
    with_counts = docs.withColumn(out_col, quality_counts(text_col))
    c = F.col(out_col)
    failed = base_failed(c)
    return with_counts.withColumn(out_col, c.withField("base_failed", failed).withField("kept", ~failed & rules.verdict(c)))


def keep_good(docs: DataFrame, rules: DecisionList, text_col: str = "text") -> DataFrame:
    """``docs`` without the rejected documents; same columns."""
    name = free_name(docs, "quality_counts")
    return judged(docs, rules, text_col, name).where(F.col(name)["kept"]).select(*[docs[c] for c in docs.columns])


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rules = learn_rules(docs, labels)
    c = F.col("quality_counts")
    out = judged(docs.select("doc_id", "text"), rules)
    return out.select("doc_id", *[c[k].alias(k) for k in COUNTS[:5]], c["base_failed"].alias("base_failed"), c["kept"].alias("kept"))


def brute_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """The five contract counts by plain Python (tests)."""
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    marked = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(marked)
