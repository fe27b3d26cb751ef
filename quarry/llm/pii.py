"""Personal data by weak supervision (operator 5); DataFrame functions only.

Candidates are all matches of one pattern per kind (email, ip, card, phone)
and of two looser ones. Five labelers vote for or against each candidate, or
abstain: the kind's own check (parts, checksum, digit count), a gazetteer (mail
domains, address ranges, card issuers, calling codes), cue words before it, its
shape, and its borders. Expectation-maximisation over the counts of vote
patterns gives each labeler's reliability and each pattern's probability; with
these as soft labels a logistic span classifier is trained. It decides about
the candidates that fail their kind's check; those that pass always stay.

Both fits use sums over *all* candidates of all documents, grouped by vote
pattern and digit count: at most a few thousand rows whatever the corpus size,
which the driver reads. Offsets are code points and follow from the lengths of
the pieces between matches, so every step is a projection of the document's
own row: no join and no shuffle of texts.

Defined cases: null and empty texts have no spans; rows without id and
repeated rows each keep their row; without candidates (or an empty table) the
classifier adds nothing; patterns are free of backtracking over long runs;
other columns aren't looked at.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import written

#: The kinds, in the order of ties.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
#: Name -> kind, pattern, and the cheap test a text must pass to hold a match.
#: Possessive runs and the look-behinds only leave out attempts that can't succeed.
SOURCES: dict[str, tuple[str, str, str]] = {
    "email": ("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": ("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]"),
    "card": ("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]"),
    "phone": ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+"),
    "spelled_email": ("email", rf"(?<!{_LOCAL}){_LOCAL}++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++", r"[\[(]at[\])]"),
    "local_phone": ("phone", r"(?<![0-9+(])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", "[0-9]"),
}
LABELERS = ("check", "gazetteer", "context", "shape", "border")
#: Fixed values of the gazetteers and cue lists.
MAIL_DOMAINS = "com org net edu gov mil int info io co uk de fr es it nl eu us ca ch at be se no pl br in cn jp au".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358 380 420 421".split()
CARD_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|64[4-9]|65|35|62)"
CUES = {
    "email": "mail|e-mail|contact|write to|kontakt|correo|courriel",
    "ip": "ip|host|server|address|addr|from|login",
    "card": "card|visa|mastercard|amex|credit|karte|carte|tarjeta|payment|paid",
    "phone": "phone|tel|call|fax|mobile|telefon|tél|teléfono|cell|dial",
}
COUNTER_CUES = r"version|isbn|issn|order|invoice|token|serial|id|no\.|nr\.|#|v"
#: Probability from which a candidate that fails its kind's check is added.
THRESHOLD = 0.9
_BLOCK = 64  # offsets are summed in blocks, so a text with many matches stays cheap


def _matches(docs: DataFrame, text: str) -> DataFrame:
    """Per source: the matches ``_m``, the pieces around them ``_p`` (length and
    ends), the length of each piece with its match ``_l`` and their block sums ``_b``."""
    t = F.col(text)
    out = docs
    for name, (_, pattern, needs) in SOURCES.items():
        there = t.contains(needs) if needs == "@" else t.rlike(needs)
        lit = F.lit(pattern)
        out = out.withColumn(f"{name}_m", F.when(there, F.regexp_extract_all(t, lit, F.lit(0))))
        piece = lambda x: F.struct(F.length(x).alias("n"), F.right(x, F.lit(24)).alias("before"), F.left(x, F.lit(4)).alias("after"))
        out = out.withColumn(f"{name}_p", F.when(there, F.transform(F.split(t, pattern, -1), piece)))
    out = out.drop(text)
    out = out.withColumns({f"{n}_l": _lengths(n) for n in SOURCES})
    return out.withColumns({f"{n}_b": F.when(F.size(f"{n}_l") > 0, _block_sums(n)) for n in SOURCES})


def _lengths(name: str) -> Column:
    return F.transform(F.col(f"{name}_m"), lambda m, i: F.length(m) + F.get(F.col(f"{name}_p"), i)["n"])


def _block_sums(name: str) -> Column:
    lens = F.col(f"{name}_l")
    blocks = F.sequence(F.lit(0), F.floor((F.size(lens) - 1) / _BLOCK).cast("int"))
    return F.transform(blocks, lambda b: F.aggregate(F.slice(lens, b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), lambda a, x: a + x))


def _spans(name: str) -> Column:
    """The source's matches with code-point offsets, from the columns of :func:`_matches`."""
    kind = SOURCES[name][0]
    m, p, lens, sums = (F.col(f"{name}_{x}") for x in "mplb")
    total = lambda a: F.aggregate(a, F.lit(0), lambda acc, x: acc + x)

    def span(x, i):
        block = F.floor(i / _BLOCK).cast("int")
        start = total(F.slice(sums, F.lit(1), block)) + total(F.slice(lens, block * _BLOCK + 1, i - block * _BLOCK)) + F.get(p, i)["n"]
        return F.struct(
            F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("k"), F.lit(name == kind).alias("base"), start.alias("s"),
            (start + F.length(x)).alias("e"), x.alias("text"), F.get(p, i)["before"].alias("before"), F.get(p, i + 1)["after"].alias("after"),
        )

    return F.coalesce(F.transform(m, span), F.expr("CAST(array() AS array<struct<kind:string,k:int,base:boolean,s:int,e:int,text:string,before:string,after:string>>)"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def passes(kind: Column, text: Column) -> Column:
    """The check of the kind: parts at most 255; 12 to 19 digits with a right checksum; 9 to 15 digits."""
    digits = _digits(text)
    parts = F.split(text, r"\.")
    small = F.forall(parts, lambda x: (F.length(F.ltrim(x, F.lit("0"))) <= 3) & (F.coalesce(F.right(x, F.lit(3)).try_cast("int"), F.lit(0)) <= 255))
    return (
        F.when(kind == "email", text.contains("@"))
        .when(kind == "ip", small)
        .when(kind == "card", F.length(digits).between(12, 19) & F.call_function("luhn_check", digits))
        .otherwise(text.startswith("+") & F.length(digits).between(9, 15))
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, 1).when(bad, -1).otherwise(0)


def _votes(x: Column) -> list[Column]:
    """The labelers' votes on a candidate struct, in the order of ``LABELERS``."""
    kind, text, digits = x["kind"], x["text"], _digits(x["text"])
    domain = F.lower(F.element_at(F.split(text, r"[.\])\x20]+"), -1))
    first = F.coalesce(F.get(F.split(text, r"\."), F.lit(0)).try_cast("int"), F.lit(999))
    gazetteer = (
        F.when(kind == "email", _vote(domain.isin(MAIL_DOMAINS), F.lit(True)))
        .when(kind == "ip", _vote((first >= 1) & (first < 224) & (first != 127), F.lit(True)))
        .when(kind == "card", _vote(digits.rlike(CARD_ISSUERS), F.lit(True)))
        .otherwise(_vote(text.startswith("+") & digits.rlike(f"^(?:{'|'.join(CALLING_CODES)})"), F.lit(False)))
    )
    before = F.lower(x["before"])
    cue = F.lit(False)
    for k in KINDS:
        cue = cue | ((kind == k) & before.rlike(rf"(?<![\p{{L}}0-9])(?:{CUES[k]})[\x20:=#\"'(-]*$"))
    context = _vote(cue, before.rlike(rf"(?<![\p{{L}}0-9])(?:{COUNTER_CUES})[\x20:=\"'(-]*$"))
    n = F.length(digits)
    shape = (
        F.when(kind == "email", _vote(F.length(F.substring_index(text, "@", 1)).between(2, 64), F.length(text) > 254))
        .when(kind == "ip", _vote(~text.rlike(r"(?:^|\.)0[0-9]"), F.lit(True)))
        .when(kind == "card", _vote(text.rlike(r"^(?:[0-9]{15,16}|[0-9]{4}(?:([\x20-])[0-9]{4})(?:\1[0-9]{4}){2})$"), (n < 12) | (n > 19)))
        .otherwise(_vote(n.between(10, 13), (n < 7) | (n > 15)))
    )
    touching = F.right(x["before"], F.lit(1)).rlike(r"[\p{L}0-9]") | F.left(x["after"], F.lit(1)).rlike(r"[\p{L}0-9]")
    inside = F.right(x["before"], F.lit(1)).rlike(r"[.@+/_-]") | F.left(x["after"], F.lit(2)).rlike(r"^[-.@/_][\p{L}0-9]")
    border = _vote(~touching & ~inside, touching)
    return [_vote(passes(kind, text), F.lit(True)), gazetteer, context, shape, border]


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, spans)``: per row, all candidates with offsets, votes and digit count."""
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = written(_matches(texts, "text"), "pii_matches")
    spans = written(found.select("id", F.concat(*[_spans(n) for n in SOURCES]).alias("spans")), "pii_spans")
    # a looser match within or across one of the kind's own pattern that passes its check is no candidate of its own
    own = F.transform(F.filter("spans", lambda b: b["base"] & passes(b["kind"], b["text"])), lambda b: F.struct(b["k"].alias("k"), b["s"].alias("s"), b["e"].alias("e")))
    spans = written(spans.withColumn("own", own), "pii_own")
    lone = lambda x: ~F.exists("own", lambda b: (b["k"] == x["k"]) & (b["s"] < x["e"]) & (x["s"] < b["e"]))
    spans = spans.withColumn("spans", F.filter("spans", lambda x: x["base"] | lone(x)))
    voted = F.transform(
        "spans",
        lambda x: F.struct(
            *[x[c].alias(c) for c in ("kind", "k", "base", "s", "e")], F.array(*_votes(x)).alias("votes"),
            F.least(F.length(_digits(x["text"])), F.lit(20)).alias("digits"),
        ),
    )
    return written(spans.select("id", voted.alias("spans")), "pii_votes")


def estimate_reliability(rows: list[tuple[int, tuple[int, ...], float]], rounds: int = 200, tol: float = 1e-9):
    """EM over ``(kind, votes, count)``: each labeler has a rate of voting for,
    against or not at all on real and on false spans, each kind a share of
    real ones. Returns these and a function from (kind, votes) to the probability."""
    kinds, n_labelers = sorted({k for k, _, _ in rows}), len(LABELERS)
    share = {k: 0.5 for k in kinds}
    # a labeler starts out right in seven of ten votes
    rate = {(j, v, real): {0: 0.4, 1: 0.42 if real else 0.18, -1: 0.18 if real else 0.42}[v] for j in range(n_labelers) for v in (-1, 0, 1) for real in (False, True)}

    def real(k, votes):
        a = math.log(share[k]) + sum(math.log(rate[j, v, True]) for j, v in enumerate(votes))
        b = math.log(1 - share[k]) + sum(math.log(rate[j, v, False]) for j, v in enumerate(votes))
        return 1 / (1 + math.exp(min(700, b - a)))

    last = None
    for _ in range(rounds):
        post = [real(k, votes) for k, votes, _ in rows]
        for k in kinds:
            total = sum(n for kk, _, n in rows if kk == k)
            share[k] = (1 + sum(p * n for p, (kk, _, n) in zip(post, rows) if kk == k)) / (2 + total)
        mass = {r: sum((p if r else 1 - p) * n for p, (_, _, n) in zip(post, rows)) for r in (False, True)}
        for j in range(n_labelers):
            for v in (-1, 0, 1):
                for r in (False, True):
                    got = sum((p if r else 1 - p) * n for p, (_, votes, n) in zip(post, rows) if votes[j] == v)
                    rate[j, v, r] = (1 + got) / (3 + mass[r])
        now = sum(p * n for p, (_, _, n) in zip(post, rows))
        if last is not None and abs(now - last) <= tol * max(1.0, now):
            break
        last = now
    return share, rate, real


def _features(k: int, votes: tuple[int, ...], digits: int) -> list[float]:
    return [1.0, *[float(k == i) for i in range(1, len(KINDS))], *[float(v == 1) for v in votes], *[float(v == -1) for v in votes], digits / 20]


def train_classifier(cells: list[tuple[int, tuple[int, ...], int, float]], real, ridge: float = 0.001, rounds: int = 50) -> list[float]:
    """Weights of a ridge logistic regression on soft labels; a cell is (kind, votes, digits, count).
    Cells weigh by their share of the candidates, so the penalty is the same at every size."""
    width = len(_features(0, (0,) * len(LABELERS), 0))
    if not cells:
        return [-10.0] + [0.0] * (width - 1)
    x = np.array([_features(k, v, d) for k, v, d, _ in cells])
    y = np.array([real(k, v) for k, v, _, _ in cells])
    n = np.array([c for *_, c in cells], float)
    n = n / n.sum()
    w = np.zeros(width)
    penalty = ridge * np.eye(width)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + penalty @ w
        curve = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return [float(v) for v in w]


def _score(x: Column, w: list[float]) -> Column:
    """The classifier's log-odds for a voted candidate struct."""
    n = len(KINDS) - 1
    total = F.lit(w[0])
    for i in range(n):
        total = total + F.when(x["k"] == i + 1, w[1 + i]).otherwise(0.0)
    for j in range(len(LABELERS)):
        v = x["votes"][j]
        total = total + F.when(v == 1, w[1 + n + j]).when(v == -1, w[1 + n + len(LABELERS) + j]).otherwise(0.0)
    return total + x["digits"] / 20 * w[-1]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(id_col, base, added)``: arrays of ``(s, k, e, kind)`` sorted by start, then kind."""
    voted = find_candidates(docs, id_col, text_col)
    cells = voted.select(F.explode("spans").alias("x")).groupBy("x.k", "x.votes", "x.digits").count().collect()  # bounded: 4 kinds, 3^5 votes, 21 counts
    rows = sorted((r["k"], tuple(r["votes"]), r["digits"], float(r["count"])) for r in cells)
    sums: dict[tuple, float] = {}
    for k, votes, _, n in rows:
        sums[k, votes] = sums.get((k, votes), 0.0) + n
    _, _, real = estimate_reliability([(k, v, n) for (k, v), n in sorted(sums.items())])
    weights = train_classifier(rows, real)
    is_base = lambda x: x["base"] & (x["votes"][0] == 1)
    short = lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["kind"].alias("kind"))
    base = F.array_sort(F.transform(F.filter("spans", is_base), short))
    chosen = F.filter("spans", lambda x: ~is_base(x) & (_score(x, weights) > math.log(threshold / (1 - threshold))))
    both = voted.select("id", base.alias("base"), F.transform(chosen, short).alias("more"))
    apart = F.filter(F.array_distinct("more"), lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    return both.select(F.col("id").alias(id_col), "base", F.array_sort(apart).alias("added"))


def pii_digest(docs: DataFrame) -> DataFrame:
    found = find_personal_data(docs)
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.array_sort(F.concat("base", "added"))).alias("spans"))
