"""Base spans against Python's regular expressions; EM and the classifier on planted votes."""

import hashlib
import random
import re

from quarry.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(BASE)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), KINDS.index(kind), m.end(), kind))
    return sorted(out)


def check(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(4)
    got = {r.doc_id: r for r in pii.pii_digest(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = base_spans(t or "")
        line = ",".join(f"{k}:{s}:{e}" for s, _, e, k in want)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), (t, line, r)
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[3] == k for x in want) for k in KINDS]
        assert {f"{k}:{s}:{e}" for s, _, e, k in want} <= set(r.spans.split(","))
    return got


def test_random_texts(spark):
    rng = random.Random(9)
    texts = []
    for alphabet in ("ab@.+-1 23(0)4_%é𝄞\n", "0123456789. -+(", "a@b.c", "4111 -"):
        texts += ["".join(rng.choices(alphabet, k=rng.randint(0, 120))) for _ in range(400)]
    texts += [None, "", "𝄞 4111 1111 1111 1111 é@x.y", "a@b.c" * 300, "+1 (017) 555-7713, 1.2.3.4.5.6.7.8, 0001.002.3.255, 256.1.1.1", "1 " * 3000]
    check(spark, texts)


def test_long_runs_end_quickly(spark):
    texts = ["1" * 300_000, "a." * 150_000, "+1" * 50_000, "(at)" * 50_000, "4111 1111 1111 1111," * 2000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in pii.pii_digest(df).collect()}
    assert [got[i].n_card for i in range(5)] == [0, 0, 0, 0, 2000]
    assert all(got[i].spans == "" for i in range(4))


def test_context_adds_spans_and_noise_does_not(spark):
    rng = random.Random(3)
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    texts = [f"please call 555-{number(3)}-{number(4)} today" for _ in range(60)]
    texts += [f"write to +1 ({number(3)}) 555-{number(4)} now" for _ in range(60)]
    texts += [f"order {number(5)} {number(3)} items" for _ in range(120)]
    got = check(spark, texts)
    assert sum("phone" in got[i].spans for i in range(60)) == 60
    assert sum(got[i].spans != "" for i in range(120, 240)) == 0


def test_reliability_and_classifier_find_the_truth():
    rng = random.Random(5)
    counts = {}
    for _ in range(6000):
        real = rng.random() < 0.4
        right = (0.95, 0.9, 0.8, 0.75, 0.7)
        votes = tuple(0 if rng.random() < 0.2 else (1 if (rng.random() < r) == real else -1) for r in right)
        counts[1, votes, real] = counts.get((1, votes, real), 0) + 1
    sums = {}
    for (k, v, _), n in counts.items():
        sums[k, v] = sums.get((k, v), 0) + n
    share, rate, prob = pii.estimate_reliability([(k, v, float(n)) for (k, v), n in sorted(sums.items())])
    assert abs(share[1] - 0.4) < 0.05
    assert rate[0, 1, True] > rate[3, 1, True] > rate[3, 1, False] > rate[0, 1, False]
    hits = sum(n for (k, v, real), n in counts.items() if (prob(k, v) > 0.5) == real)
    assert hits / 6000 > 0.93
    weights = pii.train_classifier([(k, v, 10, float(n)) for (k, v), n in sorted(sums.items())], prob)
    score = lambda v: sum(a * b for a, b in zip(weights, pii._features(1, v, 10)))
    assert sum(n for (k, v, real), n in counts.items() if (score(v) > 0) == real) / 6000 > 0.92


def test_rows_without_id_repeated_rows_and_empty_tables(spark):
    rows = [(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(repr, ((r.doc_id, r.spans) for r in pii.pii_digest(df).collect()))) == sorted(map(repr, [(i, "email:0:5") for i, _ in rows]))
    assert pii.pii_digest(df.where("false")).collect() == []


def test_numbers_in_a_match_that_fails_are_candidates(spark):
    texts = ["Call +1 202-555-0100 202-555-0101 today", "Call +1 202-555-0100 today"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: {texts[r.id][x.s : x.e] for x in r.spans if x.kind == "phone" and not x.base} for r in pii.find_candidates(df).collect()}
    assert any("202-555-0101" in x for x in got[0]) and got[1] == set()


def test_classifier_is_the_same_at_every_size():
    rng = random.Random(8)
    cells = [(k, tuple(rng.choice((-1, 0, 1)) for _ in pii.LABELERS), rng.randint(0, 19), float(rng.randint(1, 50))) for k in range(4) for _ in range(30)]

    def real(k, votes):
        return 1 / (1 + 2.0 ** -sum(votes))

    small = pii.train_classifier(cells, real)
    for times in (1000, 10**6):
        large = pii.train_classifier([(k, v, d, n * times) for k, v, d, n in cells], real)
        assert max(abs(a - b) for a, b in zip(small, large)) < 1e-6
    assert max(map(abs, small)) > 0.1
