"""License scan against every stretch of a document."""

import random

from quarry.llm import licenses as L
from quarry.llm.license_texts import TEMPLATES
from quarry.llm.texts import alnum_words


def texts():
    rng = random.Random(8)
    notices = list(TEMPLATES.values())
    out = []
    for _ in range(300):
        prose = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(0, 400))]
        for _ in range(rng.randint(0, 2)):
            words = rng.choice(notices).split()
            if len(words) > 8 and rng.random() < 0.5:
                words[rng.randrange(len(words))] = "changed"
            if rng.random() < 0.2:
                words = words[: len(words) // 2]
            at = rng.randint(0, len(prose))
            prose[at:at] = words
        out.append(" ".join(prose))
    return out + [None, "", "All", "all RIGHTS reserved", "All rights reserved. " * 500]


def brute(text, templates, containment=L.CONTAINMENT):
    """Every stretch of every length, one shingle apart, without hashes or signatures."""
    words, out = alnum_words(text), []
    for t in templates:
        grams = [tuple(words[i : i + t.width]) for i in range(len(words) - t.width + 1)]
        best = None
        for s in range(len(grams)):
            if grams[s] in t.shingles:  # a stretch that starts elsewhere holds no more
                share = len(t.shingles & set(grams[s : s + t.reach])) / len(t.shingles)
                if share >= containment and (best is None or share > best[0]):
                    best = (share, s)
        if best:
            out.append((t.name, *best))
    return sorted(out)


def test_scan_equals_every_stretch():
    templates = L.make_templates(TEMPLATES)
    data = [t.encode() if t is not None else None for t in texts()]
    got = L.Scanner(templates).scan(data)
    assert got == [brute(t, templates) for t in data]
    assert {"MIT", "BSD-2-Clause", "ISC", "MPL-2.0-header"} <= {n for x in got for n, _, _ in x}


def test_words_put_into_a_licence_at_all_offsets():
    templates = L.make_templates(TEMPLATES)
    scanner, rng = L.Scanner(templates), random.Random(3)
    noise = lambda n: [f"x{rng.randint(0, 10**6)}" for _ in range(n)]
    data = []
    for name in ("MIT", "BSD-2-Clause", "ISC", "MPL-2.0-header", "ISC-grant", "BSD-2-Clause-conditions"):
        words = TEMPLATES[name].split()
        for offset in range(0, 2 * len(words), max(1, len(words) // 12)):
            for share in (0.0, 0.1, 0.25):
                cut = rng.randrange(len(words) // 3, 2 * len(words) // 3)
                data.append((name, noise(offset) + words[:cut] + noise(int(share * len(words))) + words[cut:] + noise(rng.randint(0, 80))))
    encoded = [" ".join(words).encode() for _, words in data]
    got = scanner.scan(encoded)
    assert got == [brute(t, templates) for t in encoded]
    assert all(name in {n for n, _, _ in x} for (name, _), x in zip(data, got))  # recall of the whole set


def test_bands_hold_their_promise():
    for s in (0.1, 0.25, 0.5, 0.9):
        rows, bands = L.choose_bands(s, 1e-3)
        assert (1 - s**rows) ** bands <= 1e-3 + 1e-12
    for m in range(1, 300):
        w, step = L.window_size(m), L.stride(L.window_size(m))
        assert w >= 4 * m and L.reach(m) >= 2.5 * m
        for start in range(3 * step):  # a stretch lies whole within a window, wherever it starts
            assert start % step + L.reach(m) <= w
    assert L.make_templates({"empty": "...", "x": "One two"})[0].name == "x"


def test_query_form(spark):
    data = texts()
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(data)] + [(None, "All rights reserved.", 1)], "doc_id long, text string, licenses int").repartition(4)
    templates = L.make_templates(TEMPLATES)
    got = {r.doc_id: (r.n_licenses, r.licenses) for r in L.license_digest(df).collect()}
    for i, t in enumerate(data):
        want = [n for n, _, _ in brute(t.encode() if t is not None else None, templates)]
        assert got[i] == (len(want), ",".join(want))
    assert got[None] == (1, "all-rights-reserved")
    assert L.license_digest(df.where("false")).collect() == []
    assert L.find_licenses(df, out_col="found").columns == [*df.columns, "found"]
