"""Line dedup against a plain-Python template tree."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import xxhash

from quarry.llm import lines as L


def signed(text):
    return int(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).view(np.int64))


def normal(line):
    tokens = re.split(r"[ \t\x0b\f\r]+", line.strip(" \t\x0b\f\r"))
    return " ".join("<*>" if re.search("[0-9]", t) else t for t in tokens)


def even(line):
    return " ".join(re.split(r"[ \t\x0b\f\r]+", line.strip(" \t\x0b\f\r")))


def brute_templates(lines):
    """The template of each masked line of a generalised leaf."""
    leaves = defaultdict(set)
    for x in lines:
        t = x.split(" ")
        if len(t) >= L.MIN_TOKENS:
            for out in range(L.DEPTH + 1):
                leaves[len(t), out, tuple(t[:out] + t[out + 1 : L.DEPTH + 1])].add(x)
    chosen = {}
    for (n, _, _), members in leaves.items():
        if len(members) < L.CHILDREN:
            continue
        fields = [i for i, met in enumerate(zip(*(x.split(" ") for x in members))) if len(set(met)) >= L.CHILDREN]
        if fields and n - len(fields) >= L.CONSTANT * n:
            for x in members:
                shape = " ".join("<*>" if i in fields else t for i, t in enumerate(x.split(" ")))
                chosen[x] = min(chosen.get(x, (0, "")), (-len(members), shape))
    return {x: ("shape", shape) for x, (_, shape) in chosen.items()}


def brute(rows):
    """Per text: a flag for each line."""
    texts = {t: [even(x) for x in t.split("\n")] for _, t in rows if t is not None}
    template = brute_templates({normal(x) for ls in texts.values() for x in ls if x})
    held = defaultdict(set)
    for t, ls in texts.items():
        for x in ls:
            held[x].add(t)
    met = defaultdict(set)
    for t, ls in texts.items():
        ls = [x for x in ls if x]
        if not ls:
            continue
        own = [x for x in ls if len(held[x]) < L.MIN_DOCS]
        if all(normal(x) != x or x in template for x in ls):
            company = ("text", t)
        elif sum(len(x.split(" ")) for x in own) >= L.OWN * sum(len(x.split(" ")) for x in ls):
            company = ("own", min(own, key=signed))
        else:
            company = ("shared", min((x for x in ls if x not in own), key=lambda x: (len(held[x]), signed(x))))
        for x in ls:
            met[template.get(normal(x), normal(x))].add(company)
    often = {k for k, companies in met.items() if len(companies) >= L.MIN_DOCS}
    return {t: [bool(x) and template.get(normal(x), normal(x)) in often for x in ls] for t, ls in texts.items()}


def sample():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    prose = lambda: " ".join(word() for _ in range(rng.randint(3, 9)))
    rows = []
    for i in range(120):
        ls = [prose() for _ in range(rng.randint(1, 6))]
        if i % 3 == 0:
            ls.insert(rng.randint(0, len(ls)), "All rights  reserved.")
        if i % 4 == 0:
            ls.append(f"Posted on {rng.randint(1, 28)} May by {word()} in the news")
        if i % 5 == 0:
            ls.append(f"Page {i} of 120\t")
        rows.append((i, "\n".join(ls)))
    copied = "\n".join(prose() for _ in range(5))
    rows += [(200 + i, copied) for i in range(40)]  # exact copies
    rows += [(300 + i, copied + "\n" + prose()) for i in range(40)]  # near copies
    rows += [(400, None), (401, ""), (402, "\n \n"), (403, "All rights reserved."), (0, rows[0][1]), (None, "All rights reserved.\nown line here"), (404, "x" * 50_000 + " 1" * 20_000)]
    return rows


def test_flags_equal_brute_force(spark):
    rows = sample()
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, line_id string, line_flags int").repartition(5)
    want = brute(rows)
    got = L.clean_lines(df, out_col="flags").collect()
    assert len(got) == len(rows)
    dropped = 0
    for r in got:
        flags = want.get(r.text, [])
        assert (r.flags or [False] * len(flags)) == flags, r
        dropped += sum(flags)
    assert dropped > 90
    # boilerplate goes, copied documents stay for near-duplicate removal
    assert not any(any(want[t]) for i, t in rows if i is not None and 200 <= i < 400)


def test_digest_and_cleaned_documents(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    expected = []
    for i, t in rows:
        flags = want.get(t, [])
        kept = "\n".join(x for x, f in zip((t or "").split("\n"), flags) if not f) if t is not None else ""
        expected.append((i, len(flags), sum(flags), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, L.line_digest(df).collect()))) == sorted(map(repr, expected))
    cleaned = L.drop_recurring(df)
    assert cleaned.columns == df.columns
    ids = [r.doc_id for r in cleaned.collect()]
    assert 403 not in ids and {400, 401, 402} <= set(ids) and len([i for i in ids if i is not None and i >= 200]) == 84
    assert L.line_digest(df.where("false")).collect() == []


def unlike(n, block, own, seed=5, length=9):
    """``n`` documents of ``own(i)`` lines of their own and the lines of ``block``."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    return ["\n".join([" ".join(word() for _ in range(length)) for _ in range(own(i))] + block) for i in range(n)]


def dropped_of(spark, texts):
    """Per document the lines that are dropped."""
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = L.clean_lines(df, out_col="flags").collect()
    assert len(got) == len(texts)
    return {r.doc_id: [x for x, f in zip(r.text.split("\n"), r.flags or []) if f] for r in got}


def test_copies_do_not_save_a_footer(spark):
    footer = "Subscribe to the weekly letter"
    texts = unlike(30, [footer], lambda i: 4)
    got = dropped_of(spark, texts + [texts[0]] * 100 + unlike(1, [], lambda i: 6, seed=6) * 100)
    assert all(got[i] == [footer] for i in range(130))
    assert not any(got[i] for i in range(130, 230))


FOOTER = ["Subscribe to the weekly letter", "Follow the paper elsewhere too", "Terms of use apply here", "About the people behind this", "All rights are reserved by us"]


def test_footer_does_not_hide_itself(spark):
    texts = unlike(60, FOOTER, lambda i: 1 + i % 3)
    got = dropped_of(spark, texts)
    assert all(got[i] == FOOTER for i in range(60))


def test_near_copies_of_a_page_do_not_save_its_footer(spark):
    texts = unlike(30, FOOTER, lambda i: 1 + i % 3)
    page = unlike(1, [], lambda i: 12, seed=7)[0]
    near = [x + "\n" + page + "\n" + "\n".join(FOOTER) for x in unlike(100, [], lambda i: 1, seed=8)]
    got = dropped_of(spark, texts + near)
    assert all(got[i] == FOOTER for i in range(130))


def test_pages_of_fields_only(spark):
    status = [f"Host a{i % 40} is up since {i} days\nLoad of {i % 3} in the last minute" for i in range(60)]
    lone = [f"Request {i} was answered in time" for i in range(40)]
    once = [f"Copied line {i} of a page" for i in range(9)] * 20
    got = dropped_of(spark, status + lone + once)
    assert all(len(got[i]) == 2 for i in range(60)) and all(len(got[i]) == 1 for i in range(60, 100))
    assert not any(got[i] for i in range(100, 280))


def test_leading_tokens_become_fields(spark):
    names = [a + b for a in ("Al", "Be", "Ca", "Do", "El") for b in ("an", "bert", "dine", "fred", "gor", "hild", "ka", "lia", "mund", "na")] * 4
    kinds = [["{} commented on this story today", "By {} in the sports section today"], ["Seen with {} near the old harbour", "A note from {} about the town"]]
    blocks = [[x.format(name) for x in kinds[i % 2]] for i, name in enumerate(names)]
    texts = [page + "\n" + "\n".join(block) for page, block in zip(unlike(len(names), [], lambda i: 3), blocks)]
    got = dropped_of(spark, texts)
    assert all(got[i] == blocks[i] for i in range(len(names)))
    want = brute(list(enumerate(texts)))
    assert all([x for x, f in zip(t.split("\n"), want[t]) if f] == got[i] for i, t in enumerate(texts))


def test_company_rule_equals_brute_force(spark):
    texts = unlike(40, FOOTER, lambda i: i % 5, length=4) + unlike(30, FOOTER[:2], lambda i: 1, seed=9, length=2)
    texts += [x + "\n" + texts[3] for x in unlike(30, [], lambda i: 1, seed=11, length=3)] + [f"Load {i}\n{FOOTER[0]}" for i in range(20)]
    want = brute(list(enumerate(texts)))
    got = dropped_of(spark, texts)
    assert all([x for x, f in zip(t.split("\n"), want[t]) if f] == got[i] for i, t in enumerate(texts))
    assert any(got.values()) and not all(len(got[i]) == len(texts[i].split("\n")) for i in got)
