"""Line dedup by a log-template tree (operator 6); DataFrame functions only.

Each line of a text is parsed to places in a tree of fixed depth: its token
count, then its first ``DEPTH`` tokens, tokens with a digit standing as
``<*>``. So that a leading token can be a variable field too (``<name>
commented on this story``), each of these levels has a ``<*>`` child that every
line passes as well; the path then takes one more token, so that a leaf always
fixes ``DEPTH`` of them. A leaf that holds at least ``CHILDREN`` different lines
is generalised: a position with that many different tokens is a variable field.
If at least ``CONSTANT`` of the leaf's positions stay, its lines share the
template of the remaining tokens (of several such leaves, a line takes that of
the most different lines; ties: the first by text); otherwise (prose that only
starts alike) and in all other leaves a line's template is the line itself,
digits masked. At most one of the leading tokens is a word field.

A template is *recurring* if it is found in at least ``MIN_DOCS`` different
companies. Equal texts are one company. A line (digits unmasked) is a text's own
if fewer than ``MIN_DOCS`` texts hold it. The company of a text is

* if every line has a masked or variable field (log and status pages): its hash;
* if at least ``OWN`` of its tokens stand in own lines: their smallest hash;
* else it is a near copy or has nothing to tell it from one: the least common of
  its shared lines, so that near copies of one document are one company.

Boilerplate stands in unlike documents, and neither its other lines nor copies
of some of those documents change that; the lines of one much-copied document
stay for near-duplicate removal. Lines of recurring templates are dropped in
every document.

All counts cover every line of every document. Hot templates are counted from
grouped partial sums; nothing gathers the lines of a template. The only arrays
built are those of one document's lines.

Defined cases: null texts have no lines and stay null; lines without a token
never recur and are never dropped; rows of equal text are cleaned alike; an
empty table gives no rows; extra columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import join_small
from .components import written
from .texts import free_name

DEPTH = 3
CHILDREN = 8
CONSTANT = 0.6
MIN_TOKENS = 4
MIN_DOCS = 10
OWN = 0.25


def _even(line: Column) -> Column:
    """A line trimmed, blanks squeezed (the costly pattern runs only where needed)."""
    odd = line.contains("\t") | line.contains("\r") | line.contains("  ") | line.contains("\x0b") | line.contains("\f")
    return F.trim(F.when(odd, F.regexp_replace(line, r"[ \t\x0B\f\r]++", " ")).otherwise(line))


def _masked(even: Column) -> Column:
    """An even line with its tokens with a digit as ``<*>``."""
    return F.when(even.rlike("[0-9]"), F.regexp_replace(even, r"(?<!\S)[^\s0-9]*+[0-9]\S*+", "<*>")).otherwise(even)


def even_lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), _even)


def masked_lines(text: Column) -> Column:
    """The normalised lines of a text."""
    return F.transform(even_lines(text), _masked)


def _place(line: Column, depth: int) -> Column:
    """Token count, leaves and hash of a normalised line (null hash: no token; null leaves: too few)."""
    n = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1
    blank = line == ""
    lead = F.array(F.split(F.substring_index(line, " ", depth + 1), " "))  # an array of one: split once for all leaves

    def paths(tokens):  # a leading token left out, or the one after them
        return F.array(*[F.xxhash64(n, F.lit(i), *[F.get(tokens, F.lit(j)) for j in range(depth + 1) if j != i]) for i in range(depth + 1)])

    return F.struct(
        F.when(blank, 0).otherwise(n).alias("n"),
        F.when(n >= max(MIN_TOKENS, depth + 1), F.get(F.transform(lead, paths), F.lit(0))).alias("leaves"),
        F.when(~blank, F.xxhash64(line)).alias("key"),
    )


def _hashes(text: Column) -> tuple[Column, Column]:
    """Two hashes that stand for a text."""
    return F.xxhash64(F.lit(1), text).alias("g"), F.xxhash64(text).alias("h")


def line_table(docs: DataFrame, text_col: str, depth: int = DEPTH) -> DataFrame:
    """One row per line of each different text: text ``(g, h)``, line ``no``,
    hash of the line unmasked ``raw``, token count ``n``, ``leaves`` and masked line ``key``."""
    there = docs.where(F.col(text_col).isNotNull())
    both = F.transform(even_lines(F.col(text_col)), lambda x: F.struct(x.alias("even"), _masked(x).alias("line")))
    placed = F.transform(both, lambda x: F.struct(F.when(x["even"] != "", F.xxhash64(x["even"])).alias("raw"), _place(x["line"], depth).alias("place")))
    texts = there.select(*_hashes(F.col(text_col)), placed.alias("p")).dropDuplicates(["g", "h"])
    return texts.select("g", "h", F.posexplode("p").alias("no", "x")).select("g", "h", "no", "x.raw", "x.place.*")


def generalised(docs: DataFrame, lines: DataFrame, text_col: str, depth: int, children: int, constant: float) -> DataFrame:
    """``(key, template)`` of the masked lines whose leaf has variable fields."""
    places = lines.where("leaves IS NOT NULL").select("key", F.explode("leaves").alias("leaf"))
    crowded = places.distinct().groupBy("leaf").count().where(F.col("count") >= children).select("leaf")
    crowded = written(crowded, "crowded")
    every = docs.select(F.explode(masked_lines(F.col(text_col))).alias("line"))
    placed = every.select("line", F.inline(F.array(_place(F.col("line"), depth)))).where("leaves IS NOT NULL")
    placed = placed.select("line", "n", "key", F.explode("leaves").alias("leaf"))
    members = join_small(placed, crowded, "leaf", "left_semi")
    members = written(members.groupBy("leaf", "key", "n").agg(F.min("line").alias("line")), "leaf_lines")
    tokens = members.select("leaf", "n", F.posexplode(F.split("line", " ")).alias("at", "token"))
    varying = tokens.select("leaf", "n", "at", F.xxhash64("token").alias("t")).distinct().groupBy("leaf", "n", "at").count().where(F.col("count") >= children)
    shapes = varying.groupBy("leaf", "n").agg(F.collect_list("at").alias("fields")).where(F.col("n") - F.size("fields") >= constant * F.col("n"))
    shapes = shapes.join(members.groupBy("leaf").agg(F.count("*").alias("size")), "leaf")
    fields = F.transform(F.split("line", " "), lambda t, i: F.when(F.array_contains("fields", i), F.lit("<*>")).otherwise(t))
    found = members.join(shapes, ["leaf", "n"]).select("key", (-F.col("size")).alias("less"), F.array_join(fields, " ").alias("shape"))
    best = found.groupBy("key").agg(F.min(F.struct("less", "shape"))["shape"].alias("shape"))
    return best.select("key", F.xxhash64(F.lit("template"), "shape").alias("template"))


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """``(raw, texts)`` of the lines that at least ``min_docs`` texts hold."""
    once = lines.where("raw IS NOT NULL").select("raw", "g", "h").distinct()
    return once.groupBy("raw").agg(F.count("*").alias("texts")).where(F.col("texts") >= min_docs)


def companies(lines: DataFrame, shared: DataFrame, own: float) -> DataFrame:
    """The ``company`` of each text ``(g, h)`` that has a token."""
    met = join_small(lines.where("raw IS NOT NULL"), shared, "raw", "left")
    mine = F.col("texts").isNull()
    rank = F.col("texts").cast("decimal(12,0)") * F.lit(str(2**64)).cast("decimal(20,0)") + F.col("raw")  # order of (texts, raw)
    texts = met.groupBy("g", "h").agg(
        F.bool_and(F.col("raw") != F.col("template")).alias("fields"), F.sum("n").alias("n"),
        F.sum(F.when(mine, F.col("n")).otherwise(0)).alias("own_n"), F.min(F.when(mine, F.col("raw"))).alias("own"), F.min(rank).alias("least"),
    )
    company = F.when(F.col("fields"), F.col("h")).when(F.col("own_n") >= own * F.col("n"), F.col("own")).otherwise(F.xxhash64("least"))
    return texts.select("g", "h", company.alias("company"))


def recurring(lines: DataFrame, bodies: DataFrame, min_docs: int) -> DataFrame:
    """The templates found in at least ``min_docs`` companies, with their count."""
    once = lines.where("template IS NOT NULL").select("template", "g", "h").join(bodies, ["g", "h"])
    return once.select("template", "company").distinct().groupBy("template").agg(F.count("*").alias("companies")).where(F.col("companies") >= min_docs)


def dropped_lines(
    docs: DataFrame, text_col: str = "text", depth: int = DEPTH, children: int = CHILDREN,
    constant: float = CONSTANT, min_docs: int = MIN_DOCS, own: float = OWN,
) -> DataFrame:
    """``(g, h, drop)`` of the texts that hold recurring lines: ``drop`` has a boolean per line."""
    lines = written(line_table(docs, text_col, depth), "lines")
    fields = generalised(docs, lines, text_col, depth, children, constant)
    lines = lines.join(fields, "key", "left").withColumn("template", F.coalesce("template", "key"))
    lines = written(lines.select("g", "h", "no", "n", "raw", "template"), "templates")
    shared = written(shared_lines(lines, min_docs), "shared")
    bodies = companies(lines, shared, own)
    often = written(recurring(lines, bodies, min_docs).select("template", F.lit(True).alias("often")), "recurring")
    marked = lines.join(often, "template", "left").select("g", "h", F.struct("no", F.coalesce("often", F.lit(False)).alias("often")).alias("x"))
    flags = marked.groupBy("g", "h").agg(F.array_sort(F.collect_set("x")).alias("x"), F.max("x.often").alias("any")).where("any")
    return flags.select("g", "h", F.col("x")["often"].alias("drop"))


def clean_lines(docs: DataFrame, text_col: str = "text", out_col: str = "line_flags", **more) -> DataFrame:
    """``docs`` with ``out_col``: per line whether it is dropped (null: none)."""
    drops = written(dropped_lines(docs, text_col, **more), "drops")
    one, two = free_name(docs, "line_id"), free_name(docs, "line_hash")
    drops = drops.select(F.col("g").alias(one), F.col("h").alias(two), F.col("drop").alias(out_col))
    g, h = _hashes(docs[text_col])
    return join_small(docs, drops, (g == F.col(one)) & (h == F.col(two)), "left").select(*[docs[c] for c in docs.columns], out_col)


def kept_text(text: Column, flags: Column) -> Column:
    pairs = F.zip_with(F.split(text, "\n", -1), flags, lambda line, drop: F.struct(line.alias("line"), drop.alias("drop")))
    return F.when(flags.isNull(), text).otherwise(F.array_join(F.filter(pairs, lambda x: ~x["drop"])["line"], "\n"))


def drop_recurring(docs: DataFrame, text_col: str = "text", **more) -> DataFrame:
    """``docs`` without the lines of recurring templates; a document of which
    nothing but blanks is left goes. Same columns."""
    name = free_name(docs, "line_flags")
    found = clean_lines(docs, text_col, name, **more)
    cleaned = found.withColumn(text_col, kept_text(F.col(text_col), F.col(name)))
    return cleaned.where(F.col(name).isNull() | F.col(text_col).rlike(r"[^ \t\n\x0B\f\r]")).select(docs.columns)


def line_digest(docs: DataFrame) -> DataFrame:
    """Per document: lines, dropped lines, digest of the text that stays."""
    found = clean_lines(docs.select("doc_id", "text"))
    text, flags = F.col("text"), F.col("line_flags")
    return found.select(
        "doc_id", F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n", -1))).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(F.filter(flags, lambda x: x)), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.sha2(F.coalesce(kept_text(text, flags), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
