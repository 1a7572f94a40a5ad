"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

Emails, addresses, cards and phones come from regular expressions. They are the seeds: the
words around them are lexical patterns, and a bipartite graph links each pattern with the
identifier-like tokens seen in it. Patterns and tokens score each other in rounds: a pattern
is as reliable for a kind as the share of its tokens that are known to be of it; a token that
no base pattern covers belongs to a kind when reliable patterns together say so. Its spans
in such contexts are added. Everything is a join, a window or an aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinrank.llm.tables import texts
from kinrank.session import written

KINDS = ("email", "ip", "card", "phone")
# The base patterns, written so that no run of characters is scanned more than once: runs
# are possessive and begin where a run begins (or the last match ended).
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = (
    rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?+[0-9])++",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
# Tokens with a digit that may be identifiers.
_INSIDE = r"A-Za-z@._%+:/\-"
TOKEN = rf"(?<![{_INSIDE}0-9])[{_INSIDE}]*+[0-9][{_INSIDE}0-9]*+"
# Characters of context on each side of a token.
CONTEXT = 48
ROUNDS = 3
# Least distinct tokens of a kind in a pattern, and least scores of patterns and tokens.
SUPPORT, RELIABLE, CERTAIN = 3, 0.7, 0.7
# Scores stop here, so that one pattern alone never is beyond doubt.
HIGHEST = 0.95


def luhn(digits: Column) -> Column:
    """Whether a string of at most 20 digits passes the Luhn check."""
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for i in range(1, 21):
        digit = F.substring(padded, i, 1)
        if i % 2:
            # Digits in these places count twice, their digits added up.
            digit = F.translate(digit, "0123456789", "0246813579")
        total = total + digit.cast("int")
    return total % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    count = F.length(digits)
    part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)"
    return (
        F.when(kind == 1, match.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(kind == 2, F.when(count.between(12, 19), luhn(digits)).otherwise(False))
        .when(kind == 3, count.between(9, 15))
        .otherwise(True)
    )


def _cells(kind: int, text: Column, regex: str, wanted: Column) -> Column:
    """Matches with the lengths and the edges of what lies between them."""
    between = F.transform(
        F.split(text, regex, -1),
        lambda p: F.struct(
            F.length(p).alias("size"), F.right(p, F.lit(CONTEXT)).alias("tail"), F.left(p, F.lit(CONTEXT)).alias("front")
        ),
    )
    found = F.arrays_zip(between.alias("between"), F.regexp_extract_all(text, F.lit(regex), F.lit(0)).alias("match"))
    return F.when(wanted, F.struct(F.lit(kind).alias("kind"), found.alias("cells")))


def occurrences(keyed: DataFrame) -> DataFrame:
    """``key, kind, start, stop, match, before, after`` for base patterns (kinds 0 to 3, valid
    ones only) and identifier-like tokens (4); ``keyed`` has ``key, text``. Rows that repeat a
    key are one."""
    text = F.col("text")
    wanted = [text.contains("@"), *[text.rlike("[0-9]")] * 2, text.contains("+"), text.rlike("[0-9]")]
    kinds = [_cells(k, text, r, w) for k, (r, w) in enumerate(zip((*PATTERNS, TOKEN), wanted, strict=True))]
    rows = (
        keyed.filter(text.rlike("[0-9@]"))
        .select("key", F.explode(F.array_compact(F.array(*kinds))).alias("k"))
        .filter(F.size("k.cells") > 1)
        .select("key", F.col("k.kind").alias("kind"), F.posexplode("k.cells").alias("pos", "cell"))
        .select("key", "kind", "pos", "cell.between.size", "cell.between.tail", "cell.between.front", "cell.match")
        # Pieces of a repeated key would be added up; they are shorter than the texts.
        .distinct()
    )
    order = Window.partitionBy("key", "kind").orderBy("pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.coalesce(F.length("match"), F.lit(0))
    placed = rows.select(
        "key",
        "kind",
        "match",
        F.col("tail").alias("before"),
        F.lead("front").over(order).alias("after"),
        F.sum(F.col("size") + length).over(so_far).alias("stop"),
        length.alias("length"),
    ).filter("match IS NOT NULL")
    return placed.filter(_valid(F.col("kind"), F.col("match"))).select(
        "key", "kind", (F.col("stop") - F.col("length")).alias("start"), "stop", "match", "before", "after"
    )


def _apart(found: DataFrame) -> DataFrame:
    """Base spans, and those tokens that overlap none of them."""
    base = F.col("kind") < 4
    up = Window.partitionBy("key").orderBy("start", "kind")
    down = Window.partitionBy("key").orderBy(F.desc("stop"), "kind")
    marked = found.withColumn("reached", F.max(F.when(base, F.col("stop"))).over(up)).withColumn(
        "next", F.min(F.when(base, F.col("start"))).over(down)
    )
    overlaps = (F.coalesce(F.col("reached"), F.lit(0)) > F.col("start")) | (
        F.coalesce(F.col("next"), F.col("stop")) < F.col("stop")
    )
    # ``next`` sees only base spans that end at or behind the token's end; one that ends
    # inside the token began before it (then ``reached`` is beyond its start) or inside.
    inside = F.max(F.when(base, F.col("start"))).over(
        Window.partitionBy("key").orderBy("stop", F.desc("kind"))
    )
    marked = marked.withColumn("inside", inside)
    overlaps = overlaps | (F.coalesce(F.col("inside"), F.lit(-1)) >= F.col("start"))
    return marked.filter(base | ~overlaps).drop("reached", "next", "inside")


def _patterns() -> Column:
    """The lexical patterns of an occurrence: words before it, behind it, and both."""
    clean = lambda c: F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}=:#]+", " "))
    before, after = clean(F.col("before")), clean(F.coalesce(F.col("after"), F.lit("")))
    last = F.substring_index(before, " ", -2)
    first = F.substring_index(after, " ", 1)
    return F.array(
        F.concat(F.lit("l|"), last),
        F.concat(F.lit("r|"), F.substring_index(after, " ", 2)),
        F.concat(F.lit("b|"), F.substring_index(before, " ", -1), F.lit("|"), first),
    )


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Reliable patterns ``pattern, kind, score`` and new tokens ``token, kind, score``.

    ``edges`` are distinct ``pattern, token, seed``: the kind of a seed token, else null. A
    pattern's score for a kind is the sum of its tokens' scores over the number of its
    tokens plus one; a token's is one less the product of its patterns' doubts.
    """
    totals = written(edges.groupBy("pattern").agg(F.count("*").alias("n")))
    seeds = edges.filter("seed IS NOT NULL").select("token", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    known, before, added = seeds, -1, None
    for _ in range(rounds):
        support = (
            edges.join(known, "token")
            .groupBy("pattern", "kind")
            .agg(F.sum("score").alias("mass"), F.count("*").alias("support"))
        )
        patterns = written(
            support.join(totals, "pattern")
            .select("pattern", "kind", "support", F.least(F.lit(HIGHEST), F.col("mass") / (F.col("n") + 1)).alias("score"))
            .filter((F.col("support") >= SUPPORT) & (F.col("score") >= RELIABLE))
            .drop("support")
        )
        claims = (
            edges.filter("seed IS NULL")
            .join(patterns, "pattern")
            .groupBy("token", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("score"))))).alias("score"))
        )
        best = claims.groupBy("token").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b"))
        added = written(
            best.select("token", (-F.col("b.k")).alias("kind"), F.least(F.lit(HIGHEST), F.col("b.score")).alias("score"))
            .filter(F.col("score") >= CERTAIN)
        )
        count = added.count()
        if count == before or count == 0:
            break
        before, known = count, seeds.unionByName(added)
    return patterns, added


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind,
    joined by commas; counts and ``base_sha256`` are of the base patterns' spans alone,
    ``spans`` also has those that contexts add. A null or empty text has none and '' as
    spans. Rows that repeat an id are searched each for itself. Other columns are ignored;
    no rows give no rows.
    """
    keyed = texts(docs).withColumn(
        "key", F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"))
    )
    found = written(_apart(occurrences(keyed.select("key", "text"))))
    # A context without words is no pattern.
    words = F.filter(_patterns(), lambda p: p.rlike(r"^[lr]\|.*\p{L}|^b\|.*\p{L}.*\|.*\p{L}"))
    seen = found.withColumn("pattern", F.explode(words)).withColumn("token", F.lower("match"))
    edges = written(
        seen.select("pattern", "token", F.when(F.col("kind") < 4, F.col("kind")).alias("seed")).distinct()
    )
    patterns, tokens = bootstrap(edges, rounds)
    more = (
        seen.filter("kind = 4")
        .drop("kind")
        .join(tokens.select("token", "kind"), "token")
        .join(patterns.select("pattern", "kind"), ["pattern", "kind"], "left_semi")
        .select("key", "kind", "start", "stop", F.lit(False).alias("base"))
    )
    spans = found.filter("kind < 4").select("key", "kind", "start", "stop", F.lit(True).alias("base")).unionByName(more)
    lists = spans.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "stop", "base"))).alias("all"))
    names = F.array(*[F.lit(k) for k in KINDS])
    written_out = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))),
        ",",
    )
    every = F.coalesce("all", F.array().cast("array<struct<start:bigint,kind:int,stop:bigint,base:boolean>>"))
    base = F.filter("every", lambda s: s["base"])
    of_kind = lambda kind: F.filter("every", lambda s: s["base"] & (s["kind"] == kind))
    counts = [F.size(of_kind(k)).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return (
        keyed.select("doc_id", "key")
        .join(lists, "key", "left")
        .select("doc_id", every.alias("every"))
        .select("doc_id", *counts, F.sha2(written_out(base), 256).alias("base_sha256"), written_out(F.col("every")).alias("spans"))
    )
