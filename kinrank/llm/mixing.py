"""Mixing to target weights with soft membership.

A naive Bayes classifier over hashed words, fitted on rows whose domain is known, gives each
document a posterior over the domains. Document rates are then fitted so that the expected
tokens of each domain, ``sum(rate * tokens * posterior)``, meet the targets: least squares
weighted by the domains' sizes, by projected gradient steps that keep rates above a floor.

With the metric ``tokens`` a step changes a rate by an amount that depends on the posterior
alone, so the driver needs one sum per domain a step, and a rate is computed where it is
needed from the few vectors of the steps; no table of rates is rewritten.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, StringIndexer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinrank.llm.tables import whole_text
from kinrank.session import written

# Rows with a known domain that the classifier is fitted on, by the order of a hash.
LABELLED = 20_000
FEATURES = 1 << 12
# A text's evidence counts as that of so many words at most; more would make every
# posterior 0 or 1.
EVIDENCE = 12.0
STEPS = 60
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Mixture:
    """The classifier, its domains in the order of the posterior, and the gradient steps."""

    classifier: PipelineModel
    domains: tuple[str, ...]
    steps: tuple[tuple[float, ...], ...]
    floor: float
    # Domain -> tokens before, target, and expected tokens after the fit.
    totals: dict[str, tuple[float, float, float]]


def _packed(docs: DataFrame) -> DataFrame:
    """All columns in one struct, so that none clashes, beside the text."""
    return docs.select(F.struct("*").alias("row"), whole_text().alias("text"))


def _prepared(packed: DataFrame) -> DataFrame:
    tokens = Tokenizer(inputCol="text", outputCol="words").transform(packed)
    counted = tokens.withColumn("tokens", F.size(F.filter("words", lambda w: w != "")).cast("double"))
    return HashingTF(inputCol="words", outputCol="features", numFeatures=FEATURES).transform(counted)


def classifier(docs: DataFrame, domain: str, labelled: int = LABELLED) -> PipelineModel:
    """Fit on at most ``labelled`` rows with a known domain (null: unknown)."""
    known = docs.filter(F.col(domain).isNotNull()).select("doc_id", domain)
    order = F.xxhash64("doc_id")
    chosen = known.select("doc_id").orderBy(order, "doc_id").limit(labelled).distinct()
    rows = docs.filter(F.col(domain).isNotNull()).join(F.broadcast(chosen), "doc_id", "left_semi")
    sample = _prepared(_packed(rows)).withColumn("domain", F.col(f"row.{domain}").cast("string"))
    index = StringIndexer(inputCol="domain", outputCol="label", stringOrderType="alphabetAsc").fit(sample)
    bayes = NaiveBayes(featuresCol="features", labelCol="label").fit(index.transform(sample))
    return PipelineModel([index, bayes])


def _settled(frame: DataFrame, **columns: Column) -> DataFrame:
    """``frame`` with further columns, computed once for each row.

    What is built on a plain column may be merged with its expression, which would then be
    evaluated anew at every use; behind a generator there are only values.
    """
    struct = F.struct(*[column.alias(name) for name, column in columns.items()])
    return frame.select(*frame.columns, F.inline(F.array(struct)))


def _posteriors(docs: DataFrame, model: PipelineModel) -> DataFrame:
    """``row, tokens, p``: softmax of the log likelihoods, tempered by the length."""
    guessed = model.stages[1].transform(_prepared(_packed(docs)))
    known = _settled(guessed.select("row", "tokens", "rawPrediction"), log=vector_to_array("rawPrediction"))
    cool = F.greatest(F.lit(1.0), F.col("tokens") / EVIDENCE)
    known = _settled(known.select("row", "tokens", "log"), most=F.array_max("log"), cool=cool)
    known = _settled(known, w=F.transform("log", lambda x: F.exp((x - F.col("most")) / F.col("cool"))))
    known = _settled(known, whole=F.aggregate("w", F.lit(0.0), lambda a, y: a + y))
    known = _settled(known, p=F.transform("w", lambda x: x / F.col("whole")))
    return known.select("row", "tokens", "p")


def _rate(steps, floor: float) -> Column:
    """The rate after the steps, each a vector over the domains."""
    if not steps:
        return F.lit(max(1.0, floor))
    table = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])
    dot = lambda step: F.aggregate(
        F.zip_with("p", step, lambda p, x: p * x), F.lit(0.0), lambda a, x: a + x
    )
    return F.aggregate(
        table, F.lit(max(1.0, floor)), lambda rate, step: F.greatest(F.lit(float(floor)), rate - dot(step))
    )


def fit_mixture(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    domain: str = "lang",
    floor: float = 0.0,
    labelled: int = LABELLED,
) -> Mixture | None:
    """Fit classifier and rates to ``weights`` (None: all domains alike).

    Weights of domains that never occur, and missing weights, count as 0. The targets add up
    to the tokens there are; with a ``floor`` of 1 or more they are scaled up so far that no
    domain is asked for less than ``floor`` times what it has. Without any row whose domain
    is known there is nothing to mix: the result is None.
    """
    if docs.filter(F.col(domain).isNotNull() & F.col("doc_id").isNotNull()).isEmpty():
        return None
    model = classifier(docs, domain, labelled)
    domains = tuple(model.stages[0].labels)
    table = written(_posteriors(docs, model).select("tokens", "p"))
    width = range(len(domains))
    rate = F.col("rate")
    totals = lambda steps: list(
        _settled(table, rate=_rate(steps, floor))
        .agg(*[F.coalesce(F.sum(rate * F.col("tokens") * F.col("p")[i]), F.lit(0.0)) for i in width])
        .first()
    )
    plain = [F.coalesce(F.sum(F.col("tokens") * F.col("p")[i]), F.lit(0.0)) for i in width]
    have = list(table.agg(*plain).first())
    wanted = [max(0.0, (weights or dict.fromkeys(domains, 1.0)).get(d, 0.0)) for d in domains]
    if sum(wanted) <= 0 or sum(have) <= 0:
        return Mixture(model, domains, (), floor, {d: (h, h, h) for d, h in zip(domains, have, strict=True)})
    share = [w / sum(wanted) for w in wanted]
    total = sum(have)
    if floor > 0:
        total = max([total * floor, *(floor * h / s for h, s in zip(have, share, strict=True) if s > 0)])
    targets = [s * total for s in share]
    steps: list[tuple[float, ...]] = []
    now, least = totals(steps), float("inf")
    for _ in range(STEPS):
        gap = [n - t for n, t in zip(now, targets, strict=True)]
        largest = max(map(abs, gap))
        # Met, or as near as the floor lets it come.
        if largest <= TOLERANCE * total or least - largest <= TOLERANCE / 10 * total:
            break
        least = largest
        steps.append(tuple(g / h if h > 0 else 0.0 for g, h in zip(gap, have, strict=True)))
        now = totals(steps)
    report = {d: x for d, *x in zip(domains, have, targets, now, strict=True)}
    return Mixture(model, domains, tuple(steps), floor, {d: tuple(x) for d, x in report.items()})


def _copies() -> Column:
    """Whole copies whose expectation is the rate; the part below one is decided by the id."""
    even = F.pmod(F.xxhash64(F.col("row.doc_id"), F.lit(7)), F.lit(1_000_000)) / 1_000_000
    return (F.floor("rate") + (even < F.col("rate") - F.floor("rate")).cast("int")).cast("int")


def rates(docs: DataFrame, mixture: Mixture | None) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, domain, posterior, rate, copies``.

    ``domain`` is the likeliest one and ``posterior`` its probability. A null or blank text
    has no tokens and the prior as posterior. Without a mixture every rate is 1 and domain
    and posterior are null. Rows that repeat an id get a rate each.
    """
    if mixture is None:
        return docs.select(
            "doc_id",
            F.size(F.filter(F.split(F.lower(whole_text()), r"\s"), lambda w: w != "")).cast("bigint").alias("n_tokens"),
            F.lit(None).cast("string").alias("domain"),
            F.lit(None).cast("double").alias("posterior"),
            F.lit(1.0).alias("rate"),
            F.lit(1).alias("copies"),
        )
    found = _settled(_posteriors(docs, mixture.classifier), rate=_rate(mixture.steps, mixture.floor))
    best = F.array_max("p")
    names = F.array(*[F.lit(d) for d in mixture.domains])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("tokens").cast("bigint").alias("n_tokens"),
        F.element_at(names, F.array_position("p", best).cast("int")).alias("domain"),
        best.alias("posterior"),
        "rate",
        _copies().alias("copies"),
    )


def mixed(docs: DataFrame, mixture: Mixture | None) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as its copies say."""
    if mixture is None:
        return docs
    found = _settled(_posteriors(docs, mixture.classifier), rate=_rate(mixture.steps, mixture.floor))
    repeated = _settled(found, copies=_copies()).filter("copies > 0")
    return repeated.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
