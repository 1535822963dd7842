"""Rates of documents so that the mix meets target weights of domains that a document belongs to only in part.

A classifier learned from a labelled table gives each document its posterior over the domains. The rates r >= 0 minimise

    1/2 sum_k (sum_d n_d p_dk r_d - b_k)^2 / (T_k N)  +  ridge/2 sum_d (n_d / N) (r_d - 1)^2

with n_d tokens of document d, T_k expected tokens of domain k, N all tokens and b_k the target. Each step of the projected
gradient is one aggregation of as many sums as there are domains; a document's rate after any number of steps follows from
these sums alone, so no rates are stored between steps.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute in the workers
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.llm.common import in_pieces, rows_with_keys
from quillset.llm.features import ROWS, word_features
from quillset.session import broadcast_if_small, materialise

#: Labelled texts of each domain, about, that the classifier is fitted on; they are drawn by a hash of the id.
PER_DOMAIN = 1500
RIDGE, STEPS, TOLERANCE = 0.001, 40, 0.005
#: Share of the largest possible mix that a mix without repeats takes; the rest leaves room for texts between domains.
ONCE = 0.97


def label_domain() -> Column:
    """Domains of the table ``labels``: toxic, and of the rest good or poor."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")


#: Shares of the mix, which is as large as the corpus. Nothing of a domain without a share is wanted.
TARGET = {"good": 0.88, "poor": 0.11, "toxic": 0.01}


def posteriors(docs: DataFrame, labelled: DataFrame, key: str, text: str, per_domain: int = PER_DOMAIN) -> tuple[DataFrame, list[str]]:
    """Per document: id, n_tokens (words) and p, its probability of each domain; and the names of the domains.

    ``labelled`` has ``key`` and ``domain``; null domains and ids that ``docs`` lacks are ignored. Texts without words get
    the classifier's intercept. Without any label there is one domain that all belong to.
    """
    labelled = labelled.filter(F.col("domain").isNotNull()).select(F.col(key).alias("_id"), "domain")
    counts = {r[0]: r[1] for r in labelled.groupBy("domain").count().collect()}  # as many rows as domains
    domains = sorted(counts)
    weights, intercepts = np.zeros((1, 1)), np.zeros(1)
    if len(domains) > 1:
        share = F.create_map(*[F.lit(x) for d in domains for x in (d, min(1.0, per_domain / counts[d]))])
        drawn = labelled.filter(F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit(23)), F.lit(1 << 30)) < share[F.col("domain")] * (1 << 30))
        # about len(domains) * per_domain rows, counted before they are shipped
        sample = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(broadcast_if_small(drawn), "_id").select("domain", "text")

        def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in in_pieces(batches, "text", 1 << 20, ROWS):
                rows, _ = word_features(batch.column("text"))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("domain"), flat], names=["domain", "features"])

        rows = materialise(sample.mapInArrow(featured, "domain string, features array<float>"), "domain-sample")
        seen = {r[0]: r[1] for r in rows.groupBy("domain").count().collect()}
        domains = sorted(seen) or domains[:1]
        if len(domains) > 1:
            index = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")) - 1
            rows = rows.select(array_to_vector("features").alias("x"), index.cast("double").alias("y"))
            fitted = LogisticRegression(featuresCol="x", labelCol="y", family="multinomial", maxIter=60, regParam=0.01).fit(rows)
            # the sample has as many texts of a rare domain as of a common one; the labelled table says how common it is
            common = np.log([counts[d] / seen[d] for d in domains])
            weights, intercepts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray() + common
    known = len(domains) > 1
    domains = domains or ["all"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text", rows=ROWS):
            rows, words = word_features(batch.column("text"))
            p = np.ones((len(rows), 1))
            if known:
                p = rows @ weights.T + intercepts
                p = np.exp(p - p.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel().astype(np.float64)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words.astype(np.int64)), flat], names=["id", "n_tokens", "p"])

    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return materialise(rows.mapInArrow(run, f"id {kind}, n_tokens long, p array<double>"), "posteriors"), domains


def fitted_rates(known: DataFrame, domains: list[str], target: dict[str, float], once: bool = False) -> DataFrame:
    """``known`` (n_tokens, p) with the column rate.

    The mix is as large as the corpus; with ``once`` no rate is above 1, and the mix is nearly the largest one that the
    scarcest domain allows. Targets that the posteriors cannot meet to TOLERANCE give a warning. A target without a domain in the data is left out; if no wanted domain is there, all
    rates are 1.
    """
    size = len(domains)
    totals = known.agg(*[F.sum(F.col("n_tokens") * F.col("p")[k]) for k in range(size)]).first()
    have = np.array([float(t or 0) for t in totals])
    want = np.array([float(target.get(d, 0)) for d in domains])
    want = np.where(have > 0, want, 0)
    if not want.sum():
        return known.withColumn("rate", F.lit(1.0))
    size_of_mix = ONCE * (have / np.where(want > 0, want / want.sum(), np.inf))[want > 0].min() if once else have.sum()
    wanted = want / want.sum() * size_of_mix
    rate, step = F.lit(1.0), 1 / (1 + RIDGE)
    got, before = have, have * 2
    for step_number in range(STEPS + 1):
        slope = np.divide(got - wanted, have, out=np.zeros(size), where=have > 0)
        if np.abs(got - wanted).max() <= TOLERANCE * have.sum():
            break
        if step_number == STEPS or np.abs(got - before).max() < 0.02 * TOLERANCE * have.sum():
            warnings.warn(f"after {step_number} steps the mix has {dict(zip(domains, got / have.sum()))} of the corpus, wanted {dict(zip(domains, wanted / have.sum()))}", stacklevel=2)
            break
        pull = sum((F.col("p")[k] * float(slope[k] * step) for k in range(size)), F.lit(RIDGE * -step))
        rate = F.greatest(F.lit(0.0), rate * (1 - RIDGE * step) - pull)
        rate = F.least(F.lit(1.0), rate) if once else rate
        sums = known.withColumn("rate", rate).agg(*[F.sum(F.col("n_tokens") * F.col("p")[k] * F.col("rate")) for k in range(size)]).first()
        got, before = np.array([float(s or 0) for s in sums]), got
    return known.withColumn("rate", rate)


def mixed(docs: DataFrame, labelled: DataFrame, target: dict[str, float] | None = None, key: str = "doc_id", text: str = "text", once: bool = False) -> DataFrame:
    """Per document: key, n_tokens, its likeliest domain and that domain's probability, rate.

    ``labelled`` has ``key`` and ``domain``. Null and empty texts have no tokens; their rate is that of their posterior.
    Repeated rows get equal rates. Other columns are not read.
    """
    known, domains = posteriors(docs, labelled, key, text)
    rows = fitted_rates(known, domains, TARGET if target is None else target, once)
    best = F.array_position("p", F.array_max("p")).cast("int")
    names = F.array(*[F.lit(d) for d in domains])
    return rows.select(F.col("id").alias(key), "n_tokens", F.element_at(names, best).alias("domain"), F.array_max("p").alias("probability"), "rate")


def keep_mixed(docs: DataFrame, labelled: DataFrame, target: dict[str, float] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of a mix that has no document twice: rates are fitted below 1 and are the chance
    to stay, drawn by a hash of the key, so that the kept rows have the targets' proportions. Keys are unique."""
    rates = mixed(docs, labelled, target, key, text, once=True)
    drawn = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(29)), F.lit(1 << 30)) < F.col("rate") * (1 << 30)
    return rows_with_keys(docs, rates.filter(drawn), key)
