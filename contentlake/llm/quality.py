"""Quality classifier: document evidence with hierarchical empirical-Bayes site priors.

Two heads, ``low`` (poor text) and ``toxic``, give every document a
log-likelihood ratio from its whole text. It is fitted on a bounded sample of
``SAMPLE`` labelled rows, the ones with the least id hashes: words and word
beginnings that toxic documents share make a lexicon, and a ridge logistic
regression is fitted on counts and shares of characters and words, where each
half of the sample is looked up in the other half's lexicon.

A document's prior comes from where it lies. Expected positives are summed by
host and by path over all documents; a host's rate is shrunk to the global one,
a path's rate to its host's, by strengths taken from the spread of the rates
themselves (method of moments), so that a sparse site says little. The posterior
odds are prior odds times likelihood ratio.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from contentlake.llm.common import stage

SAMPLE = 8_000
HEADS = ("low", "toxic")
#: A sign of toxicity: in this share of the toxic sample (and 3 documents), and
#: so many times as likely there as elsewhere.
LEAST_SHARE, LEAST_DOCS, LEAST_RATIO = 0.008, 3, 20.0
PREFIXES = (4, 5)
REJECT_ABOVE = 0.5
_WORD = re.compile(r"[^\W\d_]+")
_KIND = np.zeros(256, np.uint8)  # of a byte: 1 A-Z, 2 a-z and beyond ASCII, 3 white space, 4 digit, 5 stop, 6 other sign
_KIND[0x41:0x5B], _KIND[0x61:0x7B], _KIND[0x80:] = 1, 2, 2
_KIND[[0x20, 9, 10, 11, 12, 13]], _KIND[0x30:0x3A] = 3, 4
_KIND[[ord(c) for c in ".,;:'\"()-?"]] = 5
_KIND[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 6
FEATURES = ("signs", "upper", "digits", "distinct", "repeats", "length", "hits1", "hits2", "hits")


def forms(word: str) -> list[str]:
    """A word and its beginnings (marked with a hyphen)."""
    return [word, *(word[:n] + "-" for n in PREFIXES if len(word) > n)]


def describe(text: str | None, known: dict[str, bool], lexicon: frozenset) -> list[float]:
    """The numbers of ``FEATURES``; ``known`` caches which words are signs."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.bincount(_KIND[data], minlength=7)
    found = _WORD.findall(text.lower())
    letters = max(1, kinds[1] + kinds[2])
    hits = 0
    if lexicon:
        for w, flag in zip(found, map(known.get, found)):
            if flag is None:
                flag = known[w] = any(f in lexicon for f in forms(w))
            hits += flag
        if len(known) > 500_000:
            known.clear()
    n = max(1, len(found))
    again = sum(a == b for a, b in zip(found, found[1:]))
    return [kinds[6] / max(1, len(data) - kinds[3]), kinds[1] / letters, kinds[4] / max(1, len(data)),
            len(set(found)) / n ** 0.75, again / n, np.log1p(n), float(hits >= 1), float(hits >= 2), np.log1p(hits)]


class Logistic:
    """Ridge logistic regression on standardised numbers (Newton steps)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> None:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = np.hstack([np.ones((len(x), 1)), (x - self.mean) / self.scale])
        # rare positives weigh as much as negatives: the prior is the sites' part
        weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
        penalty = np.full(z.shape[1], ridge)
        penalty[0] = 1e-6
        self.beta = np.zeros(z.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))
            grad = z.T @ (weight * (y - p)) - penalty * self.beta
            hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hess, grad)
            self.beta += np.clip(step, -4, 4)
            if np.abs(step).max() < 1e-6:
                break

    def weights(self) -> tuple[list[float], float]:
        """(weights, constant) on plain numbers."""
        w = self.beta[1:] / self.scale
        return w.tolist(), float(self.beta[0] - w @ self.mean)


def sample_labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, low, toxic, fold) of ``SAMPLE`` labelled documents; copies of a text count once."""
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
             .groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("id"), "id").limit(SAMPLE))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    picked = rows.join(F.broadcast(marks), "id")  # SAMPLE narrow rows
    return stage(picked.dropDuplicates(["text"]).select(
        "id", "text", (F.col("quality") == 0).cast("int").alias("low"), F.col("toxic").cast("int").alias("toxic"),
        F.pmod(F.xxhash64("id", F.lit(5)), F.lit(2)).cast("int").alias("fold")), "labelled")


def toxic_signs(sample: DataFrame) -> frozenset:
    """Words and beginnings that mark the toxic documents of a sample."""
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        return frozenset()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, toxic in zip(batch["text"], batch["toxic"]):
                seen[int(toxic)].update({f for w in set(_WORD.findall((text or "").lower())) for f in forms(w)})
            yield pd.DataFrame({"form": list(seen[0] | seen[1])}).assign(
                pos=lambda d: d["form"].map(seen[1]).fillna(0).astype(int), neg=lambda d: d["form"].map(seen[0]).fillna(0).astype(int))

    ratio = ((F.col("pos") + 0.5) / (pos + 1)) / ((F.col("neg") + 0.5) / (neg + 1))
    found = (sample.select("text", "toxic").mapInPandas(count, "form string, pos bigint, neg bigint")
             .groupBy("form").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
             .where((F.col("pos") >= max(LEAST_DOCS, LEAST_SHARE * pos)) & (ratio >= LEAST_RATIO)).select("form").collect())
    return frozenset(r["form"] for r in found)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The classifier: ``lexicon`` and per head (weights, constant); a head
    without positive or negative examples is None and rejects nothing."""
    sample = sample_labelled(docs, labels, id_col, text_col)
    other = {fold: toxic_signs(sample.where(F.col("fold") != fold)) for fold in (0, 1)}
    names = ", ".join(f"{f} double" for f in FEATURES)

    def numbers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, dict[str, bool]] = {0: {}, 1: {}}
        for batch in batches:
            out = pd.DataFrame([describe(t, known[f], other[f]) for t, f in zip(batch["text"], batch["fold"])], columns=list(FEATURES))
            yield out.assign(low=batch["low"].to_numpy(), toxic=batch["toxic"].to_numpy())

    rows = (sample.select("text", "low", "toxic", "fold").mapInPandas(numbers, f"{names}, low int, toxic int")
            .toPandas().sort_values([*FEATURES, *HEADS]))  # SAMPLE rows at most
    x, model = rows[list(FEATURES)].to_numpy(), {"lexicon": toxic_signs(sample)}
    for head in HEADS:
        y = rows[head].to_numpy(float)
        model[head] = Logistic(x, y).weights() if 0 < y.sum() < len(y) else None
    return model


def with_evidence(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with the log-likelihood ratios ``evidence_low`` and ``evidence_toxic``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = sent.value, {}
        heads = [model[h] or ([0.0] * len(FEATURES), -40.0) for h in HEADS]
        weights = np.array([w for w, _ in heads]).T
        for batch in batches:
            x = np.array([describe(t, known, model["lexicon"]) for t in batch.column(text_col).to_pylist()])
            e = x.reshape(-1, len(FEATURES)) @ weights + np.array([c for _, c in heads])
            cols = [pa.array(np.clip(e[:, i], -40, 40)) for i in range(len(HEADS))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, *(f"evidence_{h}" for h in HEADS)])

    schema = StructType([*docs.schema.fields, *(StructField(f"evidence_{h}", DoubleType()) for h in HEADS)])
    return docs.mapInArrow(score, schema)


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(rates: DataFrame, n: str, rate: str, centre: Column) -> float:
    """How many documents the parent's rate counts for: the rates' variance
    beyond what their sizes explain, by the method of moments."""
    within = centre * (1 - centre)
    row = rates.select(F.col(n).cast("double").alias("n"), F.col(rate).alias("r"), centre.alias("c"), within.alias("w")).agg(
        F.sum(F.col("n") * (F.col("r") - F.col("c")) ** 2), F.sum("w"), F.sum("n"), F.sum(F.col("n") * F.col("w"))).first()
    if not row[2]:
        return 1.0
    between = max(0.0, row[0] - row[1]) / row[2]
    return float(np.clip(row[3] / row[2] / between - 1 if between > 0 else 1e4, 1.0, 1e4))


def site_priors(scored: DataFrame, host_col: str, path_col: str) -> DataFrame:
    """(host, path, prior_low, prior_toxic): shrunk rates of every path."""
    host, path = F.col(host_col).alias("host"), F.col(path_col).alias("path")
    flat = scored.agg(F.count(F.lit(1)), *[F.sum((F.col(f"evidence_{h}") > 0).cast("int")) for h in HEADS]).first()
    base = {h: (float(v or 0) + 0.5) / (flat[0] + 1) for h, v in zip(HEADS, flat[1:])}
    logit = lambda p: float(np.log(p / (1 - p)))
    expected = [F.sum(_sigmoid(F.col(f"evidence_{h}") + logit(base[h]))).alias(f"s_{h}") for h in HEADS]
    paths = stage(scored.groupBy(host, path).agg(F.count(F.lit(1)).alias("n"), *expected), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), *[F.sum(f"s_{h}").alias(f"host_s_{h}") for h in HEADS])
    for h in HEADS:
        rates = hosts.withColumn("rate", F.col(f"host_s_{h}") / F.col("host_n"))
        k = _strength(rates, "host_n", "rate", F.lit(base[h]))
        hosts = hosts.withColumn(f"host_{h}", (F.col(f"host_s_{h}") + k * base[h]) / (F.col("host_n") + k))
    hosts = hosts.select(F.col("host").alias("h"), *[f"host_{x}" for x in HEADS])
    paths = stage(paths.join(hosts, paths["host"].eqNullSafe(hosts["h"])).drop("h"), "site-rates")
    for h in HEADS:
        rates = paths.withColumn("rate", F.col(f"s_{h}") / F.col("n"))
        k = _strength(rates, "n", "rate", F.col(f"host_{h}"))
        paths = paths.withColumn(f"prior_{h}", (F.col(f"s_{h}") + k * F.col(f"host_{h}")) / (F.col("n") + k))
    return paths.select("host", "path", *[f"prior_{h}" for h in HEADS])


def classify(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "lang",
             id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` (without the text if ``keep_text`` is false) with the posteriors
    ``p_low`` and ``p_toxic`` and ``accepted`` (both at most ``REJECT_ABOVE``).

    Null text is scored as empty text. Null hosts and paths are sites of their
    own. Every row of ``docs`` gives one row, also for null or repeated ids. An
    empty table gives no rows; without usable labels every row is accepted.
    Columns of ``docs`` named like the added ones are not allowed.
    """
    added = {"p_low", "p_toxic", "accepted", *(f"evidence_{h}" for h in HEADS), *(f"prior_{h}" for h in HEADS)}
    if clash := added & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} would be overwritten")
    model = fit(docs, labels, id_col, text_col)
    scored = with_evidence(docs, model, text_col)
    scored = stage(scored if keep_text else scored.drop(text_col), "evidence")
    priors = site_priors(scored, host_col, path_col).withColumnsRenamed({"host": "_site_host", "path": "_site_path"})
    here = scored[host_col].eqNullSafe(priors["_site_host"]) & scored[path_col].eqNullSafe(priors["_site_path"])
    out = scored.join(priors, here).drop("_site_host", "_site_path")
    for h in HEADS:
        prior = F.least(F.greatest(F.col(f"prior_{h}"), F.lit(1e-6)), F.lit(1 - 1e-6))
        out = out.withColumn(f"p_{h}", F.round(_sigmoid(F.col(f"evidence_{h}") + F.log(prior / (1 - prior))), 6))
    out = out.drop(*(f"evidence_{h}" for h in HEADS), *(f"prior_{h}" for h in HEADS))
    return out.withColumn("accepted", (F.col("p_low") <= REJECT_ABOVE) & (F.col("p_toxic") <= REJECT_ABOVE))
